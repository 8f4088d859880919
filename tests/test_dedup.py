"""STR6: the dedup's state is bounded, exact and survives a replay."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from cargolens import schemas as S
from cargolens.session import glob_paths, scratch_path
from cargolens.sources import events
from cargolens.streaming import dedup
from tests.helpers import shipment

DAY0 = datetime.datetime(2026, 1, 1)


def at(days):
    return None if days is None else (DAY0 + datetime.timedelta(days=days)).strftime("%Y-%m-%dT%H:%M:%S")


def deliver(spark, base, n, ids, days):
    rows = [shipment(shipment_id=i, event_timestamp=at(days)) for i in ids]
    spark.createDataFrame(rows, S.SHIPMENT).coalesce(1).write.json(f"{base}/in/d{n:03d}")


def drain(spark, base, delay="40 days", per_trigger=1000, **options):
    source = events.file_stream(spark, f"{base}/in/*", S.SHIPMENT, "json", max_files_per_trigger=per_trigger)
    return dedup.dedup_stream(source, f"{base}/out", f"{base}/ckpt", delay, **options)


def ids_of(spark, path):
    return sorted((r[0] for r in spark.read.parquet(path).select("shipment_id").collect()), key=lambda i: (i is None, i))


class Watched(dedup.State):
    """Notes the ids that batches compare with (merges read them too)."""

    read_paths: list = []
    comparing = False

    def repeated(self, *args):
        self.comparing = True
        try:
            return super().repeated(*args)
        finally:
            self.comparing = False

    def read_ids(self, paths):
        if self.comparing:
            Watched.read_paths.append(list(paths))
        return super().read_ids(paths)


def test_only_held_months_inside_the_delay_are_read(spark):
    base = scratch_path(spark, "held")
    Watched.read_paths = []
    for n, (ids, day) in enumerate([([1, 2, 3], 0), ([4, 5], 31), ([5, 6], 45), ([1, 7], 100), ([7, 7, 8], 101)]):
        deliver(spark, base, n, ids, day)
        drain(spark, base, state_class=Watched, merge_at=1)
    # the id of January comes back after the delay: it is new again
    assert ids_of(spark, f"{base}/out") == [1, 1, 2, 3, 4, 5, 6, 7, 8]
    read = [sorted(re.search(r"event_month=([^/]+)", p)[1] for p in paths) for paths in Watched.read_paths]
    # each batch the folder of the one before it; besides only January's, whose filter
    # holds the 1 (older than the delay, as its time says), but not February's
    assert read == [["2026-01"], ["2026-02"], ["2026-02"], ["2026-01"], ["2026-04"]]
    months = {re.search(r"event_month=([^/]+)", p)[1] for p in glob_paths(spark, f"{base}/out_state/*/event_month=*")}
    assert months == {"2026-04"}  # what lies before the delay is gone
    assert len(glob_paths(spark, f"{base}/out_state/marks/*.json")) == 2


def test_full_filters_stay_exact(spark):
    """One slot for all ids: the filter holds everything, the ids decide."""
    base = scratch_path(spark, "full")
    for n in range(4):
        deliver(spark, base, n, range(n * 20, n * 20 + 40), 5 * n)
        drain(spark, base, slots=1, merge_at=2)
    assert ids_of(spark, f"{base}/out") == list(range(100))
    folders = [p.rsplit("batch=", 1)[1] for p in glob_paths(spark, f"{base}/out_state/ids/event_month=*/batch=*")]
    assert any("-" in f for f in folders)  # small folders were merged


def test_a_replayed_batch_changes_nothing(spark, monkeypatch):
    base = scratch_path(spark, "replay")
    stream = {}
    monkeypatch.setattr(dedup, "_drain", lambda df, checkpoint, write_batch: stream.setdefault("write", write_batch))
    frame = spark.createDataFrame([shipment()], S.SHIPMENT)
    dedup.dedup_stream(frame, f"{base}/out", f"{base}/ckpt", "40 days")

    def batch(ids, day):
        rows = [shipment(shipment_id=i, event_timestamp=at(day)) for i in ids]
        return spark.createDataFrame(rows, S.SHIPMENT).withColumn("event_ts", F.try_to_timestamp("event_timestamp"))

    write = stream["write"]
    write(batch([1, 2], 0), 0)
    for _ in range(3):
        write(batch([2, 3, None], 30), 1)
    write(batch([3, 4], 35), 2)
    for _ in range(2):
        write(batch([4, 5], 36), 3)
    assert ids_of(spark, f"{base}/out") == [1, 2, 3, 4, 5]
    assert ids_of(spark, f"{base}/out_no_key") == [None]


def test_rows_without_a_time(spark):
    """They leave the state with the time their batch knows; before any time
    is known they are compared among themselves."""
    base = scratch_path(spark, "no_time")
    for n, (ids, day) in enumerate([([1, 1, 2], None), ([2, 3], None), ([9], 0), ([9, 10], None), ([10], 20), ([11], 90), ([10], 91)]):
        deliver(spark, base, n, ids, day)
        drain(spark, base)
    assert ids_of(spark, f"{base}/out") == [1, 2, 3, 9, 10, 10, 11]


def test_time_per_batch_is_flat(spark):
    """Fifty batches: the last are no slower than the first ones that had a state."""
    base = scratch_path(spark, "flat")
    for n in range(50):
        deliver(spark, base, n, range(n * 90, n * 90 + 100), 3 * n)
    query = drain(spark, base, delay="20 days", per_trigger=1, merge_at=3)
    times = [p["durationMs"]["addBatch"] for p in query.recentProgress if p["numInputRows"]]
    assert len(times) == 50
    early, late = sorted(times[5:20])[7], sorted(times[35:50])[7]
    assert late < 1.5 * early, (early, late)
    folders = glob_paths(spark, f"{base}/out_state/ids/event_month=*/batch=*")
    assert len(folders) <= 3 * 8
    n = spark.read.parquet(f"{base}/out").agg(F.count("*"), F.count_distinct("shipment_id")).first()
    assert tuple(n) == (50 * 90 + 10, 50 * 90 + 10)


@pytest.mark.parametrize("kind", ["string", "long"])
def test_filter_never_denies_an_id(spark, kind):
    ids = spark.range(2000).select(F.col("id").cast(kind).alias("id"))
    slot, bits = dedup.slot_and_bits(F.col("id"), 64)
    table = ids.select("id", slot.alias("slot"), bits.alias("bits"))
    held = table.groupBy("slot").agg(F.bit_or("bits").alias("all"))
    missed = table.join(held, "slot").where(F.col("all").bitwiseAND(F.col("bits")) != F.col("bits"))
    assert missed.isEmpty() and held.count() <= 64
    assert table.select(F.min(F.bit_count("bits")), F.max(F.bit_count("bits"))).first()[1] <= dedup.BITS
