"""Figures that must not grow faster than the input: files, segments, builds."""

import gzip
import json
import os

from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from cargolens.operators import silver
from cargolens.plans import catalog_incremental, catalog_more, fixtures
from cargolens.session import OPEN_FOLDERS, glob_paths, local_os_path, scratch_path
from cargolens.sinks import files, small_files
from cargolens.streaming import dedup, jobs
from cargolens.streaming import message_log as ML
from tests.helpers import frame, shipment


def data_files(path):
    found = []
    for d, _, names in os.walk(local_os_path(path)):
        found += [os.path.join(d, n) for n in names if not n.startswith((".", "_"))]
    return sorted(found)


def test_large_landings_are_compressed(spark):
    base = scratch_path(spark, "packed")
    files.land_json_lines(spark.range(3000).withColumn("x", F.lit("shipment")), f"{base}/t", 1_000, partition_by=None)
    found = data_files(f"{base}/t")
    assert found and all(p.endswith(".json.gz") for p in found)
    assert max(sum(1 for _ in gzip.open(p)) for p in found) <= 1_000
    assert spark.read.schema("id long").json(f"{base}/t").agg(F.count("id"), F.sum("id")).first() == (3000, 2999 * 1500)


@F.udf(StringType())
def folders_open(_):
    """How many folders the task that computes the value may write side by side."""
    from pyspark import TaskContext

    return TaskContext.get().getLocalProperty("spark.sql.maxConcurrentOutputFileWriters") or "0"


def test_landings_are_not_sorted_by_folder(spark):
    base = scratch_path(spark, "open")
    rows = spark.range(3000).select("id", folders_open("id").alias("text"), F.concat(F.lit("2026-01-0"), F.col("id") % 9 + 1).alias("day"))
    files.land_json_lines(rows, base, 1_000, partition_by="day", landing="a")  # more folders than stay open
    landed = spark.read.schema("id long, text string, day string").json(base)
    assert landed.groupBy("text").agg(F.count("id"), F.sum("id")).collect() == [(str(OPEN_FOLDERS), 3000, 2999 * 1500)]
    assert landed.where("id % 9 + 1 <> cast(right(cast(day as string), 1) as int)").isEmpty()
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", "0") == "0"


def test_silver_is_not_sorted_by_folder(spark, tmp_path):
    raw = frame(spark, [shipment(shipment_id=i, status="LOST" if i % 3 == 0 else "DELAYED") for i in range(30)])
    tracked = raw.withColumn("tracking_number", folders_open("shipment_id"))
    dated = tracked.withColumn("ingest_date", F.lit("2026-01-01"))
    _, counts = files.write_flagged(silver.flagged(dated), f"{tmp_path}/lake", days=(None, None))
    assert counts == {"pass": 20, "fail": 10}
    raw.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(raw.schema).parquet(f"{tmp_path}/in").withColumn("tracking_number", folders_open("shipment_id"))
    jobs.silver_stream(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    for path in (f"{tmp_path}/lake/shipments", f"{tmp_path}/out"):
        held = spark.read.parquet(path).groupBy("tracking_number", "dq_flag").count().orderBy("dq_flag").collect()
        assert held == [(str(OPEN_FOLDERS), "FAIL", 10), (str(OPEN_FOLDERS), "PASS", 20)]


def test_stored_tables_are_not_shuffled_before_landing(spark, sf_small, monkeypatch):
    asked, land = [], files.land_json_arrays
    monkeypatch.setattr(catalog_more.files, "land_json_arrays", lambda *a, **k: (asked.append(k["writers"]), land(*a, **k)))
    for cores in (1, 1000):
        monkeypatch.setattr(catalog_more.SS, "parallelism", lambda _, n=cores: n)
        n = sum(r["n"] for r in catalog_more.q_arrays_one_day(spark, sf_small).collect())
        assert n == fixtures.raw_shipments(spark, sf_small).where("shipment_id % 3 = 0").count()
    assert asked == [None, None, 1000, 1000]


def test_small_files_keep_every_row(spark):
    base = scratch_path(spark, "small")
    rows = spark.range(25).coalesce(1).withColumn("ingest_date", F.when(F.col("id") < 20, F.lit("2026-01-01")))
    files.land_json_lines(rows, f"{base}/lines", 10, landing="a")
    sizes = {p.split("/ingest_date=")[1].split("/")[0]: 0 for p in data_files(f"{base}/lines")}
    for p in data_files(f"{base}/lines"):
        n = sum(1 for _ in open(p))
        assert n <= 10
        sizes[p.split("/ingest_date=")[1].split("/")[0]] += n
    assert sizes == {"2026-01-01": 20, small_files.NULL_FOLDER: 5}
    assert not glob_paths(spark, f"{base}/lines/_landing-*")
    files.land_json_arrays(spark.range(25).coalesce(1), f"{base}/arrays", 10)
    assert sorted(len(json.load(open(p))) for p in data_files(f"{base}/arrays")) == [5, 10, 10]


def test_replaced_folders_only(spark):
    base = scratch_path(spark, "replaced")
    for landing, n in (("a", 7), ("b", 3), ("b", 4)):
        rows = spark.range(n).withColumn("landing", F.lit(landing))
        files.write_json_lines(rows, f"{base}/t", 2, ["landing"], replace=True)
    got = spark.read.schema("id long, landing string").json(f"{base}/t").groupBy("landing").count().collect()
    assert dict(tuple(r) for r in got) == {"a": 7, "b": 4}


def test_many_tasks_write_one_partition_in_order(spark):
    base = scratch_path(spark, "ranged")
    rows = spark.range(2000).select(
        F.lit("k").cast("binary").alias("key"), F.col("id").cast("string").cast("binary").alias("value"), "id"
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ML.publish_batch(rows.repartition(3), f"{base}/t", 1, "id")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(ML.Log(f"{base}/t").segments(0)) > 1
    got = ML.topic_table(spark, f"{base}/t").orderBy("offset").select("offset", F.col("value").cast("string").cast("long")).collect()
    assert [tuple(r) for r in got] == [(i, i) for i in range(2000)]


def test_a_span_starts_inside_a_segment(spark, monkeypatch):
    base = scratch_path(spark, "spans")
    rows = spark.range(250).select(F.lit(None).cast("binary").alias("key"), F.col("id").cast("string").cast("binary").alias("value"), "id")
    ML.publish_batch(rows, f"{base}/t", 1, "id")
    log = ML.Log(f"{base}/t")
    got = [(at, batch.num_rows, batch.column(1).to_pylist()) for at, batch in log.read(0, 90, 130)]
    assert [v for _, _, values in got for v in values] == [str(i).encode() for i in range(90, 130)] and got[0][0] == 90
    monkeypatch.setattr(ML, "SPAN", 100)
    assert [(s.start, s.end) for s in ML.LogReader(f"{base}/t").partitions()] == [(0, 100), (100, 200), (200, 250)]


def test_segments_of_the_earlier_format_are_read(spark, tmp_path):
    folder = tmp_path / "t" / "partition=0"
    folder.mkdir(parents=True)
    (folder / f"{0:020d}-{2:020d}.jsonl").write_text('{"k": "YQ==", "v": "Yg==", "t": 5}\n{"k": null, "v": null, "t": 5}\n')
    got = ML.topic_table(spark, str(tmp_path / "t")).orderBy("offset").select("key", "value", "offset").collect()
    assert [(r["key"], r["value"], r["offset"]) for r in got] == [(b"a", b"b", 0), (None, None, 1)]


def test_a_batch_writes_one_file_a_month(spark):
    base = scratch_path(spark, "ids")
    state = dedup.State(spark, f"{base}/state", "bigint", merge_at=2)
    for batch in range(3):
        ids = spark.range(batch * 100, batch * 100 + 100).repartition(8)
        dated = ids.select("id", F.timestamp_seconds(F.col("id") % 3 * 86400 * 40).alias("event_ts"))
        state.add(dated, batch)
    assert len(data_files(f"{base}/state/ids")) == 9
    state.tidy(2, "")  # the months that are due are merged together
    assert len(glob_paths(spark, f"{base}/state/ids/event_month=*/batch=000000000000-000000000001")) == 3
    assert len(glob_paths(spark, f"{base}/state/filters/event_month=*/batch=000000000001")) == 3
    kept = state.read_ids(glob_paths(spark, f"{base}/state/ids/event_month=*/batch=*"))
    assert kept.agg(F.count("id"), F.count_distinct("id")).first() == (300, 300)


def test_files_of_a_stream_grow_with_the_input(spark, sf_small, monkeypatch):
    base = scratch_path(spark, "input")
    monkeypatch.setattr(catalog_more, "INPUT_FILE_RECORDS", (10, 100_000))
    path = catalog_more._shipment_input(spark, sf_small, base)
    lines = spark.read.parquet(f"{sf_small}/lineitem.parquet").count()
    landed = spark.read.schema(fixtures.S.SHIPMENT).json(path).groupBy(F.input_file_name()).count()
    assert landed.agg(F.max("count")).first()[0] == lines // catalog_more.INPUT_FILES


def test_deliveries_read_one_stored_fixture(spark, sf_small):
    base = scratch_path(spark, "deliveries")
    assert list(catalog_incremental._deliver(spark, sf_small, f"{base}/bronze")) == ["a", "b", "c"]
    assert spark.read.parquet(f"{base}/bronze_shipments").count() == fixtures.raw_shipments(spark, sf_small).count()
