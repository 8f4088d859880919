"""Landings of very many small files: what the driver holds, and whole rows."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from cargolens import schemas as S
from cargolens.plans import catalog_more, catalog_topics, fixtures
from cargolens.session import glob_paths, local_os_path, scratch_path
from cargolens.sinks import files, small_files
from cargolens.sources import bronze, events
from cargolens.streaming import jobs
from tests.helpers import frame, shipment


def data_files(path):
    found = []
    for d, _, names in os.walk(local_os_path(path)):
        found += [os.path.join(d, n) for n in names if not n.startswith((".", "_"))]
    return sorted(found)


def row(**values):
    return json.dumps(dict(zip(S.SHIPMENT_COLUMNS, shipment(**values), strict=True)), ensure_ascii=False)


ODD = {
    "array": f"[{row(shipment_id=1)},\n {row(shipment_id=2, origin='Zürich → 東京')}]".encode(),
    "object": row(shipment_id=3).encode(),
    "none": b"[]",
    "empty": b"",
    "blank": b" \n ",
    "garbage": b"[{not json",
    "cut": f"[{row(shipment_id=4)},{row(shipment_id=5)[:40]}".encode(),
    "wrong type": f'[{row(shipment_id=6)},{{"shipment_id": "x", "carrier": "DHL"}}]'.encode(),
    "nulls": b"[null, {}, 7]",
    "number": b"7",
    "rest": f"[{row(shipment_id=7)}] and more".encode(),
    "two": f"[{row(shipment_id=8)}]\n[{row(shipment_id=9)}]".encode(),
    "marked": b"\xef\xbb\xbf" + f"[{row(shipment_id=10)}]".encode(),
    "wide": f"[{row(shipment_id=11)}]".encode("utf-16-le"),
}


@pytest.mark.parametrize("name", [*ODD, "packed"])
def test_small_arrays_are_read_as_spark_reads_them(spark, name, tmp_path):
    import gzip

    (tmp_path / "2026/05/_hidden").mkdir(parents=True)
    (tmp_path / "2026/05/_hidden/x.json").write_bytes(ODD["array"])
    if name == "packed":
        (tmp_path / "2026/05/a.json.gz").write_bytes(gzip.compress(ODD["array"]))
    else:
        (tmp_path / "2026/05/a.json").write_bytes(ODD[name])
    read = lambda small: bronze.read_bronze(spark, str(tmp_path), multiline=True, small=small)
    assert read(True).columns == read(False).columns
    assert sorted(map(str, read(True).cache().collect())) == sorted(map(str, read(False).cache().collect()))


def test_the_driver_holds_no_file_names(spark, sf_small):
    total = fixtures.raw_shipments(spark, sf_small).count()
    scanned = catalog_more.q_bronze_scan(spark, sf_small)
    assert scanned.inputFiles() == [] and scanned.count() == total
    assert catalog_more.q_stream_landing(spark, sf_small).inputFiles() == []
    assert catalog_topics.q_landing_exact(spark, sf_small).inputFiles() == []


def test_many_files_are_moved_by_folder():
    from pyarrow import fs

    writer = small_files.BatchWriter("/t", ["landing"], 10, False, False, True)
    moves = list(writer._moves(fs.LocalFileSystem(), [small_files.Staged("a", {"x": 1_000_000}), small_files.Staged("b", {"x": 7, "y": 7})]))
    assert len(moves) == 100 + 1 + 7 and len(set(moves)) == len(moves)


@pytest.mark.parametrize("most", [1, 3, 100])
def test_folders_of_many_files_are_read_whole(spark, monkeypatch, most):
    monkeypatch.setattr(small_files, "FOLDER_FILES", most)
    base = scratch_path(spark, "many")
    rows = frame(spark, [shipment(shipment_id=i) for i in range(95)]).repartition(3)
    ids = lambda df: sorted(r["shipment_id"] for r in df.select("shipment_id").collect())
    for n in (1, 2):
        files.land_json_lines(files.with_ingest_date(rows), f"{base}/lines", 10, landing=f"run{n}")
        files.land_json_arrays(rows, f"{base}/arrays", 10, day=f"2026-01-0{n}")
        files.land_json_lines(rows, f"{base}/flat", 10, partition_by=None)
    assert ids(bronze.read_bronze_partitioned(spark, f"{base}/lines")) == sorted([*range(95)] * 2)
    assert ids(bronze.read_landings(spark, f"{base}/lines", list(bronze.landings(spark, f"{base}/lines")))) == sorted([*range(95)] * 2)
    arrays = bronze.read_bronze_arrays(spark, f"{base}/arrays")
    assert sorted(map(tuple, arrays.groupBy("ingest_date").count().collect())) == [("2026-01-01", 95), ("2026-01-02", 95)]
    assert ids(bronze.read_bronze_arrays(spark, f"{base}/arrays", start="2026-01-02")) == [*range(95)]
    assert ids(bronze.read_bronze(spark, f"{base}/arrays", multiline=True, small=True)) == sorted([*range(95)] * 2)
    for root in ("lines", "flat"):
        landed = bronze.read_small_lines(spark, f"{base}/{root}").cache()
        assert ids(landed) == sorted([*range(95)] * 2) and landed.groupBy("file").count().agg(F.max("count")).first()[0] == 10
        assert {os.path.realpath(r["file"]) for r in landed.select("file").distinct().collect()} == set(map(os.path.realpath, data_files(f"{base}/{root}")))
        assert not glob_paths(spark, f"{base}/{root}/_landing-*")


def test_a_scan_deals_every_file_once(tmp_path):
    for folder, n in (("a", 100), ("b/c", 3), ("d=1", 40), ("_no", 5)):
        (tmp_path / folder).mkdir(parents=True)
        for i in range(n):
            (tmp_path / folder / f"{i}.json").write_text("{}")
    tasks = small_files.scan_tasks(str(tmp_path), 8)
    found = [[f for f, _ in small_files.scan(str(tmp_path), task)] for task in tasks]
    assert len({f for some in found for f in some}) == sum(map(len, found)) == 143
    assert max(map(len, found)) < 60 and len(tasks) >= 4


def test_replaced_folders_lose_their_sub_folders(spark, monkeypatch):
    monkeypatch.setattr(small_files, "FOLDER_FILES", 2)
    base = scratch_path(spark, "replaced_many")
    for landing, n in (("a", 17), ("b", 30), ("b", 14)):
        files.write_json_lines(spark.range(n).withColumn("landing", F.lit(landing)), f"{base}/t", 2, ["landing"], replace=True)
    got = spark.read.schema("id long, landing string").json(f"{base}/t").groupBy("landing").count().collect()
    assert dict(map(tuple, got)) == {"a": 17, "b": 14}


@F.udf(BooleanType())
def now_and_then(_):
    return random.random() < 0.5


@pytest.mark.parametrize("size", [10, 100])
def test_exact_batches_are_consecutive(spark, size):
    base = scratch_path(spark, "consecutive")
    rows = spark.range(0, 400, 1, 9).filter((F.col("id") < 100) | (F.col("id") > 150))
    dated = rows.withColumn("ingest_date", F.when(F.col("id") > 300, F.lit("2026-01-01")).otherwise(F.lit("2026-01-02")))
    files.land_json_lines(dated, f"{base}/out", size, exact=True, landing="a")
    got = bronze.read_small_lines(spark, f"{base}/out", "id long").groupBy("file").agg(F.collect_list("id").alias("ids")).collect()
    days = [i for i in range(301) if not 100 <= i <= 150], [*range(301, 400)]
    assert sorted(r["ids"] for r in got) == sorted(d[i : i + size] for d in days for i in range(0, len(d), size))


def test_exact_batches_need_no_equal_passes(spark):
    """Rows that differ from pass to pass, of two days, in tasks of all sizes."""
    base = scratch_path(spark, "one_pass")
    rows = spark.range(0, 400, 1, 9).filter(now_and_then.asNondeterministic()("id") & ((F.col("id") < 100) | (F.col("id") > 150)))
    dated = rows.withColumn("ingest_date", F.when(F.col("id") % 3 == 0, F.lit("2026-01-01")).otherwise(F.lit("2026-01-02")))
    files.land_json_lines(dated, f"{base}/out", 10, exact=True, landing="a")
    landed = bronze.read_small_lines(spark, f"{base}/out", "id long")
    day = F.regexp_extract("file", "ingest_date=([^/]*)/", 1).alias("day")
    sizes = landed.groupBy(day, "file").agg(F.count("id").alias("n")).collect()
    for d in ("2026-01-01", "2026-01-02"):
        counts = [r["n"] for r in sizes if r["day"] == d]
        assert len(counts) > 1 and sum(n != 10 for n in counts) <= 1 and max(counts) == 10
    assert landed.agg(F.count("id") == F.count_distinct("id")).first()[0]


def test_a_stream_landing_without_rejects_is_not_cached(spark, monkeypatch):
    cached, kind = [], type(spark.range(0))
    persist = kind.persist
    monkeypatch.setattr(kind, "persist", lambda self, *a, **k: (cached.append(1), persist(self, *a, **k))[1])
    base = scratch_path(spark, "uncached")
    frame(spark, [shipment(shipment_id=i) for i in range(25)]).write.json(f"{base}/in")
    for exact in (False, True):
        stream = events.file_stream(spark, f"{base}/in", S.SHIPMENT, "json")
        jobs.land_stream(stream, f"{base}/out{exact}", f"{base}/checkpoint{exact}", 10, exact=exact)
        assert bronze.read_small_lines(spark, f"{base}/out{exact}").agg(F.count("shipment_id"), F.count_distinct("shipment_id")).first() == (25, 25)
    assert not cached
    stream = events.file_stream(spark, f"{base}/in", S.SHIPMENT_WITH_CORRUPT, "json")
    jobs.land_stream(stream, f"{base}/kept", f"{base}/checkpoint", 10)
    assert cached and bronze.read_small_lines(spark, f"{base}/kept").count() == 25
