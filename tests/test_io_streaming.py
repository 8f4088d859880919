"""Sources, sinks, the end-to-end run and the streaming jobs."""

import json
import os

import pytest
from pyspark.sql import functions as F

from cargolens import schemas as S
from cargolens.operators import quality
from cargolens.plans import fixtures, medallion
from cargolens.plans.catalog import registry
from cargolens.session import local_os_path, scratch_path
from cargolens.sinks import files, publish
from cargolens.sources import bronze, events, tables
from pyspark.sql.types import StringType, StructField, StructType

from tests.helpers import shipment

DATED = StructType([*S.SHIPMENT.fields, StructField("ingest_date", StringType())])


def _data_files(path):
    out = []
    for d, _, names in os.walk(local_os_path(path)):
        out += [os.path.join(d, n) for n in names if not n.startswith((".", "_"))]
    return out


def test_multiline_array_reader_and_corrupt_records(spark):
    root = scratch_path(spark, "arrays")
    day = os.path.join(local_os_path(root), "2026", "05", "13")
    os.makedirs(day)
    rows = [dict(zip(S.SHIPMENT_COLUMNS, shipment(shipment_id=i))) for i in range(3)]
    with open(os.path.join(day, "batch_1_101010.json"), "w") as f:
        json.dump(rows, f, indent=2)
    with open(os.path.join(day, "batch_2_101011.json"), "w") as f:
        f.write("[{not json")
    # T20: the parent folder reads whole with recursive lookup.
    df = bronze.read_bronze(spark, root, multiline=True)
    good, bad = bronze.split_corrupt(df.cache())
    assert good.count() == 3
    assert bad.count() == 1
    assert good.columns == S.SHIPMENT_COLUMNS


def test_json_lines_landing_respects_file_size(spark, sf_small):
    root = scratch_path(spark, "lines")
    raw = fixtures.raw_shipments(spark, sf_small).limit(95)
    files.land_json_lines(files.with_ingest_date(raw), root, max_records_per_file=10)
    sizes = [sum(1 for _ in open(p)) for p in _data_files(root)]
    assert sum(sizes) == 95 and max(sizes) <= 10
    listing = bronze.bronze_inventory(spark, root)
    assert listing.count() == len(sizes)
    back = bronze.read_bronze_partitioned(spark, root)
    assert back.count() == 95
    assert back.select("ingest_date").distinct().count() == 1


def test_partition_pruning_by_date(spark, sf_small):
    root = scratch_path(spark, "by_date")
    medallion.land_partitioned(fixtures.raw_shipments(spark, sf_small), root, by_event_date=True)
    month = bronze.read_bronze_by_date(spark, root, "1996-03-01", "1996-03-31")
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        month.explain(mode="formatted")
    plan = buf.getvalue()
    assert "PartitionFilters" in plan and "ingest_date" in plan
    want = (
        fixtures.raw_shipments(spark, sf_small)
        .filter(F.substring("shipped_at", 1, 7) == "1996-03")
        .count()
    )
    assert month.count() == want


def test_medallion_run_and_gate(spark, sf_small):
    base = scratch_path(spark, "e2e")
    medallion.land_partitioned(fixtures.raw_shipments(spark, sf_small), f"{base}/bronze")
    summary = medallion.run_medallion(spark, f"{base}/bronze", f"{base}/lake", on_fail="warn")
    counts = summary["dq_counts"]
    total = fixtures.raw_shipments(spark, sf_small).count()
    assert counts["pass"] + counts["fail"] == total
    assert tables.read_silver(spark, f"{base}/lake").count() == counts["pass"]
    assert tables.read_quarantine(spark, f"{base}/lake").count() == counts["fail"]
    # the fixture repeats shipment ids, so the duplicate check fails
    assert "No duplicate shipment IDs" in summary["failed_checks"]
    with pytest.raises(quality.QualityGateError):
        medallion.run_medallion(spark, f"{base}/bronze", f"{base}/lake2", on_fail="raise")
    # gold is not written when the gate stops the run
    assert not os.path.exists(os.path.join(local_os_path(base), "lake2", "carrier_performance"))


def test_payload_round_trip(spark, sf_small):
    raw = fixtures.raw_shipments(spark, sf_small)
    payload = publish.shipment_payload(raw)
    decoded = events.decode(payload, S.SHIPMENT)
    assert decoded.filter("_parsed_ok").count() == raw.count()
    row = decoded.filter("_parsed_ok").select("key", "order_id").first()
    assert row["key"] == str(row["order_id"])


def test_decode_quarantines_bad_json(spark):
    msgs = spark.createDataFrame(
        [("1", '{"event_id": 1, "value": 2.5}'), ("2", "{oops")], "key string, value string"
    ).select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"))
    got = {r["key"]: r["_parsed_ok"] for r in events.decode(msgs, events.EVENT_SCHEMA).collect()}
    assert got == {"1": True, "2": False}


def test_stream_landing_shape_and_restart(spark, sf_small):
    q = registry()
    total = fixtures.raw_shipments(spark, sf_small).count()
    assert q["stream_landing"](spark, sf_small).first().asDict() == {"total": total, "at_most_ten": True}
    restart = {r["run"]: r["new_rows"] for r in q["stream_restart"](spark, sf_small).collect()}
    assert restart == {1: total, 2: 0}


def test_stream_silver_equals_batch_silver(spark, sf_small):
    q = registry()
    streamed = q["stream_silver"](spark, sf_small)
    batch = q["silver_shipments"](spark, sf_small)
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_stream_dedup_keeps_each_id_once(spark, sf_small):
    ids = registry()["stream_dedup"](spark, sf_small)
    distinct = fixtures.raw_shipments(spark, sf_small).select("shipment_id").distinct().count()
    assert ids.count() == distinct == ids.distinct().count()


def test_inferred_schema_gains_corrupt_column(spark):
    # T18: with inference a malformed line adds _corrupt_record to the schema;
    # the declared schema keeps the shape fixed and isolates the bad line.
    root = scratch_path(spark, "infer")
    os.makedirs(local_os_path(root))
    with open(os.path.join(local_os_path(root), "part.json"), "w") as f:
        f.write(json.dumps(dict(zip(S.SHIPMENT_COLUMNS, shipment()))) + "\n{bad\n")
    inferred = bronze.read_bronze(spark, root, infer=True)
    assert "_corrupt_record" in inferred.columns
    declared = bronze.read_bronze(spark, root)
    assert declared.columns == S.SHIPMENT_COLUMNS + ["_corrupt_record"]


def test_operational_reader_types_columns(spark, sf_small):
    from cargolens.sources import operational

    root = scratch_path(spark, "ops")
    fixtures.oltp_orders(spark, sf_small).write.parquet(f"{root}/orders")
    df = operational.read_operational(spark, "orders", root=root)
    types = dict(df.dtypes)
    assert types["order_id"] == "int" and types["expected_delivery"] == "date"
    assert df.count() == fixtures.oltp_orders(spark, sf_small).count()


def test_first_per_key_keeps_ids_exact(spark):
    from cargolens.streaming.jobs import first_per_key

    big = 9007199254740993  # not a double
    df = spark.createDataFrame([(1, "b"), (1, "a"), (big, "c"), (big, "d"), (2, None)], "k long, v string")
    assert sorted(tuple(r) for r in first_per_key(df, "k", ["v"]).collect()) == [(1, "a"), (2, None), (big, "c")]


def test_a_cluster_without_a_shared_folder_fails():
    from cargolens import session

    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Session:
        def __init__(self, master):
            self.conf = Conf({"spark.master": master})

    for master in ("yarn", "spark://host:7077", "k8s://host", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.checkpoint_root(Session(master))


def test_a_replayed_day_keeps_the_others(spark):
    base = scratch_path(spark, "replay")

    def land(day, ids, status="IN_TRANSIT"):
        rows = [(*shipment(shipment_id=i, status=status), day) for i in ids]
        frame = spark.createDataFrame(rows, DATED)
        files.land_json_lines(frame, f"{base}/bronze-{day}-{status}")

    def state():
        rows = tables.read_layer_table(spark, f"{base}/lake", "shipments").collect()
        return sorted((str(r["ingest_date"]), r["dq_flag"], r["shipment_id"]) for r in rows)

    land("2026-01-01", [1, 2])
    land("2026-01-02", [3])
    land("2026-01-02", [3, 4], "LOST")
    for folder, day in (("2026-01-01-IN_TRANSIT", "2026-01-01"), ("2026-01-02-IN_TRANSIT", "2026-01-02")):
        medallion.run_silver(spark, f"{base}/bronze-{folder}", f"{base}/lake", start=day, end=day)
    assert state() == [("2026-01-01", "PASS", 1), ("2026-01-01", "PASS", 2), ("2026-01-02", "PASS", 3)]
    # the second day again, now without a PASS row: its old PASS folder goes
    medallion.run_silver(spark, f"{base}/bronze-2026-01-02-LOST", f"{base}/lake", start="2026-01-02")
    assert [x for x in state() if x[0] == "2026-01-02"] == [("2026-01-02", "FAIL", 3), ("2026-01-02", "FAIL", 4)]
    assert len([x for x in state() if x[0] == "2026-01-01"]) == 2


def test_half_given_ranges(spark):
    root = scratch_path(spark, "half")
    rows = [(*shipment(shipment_id=i), f"2026-01-0{i}") for i in (1, 2, 3)]
    files.land_json_lines(spark.createDataFrame(rows, DATED), root)
    read = lambda *days: sorted(r["shipment_id"] for r in bronze.read_bronze_by_date(spark, root, *days).collect())
    assert (read(), read("2026-01-02"), read(None, "2026-01-02"), read("2026-01-02", "2026-01-02")) == ([1, 2, 3], [2, 3], [1, 2], [2])


def test_mean_equals_avg(spark):
    from cargolens.functions.columns import exact_mean

    for values in ([5.0, float("nan")], [1e-7, 3e-7], [1e33, 1e33, -5.0], [0.1, 0.2, None], [float("inf"), 1.0], [None]):
        df = spark.createDataFrame([(v,) for v in values], "w double")
        got, want = df.select(exact_mean("w"), F.avg("w")).first()
        assert (got is None and want is None) or got == pytest.approx(want, rel=1e-12, nan_ok=True), values


def test_weights_that_are_not_finite_are_quarantined(spark):
    from cargolens.operators import silver

    rows = [shipment(shipment_id=i, weight_kg=w) for i, w in enumerate([1.0, float("nan"), float("inf"), -1.0])]
    flags = {r["shipment_id"]: r["dq_flag"] for r in silver.flagged(spark.createDataFrame(rows, S.SHIPMENT)).collect()}
    assert flags == {0: "PASS", 1: "FAIL", 2: "FAIL", 3: "FAIL"}


def test_rules_on_absent_columns_are_reported(spark):
    frames = {"suppliers": spark.createDataFrame([(3000000000, "50.5")], "supplier_id long, rating string")}
    got = {r["constraint_name"]: r["n"] for r in quality.cast_violations(frames).collect()}
    assert got["suppliers.supplier_id int"] == got["suppliers.rating decimal(3,2)"] == 1
    assert got["suppliers.country string"] is None
    assert {r["n"] for r in quality.fk_orphans(frames).collect()} == {None}


def test_cli_stages_in_order(spark, sf_small):
    from cargolens import cli

    base = scratch_path(spark, "cli")
    src = f"{base}/incoming"
    fixtures.raw_shipments(spark, sf_small).write.json(src)
    common = ["--master", "local[2]"]
    assert cli.main(["land", "--source", src, "--bronze", f"{base}/bronze", *common]) == 0
    assert cli.main(["silver", "--bronze", f"{base}/bronze", "--lake", f"{base}/lake", *common]) == 0
    # the fixture has duplicate ids: warn passes, raise stops with exit code 2
    assert cli.main(["checks", "--lake", f"{base}/lake", *common]) == 0
    assert cli.main(["checks", "--lake", f"{base}/lake", "--on-fail", "raise", *common]) == 2
    assert cli.main(["gold", "--lake", f"{base}/lake", *common]) == 0
    assert cli.main(["report", "--lake", f"{base}/lake", "--out", f"{base}/report", *common]) == 0
    lines = files.read_text_parts(spark, f"{base}/report").collect()
    assert [r["value"] for r in lines][:2][0] == S.REPORT_SECTIONS[0] and lines[1]["value"].startswith("Carrier: ")
    assert spark.read.json(f"{base}/report_weekly_summary").count() == 5
    assert spark.read.json(f"{base}/report_business_questions").count() == 5
    silver_n = tables.read_silver(spark, f"{base}/lake").count()
    carriers = tables.read_layer_table(spark, f"{base}/lake", "carrier_performance")
    assert carriers.agg(F.sum("total_shipments")).first()[0] == silver_n


def test_malformed_bronze_goes_to_quarantine_not_dropped(spark):
    base = scratch_path(spark, "malformed")
    day = os.path.join(local_os_path(base), "bronze", "ingest_date=2026-05-13")
    os.makedirs(day)
    with open(os.path.join(day, "part-0.json"), "w") as f:
        for i in range(3):
            f.write(json.dumps(dict(zip(S.SHIPMENT_COLUMNS, shipment(shipment_id=i)))) + "\n")
        f.write("{this is not json\n")
    summary = medallion.run_medallion(spark, f"{base}/bronze", f"{base}/lake")
    assert summary["dq_counts"] == {"pass": 3, "fail": 1}
    q = tables.read_quarantine(spark, f"{base}/lake").collect()
    assert len(q) == 1 and "malformed" in q[0]["reasons"]
    assert q[0]["_corrupt_record"] == "{this is not json"
    assert tables.read_silver(spark, f"{base}/lake").count() == 3


def test_message_landing_quarantines_bad_values(spark):
    from cargolens.streaming import jobs

    base = scratch_path(spark, "messages")
    good = [json.dumps(dict(zip(S.SHIPMENT_COLUMNS, shipment(shipment_id=i)))) for i in range(4)]
    rows = [(str(i), v) for i, v in enumerate(good)] + [("9", "{broken")]
    spark.createDataFrame(rows, "key string, value string").write.json(f"{base}/topic")
    messages = events.file_stream(spark, f"{base}/topic", "key STRING, value STRING", "json").select(
        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value")
    )
    jobs.land_messages(messages, f"{base}/bronze", f"{base}/quarantine", f"{base}/ckpt")
    landed = spark.read.schema(S.SHIPMENT).json(f"{base}/bronze")
    assert sorted(r["shipment_id"] for r in landed.collect()) == [0, 1, 2, 3]
    bad = spark.read.json(f"{base}/quarantine").collect()
    assert [(r["key"], r["value"]) for r in bad] == [("9", "{broken")]
