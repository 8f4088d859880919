"""Incremental silver and gold: new landings only, the same tables as a full run."""

import random

import pytest
from pyspark.sql import functions as F

from cargolens import schemas as S
from cargolens.operators import gold, partials, quality, silver
from cargolens.plans import incremental, medallion
from cargolens.session import delete_path, glob_paths, scratch_path
from cargolens.sinks import files
from cargolens.sinks.manifest import SNAPSHOT_EVERY, Manifest
from cargolens.sources import bronze, tables
from tests.helpers import frame, shipment

D1, D2, D3 = "2026-01-01", "2026-01-02", "2026-01-03"


def rows_of(n, seed=0, first=0):
    r = random.Random(seed)
    return [
        shipment(
            shipment_id=first + i % max(1, n - 2),  # two duplicates
            order_id=None if i % 17 == 0 else r.choice([-5, 0, 1, 2, 3, 40000, 2**40, 2**40 + 1]),
            carrier=r.choice(["DHL", "FedEx", None]),
            status=r.choice(["DELIVERED", " delayed", "IN_TRANSIT", "LOST"]),
            origin=r.choice(["A", "B"]),
            weight_kg=r.choice([0.1, 1 / 3, 7.0, -1.0]),
            quantity=r.randint(1, 9),
        )
        for i in range(n)
    ]


def land(spark, base, day, landing, rows):
    files.land_json_lines(frame(spark, rows).withColumn("ingest_date", F.lit(day)), f"{base}/bronze", landing=landing)


def stored(spark, lake):
    rows = tables.read_layer_table(spark, lake, "shipments").collect()
    return sorted((str(r["ingest_date"]), r["dq_flag"], r["shipment_id"]) for r in rows)


def gold_of(spark, lake):
    return {n: [tuple(r) for r in tables.read_layer_table(spark, lake, n).collect()] for n in (*gold.GOLD_TABLES, "checks")}


def full_run(spark, base):
    """One full run over the same bronze, elsewhere."""
    lake = scratch_path(spark, "full")
    medallion.run_medallion(spark, f"{base}/bronze", lake, run_ts=F.lit("2026-01-01").cast("timestamp"))
    return lake


def run(spark, base, **options):
    return incremental.run_incremental(spark, f"{base}/bronze", f"{base}/lake", F.lit("2026-01-01").cast("timestamp"), **options)


def same_gold(a, b):
    assert a.keys() == b.keys()
    for name in a:
        assert sorted(map(str, a[name])) == sorted(map(str, b[name])), name
        if name != "checks":
            assert [r[0] for r in a[name]] == [r[0] for r in b[name]]  # the stored order


def test_runs_read_new_landings_only(spark, monkeypatch):
    base = scratch_path(spark, "inc")
    read = []
    real = bronze.read_landings
    monkeypatch.setattr(bronze, "read_landings", lambda s, root, names: read.append(names) or real(s, root, names))
    land(spark, base, D1, "a", rows_of(60))
    land(spark, base, D2, "b", rows_of(40, 1, 100))
    first = run(spark, base)
    assert first["landings"] == [f"ingest_date={D1}/landing=a", f"ingest_date={D2}/landing=b"] and first["days"] == [D1, D2]
    assert run(spark, base)["landings"] == [] and len(read) == 1
    land(spark, base, D1, "c", rows_of(30, 2, 200))  # late for the first day
    third = run(spark, base)
    assert third["landings"] == [f"ingest_date={D1}/landing=c"] and third["days"] == [D1]
    assert read[-1] == [f"ingest_date={D1}/landing=c"]
    lake = full_run(spark, base)
    assert stored(spark, f"{base}/lake") == stored(spark, lake)
    same_gold(gold_of(spark, f"{base}/lake"), gold_of(spark, lake))


def test_partials_read_the_stale_day_only(spark):
    base = scratch_path(spark, "pruned")
    for i, day in enumerate((D1, D2, D3)):
        land(spark, base, day, f"l{i}", rows_of(20, i, 100 * i))
    run(spark, base)
    rows = incremental.silver_of_days(spark, f"{base}/lake", [D2])
    scanned = rows.select(F.input_file_name().alias("f")).distinct().collect()
    assert scanned and all(f"ingest_date={D2}" in r["f"] for r in scanned)


def test_a_landing_that_changed_is_done_again(spark):
    base = scratch_path(spark, "changed")
    land(spark, base, D1, "a", rows_of(30))
    land(spark, base, D2, "b", rows_of(10, 5, 500))
    run(spark, base)
    # the landing is replaced: it has no valid row any more
    delete_path(spark, f"{base}/bronze/ingest_date={D1}/landing=a")
    land(spark, base, D1, "a", [shipment(shipment_id=1, status="LOST")])
    again = run(spark, base)
    assert again["landings"] == [f"ingest_date={D1}/landing=a"] and again["days"] == [D1]
    assert [x for x in stored(spark, f"{base}/lake") if x[0] == D1] == [(D1, "FAIL", 1)]
    same_gold(gold_of(spark, f"{base}/lake"), gold_of(spark, full_run(spark, base)))


def test_a_run_that_failed_is_repeated(spark, monkeypatch):
    base = scratch_path(spark, "failed")
    land(spark, base, D1, "a", rows_of(30))
    real = Manifest.commit

    def lost(self, entries):
        raise OSError("no commit")

    for name in ("shipments", "partials"):  # before the first commit, and between the two
        monkeypatch.setattr(Manifest, "commit", lambda self, e, n=name: lost(self, e) if self.path.endswith(n) else real(self, e))
        with pytest.raises(OSError):
            run(spark, base)
    monkeypatch.setattr(Manifest, "commit", real)
    run(spark, base)
    same_gold(gold_of(spark, f"{base}/lake"), gold_of(spark, full_run(spark, base)))


def test_rerun_of_days_and_of_a_plain_table(spark):
    base = scratch_path(spark, "again")
    land(spark, base, D1, "a", rows_of(20))
    land(spark, base, D2, "b", rows_of(20, 1, 100))
    medallion.run_silver(spark, f"{base}/bronze", f"{base}/lake")  # a full run's layout
    assert len(run(spark, base)["landings"]) == 2  # replaced as a whole
    again = run(spark, base, start=D2, again=True)
    assert again["landings"] == [f"ingest_date={D2}/landing=b"] and again["days"] == [D2]
    assert run(spark, base)["landings"] == []
    with pytest.raises(ValueError, match="landings"):
        medallion.run_silver(spark, f"{base}/bronze", f"{base}/lake", start=D1, end=D1)
    medallion.run_silver(spark, f"{base}/bronze", f"{base}/lake")
    assert not incremental.silver_manifest(spark, f"{base}/lake").exists()
    assert stored(spark, f"{base}/lake") == stored(spark, full_run(spark, base))


def test_nothing_landed_and_nothing_valid(spark):
    base = scratch_path(spark, "nothing")
    assert run(spark, base) == {"pass": 0, "fail": 0, "landings": [], "days": [], "failed_checks": []}
    land(spark, base, D1, "a", [shipment(status="LOST")])
    assert run(spark, base)["fail"] == 1
    got = gold_of(spark, f"{base}/lake")
    assert all(got[n] == [] for n in gold.GOLD_TABLES) and len(got["checks"]) == 9


def test_gate_stops_before_gold(spark):
    base = scratch_path(spark, "gate")
    land(spark, base, D1, "a", rows_of(20))  # has duplicates
    with pytest.raises(quality.QualityGateError):
        run(spark, base, on_fail="raise")
    assert not glob_paths(spark, f"{base}/lake/carrier_performance")


def test_bitmaps_count_distinct_exactly(spark):
    """Negative, null, huge and repeated ids, split over days in any way."""
    r = random.Random(4)
    pool = [None, 0, 1, -1, 32768, 32769, -32768, -32769, 2**62, -(2**62), 2**63 - 1, -(2**63) + 1] + list(range(500))
    rows = [(r.choice("abc"), r.choice([D1, D2, D3]), r.choice(pool)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, day string, id long").repartition(6)
    got = partials.distinct_counts(partials.id_bitmaps(df, "id", ["day", "g"]), ["g"], "n")
    want = df.groupBy("g").agg(F.count_distinct("id").alias("n"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_merged_tables_equal_one_pass(spark):
    rows = frame(spark, rows_of(300)).withColumn("ingest_date", F.concat(F.lit("2026-01-0"), (F.col("shipment_id") % 4 + 1).cast("string")))
    sv = silver.passed(silver.flagged(rows)).cache()
    parts = partials.partials_of(sv)
    merged = partials.merged_gold(parts["kpi"], partials.distinct_counts(parts["order_ids"], ["status"], "unique_orders"))
    for name, table in gold.gold_tables(sv).items():
        assert [tuple(r) for r in merged[name].collect()] == [tuple(r) for r in table.collect()], name
    checks = partials.merged_checks(parts["checks"], parts["shipment_ids"])
    assert sorted(map(str, checks.collect())) == sorted(map(str, quality.silver_checks(sv).collect()))


def test_manifest_snapshots(spark):
    m = Manifest(spark, scratch_path(spark, "manifest"))
    for i in range(SNAPSHOT_EVERY + 5):
        m.commit({f"n{i % 60}": str(i)})
    assert m.entries() == {f"n{i}": str(i) for i in range(SNAPSHOT_EVERY + 5)}
    assert len(glob_paths(spark, f"{m.path}/run-*.json")) == 5
    m.clear()
    assert not m.exists() and m.entries() == {}


def test_schema_is_that_of_silver(spark):
    assert set(S.SILVER_COLUMNS) <= set(incremental.no_silver(spark).columns)


def test_cli_incremental_run_from_a_topic_folder(spark, sf_small):
    """Publish to a topic folder, land it, run twice: the second run reads nothing."""
    from cargolens import cli
    from cargolens.plans import fixtures

    base = scratch_path(spark, "cli_incremental")
    common = ["--master", "local[2]"]
    files.land_json_lines(files.with_ingest_date(fixtures.raw_shipments(spark, sf_small)), f"{base}/first")
    topic = ["--topic-folder", f"{base}/topic"]
    assert cli.main(["publish", "--bronze", f"{base}/first", *topic, *common]) == 0
    assert cli.main(["land", "--bronze", f"{base}/bronze", *topic, *common]) == 0
    for landings in (1, 0):
        found = len(incremental.silver_manifest(spark, f"{base}/lake").entries())
        assert cli.main(["run", "--incremental", "--bronze", f"{base}/bronze", "--lake", f"{base}/lake", *common]) == 0
        assert len(incremental.silver_manifest(spark, f"{base}/lake").entries()) == found + landings
    n = spark.read.parquet(f"{base}/lake/shipments").count()
    assert n == fixtures.raw_shipments(spark, sf_small).count()
