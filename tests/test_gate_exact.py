"""The gate on a stream (Q1) and exact consumer batches (SNK1, STR3)."""

import json

import pytest
from pyspark.sql import functions as F

from cargolens import schemas as S
from cargolens.session import glob_paths, read_text, scratch_path
from cargolens.sinks import files
from cargolens.sources import events
from cargolens.streaming import gate
from tests.helpers import frame, shipment


def deliver(spark, base, n, rows):
    frame(spark, rows).coalesce(1).write.json(f"{base}/in/{n}")


def run(spark, base, **options):
    source = events.file_stream(spark, f"{base}/in/*", S.SHIPMENT, "json", max_files_per_trigger=1)
    return gate.gated_silver_stream(source, f"{base}/out", f"{base}/ckpt", min_rows=1, **options)


def held(spark, base):
    return [p.rsplit("=", 1)[1] for p in glob_paths(spark, f"{base}/out_held/batch=*")]


def ids(spark, base):
    return sorted(r[0] for r in spark.read.parquet(f"{base}/out").filter("dq_flag = 'PASS'").select("shipment_id").collect())


def test_a_bad_batch_is_held_and_comes_first_next_time(spark):
    base = scratch_path(spark, "gate")
    deliver(spark, base, 0, [shipment(shipment_id=i) for i in range(5)] + [shipment(shipment_id=9, status="LOST")])
    run(spark, base)
    deliver(spark, base, 1, [shipment(shipment_id=7), shipment(shipment_id=7)])  # a duplicate
    for _ in range(2):  # it stops the stream every time
        with pytest.raises(Exception, match="QualityGateError"):
            run(spark, base)
        assert ids(spark, base) == [0, 1, 2, 3, 4] and held(spark, base) == ["1"]
    rows = spark.read.parquet(f"{base}/out_held").count()
    assert rows == 2
    run(spark, base, on_fail="warn")  # let through
    assert ids(spark, base) == [0, 1, 2, 3, 4, 7, 7] and held(spark, base) == []
    results = [json.loads(read_text(spark, p)) for p in glob_paths(spark, f"{base}/out_checks/*.json")]
    assert [sum(not r["passed"] for r in batch) for batch in results] == [0, 1]
    assert {r["check_name"] for r in results[0]} == {r["check_name"] for r in results[1]} and len(results[0]) == 9


def test_a_batch_without_a_valid_row_fails(spark):
    base = scratch_path(spark, "gate_none")
    deliver(spark, base, 0, [shipment(status="LOST")])
    with pytest.raises(Exception, match="QualityGateError"):
        run(spark, base)
    assert held(spark, base) == ["0"]


@pytest.mark.parametrize("n", [0, 1, 9, 10, 11, 57, 60])
def test_exact_batches(spark, n):
    base = scratch_path(spark, "exact")
    rows = spark.range(n).repartition(7).withColumn("x", F.lit("y"))
    rows.write.parquet(f"{base}/t")
    table = spark.read.schema(rows.schema).parquet(f"{base}/t")
    files.land_json_lines(table, f"{base}/out", 10, partition_by=None, exact=True)
    landed = spark.read.schema("id long, x string").json(f"{base}/out")
    sizes = sorted(r["count"] for r in landed.groupBy(F.input_file_name()).count().collect())
    assert sizes == sorted([10] * (n // 10) + ([n % 10] if n % 10 else []))
    assert sorted(r["id"] for r in landed.collect()) == list(range(n))


def test_bucketed_foreign_key_needs_no_shuffle(spark, sf_small):
    """The anti-join of two tables bucketed by the key: only the counts are exchanged."""
    from cargolens.operators import quality
    from cargolens.plans import fixtures
    from cargolens.plans.catalog_topics import bucketed_tables

    tables = bucketed_tables(spark, sf_small)
    for child, parent, key in (("shipments", "orders", "order_id"), ("inventory", "products", "product_id")):
        found = quality.orphan_count(tables[child], key, tables[parent], key)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan and plan.count("Exchange SinglePartition") == 1, plan
        plain = fixtures.operational_tables(spark, sf_small)
        assert found.first()["n"] == quality.orphan_count(plain[child], key, plain[parent], key).first()["n"]
