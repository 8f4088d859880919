"""Plan shape: pruning, pushdown, partial aggregation, no Python in the hot
path, no cartesian products."""

import contextlib
import io

import pytest

from cargolens.plans.catalog import registry

# Queries whose DataFrame is built by running writes first (I/O, streams).
IO_QUERIES = {
    "arrays_one_day",
    "bronze_by_date",
    "bronze_scan",
    "bronze_inventory",
    "gold_order",
    "kpi_report",
    "landing_malformed",
    "landing_two_runs",
    "medallion_run",
    "silver_two_days",
    "stream_dedup_outputs",
    "stream_quarantine",
    "stream_source",
    "stream_landing",
    "stream_restart",
    "stream_silver",
    "stream_dedup",
    "stream_messages",
}
FORBIDDEN = [
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "BatchEvalPython",
    "ArrowEvalPython",
    "FlatMapGroupsInPandas",
    "MapInPandas",
]


def _plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(set(registry()) - IO_QUERIES))
def test_no_cartesian_and_no_python(spark, sf_small, name):
    plan = _plan(registry()[name](spark, sf_small))
    for node in FORBIDDEN:
        assert node not in plan, (name, node)


@pytest.mark.parametrize("name", sorted(IO_QUERIES))
def test_io_queries_read_back_without_cartesian_products(spark, sf_small, name):
    """What an I/O query returns is a plain read of what it wrote."""
    plan = _plan(registry()[name](spark, sf_small))
    for node in FORBIDDEN:
        assert node not in plan, (name, node)


def test_fixture_scans_are_pruned(spark, sf_small):
    text = _plan(registry()["carrier_performance"](spark, sf_small))
    # lineitem is read with only the columns this KPI needs (even the ship
    # date is pruned: the carrier scorecard never looks at it)
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int," \
        "l_quantity:double>" in text
    for unused in ("l_extendedprice", "l_discount", "l_tax", "l_returnflag", "c_acctbal", "p_name"):
        assert unused not in text


def test_kpi_aggregates_are_two_phase(spark, sf_small):
    df = registry()["carrier_performance"](spark, sf_small)
    text = _plan(df)
    assert "partial_count" in text and "HashAggregate" in text


def test_silver_read_prunes_partitions(spark, sf_small):
    from cargolens.operators import silver
    from cargolens.plans import fixtures
    from cargolens.session import scratch_path
    from cargolens.sinks import files
    from cargolens.sources import tables

    root = scratch_path(spark, "silver_pruning")
    files.write_flagged(silver.flagged(fixtures.raw_shipments(spark, sf_small)), root)
    text = _plan(tables.read_silver(spark, root).select("carrier"))
    assert "PartitionFilters: [isnotnull(dq_flag" in text and "PASS" in text


def test_null_check_is_pushed_to_the_scan(spark, sf_small):
    from pyspark.sql import functions as F

    df = spark.read.parquet(f"{sf_small}/lineitem.parquet").filter(F.col("l_shipdate").isNull())
    assert "PushedFilters: [IsNull(l_shipdate)]" in _plan(df)
