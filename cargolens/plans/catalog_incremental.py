"""Queries of the incremental runs: every one lands the fixture in three
deliveries (two days, then more of the first day) and runs after each."""

from __future__ import annotations

from pyspark.sql import functions as F

from cargolens import session as SS
from cargolens.operators import partials
from cargolens.plans import fixtures, incremental
from cargolens.plans.catalog import register
from cargolens.plans.catalog_more import DAYS, gold_values, run_ts
from cargolens.sinks import files
from cargolens.sources import tables

#: (landing, day, rest of shipment_id by 3): the third delivery is late for the first day.
DELIVERIES = (("a", DAYS[0], 1), ("b", DAYS[1], 0), ("c", DAYS[0], 2))


def _deliver(spark, sf_dir, root):
    """Land one delivery after the other; yields after each. The fixture is
    assembled once."""
    raw = fixtures.stored_shipments(spark, sf_dir, f"{root}_shipments")
    for landing, day, rest in DELIVERIES:
        part = raw.filter(F.col("shipment_id") % 3 == rest).withColumn("ingest_date", F.lit(day))
        files.land_json_lines(part, root, landing=landing)
        yield landing


@register("silver_incremental")
def q_silver_incremental(spark, sf_dir):
    """What each run read: the new landing only, and nothing in a run without
    one; then what silver holds."""
    base = SS.scratch_path(spark, "silver_incremental")
    read = []

    def run(place):
        counts = incremental.run_silver(spark, f"{base}/bronze", f"{base}/lake", run_ts())
        read.extend([(place, "PASS", counts["pass"]), (place, "FAIL", counts["fail"]), (place, "landings", len(counts["landings"]))])

    for landing in _deliver(spark, sf_dir, f"{base}/bronze"):
        run(f"run {landing}")
    run("run without new landings")
    stored = tables.read_layer_table(spark, f"{base}/lake", "shipments")
    day = F.col("ingest_date").cast("string").alias("place")
    held = stored.groupBy(day, "dq_flag").agg(F.count("*").alias("n"))
    return held.unionByName(spark.createDataFrame(read, "place string, dq_flag string, n bigint"))


@register("gold_incremental")
def q_gold_incremental(spark, sf_dir):
    """The stored gold values after three incremental runs: those of one full
    run over all deliveries."""
    base = SS.scratch_path(spark, "gold_incremental")
    for _ in _deliver(spark, sf_dir, f"{base}/bronze"):
        incremental.run_incremental(spark, f"{base}/bronze", f"{base}/lake", run_ts())
    return gold_values(tables.read_gold(spark, f"{base}/lake"))


@register("checks_incremental")
def q_checks_incremental(spark, sf_dir):
    """The nine checks merged from stored day partials, duplicates across days
    included (an id is on one day only here, its copies on the same)."""
    base = SS.scratch_path(spark, "checks_incremental")
    for _ in _deliver(spark, sf_dir, f"{base}/bronze"):
        incremental.run_silver(spark, f"{base}/bronze", f"{base}/lake", run_ts())
        incremental.refresh_partials(spark, f"{base}/lake")
    stored = {name: incremental.read_partials(spark, f"{base}/lake", name) for name in ("checks", "shipment_ids")}
    return partials.merged_checks(stored["checks"], stored["shipment_ids"])


@register("distinct_orders_by_day")
def q_distinct_orders_by_day(spark, sf_dir):
    """Distinct orders of each carrier, over all days, from bitmaps by ship
    day and carrier merged at the end (AGG8)."""
    rows = fixtures.raw_shipments(spark, sf_dir).withColumn("month", F.substring("shipped_at", 1, 7))
    bitmaps = partials.id_bitmaps(rows, "order_id", ["month", "carrier"])
    return partials.distinct_counts(bitmaps, ["carrier"], "orders")
