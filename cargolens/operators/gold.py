"""Silver -> gold: the four KPI tables.

Each is one hash aggregate: a partial aggregate per task (map-side combine,
so a hot carrier or route collapses to one row per task before the shuffle),
an exchange on the group key, a final aggregate. The repeated conditional
count is written once and reused; Catalyst would merge it anyway.

Average weights use ``exact_mean`` (decimal sum), so they do not drift with
partitioning; ``avg_digits`` optionally rounds them for display. ``run_ts`` adds processed_at; None leaves it out.
Sorts carry a key tie-break so the stored order is deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens.functions import columns as C
from cargolens.session import ensure_checkpoint_dir


def stamped(df: DataFrame, run_ts: Column | None) -> DataFrame:
    return df if run_ts is None else df.withColumn("processed_at", run_ts)


def in_gold_order(name: str, df: DataFrame) -> DataFrame:
    """A gold table in its stored order (SRT1, SRT2)."""
    first = "total_shipments" if name in ("shipment_status_summary", "product_summary") else "delay_rate_pct"
    return df.orderBy(F.col(first).desc_nulls_last(), *[F.col(k) for k in KPI_SETS[name]])


def carrier_performance(
    silver: DataFrame, avg_digits: int | None = None, run_ts: Column | None = None
) -> DataFrame:
    total = F.count("shipment_id")
    delayed = F.count_if(F.col("is_delayed"))
    out = silver.groupBy("carrier").agg(
        total.alias("total_shipments"),
        delayed.alias("delayed_shipments"),
        F.count_if(F.col("is_delivered")).alias("delivered_shipments"),
        C.round_avg(C.exact_mean("weight_kg"), avg_digits).alias("avg_weight_kg"),
        C.rate_pct(delayed, total).alias("delay_rate_pct"),
    )
    return stamped(out, run_ts).orderBy(F.col("delay_rate_pct").desc_nulls_last(), F.col("carrier"))


def shipment_status_summary(silver: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """count and exact distinct orders per status. One distinct column, so
    Spark plans it without Expand: (status, order_id) is de-duplicated
    map-side first, which also absorbs hot orders."""
    out = silver.groupBy("status").agg(
        F.count("shipment_id").alias("total_shipments"),
        F.count_distinct("order_id").alias("unique_orders"),
    )
    return stamped(out, run_ts).orderBy(F.col("total_shipments").desc(), F.col("status"))


def route_analysis(
    silver: DataFrame, avg_digits: int | None = None, run_ts: Column | None = None
) -> DataFrame:
    total = F.count("shipment_id")
    delayed = F.count_if(F.col("is_delayed"))
    out = silver.groupBy("origin", "destination").agg(
        total.alias("total_shipments"),
        delayed.alias("delayed_shipments"),
        C.rate_pct(delayed, total).alias("delay_rate_pct"),
        C.round_avg(C.exact_mean("weight_kg"), avg_digits).alias("avg_weight_kg"),
    )
    return stamped(out, run_ts).orderBy(
        F.col("delay_rate_pct").desc_nulls_last(), F.col("origin"), F.col("destination")
    )


def product_summary(
    silver: DataFrame, avg_digits: int | None = None, run_ts: Column | None = None
) -> DataFrame:
    total = F.count("shipment_id")
    delayed = F.count_if(F.col("is_delayed"))
    out = silver.groupBy("product").agg(
        total.alias("total_shipments"),
        F.sum("quantity").alias("total_quantity"),
        delayed.alias("delayed_shipments"),
        C.rate_pct(delayed, total).alias("delay_rate_pct"),
        C.round_avg(C.exact_mean("weight_kg"), avg_digits).alias("avg_weight_kg"),
    )
    return stamped(out, run_ts).orderBy(F.col("total_shipments").desc(), F.col("product"))


GOLD_TABLES = {
    "carrier_performance": carrier_performance,
    "shipment_status_summary": shipment_status_summary,
    "route_analysis": route_analysis,
    "product_summary": product_summary,
}


def gold_tables(silver: DataFrame, avg_digits: int | None = None, run_ts: Column | None = None):
    return {
        "carrier_performance": carrier_performance(silver, avg_digits, run_ts),
        "shipment_status_summary": shipment_status_summary(silver, run_ts),
        "route_analysis": route_analysis(silver, avg_digits, run_ts),
        "product_summary": product_summary(silver, avg_digits, run_ts),
    }


# Grouping sets of the one-pass KPI aggregate, with their grouping_id values
# (a bit is set for each key column *not* in the set; key order below).
KPI_KEYS = ["carrier", "status", "origin", "destination", "product"]
KPI_SETS = {
    "carrier_performance": ["carrier"],
    "shipment_status_summary": ["status"],
    "route_analysis": ["origin", "destination"],
    "product_summary": ["product"],
}


def grouping_of(keys: list[str]) -> int:
    n = len(KPI_KEYS)
    return sum(1 << (n - 1 - i) for i, k in enumerate(KPI_KEYS) if k not in keys)


def kpi_cube(silver: DataFrame, avg_digits: int | None = None) -> DataFrame:
    """All four KPI groupings in ONE aggregate over silver (GROUPING SETS):
    one scan, one partial aggregate per task, one shuffle. ``_gid`` tells the
    grouping of each row. The status grouping carries no distinct order
    count (that needs its own distinct aggregate; see
    ``shipment_status_summary``)."""
    total = F.count("shipment_id")
    delayed = F.count_if(F.col("is_delayed"))
    return silver.groupingSets(
        [[F.col(k) for k in keys] for keys in KPI_SETS.values()], *[F.col(k) for k in KPI_KEYS]
    ).agg(
        F.grouping_id().alias("_gid"),
        total.alias("total_shipments"),
        delayed.alias("delayed_shipments"),
        F.count_if(F.col("is_delivered")).alias("delivered_shipments"),
        F.sum("quantity").alias("total_quantity"),
        C.round_avg(C.exact_mean("weight_kg"), avg_digits).alias("avg_weight_kg"),
        C.rate_pct(delayed, total).alias("delay_rate_pct"),
    )


KPI_COLUMNS = {
    "carrier_performance": ["carrier", "total_shipments", "delayed_shipments", "delivered_shipments",
                            "avg_weight_kg", "delay_rate_pct"],
    "shipment_status_summary": ["status", "total_shipments"],
    "route_analysis": ["origin", "destination", "total_shipments", "delayed_shipments",
                       "delay_rate_pct", "avg_weight_kg"],
    "product_summary": ["product", "total_shipments", "total_quantity", "delayed_shipments",
                        "delay_rate_pct", "avg_weight_kg"],
}


def split_kpis(cube: DataFrame) -> dict[str, DataFrame]:
    """The four KPI tables out of a (materialised) ``kpi_cube``."""
    return {
        name: cube.filter(F.col("_gid") == F.lit(grouping_of(keys))).select(*KPI_COLUMNS[name])
        for name, keys in KPI_SETS.items()
    }


def kpi_tables(silver: DataFrame, avg_digits: int | None = None, materialize: bool = True) -> dict[str, DataFrame]:
    """All four KPI tables for consumers that read several in one plan.

    The cube is checkpointed (eagerly, into the shared checkpoint folder):
    otherwise each consumer branch would push its own filter and column
    pruning below the aggregate and rebuild silver once per branch. The cube
    holds one row per carrier, status, route and product, so the checkpoint
    is small, and it also cuts the lineage a retry would have to replay."""
    cube = kpi_cube(silver, avg_digits)
    if materialize:
        ensure_checkpoint_dir(silver.sparkSession)
        cube = cube.checkpoint(eager=True)
    return split_kpis(cube)
