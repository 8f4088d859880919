"""Stored partial aggregates by ingest day, and the gold and check tables merged
from them (AGG1-AGG8, Q1).

A day's partials are a few rows per carrier, status, route and product; what is
merged over all days grows with the days and keys, never with the shipments. A
rerun day replaces its own partials, the others are read as they are.

Counts and sums merge by adding. Means are kept as their exact and small parts
(``columns.mean_parts``), so the merged mean is that of one pass. Distinct
counts are kept as bitmaps: an id is one bit of the bucket that it falls into,
days merge by OR, and the bits are counted at the end. That is exact for every
long, negative ids and nulls included. A bucket has 32,768 bits (4 kB before
compression), so bitmaps suit ids that are numbered through, as order and
shipment ids are; ids strewn over the whole range of a long cost a bucket each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens import schemas as S
from cargolens.functions import columns as C
from cargolens.operators import gold, quality

DAY = "ingest_date"


# --- distinct counts ---------------------------------------------------------


def id_bitmaps(df: DataFrame, key: str, by: list[str]) -> DataFrame:
    """(by, bucket, ids): the ids of every group as bitmaps, one row a bucket.

    Tasks build the bitmaps of their rows first, so a hot id or group costs one
    row a task and bucket."""
    k = F.col(key).cast("bigint")
    rows = df.filter(k.isNotNull())
    return rows.groupBy(*by, F.bitmap_bucket_number(k).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(k)).alias("ids")
    )


def distinct_counts(bitmaps: DataFrame, by: list[str], name: str) -> DataFrame:
    """(by, name): distinct ids of every group over all bitmaps of it."""
    merged = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("ids").alias("ids"))
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count("ids")).alias(name))


# --- KPIs --------------------------------------------------------------------


def kpi_partials(silver: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The four KPI groupings of each day in one aggregate, mergeable (``by=[]``:
    of the whole table)."""
    by = [DAY] if by is None else by
    sets = [[F.col(c) for c in [*by, *keys]] for keys in gold.KPI_SETS.values()]
    exact, rest, n = C.mean_parts("weight_kg")
    grouped = silver.groupingSets(sets, *[F.col(c) for c in [*by, *gold.KPI_KEYS]])
    return grouped.agg(
        F.grouping_id().alias("grouping"),
        F.count("shipment_id").alias("total"),
        F.count_if(F.col("is_delayed")).alias("delayed"),
        F.count_if(F.col("is_delivered")).alias("delivered"),
        F.sum("quantity").alias("quantity"),
        F.sum(exact).alias("weight_exact"),
        F.sum(rest).alias("weight_rest"),
        F.count(n).alias("weights"),
    )


def merged_gold(kpis: DataFrame, orders: DataFrame, run_ts: Column | None = None) -> dict[str, DataFrame]:
    """The four gold tables from all partials and (status, unique_orders), as
    ``gold.gold_tables``."""

    def of(name: str, *more: Column) -> DataFrame:
        rows = kpis.filter(F.col("grouping") == F.lit(gold.grouping_of(gold.KPI_SETS[name])))
        total, delayed = F.sum("total"), F.sum("delayed")
        mean = C.mean_of_parts(F.sum("weight_exact"), F.sum("weight_rest"), F.sum("weights"))
        measures = {
            "total_shipments": total,
            "delayed_shipments": delayed,
            "delivered_shipments": F.sum("delivered"),
            "total_quantity": F.sum("quantity"),
            "avg_weight_kg": mean,
            "delay_rate_pct": C.rate_pct(delayed, total),
        }
        keys = gold.KPI_SETS[name]
        wanted = [c for c in gold.KPI_COLUMNS[name] if c not in keys]
        return rows.groupBy(*keys).agg(*[measures[c].alias(c) for c in wanted]).select(*gold.KPI_COLUMNS[name])

    out = {name: of(name) for name in gold.KPI_SETS}
    # both sides are one row per status: added side by side, not joined
    status = out["shipment_status_summary"].select("status", "total_shipments", F.lit(0).cast("bigint").alias("unique_orders"))
    orders = orders.select("status", F.lit(0).cast("bigint").alias("total_shipments"), "unique_orders")
    both = status.unionByName(orders).groupBy("status")
    out["shipment_status_summary"] = both.agg(F.sum("total_shipments").alias("total_shipments"), F.sum("unique_orders").alias("unique_orders"))
    return {name: gold.in_gold_order(name, gold.stamped(df, run_ts)) for name, df in out.items()}


# --- checks --------------------------------------------------------------------


def check_partials(silver: DataFrame) -> DataFrame:
    """The counts behind the nine checks, one row a day, without distinct ids."""
    return silver.groupBy(DAY).agg(*quality.check_stats())


def merged_checks(stats: DataFrame, shipment_ids: DataFrame, min_rows: int = S.MIN_ROW_COUNT) -> DataFrame:
    """The nine checks over all days, as ``quality.silver_checks``."""
    least, seen_null = {"min_weight"}, {"null_id"}
    sums = [c for c in quality.CHECK_STATS if c not in least | seen_null]
    whole = stats.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums],
        F.min("min_weight").alias("min_weight"),
        F.coalesce(F.max("null_id"), F.lit(0)).alias("null_id"),
    )
    ids = distinct_counts(shipment_ids, [], "distinct_ids")
    # two one-row tables side by side
    both = whole.unionByName(ids, allowMissingColumns=True)
    both = both.agg(*[F.max(c).alias(c) for c in both.columns]).fillna(0, ["distinct_ids"])
    return quality.check_rows(both, min_rows)


# --- what is stored -----------------------------------------------------------------


def partials_of(silver: DataFrame) -> dict[str, DataFrame]:
    """All partial tables of some days of silver, by name."""
    return {
        "kpi": kpi_partials(silver),
        "order_ids": id_bitmaps(silver, "order_id", [DAY, "status"]),
        "checks": check_partials(silver),
        "shipment_ids": id_bitmaps(silver, "shipment_id", [DAY]),
    }
