"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query starts from the driver's star tables (through the fixture plan),
so its work grows with the scale factor. Oracle texts live in
``cargolens.plans.oracle_sql``; rows-only queries have none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cargolens import schemas as S
from cargolens.operators import gold, silver
from cargolens.plans import fixtures

AVG_DIGITS = None  # exact means need no rounding to compare
Query = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        _REGISTRY[name] = fn
        return fn

    return deco


def registry() -> dict[str, Query]:
    # Import the modules that register more queries.
    from cargolens.plans import catalog_incremental, catalog_more, catalog_topics  # noqa: F401

    return dict(_REGISTRY)


# --- shared building blocks ------------------------------------------------


def flagged_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.flagged(fixtures.raw_shipments(spark, sf_dir))


def silver_shipments_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.passed(flagged_shipments(spark, sf_dir))


SILVER_OUT = (
    S.SHIPMENT_COLUMNS
    + ["is_valid_status", "is_valid_weight", "has_origin", "has_destination", "dq_flag"]
    + S.BUSINESS_COLUMNS
)


# --- milestone 1: fixture, silver rules, flagship KPI -------------------------


@register("raw_shipments")
def q_raw_shipments(spark, sf_dir):
    return fixtures.raw_shipments(spark, sf_dir)


@register("normalize_shipments")
def q_normalize_shipments(spark, sf_dir):
    return silver.normalize(fixtures.raw_shipments(spark, sf_dir))


@register("validate_shipments")
def q_validate_shipments(spark, sf_dir):
    return silver.clean_and_validate(fixtures.raw_shipments(spark, sf_dir)).select(
        "shipment_id", "is_valid_status", "is_valid_weight", "has_origin", "has_destination", "dq_flag"
    )


@register("silver_shipments")
def q_silver_shipments(spark, sf_dir):
    return silver_shipments_df(spark, sf_dir).select(*SILVER_OUT)


@register("carrier_performance")
def q_carrier_performance(spark, sf_dir):
    return gold.carrier_performance(silver_shipments_df(spark, sf_dir), AVG_DIGITS)


# --- milestone 2: other KPIs, flag and category counts -----------------------


@register("shipment_status_summary")
def q_shipment_status_summary(spark, sf_dir):
    return gold.shipment_status_summary(silver_shipments_df(spark, sf_dir))


@register("route_analysis")
def q_route_analysis(spark, sf_dir):
    return gold.route_analysis(silver_shipments_df(spark, sf_dir), AVG_DIGITS)


@register("product_summary")
def q_product_summary(spark, sf_dir):
    return gold.product_summary(silver_shipments_df(spark, sf_dir), AVG_DIGITS)


@register("dq_flag_counts")
def q_dq_flag_counts(spark, sf_dir):
    return silver.dq_flag_counts(flagged_shipments(spark, sf_dir))


@register("weight_category_counts")
def q_weight_category_counts(spark, sf_dir):
    return silver.weight_category_counts(silver_shipments_df(spark, sf_dir))


@register("silver_row_count")
def q_silver_row_count(spark, sf_dir):
    return silver.row_count(silver_shipments_df(spark, sf_dir))


@register("quarantine_reasons")
def q_quarantine_reasons(spark, sf_dir):
    return silver.quarantine_reason_counts(flagged_shipments(spark, sf_dir))
