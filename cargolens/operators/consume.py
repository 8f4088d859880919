"""Consumption: dashboard tables, KPI cards, shares, top-k, the business
questions and the text report, all as DataFrames over the gold tables.

Gold tables are aggregates whose size is set by the number of carriers,
statuses, routes and products, not by the number of shipments; the few
whole-table windows below run on such aggregates only (status has at most
the seven valid values after validation).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cargolens import schemas as S
from cargolens.functions import columns as C


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


# --- display projections (PRJ11) ---------------------------------------------


def carrier_detail(carrier: DataFrame) -> DataFrame:
    return carrier.select(
        "carrier",
        "total_shipments",
        "delivered_shipments",
        "delayed_shipments",
        "delay_rate_pct",
        "avg_weight_kg",
    )


def product_detail(product: DataFrame) -> DataFrame:
    return product.select(
        "product", "total_shipments", "total_quantity", "delay_rate_pct", "avg_weight_kg"
    )


def with_route(route: DataFrame) -> DataFrame:
    return route.withColumn("route", C.route_label("origin", "destination"))


def route_detail(route: DataFrame) -> DataFrame:
    return with_route(route).select(
        "route", "total_shipments", "delayed_shipments", "delay_rate_pct", "avg_weight_kg"
    )


# --- sorts and top-k (SRT3-4, TOP1-3) ------------------------------------------


def carriers_by_rate(carrier: DataFrame) -> DataFrame:
    return carrier.select("carrier", "delay_rate_pct").orderBy(
        F.col("delay_rate_pct").asc_nulls_last(), "carrier"
    )


def carriers_by_volume(carrier: DataFrame) -> DataFrame:
    return carrier.select("carrier", "total_shipments").orderBy(
        F.col("total_shipments").desc(), "carrier"
    )


def top_products(product: DataFrame, k: int = 10) -> DataFrame:
    """orderBy + limit plans as TakeOrderedAndProject: a per-task top-k,
    then a merge of k rows per task."""
    return (
        product.select("product", "total_shipments", "delay_rate_pct")
        .orderBy(F.col("total_shipments").desc(), "product")
        .limit(k)
    )


def top_routes(route: DataFrame, k: int = 10) -> DataFrame:
    return (
        with_route(route)
        .select("route", "delay_rate_pct", "total_shipments")
        .orderBy(F.col("delay_rate_pct").desc_nulls_last(), "route")
        .limit(k)
    )


def top_delayed_routes(route: DataFrame, k: int = 5) -> DataFrame:
    """The report's "top delayed routes": an explicit sort, not stored order."""
    return (
        route.select("origin", "destination", "delay_rate_pct")
        .orderBy(F.col("delay_rate_pct").desc_nulls_last(), "origin", "destination")
        .limit(k)
    )


# --- shares and cards (AGG12-14, C3) -------------------------------------------


def status_share(status: DataFrame) -> DataFrame:
    """Each status' share of all shipments. The window spans the whole status
    table, which validation bounds to the seven valid statuses."""
    whole = Window.partitionBy()
    return status.select(
        "status",
        "total_shipments",
        (F.col("total_shipments") / F.sum("total_shipments").over(whole)).alias("share"),
    )


def kpi_cards(carrier: DataFrame) -> DataFrame:
    """Totals, the unweighted mean of the carriers' rates (1 digit, as the
    dashboard shows it), the weighted rate, and the colour band."""
    cards = carrier.agg(
        F.sum("total_shipments").alias("total_shipments"),
        F.sum("delivered_shipments").alias("total_delivered"),
        F.sum("delayed_shipments").alias("total_delayed"),
        F.round(C.exact_mean("delay_rate_pct"), 1).alias("avg_delay_rate"),
        C.rate_pct(F.sum("delayed_shipments"), F.sum("total_shipments")).alias(
            "weighted_delay_rate"
        ),
    )
    return cards.withColumn("band", C.kpi_band("avg_delay_rate"))


# --- business questions and weekly summary (AGG16, C2) -------------------------


def _answer(df: DataFrame, qid: int, key: Column, value: Column, id_col: str) -> DataFrame:
    return df.select(
        F.lit(qid).alias(id_col),
        key.cast("string").alias("answer_key" if id_col == "question_id" else "key"),
        value.cast("double").alias("answer_value" if id_col == "question_id" else "value"),
    )


def _top1(df: DataFrame, *order: Column | str) -> DataFrame:
    return df.orderBy(*order).limit(1)


def worst_carrier(carrier: DataFrame) -> DataFrame:
    return _top1(carrier, F.col("delay_rate_pct").desc_nulls_last(), "carrier")


def best_carrier(carrier: DataFrame) -> DataFrame:
    return _top1(carrier, F.col("delay_rate_pct").asc_nulls_last(), "carrier")


def worst_route(route: DataFrame) -> DataFrame:
    return _top1(with_route(route), F.col("delay_rate_pct").desc_nulls_last(), "origin", "destination")


def top_product(product: DataFrame) -> DataFrame:
    return _top1(product, F.col("total_shipments").desc(), "product")


def delivered_pct(carrier: DataFrame) -> DataFrame:
    return carrier.agg(
        C.rate_pct(F.sum("delivered_shipments"), F.sum("total_shipments")).alias("pct")
    )


def overall_delay(carrier: DataFrame) -> DataFrame:
    return carrier.agg(
        C.rate_pct(F.sum("delayed_shipments"), F.sum("total_shipments")).alias("pct")
    )


def business_questions(gold: dict[str, DataFrame]) -> DataFrame:
    """The five questions the reference asks a language model, answered
    exactly: (question_id, answer_key, answer_value)."""
    carrier, status = gold["carrier_performance"], gold["shipment_status_summary"]
    route, product = gold["route_analysis"], gold["product_summary"]
    q = "question_id"
    in_transit = status.filter(F.col("status") == F.lit(S.IN_TRANSIT)).agg(
        F.coalesce(F.sum("total_shipments"), F.lit(0)).alias("n")
    )
    return _union(
        [
            _answer(worst_carrier(carrier), 1, F.col("carrier"), F.col("delay_rate_pct"), q),
            _answer(in_transit, 2, F.lit(S.IN_TRANSIT), F.col("n"), q),
            _answer(top_product(product), 3, F.col("product"), F.col("total_shipments"), q),
            _answer(worst_route(route), 4, F.col("route"), F.col("delay_rate_pct"), q),
            _answer(delivered_pct(carrier), 5, F.lit(S.DELIVERED), F.col("pct"), q),
        ]
    )


def weekly_summary(gold: dict[str, DataFrame]) -> DataFrame:
    """Points 1-5 of the executive summary as (point, key, value); point 6
    (free-text recommendation) is prose and not computed."""
    carrier, route, product = (
        gold["carrier_performance"],
        gold["route_analysis"],
        gold["product_summary"],
    )
    p = "point"
    return _union(
        [
            _answer(overall_delay(carrier), 1, F.lit("all carriers"), F.col("pct"), p),
            _answer(best_carrier(carrier), 2, F.col("carrier"), F.col("delay_rate_pct"), p),
            _answer(worst_carrier(carrier), 3, F.col("carrier"), F.col("delay_rate_pct"), p),
            _answer(worst_route(route), 4, F.col("route"), F.col("delay_rate_pct"), p),
            _answer(top_product(product), 5, F.col("product"), F.col("total_shipments"), p),
        ]
    )


# --- text report (C1) -----------------------------------------------------------

def _section(df: DataFrame, section: int, k1: Column, k2: Column, k3: Column, lines: list[Column]) -> DataFrame:
    """One section's lines with a common sort key: k1 descending (nulls last),
    then k2, k3 ascending, then the line's place in its row."""
    return df.select(
        F.lit(section).alias("section_no"),
        k1.cast("double").alias("k1"),
        k2.cast("string").alias("k2"),
        k3.cast("string").alias("k3"),
        F.posexplode(F.array(*lines)).alias("sub", "line"),
    )


def _num(c: str) -> Column:
    return F.col(c).cast("string")


def kpi_report(gold: dict[str, DataFrame]) -> DataFrame:
    """Text context: a block per carrier, a line per status, the top five
    routes and a line per product, each under its heading line, in fixed order.
    Columns: section_no, k1, k2, k3, sub, line.

    Lines carry their sort key instead of a number: the writer's range sort
    puts them in order, and no section has to pass through one task."""
    carrier, status = gold["carrier_performance"], gold["shipment_status_summary"]
    route, product = gold["route_analysis"], gold["product_summary"]
    no_key = F.lit(None).cast("string")
    values = [
        F.col("carrier"),
        _num("total_shipments"),
        _num("delayed_shipments"),
        _num("delivered_shipments"),
        _num("delay_rate_pct"),
        F.round("avg_weight_kg", 2).cast("string"),
    ]
    carrier_lines = [F.format_string(t, v) for t, v in zip(S.REPORT_CARRIER_LINES, values, strict=True)]
    spark = carrier.sparkSession
    heads = [(i, float("inf"), None, None, -1, h) for i, h in enumerate(S.REPORT_SECTIONS, start=1)]
    headings = spark.createDataFrame(heads, "section_no INT, k1 DOUBLE, k2 STRING, k3 STRING, sub INT, line STRING")
    routes = F.format_string(
        S.REPORT_ROUTE_LINE, F.col("origin"), F.lit(S.ROUTE_SEPARATOR), F.col("destination"), _num("delay_rate_pct")
    )
    statuses = F.format_string(S.REPORT_STATUS_LINE, F.col("status"), _num("total_shipments"))
    products = F.format_string(
        S.REPORT_PRODUCT_LINE, F.col("product"), _num("total_shipments"), _num("delay_rate_pct")
    )
    return _union(
        [
            headings,
            _section(carrier, 1, F.col("delay_rate_pct"), F.col("carrier"), no_key, carrier_lines),
            _section(status, 2, F.col("total_shipments"), F.col("status"), no_key, [statuses]),
            _section(
                top_delayed_routes(route), 3, F.col("delay_rate_pct"), F.col("origin"), F.col("destination"), [routes]
            ),
            _section(product, 4, F.col("total_shipments"), F.col("product"), no_key, [products]),
        ]
    )


def card_labels(cards: DataFrame) -> DataFrame:
    """Display text of the KPI cards: counts with thousands separators, the
    average rate with its percent sign (PRJ14)."""
    return cards.select(
        F.format_number("total_shipments", 0).alias("total_shipments"),
        F.format_number("total_delivered", 0).alias("total_delivered"),
        F.format_number("total_delayed", 0).alias("total_delayed"),
        F.format_string("%s%%", F.col("avg_delay_rate").cast("string")).alias("avg_delay_rate"),
        "band",
    )
