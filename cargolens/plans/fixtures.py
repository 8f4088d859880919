"""Shipment-shaped inputs derived from the driver's star tables (JOI2).

The star tables hold no shipments, so a shipment stream is assembled from
``lineitem`` and its dimensions, with faults planted by key arithmetic (bad
statuses, blank or missing places, padded carrier names, zero weights).

Join plan: only the needed columns are read (column pruning reaches the
parquet scan). ``nation`` is tiny and reaches the build side of a broadcast
hash join through the planner's size check (``autoBroadcastJoinThreshold``);
every other dimension grows with the scale factor and is joined by whatever
AQE picks from runtime sizes: broadcast while small, sort-merge beyond it.
Dimensions are reduced to (key, attribute) before they meet ``lineitem`` so
each shuffle moves narrow rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolens import schemas as S
from cargolens.functions.columns import iso_text
from cargolens.sources.tables import read_table

# Fixed fixture values: carrier by l_suppkey % 5 and status by
# (l_orderkey + l_linenumber) % 7, in this order.
FIXTURE_CARRIERS = ["FedEx", "DHL", " Blue Dart ", "DTDC", "Delhivery"]
FIXTURE_STATUS_CYCLE = S.VALID_STATUSES


def _pick(index: F.Column, values: list[str]) -> F.Column:
    expr = F.when(index == F.lit(0), F.lit(values[0]))
    for i, value in enumerate(values[1:], start=1):
        expr = expr.when(index == F.lit(i), F.lit(value))
    return expr


def shipment_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem joined to its order's customer nation, its supplier nation
    and its part: one row per line, narrow columns only."""
    lineitem = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate"
    )
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")

    customer_nation = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        "c_custkey", F.col("n_name").alias("dest_nation")
    )
    order_dest = orders.join(customer_nation, orders.o_custkey == customer_nation.c_custkey).select(
        "o_orderkey", "dest_nation"
    )
    supplier_origin = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        "s_suppkey", F.col("n_name").alias("origin_nation")
    )
    return (
        lineitem.join(order_dest, lineitem.l_orderkey == order_dest.o_orderkey)
        .join(supplier_origin, lineitem.l_suppkey == supplier_origin.s_suppkey)
        .join(part, lineitem.l_partkey == part.p_partkey)
    )


def raw_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-like shipment events (13 fields, timestamps as ISO text)."""
    lines = shipment_lines(spark, sf_dir)
    ok, pk, lnum, sk = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey"))
    cycle_status = _pick((ok + lnum) % 7, FIXTURE_STATUS_CYCLE)
    status = (
        F.when(pk % 211 == 0, F.lit(None).cast("string"))
        .when(pk % 101 == 0, F.lit("LOST"))
        .when(pk % 13 == 0, F.lit(" delivered "))
        .otherwise(cycle_status)
    )
    origin = (
        F.when(pk % 97 == 0, F.lit(None).cast("string"))
        .when(pk % 83 == 0, F.lit("  "))
        .otherwise(F.col("origin_nation"))
    )
    destination = F.when(pk % 89 == 0, F.lit(None).cast("string")).otherwise(F.col("dest_nation"))
    shipped_at = iso_text(F.col("l_shipdate"))
    delivered_at = F.when(
        status == F.lit(S.DELIVERED),
        iso_text(F.timestamp_add("DAY", (F.lit(1) + ok % 7).cast("int"), F.col("l_shipdate"))),
    )
    return lines.select(
        (ok * 10 + lnum).alias("shipment_id"),
        ok.alias("order_id"),
        F.col("p_type").alias("product"),
        _pick(sk % 5, FIXTURE_CARRIERS).alias("carrier"),
        F.concat(F.lit("TRK"), (F.lit(100000) + (ok * 7 + lnum) % 900000).cast("string")).alias(
            "tracking_number"
        ),
        status.alias("status"),
        origin.alias("origin"),
        destination.alias("destination"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        (F.col("l_quantity") * F.col("p_size") / F.lit(50.0) - F.lit(0.02)).alias("weight_kg"),
        shipped_at.alias("shipped_at"),
        delivered_at.alias("delivered_at"),
        shipped_at.alias("event_timestamp"),
    )


def stored_shipments(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    """The same events, assembled once and stored as a table: for queries that
    read them several times."""
    raw_shipments(spark, sf_dir).write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


# ---------------------------------------------------------------------------
# Operational tables as stored (raw types), with a violation of every declared
# constraint planted by key arithmetic.
# ---------------------------------------------------------------------------


def _planted(key: F.Column, step: int, place: int) -> F.Column:
    return key % step == place


def _too_long(value: F.Column, key: F.Column, step: int, place: int, limit: int) -> F.Column:
    """The value, or ``limit`` + 1 letters at the planted keys."""
    return F.when(_planted(key, step, place), F.lit("x" * (limit + 1))).otherwise(value)


def _with_copies(df: DataFrame, key: str, step: int, place: int) -> DataFrame:
    """The rows, those at the planted keys twice."""
    return df.unionByName(df.filter(_planted(F.col(key), step, place)))


def oltp_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = read_table(spark, sf_dir, "supplier")
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    k = F.col("s_suppkey")
    name = F.when(_planted(k, 50, 7), F.lit(None).cast("string")).otherwise(F.col("s_name"))
    email = F.concat(F.lit("s"), k.cast("string"), F.lit("@example.com"))
    rows = (
        supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(
            k.alias("supplier_id"),
            _too_long(name, k, 50, 8, 100).alias("supplier_name"),
            _too_long(F.col("n_name"), k, 50, 9, 50).alias("country"),
            _too_long(F.col("r_name"), k, 50, 10, 50).alias("region"),
            _too_long(email, k, 50, 11, 100).alias("contact_email"),
            (F.col("s_acctbal") / F.lit(900.0)).cast("string").alias("rating"),
            (F.col("s_acctbal") > 0).alias("is_active"),
        )
    )
    return _with_copies(rows, "supplier_id", 50, 12)


def oltp_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    name = F.when(_planted(k, 500, 3), F.lit(None).cast("string")).otherwise(F.col("p_name"))
    rows = part.select(
        k.alias("product_id"),
        _too_long(name, k, 500, 4, 100).alias("product_name"),
        _too_long(F.col("p_type"), k, 500, 5, 50).alias("category"),
        F.when(_planted(k, 500, 6), F.lit(123456789012.5)).otherwise(F.col("p_retailprice")).alias("unit_price"),
        F.when(k % 40 == 0, F.lit(None).cast("bigint")).otherwise(k % 105).alias("supplier_id"),
    )
    return _with_copies(rows, "product_id", 500, 7)


def oltp_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    rows = part.select(
        k.alias("inventory_id"),
        (k + 5).alias("product_id"),
        _too_long(F.concat(F.lit("WH-"), F.col("p_brand")), k, 500, 4, 20).alias("warehouse_id"),
        F.when(~_planted(k, 500, 3), F.col("p_size") * 20).alias("quantity"),
        F.when(k % 10 == 0, F.lit(None).cast("int")).otherwise(F.lit(100)).alias("reorder_level"),
    )
    return _with_copies(rows, "inventory_id", 500, 7)


def oltp_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    rows = orders.select(
        k.alias("order_id"),
        (k % 2003).alias("product_id"),
        (F.col("o_custkey") % 101).alias("supplier_id"),
        F.when(~_planted(k, 500, 3), F.lit(1) + k % 100).alias("quantity"),
        _too_long(F.col("o_orderstatus"), k, 500, 4, 20).alias("order_status"),
        F.col("o_orderdate").alias("order_date"),
        F.date_add(F.col("o_orderdate").cast("date"), 7).alias("expected_delivery"),
    )
    return _with_copies(rows, "order_id", 500, 7)


def oltp_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_shipments(spark, sf_dir)
    k = F.col("shipment_id")
    return raw.select(
        # past the INTEGER range at the planted keys
        F.when(_planted(k, 5000, 11), k + F.lit(3_000_000_000)).otherwise(k).alias("shipment_id"),
        F.when(_planted(k, 5000, 12), -F.col("order_id")).otherwise(F.col("order_id")).alias("order_id"),
        _too_long(F.col("carrier"), k, 5000, 13, 50).alias("carrier"),
        _too_long(F.col("tracking_number"), k, 5000, 14, 100).alias("tracking_number"),
        _too_long(F.col("status"), k, 5000, 15, 20).alias("status"),
        _too_long(F.col("origin"), k, 5000, 16, 100).alias("origin"),
        _too_long(F.col("destination"), k, 5000, 17, 100).alias("destination"),
        F.when(_planted(k, 5000, 21), F.lit("soon")).otherwise(F.col("shipped_at")).alias("shipped_at"),
        "delivered_at",
    )


def operational_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "suppliers": oltp_suppliers(spark, sf_dir),
        "products": oltp_products(spark, sf_dir),
        "inventory": oltp_inventory(spark, sf_dir),
        "orders": oltp_orders(spark, sf_dir),
        "shipments": oltp_shipments(spark, sf_dir),
    }
