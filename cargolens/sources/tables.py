"""Table scans addressed by root folder and name (SRC4, SRC5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

GOLD_TABLES = ["carrier_performance", "shipment_status_summary", "route_analysis", "product_summary"]


def table_path(root: str, name: str) -> str:
    root = root.rstrip("/")
    return f"{root}/{name}.parquet"


def read_table(spark: SparkSession, root: str, name: str, fmt: str = "parquet") -> DataFrame:
    """Scan one table. Parquet by default; ``fmt="delta"`` when the Delta
    jars are on the classpath (they are optional, not required)."""
    if fmt == "parquet":
        path = table_path(root, name)
        return spark.read.parquet(path)
    return spark.read.format(fmt).load(f"{root.rstrip('/')}/{name}")


def read_layer_table(spark: SparkSession, root: str, name: str, fmt: str = "parquet") -> DataFrame:
    """Scan a silver/gold table written by the sinks (a folder per table)."""
    return spark.read.format(fmt).load(f"{root.rstrip('/')}/{name}")


def read_silver(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    """Silver = the PASS partition of the flagged shipments table; the filter
    on the partition column prunes the FAIL folder before any file is read."""
    from pyspark.sql import functions as F

    return read_layer_table(spark, root, "shipments", fmt).filter(F.col("dq_flag") == F.lit("PASS"))


def read_gold(spark: SparkSession, root: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """The stored gold tables by name, for the consumers."""
    return {name: read_layer_table(spark, root, name, fmt) for name in GOLD_TABLES}


def read_quarantine(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    from pyspark.sql import functions as F

    return read_layer_table(spark, root, "shipments", fmt).filter(F.col("dq_flag") == F.lit("FAIL"))
