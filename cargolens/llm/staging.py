"""Written intermediate tables in the cluster's shared folder.

An operator that reads an intermediate result more than once writes it here
and reads it back, so a lost executor costs a re-read and never a recompute
of the whole lineage.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cargolens.session import scratch_path

#: White space as the operators' word rules know it.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\f\r"


def staged(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and return it reread."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not use (Spark ignores case)."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``docs`` written with a row number that stays the same in every later
    read, and that number's column: repeated rows can be told apart."""
    row = fresh(docs, "_row")
    return staged(docs.withColumn(row, F.monotonically_increasing_id()), name, "zstd"), row


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``idx``, the place (from 0) among the rows of the same
    group, and ``total``, the rows of the group.

    A range sort puts every group into consecutive ranges; a row's place is
    its distance from the group's first row in the range plus the group's rows
    in earlier ranges. Only counts per group and range are brought together.
    """
    keys = [F.col(group).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order]]
    part, place = F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_place")
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("*", part, place)
    ranged = staged(ranged, "ranged")
    own = Window.partitionBy(group)
    earlier = own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy(group, "_part").agg(F.count("*").alias("n"), F.min("_place").alias("first"))
    counts = counts.select(
        F.col(group).alias("_group"),
        F.col("_part").alias("_range"),
        (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(own).alias("total"),
    )
    same = (F.col("_part") == F.col("_range")) & F.col(group).eqNullSafe(F.col("_group"))
    placed = ranged.join(counts, same).withColumn("idx", F.col("_place") + F.col("shift"))
    return placed.drop("_part", "_place", "_group", "_range", "shift")


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Inside, at most ``rows`` rows (or what the session sets, if less) make
    one Arrow batch: a batch of long texts must not fill an executor."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def word_count(text):
    """Number of words of a text column; null counts as none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, SPACE + "+"))).cast("long")
