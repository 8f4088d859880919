"""Operational (OLTP) tables as typed sources (SRC8).

With a JDBC URL the table is read in parallel slices of its primary key
(``partitionColumn`` with bounds fetched by a pushed-down min/max query);
without one it is read from Parquet. Either way the columns are cast to the
types the source DDL declares. Credentials come from the caller or the
environment, never from code.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolens import schemas as S


def typed(df: DataFrame, table: str) -> DataFrame:
    """Cast present columns to the DDL types. A value that does not fit becomes
    null here; ``quality.cast_violations`` counts those on the raw table."""
    schema = S.OPERATIONAL_SCHEMAS[table]
    present = {c.lower() for c in df.columns}
    return df.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields if f.name in present]
    )


def jdbc_properties() -> dict[str, str]:
    props = {}
    for key, env in (("user", "CARGOLENS_JDBC_USER"), ("password", "CARGOLENS_JDBC_PASSWORD")):
        if os.environ.get(env):
            props[key] = os.environ[env]
    return props


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    num_partitions: int = 16,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    props = properties or jdbc_properties()
    pk = S.PRIMARY_KEYS[table]
    bounds = spark.read.jdbc(url, f"(SELECT MIN({pk}) AS lo, MAX({pk}) AS hi FROM {table}) b", properties=props)
    lo, hi = bounds.first()
    if lo is None:
        return spark.read.jdbc(url, table, properties=props)
    return spark.read.jdbc(
        url,
        table,
        column=pk,
        lowerBound=int(lo),
        upperBound=int(hi) + 1,
        numPartitions=num_partitions,
        properties=props,
    )


def read_raw(spark: SparkSession, table: str, root: str | None = None, url: str | None = None) -> DataFrame:
    """One operational table as stored. ``url`` (or CARGOLENS_JDBC_URL) selects
    JDBC; otherwise ``root/<table>`` is read as Parquet."""
    url = url or os.environ.get("CARGOLENS_JDBC_URL")
    if url:
        return read_jdbc(spark, url, table)
    if not root:
        raise ValueError("either a JDBC url or a Parquet root is needed")
    return spark.read.parquet(f"{root.rstrip('/')}/{table}")


def stored_in_buckets(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """Store a table in ``buckets`` buckets by ``key`` (sorted inside) and
    return it reread. Tables stored so by the two columns of a foreign key, in
    as many buckets, are checked and joined on it without a shuffle: the cost
    of dealing the rows by key is paid once, when they are written. ``path``
    makes it an external table."""
    writer = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def read_operational(
    spark: SparkSession, table: str, root: str | None = None, url: str | None = None
) -> DataFrame:
    """One operational table, typed as the DDL declares it."""
    return typed(read_raw(spark, table, root, url), table)
