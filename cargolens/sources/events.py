"""Message decoding (SRC7) and the stream source (SRC6).

A message is (key, value) bytes, as a Kafka topic delivers it. Decoding is
``from_json`` against a declared schema; a value that does not parse yields a
null struct and is routed to quarantine instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cargolens import schemas as S

EVENT_SCHEMA = "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
PROPS_SCHEMA = "k BIGINT"


def as_messages(
    df: DataFrame, key: str, value_cols: list[str] | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """(key, value) binary columns: key = the key column as text, value = the
    row as JSON. The same frame feeds a Kafka sink (per-key ordering comes
    from the key's partition)."""
    cols = value_cols or df.columns
    return df.select(
        F.col(key).cast("string").cast("binary").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in cols])).cast("binary").alias("value"),
        *keep,
    )


CORRUPT = "_corrupt_record"


def _with_corrupt(schema: StructType | str) -> StructType | str:
    if isinstance(schema, str):
        return f"{schema}, {CORRUPT} STRING"
    return StructType(schema.fields + [StructField(CORRUPT, StringType())])


def decode(messages: DataFrame, schema: StructType | str, keep_raw: bool = False) -> DataFrame:
    """Parse the JSON value. A value that does not parse keeps its text in
    ``_corrupt_record`` and gets ``_parsed_ok`` false, so callers can route it
    to quarantine instead of failing the job."""
    text = F.col("value").cast("string")
    parsed = messages.select(
        F.col("key").cast("string").alias("key"),
        text.alias("_raw"),
        F.from_json(text, _with_corrupt(schema), {"columnNameOfCorruptRecord": CORRUPT}).alias("_m"),
    )
    out = parsed.select(
        "key", "_raw", "_m.*", (F.col("_m").isNotNull() & F.col(f"_m.{CORRUPT}").isNull()).alias("_parsed_ok")
    ).drop(CORRUPT)
    return out if keep_raw else out.drop("_raw")


def kafka_stream(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int = S.MESSAGES_PER_TRIGGER,
) -> DataFrame:
    """Kafka topic as a stream (needs the spark-sql-kafka package on the
    cluster). Offsets are kept in the query checkpoint, not auto-committed;
    a micro-batch reads ``max_offsets_per_trigger`` messages at most."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    return reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger)).load()


def file_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    fmt: str = "json",
    glob: str | None = None,
    max_files_per_trigger: int = S.FILES_PER_TRIGGER,
) -> DataFrame:
    """A folder as a stream: new files are new data. Stands in for the topic
    where no broker is configured."""
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.option("maxFilesPerTrigger", str(max_files_per_trigger)).load(path)
