"""File sinks (SNK1-4, SNK8). Spark's commit protocol makes every write
task-retry safe: a lost executor's half-written files are never committed."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from cargolens import schemas as S
from cargolens.session import delete_path, glob_paths, open_folders
from cargolens.sinks import small_files

#: Files of many events are compressed, by zlib's fastest level.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def with_ingest_date(df: DataFrame, ts: Column | None = None) -> DataFrame:
    """ingest_date (yyyy-MM-dd): the arrival day by default (now), or the day
    of a given timestamp column."""
    day = F.current_date() if ts is None else F.to_date(ts)
    return df.withColumn("ingest_date", F.date_format(day, "yyyy-MM-dd"))


def land_json_lines(
    df: DataFrame,
    path: str,
    max_records_per_file: int = S.FILE_RECORDS,
    partition_by: str | None = "ingest_date",
    mode: str = "append",
    landing: str | None = None,
    exact: bool = False,
) -> None:
    """Bronze landing: JSON Lines, at most ``max_records_per_file`` events per
    file (``S.BRONZE_BATCH_SIZE`` gives the small files of a message consumer),
    one folder per ingest day and, inside it, one per landing. Stream landings
    (``streaming.jobs``) use the same two levels, so both can share a root.
    Null fields are written as nulls so every file carries all keys. With
    ``exact`` every file but one holds exactly ``max_records_per_file`` events
    (of each day, where one run lands several)."""
    if partition_by:
        df = df.withColumn("landing", F.lit(landing or uuid.uuid4().hex[:12]))
    by = [partition_by, "landing"] if partition_by else []
    write_json_lines(df, path, max_records_per_file, by, mode, exact=exact)


def write_json_lines(
    df: DataFrame,
    path: str,
    max_records_per_file: int,
    by: list[str],
    mode: str = "append",
    replace: bool = False,
    exact: bool = False,
) -> None:
    """JSON Lines in folders by the columns ``by``, nulls written. Files of few
    events go through ``small_files``, larger ones are compressed. ``replace``
    replaces the folders that are written and leaves the others. ``exact`` fills
    all files of a folder but one with consecutive rows: the small ones where the
    rows are, larger ones by ``in_exact_batches``."""
    if max_records_per_file < small_files.COMPRESS_FROM:
        row = F.struct(*[F.col(c) for c in df.columns if c not in by])
        text = F.to_json(row, {"ignoreNullFields": "false"}).alias("text")
        rows = df.select(*[F.col(c).cast("string").alias(c) for c in by], text)
        small_files.write_batches(rows, path, max_records_per_file, mode, replace=replace, exact=exact)
        return
    if exact:
        df = in_exact_batches(df, max_records_per_file)
    writer = df.write.mode("overwrite" if replace else mode).options(**PACKED)
    writer = writer.option("maxRecordsPerFile", max_records_per_file).option("ignoreNullFields", "false")
    if replace:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if by:
        writer = writer.partitionBy(*by)
    with open_folders(df.sparkSession):
        writer.json(path)


def in_exact_batches(df: DataFrame, size: int) -> DataFrame:
    """The rows dealt so that a write with ``maxRecordsPerFile=size`` makes files
    of exactly ``size`` rows, all but one (STR3: a consumer's batches).

    Rows are numbered through (a task's first number is the count of the rows
    of earlier tasks), and a range shuffle by batch number keeps every batch in
    one task and every task's batches whole. ``df`` is evaluated twice and must
    give the same rows in the same tasks: a table, or a cached frame."""
    part, place = F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_place")
    rows = df.select("*", part, place)
    counts = rows.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # over tasks, not rows
    counts = counts.select("_part", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_earlier"))
    number = F.col("_place") - F.col("_first") + F.col("_earlier")
    numbered = rows.join(F.broadcast(counts), "_part").withColumn("_batch", F.floor(number / size))  # one row a task
    dealt = numbered.repartitionByRange("_batch").sortWithinPartitions("_batch", "_place")
    return dealt.select(*df.columns)


def land_json_arrays(
    df: DataFrame,
    path: str,
    batch_size: int = S.BRONZE_BATCH_SIZE,
    mode: str = "append",
    writers: int | None = None,
    day: str | None = None,
) -> None:
    """Reference layout: each file one JSON array of at most ``batch_size``
    events, below ``YYYY/MM/DD`` where a ``day`` is given. Rows are serialised to
    JSON in the JVM; ``small_files`` joins them into arrays inside the tasks.
    ``writers`` spreads a small input over that many tasks first (round-robin
    repartition, which Spark makes deterministic by sorting before it, so
    retries are safe)."""
    if day:
        path = f"{path.rstrip('/')}/{day.replace('-', '/')}"
    if writers:
        df = df.repartition(writers)
    rows = df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("text"))
    small_files.write_batches(rows, path, batch_size, mode, arrays=True)


def write_table(df: DataFrame, root: str, name: str, fmt: str = "parquet", mode: str = "overwrite") -> str:
    """Silver/gold table write (full overwrite, like the reference)."""
    path = f"{root.rstrip('/')}/{name}"
    df.write.mode(mode).format(fmt).save(path)
    return path


def write_flagged(
    flagged: DataFrame,
    root: str,
    fmt: str = "parquet",
    days: tuple[str | None, str | None] | None = None,
    landings: list[str] | None = None,
) -> tuple[str, dict]:
    """Write every validated row once, partitioned by ingest_date (where the
    rows carry it) and dq_flag: the PASS folders are the silver table, the FAIL
    folders the quarantine (with reasons).

    Without ``days`` the whole table is replaced. With ``days`` (first, last;
    None leaves an end open) only those ingest days are: each of their folders
    is overwritten, and folders that this run did not write are removed. Other
    days stay. One scan of bronze feeds both tables (no cache, no second pass),
    and the PASS/FAIL counts come from an Observation on that same write.

    With ``landings`` (names ``ingest_date=<day>/landing=<id>``, the rows those
    of these landings) the table has one more folder level, the landing, and
    only the folders of these landings are replaced."""
    from cargolens.operators import silver as SV

    obs = Observation("dq_counts")
    # A malformed bronze record keeps its raw text: it fails validation (all
    # fields null) and lands in the quarantine folder, never dropped.
    extra = [S.CORRUPT_RECORD] if S.CORRUPT_RECORD in flagged.columns else []
    levels = ["ingest_date"] if landings is None else ["ingest_date", "landing"]
    dated = [c for c in levels if c in flagged.columns]
    if days and not dated:
        raise ValueError("replacing days needs rows with an ingest_date")
    folder = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in [*dated, "dq_flag"]])
    rows = SV.with_reasons(flagged).select(*S.SILVER_COLUMNS, *extra, "reasons", *dated)
    observed = rows.observe(
        obs,
        F.count_if(F.col("dq_flag") == F.lit(S.PASS)).alias("pass"),
        F.count_if(F.col("dq_flag") == F.lit(S.FAIL)).alias("fail"),
        F.collect_set(folder).alias("folders"),  # two a day or landing at most
    )
    path = f"{root.rstrip('/')}/shipments"
    writer = observed.write.mode("overwrite").partitionBy(*dated, "dq_flag").format(fmt)
    if days or landings is not None:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    with open_folders(flagged.sparkSession):
        writer.save(path)
    counts = dict(obs.get)
    written = set(counts.pop("folders"))
    if days:
        first, last = days
        for found in glob_paths(flagged.sparkSession, f"{path}/ingest_date=*/dq_flag=*"):
            day = re.search(r"ingest_date=([^/]+)/", found)[1]
            inside = (first is None or day >= first) and (last is None or day <= last)
            if inside and "/".join(found.split("/")[-2:]) not in written:
                delete_path(flagged.sparkSession, found)
    for name in landings or []:
        for found in glob_paths(flagged.sparkSession, f"{path}/{name}/dq_flag=*"):
            if "/".join(found.split("/")[-3:]) not in written:  # an earlier version had such rows
                delete_path(flagged.sparkSession, found)
    return path, counts


def write_text_report(lines: DataFrame, path: str) -> None:
    """The report as text, in order. The global sort range-partitions the
    lines, so part files read in name order give the report in order; no
    single task has to hold it (a small report is one part file anyway)."""
    order = [F.col(c).desc_nulls_last() if c == "k1" else F.col(c).asc_nulls_first() for c in S.REPORT_ORDER]
    lines.orderBy(*order).select("line").write.mode("overwrite").text(path)


def read_text_parts(spark, path: str) -> DataFrame:
    """(pos, value): lines of a multi-part text output, numbered in file-name
    order, then line order. Few lines: a report, not data."""
    lines = spark.read.text(path, wholetext=False).select(
        F.input_file_name().alias("_f"), F.monotonically_increasing_id().alias("_i"), "value"
    )
    return lines.select(F.row_number().over(Window.orderBy("_f", "_i")).cast("bigint").alias("pos"), "value")
