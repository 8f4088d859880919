"""Incremental runs: new landings to silver, changed days to gold (C4).

A run reads the landings that no committed run has processed (or that have
changed since), writes each into folders of its own, and commits their names.
Gold and the checks come from stored partial aggregates by day
(``operators.partials``): a run recomputes the days whose landings differ from
those their partials were made of, and merges the partials of all days.

Both steps are repeatable: a run that fails before its commit is done again by
the next one, and replaces what it had written.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolens import schemas as S
from cargolens.operators import partials, quality, silver
from cargolens.session import delete_path, glob_paths, path_exists
from cargolens.sinks import files
from cargolens.sinks.manifest import Manifest
from cargolens.sources import bronze, tables

PARTIALS = ("kpi", "order_ids", "checks", "shipment_ids")


def silver_manifest(spark: SparkSession, out_root: str) -> Manifest:
    return Manifest(spark, f"{out_root.rstrip('/')}/_manifests/shipments")


def partials_manifest(spark: SparkSession, out_root: str) -> Manifest:
    return Manifest(spark, f"{out_root.rstrip('/')}/_manifests/partials")


def forget(spark: SparkSession, out_root: str) -> None:
    """Before a full rebuild of silver: nothing counts as processed."""
    silver_manifest(spark, out_root).clear()
    partials_manifest(spark, out_root).clear()


def run_silver(
    spark: SparkSession,
    bronze_root: str,
    out_root: str,
    run_ts: Column | None = None,
    start: str | None = None,
    end: str | None = None,
    again: bool = False,
    fmt: str = "parquet",
) -> dict:
    """New and changed landings (of the given days, or all) to silver and
    quarantine; ``again`` takes the landings of these days whether new or not.

    Returns the PASS and FAIL counts, and the landings that were read. The
    first run on a table that full runs have written replaces it."""
    manifest = silver_manifest(spark, out_root)
    if not manifest.exists() and path_exists(spark, f"{out_root.rstrip('/')}/shipments"):
        delete_path(spark, f"{out_root.rstrip('/')}/shipments")
        partials_manifest(spark, out_root).clear()
    found, done = bronze.landings(spark, bronze_root, start, end), manifest.entries()
    known = {name: entry.split("#")[0] for name, entry in done.items()}  # <version>#<times read>
    new = {name: version for name, version in found.items() if again or known.get(name) != version}
    if not new:
        return {"pass": 0, "fail": 0, "landings": []}
    raw = bronze.read_landings(spark, bronze_root, sorted(new))
    _, counts = files.write_flagged(silver.flagged(raw, run_ts), out_root, fmt, landings=sorted(new))
    # an entry changes whenever its landing is read, so that its day gets new partials
    times = {name: int(done[name].split("#")[1]) if name in done else 0 for name in new}
    manifest.commit({name: f"{version}#{times[name] + 1}" for name, version in new.items()})
    return {**counts, "landings": sorted(new)}


def stale_days(spark: SparkSession, out_root: str) -> dict[str, str]:
    """Days of silver whose partials are missing or made of other landings,
    each with its version: a digest of the day's landings."""
    days: dict[str, list[str]] = {}
    for name, version in silver_manifest(spark, out_root).entries().items():
        day = name.split("/")[0].split("=", 1)[1]
        days.setdefault(day, []).append(f"{name}:{version}")
    versions = {day: hashlib.sha256("\n".join(sorted(parts)).encode()).hexdigest() for day, parts in days.items()}
    done = partials_manifest(spark, out_root).entries()
    return {day: version for day, version in versions.items() if done.get(day) != version}


def days_with_rows(spark: SparkSession, out_root: str) -> set[str]:
    """Ingest days that have PASS rows (folder names)."""
    found = glob_paths(spark, f"{out_root.rstrip('/')}/shipments/ingest_date=*/landing=*/dq_flag=PASS")
    return {p.split("/ingest_date=")[1].split("/")[0] for p in found}


def no_silver(spark: SparkSession) -> DataFrame:
    none = spark.createDataFrame([], S.SHIPMENT)
    return silver.flagged(none).withColumn("ingest_date", F.lit(None).cast("string"))


def silver_of_days(spark: SparkSession, out_root: str, days: list[str], fmt: str = "parquet") -> DataFrame:
    """The PASS rows of some ingest days; other days' folders are not read."""
    if not days:
        return no_silver(spark)
    rows = tables.read_silver(spark, out_root, fmt)
    return rows.withColumn("ingest_date", F.col("ingest_date").cast("string")).filter(F.col("ingest_date").isin(days))


def refresh_partials(spark: SparkSession, out_root: str, fmt: str = "parquet") -> list[str]:
    """Recompute the partials of the stale days; the days."""
    stale = stale_days(spark, out_root)
    if not stale:
        return []
    days, left = sorted(stale), days_with_rows(spark, out_root)
    rows = silver_of_days(spark, out_root, sorted(left & set(days)), fmt)
    for name, table in partials.partials_of(rows).items():
        path = partials_path(out_root, name)
        writer = table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
        writer.partitionBy(partials.DAY).parquet(path)
    # a day that has no row any more has written no folder
    for day in set(days) - left:
        for name in PARTIALS:
            delete_path(spark, f"{partials_path(out_root, name)}/{partials.DAY}={day}")
    partials_manifest(spark, out_root).commit(stale)
    return days


def partials_path(out_root: str, name: str) -> str:
    return f"{out_root.rstrip('/')}/partials/{name}"


def read_partials(spark: SparkSession, out_root: str, name: str) -> DataFrame:
    """One table of partials, all days (without a day: empty)."""
    schema, path = partials.partials_of(no_silver(spark))[name].schema, partials_path(out_root, name)
    if not glob_paths(spark, f"{path}/{partials.DAY}=*"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def run_incremental(
    spark: SparkSession,
    bronze_root: str,
    out_root: str,
    run_ts: Column | None = None,
    on_fail: str = "warn",
    start: str | None = None,
    end: str | None = None,
    again: bool = False,
    fmt: str = "parquet",
) -> dict:
    """New landings to silver, checks over all of silver, then gold, from
    stored partials; a summary of what was read. ``on_fail="raise"`` stops
    before gold is replaced, as in a full run."""
    counts = run_silver(spark, bronze_root, out_root, run_ts, start, end, again, fmt)
    days = refresh_partials(spark, out_root, fmt)
    failed: list = []
    if partials_manifest(spark, out_root).exists():
        stored = {name: read_partials(spark, out_root, name) for name in PARTIALS}
        files.write_table(partials.merged_checks(stored["checks"], stored["shipment_ids"]), out_root, "checks", fmt)
        failed = quality.gate(tables.read_layer_table(spark, out_root, "checks", fmt), on_fail)
        orders = partials.distinct_counts(stored["order_ids"], ["status"], "unique_orders")
        for name, table in partials.merged_gold(stored["kpi"], orders, run_ts).items():
            files.write_table(table, out_root, name, fmt)
    return {**counts, "days": days, "failed_checks": [r["check_name"] for r in failed]}
