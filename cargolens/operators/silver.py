"""Bronze -> silver: normalise, validate, flag, apply business rules.

Every function is a narrow, stateless projection or filter, so the same code
runs on a batch or a streaming DataFrame and fuses into one codegen stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens import schemas as S
from cargolens.functions import columns as C


def normalize(df: DataFrame) -> DataFrame:
    """status := upper(trim(status)); carrier, origin, destination trimmed
    (case kept). One projection instead of a chain of withColumn calls."""
    return df.withColumns(
        {
            "status": C.normalized_status("status"),
            "carrier": C.trimmed("carrier"),
            "origin": C.trimmed("origin"),
            "destination": C.trimmed("destination"),
        }
    )


def add_validation(df: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Four validity flags, the PASS/FAIL flag and the processed_at stamp.

    ``run_ts`` makes a run reproducible (one value for every row and every
    table of the run); by default it is current_timestamp()."""
    flags = df.withColumns(
        {
            "is_valid_status": C.is_valid_status("status"),
            "is_valid_weight": C.is_valid_weight("weight_kg"),
            "has_origin": F.col("origin").isNotNull(),
            "has_destination": F.col("destination").isNotNull(),
        }
    )
    return flags.withColumns(
        {
            "dq_flag": C.dq_flag(
                F.col("is_valid_status"),
                F.col("is_valid_weight"),
                F.col("has_origin"),
                F.col("has_destination"),
            ),
            "processed_at": run_ts if run_ts is not None else F.current_timestamp(),
        }
    )


def clean_and_validate(df: DataFrame, run_ts: Column | None = None) -> DataFrame:
    return add_validation(normalize(df), run_ts)


def apply_business_logic(df: DataFrame) -> DataFrame:
    """weight_category, is_delayed, is_delivered."""
    return df.withColumns(
        {
            "weight_category": C.weight_category("weight_kg"),
            "is_delayed": F.col("status") == F.lit(S.DELAYED),
            "is_delivered": F.col("status") == F.lit(S.DELIVERED),
        }
    )


def flagged(df: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """All rows, normalised, validated and enriched (before the PASS filter)."""
    return apply_business_logic(clean_and_validate(df, run_ts))


def passed(df: DataFrame) -> DataFrame:
    return df.filter(F.col("dq_flag") == F.lit(S.PASS))


def failed(df: DataFrame) -> DataFrame:
    return df.filter(F.col("dq_flag") == F.lit(S.FAIL))


def silver(bronze: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """The silver table: PASS rows only, 22 columns."""
    return passed(flagged(bronze, run_ts)).select(*S.SILVER_COLUMNS)


REASONS = ["bad_status", "bad_weight", "no_origin", "no_destination"]


def _reason_conditions() -> dict[str, Column]:
    # A flag that is false or null means the rule did not hold.
    return {
        "bad_status": ~F.coalesce(F.col("is_valid_status"), F.lit(False)),
        "bad_weight": ~F.coalesce(F.col("is_valid_weight"), F.lit(False)),
        "no_origin": ~F.col("has_origin"),
        "no_destination": ~F.col("has_destination"),
    }


def with_reasons(df: DataFrame) -> DataFrame:
    """Adds the array of broken rules (empty for PASS rows). A record that did
    not parse (``_corrupt_record`` set) also carries the reason 'malformed'."""
    conds = _reason_conditions()
    if S.CORRUPT_RECORD in df.columns:
        conds["malformed"] = F.col(S.CORRUPT_RECORD).isNotNull()
    reasons = F.filter(
        F.array(*[F.when(cond, F.lit(name)) for name, cond in conds.items()]),
        lambda r: r.isNotNull(),
    )
    return df.withColumn("reasons", reasons)


def quarantine(df: DataFrame) -> DataFrame:
    """FAIL rows with the array of broken rules (the reference drops them)."""
    return with_reasons(failed(df))


def quarantine_reason_counts(df: DataFrame) -> DataFrame:
    """(reason, n) over validated rows; a row may count under several reasons.

    One global aggregate (partial per task, one row per task shuffled),
    then unpivoted to four rows: no explode, no shuffle by reason."""
    conds = _reason_conditions()
    wide = failed(df).agg(*[F.count_if(cond).alias(name) for name, cond in conds.items()])
    return wide.unpivot([], list(conds), "reason", "n")


def dq_flag_counts(df: DataFrame) -> DataFrame:
    """(dq_flag, n): PASS and FAIL counts in one aggregate."""
    return df.groupBy("dq_flag").agg(F.count(F.lit(1)).alias("n"))


def weight_category_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("weight_category").agg(F.count(F.lit(1)).alias("n"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def with_typed_timestamps(df: DataFrame) -> DataFrame:
    """Typed copies of the ISO text timestamps (bad text -> null)."""
    return df.withColumns(
        {
            "shipped_ts": C.typed_timestamp("shipped_at"),
            "delivered_ts": C.typed_timestamp("delivered_at"),
            "event_ts": C.typed_timestamp("event_timestamp"),
        }
    )
