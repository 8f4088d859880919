"""Column expressions shared by the layers. All are built-in Spark
expressions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cargolens import schemas as S


def col_or_name(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalized_status(c: Column | str = "status") -> Column:
    """upper(trim(status)). trim removes spaces only; a tab survives."""
    return F.upper(F.trim(col_or_name(c)))


def trimmed(c: Column | str) -> Column:
    return F.trim(col_or_name(c))


def is_valid_status(c: Column | str = "status") -> Column:
    """Membership in the seven statuses; null in, null out."""
    return col_or_name(c).isin(S.VALID_STATUSES)


def is_valid_weight(c: Column | str = "weight_kg") -> Column:
    """Positive and finite: NaN and infinity, which Spark orders above every
    number, are not weights and go to quarantine."""
    w = col_or_name(c)
    return (w > F.lit(0)) & (w < F.lit(float("inf")))


def dq_flag(*conditions: Column) -> Column:
    """PASS only when every condition is true; false or null gives FAIL."""
    all_true = conditions[0]
    for cond in conditions[1:]:
        all_true = all_true & cond
    return F.when(all_true, F.lit(S.PASS)).otherwise(F.lit(S.FAIL))


def weight_category(c: Column | str = "weight_kg") -> Column:
    """LIGHT / MEDIUM / HEAVY / EXTRA_HEAVY; a null weight falls through to
    the top band, as in the reference."""
    w = col_or_name(c)
    bound, label = S.WEIGHT_BANDS[0]
    expr = F.when(w < F.lit(bound), F.lit(label))
    for bound, label in S.WEIGHT_BANDS[1:]:
        expr = expr.when(w < F.lit(bound), F.lit(label))
    return expr.otherwise(F.lit(S.WEIGHT_TOP_BAND))


def rate_pct(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """round(100 * n / d, digits); a zero denominator gives null, not an error."""
    return F.round(F.try_divide(numerator.cast("double") * F.lit(100.0), denominator), digits)


def route_label(origin: Column | str = "origin", destination: Column | str = "destination") -> Column:
    """'origin → destination'; null when either side is null (concat, not concat_ws)."""
    return F.concat(col_or_name(origin), F.lit(S.ROUTE_SEPARATOR), col_or_name(destination))


def kpi_band(rate: Column | str) -> Column:
    r = col_or_name(rate)
    return (
        F.when(r > F.lit(S.KPI_BAND_RED_ABOVE), F.lit("red"))
        .when(r > F.lit(S.KPI_BAND_AMBER_ABOVE), F.lit("amber"))
        .otherwise(F.lit("green"))
    )


EXACT_BELOW = 1e15


def exact_mean(c: Column | str, scale: int = 6) -> Column:
    """Mean of a double column that does not depend on the order of its rows.

    Each value is split into a DECIMAL part of ``scale`` digits, whose sum is
    exact, and the small rest, whose floating-point sum is far below the last
    digit of the total; nothing is cut off. Values of ``EXACT_BELOW`` and more,
    NaN and infinity have no DECIMAL part and go through the floating-point sum
    whole, so the mean is that of avg(). Nulls are skipped; an all-null group
    gives null."""
    exact, rest, x = mean_parts(c, scale)
    return mean_of_parts(F.sum(exact), F.sum(rest), F.count(x))


def mean_parts(c: Column | str, scale: int = 6) -> tuple[Column, Column, Column]:
    """The DECIMAL part, the rest and the value itself, whose sums and count
    ``mean_of_parts`` turns into the mean: sums of parts can be stored and
    added up later."""
    x = col_or_name(c).cast("double")
    exact = F.when(F.abs(x) < F.lit(EXACT_BELOW), x.try_cast(f"decimal(38,{scale})"))
    return exact, x - F.coalesce(exact.cast("double"), F.lit(0.0)), x


def mean_of_parts(exact: Column, rest: Column, n: Column) -> Column:
    """The mean from the summed parts of ``mean_parts`` and the count."""
    return F.try_divide(F.coalesce(exact.cast("double"), F.lit(0.0)) + rest, n)


def round_avg(c: Column, digits: int | None) -> Column:
    """Optional display rounding; None keeps the double."""
    return c if digits is None else F.round(c, digits)


def iso_text(ts: Column) -> Column:
    """ISO-8601 text of a timestamp, as events carry it."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def typed_timestamp(text: Column | str) -> Column:
    """Typed copy of an ISO text timestamp; bad text gives null (not an error)."""
    return F.try_to_timestamp(col_or_name(text))
