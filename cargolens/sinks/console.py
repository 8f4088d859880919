"""Driver-side outputs (SNK6, SNK7), bounded by construction.

Nothing here pulls an unbounded table to the driver: previews take the
first rows, and copies to pandas refuse tables above a row limit instead of
silently truncating them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def preview(df: DataFrame, n: int = 20) -> None:
    """Console preview of the first ``n`` rows (the reference's show())."""
    df.show(n, truncate=False)


class TooManyRowsError(RuntimeError):
    pass


def to_pandas_bounded(df: DataFrame, max_rows: int):
    """Copy an aggregated table to pandas; fails if it has more than the
    ``max_rows`` that the caller has room for (fetching one extra row is how
    that is detected)."""
    probe = df.limit(max_rows + 1)
    pdf = probe.toPandas()
    if len(pdf) > max_rows:
        raise TooManyRowsError(f"table has more than {max_rows} rows; aggregate it first")
    return pdf
