"""Spans of regular-expression matches as array columns, without Python.

``regexp_extract_all`` gives the matches of a text and ``split`` the stretches
between them; their lengths give each match's place in code points. The
running sum is taken in blocks, so a text with very many matches stays cheap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 64
NO_SPANS = "cast(array() as array<struct<start:int,end:int,value:string>>)"


def with_spans(df: DataFrame, text: str, pattern: str, out: str, keep_gaps: bool = False) -> DataFrame:
    """Add ``out``: array of (start, end, value) of all matches, in order.

    ``keep_gaps`` adds ``out``_gaps, the stretches before, between and after
    the matches (null where there is none).
    """
    v, g, n, b, p = (f"{out}_{x}" for x in ("values", "gaps", "steps", "blocks", "before"))
    regex = F.lit(pattern)
    df = df.withColumn(v, F.regexp_extract_all(F.col(text), regex, F.lit(0)))
    df = df.withColumn(g, F.when(F.size(v) > 0, F.split(F.col(text), pattern, -1)))
    df = df.withColumn(n, F.zip_with(v, F.slice(g, F.lit(1), F.size(v)), lambda x, y: F.length(x) + F.length(y)))
    df = df.withColumn(
        b,
        F.when(
            F.size(v) > 0,
            F.transform(
                F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int")),
                lambda k: F.aggregate(F.slice(n, k * BLOCK + 1, BLOCK), F.lit(0), lambda a, x: a + x),
            ),
        ),
    )
    df = df.withColumn(p, F.transform(b, lambda _, k: F.aggregate(F.slice(b, F.lit(1), k), F.lit(0), lambda a, x: a + x)))

    def span(x, i):
        block = F.floor(i / BLOCK).cast("int")
        inside = F.aggregate(F.slice(n, block * BLOCK + 1, i % BLOCK + 1), F.lit(0), lambda a, y: a + y)
        end = F.col(p)[block] + inside
        return F.struct((end - F.length(x)).alias("start"), end.alias("end"), x.alias("value"))

    df = df.withColumn(out, F.when(F.size(v) > 0, F.transform(v, span)).otherwise(F.expr(NO_SPANS)))
    return df.drop(v, n, b, p, *([] if keep_gaps else [g]))


def listed(kinds: dict[str, str]) -> Column:
    """All spans of several array columns as text: kind:start:end by start,
    then by the kind's place in ``kinds`` (kind -> column), comma-joined."""
    names = F.array(*[F.lit(k) for k in kinds])

    def placed(column: str, place: int) -> Column:
        return F.transform(column, lambda s: F.struct(s["start"], F.lit(place).alias("kind"), s["end"]))

    ordered = F.array_sort(F.concat(*[placed(c, i) for i, c in enumerate(kinds.values())]))
    text = F.transform(ordered, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"]))
    return F.concat_ws(",", text)


def touches(span: Column, *columns: str) -> Column:
    """Does the span overlap any span of the array columns?"""
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.exists(c, lambda b: (b["start"] < span["end"]) & (span["start"] < b["end"]))
    return hit
