"""Quality rules, then robust multivariate outliers.

The base rule fails texts under ``MIN_WORDS`` words or with more than half of
their words inside repeated 3-word windows. The rest is judged per language
and source: five transformed statistics, a minimum-covariance-determinant
estimate of their centre and scatter, and a text is rejected when its squared
Mahalanobis distance exceeds the ``CUTOFF`` quantile.

The estimate starts from medians and median deviations, then repeats
concentration steps: keep the half with the smallest distances, take its mean
and covariance. A last step re-estimates from all texts within the 97.5 %
ellipsoid. Statistics are fixed-point integers, so their sums are exact and
the verdicts do not depend on the order of the rows. ``NOISE`` is added to the
scatter: a statistic that is the same in most texts (no symbols at all) does
not turn every other value into an outlier. It is small; what a text of a given
length cannot resolve is taken off its own counts instead (``ALLOWED``): a few
symbols, one repeated line, one phrase that occurs twice.

A group with fewer than ``MIN_GROUP`` texts is judged with its language, and a
language with fewer with all texts. Everything runs in built-in functions.
Edge cases: a null text has no words; null languages and sources are values of
their own; repeated rows count as often as they occur; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens.llm.staging import SPACE, SPACE_CHARS, WORD, staged

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MIN_GROUP = 100
STEPS = 4
CUTOFF = 0.9999
UNIT = 256  # fixed-point steps per unit of a statistic
#: statistic -> standard deviation that is added as measurement noise
NOISE = {"words": 0.3, "word_length": 0.1, "symbols": 0.04, "dup_lines": 0.1, "repeats": 0.1}
#: statistic -> count that is within the resolution of any one text
ALLOWED = {"symbols": 2, "dup_lines": 1, "repeats": 6}
DIMS = len(NOISE)


def chi2_cdf(x: float, k: int) -> float:
    """Chi-squared distribution function, by the series of the incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, z = k / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-16:
        n += 1
        term *= z / n
        total += term
    return min(1.0, total * math.exp(-z + a * math.log(z) - math.lgamma(a)))


def chi2_quantile(p: float, k: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, k) < p else (low, mid)
    return low


def consistency(share: float) -> float:
    """Factor that makes the covariance of the central share right for normal data."""
    return share / chi2_cdf(chi2_quantile(share, DIMS), DIMS + 2)


def counted(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of every whole text."""
    df = docs.select(
        F.col("doc_id").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.col("text"), F.lit("")).alias("_text"),
    )
    text = F.col("_text")
    df = df.withColumn("_w", F.filter(F.split(text, SPACE + "+"), lambda w: w != ""))
    df = df.withColumn("_lines", F.filter(F.split(text, "\n"), lambda x: F.regexp_like(x, F.lit(WORD))))
    n = F.size("_w")
    word = lambda i: F.col("_w")[i]
    windows = F.transform(
        F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.expr("cast(array() as array<int>)")),
        lambda i: F.struct(F.xxhash64(word(i), word(i + 1), word(i + 2)).alias("h"), i.alias("i")),
    )
    df = df.withColumn("_windows", F.sort_array(windows))

    def again(x, i):
        same = lambda j: F.coalesce(F.get("_windows", j)["h"] == x["h"], F.lit(False))
        return same(i - 1) | same(i + 1)

    df = df.withColumn("_again", F.filter("_windows", again))
    covered = F.flatten(F.transform("_again", lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
    without = lambda chars: F.length(F.translate(text, chars, ""))
    return df.select(
        "doc_id", "lang", "source",
        n.cast("long").alias("n_words"),
        without(SPACE_CHARS).cast("long").alias("word_chars"),
        (F.length(text) - without(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct(covered)).cast("long").alias("n_repeat_words"),
        F.size("_lines").alias("_n_lines"),
    )


def statistics(df: DataFrame) -> DataFrame:
    """The transformed statistics as integers of 1 / ``UNIT`` (columns _x0 ...)."""
    beyond = lambda a, kind: F.greatest(F.col(a) - ALLOWED[kind], F.lit(0))
    share = lambda a, b: F.asin(F.sqrt(F.least(F.lit(1.0), a / F.greatest(b, F.lit(1)))))
    values = [
        F.log1p("n_words"),
        F.log1p(F.col("word_chars") / F.greatest("n_words", F.lit(1))),
        share(beyond("n_symbols", "symbols"), F.col("word_chars")),
        share(beyond("n_dup_lines", "dup_lines"), F.col("_n_lines")),
        share(beyond("n_repeat_words", "repeats"), F.col("n_words")),
    ]
    return df.select("*", *[F.round(v * UNIT).cast("long").alias(f"_x{i}") for i, v in enumerate(values)])


def grouped(df: DataFrame) -> DataFrame:
    """Add _group: language and source, or the language, or all, by size."""
    both, one = F.struct(F.lit(1).alias("level"), "lang", "source"), F.struct(F.lit(2).alias("level"), "lang", F.lit(None).cast("string").alias("source"))
    every = F.struct(F.lit(3).alias("level"), F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source"))
    sizes = df.groupBy("lang", "source").count()
    langs = sizes.groupBy("lang").agg(F.sum("count").alias("_n")).withColumnRenamed("lang", "_lang")
    names = sizes.join(langs, F.col("lang").eqNullSafe(F.col("_lang")))
    group = F.when(F.col("count") >= MIN_GROUP, both).when(F.col("_n") >= MIN_GROUP, one).otherwise(every)
    names = staged(names.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), F.to_json(group).alias("_group")), "groups")
    same = df["lang"].eqNullSafe(names["_lang"]) & df["source"].eqNullSafe(names["_source"])
    return df.join(names, same).drop("_lang", "_source")


PAIRS = [(i, j) for i in range(DIMS) for j in range(i + 1)]


def moments(inside: DataFrame, factor: float) -> DataFrame:
    """Per group: mean and lower triangle of the Cholesky root of factor * covariance + noise."""
    x = [F.col(f"_x{i}") for i in range(DIMS)]
    sums = inside.groupBy("_group").agg(
        F.count("*").alias("_n"),
        *[F.sum(c).alias(f"_s{i}") for i, c in enumerate(x)],
        *[F.sum(x[i] * x[j]).alias(f"_s{i}_{j}") for i, j in PAIRS],
    )
    df = sums.select("_group", "_n", *[(F.col(f"_s{i}") / F.col("_n") / UNIT).alias(f"_m{i}") for i in range(DIMS)], *[f"_s{i}_{j}" for i, j in PAIRS])
    noise = list(NOISE.values())
    for i, j in PAIRS:
        c = (F.col(f"_s{i}_{j}") / F.col("_n") / UNIT**2 - F.col(f"_m{i}") * F.col(f"_m{j}")) * factor
        df = df.withColumn(f"_s{i}_{j}", c + noise[i] ** 2 if i == j else c)
    return cholesky(df)


def cholesky(df: DataFrame) -> DataFrame:
    """Columns _l{i}_{j} from the covariances _s{i}_{j}."""
    for i, j in PAIRS:
        rest = F.col(f"_s{i}_{j}")
        for k in range(j):
            rest = rest - F.col(f"_l{i}_{k}") * F.col(f"_l{j}_{k}")
        root = F.sqrt(F.greatest(rest, F.lit(1e-6))) if i == j else rest / F.col(f"_l{j}_{j}")
        df = df.withColumn(f"_l{i}_{j}", root)
    return df.select("_group", *[f"_m{i}" for i in range(DIMS)], *[f"_l{i}_{j}" for i, j in PAIRS])


def distances(df: DataFrame, state: DataFrame) -> DataFrame:
    """Add _d: the squared Mahalanobis distance to the row's group."""
    out = df.join(state, "_group")
    for i in range(DIMS):
        z = F.col(f"_x{i}") / UNIT - F.col(f"_m{i}")
        for k in range(i):
            z = z - F.col(f"_l{i}_{k}") * F.col(f"_z{k}")
        out = out.withColumn(f"_z{i}", z / F.col(f"_l{i}_{i}"))
    d: Column = sum((F.col(f"_z{i}") ** 2 for i in range(1, DIMS)), F.col("_z0") ** 2)
    return out.select(*df.columns, d.alias("_d"))


def start(df: DataFrame) -> DataFrame:
    """First state of every group: medians, and median deviations as scatter."""
    x = [f"_x{i}" for i in range(DIMS)]
    # exact percentiles of fixed-point values: as many counters as there are values
    centre = df.groupBy("_group").agg(*[F.percentile(c, 0.5).alias(f"_c{i}") for i, c in enumerate(x)])
    off = df.join(centre, "_group").select("_group", *x, *[F.col(f"_c{i}") for i in range(DIMS)])
    spread = off.groupBy("_group").agg(
        *[F.max(f"_c{i}").alias(f"_c{i}") for i in range(DIMS)],
        *[F.percentile(F.abs(F.col(c) - F.col(f"_c{i}")), 0.5).alias(f"_d{i}") for i, c in enumerate(x)],
    )
    noise = list(NOISE.values())
    out = spread.select("_group", *[(F.col(f"_c{i}") / UNIT).alias(f"_m{i}") for i in range(DIMS)], *[f"_d{i}" for i in range(DIMS)])
    for i, j in PAIRS:
        variance = (F.col(f"_d{i}") * 1.4826 / UNIT) ** 2 + noise[i] ** 2
        out = out.withColumn(f"_s{i}_{j}", variance if i == j else F.lit(0.0))
    return cholesky(out)


def judge(docs: DataFrame, steps: int = STEPS) -> DataFrame:
    """One row per document: counts, base_failed, kept, and the distance."""
    repeated = F.col("n_repeat_words") * 100 > F.col("n_words") * 50
    df = statistics(counted(docs)).withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | repeated)
    df = staged(df, "statistics")
    fit = staged(grouped(df.where(~F.col("base_failed"))), "grouped")
    state = staged(start(fit), "state")
    for _ in range(steps):
        near = distances(fit, state)
        # distances in steps of 1/64, so that the exact median stays small
        ticks = F.least(F.round(F.col("_d") * 64), F.lit(1 << 16)).cast("long")
        near = near.withColumn("_t", ticks)
        half = near.groupBy("_group").agg(F.percentile("_t", 0.5).alias("_half"))
        state = staged(moments(near.join(half, "_group").where(F.col("_t") <= F.col("_half")), consistency(0.5)), "state")
    last = distances(fit, state).where(F.col("_d") <= chi2_quantile(0.975, DIMS))
    state = staged(moments(last, consistency(0.975)), "state")
    counts = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    judged = distances(fit, state).select(*counts, "base_failed", (F.col("_d") <= chi2_quantile(CUTOFF, DIMS)).alias("kept"), F.round("_d", 6).alias("distance"))
    failed = df.where("base_failed").select(*counts, "base_failed", F.lit(False).alias("kept"), F.lit(None).cast("double").alias("distance"))
    return judged.unionByName(failed)
