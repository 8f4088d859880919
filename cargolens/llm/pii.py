"""Personal data: fixed rules, then bootstrapped contextual extraction.

Base rules name e-mail and IP addresses, card and phone numbers. Their
matches are the seed entities. Every word with a digit or an at-sign is an
instance; the two words before it, and the word before with the word after,
are its lexical patterns (all words count, neighbouring instances too; digits
are masked as 0, so numbers in a row give one pattern). Spark then scores the pattern-instance graph in
turns: a pattern is as good as the mean confidence of its instances (shrunk
by ``PRIOR``, and only with ``MIN_SEEDS`` known ones), an instance as the noisy
or of its patterns. After ``ROUNDS`` turns, occurrences of unknown instances
inside a pattern of at least ``MIN_PATTERN`` whose confidence is at least
``MIN_INSTANCE`` become spans of kind ``context``.

Everything runs in built-in column functions and joins. Edge cases: a null
text is empty; without seeds there is no pattern and no context span; repeated
rows are scanned each (their graph edges count once); an empty table gives an
empty result; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens.llm.spans import listed, touches, with_spans
from cargolens.llm.staging import staged

#: Each equals the plain rule; lookbehinds, \G and possessive counts only keep long runs linear.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
#: A word with a digit or an at-sign.
INSTANCE = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
EDGE = r"""[.,;:!?"'()\[\]{}<>|*#$%&]"""
CONTEXT_CHARS = 128
ROUNDS = 3
PRIOR = 2.0
MIN_SEEDS = 3
MIN_PATTERN = 0.6
MIN_INSTANCE = 0.6
SEED_CONFIDENCE = 1.0


def luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total, i):
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.regexp_like(value, F.lit(rf"^{OCTET}(?:\.{OCTET}){{3}}$"))
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def only_valid(df: DataFrame, kind: str) -> DataFrame:
    return df.withColumn(kind, F.filter(kind, lambda s: valid(kind, s["value"])))


def base_spans(docs: DataFrame) -> DataFrame:
    """doc_id, base spans per kind, and ``words``: the instances with their context."""
    df = docs.select(F.col("doc_id").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    for kind, pattern in BASE.items():
        df = with_spans(df, "_text", pattern, kind)
        df = only_valid(df, kind)
    df = with_spans(df, "_text", INSTANCE, "words", keep_gaps=True)
    masked = lambda c: F.translate(F.lower(c), "123456789", "000000000")
    gap = F.col("words_gaps")

    def word(s, i):
        head = F.length(F.regexp_extract(s["value"], rf"^{EDGE}*", 0))
        tail = F.length(F.regexp_extract(s["value"], rf"{EDGE}*$", 0))
        core = F.regexp_replace(F.regexp_replace(s["value"], rf"^{EDGE}*", ""), rf"{EDGE}*$", "")
        # two instances back and one ahead: with the gaps, at least two words before and one after
        near = lambda k: F.coalesce(F.get("words", i + k)["value"], F.lit(""))
        before = [near(-2), F.coalesce(F.get(gap, i - 1), F.lit("")), near(-1), gap[i]]
        left = F.right(F.concat(*[F.right(part, F.lit(CONTEXT_CHARS)) for part in before]), F.lit(CONTEXT_CHARS))
        right = F.left(F.concat(*[F.left(part, F.lit(CONTEXT_CHARS)) for part in (gap[i + 1], near(1))]), F.lit(CONTEXT_CHARS))
        return F.struct(
            (s["start"] + head).alias("start"),
            (s["end"] - tail).alias("end"),
            core.alias("value"),
            masked(F.regexp_extract(left, r"(\S+\s+\S+)\s+$", 1)).alias("left2"),
            masked(F.regexp_extract(left, r"(\S+)\s+$", 1)).alias("left1"),
            masked(F.regexp_extract(right, r"^\s+(\S+)", 1)).alias("right1"),
        )

    df = df.withColumn("words", F.when(F.size("words") > 0, F.transform("words", word)))
    df = df.withColumn("words", F.filter("words", lambda s: s["end"] > s["start"]))
    return df.drop("_text", "words_gaps").withColumn("_row", F.monotonically_increasing_id())


def occurrences(found: DataFrame) -> DataFrame:
    """One row per instance, occurrence and pattern: _row, start, end, instance, pattern, seed."""
    each = found.select("_row", *BASE, F.explode("words").alias("w"))
    seed = touches(F.col("w"), *BASE)
    two = F.when(F.col("w.left2") != "", F.concat(F.lit("2 "), F.regexp_replace("w.left2", r"\s+", " ")))
    around = F.concat(F.lit("1 "), F.col("w.left1"), F.lit(" _ "), F.col("w.right1"))
    around = F.when((F.col("w.left1") != "") & (F.col("w.right1") != ""), around)
    patterns = F.filter(F.array(two, around), lambda p: p.isNotNull())
    return each.select(
        "_row", F.col("w.start").alias("start"), F.col("w.end").alias("end"), F.col("w.value").alias("instance"),
        seed.alias("seed"), F.explode(patterns).alias("pattern"),
    )


def bootstrap(edges: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Scores of patterns and instances from (pattern, instance, seed) edges.

    Scores are rounded, so the order of additions cannot change a decision.
    """
    known = edges.groupBy("instance").agg(F.max(F.col("seed").cast("double")).alias("seeded"))
    scores = staged(known.select("instance", "seeded", (F.col("seeded") * SEED_CONFIDENCE).alias("confidence")), "instances")
    patterns = None
    for _ in range(rounds):
        n_known = F.sum((F.col("confidence") >= MIN_INSTANCE).cast("long"))
        mean = F.round(F.sum("confidence") / (F.count("*") + PRIOR), 6)
        patterns = edges.join(scores, "instance").groupBy("pattern").agg(
            F.when(n_known >= MIN_SEEDS, mean).otherwise(0.0).alias("score")
        )
        patterns = staged(patterns.where("score > 0"), "patterns")
        # noisy or; a score is below 1 because of the prior
        either = F.round(1 - F.exp(F.sum(F.log1p(-F.col("score")))), 6)
        fresh = edges.join(patterns, "pattern").groupBy("instance").agg(either.alias("_or"))
        updated = scores.select("instance", "seeded").join(fresh, "instance", "left").select(
            "instance", "seeded", F.greatest(F.col("seeded") * SEED_CONFIDENCE, F.coalesce("_or", F.lit(0.0))).alias("confidence")
        )
        scores = staged(updated, "instances")
    return patterns, scores


def scan(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id and the spans per kind (email, ip, card, phone, context)."""
    found = staged(base_spans(docs), "personal")
    seen = staged(occurrences(found), "occurrences")
    patterns, scores = bootstrap(seen.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), rounds)
    good = patterns.where(F.col("score") >= MIN_PATTERN).select("pattern")
    sure = scores.where((F.col("seeded") == 0) & (F.col("confidence") >= MIN_INSTANCE)).select("instance")
    new = seen.where(~F.col("seed")).join(good, "pattern", "left_semi").join(sure, "instance", "left_semi")
    span = F.struct("start", "end", F.col("instance").alias("value"))
    new = new.groupBy("_row").agg(F.array_sort(F.collect_set(span)).alias("context"))
    none = F.expr("cast(array() as array<struct<start:int,end:int,value:string>>)")
    return found.join(new, "_row", "left").withColumn("context", F.coalesce("context", none)).drop("_row", "words")


def report(found: DataFrame) -> DataFrame:
    base = listed({k: k for k in BASE})
    every = listed({k: k for k in (*BASE, "context")})
    return found.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(base, 256).alias("base_sha256"),
        every.alias("spans"),
        F.size("context").cast("long").alias("n_context"),
    )
