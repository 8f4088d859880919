"""Secret scan: fixed rules, then character Markov models.

Base rules name assignments, access keys and long hexadecimal runs. Then
every long run of key characters that no base span touches is scored by
character Markov models: one of ordinary identifiers, and one of random
strings for each alphabet in ``CLASSES``. A run's score in a class is the mean
log-likelihood ratio of its character pairs; runs above the threshold of any
class become spans of kind ``markov``.

The random model of a class is trained from ``DRAWN`` random strings of its
alphabet, drawn here with a fixed seed (``drawn``), and from the secrets that
the base rules found, each in the narrowest class that holds it: what the base
rules know does not limit the alphabets that are found. Ordinary are the long
runs of letters, digits and signs that no rule touches. A corpus sample holds
at most ``SAMPLE`` different strings, those with the least hashes.

Thresholds come from the ordinary runs: the larger of ``MARGIN`` and the score
that only the share ``FALSE`` of them exceeds. The ordinary sample may hold
secrets that no rule knows, so runs whose score is nearer to the median of the
drawn strings than to that of the ordinary runs are set aside first.

Everything runs in built-in column functions. Edge cases: a null text is
empty; without any ordinary run there is nothing to score and no markov span;
repeated rows are scanned each; an empty table gives an empty result; columns
other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import base64
import math
import random
from collections import Counter
from string import ascii_lowercase, ascii_uppercase, digits

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens.llm.spans import listed, touches, with_spans
from cargolens.llm.staging import staged

KEYWORD = r"(?i:password|passwd|secret|token|api_?key)"
ASSIGN_HEAD = KEYWORD + r"""["']?\x20*[:=]\x20*["']?"""
#: Each equals the plain rule; lookbehinds and possessive counts only keep long runs linear.
BASE = {
    "assign": ASSIGN_HEAD + r"[A-Za-z0-9+/_.=-]++",
    "access": r"AKIA[A-Z0-9]{16,}+",
    "hex": r"(?<![0-9a-f])[0-9a-f]{24,}+",
}
MIN_ASSIGNED = 6
RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}+"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
SAMPLE = 20_000
#: Alphabets of random strings, narrow ones first.
CLASSES = {
    "hex": digits + "abcdef",
    "upper_hex": digits + "ABCDEF",
    "lower": ascii_lowercase + digits,
    "upper": ascii_uppercase + digits,
    "base62": ascii_lowercase + ascii_uppercase + digits,
    "base64": ascii_lowercase + ascii_uppercase + digits + "+/=",
    "base64url": ascii_lowercase + ascii_uppercase + digits + "-_=",
}
DRAWN = 1000
DRAWN_LENGTHS = (20, 64)
#: Weight, in characters, of the plain character shares in each line of the ordinary model.
BACKOFF = 16
MARGIN = 0.5
FALSE = 0.001


def base_spans(docs: DataFrame) -> DataFrame:
    """doc_id, the base spans per kind, and candidate runs that touch none of them."""
    df = docs.select(F.col("doc_id").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    for kind, pattern in BASE.items():
        df = with_spans(df, "_text", pattern, kind)
    value = lambda s: F.regexp_replace(s["value"], "^" + ASSIGN_HEAD, "")
    df = df.withColumn("assign", F.filter("assign", lambda s: F.length(value(s)) >= MIN_ASSIGNED))
    df = with_spans(df, "_text", RUN, "runs")
    df = df.withColumn("runs", F.filter("runs", lambda s: ~touches(s, *BASE)))
    return df.drop("_text")


def pair_ids(value: Column) -> Column:
    places = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    size, steps = len(ALPHABET), F.greatest(F.length(value) - 1, F.lit(0))
    return F.zip_with(F.slice(places, F.lit(1), steps), F.slice(places, F.lit(2), steps), lambda a, b: a * size + b)


def sample(values: DataFrame, most: int) -> DataFrame:
    """At most ``most`` different strings, those with the least hashes."""
    known = values.where(F.length("value") > 1).distinct()
    return known.orderBy(F.xxhash64("value"), "value").limit(most)


def drawn() -> dict[str, list[str]]:
    """The labelled random strings of every class, the same in every run.

    The base64 classes are encoded random bytes, with their padding.
    """
    source = random.Random(20_000)
    length = lambda: source.randint(*DRAWN_LENGTHS)
    encode = {"base64": base64.b64encode, "base64url": base64.urlsafe_b64encode}
    return {
        name: [
            encode[name](source.randbytes(length() * 3 // 4)).decode() if name in encode else "".join(source.choices(letters, k=length()))
            for _ in range(DRAWN)
        ]
        for name, letters in CLASSES.items()
    }


def pairs_of(value: str) -> list[int]:
    """``pair_ids`` of a string on the driver."""
    places = [ALPHABET.index(c) for c in value]
    return [a * len(ALPHABET) + b for a, b in zip(places, places[1:])]


def class_of(value: Column) -> Column:
    """The narrowest class that holds the string; null where none does."""
    name = F.lit(None).cast("string")
    for k, letters in reversed(CLASSES.items()):
        name = F.when(F.translate(value, letters, "") == "", k).otherwise(name)
    return name


def conditional(counts: Counter, backoff: int = 0) -> list[float]:
    """Log-probabilities of the next character (a square table) from pair
    counts: add-one smoothed, or less one and mixed with ``backoff`` of the
    character shares (a run does not vouch for its own pairs)."""
    size = len(ALPHABET)
    table = [[counts[a * size + b] for b in range(size)] for a in range(size)]
    shares = [size * (1 + sum(column)) / (size + counts.total()) for column in zip(*table)] if backoff else [1] * size
    weight, own = (backoff / size, 1) if backoff else (1, 0)
    table = [[max(0, n - own) + weight * share for n, share in zip(line, shares)] for line in table]
    return [math.log(n / sum(line)) for line in table for n in line]


class Models:
    """The ratio table and the threshold of every class."""

    def __init__(self, ratios: list[list[float]], thresholds: list[float]):
        self.ratios, self.thresholds = [[round(x, 6) for x in r] for r in ratios], thresholds

    def scores(self, pairs: Column) -> Column:
        """Mean log-likelihood ratio of random against ordinary, per class."""
        # a foldable literal of fixed size, parsed once by the optimizer
        tables = F.from_json(F.lit(str(self.ratios)), "array<array<double>>")
        total = lambda t: F.aggregate(pairs, F.lit(0.0), lambda a, p: a + F.element_at(t, p + 1))
        return F.transform(tables, lambda t: total(t) / F.size(pairs))

    def above(self, pairs: Column) -> Column:
        limits = F.array(*[F.lit(x) for x in self.thresholds])
        return F.exists(F.zip_with(self.scores(pairs), limits, lambda s, x: s > x), lambda hit: hit)


def fit(found: DataFrame, most: int = SAMPLE) -> Models | None:
    """Models from the scanned documents; None where there is no run to score."""
    runs = found.select(F.explode(F.transform("runs", lambda s: s["value"])).alias("value"))
    ordinary = staged(sample(runs, most).select(pair_ids(F.col("value")).alias("pairs")), "ordinary")
    if ordinary.isEmpty():
        return None
    head = "^" + ASSIGN_HEAD
    clean = lambda s: F.regexp_replace(F.regexp_replace(s["value"], head, ""), r"[^A-Za-z0-9+/_=-]", "")
    secrets = found.select(F.explode(F.concat(*[F.transform(k, clean) for k in BASE])).alias("value"))
    # the class is written before the pairs unfold: beside explode it would be evaluated for every pair
    labelled = staged(sample(secrets, most).select(class_of(F.col("value")).alias("class"), pair_ids(F.col("value")).alias("pairs")), "labelled")
    labelled = labelled.where("class is not null").select("class", F.explode("pairs").alias("pair"))
    strings = drawn()
    counts = {k: Counter(p for v in strings[k] for p in pairs_of(v)) for k in CLASSES}
    for row in labelled.groupBy("class", "pair").count().collect():  # one row per class and character pair at most
        counts[row["class"]][row["pair"]] += row["count"]
    usual = Counter({row["pair"]: row["count"] for row in ordinary.select(F.explode(F.array_distinct("pairs")).alias("pair")).groupBy("pair").count().collect()})
    usual = conditional(usual, BACKOFF)
    models = Models([[a - b for a, b in zip(conditional(counts[k]), usual, strict=True)] for k in CLASSES], [MARGIN] * len(CLASSES))
    scored, limits = staged(ordinary.select(models.scores(F.col("pairs")).alias("s")), "scores"), []
    centres = scored.agg(*[F.percentile(F.col("s")[i], 0.5) for i in range(len(CLASSES))]).first()
    for i, (k, ratio) in enumerate(zip(CLASSES, models.ratios, strict=True)):
        reached = sorted(sum(ratio[p] for p in pairs_of(v)) / (len(v) - 1) for v in strings[k])
        between = (centres[i] + reached[len(reached) // 2]) / 2
        below = F.when(F.col("s")[i] < between, F.col("s")[i])
        limits.append(F.percentile(below, 1 - FALSE).alias(k))
    models.thresholds = [MARGIN if x is None else max(MARGIN, x) for x in scored.agg(*limits).first()]
    return models


def scan(docs: DataFrame, most: int = SAMPLE) -> DataFrame:
    """doc_id and the spans per kind (assign, access, hex, markov): start, end, value."""
    found = staged(base_spans(docs), "secrets")
    models = fit(found, most)
    if models is None:
        return found.withColumn("markov", F.filter("runs", lambda s: F.lit(False))).drop("runs")
    paired = F.transform("runs", lambda s: F.struct(s.alias("span"), pair_ids(s["value"]).alias("pairs")))
    above = F.filter(paired, lambda x: models.above(x["pairs"]))
    return found.withColumn("markov", F.transform(above, lambda x: x["span"])).drop("runs")


def report(found: DataFrame) -> DataFrame:
    base = listed({k: k for k in BASE})
    every = listed({k: k for k in (*BASE, "markov")})
    return found.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(base, 256).alias("base_sha256"),
        every.alias("spans"),
        F.size("markov").cast("long").alias("n_markov"),
    )
