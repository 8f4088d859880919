"""Document fingerprints: threshold-scaled sketches of word shingles.

A text is the set of its five-word shingles (lower-cased words; a text of one
to four words is one shingle). Its sketch keeps every shingle hash below a
fixed fraction ``FRACTION`` of the hash range, so the sketch grows with the
text, two sketches can be compared however unequal their texts are, and the
sketch of a union is the union of the sketches. A text none of whose hashes
lies below keeps its least one, so that a short text has a mark too; merging
drops such a mark as soon as a hash below the threshold is there.

``likeness`` estimates the Jaccard similarity of two shingle sets,
``containment`` the share of one set that lies in the other. A kept hash
counts for ``1 / FRACTION`` shingles: the standard error of a likeness j is
about sqrt(j (1 - j) * FRACTION / shingles in either text).

``compare`` gives every document the sketch of its text, that of its text with
the last third replaced by the beginning of the next document, and the
likeness to both. Documents are ordered by descending id (null ids last, equal
ids in the order of the table); the first one follows the last. The order is
found on ids and lengths alone: a range sort, one row of every range for its
border. Each document then sends its neighbour the few characters that it
needs. Both joins want the texts by row number, so one shuffle of them serves
both, and no key gathers rows.

Everything runs in built-in column functions. Edge cases: a null text is
empty; a text without words has an empty sketch, whose likeness is 1 to an
empty sketch and 0 to any other; a document alone is its own next one; repeated
rows are documents of their own; an empty table gives an empty result; columns
other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cargolens.llm.staging import SPACE, staged

SHINGLE = 5
HASH_BITS = 48
#: Share of all shingle hashes that a sketch keeps.
FRACTION = 1 / 8
THRESHOLD = int(FRACTION * (1 << HASH_BITS))
DIGITS = HASH_BITS // 4
EMPTY = "cast(array() as array<bigint>)"


def with_sketch(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the sketch of a text column: ascending shingle hashes.

    Word hashes and shingle hashes are columns of their own: inside one
    expression they would be evaluated anew for every element.
    """
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), SPACE + "+"), lambda w: w != "")
    df = df.withColumn("_words", F.transform(words, lambda w: F.xxhash64(w)))
    starts = F.slice("_words", F.lit(1), F.greatest(F.size("_words") - (SHINGLE - 1), F.lit(1)))
    after = lambda i: [F.get("_words", i + k) for k in range(1, SHINGLE)]  # noqa: E731  (null past the end: not hashed)
    shingles = F.transform(starts, lambda w, i: F.shiftrightunsigned(F.xxhash64(w, *after(i)), 64 - HASH_BITS))
    return df.withColumn("_shingles", shingles).withColumn(name, kept(F.col("_shingles"))).drop("_words", "_shingles")


def kept(hashes: Column) -> Column:
    """The hashes below the threshold, ascending; where there is none, the least one."""
    low = F.array_sort(F.array_distinct(F.filter(hashes, lambda h: h < THRESHOLD)))
    return F.when(F.exists(hashes, lambda h: h < THRESHOLD), low).when(F.size(hashes) > 0, F.array(F.array_min(hashes))).otherwise(F.expr(EMPTY))


def merged(a: Column, b: Column) -> Column:
    """The sketch of the union of two sketched sets."""
    return kept(F.concat(a, b))


def shared(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two sketched sets (0 to 1)."""
    either = F.size(a) + F.size(b) - shared(a, b)
    return F.when(either == 0, 1.0).otherwise(shared(a, b) / either)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the first set that lies in the second (0 to 1)."""
    return F.when(F.size(a) == 0, 1.0).otherwise(shared(a, b) / F.size(a))


def written(sketch: Column) -> Column:
    """A sketch as text: ``DIGITS`` hexadecimal digits a hash."""
    return F.array_join(F.transform(sketch, lambda h: F.lower(F.lpad(F.hex(h), DIGITS, "0"))), "")


def loaded(fingerprint: Column) -> Column:
    """The sketch that ``written`` wrote."""
    parts = F.regexp_extract_all(fingerprint, F.lit(f"[0-9a-f]{{{DIGITS}}}"), F.lit(0))
    return F.transform(parts, lambda p: F.conv(p, 16, 10).cast("long"))


def followers(rows: DataFrame) -> DataFrame:
    """(row, before, doc_before, n_before): for every row of (row, doc_id, n) the
    row that it follows, in descending doc_id, with that row's id and n. The
    first follows the last."""
    one = F.struct("row", "doc_id", "n")
    order = [F.col("doc_id").desc_nulls_last(), F.col("row")]
    ranged = rows.select("row", "doc_id", "n").repartitionByRange(*order).sortWithinPartitions(*order)
    part, place = F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")
    ranged = staged(ranged.select("row", "doc_id", "n", part, place), "order")
    inside = F.lag(one).over(Window.partitionBy("part").orderBy("place"))
    # one row per range: its last document, handed to the next range (and the very last one to the first)
    ends = ranged.groupBy("part").agg(F.max_by(one, "place").alias("last"))
    over_ranges = Window.orderBy("part")
    very_last = F.max_by("last", "part").over(Window.partitionBy())
    ends = ends.select("part", F.coalesce(F.lag("last").over(over_ranges), very_last).alias("border"))
    before = F.coalesce("inside", "border")
    linked = ranged.withColumn("inside", inside).join(ends, "part")
    return linked.select("row", before["row"].alias("before"), before["doc_id"].alias("doc_before"), before["n"].alias("n_before"))


def compare(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next, kept_share (the share of the
    text's shingles that the edited text still holds)."""
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    # written once: the row numbers must be the same in every read
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text)
    rows = staged(rows.withColumn("n", F.char_length("text").cast("long")), "texts", "zstd")
    third = lambda n: F.floor(F.col(n) / 3).cast("int")
    texts = rows.select("row", "text")  # exactly these columns in both joins: one exchange for the two
    given = texts.join(followers(rows), "row")
    given = given.select(
        F.col("before").alias("row"),
        F.col("doc_before").alias("doc_id"),
        F.col("n_before").alias("n"),
        F.substring("text", F.lit(1), third("n_before")).alias("given"),
        "text",
    )
    given = with_sketch(given, "text", "next_sketch").drop("text")
    both = texts.join(given, "row")
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n") - third("n")).cast("int")), F.col("given"))
    both = both.withColumn("edited", edited).drop("given")
    both = with_sketch(with_sketch(both, "text", "sketch"), "edited", "edited_sketch")
    own, new = F.col("sketch"), F.col("edited_sketch")
    return both.select(
        "doc_id",
        F.col("n").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        written(own).alias("fingerprint"),
        written(new).alias("edited_fingerprint"),
        likeness(own, new).alias("near_edited"),
        likeness(own, F.col("next_sketch")).alias("near_next"),
        containment(own, new).alias("kept_share"),
    )
