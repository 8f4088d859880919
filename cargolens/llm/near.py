"""Near-duplicate classes by improved consistent weighted sampling.

A text is a weighted set: its five-word shingles (lower-cased words), weighted
by TF-IDF. Texts are near-duplicates when the weighted Jaccard similarity of
their sets is at least ``SIMILARITY``; classes are the connected components.

Texts with the same words are collapsed first; everything below is about
distinct texts. Document frequencies come from a count-min table of fixed size
over all of them, floored at the share ``RARE``. Both the table's error and the
floor are shares of the corpus, so the weights behave alike at every size, and
what is broadcast is one table of ``2 * WIDTH`` numbers. The floor bounds how
much more a rare shingle weighs than one that a third of the texts hold: the
copies of a text that was edited in many ways stay near-duplicates, though
what they share is common and what was edited is not.

Each text gets ``BANDS * ROWS`` weighted samples (for every sample the element
with the least a = c / (y e^r), after Ioffe). Equal samples in all rows of a
band put texts into one bucket: a pair at 0.8 meets in some bucket with
probability 0.9994.

No bucket is expanded into all pairs. First every member is compared with the
bucket's first one (in an order by hash). What is left lies in the open
buckets, those that hold several classes.

Texts of open buckets that share a rare shingle (one that at most ``HELD`` of
these texts hold) are compared as such. Any other pair has no more in common
than the lesser of both texts' weight in common shingles, so it is similar only
if a's weight is at most b's reach and b's at most a's reach, where a text's
reach is (1 + 1 / SIMILARITY) times its weight in common shingles, less its
weight. This bound leaves out most copies that were edited too much, without
naming their pairs.

After that only strays, members outside the largest class of a bucket, are
compared. A bucket's members are placed by weight, so those that a stray may be
similar to lie in one span; it meets them at growing distances behind it: 1,
then up to 15, up to 127 and so on, round the span. In a group of near copies
most strays find the class in the first rounds; a stray that finds none goes on
until it has met its span, so no pair in a bucket that may be similar stays
uncompared, unless its classes are joined before. Members are found by their
place (a join on bucket and place), so a large bucket is spread over all tasks.
Strays inside the bound that find no class still cost the square of their
number. Pairs that share less than ``MIN_SHARED`` of their samples are not verified (a
pair at 0.8 falls below with probability 1e-6); all others are verified on
their texts.

Edge cases: a null text has no words; texts without words form one class;
texts of one to four words are one shingle; null ids lose to any id as the
class's representative; repeated rows are members of one class; an empty table
gives an empty result; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens.llm.staging import SPACE, arrow_rows, numbered, ranked, staged

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 14
ROWS = 4
SAMPLES = BANDS * ROWS
MIN_SHARED = 0.5
#: By what the distance that a stray has covered grows in a round.
REACH = 8
#: Texts that hold a rare shingle at most: all pairs of them are compared.
HELD = 8
#: Share by which sums of weights may be off.
SLACK = 1e-6
#: Row numbers that are broadcast at most; beyond it, texts are shuffled.
BROADCAST_ROWS = 200_000
#: Links that one task connects at most; beyond it, labels are passed on in Spark.
TASK_LINKS = 200_000
RARE = 0.2
WIDTH = 1 << 19
BLOCK = 1 << 14
ID_BITS = 44
CHUNK = 1 << 15
WORDS_AT_ONCE = 1 << 19
#: Documents in one Arrow batch: long texts in batches of the usual 10,000 rows fill an executor.
BATCH_ROWS = 1024

_C1, _C2, _C3 = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def split_words(text: Column) -> Column:
    """The lower-cased words of a text column."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), SPACE + "+"), lambda w: w != "")


def hashed(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def key_of(words: Column) -> Column:
    """A key that texts share exactly when their lower-cased words are equal."""
    return F.unhex(F.sha2(F.array_join(words, " "), 256))


def shingles(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle id, times) of every distinct shingle, sorted by both.

    ``values`` are word hashes, document i owning offsets[i]:offsets[i + 1].
    """
    v = values.astype(np.int64, copy=False).view(np.uint64)
    lengths = np.diff(offsets)
    doc = np.repeat(np.arange(len(lengths), dtype=np.uint64), lengths)
    left = np.repeat(offsets[1:], lengths) - np.arange(len(v))  # words from here to the text's end
    first = np.arange(len(v)) == np.repeat(offsets[:-1], lengths)
    h = v.copy()
    for k in range(1, SHINGLE):
        h = (h ^ (h >> np.uint64(29))) * _C1
        inside = left > k  # a text that ends earlier is one shorter shingle
        h[: len(v) - k] += np.where(inside[: len(v) - k], v[k:], _C3)
        h[len(v) - k :] += _C3
    starts = (left >= SHINGLE) | first
    h, doc = h[starts], doc[starts]
    h = (h ^ (h >> np.uint64(32))) * _C2
    h ^= h >> np.uint64(29)
    both = np.sort(doc << np.uint64(ID_BITS) | h >> np.uint64(64 - ID_BITS))
    new = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])) if len(both) else np.empty(0, np.int64)
    times = np.diff(np.append(new, len(both)))
    both = both[new]
    return (both >> np.uint64(ID_BITS)).astype(np.int64), both & np.uint64((1 << ID_BITS) - 1), times


def cells(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two places of a shingle in the count-min table."""
    mask = np.uint64(WIDTH - 1)
    return (ids & mask).astype(np.int64), (ids >> np.uint64(20) & mask).astype(np.int64) + WIDTH


def listed(column) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets (from 0) of an Arrow list array without nulls."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    return values, offsets - offsets[0]


def slices(batch, *lists: int):
    """Parts of an Arrow batch whose list columns hold ``WORDS_AT_ONCE`` values
    at most (or one row): a batch of long texts must not fill the memory."""
    import pyarrow.compute as pc

    values = sum(pc.list_value_length(batch.column(i)).to_numpy(zero_copy_only=False) for i in lists)
    ends, a = np.cumsum(values), 0
    while a < batch.num_rows:
        before = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, before + WORDS_AT_ONCE, side="right")))
        yield batch.slice(a, b - a)
        a = b


def document_frequencies(docs: DataFrame) -> np.ndarray:
    """The count-min table over all documents of ``docs``."""

    def count(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        table = np.zeros(2 * WIDTH, np.int64)
        for part in (part for batch in batches for part in slices(batch, 0)):
            _, ids, _ = shingles(*listed(part.column(0)))
            for place in cells(ids):
                table += np.bincount(place, minlength=2 * WIDTH)
        salt = TaskContext.get().partitionId() % 16
        blocks = [b for b in range(2 * WIDTH // BLOCK) if table[b * BLOCK : (b + 1) * BLOCK].any()]
        counts = [zlib.compress(table[b * BLOCK : (b + 1) * BLOCK].astype("<i8").tobytes(), 1) for b in blocks]
        yield pa.RecordBatch.from_arrays(
            [pa.array(blocks, pa.int32()), pa.array([salt] * len(blocks), pa.int32()), pa.array(counts, pa.binary())],
            names=["block", "salt", "counts"],
        )

    def add(frame):
        total = np.zeros(BLOCK, np.int64)
        for c in frame["counts"]:
            total += np.frombuffer(zlib.decompress(c), "<i8")
        return frame.iloc[:1].assign(counts=[zlib.compress(total.tobytes(), 1)])

    schema = "block int, salt int, counts binary"
    parts = docs.select(hashed(split_words(F.col("text")))).mapInArrow(count, schema)
    # first within salts, so that no task adds up the tables of all tasks
    parts = parts.groupBy("block", "salt").applyInPandas(add, schema).groupBy("block").applyInPandas(add, schema)
    table = np.zeros(2 * WIDTH, np.int64)
    for row in parts.collect():  # 2 * WIDTH numbers, whatever the corpus
        table[row["block"] * BLOCK : (row["block"] + 1) * BLOCK] = np.frombuffer(zlib.decompress(row["counts"]), "<i8")
    return table


def idf_table(table: np.ndarray, n: int) -> np.ndarray:
    return np.log1p(n / np.maximum(table, max(1.0, RARE * n))).astype(np.float32)


def weigh(ids: np.ndarray, times: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF; of the two table places the rarer is nearer to the truth."""
    a, b = cells(ids)
    return times * np.maximum(idf[a], idf[b])


_RNG = np.random.default_rng(20)
_R = _RNG.gamma(2, 1, 1 << 16).astype(np.float32)
_LN_C = np.log(_RNG.gamma(2, 1, 1 << 16)).astype(np.float32)
_SEEDS = _RNG.integers(1, 1 << 63, SAMPLES).astype(np.uint64) | np.uint64(1)


_PLACE = np.arange(1 << 20, dtype=np.uint64)


def draw(ids: np.ndarray, ln_w: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """Fingerprints of sample k of the weighted sets that begin at ``starts``.

    ln a lies far above -64, so ln a + 64 is a positive float, whose bits sort
    as an integer; the place of the element below them names the least one.
    """
    u = ids * _SEEDS[k]
    u ^= u >> np.uint64(31)
    u *= _C2
    r = _R.take((u >> np.uint64(48)).view(np.int64))
    t = (u >> np.uint64(16) & np.uint64(0xFFFF)).astype(np.float32)
    t += np.float32(0.5)
    t *= np.float32(1 / (1 << 16))
    beta = t.copy()
    t += ln_w / r
    np.floor(t, out=t)
    beta -= t
    beta -= np.float32(1)  # -(t - beta + 1)
    beta *= r
    beta += _LN_C.take((u >> np.uint64(32) & np.uint64(0xFFFF)).view(np.int64))
    beta += np.float32(64)
    order = beta.view(np.uint32).astype(np.uint64)
    order <<= np.uint64(32)
    order |= _PLACE[: len(ids)] if len(ids) <= len(_PLACE) else np.arange(len(ids), dtype=np.uint64)
    least = (np.minimum.reduceat(order, starts) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    mark = (ids[least] ^ t[least].astype(np.int64).view(np.uint64) * _C3) * _C1
    return (mark >> np.uint64(32)).astype(np.uint32)


def sign(doc: np.ndarray, ids: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """(n, SAMPLES) sample fingerprints; documents without elements get zeros."""
    out = np.zeros((n, SAMPLES), np.uint32)
    ln_w = np.log(weights).astype(np.float32)
    starts = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.empty(0, np.int64)
    at = 0
    while at < len(starts):  # some documents at a time, so that the arrays stay in the cache
        to = max(at + 1, int(np.searchsorted(starts, starts[at] + CHUNK)))
        a, b = starts[at], starts[to] if to < len(starts) else len(doc)
        for k in range(SAMPLES):
            out[doc[starts[at:to]], k] = draw(ids[a:b], ln_w[a:b], starts[at:to] - a, k)
        at = to
    return out


def bands_of(signs: np.ndarray) -> np.ndarray:
    """(n, BANDS) hashes of the bands."""
    h = np.zeros((len(signs), BANDS), np.uint64)
    for r in range(ROWS):
        h = (h ^ (h >> np.uint64(30))) * _C2 + signs[:, r::ROWS].astype(np.uint64)
    return ((h ^ (h >> np.uint64(31))) * _C3).view(np.int64)


def signatures(docs: DataFrame, idf) -> DataFrame:
    """row, signs array<int>, bands array<long> of (row, text); texts without words are left out."""

    def compute(batches):
        import pyarrow as pa

        for part in (part for batch in batches for part in slices(batch, 1)):
            values, offsets = listed(part.column(1))
            doc, ids, times = shingles(values, offsets)
            n = part.num_rows
            signs = sign(doc, ids, weigh(ids, times, idf.value), n)
            some = np.diff(offsets) > 0
            keep = np.arange(some.sum() + 1)
            columns = [
                pa.ListArray.from_arrays(pa.array(keep * width, pa.int32()), pa.array(flat[some].ravel(), kind))
                for flat, width, kind in ((signs.view(np.int32), SAMPLES, pa.int32()), (bands_of(signs), BANDS, pa.int64()))
            ]
            rows = part.column(0).filter(pa.array(some))
            yield pa.RecordBatch.from_arrays([rows, *columns], names=["row", "signs", "bands"])

    words = hashed(split_words(F.col("text"))).alias("h")
    return docs.select("row", words).mapInArrow(compute, "row long, signs array<int>, bands array<bigint>")


def similarities(a, b, idf: np.ndarray) -> np.ndarray:
    """Weighted Jaccard similarity of the texts at each place of two Arrow lists of words."""
    sides = []
    for column in (a, b):
        doc, ids, times = shingles(*listed(column))
        sides.append((doc.astype(np.uint64) << np.uint64(ID_BITS) | ids, weigh(ids, times, idf).astype(np.float64), doc))
    (ka, wa, da), (kb, wb, db) = sides
    _, ia, ib = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
    n = len(a)
    low = np.bincount(da[ia], np.minimum(wa[ia], wb[ib]), n)
    total = np.bincount(da, wa, n) + np.bincount(db, wb, n)
    return low / np.maximum(total - low, 1e-9)


def weighted(texts: DataFrame, idf) -> DataFrame:
    """(row, shingle, weight) of all distinct shingles of (row, text)."""

    def compute(batches):
        import pyarrow as pa

        for part in (part for batch in batches for part in slices(batch, 1)):
            doc, ids, times = shingles(*listed(part.column(1)))
            columns = [part.column(0).take(pa.array(doc)), pa.array(ids.view(np.int64)), pa.array(weigh(ids, times, idf.value), pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "shingle", "weight"])

    words = hashed(split_words(F.col("text"))).alias("h")
    return texts.select("row", words).mapInArrow(compute, "row long, shingle long, weight double")


def rare_pairs_and_reaches(texts: DataFrame, idf, similarity: float) -> tuple[DataFrame, DataFrame]:
    """(a, b), a < b, of the texts that share a rare shingle, and (row, weight,
    reach) of all: other pairs are similar only if each one's weight is within
    the other's reach."""
    weights = staged(weighted(texts, idf), "weights")
    held = staged(weights.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1"), "held")
    rare = weights.join(held.where(F.col("n") <= HELD).select("shingle"), "shingle").groupBy("shingle").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    firsts = rare.select("rows").distinct().select("rows", F.posexplode("rows").alias("at", "a"))
    pairs = firsts.select("a", F.explode(F.slice("rows", F.col("at") + 2, HELD)).alias("b")).distinct()

    common = weights.join(held.where(F.col("n") > HELD).select("shingle"), "shingle", "left_semi").groupBy("row").agg(F.sum("weight").alias("common"))
    whole = weights.groupBy("row").agg(F.sum("weight").alias("weight")).join(common, "row", "left")
    reach = (1 + 1 / max(similarity, 1e-9)) * F.coalesce("common", F.lit(0.0)) - F.col("weight")
    # rounded sums must not lose a pair
    return pairs, staged(whole.select("row", "weight", (reach + SLACK * F.col("weight")).alias("reach")), "reaches")


def spans(members: DataFrame, similarity: float) -> DataFrame:
    """(bucket, row, idx, low, width): a member's place by weight in its bucket,
    and where the members whose weights lie within its reach begin and how many there are."""
    own = members.select("bucket", "row", F.col("weight").alias("at"), F.lit(1).alias("kind"))
    low = members.select("bucket", "row", (F.col("weight") * (similarity - SLACK)).alias("at"), F.lit(0).alias("kind"))
    high = members.select("bucket", "row", F.col("reach").alias("at"), F.lit(2).alias("kind"))

    def places(rows: DataFrame, name: str) -> DataFrame:
        rows = ranked(rows.withColumn("order", F.xxhash64("row")), "bucket", ["at", "kind", "order", "row"])
        return rows.select("bucket", "row", "kind", F.col("idx").alias(name))

    # members before a limit: its place among members and limits, less that among limits
    limits = low.unionByName(high)
    alone = places(own, "alone").unionByName(places(limits, "alone"))
    both = places(own.unionByName(limits), "among").join(alone, ["bucket", "row", "kind"])
    at = lambda kind, value: F.max(F.when(F.col("kind") == kind, value))
    before = F.col("among") - F.col("alone")
    found = both.groupBy("bucket", "row").agg(at(1, F.col("alone")).alias("idx"), at(0, before).alias("low"), at(2, before).alias("high"))
    return found.select("bucket", "row", "idx", "low", F.greatest(F.col("high") - F.col("low"), F.lit(0)).alias("width"))


def verified(pairs: DataFrame, texts: DataFrame, idf, similarity: float) -> DataFrame:
    """The pairs (a, b, label_a, label_b) that are similar; ``texts`` has (row, text)."""
    names = ["a", "b", "label_a", "label_b"]

    def compare(batches):
        import pyarrow as pa

        for part in (part for batch in batches for part in slices(batch, 4, 5)):
            similar = similarities(part.column(4), part.column(5), idf.value) >= similarity
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(similar)) for c in part.columns[:4]], names=names)

    one, two = (texts.select(F.col("row").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab")
    both = pairs.join(one, "a").join(two, "b")
    both = both.select(*names, *[hashed(split_words(F.col(t))).alias(t) for t in ("text_a", "text_b")])
    return both.mapInArrow(compare, ", ".join(f"{c} long" for c in names))


def connect(batches):
    """(row, label) of the rows of (a, b) batches, by union-find."""
    import pyarrow as pa

    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while parent.setdefault(root, root) != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            low, high = sorted((find(a), find(b)))
            parent[high] = low  # the least row of a component stays its root
    rows = list(parent)
    columns = [pa.array(rows, pa.int64()), pa.array([find(x) for x in rows], pa.int64())]
    yield pa.RecordBatch.from_arrays(columns, names=["row", "label"])


def components(edges: DataFrame) -> DataFrame:
    """(row, label) of all rows with an edge: label is the least row of the component.

    Few links are connected in one task. Beyond ``TASK_LINKS`` labels take the
    least label around them and then their label's label, until nothing
    changes; each turn is a written table.
    """
    edges = staged(edges.select("a", "b").distinct(), "edges")
    if edges.count() <= TASK_LINKS:
        return staged(edges.coalesce(1).mapInArrow(connect, "row long, label long"), "labels")
    both = staged(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    now = staged(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).withColumnRenamed("a", "row"), "labels")
    while True:
        around = both.join(now, F.col("b") == F.col("row")).groupBy("a").agg(F.min("label").alias("near"))
        step = now.join(around, F.col("row") == F.col("a")).select("row", "label", F.least("label", "near").alias("next"))
        jump = now.select(F.col("row").alias("_r"), F.col("label").alias("_to"))
        step = step.join(jump, F.col("next") == F.col("_r")).select("row", "label", F.least("next", "_to").alias("next"))
        step = staged(step, "labels")
        now = step.select("row", F.col("next").alias("label"))
        if step.where("next <> label").isEmpty():
            return now


def classes(docs: DataFrame, row: str | None = None, similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, class_id (its representative's id), class_size, kept
    (and ``row``, the given row number column).

    Exactly one document of each class is kept, one with the least id.
    """
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        return _classes(docs, row, similarity)


def without(rows: DataFrame, others: DataFrame) -> DataFrame:
    """The rows whose number is not among ``others`` (row)."""
    return rows.join(F.broadcast(others) if others.count() <= BROADCAST_ROWS else others, "row", "left_anti")


def _classes(docs: DataFrame, row: str | None, similarity: float) -> DataFrame:
    spark = docs.sparkSession
    number = F.col(row) if row else F.monotonically_increasing_id()
    base = docs.select(number.alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    if not row:  # the numbers must be the same in every read
        base = staged(base, "documents", "zstd")

    # texts with the same words are one node, named by the row of its best document
    keyed = staged(base.select("row", "doc_id", key_of(split_words(F.col("text"))).alias("key")), "keys")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("best")
    nodes = staged(keyed.groupBy("key").agg(best, F.count("*").alias("n")).select("key", "n", "best.no_id", "best.doc_id", F.col("best.row").alias("node")), "nodes")
    copies = staged(keyed.select("row").join(nodes.select(F.col("node").alias("row")), "row", "left_anti"), "copies")
    distinct = without(base.select("row", "text"), copies)
    idf = spark.sparkContext.broadcast(idf_table(document_frequencies(distinct), nodes.count()))
    node_signs = staged(signatures(distinct, idf), "signatures")
    labels = merged_labels(node_signs, base.select("row", "text"), idf, similarity)

    # back to documents: node -> class, class -> its best document
    placed = nodes.join(labels, F.col("node") == F.col("row"), "left").withColumn("label", F.coalesce("label", "node"))
    placed = staged(placed.select("key", "n", "no_id", "doc_id", "node", "label"), "placed")
    whole = placed.groupBy("label").agg(F.min(F.struct("no_id", "doc_id", "node")).alias("best"), F.sum("n").alias("class_size"))
    by_key = staged(placed.select("key", "label").join(whole, "label").select("key", "best", "class_size"), "by_key")
    out = keyed.join(by_key, "key")
    columns = ["doc_id", F.col("best.doc_id").alias("class_id"), "class_size", (F.col("row") == F.col("best.node")).alias("kept")]
    return out.select(*columns, *([F.col("row").alias(row)] if row else []))


def merged_labels(node_signs: DataFrame, texts: DataFrame, idf, similarity: float) -> DataFrame:
    """(row, label) of all nodes that are similar to another: equal labels, one class."""
    spark = node_signs.sparkSession
    order = F.xxhash64("row")
    named = F.transform("bands", lambda h, i: F.xxhash64(i, h))  # a bucket is a band and its hash
    slots = node_signs.select("row", F.explode(named).alias("bucket"))
    buckets = slots.groupBy("bucket").agg(F.count("*").alias("n"), F.min_by("row", F.struct(order, "row")).alias("first")).where("n > 1")
    members = staged(slots.join(buckets.drop("n"), "bucket"), "members")
    candidates = staged(members.select("row").distinct(), "candidates")
    many = candidates.count() > BROADCAST_ROWS
    texts = staged(texts.join(candidates if many else F.broadcast(candidates), "row", "left_semi"), "texts", "zstd")

    shared = F.aggregate(F.zip_with("signs_a", "signs_b", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)

    def similar(pairs: DataFrame) -> DataFrame:
        """The similar ones of (a, b, label_a, label_b)."""
        pairs = staged(pairs, "met").distinct()  # written first: a skewed join is dealt anew only at its end
        one, two = (node_signs.select(F.col("row").alias(c), F.col("signs").alias(f"signs_{c}")) for c in "ab")
        likely = pairs.join(one, "a").join(two, "b").where(shared >= int(MIN_SHARED * SAMPLES))
        likely = staged(likely.select("a", "b", "label_a", "label_b"), "pairs")
        return staged(verified(likely, texts, idf, similarity), "similar")

    apart = members.where("row <> first").select(F.least("row", "first").alias("a"), F.greatest("row", "first").alias("b"))
    found = similar(apart.select("a", "b", F.col("a").alias("label_a"), F.col("b").alias("label_b")))
    labels = merge(spark.createDataFrame([], "row long, label long"), found)

    open_ = in_buckets(members, labels)
    if open_.isEmpty():
        return labels
    rows = staged(open_.select("row").distinct(), "open_rows")
    many = rows.count() > BROADCAST_ROWS
    pairs, reaches = rare_pairs_and_reaches(texts.join(rows if many else F.broadcast(rows), "row", "left_semi"), idf, similarity)
    for c in "ab":
        of = labels.select(F.col("row").alias(c), F.col("label").alias(f"label_{c}"))
        pairs = pairs.join(of, c, "left").withColumn(f"label_{c}", F.coalesce(f"label_{c}", c))
    labels = merge(labels, similar(pairs.where("label_a <> label_b").select("a", "b", "label_a", "label_b")))

    # the first one has met all; who has nobody within reach meets none
    live = in_buckets(open_.where("row <> first").select("bucket", "row"), labels).join(reaches, "row")
    ends = live.groupBy("bucket").agg(F.min("weight").alias("least"), F.max("reach").alias("most"))
    live = live.join(ends, "bucket").where("reach >= least and weight <= most").drop("label", "largest", "least", "most")
    live = staged(live, "live")
    state = live.join(spans(live, similarity), ["bucket", "row"]).withColumn("next", F.lit(1).cast("long"))
    state = in_buckets(state, labels)  # ``next``: the least distance not yet covered
    while True:
        stray = (F.col("label") != F.col("largest")) & (F.col("next") <= F.col("width"))
        until = F.least(F.when(F.col("next") == 1, 2).otherwise(F.col("next") * REACH), F.col("width") + 1)
        strays = state.where(stray)
        if strays.isEmpty():
            return labels
        far = strays.select("bucket", "idx", "low", "width", F.col("row").alias("a"), F.col("label").alias("label_a"), F.col("weight").alias("weight_a"), F.explode(F.sequence("next", until - 1)).alias("far"))
        far = far.withColumn("idx", F.col("low") + (F.col("idx") - F.col("low") + F.col("far")) % F.col("width")).drop("low", "width", "far")
        pairs = far.join(state.select("bucket", "idx", F.col("row").alias("b"), F.col("label").alias("label_b"), "reach"), ["bucket", "idx"])
        turned = F.col("a") > F.col("b")
        swap = lambda x, y: F.when(turned, F.col(y)).otherwise(F.col(x)).alias(x)
        pairs = pairs.where("label_a <> label_b and weight_a <= reach").select(swap("a", "b"), swap("b", "a"), swap("label_a", "label_b"), swap("label_b", "label_a"))
        found = similar(pairs)
        state = state.withColumn("next", F.when(stray, until).otherwise(F.col("next"))).drop("label", "largest")
        labels = merge(labels, found)
        state = in_buckets(state, labels)


def in_buckets(state: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of all buckets that hold several classes, with their label and
    the label of the bucket's largest class."""
    here = state.join(labels, "row", "left").withColumn("label", F.coalesce("label", "row"))
    here = staged(here, "here")
    sizes = here.groupBy("bucket", "label").count()
    largest = sizes.groupBy("bucket").agg(F.max_by("label", F.struct("count", -F.col("label"))).alias("largest"), F.count("*").alias("labels"))
    return staged(here.join(largest.where("labels > 1").drop("labels"), "bucket"), "open")


def merge(labels: DataFrame, found: DataFrame) -> DataFrame:
    """Labels (row, label) after joining the classes of the pairs found: only
    the classes are connected anew, not their members."""
    if found.isEmpty():
        return labels
    joined = components(found.select(F.col("label_a").alias("a"), F.col("label_b").alias("b")))
    joined = joined.select(F.col("row").alias("old"), F.col("label").alias("new"))
    moved = labels.join(joined, F.col("label") == F.col("old"), "left").select("row", F.coalesce("new", "label").alias("label"))
    alone = joined.join(labels, F.col("old") == F.col("row"), "left_anti").select(F.col("old").alias("row"), F.col("new").alias("label"))
    return staged(moved.unionByName(alone), "labels")


def distinct_documents(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each class, with all its columns."""
    rows, row = numbered(docs, "documents")
    dropped = classes(rows, row, similarity).where(~F.col("kept")).select(row)
    return rows.join(dropped, row, "left_anti").select(*docs.columns)
