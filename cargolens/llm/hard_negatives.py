"""Hard negatives for contrastive training, by slot-decomposed selection.

Vectors are compared by integer inner products. Every ``every``-th row is an
anchor; its positives are its ``positives`` best other rows of the same label.
For each positive of score p, the negatives wanted are the ``negatives`` best
rows of another label whose score s lies in a window below it:
``low * p <= 100 * s <= high * p``.

An anchor's windows overlap, so they are not searched one by one. Their upper
limits (descending, as the positives are) split the scores into disjoint
slots: slot j holds the scores above the limit of positive j + 1 and not above
that of positive j. A task keeps the best rows of every slot while it reads
(the combiner), the tasks' bests meet in one group per anchor and slot, and
merging slots from the last to the first gives, for each j, the best rows not
above limit j: window j is what of them lies at or above its lower limit.

The anchors are a stated query set that is met with all rows in blocks. A
block holds at most ``BLOCK_VALUES`` vector components, which bounds what is
broadcast and what the driver holds; inside a task, ``TILE`` products at a time. Nothing
is grouped by label, so a label that holds a third of all rows is spread like
any other. Each block's result is written, so a lost executor costs one block.

Products are exact: in double precision while every sum stays below 2^53, else
in 64-bit and, beyond that, in unbounded integers (scores that do not fit a
long then end at its limits; so do components).

Edge cases: rows with a null id, label or vector, or with a null or not finite
component take no part; shorter vectors count as filled up with zeros; repeated
rows are rows of their own (a copy of the anchor can be its positive); an
anchor without positives or without negatives gives no row; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cargolens.llm.staging import staged
from cargolens.session import scratch_path

EVERY = 50
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95
SCALE = 256
BLOCK_VALUES = 1 << 20
TILE = 1 << 20
LIMIT = (1 << 63) - 1


def usable(rows: DataFrame) -> DataFrame:
    """(row, vec_id, label, q): the rows that take part, with integer components."""
    x = F.transform(F.col("embedding"), lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    good = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
    label = F.col("label").cast("long")
    return rows.where(good & ~F.coalesce(bad, F.lit(False))).select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("long").alias("vec_id"),
        label.alias("label"),
        F.transform(x, lambda v: F.floor(v * SCALE).cast("long")).alias("q"),
    )


def relabelled(rows: DataFrame) -> DataFrame:
    """Where vec_id is divisible by 7, the label is the next of ten."""
    label = F.col("label").cast("long")
    return rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))


def blocks(rows: DataFrame, every: int, values: int) -> tuple[DataFrame, int]:
    """The anchors with their block number, and how many blocks there are.

    Anchors are numbered through: a task's first number is the count of the
    anchors of earlier tasks.
    """
    anchors = rows.where(F.col("vec_id") % every == 0)
    part, place = F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")
    anchors = staged(anchors.select("*", part, place), "anchors")
    found = anchors.agg(F.count("*"), F.max(F.size("q"))).first()
    size = max(1, values // max(1, found[1] or 1))
    parts = anchors.groupBy("part").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over tasks, not rows
    parts = parts.select("part", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))
    number = F.col("place") - F.col("first") + F.col("earlier")
    anchors = anchors.join(parts, "part").withColumn("block", F.floor(number / size).cast("long"))
    return staged(anchors.select("row", "vec_id", "label", "q", "block"), "blocks"), -(-found[0] // size)


def matrix(lists, width: int) -> np.ndarray:
    """Vectors as the lines of an int64 matrix, filled up or cut to ``width``."""
    out = np.zeros((len(lists), width), np.int64)
    for i, v in enumerate(lists):
        n = min(width, len(v))
        out[i, :n] = v[:n]
    return out


def matrix_of(column, width: int) -> np.ndarray:
    """``matrix`` of an Arrow list column, without a loop where all have one length."""
    offsets = column.offsets.to_numpy()
    lengths = np.diff(offsets)
    values = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    if len(lengths) and (lengths == lengths[0]).all():
        full = values.reshape(len(lengths), -1)
        if full.shape[1] >= width:
            return full[:, :width]
        return np.pad(full, ((0, 0), (0, width - full.shape[1])))
    return matrix([values[a - offsets[0] : b - offsets[0]] for a, b in zip(offsets[:-1], offsets[1:])], width)


def largest(a: np.ndarray) -> int:
    return max(abs(int(a.min(initial=0))), abs(int(a.max(initial=0))))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the lines of a and b, as int64."""
    bound = largest(a) * largest(b) * max(1, a.shape[1])
    if bound < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound < 1 << 63:
        return a @ b.T
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -LIMIT - 1, LIMIT).astype(np.int64)


class Best:
    """The ``k`` best rows of each of ``n`` groups: highest score, then least id, then row."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.group = np.empty(0, np.int64)
        self.score, self.id, self.row = (np.empty(0, np.int64) for _ in range(3))
        # what a row must reach to enter a group that is full
        self.need = np.full(n, np.iinfo(np.int64).min)
        self.need_id = np.full(n, np.iinfo(np.int64).max)

    def may_enter(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> np.ndarray:
        need = self.need[group]
        return (score > need) | ((score == need) & (ids <= self.need_id[group]))

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        group, score = np.concatenate([self.group, group]), np.concatenate([self.score, score])
        ids, rows = np.concatenate([self.id, ids]), np.concatenate([self.row, rows])
        # ~score descends where score ascends, and cannot overflow
        order = np.lexsort((rows, ids, ~score, group))
        group = group[order]
        first = np.searchsorted(group, group, side="left")
        place = np.arange(len(group)) - first
        best = order[place < self.k]
        self.group, self.score, self.id, self.row = group[place < self.k], score[best], ids[best], rows[best]
        last = np.flatnonzero(place == self.k - 1)
        self.need[group[last]] = score[order[last]]
        self.need_id[group[last]] = ids[order[last]]


def best_rows(rows: DataFrame, block, k: int, groups_of, groups: int) -> DataFrame:
    """The k best rows of each group of each anchor: anchor, slot, score, vec_id, row.

    ``block`` is the broadcast block; ``groups_of(block, scores, labels, rows)``
    numbers the group of every product, -1 for none. Tasks keep their bests,
    and so does the shuffle's sending side (a rank filter is applied before it).
    """

    def keep(batches):
        import pyarrow as pa

        anchors = block.value
        best = Best(len(anchors["row"]) * groups, k)
        step = max(1, TILE // max(1, len(anchors["row"])))
        lines = np.arange(len(anchors["row"]))[:, None]
        for batch in batches:
            row, ids, labels = (batch.column(i).to_numpy() for i in range(3))
            q = matrix_of(batch.column(3), anchors["q"].shape[1])
            for at in range(0, len(row), step):
                part = slice(at, at + step)
                scores = products(anchors["q"], q[part])
                slot = groups_of(anchors, scores, labels[part], row[part])
                a, b = np.nonzero(slot >= 0)
                group, score = lines[a, 0] * groups + slot[a, b], scores[a, b]
                enters = best.may_enter(group, score, ids[part][b])
                if enters.any():
                    best.add(group[enters], score[enters], ids[part][b[enters]], row[part][b[enters]])
        columns = [anchors["row"][best.group // groups], best.group % groups, best.score, best.id, best.row]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["anchor", "slot", "score", "vec_id", "row"])

    found = rows.select("row", "vec_id", "label", "q").mapInArrow(keep, "anchor long, slot long, score long, vec_id long, row long")
    order = Window.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), "vec_id", "row")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def same_label(anchors, scores, labels, rows):
    hit = (anchors["label"][:, None] == labels[None, :]) & (anchors["row"][:, None] != rows[None, :])
    return np.where(hit, 0, -1)


def slots(anchors, scores, labels, rows):
    """The slot of every product: how many upper limits it does not exceed, less one."""
    reach = np.full(scores.shape, -1)
    floor = np.full(scores.shape, np.iinfo(np.int64).min)
    for j in range(anchors["upper"].shape[1]):
        under = anchors["known"][:, j, None] & (scores <= anchors["upper"][:, j, None])
        reach += under
        floor = np.where(under, anchors["lower"][:, j, None], floor)
    # below the last of its windows a score is in none of them
    wanted = (anchors["label"][:, None] != labels[None, :]) & (scores >= floor)
    return np.where(wanted, reach, -1)


def limits(scores: np.ndarray, low: int = LOW, high: int = HIGH) -> tuple[list[int], list[int]]:
    """Least and greatest score s with ``low * p <= 100 s <= high * p``."""
    p = [int(s) for s in scores]
    return [-(-low * s // 100) for s in p], [high * s // 100 for s in p]


def mine(
    vectors: DataFrame,
    every: int = EVERY,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    block_values: int = BLOCK_VALUES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = vectors.sparkSession
    rows = staged(usable(vectors), "vectors")
    anchors, n = blocks(rows, every, block_values)
    out = scratch_path(spark, "hard_negatives")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    for b in range(n):
        block = read_block(anchors.where(F.col("block") == b))
        shared = spark.sparkContext.broadcast(block)
        # at most ``positives`` rows for each anchor of the block
        found = best_rows(rows, shared, positives, same_label, 1).orderBy("anchor", "place").collect()
        shared.unpersist()
        place = {row: i for i, row in enumerate(block["row"].tolist())}
        shape = (len(place), positives)
        block |= {"known": np.zeros(shape, bool), "upper": np.zeros(shape, np.int64), "lower": np.zeros(shape, np.int64)}
        for r in found:
            at = place[r["anchor"]], r["place"] - 1
            (least,), (greatest,) = limits([r["score"]], low, high)
            block["known"][at], block["lower"][at], block["upper"][at] = True, least, greatest
        shared = spark.sparkContext.broadcast(block)
        kept = best_rows(rows, shared, negatives, slots, positives)
        pairs = spark.createDataFrame(
            [(int(r["anchor"]), int(block["vec_id"][place[r["anchor"]]]), r["place"] - 1, r["vec_id"], r["score"], int(block["lower"][place[r["anchor"]], r["place"] - 1])) for r in found],
            "anchor long, anchor_id long, slot int, positive_id long, positive_score long, lower long",
        )
        answered(kept, pairs, positives, negatives).write.parquet(f"{out}/block={b}")
        shared.unpersist()
    if not n:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{out}/block={b}" for b in range(n)])


def read_block(anchors: DataFrame) -> dict[str, np.ndarray]:
    """One block of anchors on the driver: at most ``BLOCK_VALUES`` components."""
    found = anchors.orderBy("row").collect()
    width = max((len(r["q"]) for r in found), default=0)
    return {
        **{c: np.array([r[c] for r in found], np.int64) for c in ("row", "vec_id", "label")},
        "q": matrix([np.array(r["q"], np.int64) for r in found], width),
    }


def answered(kept: DataFrame, pairs: DataFrame, positives: int, negatives: int) -> DataFrame:
    """All windows of every anchor from its slots, merged from the last to the first.

    A slot holds ``negatives`` rows at most, and all of them score higher than
    those of the next slot: the merge of two is one after the other, cut.
    """
    entry = F.struct((-F.col("place")).alias("p"), "score", "vec_id")
    each = [F.sort_array(F.collect_list(F.when(F.col("slot") == j, entry)), asc=False).alias(f"s{j}") for j in range(positives)]
    slots_of = kept.groupBy("anchor").agg(*each)
    merged = F.col(f"s{positives - 1}")
    windows = [merged]
    for j in reversed(range(positives - 1)):
        merged = F.slice(F.concat(F.col(f"s{j}"), merged), 1, negatives)
        windows.insert(0, merged)
    slots_of = slots_of.select("anchor", F.array(*windows).alias("windows"))
    both = pairs.join(slots_of, "anchor")
    inside = F.filter(F.get("windows", F.col("slot")), lambda x: x["score"] >= F.col("lower"))
    both = both.select("anchor_id", "positive_id", "positive_score", F.posexplode(inside).alias("i", "n"))
    return both.select(
        "anchor_id",
        "positive_id",
        (F.col("i") + 1).cast("int").alias("rank"),
        F.col("n.vec_id").alias("negative_id"),
        "positive_score",
        F.col("n.score").alias("negative_score"),
    )
