"""Exact dedup with a heavy-hitter split.

Texts are equal when identical after lower-casing A-Z. Every task keeps a
Misra-Gries summary of the digests it reads; the summed summaries name at most
``counters`` candidates, among them every digest with more than
2 / (counters + 1) of all rows. The candidates are counted exactly, and the
verified winners (a table of proven size) are broadcast, so rows of the large
groups are decided where they are read. Only the remaining digests are
shuffled, and none of them is frequent.

Edge cases: a null text equals an empty one; of several rows with the largest
id just one stays; null ids lose to any id; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cargolens.llm.staging import numbered, staged

COUNTERS = 1023


def normalised(text):
    return F.translate(F.coalesce(text, F.lit("")), ascii_uppercase, ascii_lowercase)


class MisraGries:
    """At most ``counters`` counts; each is short of the truth by at most
    (items seen) / (counters + 1)."""

    def __init__(self, counters: int):
        self.counters, self.counts = counters, Counter()

    def add(self, items) -> None:
        self.counts.update(items)
        if len(self.counts) > self.counters:
            cut = sorted(self.counts.values(), reverse=True)[self.counters]
            self.counts = Counter({k: n - cut for k, n in self.counts.items() if n > cut})


def frequent(digests: DataFrame, column: str, counters: int = COUNTERS) -> DataFrame:
    """Candidates for frequent values of a binary column: ``counters`` + 1 rows at most."""

    def summary(batches):
        import pyarrow as pa

        sketch = MisraGries(counters)
        for batch in batches:
            sketch.add(batch.column(0).to_pylist())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sketch.counts), pa.binary()), pa.array(list(sketch.counts.values()), pa.int64())],
            names=[column, "_n"],
        )

    rows = digests.count()
    # sums of summaries are at most the number of rows, so this keeps counters + 1 values at most
    least = max(2, -(-rows // (counters + 1)))
    summaries = digests.select(column).mapInArrow(summary, f"{column} binary, _n long")
    return summaries.groupBy(column).agg(F.sum("_n").alias("_n")).where(F.col("_n") >= least).select(column)


def mark(docs: DataFrame, row=None, counters: int = COUNTERS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256
    (and ``row``, the given row number column)."""
    number = F.col(row) if row else F.monotonically_increasing_id()
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        number.alias("_row"),
        F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("_sha"),
    )
    base = staged(base, "digests")
    best = F.max(F.struct("doc_id", "_row"))
    candidates = frequent(base, "_sha", counters)
    counted = base.join(F.broadcast(candidates), "_sha").groupBy("_sha")
    winners = staged(counted.agg(best.alias("_best"), F.count("*").alias("group_size")), "winners")
    heavy = base.join(F.broadcast(winners), "_sha")
    group = Window.partitionBy("_sha")
    light = base.join(F.broadcast(winners.select("_sha")), "_sha", "left_anti")
    light = light.select("_sha", "doc_id", "_row", best.over(group).alias("_best"), F.count("*").over(group).alias("group_size"))
    both = heavy.select("_sha", "doc_id", "_row", "_best", "group_size").unionByName(light)
    out = both.select(
        "doc_id",
        F.col("_best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("_best._row") == F.col("_row")).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
        F.col("_row"),
    )
    return out.withColumnRenamed("_row", row) if row else out.drop("_row")


def distinct_documents(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns."""
    rows, row = numbered(docs, "documents")
    dropped = mark(rows, row).where(~F.col("kept")).select(row)
    return rows.join(dropped, row, "left_anti").select(*docs.columns)
