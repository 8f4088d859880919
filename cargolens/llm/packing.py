"""Best-two-fit packing of documents into fixed-length sequences.

Greedy filling takes the longest piece that still fits. When a bin keeps a
gap, its smallest piece is taken out again if two unpacked pieces fill the
widened gap more tightly.

The method looks at lengths only, and there are at most ``max_tokens``
different lengths. So the packing is planned once, on the histogram of all
lengths (never more than ``max_tokens`` rows, whatever the corpus), where a bin
is a recipe of lengths that is repeated as often as the histogram allows. Spark
then numbers the pieces of each length and looks up, for each number, the
sequence and offset that the plan gives it. Pieces of one length are
interchangeable, so the result is that of packing all documents in one place.

Edge cases: a null or empty text is one piece with the end id alone; repeated
rows are packed as often as they occur; an empty table gives an empty result;
columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cargolens.llm import tokens
from cargolens.llm.staging import staged

MAX_TOKENS = 2048

PIECES = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, _part int, _nth long"
)


def cut_lengths(n: int, most: int) -> list[int]:
    """Lengths of a document's pieces: whole ones of ``most``, the first may be shorter."""
    rest = n % most
    return ([rest] if rest else []) + [most] * (n // most)


def plan(counts: np.ndarray, capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Recipes ``([(length, copies), ...], times)`` that use up ``counts``.

    ``counts[n]`` is the number of pieces of length n.
    """
    left = counts.astype(np.int64).copy()
    lengths = np.arange(capacity + 1)
    recipes = []
    while left.any():
        free = left.copy()
        used: dict[int, int] = {}
        gap = capacity

        def put(n: int, copies: int = 1) -> None:
            free[n] -= copies
            used[n] = used.get(n, 0) + copies

        while gap and (fit := np.flatnonzero(free[1 : gap + 1])).size:
            n = int(fit[-1]) + 1
            copies = min(int(free[n]), gap // n)
            put(n, copies)
            gap -= n * copies
        while gap and len(used):
            small = min(used)
            room = gap + small
            # below[x]: the longest unpacked length up to x (0: none)
            below = np.maximum.accumulate(np.where(free > 0, lengths, 0))
            first = np.flatnonzero(free[: room + 1] > 0)
            if not first.size:
                break
            second = below[room - first]
            same = (second == first) & (free[first] < 2)
            second = np.where(same, below[np.maximum(first - 1, 0)], second)
            total = np.where(second > 0, first + second, 0)
            best = int(total.argmax())
            if total[best] <= small:
                break
            used[small] -= 1
            free[small] += 1
            if not used[small]:
                del used[small]
            put(int(first[best]))
            put(int(second[best]))
            gap = room - int(total[best])
        times = min(int(left[n]) // copies for n, copies in used.items())
        for n, copies in used.items():
            left[n] -= copies * times
        recipes.append((sorted(used.items(), reverse=True), times))
    return recipes


class Placement:
    """The plan as sorted arrays: (length, number) -> (sequence, offset)."""

    def __init__(self, recipes: list[tuple[list[tuple[int, int]], int]], capacity: int):
        taken = np.zeros(capacity + 1, dtype=np.int64)
        rows, base = [], 0
        for items, times in recipes:
            offset = 0
            for n, copies in items:
                rows.append((n, taken[n], base, copies, offset))
                taken[n] += copies * times
                offset += n * copies
            base += times
        table = np.array(rows, dtype=np.int64).reshape(-1, 5)
        table = table[np.lexsort((table[:, 1], table[:, 0]))]
        self.length, self.low, self.base, self.copies, self.offset = (c.copy() for c in table.T)
        self.first_row = np.searchsorted(self.length, np.arange(capacity + 2))
        self.sequences = base

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row = np.empty(len(length), dtype=np.int64)
        for n in np.unique(length):
            a, b = self.first_row[n], self.first_row[n + 1]
            mine = length == n
            row[mine] = a + np.searchsorted(self.low[a:b], number[mine], side="right") - 1
        step = number - self.low[row]
        return self.base[row] + step // self.copies[row], self.offset[row] + step % self.copies[row] * length


def pieces(
    docs: DataFrame, max_tokens: int = MAX_TOKENS, tokenizer: str | None = None, with_ids: bool = False
) -> DataFrame:
    """One row per piece, numbered by length inside its task (``_part``, ``_nth``).

    ``with_ids`` adds the piece's ids as an int array.
    """
    path = tokenizer or tokens.tokenizer_path()
    schema = PIECES + (", ids array<int>" if with_ids else "")

    def cut(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
        kinds += [pa.list_(pa.int32())] if with_ids else []
        names = [f.split()[0] for f in schema.split(", ")]
        part = TaskContext.get().partitionId()
        seen = np.zeros(max_tokens + 1, dtype=np.int64)
        enc = tokens.encoder(path)
        for batch in batches:
            columns = [[] for _ in kinds]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = enc.encode_document(text.as_py())
                start = 0
                for k, n in enumerate(cut_lengths(len(ids), max_tokens)):
                    own = ids[start : start + n]
                    row = [doc_id, k, start, n, tokens.crc32_of_ids(own), part, int(seen[n])]
                    for column, value in zip(columns, row + ([own.tolist()] if with_ids else []), strict=True):
                        column.append(value)
                    seen[n] += 1
                    start += n
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(cut, schema)


def pack(docs: DataFrame, max_tokens: int = MAX_TOKENS, tokenizer: str | None = None) -> DataFrame:
    """Pieces with their place: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut = staged(pieces(docs, max_tokens, tokenizer), "pieces")
    by_part = cut.groupBy("length", "_part").agg(F.count("*").alias("_n"))
    histogram = np.zeros(max_tokens + 1, dtype=np.int64)
    for row in cut.groupBy("length").count().collect():  # max_tokens rows at most
        histogram[row["length"]] = row["count"]
    placement = Placement(plan(histogram, max_tokens), max_tokens)
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_part.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")

    def place(batches):
        import pyarrow as pa

        for batch in batches:
            length, number = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            sequence, offset = placement.place(length, number)
            columns = [*batch.columns[:5], pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=OUT_NAMES)

    numbered = cut.join(bases, ["length", "_part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("_base") + F.col("_nth")).alias("_number")
    )
    return numbered.mapInArrow(place, OUT)


OUT = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
OUT_NAMES = [f.split()[0] for f in OUT.split(", ")]


def sequences(
    docs: DataFrame, packed: DataFrame, max_tokens: int = MAX_TOKENS, tokenizer: str | None = None
) -> DataFrame:
    """The packed ids: (sequence_id, ids array<int>), one row per sequence.

    A sequence holds ``max_tokens`` ids at most, so its group is bounded.
    Equal pieces of one id are interchangeable; both sides number them.
    """
    key = ["doc_id", "piece", "ids_crc32"]
    copy = F.row_number().over(Window.partitionBy(*key).orderBy("start"))
    ids = pieces(docs, max_tokens, tokenizer, with_ids=True).withColumn("_copy", copy)
    place = packed.withColumn("_copy", copy)
    same = [place[c].eqNullSafe(ids[c]) for c in [*key, "_copy"]]
    return (
        place.join(ids, same)
        .select("sequence_id", F.struct("offset", "ids").alias("_p"))
        .groupBy("sequence_id")
        .agg(F.expr("flatten(transform(array_sort(collect_list(_p)), p -> p.ids))").alias("ids"))
    )
