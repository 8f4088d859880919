"""Token ids as wavelet matrices: one compressed, searchable file per shard.

A wavelet matrix stores a sequence of 16-bit ids as 16 bit planes. Plane k
holds bit 15-k of every id, in an order where the ids with a zero in the
previous plane come first. With a running count of ones every 512 bits it
answers ``access`` (id at a position), ``rank`` (occurrences of an id before a
position), ``select`` (position of the n-th occurrence) and ``count``.

The file stores that rank directory, and the planes in chunks of ``CHUNK``
bytes that are compressed one by one. A lookup reads the directory entry and
the one chunk that it needs of each plane, so nothing else is unpacked
(``unpacked`` counts the chunks); only ``ids`` unpacks all.

``write`` sorts documents by id over the cluster (a range shuffle), encodes
each range in its own task and writes one row per shard; a shard is closed at
the first document end after ``shard_tokens`` ids. ``read_documents`` decodes
shards back to one row per document.

Edge cases: a null or empty text is the end id alone; null ids sort first;
repeated rows are written as often as they occur; rows of one id are ordered by
a hash of their text (an id that many rows share is spread over ranges); a document longer than a
shard gets a shard of its own; an empty table writes no shard; columns other
than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cargolens.llm import tokens
from cargolens.llm.staging import arrow_rows

BITS = 16
BLOCK = 512
#: Bytes of a plane that are compressed together; a multiple of a block.
CHUNK = 1 << 13
#: Unpacked chunks that a matrix keeps.
KEPT_CHUNKS = 64
#: Ids that change their place at once.
STEP = 1 << 14
SHARD_TOKENS = 1 << 20
#: Documents in one Arrow batch.
BATCH_ROWS = 1024
MAGIC = b"WMX2"

SHARD = "part int, shard int, part_start long, n_docs int, n_tokens long, doc_ids binary, lengths binary, matrix binary"


class WaveletMatrix:
    """Bit planes with rank and select over 16-bit ids.

    ``ones`` is the rank directory: ones[k][j] counts the ones of plane k
    before block j. ``chunk_of(k, j)`` gives chunk j of plane k.
    """

    def __init__(self, n: int, zeros: list[int], ones: np.ndarray, chunk_of):
        self.n, self.zeros, self.ones, self._chunk_of = n, zeros, ones, chunk_of
        self._kept: dict[tuple[int, int], np.ndarray] = {}
        self.unpacked = 0

    @classmethod
    def of(cls, ids: np.ndarray) -> WaveletMatrix:
        ids = np.ascontiguousarray(ids, dtype=np.uint16)
        planes, zeros, n = [], [], len(ids)
        for k in range(BITS):
            bit = (ids & np.uint16(1 << (BITS - 1 - k))) != 0
            planes.append(np.packbits(bit, bitorder="little"))
            ones = int(np.count_nonzero(bit))
            zeros.append(n - ones)
            if 0 < ones < n:
                ids = parted(ids, bit, n - ones)
        ones = np.stack([directory(p)[: blocks_of(n)] for p in planes])
        return cls(n, zeros, ones, lambda k, j: planes[k][j * CHUNK : (j + 1) * CHUNK])

    def chunk(self, k: int, j: int) -> np.ndarray:
        found = self._kept.get((k, j))
        if found is None:
            if len(self._kept) >= KEPT_CHUNKS:
                self._kept.clear()
            found = self._kept[k, j] = self._chunk_of(k, j)
            self.unpacked += 1
        return found

    def plane(self, k: int) -> np.ndarray:
        chunks = [self._chunk_of(k, j) for j in range(chunks_of(self.n))]
        return np.concatenate(chunks) if chunks else np.empty(0, np.uint8)

    def ids(self) -> np.ndarray:
        """The whole sequence, plane by plane from the last to the first."""
        out = np.zeros(self.n, dtype=np.uint16)
        for k in range(BITS - 1, -1, -1):
            zeros = self.zeros[k]
            if zeros == self.n:
                continue
            if zeros == 0:
                out |= np.uint16(1 << (BITS - 1 - k))
                continue
            bit = np.unpackbits(self.plane(k), count=self.n, bitorder="little").view(bool)
            out[zeros:] |= np.uint16(1 << (BITS - 1 - k))
            out = rejoined(out, bit, zeros)
        return out

    def _byte(self, k: int, at: int) -> int:
        return int(self.chunk(k, at // CHUNK)[at % CHUNK])

    def _rank1(self, k: int, i: int) -> int:
        """Ones among the first i bits of plane k: the directory's count and
        the rest of one block."""
        block = i // BLOCK
        total = int(self.ones[k, block])
        if i % BLOCK:
            at = block * (BLOCK // 8)
            chunk, low = self.chunk(k, at // CHUNK), at % CHUNK
            whole = chunk[low : low + i // 8 - at]
            total += int(np.bitwise_count(whole).sum())
            if i % 8:
                total += (self._byte(k, i // 8) & ((1 << (i % 8)) - 1)).bit_count()
        return total

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        symbol = 0
        for k in range(BITS):
            bit = self._byte(k, i // 8) >> (i % 8) & 1
            ones = self._rank1(k, i)
            i = self.zeros[k] + ones if bit else i - ones
            symbol = symbol << 1 | bit
        return symbol

    def _range(self, symbol: int, end: int) -> tuple[int, int]:
        """Where the symbol's occurrences before ``end`` stand after the last plane."""
        low = 0
        for k in range(BITS):
            a, b = self._rank1(k, low), self._rank1(k, end)
            if symbol >> (BITS - 1 - k) & 1:
                low, end = self.zeros[k] + a, self.zeros[k] + b
            else:
                low, end = low - a, end - b
        return low, end

    def rank(self, symbol: int, end: int) -> int:
        low, high = self._range(symbol, min(end, self.n))
        return high - low

    def count(self, symbol: int) -> int:
        return self.rank(symbol, self.n)

    def select(self, symbol: int, nth: int) -> int:
        """Position of the nth (from 0) occurrence; -1 where there is none."""
        low, high = self._range(symbol, self.n)
        if not 0 <= nth < high - low:
            return -1
        i = low + nth
        for k in range(BITS - 1, -1, -1):
            one = bool(symbol >> (BITS - 1 - k) & 1)
            i = self._select(k, one, i - self.zeros[k] if one else i)
        return i

    def _select(self, k: int, one: bool, nth: int) -> int:
        low, high = 0, self.n  # the least i whose first i + 1 bits hold nth + 1 of the kind
        while low < high:
            mid = (low + high) // 2
            ones = self._rank1(k, mid + 1)
            if (ones if one else mid + 1 - ones) > nth:
                high = mid
            else:
                low = mid + 1
        return low

    def to_bytes(self) -> bytes:
        """Magic, length, zeros of each plane, rank directory, ends of all
        chunks, then the chunks (zstandard; as they are where that saves nothing)."""
        import zstandard

        pack = zstandard.ZstdCompressor(level=1)
        body, ends, at = [], [], 0
        for k in range(BITS):
            for j in range(chunks_of(self.n)):
                raw = self._chunk_of(k, j).tobytes()
                packed = pack.compress(raw)
                body.append(packed if len(packed) < len(raw) else raw)
                at += len(body[-1])
                ends.append(at)
        head = np.array([self.n, *self.zeros], dtype="<i8").tobytes()
        return b"".join([MAGIC, head, self.ones.astype("<u4").tobytes(), np.array(ends, dtype="<u8").tobytes(), *body])

    @classmethod
    def from_bytes(cls, blob: bytes) -> WaveletMatrix:
        """The matrix of a file; its chunks stay packed until they are asked for."""
        import zstandard

        if blob[:4] != MAGIC:
            raise ValueError("not a wavelet matrix")
        n, *zeros = np.frombuffer(blob, dtype="<i8", count=1 + BITS, offset=4).tolist()
        at, blocks, chunks = 4 + 8 * (1 + BITS), blocks_of(n), chunks_of(n)
        ones = np.frombuffer(blob, dtype="<u4", count=BITS * blocks, offset=at).reshape(BITS, blocks)
        at += 4 * BITS * blocks
        ends = np.frombuffer(blob, dtype="<u8", count=BITS * chunks, offset=at).tolist()
        at += 8 * BITS * chunks
        width, view, unpack = -(-n // 8), memoryview(blob), zstandard.ZstdDecompressor()

        def chunk_of(k: int, j: int) -> np.ndarray:
            i = k * chunks + j
            part = view[at + (ends[i - 1] if i else 0) : at + ends[i]]
            size = min(CHUNK, width - j * CHUNK)
            raw = part if len(part) == size else unpack.decompress(part, max_output_size=size)
            return np.frombuffer(raw, dtype=np.uint8)

        return cls(n, zeros, ones, chunk_of)


def parted(ids: np.ndarray, bit: np.ndarray, zeros: int) -> np.ndarray:
    """The ids without the bit, then those with it, ``STEP`` at a time: the
    places of a step stay in the cache (and by place is faster than by mask)."""
    out = np.empty_like(ids)
    low, high = 0, zeros
    for a in range(0, len(ids), STEP):
        part, b = ids[a : a + STEP], bit[a : a + STEP]
        one = np.flatnonzero(b)
        zero = np.flatnonzero(~b)
        out[low : low + len(zero)] = part.take(zero)
        out[high : high + len(one)] = part.take(one)
        low, high = low + len(zero), high + len(one)
    return out


def rejoined(ids: np.ndarray, bit: np.ndarray, zeros: int) -> np.ndarray:
    """The ids back in the order that ``parted`` took them from."""
    out = np.empty_like(ids)
    low, high = 0, zeros
    for a in range(0, len(ids), STEP):
        part, b = out[a : a + STEP], bit[a : a + STEP]
        one = np.flatnonzero(b)
        zero = np.flatnonzero(~b)
        part[zero] = ids[low : low + len(zero)]
        part[one] = ids[high : high + len(one)]
        low, high = low + len(zero), high + len(one)
    return out


def blocks_of(n: int) -> int:
    """Entries of the rank directory of a plane of n bits."""
    return n // BLOCK + 1


def chunks_of(n: int) -> int:
    return -(-n // (8 * CHUNK))


def directory(plane: np.ndarray) -> np.ndarray:
    """Ones before every block of a plane (whose last byte may be filled up)."""
    whole = np.zeros(-(-max(1, len(plane)) // (BLOCK // 8)) * (BLOCK // 8), np.uint8)
    whole[: len(plane)] = np.bitwise_count(plane)
    return np.concatenate([[0], np.cumsum(whole.reshape(-1, BLOCK // 8).sum(axis=1, dtype=np.int64))])


def write(docs: DataFrame, path: str, shard_tokens: int = SHARD_TOKENS, tokenizer: str | None = None) -> None:
    """Write the ids of all documents, in ascending doc_id order, as shards."""
    vocabulary = tokenizer or tokens.tokenizer_path()

    def shards(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        enc = tokens.encoder(vocabulary)
        names = [f.split()[0] for f in SHARD.split(", ")]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        done, shard = 0, 0
        doc_ids: list[int | None] = []
        parts: list[np.ndarray] = []
        held = 0

        def close():
            nonlocal done, shard, held, doc_ids, parts
            lengths = np.array([len(p) for p in parts], dtype="<i8")
            # null ids are marked by a leading bitmap
            known = np.array([d is not None for d in doc_ids])
            packed = np.packbits(known).tobytes() + np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes()
            row = [part, shard, done, len(parts), held, zlib.compress(packed, 1), zlib.compress(lengths.tobytes(), 1)]
            row.append(WaveletMatrix.of(np.concatenate(parts)).to_bytes())
            done, shard, held, doc_ids, parts = done + held, shard + 1, 0, [], []
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names=names)

        rows = ((doc_id, text.as_py()) for b in batches for doc_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True))
        for doc_id, ids in enc.encode_documents(rows):
            doc_ids.append(doc_id)
            parts.append(ids)
            held += len(ids)
            if held >= shard_tokens:
                yield close()
        if parts:
            yield close()

    # equal ids are ordered by a hash of the text, and copies of a row by their number, so ranges can part them
    order = ["doc_id", "_hash", "_row"]
    ordered = docs.select(F.col("doc_id").cast("long"), F.col("text"), F.xxhash64("text").alias("_hash"), F.monotonically_increasing_id().alias("_row"))
    ordered = ordered.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        ordered.mapInArrow(shards, SHARD).write.option("compression", "uncompressed").parquet(path)


def documents_of(shard: dict) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """(doc ids, lengths, matrix) of one shard row."""
    n = shard["n_docs"]
    packed = zlib.decompress(shard["doc_ids"])
    known = np.unpackbits(np.frombuffer(packed, np.uint8, count=-(-n // 8)), count=n)
    ids = np.frombuffer(packed, "<i8", offset=-(-n // 8)).tolist()
    lengths = np.frombuffer(zlib.decompress(shard["lengths"]), "<i8")
    return [i if k else None for i, k in zip(ids, known, strict=True)], lengths, WaveletMatrix.from_bytes(shard["matrix"])


def read_documents(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document, decoded from the shards: doc_id, start, n_tokens,
    ids_crc32 (and the ids themselves).

    ``start`` counts the ids of all documents before it: the ids of earlier
    ranges (one sum per range), of earlier shards of the range (stored in the
    shard) and of earlier documents of the shard.
    """
    shards = spark.read.schema(SHARD).parquet(path)
    extra = ", ids array<int>" if with_ids else ""
    out = "doc_id long, part int, _start long, n_tokens long, ids_crc32 long" + extra

    def decode(batches):
        import pyarrow as pa

        for batch in batches:
            for i in range(batch.num_rows):  # one shard in memory at a time
                shard = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                doc_ids, lengths, matrix = documents_of(shard)
                ids = matrix.ids()
                ends = np.cumsum(lengths)
                starts = ends - lengths
                own = [ids[a:b] for a, b in zip(starts, ends, strict=True)]
                columns = [
                    pa.array(doc_ids, pa.int64()),
                    pa.array([shard["part"]] * len(own), pa.int32()),
                    pa.array(starts + shard["part_start"], pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array([tokens.crc32_of_ids(x) for x in own], pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.array([x.tolist() for x in own], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in out.split(", ")])

    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("_n"))  # one row per range
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    # few shards a batch: a shard is megabytes
    docs = shards.mapInArrow(decode, out)
    columns = [F.col("doc_id"), (F.col("_offset") + F.col("_start")).alias("start"), F.col("n_tokens"), F.col("ids_crc32")]
    return docs.join(offsets, "part").select(*columns, *([F.col("ids")] if with_ids else []))


def occurrences(spark: SparkSession, path: str, token_ids: list[int]) -> DataFrame:
    """Count of each given token id per shard, answered by rank on the bit planes."""
    shards = spark.read.schema(SHARD).parquet(path).select("part", "shard", "matrix")

    def count(batches):
        import pandas as pd

        for frame in batches:
            for row in frame.itertuples(index=False):
                matrix = WaveletMatrix.from_bytes(row.matrix)
                yield pd.DataFrame(
                    {"part": row.part, "shard": row.shard, "token_id": token_ids, "n": [matrix.count(t) for t in token_ids]}
                )

    return shards.mapInPandas(count, "part int, shard int, token_id int, n long")
