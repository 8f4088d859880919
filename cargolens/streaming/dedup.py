"""Streaming dedup (STR6) whose state is bounded by the delay.

What a batch must know of earlier ones lies in three small tables next to the
output, below ``<out>_state``:

* ``marks/``: the newest event time after each batch (a file of one line), so
  no batch looks for it in the ids. Two marks are kept: the open batch's
  predecessor, which a replay needs, and its own.
* ``ids/event_month=<m>/batch=<n>/``: the ids that each batch wrote.
* ``filters/event_month=<m>/batch=<n>/``: a Bloom filter of the month's ids up
  to batch n, as rows (slot, bits) of 64 bits each. An id sets ``BITS`` bits of
  the one slot its hash names.

Every ``merge_at`` batches a month's small folders of ids are merged into one
and taken into its filter, so neither is rewritten by every batch. A batch
compares its ids with the few folders written since then, and tests them
against the filters of the months inside the delay by a join on slot. Only
where a filter may hold an id are the month's merged ids read. Filters err on
one side only, so the comparison stays exact.

Months that lie wholly before the delay are deleted. A merge is written before
its parts are deleted, and ids are a set, so a job that ends in between changes
nothing. Folders that an open batch wrote are never read by its replay.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cargolens.functions import columns as C
from cargolens.session import delete_path, glob_paths, path_exists, read_text, write_text
from cargolens.streaming.jobs import _drain, first_per_key

#: 64-bit slots of a month's filter: 10 bits an id for 400,000 ids a month. More
#: ids make it answer "maybe" more often, never wrongly.
SLOTS = 1 << 16
BITS = 4
#: Folders of a month's ids that are merged into one.
MERGE_AT = 16
#: Ids that a filter may hold, sent to all tasks that read the stored ids of
#: its month; beyond that the two are shuffled.
BROADCAST_IDS = 200_000


def slot_and_bits(key: Column, slots: int) -> tuple[Column, Column]:
    """The slot of an id, and the bits it sets there."""
    first = F.xxhash64(key)
    second = F.xxhash64(first, F.lit(1))
    bits = F.lit(0).cast("long")
    for k in range(BITS):
        place = F.shiftrightunsigned(second, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return F.pmod(first, F.lit(slots)), bits


class State:
    """The stored state of one dedup job."""

    def __init__(self, spark: SparkSession, path: str, key_type: str, slots: int = SLOTS, merge_at: int = MERGE_AT):
        self.spark, self.path, self.slots, self.merge_at = spark, path, slots, merge_at
        self.id_schema = f"id {key_type}, event_ts timestamp"
        self.kept: list[DataFrame] = []  # cached for the open batch

    # --- marks -------------------------------------------------------------

    def _marks(self) -> dict[int, str]:
        return {int(re.search(r"(\d+)\.json$", p)[1]): p for p in glob_paths(self.spark, f"{self.path}/marks/*.json")}

    def newest_before(self, batch_id: int) -> int | None:
        """The newest event time (microseconds) of all batches before this one."""
        earlier = [n for n in self._marks() if n < batch_id]
        return json.loads(read_text(self.spark, self._marks()[max(earlier)]))["newest"] if earlier else None

    def set_mark(self, batch_id: int, newest: int | None) -> None:
        write_text(self.spark, f"{self.path}/marks/{batch_id:012d}.json", json.dumps({"newest": newest}))
        marks = self._marks()
        for n in sorted(marks)[:-2]:
            delete_path(self.spark, marks[n])

    # --- versioned folders ---------------------------------------------------

    def _folders(self, table: str) -> list[tuple[str, int, str]]:
        """(month, last batch, path) of every folder, ascending."""
        found = []
        for p in glob_paths(self.spark, f"{self.path}/{table}/event_month=*/batch=*"):
            month, last = re.search(r"event_month=([^/]+)/batch=(?:\d+-)?(\d+)$", p).groups()
            found.append((month, int(last), p))
        return sorted(found)

    def _filters(self, batch_id: int, first_month: str) -> dict[str, tuple[int, str]]:
        """The latest filter (last batch, path) of every month inside the delay."""
        return {m: (last, p) for m, last, p in self._folders("filters") if last < batch_id and m >= first_month}

    def read_filters(self, paths: list[str]) -> DataFrame:
        reader = self.spark.read.schema("slot long, bits long, event_month string, batch string")
        return reader.option("basePath", f"{self.path}/filters").parquet(*paths).drop("batch")

    def read_ids(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(self.id_schema).parquet(*paths)

    # --- what a batch asks and adds -------------------------------------------

    def repeated(self, ids: DataFrame, batch_id: int, mark: Column | None, first_month: str) -> DataFrame | None:
        """Stored ids, from the mark on, that hold all of ``ids`` (one column,
        id) that an earlier batch wrote; None where there is nothing to compare."""
        filters = self._filters(batch_id, first_month)
        held: dict[str, int] = {}
        hits = None
        if filters:
            slot, bits = slot_and_bits(F.col("id"), self.slots)
            asked = ids.select("id", slot.alias("slot"), bits.alias("wanted"))
            hits = asked.join(self.read_filters([p for _, p in filters.values()]), "slot")
            hits = hits.where(F.col("bits").bitwiseAND(F.col("wanted")) == F.col("wanted")).select("id", "event_month").persist()
            self.kept.append(hits)
            held = {r["event_month"]: r["count"] for r in hits.groupBy("event_month").count().collect()}
        recent, merged = [], []
        for month, last, path in self._folders("ids"):
            if last < batch_id and month >= first_month:
                if month not in filters or last > filters[month][0]:
                    recent.append(path)
                elif month in held:
                    merged.append(path)
        found = []
        if recent:
            found.append(self.read_ids(recent))
        if merged:
            maybe = hits.select("id").distinct()
            maybe = F.broadcast(maybe) if sum(held.values()) <= BROADCAST_IDS else maybe
            found.append(self.read_ids(merged).join(maybe, "id", "left_semi"))
        if not found:
            return None
        stored = found[0] if len(found) == 1 else found[0].unionByName(found[1])
        return (stored if mark is None else stored.where(F.col("event_ts") >= mark)).select("id")

    def add(self, ids: DataFrame, batch_id: int) -> None:
        """Remember (id, event_ts)."""
        dated = ids.withColumns({"event_month": F.date_format("event_ts", "yyyy-MM"), "batch": F.lit(f"{batch_id:012d}")})
        self._write("ids", dated)

    def _write(self, table: str, rows: DataFrame) -> None:
        """Rows into their folders, few files each: a task takes whole months,
        a month of many rows is dealt to several (by AQE)."""
        writer = rows.hint("rebalance", "event_month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("event_month", "batch").parquet(f"{self.path}/{table}")

    def tidy(self, batch_id: int, first_month: str) -> None:
        """Delete what no batch will read again; merge small folders."""
        for table in ("ids", "filters"):
            for month in {m for m, _, _ in self._folders(table) if m < first_month}:
                delete_path(self.spark, f"{self.path}/{table}/event_month={month}")
        filters = self._filters(batch_id, first_month)
        small: dict[str, list[tuple[int, str]]] = {}
        for month, last, path in self._folders("ids"):
            if last < batch_id and "-" not in path.rsplit("batch=", 1)[1]:  # committed batches only
                small.setdefault(month, []).append((last, path))
        due = {}
        for month, parts in small.items():
            done = filters[month][0] if month in filters else -1
            for last, path in parts:
                if last <= done:  # a merge that ended before it deleted its parts
                    delete_path(self.spark, path)
            parts = [p for p in parts if p[0] > done]
            if len(parts) >= self.merge_at:
                due[month] = parts
        if due:
            self._merge(due, {m: filters[m][1] for m in due if m in filters})

    def _merge(self, due: dict[str, list[tuple[int, str]]], before: dict[str, str]) -> None:
        """Merge the small folders of all months that are due: one write of ids,
        one of filters. ``before``: the filters of these months so far."""
        paths = [path for parts in due.values() for _, path in parts]
        reader = self.spark.read.schema(f"{self.id_schema}, event_month string, batch string")
        rows = reader.option("basePath", f"{self.path}/ids").parquet(*paths).drop("batch")

        def named(name_of) -> Column:
            names = [x for month, parts in due.items() for x in (F.lit(month), F.lit(name_of(parts)))]
            return F.create_map(*names)[F.col("event_month")].alias("batch")

        self._write("ids", rows.select("*", named(lambda parts: f"{parts[0][0]:012d}-{parts[-1][0]:012d}")))
        slot, bits = slot_and_bits(F.col("id"), self.slots)
        new = rows.select("event_month", slot.alias("slot"), bits.alias("bits"))
        if before:
            new = new.unionByName(self.read_filters(list(before.values())).select("event_month", "slot", "bits"))
        new = new.groupBy("event_month", "slot").agg(F.bit_or("bits").alias("bits"))
        self._write("filters", new.select("*", named(lambda parts: f"{parts[-1][0]:012d}")))
        for path in [*paths, *before.values()]:
            delete_path(self.spark, path)


def month_of(spark: SparkSession, time: Column) -> str:
    """The month of a constant time (folded by the optimizer: no job runs)."""
    return spark.sql("SELECT 1").select(F.date_format(time, "yyyy-MM")).first()[0]


def dedup_stream(
    bronze: DataFrame,
    out_path: str,
    checkpoint: str,
    delay: str,
    key: str = "shipment_id",
    fmt: str = "parquet",
    late_path: str | None = None,
    no_key_path: str | None = None,
    slots: int = SLOTS,
    merge_at: int = MERGE_AT,
    state_class: type[State] = State,
) -> StreamingQuery:
    """Drop repeated ids that arrive within ``delay`` of event time (STR6).

    Each micro-batch keeps one row per id (reduced in the tasks first) and
    drops the ids that earlier batches wrote inside the delay. Nothing is lost:
    rows older than the delay go to ``late_path``, rows without an id to
    ``no_key_path`` (both default to folders next to ``out_path``). A row
    without an event time counts as of the newest time its batch knows, so its
    id leaves the state like any other. Each batch overwrites folders of its
    own, so a replay changes nothing."""
    base = out_path.rstrip("/")
    state = state_class(bronze.sparkSession, f"{base}_state", dict(bronze.dtypes)[key], slots, merge_at)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state.spark = spark
        newest = state.newest_before(batch_id)
        known = newest is not None
        mark = F.timestamp_micros(F.lit(newest)) - F.expr(f"INTERVAL {delay}") if known else None
        first_month = month_of(spark, mark) if known else ""
        late = F.coalesce(F.col("event_ts") < mark, F.lit(False)) if known else F.lit(False)
        has_key = F.col(key).isNotNull()
        rows, kept = batch.persist(), []
        try:
            facts = rows.agg(
                F.max(F.unix_micros("event_ts")).alias("newest"),
                F.count_if(has_key & late).alias("late"),
                F.count_if(~has_key).alias("no_key"),
            ).first()
            now = max((n for n in (newest, facts["newest"]) if n is not None), default=None)
            fresh = first_per_key(rows.filter(has_key & ~late), key, ["event_ts"]).persist()
            kept.append(fresh)
            repeated = state.repeated(fresh.select(F.col(key).alias("id")), batch_id, mark, first_month)
            if repeated is not None:
                fresh = fresh.join(repeated.withColumnRenamed("id", key), key, "left_anti").select(*rows.columns).persist()
                kept.append(fresh)
            fresh.write.mode("overwrite").format(fmt).save(f"{base}/batch={batch_id}")
            others = (
                (rows.filter(has_key & late), facts["late"], late_path or f"{base}_late"),
                (rows.filter(~has_key), facts["no_key"], no_key_path or f"{base}_no_key"),
            )
            for part, n, path in others:
                # the first batch writes both tables, empty or not, so that they can be read
                if n or not path_exists(spark, path) or path_exists(spark, f"{path}/batch={batch_id}"):
                    part.write.mode("overwrite").format(fmt).save(f"{path}/batch={batch_id}")
            newest_known = F.timestamp_micros(F.lit(now if now is not None else 0))
            ids = fresh.select(F.col(key).alias("id"), F.coalesce("event_ts", newest_known).alias("event_ts"))
            state.add(ids, batch_id)
            state.set_mark(batch_id, now)
            state.tidy(batch_id, first_month)
        finally:
            for df in (rows, *kept, *state.kept):
                df.unpersist()
            state.kept.clear()

    return _drain(bronze.withColumn("event_ts", C.typed_timestamp("event_timestamp")), checkpoint, write_batch)
