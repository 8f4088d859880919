"""Mixing sources to target weights by Pareto order sampling.

A source's target follows from its weight (never above ``most_copies`` times
its size; what is cut off goes to the others by weight). Inside a source a
document expects ``c * weight`` copies, with c solved so that the expected
words meet the target and no document expects more than ``most_copies``.
Whole expected copies are certain. For the fraction p that remains, documents
are ranked by (u / (1 - u)) / (p / (1 - p)) with u a hash of the document, and
the sample of fixed size (in words: the target less the certain words) takes
the lowest ranks. A document too long for the room that is left is passed
over; ``ROUNDS`` passes fill what that leaves.

The rank cut of a source is found without sorting the source: one histogram
of ranks, then a running sum inside the one bin where the size is reached.

Edge cases: a null text has size 0, a null source is a source of its own (the
last); repeated rows are documents of their own; sources without words have
target 0; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cargolens.llm.staging import fresh, numbered, staged, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_COPIES = 2
ROUNDS = 3
KEY_BITS = 48
BIN_BITS = 16


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST_COPIES) -> DataFrame:
    """(source, source_size, target) from (source, source_size); one row per source.

    A source is cut off at ``most`` times its size exactly when its size per
    weight is among the k smallest, for the least k whose common level leaves
    nobody else above. From there on levels only fall, so the level wanted is
    the largest of those that fit. The windows run over sources, not documents.
    """
    order = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(w) for w in weights])
    s = sizes.withColumn("_w", F.element_at(cycle, (order % len(weights) + 1).cast("int")))
    ratio = F.col("source_size") / F.col("_w")
    up = Window.orderBy(ratio, "source").rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy(ratio, "source").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    all_rows = Window.partitionBy()
    level = (F.sum("source_size").over(all_rows) * share - most * F.coalesce(F.sum("source_size").over(up), F.lit(0))) / F.sum(
        "_w"
    ).over(rest)
    s = s.withColumn("_level", level).withColumn("_fits", F.col("_level") * F.col("_w") <= most * F.col("source_size"))
    s = s.withColumn("_common", F.max(F.when(F.col("_fits"), F.col("_level"))).over(all_rows))
    target = F.least(F.coalesce(F.col("_common"), F.lit(float("inf"))) * F.col("_w"), most * F.col("source_size").cast("double"))
    return s.select("source", "source_size", target.alias("target"))


def expected_copies(classes: DataFrame, most=MOST_COPIES) -> DataFrame:
    """(source, _weight, _copies): expected copies of a weight class.

    ``classes`` has (source, _weight, _words, target), a few rows per source.
    The heaviest classes are cut off at ``most``, as few as it takes.
    """
    own = Window.partitionBy("source")
    heavier = own.orderBy(F.col("_weight").desc()).rowsBetween(Window.unboundedPreceding, -1)
    rest = own.orderBy(F.col("_weight").desc()).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    c = (F.col("target") - most * F.coalesce(F.sum("_words").over(heavier), F.lit(0))) / F.sum(
        F.col("_weight") * F.col("_words")
    ).over(rest)
    classes = classes.withColumn("_c", F.when(F.col("_words") > 0, c))
    classes = classes.withColumn("_c", F.max(F.when(F.col("_c") * F.col("_weight") <= most + 1e-9, F.col("_c"))).over(own))
    copies = F.least(F.coalesce(F.col("_c"), F.lit(float(most))) * F.col("_weight"), F.lit(float(most)))
    return classes.select("source", "_weight", copies.alias("_copies"))


def same_source(a: DataFrame, b: DataFrame, how: str = "inner") -> DataFrame:
    return a.join(b.withColumnRenamed("source", "_source"), a["source"].eqNullSafe(F.col("_source")), how).drop("_source")


def cut(pool: DataFrame, rooms: DataFrame) -> DataFrame:
    """(source, _until, _taken): the longest run of lowest ranks that fits ``room``.

    ``pool`` has (source, size, _rank), a document's rank being a struct of
    key and row number; ``_until`` is the last rank of the run, ``_taken`` its
    words.
    """
    width = 1 << (KEY_BITS - BIN_BITS)
    pool = pool.withColumn("_bin", F.shiftright(F.col("_rank.key"), KEY_BITS - BIN_BITS))
    bins = pool.groupBy("source", "_bin").agg(F.sum("size").alias("_s"))
    running = Window.partitionBy("source").orderBy("_bin")
    bins = same_source(bins.withColumn("_sum", F.sum("_s").over(running)), rooms)
    edge = bins.groupBy("source", "room").agg(
        F.min(F.when(F.col("_sum") > F.col("room"), F.struct("_bin", (F.col("_sum") - F.col("_s")).alias("before")))).alias("_e"),
        F.max("_sum").alias("_all"),
    )
    whole = F.struct(F.lit(1 << (KEY_BITS + 1)).alias("key"), F.lit(0).cast("long").alias("row"))
    lowest = F.struct((F.col("_e._bin") * width - 1).alias("key"), F.lit((1 << 63) - 1).alias("row"))
    inside = same_source(pool.select("source", "size", "_rank", "_bin"), edge.where("_e is not null"))
    inside = inside.where(F.col("_bin") == F.col("_e._bin"))
    run = Window.partitionBy("source").orderBy("_rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = inside.withColumn("_sum", F.sum("size").over(run) + F.col("_e.before"))
    inside = inside.where(F.col("_sum") <= F.col("room"))
    inside = inside.groupBy("source").agg(F.max("_rank").alias("_last"), F.max("_sum").alias("_sum"))
    found = same_source(edge, inside, "left")
    return found.select(
        "source",
        F.when(F.col("_e").isNull(), whole).otherwise(F.coalesce("_last", lowest)).alias("_until"),
        F.when(F.col("_e").isNull(), F.col("_all")).otherwise(F.coalesce("_sum", "_e.before")).alias("_taken"),
    )


def mix(docs: DataFrame, row: str | None = None, seed: int = 0) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies."""
    number = F.col(row) if row else F.monotonically_increasing_id()
    size = word_count(F.col("text"))
    base = docs.select(
        F.col("doc_id").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        size.alias("size"),
        number.alias("_row"),
        # 2 ** -53 and up: never 0 or 1
        ((F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "text"), 11) * 2 + 1) * 2.0**-54).alias("_u"),
    )
    base = base.withColumn("_weight", F.length(F.bin("size")) + 8)  # longer documents are a little likelier
    base = staged(base, "sizes")
    classes = staged(base.groupBy("source", "_weight").agg(F.sum("size").alias("_words")), "classes")
    targets = staged(source_targets(classes.groupBy("source").agg(F.sum("_words").alias("source_size"))), "targets")
    copies = staged(expected_copies(same_source(classes, targets.select("source", "target"))), "copies")
    # one small row per source: its size, target and the copies of its classes
    per_class = F.map_from_entries(F.collect_list(F.struct("_weight", "_copies"))).alias("_by_class")
    state = same_source(targets, copies.groupBy("source").agg(per_class))
    certain = F.floor(F.element_at(F.col("_by_class"), F.col("_weight")) + 1e-9)
    certain_words = same_source(classes, state).groupBy("source").agg(F.sum(certain * F.col("_words")).alias("_certain"))
    state = same_source(state, certain_words)
    state = state.withColumn("room", F.greatest(F.lit(0), F.floor(F.col("target") - F.col("_certain")))).drop("_certain")
    state = staged(state.withColumn("_cuts", F.expr("cast(array() as array<struct<until:struct<key:bigint,row:bigint>,room:bigint>>)")), "rooms")
    for _ in range(ROUNDS):
        pool = ranked(base, state)
        last = F.element_at("_cuts", -1)["until"]
        pool = pool.where((F.size("_cuts") == 0) | (F.col("_rank") > F.when(F.size("_cuts") > 0, last)))
        pool = pool.where((F.col("_p") > 0) & (F.col("size") > 0) & (F.col("size") <= F.col("room")))
        found = cut(pool.select("source", "size", "_rank"), state.select("source", "room"))
        joined = same_source(state, found, "left")
        end = F.struct(F.lit(1 << (KEY_BITS + 1)).alias("key"), F.lit(0).cast("long").alias("row"))
        step = F.struct(F.coalesce("_until", end).alias("until"), F.col("room").alias("room"))
        state = staged(
            joined.select(
                *[c for c in state.columns if c not in ("room", "_cuts")],
                (F.col("room") - F.coalesce("_taken", F.lit(0))).alias("room"),
                F.concat("_cuts", F.array(step)).alias("_cuts"),
            ),
            "rooms",
        )
    chosen = F.exists(
        F.transform(
            "_cuts",
            lambda c, i: (F.col("_rank") <= c["until"])
            & (F.col("size") <= c["room"])
            & ((i == 0) | (F.col("_rank") > F.col("_cuts")[F.greatest(i - 1, F.lit(0))]["until"])),
        ),
        lambda x: x,
    )
    out = ranked(base, state)
    extra = F.when((F.col("_p") > 0) & (F.col("size") > 0) & chosen, 1).otherwise(0)
    out = out.withColumn("copies", F.when(F.col("size") > 0, F.col("_whole") + extra).otherwise(0).cast("int"))
    columns = ["doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"]
    return out.select(*columns, *([F.col("_row").alias(row)] if row else []))


def ranked(base: DataFrame, state: DataFrame) -> DataFrame:
    """Documents with their certain copies, fraction and Pareto rank."""
    out = same_source(base, state)
    out = out.withColumn("_e", F.element_at(F.col("_by_class"), F.col("_weight")))
    out = out.withColumn("_whole", F.floor(F.col("_e") + 1e-9))
    out = out.withColumn("_p", F.greatest(F.lit(0.0), F.col("_e") - F.col("_whole")))
    odds = F.col("_u") / (1 - F.col("_u")) * (1 - F.col("_p")) / F.col("_p")
    key = F.when(F.col("_p") > 0, (odds / (1 + odds) * float(1 << KEY_BITS)).cast("long")).otherwise(1 << KEY_BITS)
    return out.withColumn("_rank", F.struct(key.alias("key"), F.col("_row").alias("row")))


def mixed_documents(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with all columns."""
    rows, row = numbered(docs, "documents")
    copies = fresh(rows, "_copies")
    taken = mix(rows, row, seed).where("copies > 0").select(row, F.col("copies").alias(copies))
    each = fresh(rows, "_copy")
    out = rows.join(taken, row).withColumn(each, F.explode(F.sequence(F.lit(1), F.col(copies))))
    return out.select(*docs.columns)
