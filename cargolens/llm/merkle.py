"""Merkle manifest of a dataset, by nested-struct rollups.

Every document is a leaf, the hash of its fields. The leaves of a source,
ascending by doc_id, are hashed in runs of ``ARITY`` (the last run may be
shorter, even one) until one node is left, the source's subroot; the subroots,
in the order of their sources, give the root in the same way. A document's
proof is the hashes of the other nodes of its runs, from the leaf to the root.

Leaves are numbered by a range sort (no source is gathered in one task). The
digits of a node's number to the base ``ARITY`` say where it stands: grouping
by all but the last digit collects a run. That is done ``DIGITS`` times inside
a block of ``ARITY ** DIGITS`` nodes: each time the lowest digit is grouped
away, and the runs become structs that hold their children's structs. All these
groupings need the one partitioning by block. A block is one row of bounded
size; the blocks' hashes are the nodes of the next rollup.

On the way down a block's struct holds all that its proofs need: nested
transforms carry the path of siblings to each leaf, and explode emits one row
per leaf, without a join. The path from the root to a block is brought to it by
grouping the two rows of its number.

Edge cases: null fields count as ``-`` (with their own hash, unlike empty
ones); null ids come first, ties are ordered by leaf hash; a null source is a
source of its own (the first); repeated rows are leaves of their own; a lone
leaf is its source's subroot, and one source's subroot is the root; an empty
table gives an empty result; columns that are not named in ``fields`` are
ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens.llm.staging import ranked, staged

ARITY = 3
DIGITS = 5
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = "struct<l: string, r: string>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def framed(column: Column) -> Column:
    """A field as text that cannot be confused with another: its length, then it."""
    text = column.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(*fields: Column) -> Column:
    return digest(*[framed(f) for f in fields])


def height(total: Column, arity: int) -> Column:
    """How often runs are hashed until one node is left (no logarithm: exact)."""
    level = F.lit(0)
    for k in range(63):
        if arity**k >= 1 << 63:
            break
        level = F.when(total > arity**k, k + 1).otherwise(level)
    return level


def blocks_of(nodes: DataFrame, done: int, arity: int, digits: int) -> DataFrame:
    """One rollup: (grp, levels, idx, h, item) nodes to blocks (grp, levels,
    idx, h, c). ``h`` is the block's hash and ``c`` its nested structs.

    ``done`` levels lie below these nodes; a tree that has fewer levels than
    that hands its single node on unhashed.
    """
    nodes = nodes.withColumn("block", F.floor(F.col("idx") / arity**digits).cast("long"))
    for d in range(digits):
        nodes = nodes.withColumn(f"d{d}", F.pmod(F.floor(F.col("idx") / arity**d), F.lit(arity)).cast("int"))
    # a block's rows meet once; what follows groups by more columns than that
    rolled = nodes.drop("idx").repartition("grp", "block")
    content = "item"
    for d in range(digits):
        rest = ["grp", "levels", "block", *[f"d{k}" for k in range(d + 1, digits)]]
        child = F.struct(F.col(f"d{d}").alias("d"), "h", F.col(content).alias("c"))
        rolled = rolled.groupBy(*rest).agg(F.sort_array(F.collect_list(child)).alias("run"))
        hashed = digest(F.array_join(F.transform("run", lambda x: x["h"]), ""))
        rolled = rolled.withColumn("h", F.when(F.col("levels") > done + d, hashed).otherwise(F.col("run")[0]["h"]))
        content = "c"
        rolled = rolled.withColumnRenamed("run", "c")
    return rolled.withColumnRenamed("block", "idx")


def emitted(blocks: DataFrame, paths: DataFrame, done: int, arity: int, digits: int) -> DataFrame:
    """The nodes of all blocks with their paths: (grp, levels, h, idx, item, path).

    ``path`` lists the steps from the node up to the root: the hashes left and
    right of it in its run.
    """
    both = blocks.select("grp", "levels", "idx", "c", F.lit(None).cast(f"array<{STEP}>").alias("path"))
    both = both.unionByName(paths.select("grp", "idx", "path"), allowMissingColumns=True)
    both = both.groupBy("grp", "idx").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("levels", "c", "path")])

    def step(run: Column, i: Column, path: Column, level: int) -> Column:
        joined = lambda part: F.array_join(F.transform(part, lambda x: x["h"]), "")
        left = joined(F.slice(run, F.lit(1), i))
        right = joined(F.slice(run, i + 2, F.lit(arity)))
        own = F.array(F.struct(left.alias("l"), right.alias("r")))
        return F.when(F.col("levels") > done + level, F.concat(own, path)).otherwise(path)

    def walk(run: Column, path: Column, first: Column, level: int) -> Column:
        if level == 0:
            return F.transform(
                run,
                lambda x, i: F.struct((first * arity + x["d"]).alias("idx"), x["h"].alias("h"), x["c"].alias("item"), step(run, i, path, 0).alias("path")),
            )
        return F.flatten(F.transform(run, lambda x, i: walk(x["c"], step(run, i, path, level), first * arity + x["d"], level - 1)))

    nodes = F.explode(walk(F.col("c"), F.col("path"), F.col("idx"), digits - 1)).alias("node")
    return both.select("grp", "levels", nodes).select("grp", "levels", "node.*")


def rolled_up(nodes: DataFrame, arity: int, digits: int) -> tuple[DataFrame, list[DataFrame]]:
    """The one node left of every group (grp, levels, idx, h), and the blocks of each rollup."""
    most = nodes.agg(F.max("levels")).first()[0] or 0
    stages: list[DataFrame] = []
    done = 0
    while done < most:
        blocks = staged(blocks_of(nodes, done, arity, digits), "blocks")
        stages.append(blocks)
        nodes = blocks.select("grp", "levels", "idx", "h", F.lit(None).cast("string").alias("item"))
        done += digits
    return nodes.select("grp", "levels", "idx", "h"), stages


def paths_down(paths: DataFrame, stages: list[DataFrame], arity: int, digits: int) -> DataFrame:
    """From the paths (grp, idx, path) of the last nodes to those of the first."""
    for k in reversed(range(len(stages))):
        paths = emitted(stages[k], paths, k * digits, arity, digits)
        if k:
            paths = staged(paths.select("grp", "idx", "path"), "paths")
    return paths


def proofs(leaves: DataFrame, arity: int = ARITY, digits: int = DIGITS) -> DataFrame:
    """(grp, h, item, path, subroot, root) of every leaf of (grp, h, item, ...).

    ``leaves`` has its order inside a group in the columns ``order`` (a struct)
    and ``row``. ``item`` is a struct that comes back untouched.
    """
    placed = ranked(leaves, "grp", ["order", "row"])
    placed = staged(placed.select("grp", "idx", "h", "item", height(F.col("total"), arity).alias("levels")), "leaves")
    tops, stages = rolled_up(placed, arity, digits)
    tops = staged(tops.select("grp", "h"), "subroots")
    # the subroots are the leaves of one more tree; their item is their group
    upper = tops.select(F.lit(0).alias("grp"), "h", F.struct(F.col("grp").alias("grp")).alias("item"), F.struct("grp").alias("order"), F.lit(0).alias("row"))
    upper = ranked(upper, "grp", ["order", "row"])
    upper = staged(upper.select("grp", "idx", "h", "item", height(F.col("total"), arity).alias("levels")), "upper")
    root, upper_stages = rolled_up(upper, arity, digits)
    top = root.select("grp", "idx", F.expr(f"cast(array() as array<{STEP}>)").alias("path"))
    found = root.select("h").first()  # one row: the root
    if upper_stages:
        above = paths_down(top, upper_stages, arity, digits).select("h", "item", "path")
    else:
        above = upper.select("h", "item", F.expr(f"cast(array() as array<{STEP}>)").alias("path"))
    above = staged(above.select(F.col("item.grp").alias("grp"), F.lit(0).cast("long").alias("idx"), "path", F.col("h").alias("subroot")), "above")
    if stages:
        out = paths_down(above.select("grp", "idx", "path"), stages, arity, digits).select("grp", "h", "item", "path")
    else:  # every group is a lone leaf
        out = placed.select(F.col("grp").alias("_grp"), "h", "item").join(above.select("grp", "path"), F.col("_grp").eqNullSafe(F.col("grp"))).select("grp", "h", "item", "path")
    names = above.select(F.col("grp").alias("_grp"), "subroot")  # one row per source, the digest of each
    out = out.join(names, F.col("grp").eqNullSafe(F.col("_grp"))).drop("_grp")
    return out.withColumn("root", F.lit(found["h"] if found else None).cast("string"))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf's hash and its path give."""
    return F.aggregate(path, leaf, lambda h, step: digest(step["l"], h, step["r"]))


def siblings(path: Column) -> Column:
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["l"], s["r"])), ""))


def manifest(docs: DataFrame, tampered: dict[str, Column] | None = None, arity: int = ARITY, digits: int = DIGITS) -> DataFrame:
    """doc_id, source, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``tampered`` replaces fields (by name) before the second hash: the root is
    then recomputed from the changed leaf and the original siblings.
    """
    fields = {f: F.col(f) for f in FIELDS}
    changed = leaf_hash(*{**fields, **(tampered or {})}.values())
    leaf = leaf_hash(*fields.values())
    base = docs.select(
        F.col("source").cast("string").alias("grp"),
        leaf.alias("h"),
        F.struct(F.col("doc_id").cast("long").alias("doc_id"), changed.alias("changed")).alias("item"),
        F.monotonically_increasing_id().alias("row"),
    )
    base = staged(base, "hashes")
    out = proofs(base.withColumn("order", F.struct(F.col("item.doc_id").alias("doc_id"), "h")), arity, digits)
    again = folded(F.col("item.changed"), F.col("path"))
    out = out.select(
        F.col("item.doc_id").alias("doc_id"),
        F.col("grp").alias("source"),
        F.col("h").alias("leaf"),
        "subroot",
        "root",
        siblings(F.col("path")).alias("proof_sha256"),
        again.alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def without_line_breaks() -> dict[str, Column]:
    """Documents whose id has an even crc32 lose the line breaks of their text."""
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return {"text": F.when(F.coalesce(even, F.lit(False)), F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))}
