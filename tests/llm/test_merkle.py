import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cargolens.llm import merkle
from tests.llm.helpers import docs, odd_rows


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def framed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels_by_hand(nodes, arity):
    levels = [nodes]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([sha("".join(low[i : i + arity])) for i in range(0, len(low), arity)])
    return levels


def steps(levels, at, arity):
    out = []
    for low in levels[:-1]:
        first = at - at % arity
        out.append(("".join(low[first:at]), "".join(low[at + 1 : first + arity])))
        at //= arity
    return out


def by_hand(rows, arity=3):
    """rows: (doc_id, text, lang, source); n_chars as the helper fills it in."""
    groups = defaultdict(list)
    for doc_id, text, lang, source in rows:
        line = lambda t: sha("".join(map(framed, (doc_id, source, lang, None if text is None else len(text), t))))  # noqa: B023, E731
        even = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0
        groups[source].append(((doc_id is not None, doc_id or 0), line(text), line(text.replace("\n", "")) if even and text is not None else line(text), doc_id))
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        groups[s].sort()
        trees[s] = levels_by_hand([g[1] for g in groups[s]], arity)
    top = levels_by_hand([trees[s][-1][0] for s in sources], arity)
    out = []
    for k, s in enumerate(sources):
        for at, (_, leaf, changed, doc_id) in enumerate(groups[s]):
            path = steps(trees[s], at, arity) + steps(top, k, arity)
            again = changed
            for left, right in path:
                again = sha(left + again + right)
            proof = sha("".join(left + right for left, right in path))
            out.append((doc_id, leaf, trees[s][-1][0], top[-1][0], proof, again, again == top[-1][0]))
    return sorted(out, key=str)


def found(frame, **options):
    out = merkle.manifest(frame, merkle.without_line_breaks(), **options).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )
    return sorted(map(tuple, out.collect()), key=str)


def full(rows):
    return [(*r, *[None] * (4 - len(r))) for r in rows]


def made(n, sources=7):
    hot = lambda i: None if i % 3 == 0 else f"s{i % sources}é"
    return [(i * 7 % 10007, f"text {i}\nline" if i % 2 else f"plain {i}", "en", hot(i)) for i in range(n)]


@pytest.mark.parametrize("digits", [1, 2, 5])
def test_against_brute_force(spark, digits):
    """Several rollups per tree with small blocks; a third of all rows in one source."""
    rows = made(400) + [(3, "lone\n", "en", "zz"), (4, None, None, "")] + [(9, "same\n", "en", "twins")] * 10
    got = found(docs(spark, rows).repartition(6), digits=digits)
    assert got == by_hand(rows)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28])
def test_one_source_of_every_shape(spark, n):
    rows = full([(i, f"t{i}\n", "en", "a") for i in range(n)])
    assert found(docs(spark, rows), digits=2) == by_hand(rows)


def test_only_lone_leaves(spark):
    rows = full([(1, "a\n", "en", None), (2, "b\n", "en", ""), (3, "c", "en", "x"), (4, "d", "en", "Ä")])
    assert found(docs(spark, rows)) == by_hand(rows)


def test_another_arity(spark):
    rows = made(70, 3)
    assert found(docs(spark, rows), arity=2, digits=3) == by_hand(rows, 2)


def test_odd_rows_and_clashing_columns(spark):
    rows = full(odd_rows() + [(None, None), (None, ""), (20, "-"), (21, "3:abc")])
    frame = docs(spark, rows).withColumns({c: F.lit(1) for c in ("h", "idx", "GRP", "item", "levels", "path", "row")})
    assert found(frame) == by_hand(rows)


def test_empty_table(spark):
    out = merkle.manifest(docs(spark, []))
    assert out.count() == 0 and "folded_root" in out.columns


def test_untouched_documents_verify(spark):
    assert merkle.manifest(docs(spark, made(50))).where("not verified").isEmpty()


def test_height_is_exact(spark):
    frame = spark.createDataFrame([(3**k + d,) for k in range(1, 39) for d in (-1, 0, 1)], "n long")
    got = {r["n"]: r["l"] for r in frame.select("n", merkle.height(F.col("n"), 3).alias("l")).collect()}
    for k in range(1, 39):
        assert got[3**k] == k and got[3**k + 1] == k + 1


def test_a_blocks_groupings_share_one_exchange(spark):
    """The digits of a block are grouped away without a further shuffle."""
    nodes = spark.createDataFrame([("a", 3, i, "h", None) for i in range(20)], "grp string, levels int, idx long, h string, item string")
    plan = merkle.blocks_of(nodes, 0, 3, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1, plan
