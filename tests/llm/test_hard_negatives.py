import math
import random

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cargolens.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int, row int, slot int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, 2) for i, v, label in rows], SCHEMA)


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def by_hand(rows, every=50):
    kept = [(i, [math.floor(256 * x) for x in v], label, at) for at, (i, v, label) in enumerate(rows) if i is not None and label is not None and usable(v)]
    out = []
    for a, qa, la, ra in kept:
        if a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(qa, q)), i, at, label) for i, q, label, at in kept if at != ra]
        scored.sort()
        positives = [s for s in scored if s[3] == la][:5]
        others = [s for s in scored if s[3] != la]
        for ps, pid, *_ in positives:
            inside = [s for s in others if -50 * ps <= -100 * s[0] <= -95 * ps][:3]
            out += [(a, pid, k + 1, s[1], -ps, -s[0]) for k, s in enumerate(inside)]
    return sorted(out)


def made(n, dims=6, labels=4, seed=0, spread=1.0):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(dims)] for _ in range(3)]
    return [(i, [x + r.gauss(0, spread) for x in r.choice(centres)], r.randrange(labels)) for i in range(n)]


def found(frame, **options):
    return sorted(tuple(r) for r in hn.mine(frame, **options).collect())


ODD = [
    (None, [1.0] * 6, 1),
    (1000, None, 1),
    (1050, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1),
    (1100, [1.0, float("nan"), 0.0, 0.0, 0.0, 0.0], 1),
    (1150, [1.0, float("-inf"), 0.0, 0.0, 0.0, 0.0], 1),
    (1200, [1.0] * 6, None),
    (1250, [], 1),
    (1300, [0.5, 0.5], 2),
    (-50, [0.5] * 6, 2),
]


@pytest.mark.parametrize("block_values", [hn.BLOCK_VALUES, 12])
def test_against_brute_force(spark, block_values):
    """Also in blocks of two anchors, with nulls, short vectors and negative ids."""
    rows = made(420) + ODD
    got = found(vectors(spark, rows).repartition(5), block_values=block_values)
    assert got == by_hand(rows) and len(got) > 50


def test_ties_copies_and_a_hot_label(spark):
    """A third of all rows are one vector of one label; ids, not rows, break ties."""
    rows = made(150, seed=3) + [(200 + i, [1.0, 0.5, 0.0, 0.25, 1.0, 1.0], 1) for i in range(80)] + [(50, [0.75] * 6, 1)] * 3
    assert found(vectors(spark, rows).repartition(7)) == by_hand(rows)


def test_relabelling(spark):
    rows = [(7, 1), (14, 9), (8, 9), (0, 5)]
    frame = spark.createDataFrame(rows, "vec_id long, label int")
    assert {r["vec_id"]: r["label"] for r in hn.relabelled(frame).collect()} == {7: 2, 14: 0, 8: 9, 0: 6}


def test_empty_and_lonely(spark):
    assert found(vectors(spark, [])) == []
    assert found(vectors(spark, [(50, [1.0], 1)])) == []
    assert found(vectors(spark, [(50, [1.0], 1), (51, [0.6], 2)])) == []  # no positive
    assert found(vectors(spark, [(50, [1.0], 1), (51, [1.0], 1), (52, [0.6], 2)])) == [(50, 51, 1, 52, 65536, 256 * 153)]


@pytest.mark.parametrize("big", [2.0**20, 2.0**30, 2.0**50])
def test_exact_beyond_doubles(spark, big):
    r = random.Random(4)
    rows = [(i, [float(r.randrange(1, 1 << 20)) / 256 + big, float(r.randrange(100))], i % 3) for i in range(120)]
    want = by_hand(rows)
    if big == 2.0**50:  # scores end at the limits of a long
        a, b = np.array([[1 << 60, 5]]), np.array([[1 << 60, -3], [-(1 << 60), 0]])
        assert hn.products(a, b).tolist() == [[hn.LIMIT, -hn.LIMIT - 1]]
    else:
        assert found(vectors(spark, rows)) == want


@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-5, 5), st.integers(0, 9)), max_size=60), st.integers(1, 4), st.integers(1, 9))
def test_combiner_keeps_the_best(items, k, step):
    best = hn.Best(4, k)
    for at in range(0, len(items), step):
        g, s, i = (np.array(c, np.int64) for c in zip(*items[at : at + step]))
        rows = np.arange(at, at + len(g))
        enters = best.may_enter(g, s, i)
        best.add(g[enters], s[enters], i[enters], rows[enters])
    for g in range(4):
        want = sorted((-s, i, at) for at, (h, s, i) in enumerate(items) if h == g)[:k]
        mine = best.group == g
        assert sorted(zip((-best.score[mine]).tolist(), best.id[mine].tolist(), best.row[mine].tolist())) == want


def test_limits_are_exact():
    for p in [*range(-250, 250), 10**15 + 7]:
        (low,), (high,) = hn.limits([p])
        for s in {low - 1, low, high, high + 1, p // 2, p}:
            assert (low <= s <= high) == (50 * p <= 100 * s <= 95 * p)


def test_general_interface(spark):
    rows = made(60, seed=8)
    out = hn.mine(vectors(spark, rows), every=20, positives=2, negatives=1, low=10, high=99)
    assert out.groupBy("anchor_id", "positive_id").count().where("count > 1").isEmpty()
    assert out.where(F.col("anchor_id") % 20 != 0).isEmpty()
