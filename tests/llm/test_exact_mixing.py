import hashlib
import re
from collections import Counter, defaultdict

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cargolens.llm import exact, mixing, staging
from tests.llm.helpers import docs, odd_rows


@given(st.lists(st.integers(0, 30), max_size=300), st.integers(1, 10))
def test_misra_gries_bound(items, counters):
    sketch = exact.MisraGries(counters)
    for i in range(0, len(items), 7):
        sketch.add(items[i : i + 7])
    true = Counter(items)
    assert len(sketch.counts) <= counters
    for k, n in true.items():
        assert n - len(items) / (counters + 1) <= sketch.counts.get(k, 0) <= n


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("counters", [1, 3, 1023])
def test_exact_against_brute_force(spark, counters):
    rows = odd_rows() + [(100 + i, ["Same Text", "same text", "É", "é"][i % 4]) for i in range(40)] + [(500, "twice")] * 3
    out = exact.mark(docs(spark, rows), counters=counters).collect()
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[lower(text)].append(doc_id)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    assert len(out) == len(rows)
    for r in out:
        ids = by_sha[r["text_sha256"]]
        assert r["group_size"] == len(ids) and r["doc_id"] in ids
        assert r["keep_id"] == max((i for i in ids if i is not None), default=None)
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
    kept = Counter(r["text_sha256"] for r in out if r["kept"])
    assert kept == Counter(by_sha.keys())


def test_distinct_documents_keeps_columns(spark):
    frame = docs(spark, [(1, "A"), (2, "a"), (2, "a"), (3, "b")]).withColumn("_ROW", F.lit(1))
    out = exact.distinct_documents(frame)
    assert out.columns == frame.columns
    assert sorted((r["doc_id"], r["text"]) for r in out.collect()) == [(2, "a"), (3, "b")]


def test_exact_empty(spark):
    assert exact.mark(docs(spark, [])).count() == 0


def targets_by_hand(sizes, weights=(3, 1, 2), share=1.5, most=2):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, out, free = share * sum(sizes.values()), {}, set(names)
    while free:
        level = (total - sum(out.values())) / sum(w[s] for s in free)
        above = {s for s in free if level * w[s] > most * sizes[s]}
        if not above:
            return out | {s: level * w[s] for s in free}
        out |= {s: float(most * sizes[s]) for s in above}
        free -= above
    return out


@pytest.mark.parametrize("seed", range(3))
def test_targets_against_brute_force(spark, seed):
    """One to thirty sources at once, of equal, random and empty sizes."""
    import random

    r = random.Random(seed)
    for n in [1, 2, 3, 6, 20, 29, 30]:
        names = [f"s{i:02d}" for i in range(n - 1)] + [None if n % 2 else "zz"]
        sizes = {s: 100 if seed == 0 else r.choice([0, 1, r.randint(1, 50), r.randint(1, 10**6)]) for s in names}
        frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {row["source"]: row["target"] for row in mixing.source_targets(frame).collect()}
        assert got == pytest.approx(targets_by_hand(sizes), rel=1e-9, abs=1e-6)
        assert sum(got.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_mix(spark):
    rows = [(i, "w " * (i * 37 % 90 + (5000 if i == 7 else 0)), "en", ["a", "b", "c", "d", None][min(i % 7, 4)]) for i in range(700)]
    rows += odd_rows() + [(3, "w w", "en", "solo")]
    frame = docs(spark, rows)
    out = mixing.mix(frame, row=None).collect()
    again = mixing.mix(frame.repartition(5)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    assert len(out) == len(rows)
    sizes = defaultdict(int)
    for _, text, *rest in rows:
        sizes[rest[1] if len(rest) > 1 else None] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = targets_by_hand(dict(sizes))
    by_target, longest = defaultdict(int), defaultdict(int)
    for r in out:
        longest[r["source_size"]] = max(longest[r["source_size"]], r["size"])
    even = {n for n, most in longest.items() if 20 * most < n}
    assert even
    for r in out:
        assert r["taken"] == r["copies"] * r["size"] and r["copies"] <= 2
        by_target[r["source_size"], r["target"]] += r["taken"]
    assert sorted(round(t, 6) for t in want.values()) == pytest.approx(sorted(round(t, 6) for _, t in by_target), abs=1e-5)
    for (size, target), taken in by_target.items():
        assert taken <= target + 1e-6
        if size in even:  # no single document decides
            assert target - taken <= 0.01 * target


def test_mixed_documents(spark):
    frame = docs(spark, [(i, "w " * 20, "en", "ab"[i % 2]) for i in range(60)] + [(5, "w w", "en", "b")] * 2)
    out = mixing.mixed_documents(frame)
    assert out.columns == frame.columns
    words = sum(len(r["text"].split()) for r in out.collect())
    assert abs(words - 1.5 * (1200 + 4)) < 45


def test_inclusion_is_unequal_and_right(spark):
    """Over many seeds a document is taken about as often as it expects."""
    frame = docs(spark, [(i, "w " * (4 if i % 2 else 400), "en", "a") for i in range(400)])
    out = [r for seed in range(3) for r in mixing.mix(frame, seed=seed).select("size", "copies").collect()]
    mean = {s: sum(r["copies"] for r in out if r["size"] == s) / 600 for s in (4, 400)}
    assert mean[400] > mean[4] > 0.8
    assert mean[4] / mean[400] == pytest.approx(11 / 17, abs=0.05)


def test_mix_empty(spark):
    assert mixing.mix(docs(spark, [])).count() == 0
    assert mixing.mix(docs(spark, [(1, None), (2, "")])).where("taken > 0").count() == 0


def test_numbered_documents_are_packed_tightly(spark):
    rows, row = staging.numbered(docs(spark, [(1, "a text"), (2, None), (2, None)]), "documents")
    assert rows.inputFiles() and all(f.endswith(".zstd.parquet") for f in rows.inputFiles())
    assert rows.count() == 3 == rows.select(row).distinct().count()
