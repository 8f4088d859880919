import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cargolens.llm import near
from tests.llm.helpers import docs, odd_rows


def words_of(text):
    return re.findall("[^\x20\x09-\x0D]+", (text or "").lower())


def hashed(texts):
    ids = {}
    rng = np.random.default_rng(5)
    lists = [[ids.setdefault(w, int(rng.integers(-(2**62), 2**62))) for w in words_of(t)] for t in texts]
    offsets = np.cumsum([0, *map(len, lists)])
    return np.array([x for y in lists for x in y], dtype=np.int64), offsets


def shingle_sets(texts):
    out = []
    for t in texts:
        w = words_of(t)
        out.append(Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter())
    return out


def test_shingles_against_counters():
    r = random.Random(0)
    texts = ["", "a", "a b", "a b c d e", "a b c d e f " * 3] + [" ".join(r.choice("abc") for _ in range(r.randint(0, 40))) for _ in range(60)]
    doc, ids, times = near.shingles(*hashed(texts))
    found = defaultdict(dict)
    for d, i, n in zip(doc.tolist(), ids.tolist(), times.tolist(), strict=True):
        found[d][i] = n
    sets = shingle_sets(texts)
    name = {}
    for d, c in enumerate(sets):
        assert sorted(found[d].values()) == sorted(c.values())
    # equal shingles have equal ids across texts
    for a in range(len(texts)):
        for b in range(a):
            assert len(found[a].keys() & found[b].keys()) == len(sets[a].keys() & sets[b].keys()), name


def test_samples_estimate_weighted_jaccard():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 1 << near.ID_BITS, 1200).astype(np.uint64)
    w = rng.gamma(2, 2, 1200) + 0.1
    for same in (500, 900, 1080):
        other = np.concatenate([ids[:same], rng.integers(0, 1 << near.ID_BITS, 1200 - same).astype(np.uint64)])
        w2 = w * rng.uniform(0.8, 1.25, 1200)
        low = np.minimum(w, w2)[:same].sum()
        truth = low / (w.sum() + w2.sum() - low)
        got = []
        for part in range(20):
            shift = np.uint64(part * 0x9E3779B97)
            a, b = ((x + shift) * np.uint64(0x5851F42D4C957F2D) >> np.uint64(20) for x in (ids, other))
            got.append(np.mean(near.sign(np.zeros(1200, int), a, w, 1) == near.sign(np.zeros(1200, int), b, w2, 1)))
        assert np.mean(got) == pytest.approx(truth, abs=0.04)


def test_similarity_against_counters():
    texts = ["a b c d e f g h", "a b c d e f g x", "", "p q r s t", "x y"]
    pairs = [(0, 1), (0, 0), (2, 0), (3, 3), (4, 4), (1, 3)]
    import pyarrow as pa

    values, offsets = hashed(texts)
    lists = [values[offsets[i] : offsets[i + 1]].tolist() for i in range(len(texts))]
    a, b = (pa.array([lists[p[k]] for p in pairs], pa.list_(pa.int64())) for k in (0, 1))
    idf = np.ones(2 * near.WIDTH, np.float32)
    sets = shingle_sets(texts)
    want = [sum((sets[x] & sets[y]).values()) / max(1, sum((sets[x] | sets[y]).values())) for x, y in pairs]
    assert near.similarities(a, b, idf).tolist() == pytest.approx(want)


def planted(seed=0):
    """Unrelated texts, exact and near copies of some, and a chain."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 8))) for _ in range(2000)]
    text = lambda n: [r.choice(vocabulary) for _ in range(n)]
    boilerplate = text(30)
    rows, truth = [], {}
    for i in range(120):
        base = text(r.randint(80, 300))
        rows.append((i, " ".join(base + (boilerplate if i % 3 == 0 else []))))
    for i in range(40):
        source = rows[i][1].split()
        k = 1000 + 10 * i
        rows.append((k, " ".join(source).upper()))
        for j in range(3):
            edited = list(source)
            edited[r.randrange(len(edited))] = "changed"
            rows.append((k + 1 + j, " ".join(edited)))
        truth[i] = {i, k, k + 1, k + 2, k + 3}
    return rows, truth


def brute(rows, similarity=0.8):
    """Components of pairs above the similarity, with exact document frequencies over distinct texts."""
    sets = shingle_sets([t for _, t, *_ in rows])
    distinct = {" ".join(words_of(t)): c for (_, t, *_), c in zip(rows, sets, strict=True)}
    df = Counter(s for c in distinct.values() for s in c)
    n, m = len(rows), len(distinct)
    w = [{s: k * np.log1p(m / max(df[s], max(1.0, near.RARE * m))) for s, k in c.items()} for c in sets]
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by = defaultdict(list)
    for i, c in enumerate(sets):
        for s in c:
            by[s].append(i)
    for a, b in {(x, y) for group in by.values() if len(group) < 60 for x in group for y in group if x < y}:
        low = sum(min(w[a][s], w[b].get(s, 0)) for s in w[a])
        if low / (sum(w[a].values()) + sum(w[b].values()) - low) >= similarity:
            parent[find(a)] = find(b)
    empty = [i for i, c in enumerate(sets) if not c]
    for i in empty[1:]:
        parent[find(i)] = find(empty[0])
    groups = defaultdict(list)
    for i in range(n):
        groups[find(i)].append(rows[i][0])
    return groups


def test_classes_against_brute_force(spark):
    rows, truth = planted()
    rows += [(d if d is None else 5000 + d, *rest) for d, *rest in odd_rows()]
    out = near.classes(docs(spark, rows)).collect()
    assert len(out) == len(rows)
    want = sorted(sorted(str(d) for d in g) for g in brute(rows).values())
    groups = defaultdict(list)
    for r in out:
        groups[r["class_id"]].append(r)
    got = sorted(sorted(str(r["doc_id"]) for r in g) for g in groups.values())
    assert got == want
    for class_id, g in groups.items():
        assert sum(r["kept"] for r in g) == 1 and all(r["class_size"] == len(g) for r in g)
        assert class_id == min((r["doc_id"] for r in g if r["doc_id"] is not None), default=None)


@pytest.mark.parametrize("links", [0, near.TASK_LINKS])
def test_components(spark, monkeypatch, links):
    """By passing labels on, and in one task."""
    monkeypatch.setattr(near, "TASK_LINKS", links)
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60, 2)] + [(2 * i, 2 * i + 2) for i in range(40, 60)] + [(r.randrange(200, 260), r.randrange(200, 260)) for _ in range(40)] + [(9, 9), (7, 6)]
    parent = {x: x for e in edges for x in e}
    for _ in parent:
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    out = near.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {x["row"]: x["label"] for x in out} == parent and len(out) == len(parent)


def test_members_that_differ_from_the_first_are_not_lost(spark, monkeypatch):
    """With every text in one bucket and short steps, all links are still found."""
    rows, truth = planted(3)
    rows = [r for r in rows if r[0] < 12 or 1000 <= r[0] < 1080]
    monkeypatch.setattr(near, "bands_of", lambda signs: np.ones((len(signs), near.BANDS), np.int64))
    monkeypatch.setattr(near, "REACH", 2)
    out = near.classes(docs(spark, rows)).collect()
    groups = defaultdict(set)
    for r in out:
        groups[r["class_id"]].add(r["doc_id"])
    for i in range(8):
        assert groups[i] == truth[i]
    assert len(groups) == 12


def edited(r, words, share):
    """The words with single ones replaced until the plain shingle similarity is about ``share``."""
    sets = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    own, out = sets(words), list(words)
    while True:
        trial = list(out)
        trial[r.randrange(len(trial))] = f"edit{r.randrange(10**9)}"
        new = sets(trial)
        if len(own & new) / len(own | new) < share:
            return out
        out = trial


def test_edited_copies_of_a_hot_text(spark, monkeypatch):
    """A text that holds a third of all rows, its exact and its edited copies:
    what is common in them does not hide them, and pairs stay linear."""
    r = random.Random(11)
    vocabulary = [f"w{i}" for i in range(3000)]
    base = r.choices(vocabulary, k=300)
    rows = [(i, " ".join(base)) for i in range(120)]
    rows += [(1000 + i, " ".join(edited(r, base, 0.84 + 0.001 * (i % 100)))) for i in range(280)]
    rows += [(5000 + i, " ".join(r.choices(vocabulary, k=r.randint(20, 200)))) for i in range(600)]
    pairs = []
    real = near.verified
    monkeypatch.setattr(near, "verified", lambda p, *rest: pairs.append(p.count()) or real(p, *rest))
    out = {x["doc_id"]: x for x in near.classes(docs(spark, rows)).collect()}
    caught = sum(out[1000 + i]["class_id"] == 0 for i in range(280))
    assert caught >= 0.9 * 280, caught
    assert all(out[i]["class_id"] == 0 for i in range(120))
    assert all(out[5000 + i]["class_size"] == 1 for i in range(600))
    assert sum(pairs) <= 40 * 281, pairs  # all pairs of the group: 39,340


def test_a_stray_meets_the_whole_bucket(spark, monkeypatch):
    """Texts unlike each other in one bucket, and two pairs that no first step joins."""
    r = random.Random(2)
    rows = [(i, " ".join(f"w{r.randrange(10**6)}" for _ in range(40))) for i in range(60)]
    rows += [(100 + i, rows[i][1] + " more") for i in (7, 23)]
    monkeypatch.setattr(near, "bands_of", lambda signs: np.ones((len(signs), near.BANDS), np.int64))
    out = {x["doc_id"]: x["class_id"] for x in near.classes(docs(spark, rows)).collect()}
    assert out[107] == 7 and out[123] == 23 and len(set(out.values())) == 60


def hot_group(seed=4, copies=240):
    """A text, and copies with one to thirteen words replaced: most are below the similarity to any other."""
    r = random.Random(seed)
    base = [f"w{i}" for i in range(150)]
    rows = [(0, " ".join(base))]
    for i in range(1, copies):
        words = list(base)
        for at in r.sample(range(150), 1 + i % 13):
            words[at] = f"edit{r.randrange(10**9)}"
        rows.append((i, " ".join(words if i % 7 else words[: 150 - i % 5])))
    return rows


def test_copies_edited_too_much_are_not_compared_with_each_other(spark, monkeypatch):
    """Same classes as by brute force, without naming the pairs of strays, though all share every bucket."""
    rows = hot_group()
    rows += [(1000, rows[12][1].replace("w3 ", "other ")), (1001, rows[25][1].replace(" w140", " else"))]
    monkeypatch.setattr(near, "bands_of", lambda signs: np.ones((len(signs), near.BANDS), np.int64))
    monkeypatch.setattr(near, "RARE", 1.0)  # equal weights
    pairs = []
    real = near.verified
    monkeypatch.setattr(near, "verified", lambda p, *rest: pairs.append(p.count()) or real(p, *rest))
    groups = defaultdict(list)
    for r in near.classes(docs(spark, rows)).collect():
        groups[r["class_id"]].append(r["doc_id"])
    sets = shingle_sets([t for _, t in rows])
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            low = sum((sets[a] & sets[b]).values())
            if low / (sum(sets[a].values()) + sum(sets[b].values()) - low) >= 0.8:
                parent[find(a)] = find(b)
    want = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        want[find(i)].append(d)
    assert sorted(sorted(g) for g in groups.values()) == sorted(sorted(g) for g in want.values())
    assert len(want) > 100 and any(1000 in g and 12 in g for g in want.values())
    assert sum(pairs) < 0.15 * len(rows) ** 2 / 2, pairs


def test_spans(spark):
    """Places by weight, and the members within reach, against counting."""
    r = random.Random(9)
    members = [(b, i, float(r.randint(50, 90)), 0.0) for b in (1, 2) for i in range(60)]
    members = [(b, i, w, w * r.uniform(0.7, 1.25)) for b, i, w, _ in members]
    out = near.spans(spark.createDataFrame(members, "bucket long, row long, weight double, reach double"), 0.8).collect()
    assert len(out) == 120
    of = {(b, i): (w, reach) for b, i, w, reach in members}
    for x in out:
        w, reach = of[x["bucket"], x["row"]]
        weights = sorted(v for (b, _), (v, _) in of.items() if b == x["bucket"])
        low = sum(v < w * (0.8 - near.SLACK) for v in weights)
        assert x["low"] == low and x["width"] == max(0, sum(v <= reach for v in weights) - low)
        assert weights[x["idx"]] == w
    assert sorted(x["idx"] for x in out) == sorted([*range(60)] * 2)


def test_many_null_and_equal_ids(spark):
    """Texts are found by row, not by id: equal and null ids do not multiply."""
    rows = [(None if i % 2 else 5, f"text number {i // 2} of the rows without a name") for i in range(200)]
    out = near.classes(docs(spark, rows))
    assert out.count() == 200 and out.where("kept").count() == 100


def test_distinct_documents(spark):
    rows, truth = planted(1)
    frame = docs(spark, rows + [(2, rows[2][1])]).withColumn("KEY", F.lit(1)).withColumn("signs", F.lit(2))
    out = near.distinct_documents(frame)
    assert out.columns == frame.columns
    assert sorted(r["doc_id"] for r in out.collect()) == list(range(120))


def test_empty(spark):
    assert near.classes(docs(spark, [])).count() == 0
    assert near.classes(docs(spark, [(1, None), (2, "")])).where("kept").count() == 1
