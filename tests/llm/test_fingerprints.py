import hashlib
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from cargolens.llm import fingerprints as fp
from tests.llm.helpers import docs, odd_rows

SPACES = " \t\n\x0b\f\r"


def split(text):
    for c in SPACES[1:]:
        text = text.replace(c, " ")
    return [w for w in text.lower().split(" ") if w]


def shingle_set(text):
    words = split(text)
    starts = range(max(1, len(words) - 4)) if words else []
    return {tuple(words[i : i + 5]) for i in starts}


def signed(n):
    return n - (1 << 64) if n >> 63 else n


def hash_of(shingle):
    seed = 42
    for w in shingle:
        word = xxhash.xxh64(w.encode(), seed=42).intdigest()
        seed = xxhash.xxh64(word.to_bytes(8, "little"), seed=seed).intdigest()
    return seed >> 16


def sketch_by_hand(text):
    hashes = {hash_of(s) for s in shingle_set(text)}
    return sorted(h for h in hashes if h < fp.THRESHOLD) or sorted(hashes)[:1]


def likeness_by_hand(a, b):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def by_hand(rows):
    """rows in table order; ids descending, null last, ties in table order."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, -(rows[i][0] or 0), i))
    out = []
    for at, i in enumerate(order):
        doc_id, text = rows[i][0], rows[i][1] or ""
        after = rows[order[(at + 1) % len(order)]][1] or ""
        k = len(text) // 3
        edited = text[: len(text) - k] + after[:k]
        own, new, nxt = map(sketch_by_hand, (text, edited, after))
        line = lambda s: "".join(f"{h:012x}" for h in s)
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), line(own), line(new),
                    round(likeness_by_hand(own, new), 9), round(likeness_by_hand(own, nxt), 9)))
    return out


def made(n, seed=1):
    r = random.Random(seed)
    vocabulary = ["".join(r.choices("abcdeé漢", k=r.randint(1, 6))) for _ in range(400)]
    return [(i * 3 % 1009, " ".join(r.choices(vocabulary, k=r.choice([1, 4, 5, 6, 40, 300]))) + r.choice(["", "\n", " x"])) for i in range(n)]


@pytest.mark.parametrize("rows", [made(120), [(5, "Alone and free, one two three")], [(1, None), (2, "")], [(7, "same text here")] * 5])
def test_against_brute_force(spark, rows):
    frame = docs(spark, rows).coalesce(1)  # one partition: the table's order is the rows' order
    got = [(r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"], round(r["near_edited"], 9), round(r["near_next"], 9))
           for r in fp.compare(frame).collect()]
    assert sorted(map(str, got)) == sorted(map(str, by_hand(rows)))


def test_odd_rows_over_many_partitions(spark):
    """Null ids, a hot id that spans ranges, very long texts, clashing columns."""
    rows = odd_rows() + [(77, f"tied text number {i} of them") for i in range(60)] + [(None, f"no id {i}") for i in range(30)]
    frame = docs(spark, rows).repartition(4).withColumns({"row": F.lit(1), "N": F.lit(2), "sketch": F.lit(3), "part": F.lit(4)})
    out = fp.compare(frame).collect()
    assert len(out) == len(rows)
    texts = {}
    for r in out:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 and 0 <= r["kept_share"] <= 1
    for doc_id, text, *_ in rows:
        texts.setdefault(doc_id, set()).add("".join(f"{h:012x}" for h in sketch_by_hand(text or "")))
    for r in out:
        assert r["fingerprint"] in texts[r["doc_id"]]
    # every text gives its beginning to exactly one other: the likeness to the next is that of some text
    assert {r["n_chars"] for r in out} == {len(t or "") for _, t, *_ in rows}


def test_empty_table(spark):
    assert fp.compare(docs(spark, [])).count() == 0


def test_merge_and_containment_of_unequal_texts(spark):
    r = random.Random(5)
    words = [f"w{r.randrange(10**6)}" for _ in range(20000)]
    big, small, other = " ".join(words), " ".join(words[3000:3400]), " ".join(f"v{r.randrange(10**6)}" for _ in range(400))
    frame = spark.createDataFrame([(big, small, other, "")], "big string, small string, other string, none string")
    for name in ("big", "small", "other", "none"):
        frame = fp.with_sketch(frame, name, f"{name}_s")
    frame = frame.withColumn("two", F.concat_ws(" ", "small", "other"))
    frame = fp.with_sketch(frame, "two", "two_s")
    c = {n: F.col(f"{n}_s") for n in ("big", "small", "other", "none", "two")}
    row = frame.select(
        fp.containment(c["small"], c["big"]).alias("inside"),
        fp.containment(c["other"], c["big"]).alias("outside"),
        fp.containment(c["big"], c["small"]).alias("back"),
        fp.likeness(fp.merged(c["small"], c["other"]), c["two"]).alias("merge"),
        (fp.merged(c["small"], c["none"]) == c["small"]).alias("same"),
        (fp.loaded(fp.written(c["big"])) == c["big"]).alias("round_trip"),
    ).first()
    assert row["inside"] == 1 and row["outside"] == 0
    assert abs(row["back"] - 400 / 20000) < 0.01
    assert row["merge"] > 0.9  # all but the shingles across the seam
    assert row["same"] and row["round_trip"]


def test_estimates_are_near_the_truth(spark):
    rows = made(400, seed=9)
    got = fp.compare(docs(spark, rows).coalesce(1)).select("doc_id", "near_edited", "n_chars").collect()
    truth = {}
    order = sorted(range(len(rows)), key=lambda i: -rows[i][0])
    for at, i in enumerate(order):
        text, after = rows[i][1], rows[order[(at + 1) % len(order)]][1]
        k = len(text) // 3
        a, b = shingle_set(text), shingle_set(text[: len(text) - k] + after[:k])
        truth[rows[i][0]] = (len(a & b) / len(a | b), len(a))
    errors = [abs(r["near_edited"] - truth[r["doc_id"]][0]) for r in got if truth[r["doc_id"]][1] > 200]
    assert errors and sum(errors) / len(errors) < 0.1
