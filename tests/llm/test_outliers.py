import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cargolens.llm import outliers
from tests.llm.helpers import docs, odd_rows

SPACE = "\x20\x09-\x0D"


def counts(text):
    words = re.findall(f"[^{SPACE}]+", text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(f"[^{SPACE}]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w in windows if windows.count(w) > 1} if len(windows) < 2000 else {w for w in windows}
    inside = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(inside)


def test_counts(spark):
    r = random.Random(1)
    pieces = ["a", "b", "é", "#x", " ", "\n", "\t", "<", "\x0b", "word", "word\nword", "漢字"]
    rows = odd_rows() + [(100 + i, " ".join(r.choice(pieces) for _ in range(r.randint(0, 60)))) for i in range(200)]
    out = outliers.judge(docs(spark, rows)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted(str((r["doc_id"], *[r[n] for n in names])) for r in out) == sorted(str((d, *counts(t))) for d, t, *_ in rows)
    for r in out:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_chi2():
    assert outliers.chi2_cdf(4.351460, 5) == pytest.approx(0.5, abs=1e-6)
    assert outliers.chi2_quantile(0.975, 5) == pytest.approx(12.8325, abs=1e-3)


def mcd_by_hand(x, steps):
    """The same estimate in numpy."""
    noise = np.diag(np.array(list(outliers.NOISE.values())) ** 2)
    q = np.round(x * outliers.UNIT)
    x = q / outliers.UNIT
    m = np.median(q, axis=0)
    s = np.diag((np.median(np.abs(q - m), axis=0) * 1.4826 / outliers.UNIT) ** 2) + noise
    m = m / outliers.UNIT
    d = lambda: np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(s), x - m)
    for _ in range(steps):
        t = np.minimum(np.round(d() * 64), 1 << 16)
        near = x[t <= np.median(t)]
        m, s = near.mean(0), np.cov(near.T, bias=True) * outliers.consistency(0.5) + noise
    near = x[d() <= outliers.chi2_quantile(0.975, outliers.DIMS)]
    m, s = near.mean(0), np.cov(near.T, bias=True) * outliers.consistency(0.975) + noise
    return d()


def test_estimate_against_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 5)) @ rng.normal(size=(5, 5)) * 0.3 + 3
    x[:60] += 4  # a tight cluster of outliers
    rows = [(i, *[int(v) for v in np.round(r * outliers.UNIT)]) for i, r in enumerate(x)]
    fit = spark.createDataFrame(rows, ["doc_id", *[f"_x{i}" for i in range(5)]]).withColumn("_group", F.lit("g"))
    state = outliers.start(fit)
    for _ in range(3):
        near = outliers.distances(fit, state).withColumn("_t", F.least(F.round(F.col("_d") * 64), F.lit(1 << 16)).cast("long"))
        half = near.groupBy("_group").agg(F.percentile("_t", 0.5).alias("_half"))
        state = outliers.moments(near.join(half, "_group").where("_t <= _half"), outliers.consistency(0.5))
        state = spark.createDataFrame(state.collect(), state.schema)
    last = outliers.distances(fit, state).where(F.col("_d") <= outliers.chi2_quantile(0.975, 5))
    state = outliers.moments(last, outliers.consistency(0.975))
    found = dict(outliers.distances(fit, state).select("doc_id", "_d").collect())
    want = mcd_by_hand(x, 3)
    assert [found[i] for i in range(600)] == pytest.approx(want.tolist(), rel=1e-6)


def test_rejects_outliers_and_keeps_clean(spark):
    r = random.Random(2)
    vocabulary = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9))) for _ in range(3000)]
    rows = [(i, " ".join(r.choice(vocabulary) for _ in range(r.randint(60, 900))), "en", "ab"[i % 2]) for i in range(400)]
    rows += [(1000 + i, " ".join(r.choice(vocabulary) + "###$$$" for _ in range(200)), "en", "a") for i in range(20)]
    out = {x["doc_id"]: x["kept"] for x in outliers.judge(docs(spark, rows)).collect()}
    assert all(out[i] for i in range(400)) and not any(out[1000 + i] for i in range(20))


def test_one_bad_statistic_rejects(spark):
    """Each of symbols, repeated lines and repeated words decides by itself; one repeat of a line does not."""
    r = random.Random(6)
    vocabulary = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9))) for _ in range(3000)]
    line = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    lines = lambda n: [line(20) for _ in range(n)]
    rows = [(i, "\n".join(lines(r.randint(5, 30))), "en", "a") for i in range(400)]
    rows += [(1000 + i, "\n".join(" ".join(w[:-1] + "|" if k % 2 else w for k, w in enumerate(x.split())) for x in lines(15)), "en", "a") for i in range(5)]
    for i in range(5):
        short, half = [line(3) for _ in range(10)], lines(15)
        rows.append((2000 + i, "\n".join(short + short + half[:5]), "en", "a"))  # 10 of 25 lines
        rows.append((3000 + i, "\n".join([line(120), *[x + " " + line(2) for x in half[:2]], *[x + " " + line(2) for x in half[:2]]]), "en", "a"))
        once = lines(6)
        rows.append((4000 + i, "\n".join([*once[:5], line(2), once[5], line(2)]), "en", "a"))
        rows[-1] = (4000 + i, rows[-1][1] + "\n" + rows[-1][1].split("\n")[5], "en", "a")
    out = {x["doc_id"]: x for x in outliers.judge(docs(spark, rows)).collect()}
    assert not any(x["base_failed"] for x in out.values())
    assert all(out[i]["kept"] for i in range(400)) and all(out[4000 + i]["kept"] for i in range(5))
    assert not any(out[k + i]["kept"] for k in (1000, 2000, 3000) for i in range(5))


def test_empty(spark):
    assert outliers.judge(docs(spark, [])).count() == 0
