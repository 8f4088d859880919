import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cargolens.llm import langid
from tests.llm.helpers import docs, odd_rows


def test_gradients_by_finite_differences():
    model = langid.new_model(["a", "b", "c"], hidden=3)
    model = langid.Model(model.langs, *[[w.astype(np.float64) for w in ws] for ws in (model.tables, model.recurrent)], model.out.astype(float), model.bias.astype(float))
    rng = np.random.default_rng(1)
    windows, labels = rng.integers(0, 256, (7, 5)), np.array([0, 1, 2, 1, 0])
    _, grads = langid.gradients(model, windows, labels)
    for w, g in zip(model.parameters(), grads, strict=True):
        flat = np.argsort(-np.abs(g).ravel())[:3]
        for i in flat:
            at = np.unravel_index(i, w.shape)
            keep = w[at]
            w[at] = keep + 1e-3
            up = langid.gradients(model, windows, labels)[0]
            w[at] = keep - 1e-3
            down = langid.gradients(model, windows, labels)[0]
            w[at] = keep
            assert g[at] == pytest.approx((up - down) / 2e-3, rel=2e-2, abs=1e-4)


def test_windows_pool_to_documents():
    model = langid.new_model(["a", "b"])
    texts = [b"x", b"hello " * 100, b"\xc3\xa9" * 48, b"y" * 97]
    together = langid.label_texts(model, texts)
    for t, p in zip(texts, together, strict=True):
        assert langid.label_texts(model, [t])[0] == pytest.approx(p, abs=1e-5)
        assert p.sum() == pytest.approx(1)


LANGS = {"en": ["the", "and", "tion", "ing", "wh"], "de": ["sch", "ung", "ü", "ein", "ge"], "fr": ["eau", "é", "que", "oi", "ment"]}


def made(n, seed=0):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        lang = r.choice(list(LANGS))
        words = ["".join(r.choice(LANGS[lang]) for _ in range(r.randint(1, 4))) for _ in range(r.randint(5, 120))]
        rows.append((i, " ".join(words), lang, "s"))
    return rows


def test_held_out_accuracy(spark):
    rows = made(300)
    out = {r["doc_id"]: r for r in langid.identify(docs(spark, rows)).collect()}
    held = [d for d, *_ in rows if zlib.crc32(str(d).encode()) % 3 == 1]
    assert [d for d in out if out[d]["held_out"]] == sorted(held) or {d for d in out if out[d]["held_out"]} == set(held)
    right = sum(out[d]["lang_pred"] == lang for d, _, lang, _ in rows if d in set(held))
    assert right >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in out.values())


def test_odd_rows_and_labels_are_not_inputs(spark):
    rows = made(200) + [(1000 + (r[0] or 0), r[1], None, None) for r in odd_rows()] + [(5000, "12 34 !?", "en", "s")]
    out = {r["doc_id"]: r for r in langid.identify(docs(spark, rows)).collect()}
    assert out[1001]["lang_pred"] == out[1002]["lang_pred"] == out[5000]["lang_pred"] == langid.UNKNOWN
    assert {r["lang_pred"] for r in out.values()} <= {*LANGS, langid.UNKNOWN}


def test_empty_and_unlabelled(spark):
    assert langid.identify(docs(spark, [])).count() == 0
    assert langid.identify(docs(spark, [(1, "text")])).first()["lang_pred"] == langid.UNKNOWN


def test_seventy_languages(spark):
    """Rare languages are learned too, however many there are."""
    r = random.Random(7)
    letters = "abcdefghijklmnopqrstuvwxyz"
    parts = {f"l{k:02d}": [letters[k % 26] + letters[(k * 7 + j * 3) % 26] + letters[(k // 26 + 5 * j) % 26] for j in range(3)] for k in range(70)}
    rows = [(i, " ".join("".join(r.choice(parts[f"l{i % 70:02d}"]) for _ in range(3)) for _ in range(25)), f"l{i % 70:02d}") for i in range(70 * 12)]
    out = {x["doc_id"]: x for x in langid.identify(docs(spark, rows)).collect()}
    held = [row for row in rows if out[row[0]]["held_out"]]
    assert sum(out[d]["lang_pred"] == lang for d, _, lang in held) >= 0.9 * len(held)
    assert len({x["lang_pred"] for x in out.values()}) == 70


def test_unlabelled_corpus_is_kept(spark):
    out = langid.identified_documents(docs(spark, [(1, "some text"), (2, "123"), (3, None)]))
    assert [x["doc_id"] for x in out.collect()] == [1]


def test_identified_documents(spark):
    frame = docs(spark, made(200) + [(900, None), (901, "123")]).withColumn("_SCORE", F.lit(1))
    out = langid.identified_documents(frame)
    assert out.columns == frame.columns
    assert {r["doc_id"] for r in out.collect()} == set(range(200))
