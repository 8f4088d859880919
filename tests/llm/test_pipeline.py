"""The pipeline and the registered queries on small tables."""

import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from cargolens.llm import queries, tokens
from cargolens.llm.staging import staged
from tests.llm.helpers import docs
from tests.llm.test_exact_mixing import lower, targets_by_hand
from tests.llm.test_langid import made
from tests.llm.test_near import brute, words_of
from tools.oracle_check import digest

ROWS_OF = {name: "pages" if name.startswith("op7") else "documents" for name in queries.QUERIES}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_cover_their_table(spark, sf_small, name):
    df = queries.QUERIES[name](spark, sf_small)
    if name.startswith("op12"):  # a query set against all rows: see its own test
        assert df.count() > 0
        return
    source = spark.read.parquet(f"{sf_small}/{ROWS_OF[name]}.parquet")
    key = "page_id" if ROWS_OF[name] == "pages" else "doc_id"
    rows = df.select(key).collect()
    want = {r[0] for r in source.select(key).collect()}
    assert {r[0] for r in rows} == want
    assert name.startswith("op5") or len(rows) == source.count()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_oracles(spark, sf_small, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    df = queries.QUERIES[name](spark, sf_small)
    rel = con.sql(queries.ORACLE_SQL[name])
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(rel.columns, rel.fetchall())[0]


def table():
    """Texts in three languages from two sources with exact and near copies, and rejects."""
    rows = [(d, " ".join((t.split() * 12)[:120]) + f" end{d}", lang, "ab"[d % 2]) for d, t, lang, _ in made(90)]
    rows += [(1000 + d, t.replace("e", "E") if d % 2 else t, lang, s) for d, t, lang, s in rows[:20]]
    rows += [(2000 + d, " ".join(t.split()[:-1] + ["other"]), lang, s) for d, t, lang, s in rows[20:40]]
    rows += [(3000, None, "en", "a"), (3001, "", "en", "b"), (3002, "12 34 56", "en", "a"), (40, rows[40][1], rows[40][2], rows[40][3])]
    return rows


def test_pipeline_against_brute_force(spark):
    rows = table()
    frame = docs(spark, rows).drop("text_2")
    # language ID: what has no letters goes
    kept = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    # exact: of equal texts one row with the largest id stays
    groups = defaultdict(list)
    for r in kept:
        groups[lower(r[1])].append(r)
    kept = [max(g, key=lambda r: r[0]) for g in groups.values()]
    # near: one document of each class stays, one with the least id
    by_id = {r[0]: r for r in kept}
    kept = [by_id[min(ids)] for ids in brute(kept).values()]
    out, steps = frame, []
    for name, stage in corpus_pipeline.STAGES:
        out = staged(stage(spark, out, ""), "test")
        steps.append(out)
        assert name == corpus_pipeline.STAGES[-1][0] or out.columns == frame.columns
    assert sorted(tuple(r)[:4] for r in steps[2].collect()) == sorted(kept)
    # mix: nobody more than twice, sources near their targets
    times = defaultdict(int)
    for r in steps[3].collect():
        times[r["doc_id"]] += 1
    assert set(times) <= {r[0] for r in kept} and max(times.values()) <= 2
    sizes, taken = defaultdict(int), defaultdict(int)
    for doc_id, text, _, source in kept:
        n = len(words_of(text))
        sizes[source] += n
        taken[source] += n * times[doc_id]
    for source, target in targets_by_hand(dict(sizes)).items():
        assert abs(taken[source] - target) <= 125
    # packing: every id of the mix, gapless, in sequences that are as few as can be
    placed, ids = defaultdict(list), defaultdict(int)
    enc = tokens.encoder(tokens.tokenizer_path())
    for r in steps[4].collect():
        placed[r["sequence_id"]].append((r["offset"], r["length"]))
        ids[r["doc_id"]] += r["length"]
        if r["piece"] == 0 and r["length"] <= 2048:
            whole = enc.encode_document(by_id[r["doc_id"]][1])
            assert r["ids_crc32"] == zlib.crc32(whole[: r["length"]].astype("<u4").tobytes())
    assert ids == {d: n * len(enc.encode_document(by_id[d][1])) for d, n in times.items()}
    for members in placed.values():
        ends = np.cumsum([n for _, n in sorted(members)])
        assert [a for a, _ in sorted(members)] == [0, *ends[:-1]] and ends[-1] <= 2048
    assert len(placed) <= -(-sum(ids.values()) // 2048) + 2


def test_pipeline_on_an_empty_table(spark):
    out = docs(spark, []).drop("text_2")
    for _, stage in corpus_pipeline.STAGES:
        out = staged(stage(spark, out, ""), "empty")
    assert out.count() == 0
