import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cargolens.llm import packing, tokens, wavelet
from tests.llm.helpers import docs, odd_rows


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.tokenizer_path())
    t.encode_special_tokens = True
    return t


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab1'sé.,| \n\t\r\v\x1c\x85\xa0漢İ<>", max_size=60))
def test_ids_equal_the_library(text):
    from tokenizers import Tokenizer

    t = test_ids_equal_the_library.__dict__.setdefault("t", Tokenizer.from_file(tokens.tokenizer_path()))
    assert tokens.encoder(tokens.tokenizer_path()).encode(text).tolist() == t.encode(text, add_special_tokens=False).ids


def test_new_words_go_straight_to_the_merges(library, monkeypatch):
    enc = tokens.Encoder(tokens.tokenizer_path())
    looked, find = [], enc.findall
    monkeypatch.setattr(enc, "findall", lambda piece: looked.append(piece) or find(piece))
    text = "Start thesntha laarciñ ofanstinor, eanton!? Vioié. don't ªº a1 ɐb ..."
    assert enc.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
    assert looked == ["Start", " don't", " a1", " ..."]


ODD_TEXTS = [None, "", " ", "  ", "a ", " a", "a  b", "\n a", "a\n b c", "é\xa0 b", "x\u3000 y z", "漢 İb the", "end.\nNew thrn, the.", "<|endoftext|> ÿ Ġ", "a\x1c b"]


def test_texts_encoded_together_ask_the_library_once_a_word(library, monkeypatch):
    monkeypatch.setattr(tokens, "TOGETHER_CHARS", 4000)
    enc = tokens.Encoder(tokens.tokenizer_path())
    plain = [f"start {w} thonti, {w}. er{w}\nNew{w} {w}" for w in ("sttible", "hereath", "éleçque", "ouédies")]
    rows = list(enumerate(plain * 300 + ODD_TEXTS * 3))
    singly = []
    merge = enc.merge
    monkeypatch.setattr(enc, "merge", lambda letters: singly.append(letters) or merge(letters))
    out = list(enc.encode_documents(iter(rows[: len(plain) * 300])))
    assert singly == ["start"]  # a first piece, which follows no blank
    out += enc.encode_documents(iter(rows[len(plain) * 300 :]))
    assert [i for i, _ in out] == [i for i, _ in rows]
    for (_, ids), (_, text) in zip(out, rows, strict=True):
        assert ids.tolist() == [*library.encode(text or "", add_special_tokens=False).ids, tokens.END_ID]
    assert list(enc.encode_documents([])) == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab1'sé.,| \n\t\r\v\x1c\x85\xa0\u2003\u3000漢İÿ<>", max_size=40), max_size=6))
def test_texts_encoded_together_are_as_encoded_singly(texts):
    enc = tokens.encoder(tokens.tokenizer_path())
    out = [ids.tolist() for _, ids in enc.encode_documents(enumerate(texts))]
    assert out == [enc.encode_document(t).tolist() for t in texts]


def test_words_take_several_calls(library, monkeypatch):
    monkeypatch.setattr(tokens, "CALL_WORDS", 3)
    enc = tokens.Encoder(tokens.tokenizer_path())
    words = [" thesntha", "\n", " éanton", "漢", " ", "ÿ", "..."]
    assert [np.frombuffer(b, "<u2").tolist() for b in enc._words(words)] == [library.encode(w, add_special_tokens=False).ids for w in words]


@pytest.mark.parametrize("n", [0, 1, wavelet.STEP, 2 * wavelet.STEP + 5])
def test_parting_and_rejoining(n):
    rng = np.random.default_rng(n)
    ids, bit = rng.integers(0, 1 << 16, n).astype(np.uint16), rng.integers(0, 2, n).astype(bool)
    out = wavelet.parted(ids, bit, n - int(bit.sum()))
    assert (out == np.concatenate([ids[~bit], ids[bit]])).all()
    assert (wavelet.rejoined(out, bit, n - int(bit.sum())) == ids).all()


def test_kept_pieces_are_bounded():
    kept = tokens._Kept(lambda p: p.encode(), 3 * (tokens.ENTRY_BYTES + 2))
    assert [kept[c] for c in "abcdea"] == [c.encode() for c in "abcdea"] and len(kept) <= 3


def first_fit_bins(lengths, capacity):
    bins = []
    for n in sorted(lengths, reverse=True):
        for i, b in enumerate(bins):
            if b + n <= capacity:
                bins[i] += n
                break
        else:
            bins.append(n)
    return len(bins)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=120))
def test_plan_uses_every_length_once(lengths):
    counts = np.bincount(lengths, minlength=51)
    recipes = packing.plan(counts, 50)
    used = np.zeros(51, dtype=int)
    for items, times in recipes:
        assert times > 0 and sum(n * c for n, c in items) <= 50
        for n, c in items:
            used[n] += c * times
    assert (used == counts).all()
    assert sum(t for _, t in recipes) <= first_fit_bins(lengths, 50) * 11 / 9 + 1


def test_two_fit_replaces_the_smallest():
    # greedy fills 10 with 6 + 3; 2 + 2 fill the gap of 4 better than 3
    recipes = packing.plan(np.bincount([6, 3, 2, 2], minlength=11), 10)
    assert recipes[0] == ([(6, 1), (2, 2)], 1)


def check_packed(rows, doc_lengths, capacity):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for members in by_sequence.values():
        at = 0
        for offset, n in sorted(members):
            assert offset == at
            at += n
        assert at <= capacity
    assert sum(r["length"] for r in rows) == sum(doc_lengths)
    return len(by_sequence)


def test_pack_odd_rows(spark, library):
    rows = odd_rows()
    out = packing.pack(docs(spark, rows)).collect()
    lengths = [len(library.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, *_ in rows]
    n = check_packed(out, lengths, 2048)
    assert n <= -(-sum(lengths) // 2048) + 1
    long = sorted((r["piece"], r["start"], r["length"]) for r in out if r["doc_id"] == 4)
    assert [p for p, _, _ in long] == list(range(len(long)))
    assert all(k == 2048 for _, _, k in long[1:])
    assert sum(r["doc_id"] == 6 for r in out) == 2


def test_sequences_hold_the_ids(spark, library):
    rows = [(i, "some words and more " * (i % 7) + str(i)) for i in range(40)] + [(3, "twin"), (3, "twin"), (None, "n")]
    frame = docs(spark, rows)
    packed = packing.pack(frame, max_tokens=64)
    found = {r["sequence_id"]: r["ids"] for r in packing.sequences(frame, packed, max_tokens=64).collect()}
    for r in packed.collect():
        own = found[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]]
        assert zlib.crc32(np.array(own, "<u4").tobytes()) == r["ids_crc32"]
    assert sum(map(len, found.values())) == sum(len(library.encode(t, add_special_tokens=False).ids) + 1 for _, t in rows)


def test_pack_empty(spark):
    assert packing.pack(docs(spark, [])).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from([0, 1, 7, 255, 256, 50256, 65535]), max_size=1300))
def test_wavelet_matrix(ids):
    m = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.of(np.array(ids, dtype=np.uint16)).to_bytes())
    assert m.ids().tolist() == ids
    for s in {*ids[:3], 2}:
        places = [i for i, x in enumerate(ids) if x == s]
        assert m.count(s) == len(places) and m.rank(s, len(ids) // 2) == sum(p < len(ids) // 2 for p in places)
        assert [m.select(s, k) for k in range(min(3, len(places)))] == places[:3]
        assert m.select(s, len(places)) == -1
    assert [m.access(i) for i in range(0, len(ids), 97)] == ids[::97]


@pytest.mark.parametrize("shard_tokens", [50, 1 << 20])
def test_round_trip(spark, library, tmp_path, shard_tokens):
    rows = odd_rows() + [(100 + i, "plain text " * i) for i in range(30)]
    path = f"file://{tmp_path}/wm"
    wavelet.write(docs(spark, rows), path, shard_tokens)
    out = wavelet.read_documents(spark, path, with_ids=True).collect()
    out.sort(key=lambda r: r["start"])
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    at = 0
    for r, (doc_id, text, *_) in zip(out, order, strict=True):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids"]) == (doc_id, at, len(ids), ids)
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    counted = {t: 0 for t in (0, 11)}
    for r in wavelet.occurrences(spark, path, [0, 11]).collect():
        counted[r["token_id"]] += r["n"]
    assert counted[0] == sum(x == 0 for r in out for x in r["ids"])


def test_write_empty(spark, tmp_path):
    wavelet.write(docs(spark, []), f"file://{tmp_path}/none")
    assert wavelet.read_documents(spark, f"file://{tmp_path}/none").count() == 0


def test_lookups_unpack_only_what_they_touch():
    rng = np.random.default_rng(3)
    ids = (rng.zipf(1.2, 400_000) % 50_000).astype(np.uint16)
    blob = wavelet.WaveletMatrix.of(ids).to_bytes()
    chunks = wavelet.BITS * wavelet.chunks_of(len(ids))
    for lookup in (
        lambda m: m.access(123_456) == ids[123_456],
        lambda m: m.count(7) == (ids == 7).sum(),
        lambda m: m.rank(7, 200_000) == (ids[:200_000] == 7).sum(),
    ):
        m = wavelet.WaveletMatrix.from_bytes(blob)
        assert m.unpacked == 0 and lookup(m)
        assert 0 < m.unpacked <= 2 * wavelet.BITS < chunks / 3
    # the directory is read from the file, not made again
    m = wavelet.WaveletMatrix.from_bytes(blob)
    assert m.ones.base is not None and m.ones[3, -1] <= (ids & (1 << 12) != 0).sum()
    places = np.flatnonzero(ids == 7)
    assert [m.select(7, i) for i in (0, len(places) // 2, len(places) - 1)] == [places[0], places[len(places) // 2], places[-1]]


def test_rows_of_one_id_are_spread(spark):
    from cargolens.session import scratch_path

    rows = [(None if i % 2 else 7, f"text {i % 500} of many") for i in range(4000)]
    path = scratch_path(spark, "hot_id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the ranges are small here
    try:
        wavelet.write(docs(spark, rows).repartition(4), path, shard_tokens=1000)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spark.read.parquet(path).select("part").distinct().count() > 2
    out = wavelet.read_documents(spark, path).orderBy("start").collect()
    assert [r["doc_id"] for r in out] == [None] * 2000 + [7] * 2000
    ends = np.cumsum([r["n_tokens"] for r in out])
    assert [r["start"] for r in out] == [0, *ends[:-1].tolist()]
