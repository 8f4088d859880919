"""Exact token ids of whole texts, through the tokenizers library.

Byte-level BPE splits a text into pre-tokens and merges inside each one only,
so the ids of a text are the ids of its pre-tokens in a row. A pre-token never
spans the point between a non-space character and a following blank. The
encoder cuts the text there, keeps the ids of every distinct piece it has met
in this worker, and asks the library for the new ones only. Many texts are cut
by Arrow together, so each distinct piece of theirs is looked up once.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from struct import pack
from typing import Any

import numpy as np

TOKENIZER_FILE = "byte_bpe_50k.json"
END_ID = 0
#: Bytes that a worker keeps before it starts afresh (a memory bound, not a
#: result): pieces after a blank, which are most of a text, and the two other stores.
MAX_SPACED_BYTES = 224 << 20
MAX_KEPT_BYTES = 48 << 20
#: What an entry costs beside its text and ids: two objects and its place in the store.
ENTRY_BYTES = 200
#: Pieces longer than this are encoded each time.
MAX_KEPT_CHARS = 64

#: Words that the library merges in one call.
CALL_WORDS = 1 << 13
#: A byte that no UTF-8 text holds.
_NO_BYTE = b"\xff"
#: Characters of texts whose pieces are looked up together (one text may be longer).
TOGETHER_CHARS = 1 << 24

_BLANK_AFTER_SPACE = re.compile(r"\s ")
_ASCII_SPACE = np.array([chr(c).isspace() and c < 128 for c in range(256)])
#: The last byte but one of white space beyond ASCII, in UTF-8.
_BEFORE_SPACE = np.array(sorted({chr(c).encode()[-2] for c in range(128, 0x3001) if chr(c).isspace()}), dtype=np.uint8)
_ODD_BLANKS = ["  ", "\n ", "\t ", "\r ", "\v ", "\f "]
_CUT = re.compile(r"(?<=\S) ")
_PLAIN_LIMIT = "ɐ"
#: Signs that end a word; none of them begins a contraction.
_STOPS = ".,;:!?"


def tokenizer_path(name: str = TOKENIZER_FILE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of every byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in letters:
            letters[b] = chr(256 + len(letters) - len(plain))
    return letters


class _Kept(dict):
    """Piece -> ids as little-endian 16-bit bytes, computed when missing."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most = make, most
        self.held = 0

    def __missing__(self, piece):
        ids = self.make(piece)
        self.keep(piece, ids)
        return ids

    def keep(self, piece: str, ids: bytes) -> None:
        if len(piece) <= MAX_KEPT_CHARS:
            size = ENTRY_BYTES + len(piece) + len(ids)
            if self.held + size > self.most:
                self.clear()
                self.held = 0
            self.held += size
            self[piece] = ids


class Encoder:
    """Ids of whole texts. One per Python worker (see ``encoder``)."""

    def __init__(self, path: str):
        import public_tokenizers
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True  # their strings are ordinary text
        if self.tok.get_vocab_size() > 65536:
            raise ValueError("token ids must fit 16 bits")
        self.findall = _plain_pattern(public_tokenizers.PATTERN).findall
        letters = _byte_letters()
        self.letters = str.maketrans(letters)
        self.letter_table = np.array([ord(letters[b]) for b in range(256)], dtype="<u2")
        self.blank = " ".translate(self.letters)
        self.merge = self.tok.model.tokenize
        # the same model, for words in letters that stand side by side
        self.merger = Tokenizer(self.tok.model)
        self.merger.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(letters[_NO_BYTE[0]])
        self.sizes = np.zeros(65536, dtype=np.int64)
        for token, i in self.tok.get_vocab().items():
            self.sizes[i] = len(token)
        self.words = _Kept(self._word, MAX_KEPT_BYTES)
        self.first = _Kept(self._piece, MAX_KEPT_BYTES)
        self.spaced = _Kept(self._spaced, MAX_SPACED_BYTES)

    def _merged(self, letters: str) -> bytes:
        ids = [t.id for t in self.merge(letters)]
        return pack(f"<{len(ids)}H", *ids)

    def _word(self, word: str) -> bytes:
        return self._merged(word.encode().decode("latin-1").translate(self.letters))

    def _words(self, words: list[str]) -> Iterator[bytes]:
        """``_word`` of every word, ``CALL_WORDS`` in one call of the library.
        The letters of its ids tell where a word ends."""
        for a in range(0, len(words), CALL_WORDS):
            raw = [word.encode() for word in words[a : a + CALL_WORDS]]
            letters = self.letter_table[np.frombuffer(_NO_BYTE.join(raw), np.uint8)].tobytes().decode("utf-16-le")
            ids = np.array(self.merger.encode_batch_fast([letters], add_special_tokens=False)[0].ids, dtype="<u2")
            ends = np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum([len(r) for r in raw])) + 1
            if ends[-1] != len(ids):
                raise ValueError("ids do not make up the words")
            ids, at = ids.tobytes(), 0
            for end in (2 * ends).tolist():
                yield ids[at:end]
                at = end

    def _split(self, rest: str) -> list[str] | None:
        """Words of a blank and the piece after it; none for rare scripts.
        Letters alone are one word with the blank, so the pattern need not look
        at them; most pieces that a worker has not met yet are such words."""
        if rest and max(rest) >= _PLAIN_LIMIT:
            return None
        if rest.isalpha():
            return [" " + rest]
        letters = rest.rstrip(_STOPS)
        if letters.isalpha():  # one word and the run of signs that ends it
            return [" " + letters, rest[len(letters) :]]
        return self.findall(" " + rest)

    def _spaced(self, rest: str) -> bytes:
        if rest.isascii() and rest.isalpha():  # letters that stand for themselves
            return self._merged(self.blank + rest)
        words = self._split(rest)
        if words is None:
            return self._piece(" " + rest)
        if len(words) == 1:  # the caller keeps it; keeping it twice would double the memory
            return self._word(words[0])
        return b"".join([self.spaced[w[1:]] if w[0] == " " else self.words[w] for w in words])

    def _spaced_all(self, rests: list[str]) -> list[bytes]:
        """Ids of blanks and the pieces after them. New words are kept; pieces
        of several words are put together anew, as most of them do not come back."""
        out = list(map(self.spaced.get, rests))
        new = [i for i, ids in enumerate(out) if ids is None]
        words, counts = [], []  # flat: a list a piece would make the collector walk through the stores
        for i in new:
            found = self._split(rests[i]) or ()
            words += found
            counts.append(len(found))
        met = dict.fromkeys(words)
        for w in met:
            met[w] = self.spaced.get(w[1:]) if w[0] == " " else self.words.get(w)
        todo = [w for w, ids in met.items() if ids is None]
        for w, ids in zip(todo, self._words(todo), strict=True):
            met[w] = ids
            if w[0] == " ":
                self.spaced.keep(w[1:], ids)
            else:
                self.words.keep(w, ids)
        at = 0
        for i, n in zip(new, counts, strict=True):
            if n == 0:
                out[i] = self.spaced[rests[i]]
            elif n == 1:
                out[i] = met[words[at]]
            else:
                out[i] = b"".join(map(met.__getitem__, words[at : at + n]))
            at += n
        return out

    def _piece(self, piece: str) -> bytes:
        if piece and max(piece) >= _PLAIN_LIMIT:  # leave rare scripts to the library's own splitter
            return np.array(self.tok.encode(piece, add_special_tokens=False).ids, dtype="<u2").tobytes()
        words = self.findall(piece)
        if len(words) == 1:  # as above
            return self._word(words[0])
        return b"".join(map(self.words.__getitem__, words))

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of the whole text, without any end id; null counts as empty."""
        if not text:
            return np.empty(0, dtype="<u2")
        pieces = _CUT.split(text) if _has_odd_blank(text) else text.split(" ")
        head = self.first[pieces[0]]
        return np.frombuffer(head + b"".join(map(self.spaced.__getitem__, pieces[1:])), dtype="<u2")

    def encode_document(self, text: str | None) -> np.ndarray:
        return np.append(self.encode(text), np.uint16(END_ID)).astype("<u2", copy=False)

    def encode_documents(self, rows: Iterable[tuple[Any, str | None]]) -> Iterator[tuple[Any, np.ndarray]]:
        """(id, ids) of (id, text) rows in their order, as ``encode_document``
        gives them, ``TOGETHER_CHARS`` at a time."""
        doc_ids, texts, chars = [], [], 0
        for doc_id, text in rows:
            doc_ids.append(doc_id)
            texts.append(text or "")
            chars += len(texts[-1])
            if chars >= TOGETHER_CHARS:
                yield from zip(doc_ids, self._together(texts), strict=True)
                doc_ids, texts, chars = [], [], 0
        yield from zip(doc_ids, self._together(texts), strict=True)

    def _together(self, texts: list[str]) -> list[np.ndarray]:
        import pyarrow as pa

        parts = [text.partition(" ") for text in texts]
        at = [i for i, (_, blank, _) in enumerate(parts) if blank]
        cut, pieces = _cut([parts[i][2] for i in at])
        odd = _odd(cut, pieces, [parts[i][0] for i in at])
        if odd.any():  # a blank there does not end a word
            at = [i for i, o in zip(at, odd.tolist(), strict=True) if not o]
            cut, pieces = _cut([parts[i][2] for i in at])
        out: list[np.ndarray | None] = [None] * len(texts)
        if at:
            known = self._spaced_all(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())
            found = pa.array(known, pa.large_binary()).take(pieces.indices)
            _, ends, ids = found.buffers()
            ids = np.frombuffer(ids, dtype="<u2")
            ends = np.frombuffer(ends, dtype="<i8")[cut.offsets.to_numpy()] // 2
            end = np.array([END_ID], dtype="<u2")
            for i, a, b in zip(at, ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                out[i] = np.concatenate([np.frombuffer(self.first[parts[i][0]], dtype="<u2"), ids[a:b], end])
        return [self.encode_document(text) if ids is None else ids for ids, text in zip(out, texts, strict=True)]


def _cut(rests: list[str]):
    """The pieces between the blanks of every text, and them as a dictionary."""
    import pyarrow as pa
    import pyarrow.compute as pc

    cut = pc.split_pattern(pa.array(rests, pa.large_string()), " ")
    return cut, cut.values.dictionary_encode()


def _odd(cut, pieces, heads: list[str]) -> np.ndarray:
    """Which of the cut texts have a blank after white space, inside them or
    after their first piece."""
    last = _end_in_space(pieces.dictionary)
    bounds = cut.offsets.to_numpy()
    seen = np.zeros(bounds[-1] + 1, dtype=np.int32)
    np.cumsum(last[pieces.indices.to_numpy()], out=seen[1:])
    inside = seen[bounds[1:] - 1] - seen[bounds[:-1]] > 0  # no blank follows the last piece
    return inside | np.array([head[-1:].isspace() for head in heads], dtype=bool)


def _end_in_space(pieces) -> np.ndarray:
    """Which strings are empty or end in white space. Their last bytes tell;
    only those that may end in white space beyond ASCII are looked at."""
    _, bounds, data = pieces.buffers()
    ends = np.frombuffer(bounds, dtype="<i8")[pieces.offset : pieces.offset + len(pieces) + 1]
    padded = np.frombuffer(b"  " + (data.to_pybytes() if data else b""), dtype=np.uint8)
    last, before = padded[ends[1:] + 1], padded[ends[1:]]
    out = (ends[1:] == ends[:-1]) | (last < 128) & _ASCII_SPACE[last]
    for i in np.flatnonzero((last >= 128) & np.isin(before, _BEFORE_SPACE)).tolist():
        out[i] = pieces[i].as_py()[-1:].isspace()
    return out


def _has_odd_blank(text: str) -> bool:
    if text.isascii():
        return any(run in text for run in _ODD_BLANKS) or any(c in text for c in "\x1c\x1d\x1e\x1f") and _BLANK_AFTER_SPACE.search(text) is not None
    return _BLANK_AFTER_SPACE.search(text) is not None


def _plain_pattern(pattern: str) -> re.Pattern:
    """The pattern for texts below ``_PLAIN_LIMIT``, with its classes spelled
    out: the standard module is faster than one that knows all scripts."""
    import regex

    signs = [chr(c) for c in range(ord(_PLAIN_LIMIT))]
    kinds = {k: "".join(re.escape(c) for c in signs if regex.match(k, c)) for k in (r"\s", r"\p{L}", r"\p{N}")}
    parts = re.split(r"(\[[^\]]*\])", pattern)  # classes inside brackets need none of their own
    for i, part in enumerate(parts):
        for kind, members in kinds.items():
            part = part.replace(kind, members if i % 2 else f"[{members}]")
        parts[i] = part.replace(r"\S", f"[^{kinds[chr(92) + 's']}]")
    return re.compile("".join(parts))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def crc32_of_ids(ids: np.ndarray) -> int:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    import zlib

    return zlib.crc32(ids.astype("<u4").tobytes())
