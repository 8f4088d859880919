"""Language identification with a bidirectional gated recurrent network.

Two GRUs read the bytes of a text, one forward and one backward, in windows of
``WINDOW`` bytes; a softmax over both states labels every position, and the
document's probabilities are the mean over its positions. Every byte of every
text is read.

The network is trained here in numpy by backpropagation through time, on a
bounded sample: at most ``SAMPLE`` labelled documents of each language (those
with the least hashes of their id), ``PLACES`` stretches of each. Every
labelled language is learned; the states and the training steps grow with
their number. Inference runs in Spark tasks over all documents.

Edge cases: a null text or one without a letter is ``und`` with score 0; so is
every text where nothing was learned (the filter then keeps all texts with a
letter, since it knows no language to reject); rows without a language or an id are
never learned from; repeated rows are labelled each; an empty table gives an
empty result; further columns are passed on untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cargolens.llm.staging import fresh

UNKNOWN = "und"
HIDDEN = 8
WINDOW = 96
WINDOWS_AT_ONCE = 2048
SAMPLE = 400
PLACES = 2
#: Languages that ``HIDDEN`` states and ``TRAIN_STEPS`` steps are meant for.
LANGS_A_SHARE = 32
TRAIN_STEPS = 300
TRAIN_BATCH = 128
TRAIN_WINDOW = 64
RATE = 0.02
MIN_SCORE = 0.4


@dataclass
class Model:
    """Weights: input tables and recurrent matrices of both directions, output layer."""

    langs: list[str]
    tables: list[np.ndarray]  # (3H, 256) each: input weights and bias by byte
    recurrent: list[np.ndarray]  # (3H, H) each
    out: np.ndarray  # (L, 2H)
    bias: np.ndarray  # (L, 1)

    def parameters(self) -> list[np.ndarray]:
        return [*self.tables, *self.recurrent, self.out, self.bias]


def new_model(langs: list[str], hidden: int = HIDDEN, seed: int = 0) -> Model:
    rng = np.random.default_rng(seed)
    draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
    return Model(
        langs,
        [draw(3 * hidden, 256, scale=0.3) for _ in range(2)],
        [draw(3 * hidden, hidden, scale=0.3) for _ in range(2)],
        draw(len(langs), 2 * hidden, scale=0.3),
        np.zeros((len(langs), 1), np.float32),
    )


def sigmoid_(x: np.ndarray) -> np.ndarray:
    x *= 0.5
    np.tanh(x, out=x)
    x *= 0.5
    x += 0.5
    return x


def step(table, recurrent, byte, h):
    """One GRU step for a batch: new state (H, B) and what the backward pass needs."""
    hidden = h.shape[0]
    x = table.take(byte, axis=1)
    g = recurrent @ h
    gates = x[: 2 * hidden]
    gates += g[: 2 * hidden]
    sigmoid_(gates)
    z, r = gates[:hidden], gates[hidden:]
    inner = g[2 * hidden :]
    n = np.tanh(inner * r + x[2 * hidden :])
    return n + z * (h - n), z, r, n, inner


def softmax(logits: np.ndarray) -> np.ndarray:
    logits -= logits.max(axis=0)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=0)
    return logits


def gradients(model: Model, windows: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean loss over all positions, and its gradients, by backpropagation through time.

    windows: (steps, batch) bytes; labels: (batch,) language numbers.
    """
    steps, batch = windows.shape
    hidden = model.recurrent[0].shape[1]
    orders = [range(steps), range(steps - 1, -1, -1)]
    states = np.empty((steps, 2 * hidden, batch), np.float32)
    kept: list[list] = [[None] * steps, [None] * steps]
    for d in range(2):
        h = np.zeros((hidden, batch), np.float32)
        for t in orders[d]:
            before = h
            h, *gates = step(model.tables[d], model.recurrent[d], windows[t], h)
            kept[d][t] = (before, *gates)
            states[t, d * hidden : (d + 1) * hidden] = h
    flat = states.transpose(1, 0, 2).reshape(2 * hidden, -1)
    p = softmax(model.out @ flat + model.bias)
    target = np.tile(labels, steps)
    at = (target, np.arange(len(target)))
    loss = float(-np.log(np.maximum(p[at], 1e-12)).mean())
    p[at] -= 1
    p /= len(target)
    d_out, d_bias = p @ flat.T, p.sum(axis=1, keepdims=True)
    d_states = (model.out.T @ p).reshape(2 * hidden, steps, batch)
    d_tables = [np.zeros_like(w) for w in model.tables]
    d_recurrent = [np.zeros_like(w) for w in model.recurrent]
    one_hot = np.eye(256, dtype=np.float32)
    for d in range(2):
        later = np.zeros((hidden, batch), np.float32)
        for t in reversed(orders[d]):
            before, z, r, n, inner = kept[d][t]
            dh = d_states[d * hidden : (d + 1) * hidden, t] + later
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (before - n) * z * (1 - z)
            dr = dn * inner * r * (1 - r)
            d_tables[d] += np.concatenate([dz, dr, dn]) @ one_hot[windows[t]]
            dg = np.concatenate([dz, dr, dn * r])
            d_recurrent[d] += dg @ before.T
            later = dh * z + model.recurrent[d].T @ dg
    return loss, [*d_tables, *d_recurrent, d_out, d_bias]


def fit(texts: list[bytes], langs: list[str], steps: int | None = None, seed: int = 0) -> Model | None:
    """Train on stretches of bytes and their languages (Adam, balanced batches)."""
    names = sorted(set(langs))
    if not names:
        return None
    rng = np.random.default_rng(seed)
    shares = 1 + len(names) // LANGS_A_SHARE
    steps = steps or TRAIN_STEPS * shares
    model = new_model(names, HIDDEN * shares, seed)
    by_lang = [[t for t, n in zip(texts, langs, strict=True) if n == name] for name in names]
    params = model.parameters()
    first, second = [np.zeros_like(w) for w in params], [np.zeros_like(w) for w in params]
    for i in range(1, steps + 1):
        labels = rng.integers(0, len(names), TRAIN_BATCH)
        windows = np.zeros((TRAIN_WINDOW, TRAIN_BATCH), np.uint8)
        for b, k in enumerate(labels):
            text = by_lang[k][rng.integers(len(by_lang[k]))]
            at = rng.integers(max(1, len(text) - TRAIN_WINDOW + 1))
            part = np.frombuffer(text[at : at + TRAIN_WINDOW], np.uint8)
            windows[: len(part), b] = part
        _, grads = gradients(model, windows, labels)
        rate = RATE * min(1.0, 2 * (1 - i / (steps + 1)))
        for w, g, m, v in zip(params, grads, first, second, strict=True):
            np.clip(g, -1, 1, out=g)
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.999**i)) + 1e-8)
    return model


def label_windows(model: Model, windows: np.ndarray) -> np.ndarray:
    """Sums of the position probabilities of every window: (steps, n) -> (L, n).

    Byte 0 is padding and counts for nothing.
    """
    steps, n = windows.shape
    hidden = model.recurrent[0].shape[1]
    index = windows.astype(np.intp)
    forward = np.empty((steps, hidden, n), np.float32)
    h = np.zeros((hidden, n), np.float32)
    for t in range(steps):
        h = step(model.tables[0], model.recurrent[0], index[t], h)[0]
        forward[t] = h
    sums = np.zeros((len(model.langs), n), np.float64)
    h = np.zeros((hidden, n), np.float32)
    ahead, behind = model.out[:, :hidden], model.out[:, hidden:]
    for t in range(steps - 1, -1, -1):
        h = step(model.tables[1], model.recurrent[1], index[t], h)[0]
        p = softmax(ahead @ forward[t] + behind @ h + model.bias)
        p *= windows[t] != 0
        sums += p
    return sums


def label_texts(model: Model, texts: list[bytes]) -> np.ndarray:
    """Pooled probabilities of texts with at least one byte: (n, L)."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    counts = -(-lengths // WINDOW)
    ends = np.cumsum(counts)
    flat = np.zeros(int(ends[-1]) * WINDOW, np.uint8)
    for text, k, end in zip(texts, counts, ends, strict=True):
        at = (end - k) * WINDOW
        flat[at : at + len(text)] = np.frombuffer(text, np.uint8)
    windows = flat.reshape(-1, WINDOW)
    sums = np.empty((len(windows), len(model.langs)))
    for a in range(0, len(windows), WINDOWS_AT_ONCE):
        part = windows[a : a + WINDOWS_AT_ONCE]
        sums[a : a + len(part)] = label_windows(model, np.ascontiguousarray(part.T)).T
    pooled = np.add.reduceat(sums, ends - counts, axis=0)
    return pooled / np.maximum(pooled.sum(axis=1, keepdims=True), 1e-9)


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 3; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def train(docs: DataFrame, sample: int = SAMPLE, usable: Column | None = None) -> Model | None:
    """Learn from text and lang of documents that are not held out (or ``usable``)."""
    usable = remainder(F.col("doc_id")) != 1 if usable is None else usable
    labelled = docs.where(usable & F.col("lang").isNotNull() & has_letter(F.col("text")))
    labelled = labelled.select(F.col("lang").cast("string").alias("lang"), F.xxhash64("doc_id").alias("h"), F.col("text").alias("text"))
    counts = labelled.groupBy("lang").count().orderBy("lang").collect()  # one row per language
    if not counts:
        return None
    # thin out by hash before the exact cut, so that the driver is never sent much more than it keeps
    share = F.element_at(F.create_map(*[x for r in counts for x in (F.lit(r["lang"]), F.lit(min(1.0, 2 * sample / r["count"])))]), F.col("lang"))
    place = F.pmod(F.xxhash64("h", F.lit(1)), F.lit(1 << 20)) / float(1 << 20)
    thin = labelled.where(place < share)
    size = 3 * TRAIN_WINDOW
    room = F.greatest(F.length("text") - size, F.lit(1))
    cuts = [F.substring(F.col("text"), (F.pmod(F.xxhash64("h", F.lit(2 + k)), room) + 1).cast("int"), F.lit(size)) for k in range(PLACES)]
    rows = thin.select("lang", "h", F.array(*cuts).alias("cuts")).orderBy("h", "lang").limit(2 * sample * len(counts)).collect()
    texts, langs, taken = [], [], {}
    for r in rows:
        taken[r["lang"]] = taken.get(r["lang"], 0) + 1
        if taken[r["lang"]] <= sample:
            for cut in r["cuts"]:
                texts.append(cut.encode())
                langs.append(r["lang"])
    return fit(texts, langs)


def has_letter(text: Column) -> Column:
    return F.coalesce(F.regexp_like(text, F.lit(r"\p{L}")), F.lit(False))


def predict(docs: DataFrame, model: Model | None, lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the language and score of every text."""
    if model is None:
        return docs.withColumns({lang_pred: F.lit(UNKNOWN), score: F.lit(0.0)})
    read = fresh(docs, "_read")
    source = docs.withColumn(read, F.when(has_letter(F.col("text")), F.encode("text", "UTF-8")))
    fields = [*docs.schema.fields, T.StructField(lang_pred, T.StringType()), T.StructField(score, T.DoubleType())]

    def label(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            known = [i for i, t in enumerate(texts) if t]
            names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            if known:
                p = label_texts(model, [texts[i] for i in known])
                for i, k, s in zip(known, p.argmax(axis=1).tolist(), p.max(axis=1).tolist(), strict=True):
                    names[i], scores[i] = model.langs[k], s
            columns = [*batch.columns[:-1], pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return source.mapInArrow(label, T.StructType(fields))


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    model = train(docs, sample)
    out = predict(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")), model)
    held_out = F.coalesce(remainder(F.col("doc_id")) == 1, F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def identified_documents(docs: DataFrame, min_score: float = MIN_SCORE, sample: int = SAMPLE) -> DataFrame:
    """The documents whose language is known with at least ``min_score``, columns unchanged."""
    names = [fresh(docs, "_lang_pred"), fresh(docs, "_score")]
    model = train(docs, sample)
    if model is None:
        return docs.where(has_letter(F.col("text")))
    out = predict(docs, model, *names)
    return out.where((F.col(names[0]) != UNKNOWN) & (F.col(names[1]) >= min_score)).select(*docs.columns)
