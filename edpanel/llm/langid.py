"""Language identification with a bidirectional gated recurrent network over bytes.

Two recurrent layers of ``hidden`` units read the UTF-8 bytes of a text, one from each side;
a softmax over both labels every byte position, and a document's probabilities are the mean
over its positions. Texts are read whole, in windows of ``WINDOW`` bytes (the state starts
anew in each). The network is trained with numpy by backpropagation through time and Adam on
random windows of a bounded sample of labelled rows: ``sample_rows`` rows, dealt evenly over
the languages by a hash of doc_id. Learned weights are a few kB and go to the tasks as they are.

Defined results: a text that is null or has no letter is ``und`` with score 0.0; so is every
text when nothing was learned; score is the mean probability of the predicted language; ties
go to the alphabetically first language; repeated rows are predicted one by one; columns that
clash with result names are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edpanel.llm.common import tuned
from edpanel.llm.tokens import text_bytes

HIDDEN = 8
WINDOW = 128
SAMPLE_ROWS = 2400
SAMPLE_BYTES = 2048  # kept of a sampled row, from a place that its hash picks
TRAIN_WINDOW = 48
TRAIN_BATCH = 192
TRAIN_STEPS = 260
UNKNOWN = "und"


@dataclass
class Model:
    """Weights: per direction the byte table (256, 3H), recurrent gates (H, 2H) and candidate
    (H, H); the output layer (2H, L) and its bias."""
    languages: list[str]
    tables: list[np.ndarray]
    gates: list[np.ndarray]
    candidates: list[np.ndarray]
    out: np.ndarray
    bias: np.ndarray


def _gate(a: np.ndarray) -> np.ndarray:
    """Piecewise linear sigmoid, in place."""
    a *= np.float32(0.25)
    a += np.float32(0.5)
    return np.clip(a, 0, 1, out=a)


def _softmax(a: np.ndarray) -> np.ndarray:
    a = np.exp(a - a.max(axis=-1, keepdims=True))
    return a / a.sum(axis=-1, keepdims=True)


def _step(table, gates, candidate, state, byte):
    """One step of a recurrent layer: new state, gates, candidate value."""
    h = state.shape[1]
    x = table[byte]
    g = state @ gates
    g += x[:, :2 * h]
    _gate(g)
    c = (state * g[:, :h]) @ candidate
    c += x[:, 2 * h:]
    np.tanh(c, out=c)
    return state + g[:, h:] * (c - state), g, c


def position_logits(model: Model, windows: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(position, logits) of all windows (n, t), by position; rows past a window's length hold
    padding. The windows are sorted by falling length."""
    n, t = windows.shape
    hidden = model.out.shape[0] // 2
    active = [int(np.searchsorted(-lengths, -p, side="left")) for p in range(t)]  # windows longer than p
    states = np.zeros((t, n, hidden), np.float32)
    state = np.zeros((n, hidden), np.float32)
    for p in range(t - 1, -1, -1):  # from the right: shorter windows join as their end is reached
        k = active[p]
        if k:
            state[:k] = _step(model.tables[1], model.gates[1], model.candidates[1], state[:k], windows[:k, p])[0]
            states[p, :k] = state[:k]
    state = np.zeros((n, hidden), np.float32)
    for p in range(t):
        k = active[p]
        if not k:
            break
        state = _step(model.tables[0], model.gates[0], model.candidates[0], state[:k], windows[:k, p])[0]
        yield p, state @ model.out[:hidden] + states[p, :k] @ model.out[hidden:] + model.bias


def document_probabilities(model: Model, data: np.ndarray, bounds: np.ndarray, width: int = WINDOW, batch: int = 2048) -> np.ndarray:
    """Mean of the position probabilities of each text (n, L)."""
    sizes = np.diff(bounds)
    count = -(-sizes // width)
    owner = np.repeat(np.arange(len(sizes)), count)
    starts = bounds[:-1][owner] + width * (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count))
    lengths = np.minimum(width, bounds[1:][owner] - starts)
    order = np.argsort(-lengths, kind="stable")
    padded = np.concatenate([data, np.zeros(width, np.uint8)])
    total = np.zeros((len(sizes), len(model.languages)))
    for at in range(0, len(order), batch):
        mine = order[at:at + batch]
        windows = padded[starts[mine][:, None] + np.arange(width)]
        sums = np.zeros((len(mine), len(model.languages)), np.float32)
        for _, logits in position_logits(model, windows, lengths[mine]):
            np.exp(logits, out=logits)  # logits are small sums of bounded states: no overflow
            logits /= logits.sum(axis=1, keepdims=True)
            sums[:len(logits)] += logits
        np.add.at(total, owner[mine], sums)
    return total / np.maximum(sizes, 1)[:, None]


def train(texts: list[bytes], labels: list[str], hidden: int = HIDDEN, steps: int = TRAIN_STEPS, seed: int = 7) -> Model | None:
    """Fit the network; None without labelled text."""
    languages = sorted(set(labels))
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    rows = [[np.frombuffer(t, np.uint8) for t, g in zip(texts, labels) if g == lang] for lang in languages]
    n_lang, f4 = len(languages), np.float32
    params = {}
    for d in (0, 1):
        params[f"t{d}"] = (rng.standard_normal((256, 3 * hidden)) * 0.3).astype(f4)
        params[f"g{d}"] = (rng.standard_normal((hidden, 2 * hidden)) / np.sqrt(hidden)).astype(f4)
        params[f"c{d}"] = (rng.standard_normal((hidden, hidden)) / np.sqrt(hidden)).astype(f4)
    params["o"] = (rng.standard_normal((2 * hidden, n_lang)) * 0.1).astype(f4)
    params["b"] = np.zeros(n_lang, f4)
    moment = {k: np.zeros_like(v) for k, v in params.items()}
    square = {k: np.zeros_like(v) for k, v in params.items()}
    for step in range(1, steps + 1):
        y = rng.integers(0, n_lang, TRAIN_BATCH)
        x, mask = np.zeros((TRAIN_WINDOW, TRAIN_BATCH), np.uint8), np.zeros((TRAIN_WINDOW, TRAIN_BATCH), f4)
        for k, lang in enumerate(y):
            text = rows[lang][rng.integers(len(rows[lang]))]
            size = min(len(text), int(rng.integers(4, TRAIN_WINDOW + 1)))
            begin = int(rng.integers(0, len(text) - size + 1))
            x[:size, k], mask[:size, k] = text[begin:begin + size], 1
        grads = {k: np.zeros_like(v) for k, v in params.items()}
        kept = []  # per direction: positions, states before, gates, candidates, states after
        for d in (0, 1):
            state, trace = np.zeros((TRAIN_BATCH, hidden), f4), []
            for p in (range(TRAIN_WINDOW) if d == 0 else range(TRAIN_WINDOW - 1, -1, -1)):
                new, g, c = _step(params[f"t{d}"], params[f"g{d}"], params[f"c{d}"], state, x[p])
                new = np.where(mask[p][:, None] > 0, new, state)
                trace.append((p, state, g, c, new))
                state = new
            kept.append(trace)
        both = np.zeros((TRAIN_WINDOW, TRAIN_BATCH, 2 * hidden), f4)
        for d in (0, 1):
            for p, _, _, _, new in kept[d]:
                both[p, :, d * hidden:(d + 1) * hidden] = new
        delta = _softmax(both @ params["o"] + params["b"])
        delta[:, np.arange(TRAIN_BATCH), y] -= 1
        delta *= mask[:, :, None] / mask.sum()
        grads["o"] = np.einsum("tbh,tbl->hl", both, delta)
        grads["b"] = delta.sum(axis=(0, 1))
        back = delta @ params["o"].T
        for d in (0, 1):  # through time, against each direction's order
            flow = np.zeros((TRAIN_BATCH, hidden), f4)
            for p, state, g, c, _ in reversed(kept[d]):
                live = mask[p][:, None]
                flow += back[p, :, d * hidden:(d + 1) * hidden]
                reset, update = g[:, :hidden], g[:, hidden:]
                into = flow * live
                d_c = into * update * (1 - c * c)
                d_gated = d_c @ params[f"c{d}"].T
                d_gates = np.concatenate([d_gated * state, into * (c - state)], axis=1) * ((g > 0) & (g < 1)) * f4(0.25)
                grads[f"c{d}"] += (state * reset).T @ d_c
                grads[f"g{d}"] += state.T @ d_gates
                np.add.at(grads[f"t{d}"], x[p], np.concatenate([d_gates, d_c], axis=1))
                flow = flow * (1 - live) + into * (1 - update) + d_gated * reset + d_gates @ params[f"g{d}"].T
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        rate = 0.02 * (1 - step / (steps + 1)) + 0.0005
        for name, grad in grads.items():
            grad = grad * min(1.0, 1.0 / (norm + 1e-9))
            moment[name] = 0.9 * moment[name] + 0.1 * grad
            square[name] = 0.99 * square[name] + 0.01 * grad * grad
            params[name] -= (rate * (moment[name] / (1 - 0.9 ** step)) / (np.sqrt(square[name] / (1 - 0.99 ** step)) + 1e-8)).astype(f4)
    return Model(languages, *([params[f"{k}{d}"] for d in (0, 1)] for k in "tgc"), params["o"], params["b"])


def has_letter() -> F.Column:
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


def training_sample(df: DataFrame, rows: int = SAMPLE_ROWS) -> tuple[list[bytes], list[str]]:
    """At most ``rows`` labelled texts (SAMPLE_BYTES of each), about as many of every language."""
    usable = df.where(F.col("lang").isNotNull() & has_letter())
    counts = {r.lang: r.n for r in usable.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(rows).collect()}
    if not counts:
        return [], []
    each, parts = rows / len(counts), 1 << 30
    limit = F.create_map(*(F.lit(x) for lang, n in counts.items() for x in (lang, int(parts * min(1.0, each / n)))))
    picked = F.xxhash64("doc_id", F.lit("sample"))
    chosen = usable.where(F.pmod(picked, F.lit(parts)) < F.try_element_at(limit, F.col("lang")))
    begin = F.pmod(F.xxhash64("doc_id"), F.greatest(F.length("text") - SAMPLE_BYTES // 2, F.lit(1))).cast("int") + 1
    held = chosen.select("lang", F.call_function("substring", F.col("text"), begin, F.lit(SAMPLE_BYTES // 2)).alias("text"), "doc_id")
    got = held.orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(rows).collect()
    got = [(r.text.encode()[:SAMPLE_BYTES], r.lang) for r in got if r.text]
    return [t for t, _ in got], [g for _, g in got]


def fit(df: DataFrame, sample_rows: int = SAMPLE_ROWS, **options) -> Model | None:
    """Train on the labelled rows of ``df`` (doc_id, text, lang)."""
    return train(*training_sample(df.withColumn("text", F.col("text").cast("string")), sample_rows), **options)


def predict(df: DataFrame, model: Model | None) -> DataFrame:
    """``df`` with lang_pred, score and n_positions (bytes labelled)."""
    tuned(df.sparkSession)
    df = df.drop("lang_pred", "score", "n_positions").withColumn("text", F.col("text").cast("string"))
    if model is None:
        return df.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0), "n_positions": F.lit(0).cast("long")})
    fields = [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("n_positions", T.LongType())]
    schema = T.StructType([*df.schema.fields, *(T.StructField(n, t) for n, t in fields)])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(model.languages, object)
        for batch in batches:
            data, bounds = text_bytes(batch.column("text"))
            mean = document_probabilities(model, data, bounds)
            top = mean.argmax(axis=1)
            score = np.clip(mean[np.arange(len(top)), top], 0, 1)
            new = [pa.array(names[top].tolist(), pa.string()), pa.array(score, pa.float64()), pa.array(np.diff(bounds), pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, *(n for n, _ in fields)])

    found = df.mapInArrow(task, schema)
    known = has_letter()
    return found.withColumns({"lang_pred": F.when(known, F.col("lang_pred")).otherwise(UNKNOWN),
                              "score": F.when(known, F.col("score")).otherwise(0.0)})
