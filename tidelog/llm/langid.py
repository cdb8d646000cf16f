"""Language identification with a byte convolutional network.

Filters of several widths slide over the bytes of a text, each keeps its strongest answer in a window of fixed length (max
pooling), and a softmax layer turns the answers into languages. The network is trained in numpy on a bounded sample of
labelled windows. A text is predicted from all of its windows: their log probabilities are averaged, weighted by length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
#: Different texts of a language that train at most (chosen by a hash), and windows taken from each.
TRAIN_DOCS, TRAIN_WINDOWS = 600, 4
EPOCHS, BATCH, RATE = 6, 64, 0.01
#: Windows in one step of a prediction.
STEP = 64


def _classes() -> np.ndarray:
    """Byte to input class: A-Z as a-z, digits alike, other ASCII as a blank, all bytes beyond ASCII apart."""
    out = np.zeros(256, np.int64)
    for b in range(256):
        c = chr(b).lower()
        out[b] = 1 + ord(c) - ord("a") if b < 128 and c.isalpha() else 27 if b < 128 and c.isdigit() else 28 + b - 128 if b >= 128 else 0
    return out


CLASSES = _classes()
N_CLASSES = int(CLASSES.max()) + 1


@dataclass
class Network:
    languages: list[str]
    filters: list[np.ndarray]  # for each width: (width, class, filter)
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """windows: (n, WINDOW) classes. The strongest answer of each filter and where it is."""
        n = len(windows)
        padded = np.zeros((n, WINDOW + max(WIDTHS) - 1), np.int64)
        padded[:, :WINDOW] = windows
        best, where = [], []
        for width, table in zip(WIDTHS, self.filters, strict=True):
            answer = table[0][padded[:, :WINDOW]]
            for k in range(1, width):
                answer += table[k][padded[:, k:k + WINDOW]]
            at = answer.argmax(axis=1)
            where.append(at)
            best.append(np.take_along_axis(answer, at[:, None, :], 1)[:, 0, :])
        return np.concatenate(best, axis=1) + self.bias, np.concatenate(where, axis=1)

    def train_step(self, windows: np.ndarray, truth: np.ndarray, state: dict, step: int) -> float:
        raw, where = self.pooled(windows)
        hidden = np.maximum(raw, 0)
        p = _softmax(hidden @ self.dense + self.dense_bias)
        loss = float(-np.log(np.maximum(p[np.arange(len(p)), truth], 1e-9)).mean())
        p[np.arange(len(p)), truth] -= 1
        p /= len(p)
        back = (p @ self.dense.T) * (raw > 0)
        padded = np.zeros((len(windows), WINDOW + max(WIDTHS) - 1), np.int64)
        padded[:, :WINDOW] = windows
        grads = [hidden.T @ p, p.sum(axis=0), back.sum(axis=0)]
        rows = np.arange(len(windows))[:, None]
        for w, (width, table) in enumerate(zip(WIDTHS, self.filters, strict=True)):
            part = slice(w * FILTERS, (w + 1) * FILTERS)
            grad = np.zeros_like(table)
            for k in range(width):
                np.add.at(grad[k], (padded[rows, where[:, part] + k], np.arange(FILTERS)[None, :]), back[:, part])
            grads.append(grad)
        for i, (value, grad) in enumerate(zip([self.dense, self.dense_bias, self.bias, *self.filters], grads, strict=True)):
            m, v = state.setdefault(i, (np.zeros_like(value), np.zeros_like(value)))
            m = 0.9 * m + 0.1 * grad
            v = 0.999 * v + 0.001 * grad * grad
            state[i] = (m, v)
            value -= (RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)).astype(value.dtype)
        return loss


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _windows(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    out = np.zeros(max(1, -(-len(raw) // WINDOW)) * WINDOW, np.int64)
    out[:len(raw)] = CLASSES[raw]
    return out.reshape(-1, WINDOW)


def train(samples: list[tuple[bytes, str]], seed: int = 1) -> Network:
    """Trains on windows with their language. One language alone, or none, gives a network that knows just it, or nothing."""
    languages = sorted({lang for _, lang in samples})
    rng = np.random.default_rng(seed)
    n = len(WIDTHS) * FILTERS
    net = Network(languages, [rng.normal(0, 0.3, (w, N_CLASSES, FILTERS)).astype(np.float32) for w in WIDTHS], np.zeros(n, np.float32),
                  rng.normal(0, 0.2, (n, max(1, len(languages)))).astype(np.float32), np.zeros(max(1, len(languages)), np.float32))
    if len(languages) < 2:
        return net
    order = sorted(samples)
    windows = np.concatenate([_windows(data[:WINDOW]) for data, _ in order])
    truth = np.array([languages.index(lang) for _, lang in order])
    state: dict = {}
    step = 0
    for _ in range(EPOCHS):
        mixed = rng.permutation(len(windows))
        for a in range(0, len(mixed), BATCH):
            step += 1
            net.train_step(windows[mixed[a:a + BATCH]], truth[mixed[a:a + BATCH]], state, step)
    return net


def training_sample(docs: DataFrame, text: str = "text", lang: str = "lang") -> list[tuple[bytes, str]]:
    """Windows of TRAIN_DOCS texts of each language (of all, if fewer), at places set by a hash. The number of languages bounds it.

    Copies of a text are one. Those with the least hashes are chosen, in each language by itself.
    """
    rows = docs.select(F.col(text).cast("binary").alias("b"), F.col(lang).alias("l")).where("b is not null and l is not null and length(b) > 0")
    rows = rows.withColumn("h", F.shiftrightunsigned(F.xxhash64("b"), 1))
    counts = rows.select("l", "h").distinct().groupBy("l").agg(F.count("*").alias("n"))
    # Of evenly spread hashes, twice as many as wanted are below the bound; few languages lie so far off that one is short.
    bounds = counts.select("l", F.when(F.col("n") <= 4 * TRAIN_DOCS, F.lit(2.0 ** 63)).otherwise(2.0 ** 63 * 2 * TRAIN_DOCS / F.col("n")).alias("below"))
    chosen = rows.join(F.broadcast(bounds), "l").where(F.col("h").cast("double") <= F.col("below"))
    windows = F.transform(F.sequence(F.lit(1), F.lit(TRAIN_WINDOWS)), lambda k: F.substring(
        "b", (F.pmod(F.xxhash64(k, "b"), F.greatest(F.length("b") - WINDOW, F.lit(0)) + 1) + 1).cast("int"), F.lit(WINDOW)))
    once = chosen.groupBy("l", "h").agg(F.min(windows).alias("ws"))
    place = F.row_number().over(Window.partitionBy("l").orderBy("h"))
    picked = once.withColumn("place", place).where(F.col("place") <= TRAIN_DOCS).select("l", F.explode("ws").alias("w"))
    return [(bytes(r.w), r.l) for r in picked.collect()]


def predict(docs: DataFrame, net: Network, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of docs: doc_id, the columns of keep, lang_pred and score (the mean probability over the windows).

    lang_pred is `und` and score 0 where the text is null or holds no letter, or the network knows no language. Only the text
    decides; every window of it counts, however long it is.
    """
    schema = T.StructType([docs.schema[doc_id], *[docs.schema[k] for k in keep], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    languages = np.array([*net.languages, "und"], dtype=object)
    rows = docs.select(doc_id, *keep, F.when(F.col(text).rlike(r"\p{L}"), F.col(text).cast("binary")).alias("__text"))

    def act(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Two neighbouring bytes are looked up at once: a filter of width 4 takes two steps, not four.
        two, three, four = net.filters
        def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            return np.ascontiguousarray((a[:, None, :] + b[None, :, :]).reshape(-1, FILTERS))
        tables = pair(*two), pair(*three[:2]), three[2], pair(*four[:2]), pair(*four[2:])

        def log_probabilities(windows: np.ndarray) -> np.ndarray:
            padded = np.zeros((len(windows), WINDOW + 3), np.int64)
            padded[:, :WINDOW] = windows
            first = padded[:, :-1] * N_CLASSES + padded[:, 1:]
            near, far = first[:, :WINDOW], first[:, 2:WINDOW + 2]
            parts = [tables[0].take(near, 0).max(axis=1),
                     (tables[1].take(near, 0) + tables[2].take(padded[:, 2:WINDOW + 2], 0)).max(axis=1),
                     (tables[3].take(near, 0) + tables[4].take(far, 0)).max(axis=1)]
            return np.log(_softmax(np.maximum(np.concatenate(parts, axis=1) + net.bias, 0) @ net.dense + net.dense_bias) + 1e-12)

        for batch in batches:
            texts = batch.column("__text")
            label = np.full(len(texts), len(net.languages))
            score = np.zeros(len(texts))
            if net.languages:
                for a, value in enumerate(texts):
                    if not value.is_valid:
                        continue
                    data = value.as_buffer()
                    windows = _windows(data)
                    logs = np.concatenate([log_probabilities(windows[k:k + STEP]) for k in range(0, len(windows), STEP)])
                    weight = np.full(len(windows), WINDOW, np.float64)
                    weight[-1] = len(data) - WINDOW * (len(windows) - 1)
                    mean = weight @ logs / weight.sum()
                    label[a] = mean.argmax()
                    score[a] = min(1.0, float(weight @ np.exp(logs[:, label[a]]) / weight.sum()))
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in (doc_id, *keep)], pa.array(languages[label].tolist(), pa.string()), pa.array(score)], names=[f.name for f in schema])

    return rows.mapInArrow(act, schema)


def identify(docs: DataFrame, trains: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", keep: tuple[str, ...] = ()) -> DataFrame:
    """Trains on the rows of docs where trains is true, then predicts every row."""
    return predict(docs, train(training_sample(docs.where(trains), text, lang)), doc_id, text, keep)
