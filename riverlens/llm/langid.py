"""Language identification by a byte convolutional network.

Texts are lower-cased, encoded as UTF-8 and cut into windows of ``WINDOW``
bytes.  Filters of several widths run over the one-hot bytes of a window; the
maximum of each filter over the window goes through a linear layer and a
softmax.  The answer for a document is the average over all its windows,
weighted by their bytes.  The network is trained in numpy on the driver, on a
bounded sample of labelled documents (``PER_LANG`` of each language at most,
one window of each, drawn by a hash of the id from any place of the text).

Defined cases: a null text, an empty one and one without a letter give ``und``
and score 0; without any document to learn from every answer is ``und``; ties
between languages go to the first by code point; a null lang is not learned
from; repeated rows give repeated answers; columns of other names do not
matter.

Scale: predicting is a narrow map, no shuffle.  The model is some hundred
kilobytes whatever the data; a task works on ``CHUNK`` windows at a time and
tabulates the filters over byte pairs once per worker.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WIDTHS, FILTERS = (2, 3, 4), 16
WINDOW, CHUNK = 256, 2048
PER_LANG = 1500
EPOCHS, BATCH, RATE = 8, 64, 0.01
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


class Model:
    """Filters (width x 256 x FILTERS for each width), their biases, the linear layer, the languages."""

    def __init__(self, langs: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.langs = langs
        self.filters = [rng.normal(0, 0.1, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros(len(WIDTHS) * FILTERS, dtype=np.float32)
        self.out = rng.normal(0, 0.1, (len(self.bias), len(langs))).astype(np.float32)
        self.out_bias = np.zeros(len(langs), dtype=np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [*self.filters, self.bias, self.out, self.out_bias]


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _gradients(model: Model, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean cross entropy of windows x (rows of bytes) with language numbers y."""
    n, rows = len(x), np.arange(len(x))[:, None]
    pooled, places = [], []
    for w, table in zip(WIDTHS, model.filters):
        span = x.shape[1] - w + 1
        z = sum(table[j][x[:, j:j + span]] for j in range(w))
        at = z.argmax(1)
        pooled.append(np.take_along_axis(z, at[:, None, :], 1)[:, 0, :]), places.append(at)
    z = np.concatenate(pooled, 1) + model.bias
    h = np.maximum(z, 0)
    p = softmax(h @ model.out + model.out_bias)
    p[np.arange(n), y] -= 1
    p /= n
    dz = (p @ model.out.T) * (z > 0)
    grads = []
    for k, (w, at) in enumerate(zip(WIDTHS, places)):
        d = dz[:, k * FILTERS:(k + 1) * FILTERS]
        g = np.zeros((w, 256, FILTERS), dtype=np.float32)
        for j in range(w):
            np.add.at(g[j], (x[rows, at + j], np.arange(FILTERS)[None, :]), d)
        grads.append(g)
    return [*grads, dz.sum(0), h.T @ p, p.sum(0)]


def train(windows: np.ndarray, labels: list[str]) -> Model:
    """Fit by Adam on windows (rows of WINDOW bytes) and their languages."""
    langs = sorted(set(labels), key=lambda s: s.encode())
    model = Model(langs)
    if len(langs) < 2:
        return model
    y = np.array([langs.index(s) for s in labels], dtype=np.int64)
    share = len(y) / (len(langs) * np.bincount(y, minlength=max(1, len(langs))))  # rare languages count as much
    rng, step = np.random.default_rng(11), 0
    first = [np.zeros_like(p) for p in model.parameters()]
    second = [np.zeros_like(p) for p in model.parameters()]
    epochs = EPOCHS if len(y) > 500 else EPOCHS * 5
    for epoch in range(epochs):
        picked = rng.choice(len(y), len(y), p=share[y] / share[y].sum())
        for lo in range(0, len(y), BATCH):
            part = picked[lo:lo + BATCH]
            step += 1
            rate = RATE * (1 - epoch / epochs) * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
            for p, g, m, v in zip(model.parameters(), _gradients(model, windows[part], y[part]), first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * m / (np.sqrt(v) + 1e-8)
    return model


class Predictor:
    """The model with its filters tabulated over byte pairs."""

    def __init__(self, model: Model):
        self.model = model
        n = len(WIDTHS) * FILTERS
        # the first two bytes feed every width; bytes three and four the wider ones
        lead = np.concatenate([f[0][:, None, :] + f[1][None, :, :] for f in model.filters], axis=2)
        self.lead = np.ascontiguousarray(lead.reshape(65536, n))
        zero = np.zeros((256, FILTERS), dtype=np.float32)
        tail = np.concatenate([(f[2] if w > 2 else zero)[:, None, :] + (f[3] if w > 3 else zero)[None, :, :]
                               for w, f in zip(WIDTHS, model.filters)][1:], axis=2)
        self.tail = np.ascontiguousarray(tail.reshape(65536, n - FILTERS))

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """Probability of each language for each window (rows of WINDOW bytes)."""
        out = []
        for lo in range(0, len(windows), CHUNK):
            x = np.ascontiguousarray(windows[lo:lo + CHUNK].T).astype(np.int32)
            pair = (x[:-1] << 8) | x[1:]
            best = np.full((x.shape[1], self.lead.shape[1]), -np.inf, dtype=np.float32)
            z, more = np.empty_like(best), np.empty((len(best), self.tail.shape[1]), dtype=np.float32)
            for p in range(WINDOW - 1):
                np.take(self.lead, pair[p], axis=0, out=z, mode="clip")
                if p + 3 < WINDOW:
                    np.take(self.tail, pair[p + 2], axis=0, out=more, mode="clip")
                    z[:, FILTERS:] += more
                    np.maximum(best, z, out=best)
                elif p + 2 < WINDOW:   # room for widths two and three
                    z[:, FILTERS:2 * FILTERS] += self.model.filters[1][2][x[p + 2]]
                    np.maximum(best[:, :2 * FILTERS], z[:, :2 * FILTERS], out=best[:, :2 * FILTERS])
                else:
                    np.maximum(best[:, :FILTERS], z[:, :FILTERS], out=best[:, :FILTERS])
            h = np.maximum(best + self.model.bias, 0)
            out.append(softmax(h @ self.model.out + self.model.out_bias))
        return np.concatenate(out)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text."""
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.model.langs:
            return langs, scores
        group, size = [], 0
        for k, text in enumerate(texts):
            if text and LETTER.search(text):
                group.append((k, text.lower().encode()))
                size += len(group[-1][1])
            if group and (size >= 8 * CHUNK * WINDOW or k == len(texts) - 1):
                self._answer(group, langs, scores)
                group, size = [], 0
        if group:
            self._answer(group, langs, scores)
        return langs, scores

    def _answer(self, group: list[tuple[int, bytes]], langs: list[str], scores: list[float]) -> None:
        n = np.array([-(-len(t) // WINDOW) for _, t in group])
        flat = b"".join(t.ljust(int(c) * WINDOW, b"\0") for c, (_, t) in zip(n, group))
        windows = np.frombuffer(flat, dtype=np.uint8).reshape(-1, WINDOW)
        weight = np.full(len(windows), WINDOW, dtype=np.float64)
        ends = np.cumsum(n)
        weight[ends - 1] -= n * WINDOW - np.array([len(t) for _, t in group])
        p = np.add.reduceat(self.probabilities(windows) * weight[:, None], ends - n, axis=0)
        p /= p.sum(1, keepdims=True)
        for (k, _), row in zip(group, p):
            langs[k], scores[k] = self.model.langs[int(row.argmax())], float(min(1.0, row.max()))


def windows_of(text: Column, place: Column) -> Column:
    """A window's worth of lower-cased text from any place: ``place`` is a non-negative number."""
    room = F.greatest(F.length(text) - WINDOW, F.lit(0)) + 1
    return F.lower(F.substr(text, (place % room).cast("int") + 1, F.lit(WINDOW)))


def fit(docs: DataFrame, per_lang: int = PER_LANG) -> Model:
    """Train on at most ``per_lang`` documents of each language, by the hash order of their ids."""
    turn = F.xxhash64("doc_id", F.lit(5))
    place = F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(1 << 40))
    known = docs.where("lang is not null and text is not null")
    # a cut in hash order first, at twice the number, so that no language meets as a whole in one task
    counts = known.groupBy("lang").agg(F.count("*").alias("n")).collect()      # a row per language, as the model has
    share = F.create_map(*[x for r in counts for x in (F.lit(r["lang"]), F.lit(2.0 * per_lang / r["n"]))]
                         or [F.lit(""), F.lit(0.0)])
    known = known.where(turn / F.lit(2.0 ** 64) + 0.5 < share[F.col("lang")])
    rows = (known.select("lang", turn.alias("turn"), windows_of(F.col("text"), place).alias("piece"))
            .where(F.col("piece").rlike(r"\p{L}")).distinct())
    few = Window.partitionBy("lang").orderBy("turn", "piece")
    rows = rows.withColumn("nth", F.row_number().over(few)).where(F.col("nth") <= per_lang)
    found = rows.select("lang", "piece").orderBy("lang", "nth").collect()
    flat = b"".join(r["piece"].encode()[:WINDOW].ljust(WINDOW, b"\0") for r in found)
    return train(np.frombuffer(flat, dtype=np.uint8).reshape(-1, WINDOW), [r["lang"] for r in found])


_PREDICTORS: dict[bytes, Predictor] = {}


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (doc_id, held_out, text) to (doc_id, held_out, lang_pred, score)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    print_ = b"".join(p.tobytes() for p in model.parameters()[-2:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if print_ not in _PREDICTORS:
            _PREDICTORS.clear()
            _PREDICTORS[print_] = Predictor(shared.value)
        for batch in batches:
            langs, scores = _PREDICTORS[print_].predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()),
                                              pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "held_out", "text").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    """The fold that nothing is learned from; a null id belongs to it too."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))
