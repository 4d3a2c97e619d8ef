"""Toxicity by cumulative-link ordinal regression.

A document has a severity grade 0..K.  One weight vector serves all ordered
thresholds: P(grade >= k) = sigmoid(score - threshold_k), where the score adds
the weights of the document's features, and the expected severity is the sum
of these probabilities.  Features are the distinct words of the lower-cased
text and their beginnings of four and five letters, hashed to ``DIM`` places:
sparse, each counted once a document.  The fit is on the driver, in numpy, on
a bounded sample of labelled documents (``PER_GRADE`` of each grade at most, by
a hash of the id), weighted back to the grades' true shares, with an L1
penalty that leaves few words a weight.

Defined cases: a null or empty text has no features, its severity is that of
the thresholds alone, and it is never rejected; a label whose doc_id has no
document, and a null grade, teach nothing; several labels of one document
count as the highest; without labels of two grades every severity is 0;
repeated rows get repeated answers; other columns pass through ``keep_clean``.

Scale: scoring is a narrow map, no shuffle; the model is the non-zero weights,
at most ``DIM``.  The labels are cut to the sample before they meet the texts,
so that join broadcasts at most (grades x PER_GRADE) ids.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from riverlens.llm.common import packed

DIM = 1 << 20
PER_GRADE = 4000
REJECT = 0.5            # P(grade >= 1) from which a document is rejected
ROUNDS, RATE, L1, REFIT = 150, 0.5, 0.8, 0.05
MIN_DOCS = 3            # documents of the sample that a feature must be in
WORD = re.compile(r"[^\W\d_]+")
MEMO = 60_000


def features_of(word: str) -> list[int]:
    """Hashed features of a lower-case word: itself, its first four and its first five letters."""
    names = {f"w{word}"} | {f"{n}{word[:n]}" for n in (4, 5) if len(word) >= n}
    return [xxhash.xxh64_intdigest(x.encode()) % DIM for x in names]


def words_of(text: str | None) -> set[str]:
    if not text:
        return set()
    if len(text) < 1_000_000:
        return set(WORD.findall(text.lower()))
    return {m[0] for m in WORD.finditer(text.lower())}


class Model:
    """Thresholds of the grades 1..K and the features that have a weight."""

    def __init__(self, thresholds: np.ndarray, weights: dict[int, float]):
        self.thresholds, self.weights = thresholds, weights

    def exceeding(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1..K, a row per score."""
        return 1 / (1 + np.exp(-np.clip(scores[:, None] - self.thresholds[None, :], -60, 60)))


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.memo: dict[str, tuple[int, ...]] = {}

    def score(self, text: str | None) -> float:
        """Sum of the weights of the distinct features of a text."""
        memo, weights, found = self.memo, self.model.weights, set()
        if len(memo) > MEMO:
            memo = self.memo = {}
        for word in words_of(text):
            known = memo.get(word)
            if known is None:
                known = tuple(f for f in features_of(word) if f in weights)
                memo[word] = known
            if known:
                found.update(known)
        return sum(weights[f] for f in sorted(found))


def train(rows: list[np.ndarray], grades: np.ndarray, importance: np.ndarray) -> Model:
    """Fit on rows of feature numbers; AdaGrad with an L1 step on the weights."""
    top = int(grades.max()) if len(grades) else 0
    if top < 1 or len(np.unique(grades)) < 2:
        return Model(np.zeros(0), {})
    flat = np.concatenate(rows) if rows else np.zeros(0, dtype=np.int64)
    names, col, n = np.unique(flat, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    used = n[col] >= MIN_DOCS
    row, col = row[used], col[used]
    share = importance / importance.sum()
    w, g2 = np.zeros(len(names)), np.full(len(names), 1e-8)
    # thresholds from the grades' shares; their gaps are kept positive as exponentials
    above = np.array([max(1e-4, share[grades >= k].sum()) for k in range(1, top + 1)])
    start = np.log((1 - above) / above)
    theta = np.concatenate([[start[0]], np.log(np.maximum(1e-3, np.diff(start)))])
    t2 = np.full(top, 1e-8)
    # a feature's penalty: L1 times the size that chance alone gives to the largest of all gradients
    often = np.bincount(col, weights=share[row], minlength=len(names))
    spread = above[0] * (1 - above[0]) * (share ** 2).sum()
    penalty = L1 * np.sqrt(2 * np.log(max(2, (n >= MIN_DOCS).sum())) * often * spread)
    live = n >= MIN_DOCS
    for r in range(2 * ROUNDS):
        if r == ROUNDS:     # the chosen features once more, nearly free of the penalty that chose them
            live, penalty = w != 0, penalty * REFIT
            g2[:], t2[:] = 1e-8, 1e-8
            row, col = row[live[col]], col[live[col]]
        eta = np.bincount(row, weights=w[col], minlength=len(rows))
        cuts = np.cumsum(np.concatenate([[theta[0]], np.exp(theta[1:])]))
        s = 1 / (1 + np.exp(-np.clip(eta[:, None] - cuts[None, :], -60, 60)))
        s = np.concatenate([np.ones((len(rows), 1)), s, np.zeros((len(rows), 1))], axis=1)
        d = s * (1 - s)
        at = np.arange(len(rows))
        p = np.maximum(s[at, grades] - s[at, grades + 1], 1e-12)
        d_eta = -share * (d[at, grades] - d[at, grades + 1]) / p
        d_cut = np.zeros(top)
        for k in range(1, top + 1):
            d_cut[k - 1] = (share * ((grades == k) * d[:, k] - (grades == k - 1) * d[:, k]) / p).sum()
        d_theta = np.concatenate([[d_cut.sum()], np.exp(theta[1:]) * np.cumsum(d_cut[::-1])[::-1][1:]])
        g = np.bincount(col, weights=d_eta[row], minlength=len(names))
        g2 += g * g
        step = RATE / np.sqrt(g2)
        w -= step * g
        w = np.sign(w) * np.maximum(0, np.abs(w) - step * penalty)
        w[~live] = 0
        t2 += d_theta ** 2
        theta -= RATE / 5 * d_theta / np.sqrt(t2)
    cuts = np.cumsum(np.concatenate([[theta[0]], np.exp(theta[1:])]))
    kept = np.flatnonzero(w)
    return Model(cuts, dict(zip(names[kept].tolist(), w[kept].tolist())))


def fit(docs: DataFrame, grades: DataFrame, per_grade: int = PER_GRADE) -> Model:
    """Train on ``docs`` (doc_id, text) with ``grades`` (doc_id, grade: small integers from 0)."""
    labels = (grades.where("doc_id is not null and grade is not null")
              .groupBy("doc_id").agg(F.max("grade").cast("int").alias("grade")))
    totals = {r["grade"]: r["n"] for r in labels.groupBy("grade").agg(F.count("*").alias("n")).collect()}
    few = labels.limit(0)
    for grade in totals:    # the first of each grade in hash order; every task sends per_grade rows at most
        few = few.union(labels.where(F.col("grade") == grade).orderBy(F.xxhash64("doc_id", F.lit(9)), "doc_id").limit(per_grade))
    # at most (grades x per_grade) rows: small enough to broadcast by construction
    rows = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(few), "doc_id")
    rows = rows.select(F.xxhash64("doc_id", F.lit(9)).alias("h"), "doc_id", F.xxhash64("text").alias("t"), "grade", "text")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted({f for w in words_of(x.as_py()) for f in features_of(w)}) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("h", "doc_id", "t", "grade")),
                                              pa.array(found, pa.list_(pa.int32()))], ["h", "doc_id", "t", "grade", "features"])

    # every task extracts the features of its texts; of these, not of the texts, a bounded number of rows meet
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = (rows.mapInArrow(extract, f"h long, doc_id {kind}, t long, grade int, features array<int>")
             .orderBy("h", "doc_id", "t").limit(max(1, per_grade * len(totals))).select("grade", "features").toArrow())
    y = found.column("grade").to_numpy().astype(np.int64)
    sets = [np.asarray(x.values, dtype=np.int32) for x in found.column("features")]
    seen = np.bincount(y, minlength=int(y.max()) + 1 if len(y) else 1)
    weight = np.array([totals.get(int(k), 0) / max(1, seen[k]) for k in y])
    return train(sets, y, weight)


_SCORERS: dict[int, Scorer] = {}


def severity(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (doc_id, text) to (doc_id, severity, grade, toxic)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return graded(docs.select("doc_id", "text"), "doc_id", f"doc_id {kind}", model)


def graded(rows: DataFrame, carried: str, schema: str, model: Model) -> DataFrame:
    """``rows`` (``carried``, text) with severity, grade (the likeliest) and toxic in place of text."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    key = xxhash.xxh64_intdigest(model.thresholds.tobytes() + repr(sorted(model.weights.items())).encode())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[key] = Scorer(shared.value)
        scorer = _SCORERS[key]
        for batch in batches:
            texts = [x.as_py() for x in batch.column("text")]
            p = scorer.model.exceeding(np.array([scorer.score(t) for t in texts], dtype=np.float64))
            shares = np.diff(np.concatenate([np.ones((len(p), 1)), p, np.zeros((len(p), 1))], axis=1) * -1, axis=1)
            likely = shares.argmax(1)
            toxic = [bool(t) and p.shape[1] > 0 and bool(row[0] >= REJECT) for t, row in zip(texts, p)]
            yield pa.RecordBatch.from_arrays([batch.column(carried), pa.array(p.sum(1), pa.float64()),
                                              pa.array(likely, pa.int32()), pa.array(toxic, pa.bool_())],
                                             [carried, "severity", "grade", "toxic"])
        pa.default_memory_pool().release_unused()

    return rows.mapInArrow(run, f"{schema}, severity double, grade int, toxic boolean")


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not rejected, all columns as they were."""
    names = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(BooleanType())
    def rejected(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(shared.value)
        for part in texts:
            p = scorer.model.exceeding(np.array([scorer.score(t) for t in part], dtype=np.float64))
            yield pd.Series([bool(t) and p.shape[1] > 0 and bool(r[0] >= REJECT) for t, r in zip(part, p)])
        pa.default_memory_pool().release_unused()

    rows = docs.select(packed(docs).alias("row"), F.col("text").alias("t"))
    return rows.where(~rejected("t")).select(*[F.col(f"row.`{c}`").alias(c) for c in names])


def label_grades(labels: DataFrame) -> DataFrame:
    """Severity grades of the labels: 0 not toxic, 1 toxic, 2 toxic and of low quality as well."""
    toxic: Column = F.col("toxic") == 1
    grade = F.when(toxic & (F.col("quality") == 0), 2).when(toxic, 1).when(F.col("toxic") == 0, 0)
    return labels.select("doc_id", grade.alias("grade"))
