"""Exact path-dependent tree Shapley values as a Spark job (XAI-1..6), for trees of any depth and width.

1. The fitted tree is saved under the session's checkpoint folder and its
   node table read back (the size of the model, not of the data).
2. On the driver the tree becomes arrays over its leaves: for each feature the
   range of threshold sides that leads to the leaf, the cover ratio ``z`` of the
   feature's splits on the path (child weight over parent weight, multiplied;
   1 for a feature that is not on the path), and the class distribution.
3. For a row, o_j says whether the row's side of feature j is in the leaf's
   range.  The leaf's share of the Shapley value of feature j is

       v (o_j - z_j) sum_S |S|! (d-|S|-1)! / d!  prod_{k in S} o_k  prod_{k not in S, k <> j} z_k ,

   over the subsets S of the other d - 1 features of the path.  Since
   |S|! (d-|S|-1)! / d! is the integral of t^|S| (1-t)^(d-1-|S|) over 0..1, the
   sum is the integral of the polynomial  prod_{k <> j} (t o_k + (1-t) z_k),
   of degree d - 1, and Gauss-Legendre nodes, half as many as d, give it
   exactly.  All terms are positive, so nothing cancels.  The work per row is
   leaves x features x nodes; no table of subsets is made.
   A tree with few features and many more leaves than subsets of them goes by
   the definition instead: the tree's expectation given each subset is found by
   walking down, one way at splits on the subset and both ways, weighted by
   cover, at the others.  A row then meets only the leaves that agree with it
   on the subset, and not every leaf of a model that grows with its data.
4. Rows are scored with ``mapInArrow``: each distinct combination of threshold
   sides in a batch once, a chunk of rows and leaves at a time.  One array
   leaves per row; ranking, directions and the decision document are column
   expressions on the same row.  No shuffle.  Where only the predicted class is
   explained, its values leave with their order, and nothing is ranked after.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from decimal import ROUND_HALF_UP, Decimal
from math import factorial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import DecisionTreeClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riverlens.functions import dims
from riverlens.functions.scalars import direction
from riverlens.session import ensure_checkpoint_dir


class NotATreeError(TypeError):
    """XAI-6: attribution needs a single decision tree."""


def tree_from_pipeline(model) -> DecisionTreeClassificationModel:
    """XAI-6: the tree classifier of a fitted pipeline; reject anything else."""
    stages = getattr(model, "stages", [model])
    for st in reversed(stages):
        if isinstance(st, DecisionTreeClassificationModel):
            return st
    raise NotATreeError("the model has no decision tree classifier")


def node_table(tree: DecisionTreeClassificationModel, spark) -> pd.DataFrame:
    """The saved node table of a fitted tree (as large as the model, which the driver holds anyway)."""
    path = os.path.join(ensure_checkpoint_dir(spark), f"tree-{uuid.uuid4().hex}")
    tree.write().overwrite().save(path)
    nodes = spark.read.parquet(os.path.join(path, "data")).select(
        "id", "impurityStats", "leftChild", "rightChild",
        F.col("split.featureIndex").alias("feature"),
        F.col("split.leftCategoriesOrThreshold").alias("thr"), F.col("split.numCategories").alias("categories"))
    out = nodes.toPandas()  # one row per node
    if (out["categories"] > 0).any():
        raise NotATreeError("a split on a categorical feature has no threshold")
    return out.drop(columns="categories")


CHUNK = 1 << 18     # pairs of a row and a leaf that are worked on at once
WIDE = 64           # leaves for each subset of the features, from which on the subsets take less work
KEPT = 1 << 17      # combinations of sides of a subset whose expectations a worker keeps


@dataclass
class Nodes:
    """The tree as arrays over its nodes: children (-1: a leaf), feature, split, left child's cover, leaf's distribution."""

    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    split: np.ndarray       # a row goes left if its side is at most this
    cover: np.ndarray
    value: np.ndarray
    kept: dict = field(default_factory=dict)    # subset -> (which are known, expectations), filled as rows need them

    def given(self, sides: np.ndarray, fixed: np.ndarray) -> np.ndarray:
        """The tree's expectation of each class for rows whose sides are known for the ``fixed`` features."""
        out = np.zeros((len(sides), self.value.shape[1]))
        todo = [(np.arange(len(sides)), np.zeros(len(sides), dtype=np.int64), np.ones(len(sides)))]
        while todo:
            row, node, w = todo.pop()
            if len(row) > CHUNK:
                half = len(row) // 2
                todo += [(row[half:], node[half:], w[half:]), (row[:half], node[:half], w[:half])]
                continue
            end = self.left[node] < 0
            if end.any():
                at, value = row[end], w[end, None] * self.value[node[end]]
                for c in range(out.shape[1]):
                    out[:, c] += np.bincount(at, value[:, c], minlength=len(out))
                row, node, w = row[~end], node[~end], w[~end]
            if not len(row):
                continue
            f = self.feature[node]
            known = fixed[f]
            one, both = node[known], node[~known]
            next_ = np.where(sides[row[known], f[known]] <= self.split[one], self.left[one], self.right[one])
            share, ways = self.cover[both], row[~known]
            todo.append((np.concatenate([row[known], ways, ways]), np.concatenate([next_, self.left[both], self.right[both]]),
                         np.concatenate([w[known], w[~known] * share[:, 0], w[~known] * share[:, 1]])))
        return out

    def expectations(self, sides: np.ndarray, subset: Sequence[int], sizes: Sequence[int]) -> np.ndarray:
        """``given`` with each combination of the ``subset``'s sides once; a small number of them is kept."""
        fixed = np.isin(np.arange(sides.shape[1]), subset)
        cells = 1
        for f in subset:
            cells *= sizes[f]
        if cells > np.iinfo(np.int64).max:
            return self.given(sides, fixed)
        code = np.zeros(len(sides), dtype=np.int64)
        for f in subset:
            code = code * sizes[f] + sides[:, f]
        distinct, first, back = np.unique(code, return_index=True, return_inverse=True)
        if cells > KEPT:
            return self.given(sides[first], fixed)[back]
        key = tuple(subset)
        if key not in self.kept:
            self.kept[key] = np.zeros(cells, dtype=bool), np.zeros((cells, self.value.shape[1]))
        known, table = self.kept[key]
        new = ~known[distinct]
        if new.any():
            table[distinct[new]] = self.given(sides[first[new]], fixed)
            known[distinct[new]] = True
        return table[code]


@dataclass
class Leaves:
    """The leaves of a tree as arrays (leaf, feature) and (leaf, class).

    A row's side of feature f is the number of the feature's thresholds below
    its value; it reaches the leaf if ``low`` < side <= ``high`` for every f.
    """

    thresholds: list[np.ndarray]
    low: np.ndarray
    high: np.ndarray
    z: np.ndarray
    value: np.ndarray
    nodes: Nodes | None = None

    @property
    def base(self) -> np.ndarray:
        """The tree's expectation of each class."""
        return (self.z.prod(axis=1)[:, None] * self.value).sum(axis=0)

    def sides(self, x: np.ndarray) -> np.ndarray:
        """Sides of the rows; NaN lies above every threshold, as the model sends it."""
        return np.stack([np.searchsorted(t, x[:, f], side="left") for f, t in enumerate(self.thresholds)], axis=1).astype(np.int32)


def leaves_of(nodes: pd.DataFrame, n_features: int) -> Leaves:
    """The leaf arrays of a node table (id, impurityStats, leftChild, rightChild, feature, thr)."""
    by_id = {int(r.id): r for r in nodes.itertuples()}
    weight = {i: float(np.sum(r.impurityStats)) for i, r in by_id.items()}
    inner = nodes[nodes["leftChild"] >= 0]
    thresholds = [np.unique(np.array([t[0] for t in inner["thr"][inner["feature"] == f]], dtype=float)) for f in range(n_features)]
    low, high, z, value = [], [], [], []
    todo = [(0, np.full(n_features, -1), np.array([len(t) for t in thresholds]), np.ones(n_features))]
    while todo:
        i, lo, hi, cover = todo.pop()
        r = by_id[i]
        if r.leftChild < 0:
            stats = np.asarray(r.impurityStats, dtype=float)
            low.append(lo), high.append(hi), z.append(cover)
            value.append(stats / stats.sum() if stats.sum() > 0 else stats)
            continue
        f = int(r.feature)
        at = int(np.searchsorted(thresholds[f], r.thr[0]))
        for child, side in ((int(r.rightChild), 1), (int(r.leftChild), 0)):
            lo2, hi2, cover2 = lo.copy(), hi.copy(), cover.copy()
            if side:
                lo2[f] = max(lo[f], at)
            else:
                hi2[f] = min(hi[f], at)
            cover2[f] *= weight[child] / weight[i] if weight[i] > 0 else 0.0
            todo.append((child, lo2, hi2, cover2))
    return Leaves(thresholds, np.array(low, dtype=np.int32), np.array(high, dtype=np.int32), np.array(z), np.array(value),
                  _nodes_of(by_id, weight, thresholds))


def _nodes_of(by_id: dict, weight: dict, thresholds: list[np.ndarray]) -> Nodes:
    """The node arrays, the root first."""
    place = {i: k for k, i in enumerate(sorted(by_id))}
    out = Nodes(*(np.full(len(by_id), -1, dtype=np.int64) for _ in range(4)), np.zeros((len(by_id), 2)),
                np.zeros((len(by_id), len(by_id[0].impurityStats))))
    for i, r in by_id.items():
        k, stats = place[i], np.asarray(r.impurityStats, dtype=float)
        out.value[k] = stats / stats.sum() if stats.sum() > 0 else stats
        if r.leftChild >= 0:
            f, children = int(r.feature), (int(r.leftChild), int(r.rightChild))
            out.left[k], out.right[k], out.feature[k] = place[children[0]], place[children[1]], f
            out.split[k] = np.searchsorted(thresholds[f], r.thr[0])
            out.cover[k] = [weight[c] / weight[i] if weight[i] > 0 else 0.0 for c in children]
    return out


def _others(factors: list[np.ndarray]) -> list[np.ndarray]:
    """For each factor the product of all others, without a division."""
    before, after = [None], [None]
    for f in factors[:-1]:
        before.append(f if before[-1] is None else before[-1] * f)
    for f in factors[:0:-1]:
        after.append(f if after[-1] is None else after[-1] * f)
    return [a if b is None else b if a is None else a * b for a, b in zip(before, after[::-1])]


def shapley_values(leaves: Leaves, x: np.ndarray) -> np.ndarray:
    """Shapley values (rows, classes * features) of the rows of ``x``."""
    sides = leaves.sides(x)
    # they depend on the sides only: each distinct combination once
    packed = np.ascontiguousarray(sides).view(np.dtype((np.void, sides.dtype.itemsize * sides.shape[1]))).ravel()
    _, first, back = np.unique(packed, return_index=True, return_inverse=True)
    rows = sides[first]
    used = np.flatnonzero([len(t) > 0 for t in leaves.thresholds])
    n_classes, n_features = leaves.value.shape[1], x.shape[1]
    out = np.zeros((len(rows), n_classes, n_features))
    if not len(used):
        return out.reshape(len(rows), -1)[back]
    if len(leaves.z) > WIDE << len(used):
        _by_subsets(leaves, rows, [int(f) for f in used], out)
        return out.reshape(len(rows), -1)[back]
    on_path = (leaves.low[:, used] >= 0) | (leaves.high[:, used] < [len(leaves.thresholds[f]) for f in used])
    # leaves of similar path length together, so that short paths take few nodes
    length = on_path.sum(axis=1)
    for d in np.unique(length[length > 0]):
        nodes, node_weights = np.polynomial.legendre.leggauss((d + 1) // 2)
        t = (nodes + 1) / 2
        mine = np.flatnonzero(length == d)
        step = max(1, CHUNK // len(rows))
        for at in range(0, len(mine), step):
            part = mine[at:at + step]
            low, high, z = (a[part][:, used] for a in (leaves.low, leaves.high, leaves.z))
            per = max(1, CHUNK // len(part))
            for r in range(0, len(rows), per):
                side = rows[r:r + per, None, :][:, :, used]
                on = ((side > low) & (side <= high)).astype(float)              # (row, leaf, feature)
                total = np.zeros_like(on)
                for node, w in zip(t, node_weights / 2):
                    rest = _others([node * on[:, :, k] + (1 - node) * z[:, k] for k in range(len(used))])
                    for k, p in enumerate(rest):
                        total[:, :, k] += w if p is None else w * p
                total *= on - z
                for k, f in enumerate(used):
                    out[r:r + per, :, f] += total[:, :, k] @ leaves.value[part]
    return out.reshape(len(rows), -1)[back]


def _by_subsets(leaves: Leaves, rows: np.ndarray, used: Sequence[int], out: np.ndarray) -> None:
    """Shapley's definition over all subsets of the ``used`` features, into ``out`` (row, class, feature)."""
    n = len(used)
    sizes = [len(t) + 1 for t in leaves.thresholds]
    weight = [factorial(s) * factorial(n - s - 1) / factorial(n) for s in range(n)]
    for mask in range(1 << n):
        subset = [f for k, f in enumerate(used) if mask >> k & 1]
        v = leaves.nodes.expectations(rows, subset, sizes)
        for f in used:
            out[:, :, f] += weight[len(subset) - 1] * v if f in subset else -weight[len(subset)] * v


def by_size(values: np.ndarray) -> np.ndarray:
    """The columns of each row by falling size, rounded half up to nine digits as Spark rounds; ties by number."""
    size = np.abs(values)
    units = np.floor(size * 1e9 + 0.5)
    edge = np.abs(size * 1e9 - units) > 0.499       # hardly ever: the decimal digits decide
    if edge.any():
        units[edge] = [float(Decimal(repr(float(v))).quantize(Decimal("1e-9"), ROUND_HALF_UP).scaleb(9)) for v in size[edge]]
    return np.argsort(-units, axis=1, kind="stable").astype(np.int32)


def _lists(values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * values.shape[1], pa.int32()), pa.array(values.reshape(-1)))


def answers(pred: DataFrame, keys: Sequence[str] = ("obs_id",)) -> DataFrame:
    """What an explanation of the predicted class takes of predictions: one probability, no map of all."""
    return pred.select(*keys, "predicted", F.col("probabilities")[F.col("predicted")].alias("predicted_probability"), "features")


def attributed(nodes: pd.DataFrame, df: DataFrame, n_features: int, features_col: str = "features",
               class_names: Sequence[str] | None = None) -> tuple[DataFrame, np.ndarray]:
    """XAI-1: ``df`` with ``x`` (feature values) and ``phi`` (class-major Shapley values) in place of the features.

    One row in, one row out, whatever else ``df`` carries; also the base value of each class.
    With ``class_names`` the rows have, in place of ``phi``, the values ``own`` of their ``predicted``
    class and ``order``, the numbers of the features by size (``by_size``); both null without a class.
    """
    leaves = leaves_of(nodes, n_features)
    base = leaves.base
    shared = df.sparkSession.sparkContext.broadcast(leaves)     # as large as the model
    x = F.col(features_col)
    if df.schema[features_col].dataType.typeName() != "array":
        x = vector_to_array(x)
    src = df.select(*[c for c in df.columns if c != features_col], x.alias("x"))
    classes = None if class_names is None else pa.array(list(class_names), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, n_features)
            phi = shapley_values(shared.value, values)
            if classes is None:
                yield pa.RecordBatch.from_arrays([*batch.columns, _lists(phi)], [*batch.schema.names, "phi"])
                continue
            at = pc.index_in(batch.column("predicted").cast(pa.string()), value_set=classes)
            there = at.is_valid()
            own = phi.reshape(len(phi), -1, n_features)[np.arange(len(phi)), at.fill_null(0).to_numpy(zero_copy_only=False)]
            found = [pc.if_else(there, a, pa.scalar(None, a.type)) for a in (_lists(own), _lists(by_size(own)))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], [*batch.schema.names, "own", "order"])

    doubles = T.ArrayType(T.DoubleType())
    made = ([T.StructField("phi", doubles)] if classes is None else
            [T.StructField("own", doubles), T.StructField("order", T.ArrayType(T.IntegerType()))])
    return src.mapInArrow(run, T.StructType([*src.schema.fields, *made])), base


def long_form(rows: DataFrame, feature_names: Sequence[str], keys: Sequence[str] = ("obs_id",)) -> DataFrame:
    """(keys, class_index, feature_index, feature, feature_value, contribution) of attributed rows."""
    n = len(feature_names)
    out = rows.select(*keys, "x", F.posexplode("phi").alias("_i", "contribution"))
    at = F.col("_i") % n
    return out.select(*keys, F.floor(F.col("_i") / n).cast("int").alias("class_index"), at.cast("int").alias("feature_index"),
                      F.get(F.array(*[F.lit(f) for f in feature_names]), at).alias("feature"),
                      F.get("x", at).alias("feature_value"), "contribution")


def tree_shap(model, df: DataFrame, feature_names: Sequence[str], keys: Sequence[str] = ("obs_id",),
              features_col: str = "features") -> tuple[DataFrame, np.ndarray]:
    """XAI-1: long form (keys, class_index, feature, feature_value, contribution) and base values."""
    nodes = node_table(tree_from_pipeline(model), df.sparkSession)
    rows, base = attributed(nodes, df.select(*keys, features_col), len(feature_names), features_col)
    return long_form(rows, feature_names, keys), base


def global_importance(contrib: DataFrame, class_names: Sequence[str]) -> DataFrame:
    """XAI-3 / WIN-5: mean |phi| over rows and classes per feature, share, rank, per-class columns."""
    per = contrib.groupBy("feature").agg(
        F.avg(F.abs("contribution")).alias("mean_abs"),
        *[F.avg(F.when(F.col("class_index") == i, F.abs("contribution"))).alias(f"mean_abs_{n.replace(' ', '_').lower()}")
          for i, n in enumerate(class_names)])
    w = Window.partitionBy()  # one row per feature
    return (per.withColumn("share", F.col("mean_abs") / F.sum("mean_abs").over(w))
               .withColumn("rank", F.row_number().over(Window.orderBy(F.col("mean_abs").desc(), F.col("feature")))))


CAVEAT = "Contributions explain the model's answer; they are no evidence of cause."


def with_explanation(rows: DataFrame, base: np.ndarray, class_names: Sequence[str], feature_names: Sequence[str]) -> DataFrame:
    """XAI-4 / WIN-4 / SCL-8: attributed predictions with ``ranked``, ``base_value``, ``additive_ok`` and ``caveat``.

    ``ranked`` holds the contributions toward the predicted class by size (ties
    by feature order), with direction.  All in-row: no join, no shuffle.  Rows
    attributed with ``class_names`` are ranked already: they get the features'
    ``names`` in place of ``ranked``, for ``local_explanation``.
    """
    n = len(feature_names)
    at = F.array_position(F.array(*[F.lit(c) for c in class_names]), F.col("predicted")).cast("int") - 1
    if "order" in rows.columns:
        total = sum((F.get("own", F.lit(i)) for i in range(n)), F.lit(0.0))
        value = F.get(F.array(*[F.lit(float(b)) for b in base]), at)
        return rows.withColumns({"names": F.array(*[F.lit(f) for f in feature_names]), "base_value": value, "additive_ok":
                                 F.abs(value + total - F.col("predicted_probability")) <= 1e-5, "caveat": F.lit(CAVEAT)})
    rows = rows.withColumn("_at", at).withColumn("_phi", F.slice("phi", F.col("_at") * n + 1, F.lit(n)))
    names = F.array(*[F.lit(f) for f in feature_names])
    items = F.transform("_phi", lambda c, i: F.struct(
        (-F.round(F.abs(c), 9)).alias("_order"), i.alias("feature_index"), F.get(names, i).alias("feature"),
        F.get(F.col("x"), i).alias("feature_value"), c.alias("contribution"), direction(c).alias("direction")))
    ranked = F.transform(F.array_sort(items), lambda s, i: F.struct(
        (i + 1).alias("rank"), s["feature"].alias("feature"), s["feature_value"].alias("feature_value"),
        s["contribution"].alias("contribution"), s["direction"].alias("direction")))
    total = F.aggregate("_phi", F.lit(0.0), lambda a, c: a + c)
    value = F.get(F.array(*[F.lit(float(b)) for b in base]), F.col("_at"))
    return rows.withColumns({"ranked": ranked, "base_value": value, "additive_ok": F.abs(
        value + total - F.col("probabilities")[F.col("predicted")]) <= 1e-5, "caveat": F.lit(CAVEAT)}).drop("_at", "_phi")


def local_explanation(rows: DataFrame, keys: Sequence[str] = ("obs_id",)) -> DataFrame:
    """Long form of explained rows: one row per ranked contribution.

    The order, a plain column, is exploded: Spark asks first whether an exploded
    array has items, and would rank each row again for both parts of that question.
    """
    if "order" in rows.columns:
        at, c = F.col("_i"), F.get("own", F.col("_i"))
        out = rows.select(*keys, "predicted", "base_value", "additive_ok", "x", "own", "names", F.posexplode("order").alias("_rank", "_i"))
        return out.select(*keys, "predicted", "base_value", "additive_ok", (F.col("_rank") + 1).alias("rank"), F.get("names", at).alias("feature"),
                          F.get("x", at).alias("feature_value"), c.alias("contribution"), direction(c).alias("direction"))
    return rows.select(*keys, "predicted", "base_value", "additive_ok", F.inline("ranked"))


def compare_with_eda(importance: DataFrame, five_number: DataFrame) -> DataFrame:
    """XAI-5: attribution rank vs class-separation rank (spread of class medians).

    ``five_number`` is AGG-20 (one row per class x feature).  Both inputs have
    one row per feature (x class), so the comparison is a small join.
    """
    spread = (five_number.groupBy("feature")
                         .agg((F.max("median") - F.min("median")).alias("median_spread")))
    sep_rank = F.row_number().over(Window.orderBy(F.col("median_spread").desc(), F.col("feature")))
    eda = spread.withColumn("eda_rank", sep_rank)
    j = importance.select("feature", F.col("rank").alias("shap_rank"), "share").join(eda, "feature", "left")
    return j.withColumn("rank_agrees", F.col("shap_rank") == F.col("eda_rank"))
