"""Tree Shapley values against exact fractions, for trees of any depth and width."""

from fractions import Fraction
from functools import reduce
from itertools import combinations, product
from math import factorial

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riverlens.functions.scalars import rounded
from riverlens.operators import explain as X
from riverlens.plans import literal as L


def random_tree(seed, n_features, n_leaves, n_classes=3, chain=False):
    """A node table with ``n_leaves`` leaves, thresholds 1..63, and some features split more than once on a path."""
    rng = np.random.default_rng(seed)
    tree, leaves, fresh = {}, [0], 1
    while len(leaves) < n_leaves:
        k = leaves.pop(-1 if chain else int(rng.integers(len(leaves))))
        tree[k] = (int(rng.integers(n_features)), float(rng.integers(1, 64)), fresh, fresh + 1)
        leaves += [fresh, fresh + 1]
        fresh += 2
    weight = {k: rng.integers(0, 9, n_classes) + (np.arange(n_classes) == 0) for k in leaves}
    for k in sorted(tree, reverse=True):
        weight[k] = weight[tree[k][2]] + weight[tree[k][3]]
    return pd.DataFrame([(k, [float(v) for v in weight[k]], *((tree[k][2], tree[k][3], tree[k][0], [tree[k][1]])
                                                              if k in tree else (-1, -1, -1, []))) for k in sorted(weight)],
                        columns=["id", "impurityStats", "leftChild", "rightChild", "feature", "thr"])


def paths(nodes):
    """(conditions {feature: [(threshold, left)]}, covers {feature: Fraction}, distribution) of every leaf."""
    by = {int(r.id): r for r in nodes.itertuples()}
    total = {i: sum(map(int, r.impurityStats)) for i, r in by.items()}
    out, todo = [], [(0, {}, {})]
    while todo:
        i, conditions, covers = todo.pop()
        r = by[i]
        if r.leftChild < 0:
            out.append((conditions, covers, [Fraction(int(v), total[i]) for v in r.impurityStats]))
            continue
        f = int(r.feature)
        for child, left in ((int(r.leftChild), True), (int(r.rightChild), False)):
            todo.append((child, {**conditions, f: [*conditions.get(f, []), (r.thr[0], left)]},
                         {**covers, f: covers.get(f, Fraction(1)) * Fraction(total[child], total[i])}))
    return out


def meets(x, conditions):
    return all((x <= t) == left for t, left in conditions)


def by_subsets(nodes, x, n_features, n_classes=3):
    """Shapley's definition: all subsets of features, expectations as fractions."""
    leaves = paths(nodes)

    def value(s):
        out = [Fraction(0)] * n_classes
        for conditions, covers, dist in leaves:
            share = Fraction(1)
            for f, c in conditions.items():
                share *= (Fraction(int(meets(x[f], c))) if f in s else covers[f])
            out = [a + share * b for a, b in zip(out, dist)]
        return out

    values = {s: value(set(s)) for n in range(n_features + 1) for s in combinations(range(n_features), n)}
    phi = [[Fraction(0)] * n_features for _ in range(n_classes)]
    for j in range(n_features):
        for s, v in values.items():
            if j not in s:
                w = Fraction(factorial(len(s)) * factorial(n_features - len(s) - 1), factorial(n_features))
                more = values[tuple(sorted((*s, j)))]
                for c in range(n_classes):
                    phi[c][j] += w * (more[c] - v[c])
    return phi


def by_paths(nodes, x, n_features, n_classes=3):
    """The same by extending along each path: weights of subsets by size, as fractions."""
    phi = [[Fraction(0)] * n_features for _ in range(n_classes)]
    for conditions, covers, dist in paths(nodes):
        on = {f: Fraction(int(meets(x[f], c))) for f, c in conditions.items()}
        d = len(on)
        for j in on:
            # by_size[s]: sum over subsets of s of the other features, o inside and z outside
            by_size = reduce(lambda p, k: [(p[s] * covers[k] if s < len(p) else 0) + (p[s - 1] * on[k] if s else 0)
                                           for s in range(len(p) + 1)], (k for k in on if k != j), [Fraction(1)])
            total = sum(v * Fraction(factorial(s) * factorial(d - s - 1), factorial(d)) for s, v in enumerate(by_size))
            for c in range(n_classes):
                phi[c][j] += dist[c] * total * (on[j] - covers[j])
    return phi


def close(got, want):
    assert np.abs(got - np.array([[float(v) for v in row] for row in want]).reshape(-1)).max() < 1e-12


def test_small_tree_equals_the_definition():
    nodes = random_tree(3, 6, 40)
    x = np.random.default_rng(1).integers(0, 66, (4, 6)).astype(float)
    got = X.shapley_values(X.leaves_of(nodes, 6), x)
    for row, phi in zip(x, got):
        want = by_subsets(nodes, row, 6)
        close(phi, want)
        close(phi, by_paths(nodes, row, 6))


def test_wide_deep_tree_equals_exact_fractions():
    nodes = random_tree(5, 12, 1000)
    x = np.random.default_rng(2).integers(0, 66, (3, 12)).astype(float)
    leaves = X.leaves_of(nodes, 12)
    assert len(leaves.z) == 1000
    for row, phi in zip(x, X.shapley_values(leaves, x)):
        close(phi, by_paths(nodes, row, 12))


@pytest.mark.parametrize("kept", [X.KEPT, 8])
def test_tree_with_many_leaves_and_few_features_goes_by_subsets(monkeypatch, kept):
    """The work per row must not grow with the leaves: the walk meets only those that agree with the row."""
    monkeypatch.setattr(X, "KEPT", kept)
    nodes = random_tree(13, 4, 2500)
    x = np.random.default_rng(6).integers(0, 66, (300, 4)).astype(float)
    x[0, 1] = float("nan")
    leaves = X.leaves_of(nodes, 4)
    met = []
    walk = X.Nodes.given
    monkeypatch.setattr(X.Nodes, "given", lambda self, sides, fixed: met.append(len(sides)) or walk(self, sides, fixed))
    got = X.shapley_values(leaves, x)
    assert met
    for row, phi in list(zip(x, got))[1:4]:
        close(phi, by_paths(nodes, row, 4))
    monkeypatch.setattr(X, "WIDE", 1 << 20)
    assert np.abs(got - X.shapley_values(leaves, x)).max() < 1e-13
    monkeypatch.setattr(X, "WIDE", 1)
    monkeypatch.setattr(X, "CHUNK", 50)
    assert np.abs(got[:20] - X.shapley_values(X.leaves_of(nodes, 4), x[:20])).max() < 1e-13


def test_chain_of_a_hundred_splits():
    nodes = random_tree(7, 15, 100, chain=True)
    x = np.random.default_rng(3).integers(0, 66, (3, 15)).astype(float)
    for row, phi in zip(x, X.shapley_values(X.leaves_of(nodes, 15), x)):
        close(phi, by_paths(nodes, row, 15))


def test_rows_that_differ_in_any_feature_differ():
    """Nine features of 255 thresholds: no code of the sides may overflow."""
    rows = [(0, [4.0, 4.0], 1, 2, 0, [0.5]), (1, [3.0, 1.0], -1, -1, -1, []), (2, [1.0, 3.0], -1, -1, -1, [])]
    extra = 3
    for f in range(9):
        for k in range(255):
            rows += [(extra, [1.0, 1.0], -1, -1, f, [float(k)])]
            extra += 1
    nodes = pd.DataFrame(rows, columns=["id", "impurityStats", "leftChild", "rightChild", "feature", "thr"])
    leaves = X.leaves_of(nodes, 9)
    leaves.thresholds[:] = [np.unique(np.append(np.arange(255.0), 0.5))] + [np.arange(255.0)] * 8
    leaves.low[leaves.low >= 0] = np.searchsorted(leaves.thresholds[0], 0.5)
    leaves.high[:] = [[np.searchsorted(leaves.thresholds[0], 0.5) if leaves.low[i][0] < 0 else 256, *[255] * 8] for i in range(2)]
    x = np.full((2, 9), 100.0)
    x[0, 0] = 0.25
    one, two = X.shapley_values(leaves, x)
    assert np.abs(one - two).max() > 0.1


def test_nan_goes_right_as_in_the_model():
    nodes = random_tree(9, 4, 30)
    leaves = X.leaves_of(nodes, 4)
    far = np.array([[1e9, 3.0, 1e9, 40.0]])
    lost = np.array([[float("nan"), 3.0, float("nan"), 40.0]])
    assert np.array_equal(X.shapley_values(leaves, far), X.shapley_values(leaves, lost))


def test_single_leaf_and_chunks(monkeypatch):
    nodes = pd.DataFrame([(0, [1.0, 3.0], -1, -1, -1, [])], columns=["id", "impurityStats", "leftChild", "rightChild", "feature", "thr"])
    leaves = X.leaves_of(nodes, 3)
    assert leaves.base.tolist() == [0.25, 0.75] and not X.shapley_values(leaves, np.ones((2, 3))).any()
    nodes = random_tree(11, 5, 60)
    x = np.random.default_rng(4).integers(0, 66, (50, 5)).astype(float)
    whole = X.shapley_values(X.leaves_of(nodes, 5), x)
    monkeypatch.setattr(X, "CHUNK", 64)
    assert np.abs(whole - X.shapley_values(X.leaves_of(nodes, 5), x)).max() < 1e-14


def test_literal_tree_has_no_rounding_ties():
    """No exact value of the literal tree lies near a 5 behind the digit that its queries round to."""
    nodes = L.node_frame()
    cuts = [sorted(t[0] for t in nodes["thr"][nodes["feature"] == f]) or [0.0] for f in range(5)]
    for point in product(*[[c[0] - 1, *[v + 1e-3 for v in c]] for c in cuts]):
        for value in (v for row in by_paths(nodes, point, 5, 5) for v in row):
            far = abs(value * 10 ** 6 % 1 - Fraction(1, 2))
            assert far > Fraction(1, 10 ** 5) or value == 0, value


def test_categorical_splits_are_refused(spark):
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.feature import VectorAssembler, VectorIndexer
    df = spark.createDataFrame([(float(i % 3), float(i % 3 == 1)) for i in range(30)], "a double, y double")
    df = VectorAssembler(inputCols=["a"], outputCol="v").transform(df)
    df = VectorIndexer(inputCol="v", outputCol="features", maxCategories=4).fit(df).transform(df)
    tree = DecisionTreeClassifier(labelCol="y").fit(df)
    with pytest.raises(X.NotATreeError):
        X.node_table(tree, spark)


def test_predicted_class_is_ranked_with_its_values(spark):
    """The short way to a local explanation gives the rows of the long one; nothing is ranked again for the explode."""
    rng = np.random.default_rng(5)
    nodes, names, features = random_tree(5, 4, 20), ["a", "b", "c"], ["p", "q", "r", "s"]
    data = [(i, None if i == 7 else names[i % 3], [float(v) for v in rng.integers(0, 65, 4)]) for i in range(60)]
    pred = spark.createDataFrame(data, "obs_id long, predicted string, features array<double>").withColumn(
        "probabilities", F.create_map(*[x for k, n in enumerate(names) for x in (F.lit(n), F.lit(0.1 * k))]))
    rows, base = X.attributed(nodes, X.answers(pred), 4, class_names=names)
    short = X.local_explanation(X.with_explanation(rows, base, names, features))
    rows, base = X.attributed(nodes, pred, 4)
    long = X.local_explanation(X.with_explanation(rows, base, names, features))
    assert short.columns == long.columns and short.count() == 59 * 4
    assert sorted(map(tuple, short.collect())) == sorted(map(tuple, long.collect()))
    plan = short._jdf.queryExecution().executedPlan().toString()
    assert "array_sort" not in plan and "transform(" not in plan


def test_order_by_size_rounds_as_spark():
    values = np.array([[1e-10, -2e-10, 0.25, -0.25], [0.1234567895, 0.1234567901, 0.1234567885, 0.0], [-0.3, 0.1, -0.2, 0.4]])
    assert X.by_size(values).tolist() == [[2, 3, 0, 1], [0, 1, 2, 3], [3, 0, 2, 1]]


def test_rounded_is_round(spark):
    rng = np.random.default_rng(9)
    values = [0.0, -0.0, 2.5e-6, 1.5e-6, -0.5e-6, 1.0000005, -1.0000005, 0.1234565, 1e300, -1e12, 123456789.1234565, 1e-320,
              float("nan"), float("inf"), float("-inf"), None, *rng.normal(0, 1, 2000).tolist(), *rng.normal(0, 1e6, 2000).tolist(),
              *(rng.integers(-10**9, 10**9, 2000) / 2e6).tolist(), *(rng.integers(-10**9, 10**9, 2000) / 2e6 + 1e-10).tolist()]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.select(rounded(F.col("v")).alias("a"), F.round("v", 6).alias("b"))
    assert got.where(~F.col("a").eqNullSafe(F.col("b"))).count() == 0
