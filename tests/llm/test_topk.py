import numpy as np
from pyspark.sql import functions as F

from riverlens.llm import topk


def brute(rows, k, every):
    ok = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v):
            ok[i] = [int(np.floor(256 * float(x))) for x in v]
    out = []
    for q, v in ok.items():
        if q % every == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ok.items() if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def search(spark, rows, k=5, every=10, **sizes):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    df = df.select("vec_id", topk.quantised(F.col("embedding")).alias("v"))
    return sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % every == 0, k=k, **sizes).collect())


def vectors(n, dim, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (8, dim))
    x = centres[rng.integers(0, 8, n)] + rng.normal(0, .15, (n, dim))
    return [(k, [float(v) for v in np.float32(row)]) for k, row in enumerate(x)]


def test_matches_brute_force_over_blocks(spark):
    rows = vectors(600, 6)
    assert search(spark, rows, block=64, query_block=16) == brute(rows, 5, 10)


def test_ties_copies_and_odd_vectors(spark):
    rows = vectors(120, 4, 2)
    rows += [(k, rows[7][1]) for k in range(200, 420)]                      # one very common vector
    rows += [(500, None), (510, []), (520, [1.0, None, 0.0, 0.0]), (530, [float("nan")] * 4), (540, [float("inf")] * 4),
             (None, [1.0] * 4), (550, [0.0] * 4), (560, [-1.0] * 4), (570, [1.0, 2.0]), (570, [1.0, 2.0])]
    assert search(spark, rows, block=32, query_block=8) == brute(rows, 5, 10)


def test_few_rows(spark):
    rows = vectors(3, 4)
    assert search(spark, rows, every=1) == brute(rows, 5, 1)
    assert search(spark, rows[:1], every=1) == []
    assert search(spark, []) == []


def test_large_components_stay_exact(spark):
    rows = [(k, [float(2.0 ** 22 + k), float(-2.0 ** 21 - k * 3), 1.0]) for k in range(40)]
    assert search(spark, rows) == brute(rows, 5, 10)


def test_pruning_skips_far_nodes(monkeypatch):
    rng = np.random.default_rng(5)
    q = rng.integers(90, 110, (64, 8)).astype(float)
    p = np.concatenate([rng.integers(90, 110, (500, 8)), rng.integers(-110, -90, (4000, 8))]).astype(float)
    seen = []
    monkeypatch.setattr(topk, "products", lambda a, b, f=topk.products: seen.append(len(a) * len(b)) or f(a, b))
    row, ids, scores = topk.dual_search(np.arange(64) + 10 ** 6, q, np.arange(len(p)), p, 5, np.full(64, -np.inf))
    exact = q @ p.T
    for r in range(64):
        want = np.lexsort((np.arange(len(p)), -exact[r]))[:5]
        assert ids[row == r].tolist() == want.tolist() and scores[row == r].tolist() == exact[r][want].astype(int).tolist()
    assert sum(seen) < 0.3 * q.shape[0] * p.shape[0]
