import math

import numpy as np
from pyspark.sql import functions as F

from riverlens.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, x long, copies int, w string"


def white(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1, 2, "w") for r in rows], SCHEMA)
    df = df.select("vec_id", whitening.shifted(F.col("embedding")).alias("x"))
    return whitening.whitened_rows(df, **kw).collect()


def exact(rows):
    """x of the rows that stay, their sum and n, in Python's integers."""
    kept = [(i, [math.floor(1024 * float(c)) + 100000 for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(x) for _, x in kept), default=0)
    kept = [(i, x + [100000] * (width - len(x))) for i, x in kept]
    return kept, [sum(c) for c in zip(*[x for _, x in kept])], len(kept)


def check(rows, got, components=8, weighted=True):
    kept, total, n = exact(rows)
    x = np.array([v for _, v in kept], dtype=float)
    fit = x if weighted else np.unique(x, axis=0)
    y = x - fit.mean(0)
    centred = fit - fit.mean(0)
    values, basis = np.linalg.eigh(centred.T @ centred / len(fit))
    values, basis = values[::-1], basis[:, ::-1]
    used = min(components, x.shape[1])
    assert len(got) == n * used
    by = {}
    for r in got:
        assert r["n"] == len(fit) and r["identity_error"] < 1e-6
        by.setdefault(r["component"], []).append(r)
    for k in range(used):
        mine = sorted(by[k + 1], key=lambda r: (r["vec_id"], r["whitened"]))
        assert abs(mine[0]["explained"] / (values[k] / values.sum()) - 1) < 1e-9
        want = y @ basis[:, k] / np.sqrt(values[k])
        have = {}
        for r in mine:
            have.setdefault(r["vec_id"], []).append(r["whitened"])
        flat = np.array([have[i].pop(0) for i, _ in sorted(kept, key=lambda p: p[0])])
        want = want[[k for k, _ in sorted(enumerate(kept), key=lambda p: p[1][0])]]
        sign = np.sign(flat @ want)
        assert np.abs(flat - sign * want).max() < 1e-6
    if weighted:
        far = {}
        for i, v in kept:
            far.setdefault(i, []).append(sum((n * a - s) ** 2 for a, s in zip(v, total)))
        assert sorted((r["vec_id"], r["deviation"]) for r in by[1]) == sorted((i, d) for i, ds in far.items() for d in ds)


def vectors(n, dim, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, .3, (n, dim)) * np.linspace(1, .2, dim)
    return [(k, [float(v) for v in np.float32(row)]) for k, row in enumerate(x)]


def test_matches_the_definition(spark):
    rows = vectors(300, 12)
    check(rows, white(spark, rows))
    small = vectors(50, 5)
    check(small, white(spark, small))


def test_common_vector_counts_with_its_rows(spark):
    rows = vectors(200, 6)
    rows += [(k, rows[3][1]) for k in range(200, 320)]
    check(rows, white(spark, rows))
    check(rows, white(spark, rows, weighted=False), weighted=False)


def test_odd_rows(spark):
    rows = vectors(60, 4) + [(100, None), (101, [1.0, None, 0.0, 0.0]), (102, [float("nan")] * 4), (103, [float("-inf")] * 4),
                             (104, [0.5]), (105, [0.25] * 4), (105, [0.25] * 4)]
    check(rows, white(spark, rows))
    null_id = white(spark, rows + [(None, [0.1, 0.2, 0.3, 0.4])])
    assert sum(r["vec_id"] is None for r in null_id) == 4 and len(null_id) == 64 * 4


def test_no_variance_and_no_rows(spark):
    same = white(spark, [(k, [0.5, 0.25]) for k in range(5)])
    assert len(same) == 10 and all(r["whitened"] is None and r["deviation"] == 0 and r["identity_error"] is None for r in same)
    flat = white(spark, [(k, [float(k), 0.5]) for k in range(5)])
    assert {(r["component"], r["whitened"] is None) for r in flat} == {(1, False), (2, True)}
    assert white(spark, []) == [] and white(spark, [(1, None)]) == [] and white(spark, [(1, [])]) == []


def test_sums_beyond_a_long(spark):
    far = white(spark, [(k, [float((-1) ** k) * 2.0 ** 50, float(k)]) for k in range(6)])
    assert all(r["deviation"] is None for r in far)
