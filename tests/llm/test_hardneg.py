import numpy as np
from pyspark.sql import functions as F

from riverlens.llm import hardneg
from riverlens.llm.topk import quantised

SCHEMA = "vec_id long, label int, embedding array<float>, grp int, `limits` int, slot string"


def brute(rows, every, positives=5, negatives=3):
    """The definition, pair by pair, with Python's integers."""
    ok = {}
    for i, lab, v in rows:
        if i is not None and lab is not None and v and all(x is not None and np.isfinite(x) for x in v):
            ok[i] = (lab, [int(np.floor(256 * float(x))) for x in v])
    out = []
    for a, (lab, v) in ok.items():
        if a % every:
            continue
        ranked = sorted((-sum(x * y for x, y in zip(v, w)), i, m) for i, (m, w) in ok.items() if i != a)
        for p, i, _ in [r for r in ranked if r[2] == lab][:positives]:
            hits = [(s, n) for s, n, m in ranked if m != lab and 50 * -p <= 100 * -s <= 95 * -p][:negatives]
            out += [(a, i, r + 1, n, -p, -s) for r, (s, n) in enumerate(hits)]
    return sorted(out)


def mined(spark, rows, every=10, **sizes):
    df = spark.createDataFrame([(*r, 1, 2, "s") for r in rows], SCHEMA)
    df = df.withColumn("v", quantised(F.col("embedding")))
    return sorted(tuple(r) for r in hardneg.hard_negatives(df, F.col("vec_id") % every == 0, **sizes).collect())


def vectors(n, dim, labels, seed=1, spread=.4):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, .4, (5, dim))[rng.integers(0, 5, n)] + rng.normal(0, spread, (n, dim))
    return [(k, int(rng.integers(0, labels)), [float(v) for v in np.float32(row)]) for k, row in enumerate(x)]


def test_matches_brute_force_over_blocks(spark):
    rows = vectors(500, 6, 4)
    want = brute(rows, 10)
    assert len(want) > 300
    assert mined(spark, rows, anchor_block=16, row_block=64) == want
    assert mined(spark, rows) == want


def test_hot_label_copies_ties_and_odd_rows(spark):
    rows = [(i, 0 if i % 3 else m, v) for i, m, v in vectors(200, 3, 5, 3)]
    rows += [(k, 1, rows[20][2]) for k in range(200, 420)]                     # one very common vector of one label
    rows += [(k, 2, rows[40][2]) for k in range(420, 480)]
    rows += [(500, None, [1.0] * 3), (510, 1, None), (520, 1, []), (530, 1, [1.0, None, 0.0]), (540, 1, [float("nan")] * 3),
             (550, 2, [float("inf")] * 3), (None, 1, [1.0] * 3), (560, 3, [0.0] * 3), (570, 0, [-1.0] * 3), (580, 0, [1.0, 2.0]),
             (580, 0, [1.0, 2.0])]
    assert mined(spark, rows, anchor_block=8, row_block=32) == brute(rows, 10)


def test_one_label_one_row_and_no_rows(spark):
    rows = vectors(30, 4, 1, 5)
    assert mined(spark, rows) == []
    assert mined(spark, rows[:1]) == []
    assert mined(spark, []) == []


def test_large_components_stay_exact(spark):
    for scale in (2.0 ** 9, 2.0 ** 18):
        rows = [(k, k % 3, [scale + k, -scale / 2 - k * 3, float(k)]) for k in range(60)]
        want = brute(rows, 10)
        assert mined(spark, rows) == want


def test_slots_cover_overlapping_windows():
    rng = np.random.default_rng(4)
    a, b = rng.integers(-9, 9, (7, 3)).astype(np.float32), rng.integers(-9, 9, (90, 3)).astype(np.float32)
    limits = -np.sort(-rng.integers(-60, 60, (7, 4)), axis=1)
    floors = limits - 25
    none = lambda r, c: np.zeros(np.broadcast_shapes(np.shape(r), np.shape(c)), dtype=bool)     # noqa: E731
    row, slot, ids, score = hardneg.slot_tops(a, b, np.arange(90), none, limits, floors, 2)
    for r in range(7):
        for s in range(4):
            lower = max(floors[r, s], limits[r, s + 1] + 1 if s < 3 else -999)
            fit = sorted((-int(x), i) for i, x in enumerate(a[r] @ b.T) if lower <= x <= limits[r, s])[:2]
            here = (row == r) & (slot == s)
            assert sorted(zip((-score[here]).tolist(), ids[here].tolist())) == fit
