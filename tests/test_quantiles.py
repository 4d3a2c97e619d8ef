"""Exact distributed quantiles and ranks against numpy / pandas."""

import numpy as np
import pandas as pd
import pytest

from riverlens.operators.quantiles import exact_quantiles, ranked_values


def test_quantiles_match_numpy_with_hot_group(spark):
    rng = np.random.default_rng(7)
    hot = rng.integers(0, 50, 3000).astype(float)          # a third-of-rows group, many ties
    cold = rng.normal(0, 1, 6000)
    pdf = pd.DataFrame({"g": ["hot"] * len(hot) + ["cold"] * len(cold),
                        "v": np.concatenate([hot, cold])})
    pdf.loc[::97, "v"] = np.nan
    df = spark.createDataFrame(pdf).repartition(7)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {(r["g"], r["prob"]): r["quantile"] for r in exact_quantiles(df, "v", probs, ["g"]).collect()}
    for g, sub in pdf.groupby("g"):
        vals = sub["v"].dropna().to_numpy()
        for p in probs:
            assert got[(g, p)] == pytest.approx(np.quantile(vals, p), rel=1e-12, abs=1e-12)


def test_ranks_are_partition_independent(spark):
    pdf = pd.DataFrame({"v": [5.0, 1.0, 1.0, 3.0, 3.0, 3.0, 9.0]})
    for parts in (1, 3, 8):
        df = spark.createDataFrame(pdf).repartition(parts)
        got = sorted((r["v"], r["cnt"], r["before"]) for r in ranked_values(df, "v").collect())
        assert got == [(1.0, 2, 0), (3.0, 3, 2), (5.0, 1, 5), (9.0, 1, 6)]


def test_global_median(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4)], "v double")
    q = exact_quantiles(df, "v", [0.5]).first()["quantile"]
    assert q == 2.5  # interpolated, unlike ml.feature.Imputer's 2.0


def test_skewed_values_leave_even_parts(spark):
    from riverlens.operators.quantiles import _placed
    vals = [float(x) for x in range(20000)] + [float("inf"), 1e300, -1e300]
    df = spark.createDataFrame([("a", v) for v in vals] + [("b", 1.0)], "g string, v double")
    placed, _ = _placed(df, "v", ["g"])
    sizes = [r["count"] for r in placed.groupBy("_b").count().collect()]
    assert max(sizes) <= 3 * sum(sizes) / len(sizes)
    got = {r["v"]: r["before"] for r in ranked_values(df.where("g = 'a'"), "v", ["g"]).collect()}
    assert got == {v: k for k, v in enumerate(sorted(vals))}


def test_smote_rows_lie_between_two_of_their_class(spark):
    from riverlens.operators import split as S
    rng = np.random.default_rng(3)
    rows = [(f"a{k}", "A", *map(float, rng.normal(0, 1, 2))) for k in range(60)]
    rows += [(f"b{k}", "B", *map(float, rng.normal(3, 1, 2))) for k in range(13)]
    rows += [("c0", "C", 9.0, 9.0)] + [(f"d{k}", "D", 1.0, 2.0) for k in range(5)]
    df = spark.createDataFrame(rows, "obs_id string, wqi_class string, x double, y double")
    out = S.smote(df, ("x", "y"), k=3).collect()
    sizes = {}
    for r in out:
        sizes[r["wqi_class"]] = sizes.get(r["wqi_class"], 0) + 1
    assert sizes == dict.fromkeys("ABCD", 60)
    real = {r[0]: np.array(r[2:]) for r in rows}
    sd = np.array([r[2:] for r in rows]).std(0)
    for r in (r for r in out if r["synthetic"]):
        name, p = r["obs_id"].split("#")[0], np.array([r["x"], r["y"]])
        mates = sorted((np.linalg.norm((real[o] - real[name]) / sd), o) for o in real if o[0] == name[0] and o != name)[:3]
        on = [np.linalg.norm(p - real[name]) + np.linalg.norm(p - real[o]) - np.linalg.norm(real[name] - real[o]) for _, o in mates]
        assert not mates or min(on) < 1e-9
    again = S.smote(df, ("x", "y"), k=3).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))
    assert S.resample(df, " ROS ", ("x", "y")).count() == 240 and S.resample(df, "passthrough").count() == len(rows)
    with pytest.raises(ValueError):
        S.resample(df, "adasyn")


def test_oversampling_beyond_a_chunk(spark):
    from riverlens.operators import split as S
    df = spark.createDataFrame([(f"a{k}", "A") for k in range(2500)] + [("b", "B"), ("c1", "C"), ("c2", "C")], "obs_id string, wqi_class string")
    out = S.oversample(df).groupBy("wqi_class", "obs_id").agg({"copy": "max", "*": "count"}).collect()
    n = {r["obs_id"]: (r["count(1)"], r["max(copy)"]) for r in out}
    assert n["b"] == (2500, 2500) and n["c1"] == n["c2"] == (1250, 1250) and n["a7"] == (1, 1)
