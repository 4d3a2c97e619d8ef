"""Rank correlations and probes on rows of their own."""

import random

from pyspark.sql import functions as F

from riverlens.functions.index import with_index
from riverlens.operators import profile as P
from riverlens.operators import scoring as SC


def _measured(spark, n=400, keys=250, seed=5):
    rng = random.Random(seed)
    value = lambda lo, hi, step: None if rng.random() < 0.15 else round(lo + step * rng.randrange(int((hi - lo) / step)), 4)
    data = [(f"k{rng.randrange(keys)}", value(6.0, 9.0, 0.01), value(0.0, 15.0, 0.1), value(0.0, 6.0, 0.05), value(0.0, 900.0, 1.0))
            for _ in range(n)]
    data.append(("nan", float("nan"), 5.0, 1.0, 100.0))
    return spark.createDataFrame(data, "obs_id string, ph double, do_mgl double, bod_mgl double, fc double")


def test_spearman_meets_the_ranks_of_one_side_only(spark):
    df = _measured(spark)
    names = ["ph", "do_mgl", "bod_mgl", "fc"]
    out = P.spearman_matrix(df, names)
    wide = df.toPandas()
    for a in names:
        for b in names:
            both = wide[[a, b]].dropna().rank()
            got = out.where((F.col("feature_a") == a) & (F.col("feature_b") == b)).first()["rho"]
            assert abs(got - (1.0 if a == b else both[a].corr(both[b]))) < 1e-6
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") <= 4    # the result reads its halves twice: the parts' offsets, the names


def test_probes_are_labelled_in_the_row(spark):
    df = _measured(spark)
    steps = {"ph": 0.3, "do_mgl": 1.0, "bod_mgl": 0.5, "fc": 60.0}
    wanted = SC.first_changes(with_index(SC.probe_rows(df, steps, SC.dims.INPUT_BOUNDS, ("obs_id",))), "wqi_class", ("obs_id",))
    got = SC.sensitivity_probes(df, steps)
    rows = lambda x: sorted(map(tuple, x.select("obs_id", "probe_no", "feature", "probe_value", "probe_class", "label").collect()))
    assert rows(got) == rows(wanted) and len(rows(got)) > 20
    assert "Generate" not in got._jdf.queryExecution().optimizedPlan().toString()     # one row a row is shuffled
