"""Model pipeline and tree Shapley invariants (brute force on a small fixture)."""

import math
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from riverlens.operators import explain as X
from riverlens.operators import models as MD
from riverlens.operators import split as S
from riverlens.plans.labelling import scored_observations


@pytest.fixture(scope="module")
def fitted(spark):
    df = scored_observations(spark, SF_SMALL).where(F.col("wqi_class").isNotNull())
    sp = S.stratified_split(df).select("obs_id", "wqi_class", *MD.RAW, "split").cache()
    train = S.with_weights(sp.where(F.col("split") == "train"))
    model = MD.build_pipeline("decision_tree", max_depth=4).fit(train)
    test = sp.where(F.col("split") == "test")
    pred = MD.predict(model, test).cache()
    return model, pred


def test_probabilities_sum_to_one(fitted):
    _, pred = fitted
    sums = pred.select(F.aggregate(F.map_values("probabilities"), F.lit(0.0), lambda a, x: a + x).alias("s"))
    assert all(abs(r["s"] - 1.0) < 1e-9 for r in sums.collect())
    assert pred.where(F.col("uncertain") != (F.col("top_probability") < 0.6)).count() == 0


def test_imputer_uses_interpolated_median(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,)], "ph double")
    out = MD.ExactMedianImputer(inputCols=["ph"]).fit(df).transform(df).collect()
    assert out[-1]["ph_imp"] == 2.5


def test_unfitted_pipeline_saves_loads_and_fits_to_the_same_model(spark, tmp_path):
    from pyspark.ml import Pipeline
    df = scored_observations(spark, SF_SMALL).where(F.col("wqi_class").isNotNull()).select("obs_id", "wqi_class", *MD.RAW)
    train = S.with_weights(df)
    pipe = MD.build_pipeline("decision_tree", max_depth=5)
    pipe.write().overwrite().save(str(tmp_path / "unfitted"))
    again = Pipeline.load(str(tmp_path / "unfitted"))
    imputer = again.getStages()[1]
    assert isinstance(imputer, MD.ExactMedianImputer) and imputer.getInputCols() == list(MD.FEATURES)
    one, two = pipe.fit(train), again.fit(train)
    assert one.stages[1].getMedians() == two.stages[1].getMedians()
    assert one.stages[-1].toDebugString.split("\n")[1:] == two.stages[-1].toDebugString.split("\n")[1:]
    two.write().overwrite().save(str(tmp_path / "fitted"))
    loaded = MD.PipelineModel.load(str(tmp_path / "fitted"))
    assert loaded.stages[1].getMedians() == one.stages[1].getMedians()
    flat = lambda m: MD.predict(m, df).select("obs_id", "predicted", "top_probability")
    assert flat(one).exceptAll(flat(loaded)).count() == 0


def test_log10_feature_names_nan_and_null(spark):
    stage = MD.Log10Feature(inputCol="x", outputCol="y")
    assert stage.feature_names_in() == ["x"] and stage.feature_names_out() == ["y"]
    df = spark.createDataFrame([(100.0,), (0.5,), (float("nan"),), (None,)], "x double")
    assert [r["y"] for r in stage.transform(df).collect()] == [2.0, 0.0, None, None]


def test_a_column_without_values_stays_empty(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None)], "a double, b double")
    out = MD.ExactMedianImputer(inputCols=["a", "b"]).fit(df).transform(df.union(spark.createDataFrame([(None, 7.0)], df.schema)))
    assert [(r["a_imp"], r["b_imp"]) for r in out.collect()] == [(1.0, None), (3.0, None), (2.0, 7.0)]


def test_one_protocol_for_every_model(spark, tmp_path):
    from riverlens.operators import training as TR
    df = scored_observations(spark, SF_SMALL).where(F.col("wqi_class").isNotNull())
    sp = S.stratified_split(df, materialize=True).select("obs_id", "wqi_class", *MD.RAW, "split")
    train, test = sp.where("split = 'train'").drop("split"), sp.where("split = 'test'").drop("split")
    models, pred, report = TR.train_models(train, test, save_dir=str(tmp_path), random_forest={"max_depth": 5},
                                           boosted_trees={"max_iter": 2}, decision_tree={"max_depth": 30})
    rows = {r["model"]: r for r in report.collect()}
    assert set(rows) == set(MD.KINDS) == set(models)
    assert all(r["predictions"] == r["test_rows"] == test.count() and r["fit_seconds"] > 0 for r in rows.values())
    assert rows["decision_tree"]["depth"] > 5 >= rows["random_forest"]["depth"] and rows["logistic_regression"]["depth"] is None
    assert pred.groupBy("model").count().where(F.col("count") == test.count()).count() == 4
    out = TR.compare_models(pred, report, MD.KINDS).orderBy("selection_rank").collect()
    assert [r["selection_rank"] for r in out] == [1, 2, 3, 4]
    with pytest.raises(TR.PredictionCheckError):
        TR.checked_predictions(models["decision_tree"], test, test.count() + 1, "decision_tree", "wqi_class", "obs_id")


def test_query_fits_every_model_at_full_size(spark, monkeypatch):
    """The query's options leave every estimator as the library makes it: no fewer rounds, trees or levels."""
    from riverlens.plans import models as PM
    asked = {}

    def recorded(train, test, kinds, save_dir=None, **options):
        asked.update(options, kinds=kinds)
        raise InterruptedError

    monkeypatch.setattr(PM.TR, "train_models", recorded)
    with pytest.raises(InterruptedError):
        PM.fitted_model_metrics(spark, SF_SMALL)
    assert tuple(asked["kinds"]) == MD.KINDS
    made = {kind: MD.classifier(kind, **asked.get(kind, {})) for kind in MD.KINDS}
    assert made["boosted_trees"].getClassifier().getMaxIter() == 100 and made["boosted_trees"].getClassifier().getMaxDepth() == 6
    assert made["random_forest"].getNumTrees() == 100 and made["logistic_regression"].getMaxIter() == 1000
    assert made["decision_tree"].getMaxDepth() == made["random_forest"].getMaxDepth() == MD.NO_LIMIT


def test_ties_go_to_explainability_then_latency(spark):
    from riverlens.operators import metrics as M
    pairs = spark.createDataFrame([("Good", "Good"), ("Poor", "Poor"), ("Poor", "Good")], "label string, prediction string")
    conf = None
    for name in ("a", "b", "c", "d"):
        c = M.confusion(pairs, model=name)
        conf = c if conf is None else conf.unionByName(c)
    traits = spark.createDataFrame([("a", False, 0.1), ("b", True, 0.9), ("c", True, 0.2)], "model string, explainable boolean, latency double")
    ranked = [r["model"] for r in M.select_model(conf, traits=traits).orderBy("selection_rank").collect()]
    assert ranked == ["c", "b", "a", "d"]
    assert [r["model"] for r in M.select_model(conf).orderBy("selection_rank").collect()] == ["a", "b", "c", "d"]


def test_sensitivity_of_a_loaded_model(spark, fitted, tmp_path):
    from riverlens.operators import scoring as SC
    from riverlens.sources.sinks import load_model, save_model
    model, _ = fitted
    save_model(model, str(tmp_path / "m"))
    loaded = load_model(str(tmp_path / "m"))
    tree = X.tree_from_pipeline(model)
    nodes = X.node_table(tree, spark)
    cut = float(nodes[(nodes["feature"] == 1) & (nodes["leftChild"] >= 0)]["thr"].iloc[0][0])      # a threshold of DO
    rows = [(k, 7.0 + k / 50, cut + (k % 5 - 2) * 0.06, 3.0 + k / 9, 40.0 * k) for k in range(40)] + [(99, 7.0, None, 2.0, 10.0)]
    df = spark.createDataFrame(rows, "submission_id long, ph double, do_mgl double, bod_mgl double, fc double")
    one = lambda *v: MD.predict(loaded, spark.createDataFrame([(0, *v)], df.schema), keys=("submission_id",))
    got = {r["submission_id"]: r for r in SC.model_sensitivity(
        df, lambda x, keys: MD.predict(loaded, x, keys=keys)).collect()}
    probes, names = [], list(SC.PROBE_STEPS)
    for r in rows:
        probes.append((r[0], -1, None, None, *r[1:]))
        for i, f in enumerate(names):
            for j, sign in enumerate((-1.0, 1.0)):
                v = None if r[1 + i] is None else r[1 + i] + sign * SC.PROBE_STEPS[f]
                lo, hi = SC.dims.INPUT_BOUNDS[f]
                if v is not None and lo <= v <= hi:
                    probes.append((r[0], 2 * i + j, f, v, *[v if g == i else x for g, x in enumerate(r[1:])]))
    table = spark.createDataFrame(probes, "submission_id long, probe_no int, feature string, v double, ph double, do_mgl double, bod_mgl double, fc double")
    labels = {(r["submission_id"], r["probe_no"]): (r["predicted"], r["feature"], r["v"])
              for r in MD.predict(loaded, table, keys=("submission_id", "probe_no", "feature", "v")).collect()}
    want = {}
    for (i, no), (label, f, v) in sorted(labels.items()):
        if no >= 0 and i not in want and label != labels[i, -1][0]:
            want[i] = (no, f, v, label, labels[i, -1][0])
    assert want and {i: tuple(r)[1:] for i, r in got.items()} == want
    assert one(7.0, cut, 3.0, 40.0).count() == 1


def test_regressors(spark):
    from riverlens.operators import regression as R
    df = scored_observations(spark, SF_SMALL)
    sp = S.stratified_split(df.where(F.col("wqi_class").isNotNull()), materialize=True).select("obs_id", "wqi_score", *MD.RAW, "split")
    out = {r["model"]: r for r in R.compare_regressors(sp.where("split = 'train'"), sp.where("split = 'test'"),
                                                       boosted_trees={"max_iter": 10}).collect()}
    assert set(out) == set(R.REGRESSORS) and all(r["caveat"] == R.CAVEAT and r["n"] > 1000 for r in out.values())
    assert out["linear"]["r2"] > 0 and out["boosted_trees"]["rmse"] < out["linear"]["rmse"]
    with pytest.raises(MD.FeatureSchemaError):
        R.build_regression(features=("ph", "wqi_score"))


def _expected(nodes, x, subset):
    by_id = {int(r.id): r for r in nodes.itertuples()}

    def go(i):
        r = by_id[i]
        stats = np.asarray(r.impurityStats, dtype=float)
        if r.leftChild < 0:
            return stats / stats.sum()
        f, t = int(r.feature), float(r.thr[0])
        if f in subset:
            return go(int(r.leftChild) if x[f] <= t else int(r.rightChild))
        lw = np.sum(by_id[int(r.leftChild)].impurityStats)
        rw = np.sum(by_id[int(r.rightChild)].impurityStats)
        return (lw * go(int(r.leftChild)) + rw * go(int(r.rightChild))) / (lw + rw)
    return go(0)


def test_tree_shap_matches_brute_force_and_adds_up(spark, fitted):
    model, pred = fitted
    contrib, base = X.tree_shap(model, pred, list(MD.FEATURES))
    nodes = X.node_table(X.tree_from_pipeline(model), spark)
    rows = pred.select("obs_id", "features", "probabilities", "predicted").limit(15).collect()
    got = {}
    for r in contrib.where(F.col("obs_id").isin([row["obs_id"] for row in rows])).collect():
        got[(r["obs_id"], r["class_index"], r["feature_index"])] = r["contribution"]
    n = len(MD.FEATURES)
    assert np.allclose(base, _expected(nodes, np.zeros(n), set()))
    for row in rows:
        x = np.asarray(row["features"].toArray())
        for j in range(n):
            phi = np.zeros(len(base))
            others = [k for k in range(n) if k != j]
            for s in range(n):
                for sub in combinations(others, s):
                    w = math.factorial(s) * math.factorial(n - s - 1) / math.factorial(n)
                    phi += w * (_expected(nodes, x, set(sub) | {j}) - _expected(nodes, x, set(sub)))
            for c in range(len(base)):
                assert got[(row["obs_id"], c, j)] == pytest.approx(phi[c], abs=1e-9)
        total = base + np.array([sum(got[(row["obs_id"], c, j)] for j in range(n)) for c in range(len(base))])
        names = MD.label_names(model)
        assert total[names.index(row["predicted"])] == pytest.approx(row["probabilities"][row["predicted"]], abs=1e-9)


def test_local_explanation_is_additive(spark, fitted):
    model, pred = fitted
    rows, base = X.attributed(X.node_table(X.tree_from_pipeline(model), spark), pred, len(MD.FEATURES))
    loc = X.local_explanation(X.with_explanation(rows, base, MD.label_names(model), MD.FEATURES))
    assert loc.where(~F.col("additive_ok")).count() == 0
    ranks = loc.groupBy("obs_id").agg(F.collect_set("rank").alias("r")).collect()
    assert all(sorted(r["r"]) == [1, 2, 3, 4, 5] for r in ranks)


def test_saved_model_scores_rows_without_a_label(spark, fitted, tmp_path):
    from riverlens.sources.sinks import artifact_digest, load_model, save_model
    model, pred = fitted
    path = str(tmp_path / "model")
    save_model(model, path)
    raw = scored_observations(spark, SF_SMALL).select("obs_id", *MD.RAW)
    flat = lambda df: df.select("obs_id", "predicted", "top_probability", F.to_json("probabilities"))
    assert "wqi_class" not in MD.predict(model, raw).columns
    one, two = flat(MD.predict(model, raw)), flat(MD.predict(load_model(path), raw))
    assert one.exceptAll(two).count() == 0
    whole = [r["sha256"] for r in artifact_digest(spark, path).where("path = '*'").collect()]
    assert len(whole) == 1
    # an engineered column that is already there is made anew
    again = flat(MD.predict(model, raw.withColumn("log10_fc", F.lit(99.0))))
    assert again.exceptAll(one).count() == 0


def test_leakage_columns_are_refused(spark):
    for bad in ("wqi_score", "WQI_class", "potability"):
        with pytest.raises(MD.FeatureSchemaError):
            MD.build_pipeline(features=(*MD.FEATURES, bad))
    with pytest.raises(MD.FeatureSchemaError):
        MD.check_features(spark.createDataFrame([(1.0,)], "ph double"))


def test_non_tree_rejected():
    with pytest.raises(X.NotATreeError):
        X.tree_from_pipeline(object())


def test_random_search_runs_and_picks_best(spark):
    from riverlens.operators.tuning import MacroF1Evaluator, sample_param_maps, tune
    df = scored_observations(spark, SF_SMALL).where(F.col("wqi_class").isNotNull())
    train = S.with_weights(S.stratified_split(df).where(F.col("split") == "train")
                           .select("obs_id", "wqi_class", *MD.RAW))
    best, scores = tune(MD.build_pipeline("decision_tree"), train, "decision_tree", n_iter=3, folds=2,
                        parallelism=2)
    assert len(scores) == 3 and all(0.0 <= s <= 1.0 for _p, s in scores)
    maps = sample_param_maps(MD.classifier("decision_tree"), {"maxDepth": [3, 5]}, n_iter=10)
    assert len(maps) == 2                      # never more candidates than the grid holds
    ev = MacroF1Evaluator()
    pred = best.transform(train)
    assert 0.0 < ev.evaluate(pred) <= 1.0


def test_imbalance_experiment_table(spark):
    from riverlens.operators.tuning import imbalance_experiment
    df = scored_observations(spark, SF_SMALL).where(F.col("wqi_class").isNotNull())
    sp = S.stratified_split(df, materialize=True).select("obs_id", "wqi_class", *MD.RAW, "split")
    train, test = sp.where(F.col("split") == "train"), sp.where(F.col("split") == "test")
    out = imbalance_experiment(train, test, kinds=("decision_tree", "logistic_regression")).collect()
    assert {(r["model_kind"], r["strategy"]) for r in out} == {
        (k, s) for k in ("decision_tree", "logistic_regression") for s in ("balanced_weights", "random_oversampling", "smote")}
    assert all(0.0 <= r["f1_macro"] <= 1.0 for r in out)


def test_boosted_trees_give_probabilities(spark):
    df = scored_observations(spark, SF_SMALL).where(F.col("wqi_class").isNotNull()).select("obs_id", "wqi_class", *MD.RAW)
    model = MD.build_pipeline("boosted_trees", max_iter=3).fit(df)
    pred = MD.predict(model, df)
    total = F.aggregate(F.map_values("probabilities"), F.lit(0.0), lambda a, x: a + x)
    assert pred.where(F.abs(total - 1) > 1e-9).count() == 0
    assert pred.where(F.col("probabilities")[F.col("predicted")] == F.col("top_probability")).count() >= 0.99 * df.count()
    assert pred.where("predicted = wqi_class").count() > 0.6 * df.count()


def test_tuned_candidates_update_the_comparison(spark):
    from riverlens.operators.tuning import tune_candidates
    df = scored_observations(spark, SF_SMALL).where(F.col("wqi_class").isNotNull())
    sp = S.stratified_split(df, materialize=True).select("obs_id", "wqi_class", *MD.RAW, "split")
    baseline = spark.createDataFrame([("decision_tree", 0.1), ("logistic_regression", 0.5), ("decision_tree (Tuned)", 0.3)],
                                     "model string, f1_macro double")
    out = {r["model"]: r for r in tune_candidates(sp.where("split = 'train'"), sp.where("split = 'test'"), baseline,
                                                  ("decision_tree",), n_iter=2, folds=2, parallelism=2).collect()}
    assert set(out) == {"decision_tree", "logistic_regression", "decision_tree (Tuned)"}
    tuned = out["decision_tree (Tuned)"]
    assert tuned["direction"] == "improved" and tuned["delta"] == pytest.approx(tuned["f1_macro"] - 0.1)


def test_boosting_on_cells_gives_the_trees_of_all_rows(spark):
    import random
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor
    from riverlens.operators import regression as R
    rng = random.Random(3)
    data = [(i, float(rng.randrange(60)), rng.choice([None, 0.0, 1.5, 2.5, 7.0]), rng.gauss(3, 2), abs(rng.gauss(0, 900))) for i in range(3000)]
    rows = spark.createDataFrame(data, "obs_id long, ph double, do_mgl double, bod_mgl double, fc double").withColumn(
        "wqi_score", F.col("ph") * F.coalesce("do_mgl", F.lit(3.0)) + F.sin("bod_mgl") * 20 + F.sqrt("fc"))
    made = R.build_regression("boosted_trees", max_iter=5).fit(rows)
    columns = [f"{c}_imp" for c in MD.FEATURES]
    plain = Pipeline(stages=[MD.Log10Feature(), MD.ExactMedianImputer(inputCols=list(MD.FEATURES)),
                             VectorAssembler(inputCols=columns, outputCol="features"),
                             GBTRegressor(featuresCol="features", labelCol="wqi_score", maxIter=5, maxDepth=6, stepSize=0.3, seed=42)]).fit(rows)
    both = R.predict_score(made, rows).join(R.predict_score(plain, rows).select("obs_id", F.col("prediction").alias("p")), "obs_id")
    assert both.where(F.abs(F.col("prediction") - F.col("p")) > 1e-6).count() == 0
    trees = [t for t in plain.stages[-1].trees]
    assert [t.numNodes for t in made.stages[-1].stages[-1].trees] == [t.numNodes for t in trees]


def test_the_cells_hold_all_rows_and_do_not_grow_with_them(spark):
    from riverlens.operators import regression as R
    bins = R.Bins(inputCols=["a", "b"], splits=[[0.5, 1.5], [10.0]])
    values = lambda n: spark.range(n).select((F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 23).cast("double").alias("b"),
                                             F.col("id").cast("double").alias("y"))
    for n in (500, 5000):
        got = R.cells(values(n), bins, "y").agg(F.count("*"), F.sum("weight"), F.sum(F.col("weight") * F.col("y"))).first()
        assert got[0] == 6 and got[1] == n and abs(got[2] - n * (n - 1) / 2) < 1e-6 * n * n
    odd = spark.createDataFrame([(0.5, 10.0), (float("nan"), None), (0.6, 10.1)], "a double, b double")
    assert [tuple(r) for r in bins.transform(odd).select("a_bin", "b_bin").collect()] == [(0.0, 0.0), (2.0, 1.0), (1.0, 1.0)]


def test_split_points_are_those_of_mllib():
    from riverlens.operators import regression as R
    assert R.split_points(np.array([1.0, 3.0, 3.0, np.nan, 2.0]), 5) == [1.5, 2.5]
    assert R.split_points(np.array([0.0, 0.0, -1.0, 2.0]), 4) == [-0.5, 1.0]
    assert R.split_points(np.array([np.nan, np.nan]), 2) == [] == R.split_points(np.array([4.0]), 1)
    many = R.split_points(np.arange(1000.0), 1000)
    assert len(many) == 31 and many == sorted(many)
