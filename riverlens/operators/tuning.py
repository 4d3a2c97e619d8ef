"""Random search with stratified-by-hash folds and a macro-F1 evaluator (ML-6, ML-7).

``CrossValidator`` with an explicit fold column (md5-derived, so folds do not
depend on partitioning) and ``parallelism`` fits candidates concurrently;
each fit is itself a distributed MLlib job.  The evaluator reduces the
(label, prediction) pairs to a per-class table (at most k x k rows) before
anything reaches the driver.
"""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.ml.evaluation import Evaluator
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverlens.operators.split import order_key
from riverlens.session import written

# FIXED VALUES: search spaces (MLlib names; "no depth limit" becomes MLlib's maximum 30).
GRIDS: dict[str, dict[str, Sequence]] = {
    "decision_tree": {"maxDepth": [3, 5, 8, 10, 15, 20, 30], "minInstancesPerNode": [1, 2, 4, 8],
                      "impurity": ["gini", "entropy"]},
    "random_forest": {"numTrees": [50, 100, 200, 300], "maxDepth": [5, 10, 15, 20, 30],
                      "minInstancesPerNode": [1, 2, 4], "featureSubsetStrategy": ["sqrt", "log2", "all"]},
}
N_ITER = 25
FOLDS = 5


class MacroF1Evaluator(Evaluator):
    """Macro F1 over labels seen in truth or prediction (zero division -> 0)."""

    def __init__(self, label_col: str = "label_idx", prediction_col: str = "prediction"):
        super().__init__()
        self.label_col, self.prediction_col = label_col, prediction_col

    def _evaluate(self, dataset: DataFrame) -> float:
        cells = (dataset.groupBy(F.col(self.label_col).alias("t"), F.col(self.prediction_col).alias("p"))
                        .count().collect())   # at most k x k rows
        labels = {r["t"] for r in cells} | {r["p"] for r in cells}
        f1s = []
        for c in labels:
            tp = sum(r["count"] for r in cells if r["t"] == c and r["p"] == c)
            sup = sum(r["count"] for r in cells if r["t"] == c)
            pred = sum(r["count"] for r in cells if r["p"] == c)
            p = tp / pred if pred else 0.0
            rc = tp / sup if sup else 0.0
            f1s.append(2 * p * rc / (p + rc) if p + rc else 0.0)
        return sum(f1s) / len(f1s) if f1s else 0.0

    def isLargerBetter(self) -> bool:
        return True


def sample_param_maps(estimator, grid: dict[str, Sequence], n_iter: int = N_ITER, seed: int = 42):
    """Seeded random candidates from the grid (without repeats when the grid is small)."""
    rng = random.Random(seed)
    names = sorted(grid)
    seen, maps = set(), []
    total = 1
    for n in names:
        total *= len(grid[n])
    while len(maps) < min(n_iter, total):
        pick = tuple(rng.choice(list(grid[n])) for n in names)
        if pick in seen:
            continue
        seen.add(pick)
        maps.append({estimator.getParam(n): v for n, v in zip(names, pick)})
    return maps


def tune(pipeline, train: DataFrame, kind: str, key: str = "obs_id", n_iter: int = N_ITER, folds: int = FOLDS,
         seed: int = 42, parallelism: int = 4):
    """ML-6: random search with k folds; returns (best pipeline model, [(params, mean macro F1)])."""
    est = pipeline.getStages()[-1]
    maps = sample_param_maps(est, GRIDS[kind], n_iter, seed)
    # every candidate x fold fit re-reads the data: written once to the shared folder
    data = written(train.withColumn("fold", (order_key(F.col(key), seed + 7) % folds).cast("int")), "tuning")
    cv = CrossValidator(estimator=pipeline, estimatorParamMaps=maps, evaluator=MacroF1Evaluator(),
                        foldCol="fold", numFolds=folds, parallelism=parallelism, seed=seed)
    model = cv.fit(data)
    scores = [({p.name: v for p, v in m.items()}, s) for m, s in zip(maps, model.avgMetrics)]
    return model.bestModel, scores


def imbalance_experiment(train: DataFrame, test: DataFrame, kinds: Sequence[str] = ("decision_tree",
                         "random_forest", "logistic_regression", "boosted_trees"),
                         strategies: Sequence[str] = ("balanced_weights", "random_oversampling", "smote"),
                         label: str = "wqi_class") -> DataFrame:
    """ML-13: macro F1 per (model, imbalance strategy) on the same test split.

    ``balanced_weights`` trains with n / (k n_c) weights; ``random_oversampling``
    trains unweighted on the deterministic oversample of the training rows
    (SPL-4).  Boosted trees take no weights, as in the reference.
    """
    from riverlens.operators import metrics as M
    from riverlens.operators import models as MD
    from riverlens.operators.split import resample, with_weights
    conf = None
    for strategy in strategies:
        if strategy == "balanced_weights":
            data = with_weights(train, label)
        elif strategy in ("random_oversampling", "smote"):
            rows = train.dropna(subset=list(MD.RAW)) if strategy == "smote" else train
            data = resample(rows, "ros" if strategy == "random_oversampling" else strategy, MD.RAW, label)
            data = data.withColumn("weight", F.lit(1.0))
        else:
            raise ValueError(f"unknown strategy {strategy!r}")
        data = written(data, "resampled")
        for kind in kinds:
            model = MD.build_pipeline(kind).fit(data)
            pred = MD.predict(model, test).select(F.col(label).alias("label"), F.col("predicted").alias("prediction"))
            c = M.confusion(pred, model=f"{kind}|{strategy}")
            conf = c if conf is None else conf.unionByName(c)
    ov = M.overall(conf, ["model"])
    parts = F.split(F.col("model"), "[|]")
    return ov.select(parts[0].alias("model_kind"), parts[1].alias("strategy"), "f1_macro", "f1_weighted", "accuracy")


def tune_candidates(train: DataFrame, test: DataFrame, baseline: DataFrame, kinds: Sequence[str] = ("decision_tree", "random_forest"),
                    label: str = "wqi_class", **search) -> DataFrame:
    """ML-7 / SNK-7: tune the named candidates and update the comparison table.

    ``baseline`` has (model, f1_macro).  Each candidate is tuned on ``train``
    (weighted by class) and evaluated on ``test`` once.  Returns the baseline
    rows and a "(Tuned)" row per candidate with its change and its direction.
    """
    from riverlens.operators import metrics as M
    from riverlens.operators import models as MD
    from riverlens.operators.split import with_weights
    from riverlens.sources.sinks import update_comparison
    weighted = written(with_weights(train, label), "tuning-train")
    conf = None
    for kind in kinds:
        best, _ = tune(MD.build_pipeline(kind), weighted, kind, **search)
        pred = MD.predict(best, test).select(F.col(label).alias("label"), F.col("predicted").alias("prediction"))
        c = M.confusion(pred, model=kind)
        conf = c if conf is None else conf.unionByName(c)
    tuned = M.overall(conf, ["model"]).select(F.col("model").alias("_kind"), F.col("f1_macro").alias("_f1"))
    fresh = tuned.join(baseline.select(F.col("model").alias("_kind"), F.col("f1_macro").alias("_old")), "_kind", "left")
    delta = F.col("_f1") - F.col("_old")
    fresh = fresh.select(F.concat("_kind", F.lit(" (Tuned)")).alias("model"), F.col("_f1").alias("f1_macro"), delta.alias("delta"),
                         F.when(delta > 0, "improved").when(delta < 0, "worse").when(delta == 0, "unchanged").alias("direction"))
    return update_comparison(baseline, fresh)
