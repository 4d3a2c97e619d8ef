"""MLlib model pipeline: engineered feature, train-only imputation, weighted classifiers.

Stages (all persistable, fitted or not, with ``write().save`` / ``load``):

1. ``Log10Feature`` - a Transformer adding ``log10_fc`` (FEA-1 / FEA-2);
2. ``ExactMedianImputer`` - an Estimator; its model holds the train-only
   medians (FEA-3 / CLN-2; ``ml.feature.Imputer`` takes the lower middle
   element instead of the interpolated median);
3. ``VectorAssembler`` in the frozen feature order (PRJ-7);
4. ``StringIndexer`` for the label, and the classifier with a balanced
   ``weightCol`` (SPL-3).

The own stages are column expressions, so they run in the JVM.  Fits are
distributed MLlib jobs; of the data only the fitted model reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression, OneVsRest,
                                       RandomForestClassifier)
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverlens.functions import dims
from riverlens.functions.scalars import log10_floor1, no_nan
from riverlens.operators.quantiles import exact_quantiles, melt

RAW = dims.MODEL_FEATURES
FEATURES = (*RAW, dims.ENGINEERED_FEATURE)


class FeatureSchemaError(ValueError):
    """Input lacks a required raw feature or carries a forbidden column."""


class Log10Feature(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """FEA-1 / FEA-2 / SCL-2: log10(max(x, 1)) of the input column; null and NaN give null."""

    @keyword_only
    def __init__(self, *, inputCol: str = "fc", outputCol: str = dims.ENGINEERED_FEATURE):
        super().__init__()
        self._setDefault(inputCol="fc", outputCol=dims.ENGINEERED_FEATURE)
        self._set(**self._input_kwargs)

    def feature_names_in(self) -> list[str]:
        return [self.getInputCol()]

    def feature_names_out(self) -> list[str]:
        return [self.getOutputCol()]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOutputCol(), log10_floor1(no_nan(F.col(self.getInputCol()).cast("double"))))


class MedianImputerModel(Model, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Writes ``<column>_imp`` next to each raw column: the value, or the fitted median where it is null or NaN.

    A column that had no value when fitted has no median and stays as it is.
    """

    medians = Param(Params._dummy(), "medians", "fitted median of each input column", TypeConverters.toList)

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, medians: Sequence[float | None] | None = None):
        super().__init__()
        self._set(**{k: list(v) for k, v in self._input_kwargs.items() if v is not None})

    def getMedians(self) -> dict[str, float | None]:
        return dict(zip(self.getInputCols(), self.getOrDefault(self.medians)))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns({f"{c}_imp": F.coalesce(no_nan(F.col(c).cast("double")), F.lit(m).cast("double"))
                                    for c, m in self.getMedians().items()})


class ExactMedianImputer(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """FEA-3: fit exact medians on the training frame only; transform never refits."""

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] = RAW):
        super().__init__()
        self._setDefault(inputCols=list(RAW))
        self._set(**{k: list(v) for k, v in self._input_kwargs.items()})

    def _fit(self, dataset: DataFrame) -> MedianImputerModel:
        names = self.getInputCols()
        q = exact_quantiles(melt(dataset, names), "value", [0.5], ["feature"]).collect()  # one row per column
        med = {r["feature"]: r["quantile"] for r in q}
        return MedianImputerModel(inputCols=names, medians=[med.get(c) for c in names])


# FIXED VALUES: columns that may never be features (the target and what it is made from).
FORBIDDEN = ("wqi_score", "wqi_class", "potability")


def check_features(df: DataFrame | None, features: Sequence[str] = RAW, forbidden: Sequence[str] = FORBIDDEN) -> None:
    """VAL-2 / XAI-2: no leakage column among the features; the raw ones present in ``df``, if given."""
    leaks = [c for c in features if c.lower() in forbidden]
    if leaks:
        raise FeatureSchemaError(f"leakage columns among the features: {leaks}")
    have = {c.lower() for c in df.columns} if df is not None else set(RAW)
    missing = [c for c in RAW if c not in have]
    if missing:
        raise FeatureSchemaError(f"missing features {missing}")


#: MLlib's largest depth, in place of "no limit".
NO_LIMIT = 30
KINDS = ("decision_tree", "random_forest", "logistic_regression", "boosted_trees")


def classifier(kind: str, weight_col: str | None = "weight", seed: int = 42, max_depth: int = NO_LIMIT,
               max_iter: int = 100):
    """ML-1..4 estimators (balanced through ``weightCol`` except boosting).

    ``max_depth`` bounds the single tree and the forest, ``max_iter`` is the
    number of boosting rounds.  The forest caches its rows' node ids, and the
    boosting rounds are checkpointed: else every pass walks all trees so far.
    """
    common = dict(featuresCol="features", labelCol="label_idx")
    trees = dict(maxDepth=max_depth, maxBins=256, seed=seed, maxMemoryInMB=512, weightCol=weight_col)
    if kind == "decision_tree":
        return DecisionTreeClassifier(**trees, **common)
    if kind == "random_forest":
        return RandomForestClassifier(numTrees=100, cacheNodeIds=True, checkpointInterval=10, **trees, **common)
    if kind == "logistic_regression":
        return LogisticRegression(family="multinomial", maxIter=1000, weightCol=weight_col, **common)
    if kind == "boosted_trees":
        # GBT is binary in MLlib: one-vs-rest, one model a class side by side, no class weight (as the reference)
        return OneVsRest(classifier=GBTClassifier(maxIter=max_iter, maxDepth=6, stepSize=0.3, seed=seed, checkpointInterval=10),
                         parallelism=len(dims.CLASS_ORDER), **common)
    raise ValueError(f"unknown model {kind!r}")


def build_pipeline(kind: str = "decision_tree", label: str = "wqi_class", features: Sequence[str] = FEATURES,
                   **kw) -> Pipeline:
    """FEA-7 / SCO-1: unfitted pipeline from raw features to a predicted class label."""
    check_features(None, features)
    indexer = StringIndexer(inputCol=label, outputCol="label_idx", stringOrderType="alphabetAsc")
    weight = None if kind == "boosted_trees" else kw.pop("weight_col", "weight")
    return Pipeline(stages=[Log10Feature(), ExactMedianImputer(inputCols=features),
                            VectorAssembler(inputCols=[f"{c}_imp" for c in features], outputCol="features",
                                            handleInvalid="keep"),
                            indexer, classifier(kind, weight_col=weight, **kw)])


def label_names(model: PipelineModel) -> list[str]:
    return list(model.stages[3].labels)


def predict(model: PipelineModel, df: DataFrame, keys: Sequence[str] = ("obs_id",),
            label: str = "wqi_class") -> DataFrame:
    """SCO-2 / SCO-3 / SCO-4: predicted label, class probabilities, top probability, uncertain flag.

    ``df`` needs the raw features only; a label column is carried along if there
    is one, and an engineered column is made anew.  Boosted one-vs-rest models
    have margins: their logistic probabilities, scaled to sum 1, stand in.
    """
    check_features(df)
    out = model.transform(df.drop(dims.ENGINEERED_FEATURE))
    names = label_names(model)
    to_label = IndexToString(inputCol="prediction", outputCol="predicted", labels=names)
    out = to_label.transform(out)
    cols = [*keys, *([label] if label in df.columns else []), "predicted", "features"]
    if "probability" in out.columns or "rawPrediction" in out.columns:
        if "probability" in out.columns:
            probs = vector_to_array("probability")
        else:
            each = F.transform(vector_to_array("rawPrediction"), lambda m: 1 / (1 + F.exp(-2 * m)))
            probs = F.transform(each, lambda p: p / F.aggregate(each, F.lit(0.0), lambda a, b: a + b))
        out = out.withColumn("_p", probs)
        cols += [F.array_max("_p").alias("top_probability"),
                 F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.col("_p")).alias("probabilities"),
                 (F.array_max("_p") < dims.UNCERTAIN_BELOW).alias("uncertain")]
    return out.select(*cols)


def preprocess(model: PipelineModel, df: DataFrame, keys: Sequence[str] = ("submission_id",)) -> DataFrame:
    """SCO-7: (keys, input_count, processed_feature_count, processed) of validated rows.

    The stages before the label's indexer, which a row without a label does not
    need; ``processed`` is the feature vector that the classifier would see.
    """
    check_features(df)
    out = df.drop(dims.ENGINEERED_FEATURE)
    for stage in model.stages[:3]:
        out = stage.transform(out)
    x = vector_to_array("features")
    return out.select(*keys, F.lit(len(RAW)).alias("input_count"), F.size(x).alias("processed_feature_count"), x.alias("processed"))


def one_hot(df: DataFrame, columns: Sequence[str]):
    """FEA-6: one-hot for text features; a value unseen at fit time encodes as all zeros.

    ``StringIndexer(handleInvalid="keep")`` maps unseen values to the last
    index and ``OneHotEncoder(dropLast=True)`` drops exactly that slot.
    """
    from pyspark.ml.feature import OneHotEncoder
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep") for c in columns]
    enc = OneHotEncoder(inputCols=[f"{c}_idx" for c in columns], outputCols=[f"{c}_vec" for c in columns],
                        dropLast=True, handleInvalid="error")
    return Pipeline(stages=[*idx, enc]).fit(df)
