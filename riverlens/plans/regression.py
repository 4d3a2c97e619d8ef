"""Regression queries (ML-14): fitted regressors, and a closed form that SQL can check."""

from __future__ import annotations

from pyspark.sql import functions as F

from riverlens.operators import models as MD
from riverlens.operators import regression as R
from riverlens.plans.registry import register
from riverlens.plans.training import SPLIT_SQL, split_frame
from riverlens.session import written


def _sides(spark, sf_dir):
    sp = written(split_frame(spark, sf_dir).select("obs_id", "wqi_score", *MD.RAW, "split"), "regression-split")
    return sp.where("split = 'train'"), sp.where("split = 'test'")


@register("score_regressors", ("ML-14",))
def score_regressors(spark, sf_dir):
    """Linear and boosted regression of the score on all features, measured on the test rows."""
    train, test = _sides(spark, sf_dir)
    return R.compare_regressors(train, test)


@register("bod_score_regression", ("ML-14", "FEA-3"), oracle=f"""
WITH {SPLIT_SQL},
md AS (SELECT quantile_cont(bod_mgl, 0.5) AS m FROM sp WHERE split = 'train'),
x AS (SELECT split, coalesce(bod_mgl, (SELECT m FROM md)) AS x, wqi_score AS y FROM sp),
c AS (SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept FROM x WHERE split = 'train'),
e AS (SELECT y, slope * x + intercept AS p, slope, intercept FROM x, c WHERE split = 'test')
SELECT count(*) AS n, round(any_value(slope), 4) AS slope, round(any_value(intercept), 4) AS intercept,
       round(avg(abs(p - y)), 4) AS mae, round(sqrt(avg((p - y) * (p - y))), 4) AS rmse,
       round(1 - avg((p - y) * (p - y)) / var_pop(y), 6) AS r2 FROM e
""")
def bod_score_regression(spark, sf_dir):
    """The score on oxygen demand alone: the fitted line and its errors on the test rows."""
    train, test = _sides(spark, sf_dir)
    model = R.build_regression("linear", ("bod_mgl",)).fit(train)
    terms = dict(R.coefficients(model, ("bod_mgl",)))
    pred = R.predict_score(model, test)
    err = F.col("prediction") - F.col("label")
    return pred.agg(F.count("*").alias("n"), F.round(F.lit(terms["bod_mgl"]), 4).alias("slope"),
                    F.round(F.lit(terms["intercept"]), 4).alias("intercept"), F.round(F.avg(F.abs(err)), 4).alias("mae"),
                    F.round(F.sqrt(F.avg(err * err)), 4).alias("rmse"), F.round(1 - F.avg(err * err) / F.var_pop("label"), 6).alias("r2"))
