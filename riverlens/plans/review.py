"""Review-table, regression-metric and JSON document queries (SCO-8, ML-14, RUL-4, SCL-5, SCL-9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riverlens.functions.dims import PARAMETER_BY_COLUMN, STANDARD_SOURCES
from riverlens.functions.index import with_score
from riverlens.functions.scalars import log10_floor1
from riverlens.operators import metrics as M
from riverlens.operators import scoring as SC
from riverlens.plans.labelling import scored_observations
from riverlens.plans.oracle import d, index_ctes, scored_cte
from riverlens.plans.registry import register
from riverlens.plans.rules import obs_with_findings


# the oracle's own table of limits: (column, parameter, lowest, highest, unit)
_REVIEWED = (("ph", "pH", 6.5, 8.5, "pH scale"), ("do_mgl", "DO", 5.0, 14.6, "mg/L"), ("bod_mgl", "BOD", None, 3.0, "mg/L"),
             ("fc", "FC", None, 250.0, "MPN/100mL"), ("log10_fc", "Log10_FC", None, 2.398, "log10 MPN/100mL"))


def _review_sql():
    parts = []
    for col, param, lo, hi, unit in _REVIEWED:
        conds = ([f"{col} < {d(lo)}"] if lo is not None else []) + [f"{col} > {d(hi)}"]
        parts.append(f"SELECT obs_id, '{param}' AS parameter, round({col}, 6) AS value, '{unit}' AS unit, "
                     f"{d(lo) if lo is not None else 'CAST(NULL AS DOUBLE)'} AS lower_limit, {d(hi)} AS upper_limit, "
                     f"'{STANDARD_SOURCES[param]}' AS source, coalesce({' OR '.join(conds)}, false) AS abnormal FROM rv")
    return " UNION ALL ".join(parts)


@register("measurement_review", ("SCO-8",), oracle=f"""
WITH {scored_cte(raw=True)}, rv AS (SELECT *, CASE WHEN fc IS NOT NULL THEN log10(greatest(fc, {d(1.0)})) END AS log10_fc FROM scored)
{_review_sql()}
""")
def measurement_review(spark, sf_dir):
    s = scored_observations(spark, sf_dir, raw=True).withColumn("log10_fc", log10_floor1(F.col("fc")))
    return SC.measurement_review(s).withColumn("value", F.round("value", 6))


_REG_IDX, _REG_OUT = index_ctes("obs", ("ph", "bod_mgl", "fc"), "regp")


@register("score_regression_metrics", ("ML-14",), oracle=f"""
WITH {scored_cte()}, {_REG_IDX},
j AS (SELECT s.wqi_score AS label, p.wqi_score AS prediction FROM scored s JOIN {_REG_OUT} p USING (obs_id)
      WHERE s.wqi_score IS NOT NULL AND p.wqi_score IS NOT NULL)
SELECT count(*) AS n, round(avg(abs(prediction - label)), 6) AS mae,
       round(sqrt(avg((prediction - label) * (prediction - label))), 6) AS rmse,
       round(CASE WHEN var_pop(label) > 0 THEN 1 - avg((prediction - label) * (prediction - label)) / var_pop(label) END, 6) AS r2
FROM j
""")
def score_regression_metrics(spark, sf_dir):
    """A three-parameter score as the 'regressor' of the full score (stand-in for a fitted model)."""
    s = scored_observations(spark, sf_dir)
    s = with_score(s, [PARAMETER_BY_COLUMN[c] for c in ("ph", "bod_mgl", "fc")], n_name="_pn", score_name="_ps")
    return M.regression_metrics(s.select(F.col("wqi_score").alias("label"), F.col("_ps").alias("prediction")))


@register("decision_summary_documents", ("RUL-4", "SCL-5", "SCL-9"))
def decision_summary_documents(spark, sf_dir):
    return SC.decision_summary_json(obs_with_findings(spark, sf_dir))
