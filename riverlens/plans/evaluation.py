"""Metric queries (ML-8..12) over two index-based stand-in predictors.

Truth is the full four-parameter class; the stand-ins predict the class
from three parameters only (pH + BOD + FC, and pH + DO + BOD), so the
metric jobs run on whole tables without a fitted model.  The same metric
operators evaluate MLlib predictions in ``riverlens.operators.models``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from riverlens.functions.dims import CLASS_ORDER, PARAMETER_BY_COLUMN
from riverlens.functions.index import class_label, with_score
from riverlens.operators import metrics as M
from riverlens.plans.labelling import scored_observations
from riverlens.plans.oracle import class_sql, d, index_ctes, obs_cte, scored_cte
from riverlens.plans.registry import register

STAND_INS = {"ph_bod_fc": ("ph", "bod_mgl", "fc"), "ph_do_bod": ("ph", "do_mgl", "bod_mgl")}


def predictions(spark, sf_dir, model="ph_bod_fc"):
    """(obs_id, label, prediction) where both exist."""
    df = scored_observations(spark, sf_dir)
    params = [PARAMETER_BY_COLUMN[c] for c in STAND_INS[model]]
    df = with_score(df, params, n_name="_pn", score_name="_ps")
    return (df.select("obs_id", F.col("wqi_class").alias("label"),
                      class_label(F.col("_ps")).alias("prediction"))
              .where(F.col("label").isNotNull() & F.col("prediction").isNotNull()))


def _pred_sql(model):
    cols = STAND_INS[model]
    idx, name = index_ctes("obs", cols, f"_p_{model}")
    return idx, (f"pred_{model} AS (SELECT s.obs_id, s.wqi_class AS label, {class_sql('p.wqi_score')} AS prediction "
                 f"FROM scored s JOIN {name} p USING (obs_id) WHERE s.wqi_class IS NOT NULL AND p.wqi_score IS NOT NULL)")


def _with_preds():
    parts = [scored_cte()]
    for m in STAND_INS:
        a, b = _pred_sql(m)
        parts += [a, b]
    return ", ".join(parts)


LABELS_SQL = ", ".join(f"('{c}', {i + 1})" for i, c in enumerate(CLASS_ORDER))


def _conf_sql(model):
    return (f"lab(c, o) AS (SELECT * FROM (VALUES {LABELS_SQL})), "
            f"cnt AS (SELECT label, prediction, count(*) AS n FROM pred_{model} GROUP BY ALL), "
            f"conf AS (SELECT t.c AS truth, CAST(t.o AS INTEGER) AS truth_order, p.c AS predicted, "
            f"CAST(p.o AS INTEGER) AS predicted_order, CAST(coalesce(n, 0) AS BIGINT) AS n "
            f"FROM lab t CROSS JOIN lab p LEFT JOIN cnt ON cnt.label = t.c AND cnt.prediction = p.c)")


_PC_SQL = (f"pc0 AS (SELECT truth AS wqi_class, truth_order AS class_order, "
           f"sum(n) FILTER (WHERE truth = predicted) AS tp, sum(n) AS support FROM conf GROUP BY ALL), "
           f"pp AS (SELECT predicted AS wqi_class, sum(n) AS predicted FROM conf GROUP BY ALL), "
           f"pc1 AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE {d(0.0)} END AS precision, "
           f"CASE WHEN support > 0 THEN tp / support ELSE {d(0.0)} END AS recall FROM pc0 JOIN pp USING (wqi_class)), "
           f"pc AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) "
           f"ELSE {d(0.0)} END AS f1 FROM pc1)")


@register("confusion_matrix", ("ML-8",), oracle=f"""
WITH {_with_preds()}, {_conf_sql('ph_bod_fc')}
SELECT * FROM conf
""")
def confusion_matrix(spark, sf_dir):
    return M.confusion(predictions(spark, sf_dir))


@register("per_class_metrics", ("ML-9",), oracle=f"""
WITH {_with_preds()}, {_conf_sql('ph_bod_fc')}, {_PC_SQL}
SELECT wqi_class, class_order, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support, CAST(predicted AS BIGINT) AS predicted FROM pc
""")
def per_class_metrics(spark, sf_dir):
    pc = M.per_class(M.confusion(predictions(spark, sf_dir)))
    return pc.select("wqi_class", "class_order", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")],
                     "support", "predicted")


@register("overall_metrics", ("ML-10",), oracle=f"""
WITH {_with_preds()}, {_conf_sql('ph_bod_fc')}, {_PC_SQL}
SELECT (SELECT CAST(sum(n) AS BIGINT) FROM conf) AS n,
       round((SELECT sum(n) FILTER (WHERE truth = predicted) / sum(n) FROM conf), 6) AS accuracy,
       round(avg(precision), 6) AS precision_macro, round(avg(recall), 6) AS recall_macro,
       round(avg(f1), 6) AS f1_macro, round(sum(f1 * support) / sum(support), 6) AS f1_weighted
FROM pc WHERE support > 0 OR predicted > 0
""")
def overall_metrics(spark, sf_dir):
    return M.overall(M.confusion(predictions(spark, sf_dir)))


@register("normalised_confusion", ("ML-11",), oracle=f"""
WITH {_with_preds()}, {_conf_sql('ph_bod_fc')}
SELECT truth, truth_order, predicted, predicted_order,
       round(CASE WHEN sum(n) OVER (PARTITION BY truth) > 0 THEN n / sum(n) OVER (PARTITION BY truth)
             ELSE {d(0.0)} END, 6) AS share FROM conf
""")
def normalised_confusion(spark, sf_dir):
    return M.normalised_confusion(M.confusion(predictions(spark, sf_dir)))


def _model_row_sql(model):
    return f"""SELECT '{model}' AS model, * FROM (
  WITH {_conf_sql(model)}, {_PC_SQL},
  w2 AS (SELECT avg(recall) AS worst_two_recall FROM (SELECT recall FROM pc WHERE support > 0
         ORDER BY recall, class_order LIMIT 2))
  SELECT round(avg(f1), 6) AS f1_macro, (SELECT worst_two_recall FROM w2) AS worst_two_recall,
         round((SELECT sum(n) FILTER (WHERE truth = predicted) / sum(n) FROM conf), 6) AS accuracy,
         round(sum(f1 * support) / sum(support), 6) AS f1_weighted
  FROM pc WHERE support > 0 OR predicted > 0)"""


@register("model_selection", ("ML-11", "ML-12", "SRT-3"), oracle=f"""
WITH {_with_preds()},
rows_ AS ({' UNION ALL '.join(_model_row_sql(m) for m in STAND_INS)}),
b AS (SELECT *, f1_macro >= max(f1_macro) OVER () - {d(0.015)} AS near FROM rows_)
SELECT model, f1_macro, round(worst_two_recall, 6) AS worst_two_recall, accuracy, f1_weighted,
       CAST(row_number() OVER (ORDER BY near DESC, CASE WHEN near THEN round(worst_two_recall, 6) END DESC NULLS LAST,
                               f1_macro DESC, model) AS INTEGER) AS selection_rank
FROM b
""")
def model_selection(spark, sf_dir):
    conf = None
    for m in STAND_INS:
        c = M.confusion(predictions(spark, sf_dir, m), model=m)
        conf = c if conf is None else conf.unionByName(c)
    return M.select_model(conf)
