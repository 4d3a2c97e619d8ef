"""Index scoring and labelling queries (WQI-1..6, AGG-4..7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riverlens.operators import labelling as L
from riverlens.plans.oracle import class_dim_sql, d, scored_cte
from riverlens.plans.registry import register
from riverlens.sources.tables import observations


def scored_observations(spark, sf_dir, with_coordinates=False, raw=False):
    return L.score(observations(spark, sf_dir, with_coordinates, raw))


@register("wqi_scores", ("WQI-1", "WQI-2", "WQI-3", "WQI-4", "SCL-3"), oracle=f"""
WITH {scored_cte()}
SELECT obs_id, station, state, n_params, round(wqi_score, 6) AS wqi_score, wqi_class, potability
FROM scored
""")
def wqi_scores(spark, sf_dir):
    s = scored_observations(spark, sf_dir)
    return s.select("obs_id", "station", "state", "n_params", L.r(F.col("wqi_score")).alias("wqi_score"),
                    "wqi_class", "potability")


@register("wqi_class_distribution", ("WQI-5", "AGG-4", "SRT-2"), oracle=f"""
WITH {scored_cte()}, {class_dim_sql()},
counts AS (SELECT wqi_class, count(*) AS n FROM scored WHERE wqi_class IS NOT NULL GROUP BY wqi_class),
total AS (SELECT count(wqi_score) AS t FROM scored)
SELECT c.wqi_class, c.class_order, c.category, c.wqi_range, c.binary_potability,
       CAST(coalesce(n, 0) AS BIGINT) AS n,
       round(CASE WHEN t > 0 THEN coalesce(n, 0) * {d(100.0)} / t ELSE {d(0.0)} END, 6) AS percentage
FROM classes c LEFT JOIN counts USING (wqi_class) CROSS JOIN total
""")
def wqi_class_distribution(spark, sf_dir):
    return L.class_report(scored_observations(spark, sf_dir))


_SHARES = " , ".join(
    f"CASE WHEN labelled_records > 0 THEN c{i} * {d(100.0)} / labelled_records ELSE {d(0.0)} END AS s{i}"
    for i in range(5))


@register("wqi_label_summary", ("WQI-5", "AGG-5", "AGG-6", "AGG-7"), oracle=f"""
WITH {scored_cte()},
base AS (
  SELECT count(*) AS total_records, count(wqi_score) AS labelled_records,
         count(*) FILTER (WHERE wqi_score IS NULL) AS quarantined_records,
         count(*) FILTER (WHERE potability = 1) AS potable_count,
         count(*) FILTER (WHERE potability = 0) AS non_potable_count,
         avg(wqi_score) AS mean_wqi, quantile_cont(wqi_score, 0.5) AS median_wqi,
         count(*) FILTER (WHERE wqi_class = 'Excellent') AS c0,
         count(*) FILTER (WHERE wqi_class = 'Good') AS c1,
         count(*) FILTER (WHERE wqi_class = 'Poor') AS c2,
         count(*) FILTER (WHERE wqi_class = 'Very Poor') AS c3,
         count(*) FILTER (WHERE wqi_class = 'Unsuitable') AS c4
  FROM scored),
sh AS (SELECT *, {_SHARES} FROM base),
top AS (SELECT *, greatest(s0, s1, s2, s3, s4) AS t FROM sh)
SELECT total_records, labelled_records, quarantined_records, potable_count, non_potable_count,
       round(CASE WHEN labelled_records > 0 THEN potable_count * {d(100.0)} / labelled_records
             ELSE {d(0.0)} END, 6) AS potable_percentage,
       round(mean_wqi, 6) AS mean_wqi, round(median_wqi, 6) AS median_wqi,
       round(t, 6) AS dominant_percentage,
       CASE WHEN s0 = t THEN 'Excellent' WHEN s1 = t THEN 'Good' WHEN s2 = t THEN 'Poor'
            WHEN s3 = t THEN 'Very Poor' ELSE 'Unsuitable' END AS dominant_class,
       t > {d(90.0)} AS severely_imbalanced
FROM top
""")
def wqi_label_summary(spark, sf_dir):
    return L.label_summary(scored_observations(spark, sf_dir))


@register("wqi_quarantine", ("WQI-5", "SNK-2"), oracle=f"""
WITH {scored_cte()}
SELECT obs_id, station, state, n_params FROM scored WHERE wqi_score IS NULL
""")
def wqi_quarantine(spark, sf_dir):
    _labelled, quarantine = L.split_labelled(scored_observations(spark, sf_dir))
    return quarantine.select("obs_id", "station", "state", "n_params")


def _contrib_sql() -> str:
    from riverlens.functions import dims
    from riverlens.plans.oracle import sub_index_sql
    parts = []
    for p in dims.INDEX_PARAMETERS:
        if p.column not in ("ph", "do_mgl", "bod_mgl", "fc"):
            continue
        parts.append(
            f"SELECT obs_id, '{p.code}' AS parameter, {p.column} AS value, "
            f"{sub_index_sql(p, p.column)} AS sub_index, {d(1.0 / p.limit)} AS weight, wqi_score, "
            f"({' + '.join(f'(CASE WHEN {q.column} IS NOT NULL THEN {d(1.0 / q.limit)} ELSE {d(0.0)} END)' for q in dims.INDEX_PARAMETERS if q.column in ('ph', 'do_mgl', 'bod_mgl', 'fc'))}) AS sw "
            f"FROM scored WHERE wqi_score IS NOT NULL AND {p.column} IS NOT NULL")
    return " UNION ALL ".join(parts)


@register("wqi_contributions", ("WQI-6",), oracle=f"""
WITH {scored_cte()}, long AS ({_contrib_sql()})
SELECT obs_id, parameter, round(value, 6) AS value, round(sub_index, 6) AS sub_index,
       round(weight, 6) AS weight, round(sub_index * weight / sw, 6) AS contribution,
       round(wqi_score, 6) AS wqi_score
FROM long
""")
def wqi_contributions(spark, sf_dir):
    c = L.contributions(scored_observations(spark, sf_dir))
    return c.select("obs_id", "parameter", *[L.r(F.col(x)).alias(x) for x in
                                              ("value", "sub_index", "weight", "contribution", "wqi_score")])
