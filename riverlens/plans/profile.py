"""Profiling and cleaning-audit queries (AGG-8..23, AGG-29, FLT-1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riverlens.functions import dims
from riverlens.functions.scalars import log10_floor1
from riverlens.operators import profile as P
from riverlens.plans.oracle import d, scored_cte
from riverlens.plans.registry import register
from riverlens.plans.labelling import scored_observations

FEATURES = ("ph", "do_mgl", "bod_mgl", "fc", "log10_fc")
RAW = dims.MODEL_FEATURES

PROF_CTE = (f"{scored_cte()}, prof AS (SELECT *, CASE WHEN fc IS NOT NULL THEN "
            f"log10(greatest(fc, {d(1.0)})) END AS log10_fc FROM scored)")


def profiled(spark, sf_dir):
    return scored_observations(spark, sf_dir).withColumn("log10_fc", log10_floor1(F.col("fc")))


def long_sql(src, features, keys=(), where=None):
    kp = "".join(f"{k}, " for k in keys)
    w = f" WHERE {where}" if where else ""
    return " UNION ALL ".join(
        f"SELECT {kp}'{c}' AS feature, {i} AS feature_order, {c} AS value FROM {src}{w}"
        for i, c in enumerate(features))


def _summary_sql():
    parts = []
    for i, c in enumerate(FEATURES):
        parts.append(
            f"SELECT '{c}' AS feature, {i} AS feature_order, count({c}) AS count, "
            f"count(*) - count({c}) AS missing_count, "
            f"round((count(*) - count({c})) * {d(100.0)} / count(*), 6) AS missing_pct, "
            f"round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min, "
            f"round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS median, "
            f"round(quantile_cont({c}, 0.75), 6) AS q75, round(max({c}), 6) AS max, "
            f"round(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), 6) AS iqr, "
            f"round(skewness({c}), 6) AS skewness, round(kurtosis({c}), 6) AS kurtosis FROM prof")
    return " UNION ALL ".join(parts)


@register("summary_statistics", ("AGG-9", "AGG-10"), oracle=f"""
WITH {PROF_CTE}
SELECT feature, CAST(feature_order AS INTEGER) AS feature_order, CAST(count AS BIGINT) AS count,
       CAST(missing_count AS BIGINT) AS missing_count, missing_pct, mean, std, min, q25, median, q75, max,
       iqr, skewness, kurtosis FROM ({_summary_sql()})
""")
def summary_statistics(spark, sf_dir):
    return P.summary_statistics(profiled(spark, sf_dir), FEATURES)


@register("outlier_audit", ("AGG-11", "AGG-29"), oracle=f"""
WITH {PROF_CTE}, long AS ({long_sql('prof', FEATURES)}),
par AS (SELECT feature, count(value) AS n, quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.75) AS q75,
               avg(value) AS mu, stddev_samp(value) AS sd FROM long GROUP BY feature)
SELECT l.feature, CAST(max(n) AS BIGINT) AS n,
  round(max(q25 - {d(1.5)} * (q75 - q25)), 6) AS lower_fence, round(max(q75 + {d(1.5)} * (q75 - q25)), 6) AS upper_fence,
  count(*) FILTER (WHERE value < q25 - {d(1.5)} * (q75 - q25) OR value > q75 + {d(1.5)} * (q75 - q25)) AS iqr_outliers,
  round(count(*) FILTER (WHERE value < q25 - {d(1.5)} * (q75 - q25) OR value > q75 + {d(1.5)} * (q75 - q25)) * {d(100.0)} / max(n), 6) AS iqr_outlier_pct,
  count(*) FILTER (WHERE value < q25 - {d(3.0)} * (q75 - q25) OR value > q75 + {d(3.0)} * (q75 - q25)) AS extreme_outliers,
  round(count(*) FILTER (WHERE value < q25 - {d(3.0)} * (q75 - q25) OR value > q75 + {d(3.0)} * (q75 - q25)) * {d(100.0)} / max(n), 6) AS extreme_outlier_pct,
  count(*) FILTER (WHERE sd > 0 AND abs((value - mu) / sd) > {d(3.0)}) AS z_outliers,
  round(count(*) FILTER (WHERE sd > 0 AND abs((value - mu) / sd) > {d(3.0)}) * {d(100.0)} / max(n), 6) AS z_outlier_pct
FROM long l JOIN par p ON l.feature = p.feature WHERE value IS NOT NULL GROUP BY l.feature
""")
def outlier_audit(spark, sf_dir):
    return P.outlier_audit(profiled(spark, sf_dir), FEATURES)


def _bad(c):
    lo, hi = dims.CLEANING_BOUNDS[c]
    return f"coalesce({c} < {d(lo)} OR {c} > {d(hi)}, false)"


_ANY_BAD = " OR ".join(_bad(c) for c in RAW)


@register("invalid_counts", ("AGG-12",), oracle=f"""
WITH {scored_cte(raw=True)}
{' UNION ALL '.join(f"SELECT '{c}' AS feature, count(*) FILTER (WHERE {_bad(c)}) AS invalid, count(*) AS rows FROM scored" for c in RAW)}
UNION ALL SELECT 'any' AS feature, count(*) FILTER (WHERE {_ANY_BAD}) AS invalid, count(*) AS rows FROM scored
""")
def invalid_counts(spark, sf_dir):
    return P.invalid_counts(scored_observations(spark, sf_dir, raw=True))


@register("valid_observations", ("FLT-1",), oracle=f"""
WITH {scored_cte(raw=True)}
SELECT obs_id, round(ph, 6) AS ph, round(do_mgl, 6) AS do_mgl, round(bod_mgl, 6) AS bod_mgl, round(fc, 6) AS fc
FROM scored WHERE NOT ({_ANY_BAD})
""")
def valid_observations(spark, sf_dir):
    df = P.remove_invalid(scored_observations(spark, sf_dir, raw=True))
    return df.select("obs_id", *[P.r(F.col(c)).alias(c) for c in RAW])


def _class_dim_values():
    return ", ".join(f"('{c}', {i + 1})" for i, c in enumerate(dims.CLASS_ORDER))


@register("class_loss_after_cleaning", ("AGG-13",), oracle=f"""
WITH {scored_cte(raw=True)}, cls(wqi_class, class_order) AS (SELECT * FROM (VALUES {_class_dim_values()})),
b AS (SELECT wqi_class, count(*) AS n FROM scored GROUP BY wqi_class),
a AS (SELECT wqi_class, count(*) AS n FROM scored WHERE NOT ({_ANY_BAD}) GROUP BY wqi_class)
SELECT c.wqi_class, c.class_order, CAST(coalesce(b.n, 0) AS BIGINT) AS before, CAST(coalesce(a.n, 0) AS BIGINT) AS after,
       round(CASE WHEN coalesce(b.n, 0) > 0 THEN (coalesce(b.n, 0) - coalesce(a.n, 0)) * {d(100.0)} / b.n ELSE {d(0.0)} END, 6) AS loss_pct,
       CASE WHEN coalesce(b.n, 0) > 0 THEN (coalesce(b.n, 0) - coalesce(a.n, 0)) * {d(100.0)} / b.n ELSE {d(0.0)} END > {d(10.0)} AS loss_flag
FROM cls c LEFT JOIN b USING (wqi_class) LEFT JOIN a USING (wqi_class)
""")
def class_loss_after_cleaning(spark, sf_dir):
    s = scored_observations(spark, sf_dir, raw=True)
    return P.class_loss(s, ~P.any_invalid(s))


@register("class_distribution", ("AGG-8", "SRT-2"), oracle=f"""
WITH {scored_cte()}, cls(wqi_class, class_order) AS (SELECT * FROM (VALUES {_class_dim_values()})),
c AS (SELECT wqi_class, count(*) AS n FROM scored WHERE wqi_class IS NOT NULL GROUP BY wqi_class)
SELECT c.wqi_class, CAST(n AS BIGINT) AS n, round(n / sum(n) OVER (), 6) AS share, cls.class_order
FROM c LEFT JOIN cls USING (wqi_class)
""")
def class_distribution(spark, sf_dir):
    return P.class_distribution(scored_observations(spark, sf_dir))


def _crosstab_sql(row_expr, row_name, src="scored"):
    return f"""cls(wqi_class, class_order) AS (SELECT * FROM (VALUES {_class_dim_values()})),
base AS (SELECT {row_expr} AS {row_name}, wqi_class FROM {src} WHERE wqi_class IS NOT NULL),
rows_ AS (SELECT {row_name}, count(*) AS t FROM base WHERE {row_name} IS NOT NULL GROUP BY {row_name}),
cnt AS (SELECT {row_name}, wqi_class, count(*) AS n FROM base WHERE {row_name} IS NOT NULL GROUP BY {row_name}, wqi_class)
SELECT r.{row_name}, c.wqi_class, c.class_order, CAST(coalesce(n, 0) AS BIGINT) AS n,
       round(coalesce(n, 0) * {d(100.0)} / t, 6) AS pct
FROM rows_ r CROSS JOIN cls c LEFT JOIN cnt ON cnt.{row_name} = r.{row_name} AND cnt.wqi_class = c.wqi_class"""


@register("state_class_crosstab", ("AGG-14",), oracle=f"""
WITH {scored_cte()}, {_crosstab_sql('state', 'state')}
""")
def state_class_crosstab(spark, sf_dir):
    return P.crosstab_percent(scored_observations(spark, sf_dir), "state")


@register("year_class_crosstab", ("AGG-15",), oracle=f"""
WITH {scored_cte()}, {_crosstab_sql('CAST(year(sampled_at) AS INTEGER)', 'year')}
""")
def year_class_crosstab(spark, sf_dir):
    s = scored_observations(spark, sf_dir).withColumn("year", F.year("sampled_at"))
    return P.crosstab_percent(s, "year", only_present=True)


@register("state_overview", ("AGG-16",), oracle=f"""
WITH {scored_cte()}
SELECT state, CASE WHEN grouping(state) = 1 THEN 'all' ELSE 'state' END AS scope, count(*) AS observations,
       count(DISTINCT station) AS stations FROM scored GROUP BY ROLLUP (state)
""")
def state_overview(spark, sf_dir):
    return P.state_overview(scored_observations(spark, sf_dir))


def _pairs():
    return [(a, b) for i, a in enumerate(FEATURES) for b in FEATURES[i + 1:]]


_PEARSON_SQL = " UNION ALL ".join(
    [f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 6) AS r FROM prof" for a, b in _pairs()]
    + [f"SELECT '{b}' AS feature_a, '{a}' AS feature_b, round(corr({a}, {b}), 6) AS r FROM prof" for a, b in _pairs()]
    + [f"SELECT '{a}' AS feature_a, '{a}' AS feature_b, {d(1.0)} AS r" for a in FEATURES])


@register("pearson_matrix", ("AGG-17",), oracle=f"""
WITH {PROF_CTE}
{_PEARSON_SQL}
""")
def pearson_matrix(spark, sf_dir):
    return P.pearson_matrix(profiled(spark, sf_dir), FEATURES)


def _spearman_pair(a, b):
    return (f"(SELECT corr(ra, rb) FROM (SELECT "
            f"(rank() OVER (ORDER BY {a}) + (count(*) OVER (PARTITION BY {a}) - 1) / {d(2.0)}) AS ra, "
            f"(rank() OVER (ORDER BY {b}) + (count(*) OVER (PARTITION BY {b}) - 1) / {d(2.0)}) AS rb "
            f"FROM prof WHERE {a} IS NOT NULL AND {b} IS NOT NULL))")


_SPEARMAN_SQL = " UNION ALL ".join(
    [f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round({_spearman_pair(a, b)}, 6) AS rho" for a, b in _pairs()]
    + [f"SELECT '{b}' AS feature_a, '{a}' AS feature_b, round({_spearman_pair(a, b)}, 6) AS rho" for a, b in _pairs()]
    + [f"SELECT '{a}' AS feature_a, '{a}' AS feature_b, {d(1.0)} AS rho" for a in FEATURES])


@register("spearman_matrix", ("AGG-18",), oracle=f"""
WITH {PROF_CTE}
{_SPEARMAN_SQL}
""")
def spearman_matrix(spark, sf_dir):
    return P.spearman_matrix(profiled(spark, sf_dir), FEATURES)


@register("redundant_feature_pairs", ("AGG-19",), oracle=f"""
WITH {PROF_CTE}, m AS ({_PEARSON_SQL})
SELECT feature_a, feature_b, r AS correlation, abs(r) AS abs_correlation FROM m
WHERE feature_a < feature_b AND abs(r) > {d(0.85)}
""")
def redundant_feature_pairs(spark, sf_dir):
    return P.redundant_pairs(P.pearson_matrix(profiled(spark, sf_dir), FEATURES), 0.85)


@register("five_number_by_class", ("AGG-20",), oracle=f"""
WITH {PROF_CTE}, long AS ({long_sql('prof', RAW, ('wqi_class',), 'wqi_class IS NOT NULL')})
SELECT wqi_class, feature, round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 6) AS q25,
       round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.75), 6) AS q75,
       round(max(value), 6) AS max
FROM long WHERE value IS NOT NULL GROUP BY wqi_class, feature
""")
def five_number_by_class(spark, sf_dir):
    return P.five_number_by_class(scored_observations(spark, sf_dir), RAW)


def _hist_sql(bins, single):
    nb = f"CASE WHEN hi = lo THEN {1 if single else bins} ELSE {bins} END"
    return f"""{PROF_CTE}, long AS ({long_sql('prof', RAW)}),
v AS (SELECT feature, value FROM long WHERE value IS NOT NULL AND NOT isnan(value)),
rng0 AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM v GROUP BY feature),
rng AS (SELECT feature, lo, {nb} AS nbins, (hi - lo) / ({nb}) AS width FROM rng0),
cnt AS (SELECT v.feature, CASE WHEN width > 0 THEN least(nbins - 1, CAST(floor((value - lo) / width) AS INTEGER)) ELSE 0 END AS bin,
               count(*) AS n FROM v JOIN rng ON v.feature = rng.feature GROUP BY ALL),
allb AS (SELECT feature, lo, width, CAST(unnest(range(0, nbins)) AS INTEGER) AS bin FROM rng)
SELECT a.feature, a.bin, round(lo + a.bin * width, 6) AS bin_start, round(lo + (a.bin + 1) * width, 6) AS bin_end,
       CAST(coalesce(n, 0) AS BIGINT) AS n
FROM allb a LEFT JOIN cnt c ON a.feature = c.feature AND a.bin = c.bin"""


@register("histogram_30_bins", ("AGG-21",), oracle=f"WITH {_hist_sql(30, False)}")
def histogram_30_bins(spark, sf_dir):
    return P.histogram(profiled(spark, sf_dir), RAW, 30, False)


@register("histogram_7_bins", ("AGG-22",), oracle=f"WITH {_hist_sql(7, True)}")
def histogram_7_bins(spark, sf_dir):
    return P.histogram(profiled(spark, sf_dir), RAW, 7, True)


@register("distribution_summary", ("AGG-23",), oracle=f"""
WITH {PROF_CTE}, long AS ({long_sql('prof', RAW)})
SELECT feature, round(min(value), 6) AS min, round(max(value), 6) AS max,
       round(quantile_cont(value, 0.5), 6) AS median, count(*) FILTER (WHERE value IS NULL) AS missing
FROM long GROUP BY feature
""")
def distribution_summary(spark, sf_dir):
    return P.distribution_summary(scored_observations(spark, sf_dir), RAW)
