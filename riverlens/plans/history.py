"""History, station and window queries (FLT-2/3, AGG-24..27, WIN-1..3, JOIN-4, SRT-1, SET-3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riverlens.functions import dims
from riverlens.operators import history as H
from riverlens.plans.labelling import scored_observations
from riverlens.plans.oracle import d, scored_cte
from riverlens.plans.registry import register

FEATURES = dims.MODEL_FEATURES

REC_CTE = (f"{scored_cte(with_coordinates=True)}, rec AS (SELECT obs_id, state, station, wqi_class AS category, "
           f"{', '.join(FEATURES)}, sampled_at, latitude, longitude, strftime(sampled_at, '%Y-%m-%d') AS date, "
           f"strftime(sampled_at, '%Y-%m') AS month FROM scored)")


def records(spark, sf_dir, with_ts=False):
    return H.history_records(scored_observations(spark, sf_dir), FEATURES, keep_ts=with_ts)


def _means_sql(src):
    return " UNION ALL ".join(
        f"SELECT month, '{f}' AS feature, round(avg({f}), 6) AS mean, count({f}) AS n FROM {src} "
        f"WHERE month IS NOT NULL GROUP BY month HAVING count({f}) > 0" for f in FEATURES)


@register("history_monthly_means", ("AGG-24", "PRJ-6"), oracle=f"""
WITH {REC_CTE}
{_means_sql('rec')}
""")
def history_monthly_means(spark, sf_dir):
    return H.monthly_means(records(spark, sf_dir), FEATURES)


HIST_FROM, HIST_TO = "1996-01-01", "1998-12-31"


@register("history_period_monthly_means", ("FLT-2", "AGG-24"), oracle=f"""
WITH {REC_CTE},
flag AS (SELECT bool_or(date IS NOT NULL) AS day_precision FROM rec),
f AS (SELECT rec.* FROM rec, flag
      WHERE (CASE WHEN coalesce(day_precision, false) THEN date ELSE month END) IS NOT NULL
        AND (CASE WHEN coalesce(day_precision, false) THEN date ELSE month END) >= '{HIST_FROM}'
        AND (CASE WHEN coalesce(day_precision, false) THEN date ELSE month END) <= '{HIST_TO}')
{_means_sql('f')}
""")
def history_period_monthly_means(spark, sf_dir):
    rec = records(spark, sf_dir, with_ts=True)
    return H.monthly_means(H.filter_history(rec, HIST_FROM, HIST_TO, ts_col="sampled_at"), FEATURES)


_CLS = ", ".join(f"('{c}', {i + 1})" for i, c in enumerate(dims.CLASS_ORDER))


@register("history_monthly_classes", ("AGG-25",), oracle=f"""
WITH {REC_CTE}, cls(wqi_class, class_order) AS (SELECT * FROM (VALUES {_CLS})),
m AS (SELECT month, count(*) AS t FROM rec WHERE month IS NOT NULL GROUP BY month),
c AS (SELECT month, category, count(*) AS n FROM rec WHERE month IS NOT NULL GROUP BY month, category)
SELECT m.month, cls.wqi_class, cls.class_order, CAST(coalesce(n, 0) AS BIGINT) AS n,
       round(coalesce(n, 0) / t, 6) AS share
FROM m CROSS JOIN cls LEFT JOIN c ON c.month = m.month AND c.category = cls.wqi_class
""")
def history_monthly_classes(spark, sf_dir):
    return H.monthly_classes(records(spark, sf_dir))


@register("history_coverage", ("AGG-26",), oracle=f"""
WITH {REC_CTE}
{' UNION ALL '.join(f"""SELECT '{f}' AS feature, count(*) AS observations, count(DISTINCT month) AS sampled_months,
       count(*) FILTER (WHERE {f} IS NULL) AS missing_values, min(month) AS first_period, max(month) AS last_period FROM rec"""
       for f in FEATURES)}
""")
def history_coverage(spark, sf_dir):
    return H.coverage(records(spark, sf_dir), FEATURES)


def _overview_sql():
    miss = " + ".join(f"(CASE WHEN {f} IS NULL THEN 1 ELSE 0 END)" for f in FEATURES)
    rows = [("records", "CAST(records AS DOUBLE)"), ("stations", "CAST(stations AS DOUBLE)"),
            ("parameters", d(float(len(FEATURES)))),
            ("missing_cell_pct", f"CASE WHEN records > 0 THEN missing_cells * {d(100.0)} / (records * {len(FEATURES)}) END")]
    for i, c in enumerate(dims.CLASS_ORDER):
        rows.append((f"count:{c}", f"CAST(c{i} AS DOUBLE)"))
        rows.append((f"share:{c}", f"CASE WHEN records > 0 THEN c{i} / records ELSE {d(0.0)} END"))
    cls = ", ".join(f"count(*) FILTER (WHERE category = '{c}') AS c{i}" for i, c in enumerate(dims.CLASS_ORDER))
    one = (f"one AS (SELECT count(*) AS records, count(DISTINCT (state, station)) AS stations, "
           f"sum({miss}) AS missing_cells, {cls} FROM rec)")
    sel = " UNION ALL ".join(f"SELECT '{m}' AS metric, round({e}, 6) AS value FROM one" for m, e in rows)
    return one, sel


_OV_ONE, _OV_SEL = _overview_sql()


@register("overview_metrics", ("AGG-27",), oracle=f"""
WITH {REC_CTE}, {_OV_ONE}
{_OV_SEL}
""")
def overview_metrics(spark, sf_dir):
    return H.overview_metrics(records(spark, sf_dir), FEATURES)


@register("station_coordinates", ("WIN-2", "JOIN-4", "SRT-1"), oracle=f"""
WITH {REC_CTE},
st AS (SELECT DISTINCT state, station FROM rec),
loc AS (SELECT state, station, arg_max(latitude, (sampled_at, obs_id)) AS latitude,
               arg_max(longitude, (sampled_at, obs_id)) AS longitude
        FROM rec WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 GROUP BY state, station)
SELECT st.state, st.station, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude
FROM st LEFT JOIN loc USING (state, station)
""")
def station_coordinates(spark, sf_dir):
    df = scored_observations(spark, sf_dir, with_coordinates=True)
    out = H.stations_with_coordinates(df)
    return out.select("state", "station", F.round("latitude", 6).alias("latitude"),
                      F.round("longitude", 6).alias("longitude"))


@register("latest_record_per_station", ("WIN-3",), oracle=f"""
WITH {REC_CTE},
ranked AS (SELECT *, row_number() OVER (PARTITION BY state, station
                                        ORDER BY coalesce(date, month, '') DESC, obs_id DESC) AS rn FROM rec)
SELECT state, station, obs_id, category, {', '.join(f'round({f}, 6) AS {f}' for f in FEATURES)}, date, month
FROM ranked WHERE rn = 1
""")
def latest_record_per_station(spark, sf_dir):
    out = H.latest_per_station(records(spark, sf_dir))
    return out.select("state", "station", "obs_id", "category",
                      *[F.round(f, 6).alias(f) for f in FEATURES], "date", "month")


def _in_bounds_sql():
    parts = []
    for c, (lo, hi) in dims.INPUT_BOUNDS.items():
        parts.append(f"({c} IS NOT NULL AND NOT isnan({c}) AND isfinite({c}) AND {c} BETWEEN {d(lo)} AND {d(hi)})")
    return " AND ".join(parts)


@register("first_valid_sample", ("FLT-3",), oracle=f"""
WITH {REC_CTE}
SELECT obs_id, state, station, {', '.join(f'round({c}, 6) AS {c}' for c in dims.INPUT_BOUNDS)}
FROM rec WHERE {_in_bounds_sql()} ORDER BY sampled_at, obs_id LIMIT 1
""")
def first_valid_sample(spark, sf_dir):
    out = H.first_valid_sample(scored_observations(spark, sf_dir))
    return out.select("obs_id", "state", "station", *[F.round(c, 6).alias(c) for c in dims.INPUT_BOUNDS])


@register("distinct_states", ("SET-3",), oracle=f"""
WITH {REC_CTE}
SELECT DISTINCT state FROM rec
""")
def distinct_states(spark, sf_dir):
    return H.distinct_values(records(spark, sf_dir), ["state"])


@register("dedupe_station_day", ("WIN-1",), oracle=f"""
WITH {REC_CTE},
ranked AS (SELECT *, row_number() OVER (PARTITION BY station, date ORDER BY obs_id) AS rn FROM rec)
SELECT station, date, obs_id, category FROM ranked WHERE rn = 1
""")
def dedupe_station_day(spark, sf_dir):
    rec = records(spark, sf_dir).select("station", "date", "obs_id", "category")
    return H.deduplicate(rec, ["station", "date"], keep="first")


@register("unique_station_day", ("WIN-1",), oracle=f"""
WITH {REC_CTE},
c AS (SELECT *, count(*) OVER (PARTITION BY station, date) AS k FROM rec)
SELECT station, date, obs_id, category FROM c WHERE k = 1
""")
def unique_station_day(spark, sf_dir):
    rec = records(spark, sf_dir).select("station", "date", "obs_id", "category")
    return H.deduplicate(rec, ["station", "date"], keep="none")
