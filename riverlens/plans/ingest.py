"""Feed join, key audit, accounting and missingness queries (JOIN-1..3, AGG-1..3, AGG-28)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riverlens.operators import ingest as I
from riverlens.operators import labelling as L
from riverlens.plans.oracle import EXTRAS, MEASUREMENTS, OBS_ID, obs_cte, scored_cte
from riverlens.plans.registry import register
from riverlens.sources.feeds import driver_feeds
from riverlens.sources.tables import observations

_BASE = ("base AS (SELECT * FROM lineitem JOIN supplier ON l_suppkey = s_suppkey "
         "JOIN nation ON s_nationkey = n_nationkey)")


def _feed_sql(name, where, fmt, cols):
    sel = ", ".join(f"{v} AS {k}" for k, v in cols.items())
    w = f"WHERE {where}" if where else ""
    return (f"{name} AS (SELECT n_name AS state, s_name AS station, {OBS_ID} AS event_key, "
            f"s_suppkey AS station_code, strftime(l_shipdate, '{fmt}') AS acquired_text, {sel} "
            f"FROM base {w})")


FEEDS_SQL = ", ".join([
    _BASE,
    _feed_sql("bio", "l_linenumber <= 6", "%d/%m/%Y %H:%M",
              {k: MEASUREMENTS[k] for k in ("bod_mgl", "do_mgl", "fc")}),
    _feed_sql("chem", None, "%d-%m-%Y %H:%M",
              {"ph": MEASUREMENTS["ph"], "ec": EXTRAS["ec"], "nitrate_n": EXTRAS["nitrate_n"]}),
    _feed_sql("phys", "l_linenumber <= 3", "%d-%m-%Y %H:%M",
              {"temperature": EXTRAS["temperature"], "turbidity": EXTRAS["turbidity"]}),
])

_PARSE = ("coalesce(try_strptime(trim(acquired_text), '%d-%m-%Y %H:%M'), "
          "try_strptime(trim(acquired_text), '%d/%m/%Y %H:%M'), "
          "try_strptime(trim(acquired_text), '%d-%m-%Y'), try_strptime(trim(acquired_text), '%d/%m/%Y'))")

JOINED_SQL = f"""{FEEDS_SQL},
joined0 AS (
  SELECT b.state, b.station, b.event_key, b.station_code, b.acquired_text, b.bod_mgl, b.do_mgl, b.fc,
         c.ph, c.ec, c.nitrate_n, p.temperature, p.turbidity,
         coalesce(p.event_key IS NOT NULL, false) AS has_physical_record
  FROM bio b JOIN chem c ON b.state = c.state AND b.station = c.station AND b.event_key = c.event_key
  LEFT JOIN phys p ON b.state = p.state AND b.station = p.station AND b.event_key = p.event_key),
joined AS (SELECT *, {_PARSE} AS sampled_at FROM joined0)"""

_JOINED_COLS = ("state", "station", "event_key", "station_code", "acquired_text", "bod_mgl", "do_mgl",
                "fc", "ph", "ec", "nitrate_n", "temperature", "turbidity", "has_physical_record")


def joined_table(spark, sf_dir):
    return I.join_feeds(driver_feeds(spark, sf_dir))


@register("feed_join", ("JOIN-1", "JOIN-2", "PRJ-4", "PRJ-5", "SCL-1"), oracle=f"""
WITH {JOINED_SQL}
SELECT {', '.join(_JOINED_COLS)}, CAST(year(sampled_at) AS INTEGER) AS year,
       CAST(month(sampled_at) AS INTEGER) AS month, CAST(day(sampled_at) AS INTEGER) AS day,
       strftime(sampled_at, '%Y-%m-%d') AS date
FROM joined
""")
def feed_join(spark, sf_dir):
    j = joined_table(spark, sf_dir)
    return j.select(*_JOINED_COLS, "year", "month", "day", "date")


def _audit_sql(feed):
    return (f"SELECT '{feed}' AS feed, CAST(sum(c) AS BIGINT) AS rows, count(*) AS distinct_keys, "
            f"count(*) FILTER (WHERE c > 1) AS duplicate_keys, "
            f"CAST(coalesce(sum(CASE WHEN c > 1 THEN c END), 0) AS BIGINT) AS rows_in_duplicates "
            f"FROM (SELECT state, station, event_key, count(*) AS c FROM {feed} "
            f"GROUP BY state, station, event_key)")


@register("feed_key_audit", ("JOIN-3",), oracle=f"""
WITH {FEEDS_SQL}, biological AS (SELECT * FROM bio), chemical AS (SELECT * FROM chem),
physical AS (SELECT * FROM phys)
{_audit_sql('biological')} UNION ALL {_audit_sql('chemical')} UNION ALL {_audit_sql('physical')}
""")
def feed_key_audit(spark, sf_dir):
    return I.key_audit(driver_feeds(spark, sf_dir))


@register("join_accounting", ("AGG-1", "AGG-2"), oracle=f"""
WITH {JOINED_SQL},
fb AS (SELECT state, grouping(state) AS g, count(*) AS n FROM bio GROUP BY ROLLUP (state)),
fc AS (SELECT state, grouping(state) AS g, count(*) AS n FROM chem GROUP BY ROLLUP (state)),
fp AS (SELECT state, grouping(state) AS g, count(*) AS n FROM phys GROUP BY ROLLUP (state)),
j AS (SELECT state, grouping(state) AS g, count(*) AS final_rows,
             count(*) FILTER (WHERE has_physical_record) AS physical_matches,
             count(*) FILTER (WHERE NOT has_physical_record) AS physical_unmatched,
             count(DISTINCT station) AS stations, count(DISTINCT sampled_at) AS timestamps
      FROM joined GROUP BY ROLLUP (state)),
s AS (SELECT state, g FROM fb UNION SELECT state, g FROM fc UNION SELECT state, g FROM fp UNION SELECT state, g FROM j)
SELECT s.state, CAST(coalesce(fb.n, 0) AS BIGINT) AS biological_rows,
       CAST(coalesce(fc.n, 0) AS BIGINT) AS chemical_rows, CAST(coalesce(fp.n, 0) AS BIGINT) AS physical_rows,
       CAST(coalesce(j.final_rows, 0) AS BIGINT) AS final_rows,
       CAST(coalesce(j.physical_matches, 0) AS BIGINT) AS physical_matches,
       CAST(coalesce(j.physical_unmatched, 0) AS BIGINT) AS physical_unmatched,
       CAST(coalesce(j.stations, 0) AS BIGINT) AS stations,
       CAST(coalesce(j.timestamps, 0) AS BIGINT) AS timestamps,
       CASE WHEN s.g = 1 THEN 'all' ELSE 'state' END AS scope
FROM s LEFT JOIN fb ON s.state IS NOT DISTINCT FROM fb.state AND s.g = fb.g
LEFT JOIN fc ON s.state IS NOT DISTINCT FROM fc.state AND s.g = fc.g
LEFT JOIN fp ON s.state IS NOT DISTINCT FROM fp.state AND s.g = fp.g
LEFT JOIN j ON s.state IS NOT DISTINCT FROM j.state AND s.g = j.g
""")
def join_accounting(spark, sf_dir):
    feeds = driver_feeds(spark, sf_dir)
    return I.state_accounting(feeds, I.join_feeds(feeds))


_MISSING_COLS = ("bod_mgl", "do_mgl", "fc", "ph", "ec", "nitrate_n", "temperature", "turbidity")


def _missing_sql(src, cols, keys=()):
    k = ", ".join(keys)
    kp = f"{k}, " if keys else ""
    parts = []
    for i, c in enumerate(cols):
        parts.append(
            f"SELECT {kp}'{c}' AS column_name, {i} AS column_order, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) "
            f"AS missing, CAST(count(*) AS BIGINT) AS rows FROM {src}" + (f" GROUP BY {k}" if keys else ""))
    return (f"SELECT {kp}column_name, CAST(column_order AS INTEGER) AS column_order, missing, rows, "
            f"round(CASE WHEN rows > 0 THEN missing * CAST('100.0' AS DOUBLE) / rows ELSE 0 END, 6) "
            f"AS missing_pct FROM ({' UNION ALL '.join(parts)})")


@register("missing_by_column", ("AGG-3",), oracle=f"""
WITH {JOINED_SQL}
{_missing_sql('joined', _MISSING_COLS)}
""")
def missing_by_column(spark, sf_dir):
    return I.missing_percentages(joined_table(spark, sf_dir), _MISSING_COLS)


@register("missing_by_state", ("AGG-28",), oracle=f"""
WITH {obs_cte()}
{_missing_sql('obs', ('ph', 'do_mgl', 'bod_mgl', 'fc'), ('state',))}
""")
def missing_by_state(spark, sf_dir):
    return I.missing_percentages(observations(spark, sf_dir), ("ph", "do_mgl", "bod_mgl", "fc"), ("state",))


@register("missing_by_class", ("AGG-28",), oracle=f"""
WITH {scored_cte()}
{_missing_sql('scored', ('ph', 'do_mgl', 'bod_mgl', 'fc'), ('wqi_class',))}
""")
def missing_by_class(spark, sf_dir):
    return I.missing_percentages(L.score(observations(spark, sf_dir)), ("ph", "do_mgl", "bod_mgl", "fc"), ("wqi_class",))
