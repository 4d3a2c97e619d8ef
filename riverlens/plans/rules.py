"""Rule engine queries (RUL-1..4, RUL-7, RUL-9, JOIN-8, SET-4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riverlens.functions import dims
from riverlens.functions.scalars import log10_floor1
from riverlens.operators import labelling as L
from riverlens.operators import rules as RU
from riverlens.plans.ingest import JOINED_SQL, joined_table
from riverlens.plans.labelling import scored_observations
from riverlens.plans.oracle import class_sql, d, index_ctes, scored_cte
from riverlens.plans.registry import register
from riverlens.sources.feeds import thresholds_frame

OBS_RULE_COLS = ("ph", "do_mgl", "bod_mgl", "fc", "log10_fc")
FEED_RULE_COLS = ("ph", "do_mgl", "bod_mgl", "fc", "log10_fc", "ec", "nitrate_n", "temperature", "turbidity")
FEED_KEYS = ("state", "station", "event_key")
POOR = ", ".join(f"'{c}'" for c in dims.POOR_CLASSES)


def obs_with_findings(spark, sf_dir):
    s = scored_observations(spark, sf_dir).withColumn("log10_fc", log10_floor1(F.col("fc")))
    return RU.with_findings(s, OBS_RULE_COLS)


def feed_with_findings(spark, sf_dir):
    j = L.score(joined_table(spark, sf_dir)).withColumn("log10_fc", log10_floor1(F.col("fc")))
    return RU.with_findings(j, FEED_RULE_COLS)


def _raw_findings_sql(src, cols, keys):
    rows = RU._rule_rows(dims.RULES, cols)
    k = ", ".join(keys)
    parts = []
    for i, r in enumerate(rows):
        c, lim, crit = r["column"], float(r["limit"]), r["critical"]
        if r["direction"] == "below":
            ab = f"{c} < {d(lim)}"
            cr = f"{c} < {d(crit)}" if crit is not None else "false"
        else:
            ab = f"{c} > {d(lim)}"
            cr = f"{c} > {d(crit if crit is not None else 2 * lim)}"
        parts.append(
            f"SELECT {k}, wqi_class, {i} AS rule_order, '{r['parameter']}' AS parameter, '{r['kind']}' AS kind, "
            f"{c} AS value, {d(lim)} AS limit_value, coalesce({cr}, false) AS is_critical, "
            f"CASE WHEN {cr} THEN '{r['critical_priority']}' ELSE '{r['base_priority']}' END AS base "
            f"FROM {src} WHERE {c} IS NOT NULL AND {ab}")
    return " UNION ALL ".join(parts)


def _elevated_sql(src, cols, keys):
    k = ", ".join(keys)
    return (f"raw AS ({_raw_findings_sql(src, cols, keys)}), "
            f"el AS (SELECT *, count(*) OVER (PARTITION BY {k}) AS n_abnormal FROM raw), "
            f"fnd AS (SELECT *, CASE WHEN n_abnormal >= 2 THEN 'High' "
            f"WHEN coalesce(wqi_class IN ({POOR}), false) AND base = 'Medium' THEN 'High' ELSE base END AS priority FROM el)")


_FEED_IDX, _ = index_ctes("joined", ('ph', 'do_mgl', 'bod_mgl', 'ec', 'turbidity', 'fc', 'nitrate_n'), "fs0")
_FEED_SCORED = (f"{JOINED_SQL}, {_FEED_IDX}, "
                f"fs AS (SELECT *, {class_sql('wqi_score')} AS wqi_class, CASE WHEN fc IS NOT NULL THEN "
                f"log10(greatest(fc, {d(1.0)})) END AS log10_fc FROM fs0)")


@register("rule_findings", ("RUL-1", "RUL-2"), oracle=f"""
WITH {_FEED_SCORED}, {_elevated_sql('fs', FEED_RULE_COLS, FEED_KEYS)}
SELECT state, station, event_key, parameter, kind, round(value, 6) AS value, round(limit_value, 6) AS limit_value,
       is_critical, priority, CAST(n_abnormal AS INTEGER) AS n_abnormal FROM fnd
""")
def rule_findings(spark, sf_dir):
    f = RU.findings_long(feed_with_findings(spark, sf_dir), FEED_KEYS)
    return f.select(*FEED_KEYS, "parameter", "kind", F.round("value", 6).alias("value"),
                    F.round("limit", 6).alias("limit_value"), "is_critical", "priority", "n_abnormal")


OBS_PROF = (f"{scored_cte()}, op AS (SELECT *, CASE WHEN fc IS NOT NULL THEN log10(greatest(fc, {d(1.0)})) "
            f"END AS log10_fc FROM scored)")


@register("overall_priority", ("RUL-3", "RUL-4"), oracle=f"""
WITH {OBS_PROF}, {_elevated_sql('op', OBS_RULE_COLS, ('obs_id',))},
per AS (SELECT obs_id, count(*) AS n, bool_or(priority = 'High') AS any_high,
               bool_or(priority = 'Medium') AS any_medium FROM fnd GROUP BY obs_id)
SELECT op.obs_id, op.wqi_class, {len(OBS_RULE_COLS)} AS n_evaluated, CAST(coalesce(n, 0) AS INTEGER) AS n_abnormal,
  CASE WHEN coalesce(n, 0) = 0 THEN 'None' WHEN any_high THEN 'High' WHEN n >= 2 THEN 'High'
       WHEN coalesce(op.wqi_class IN ({POOR}), false) THEN 'High' WHEN any_medium THEN 'Medium' ELSE 'Low' END
  AS overall_priority
FROM op LEFT JOIN per USING (obs_id)
""")
def overall_priority(spark, sf_dir):
    return obs_with_findings(spark, sf_dir).select("obs_id", "wqi_class", "n_evaluated", "n_abnormal",
                                                   "overall_priority")


@register("findings_fleet_summary", ("RUL-9",), oracle=f"""
WITH {OBS_PROF}, {_elevated_sql('op', OBS_RULE_COLS, ('obs_id',))}
SELECT op.state, strftime(op.sampled_at, '%Y-%m') AS month, priority, count(*) AS findings,
       count(DISTINCT fnd.obs_id) AS observations
FROM fnd JOIN op USING (obs_id) GROUP BY ALL
""")
def findings_fleet_summary(spark, sf_dir):
    w = obs_with_findings(spark, sf_dir).withColumn("month", F.date_format("sampled_at", "yyyy-MM"))
    return RU.fleet_summary(RU.findings_long(w, ("obs_id", "state", "month")))


def _actions_values():
    rows = []
    for r in dims.RULES:
        for j, t in enumerate(RU.ACTIONS.get((r[0], r[2]), ("Review the measurement and resample",))):
            rows.append(f"('{r[0]}', '{r[2]}', {j}, '{t}')")
    return ", ".join(rows)


@register("decision_actions", ("SET-4", "RUL-5"), oracle=f"""
WITH {OBS_PROF}, {_elevated_sql('op', OBS_RULE_COLS, ('obs_id',))},
txt(parameter, kind, pos, recommendation) AS (SELECT * FROM (VALUES {_actions_values()})),
a AS (SELECT obs_id, fnd.parameter, priority, recommendation, rule_order, pos FROM fnd JOIN txt USING (parameter, kind)),
first_seen AS (SELECT obs_id, parameter, priority, recommendation, min(rule_order * 1000 + pos) AS o
               FROM a GROUP BY ALL)
SELECT obs_id, CAST(row_number() OVER (PARTITION BY obs_id ORDER BY o) AS INTEGER) AS action_rank,
       parameter, priority, recommendation FROM first_seen
""")
def decision_actions(spark, sf_dir):
    return RU.action_items(obs_with_findings(spark, sf_dir))


@register("unique_abnormal_parameters", ("RUL-7",), oracle=f"""
WITH {OBS_PROF}, {_elevated_sql('op', OBS_RULE_COLS, ('obs_id',))},
r AS (SELECT *, row_number() OVER (PARTITION BY obs_id, parameter ORDER BY rule_order DESC) AS rn FROM fnd)
SELECT obs_id, parameter, kind, priority FROM r WHERE rn = 1
""")
def unique_abnormal_parameters(spark, sf_dir):
    w = obs_with_findings(spark, sf_dir)
    return (w.select("obs_id", F.inline(RU.unique_by_parameter(F.col("findings"))))
             .select("obs_id", "parameter", "kind", "priority"))


@register("measurement_rule_join", ("JOIN-8", "SRC-4"), oracle=f"""
WITH {OBS_PROF}, raw AS ({_raw_findings_sql('op', OBS_RULE_COLS, ('obs_id',))})
SELECT obs_id, parameter, kind, round(value, 6) AS value, is_critical, base FROM raw
""")
def measurement_rule_join(spark, sf_dir):
    s = scored_observations(spark, sf_dir).withColumn("log10_fc", log10_floor1(F.col("fc")))
    f = RU.findings_by_join(s, thresholds_frame(spark), OBS_RULE_COLS)
    return f.select("obs_id", "parameter", "kind", F.round("value", 6).alias("value"), "is_critical", "base")
