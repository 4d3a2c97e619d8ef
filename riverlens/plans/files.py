"""Queries over files and versions written by the job itself (SRC-2, SRC-3, SNK-7, JOIN-3, VAL-1, RUL-8, AGG-30, FEA-6, SCL-5/9)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from riverlens.functions import dims
from riverlens.operators import ingest as I
from riverlens.operators import rules as RU
from riverlens.operators import scoring as SC
from riverlens.operators import split as S
from riverlens.operators.models import one_hot
from riverlens.plans.ingest import JOINED_SQL, _audit_sql
from riverlens.plans.labelling import scored_observations
from riverlens.plans.oracle import EXTRAS, d, obs_cte, scored_cte
from riverlens.plans.registry import register
from riverlens.plans.rules import OBS_PROF, OBS_RULE_COLS, _actions_values, _elevated_sql, obs_with_findings
from riverlens.session import ensure_checkpoint_dir, written
from riverlens.sources import feeds as FD
from riverlens.sources import sinks as SK
from riverlens.sources.feeds import driver_feeds
from riverlens.sources.tables import extra_measurements, observations, read_table


def scratch(spark, name):
    """A fresh folder below the shared one."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/riverlens-{name}-{uuid.uuid4().hex}"


# ---- SRC-2: a text feed with lines of every kind

def _feed_text(spark, sf_dir):
    """One line per lineitem; by residue of the order key it lacks a cell, has one too many, an open quote, or a quoted comma."""
    li = read_table(spark, sf_dir, "lineitem")
    r = F.col("l_orderkey") % 40
    cells = [F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.col("l_quantity").cast("double").cast("string")]
    note = F.when(r == 11, '"open').when(r == 13, '"a, ""b"""').otherwise("plain")
    line = F.when(r == 3, F.concat_ws(",", *cells)).otherwise(F.concat_ws(",", *cells, note, F.when(r == 7, F.lit("extra"))))
    return li.select(line.alias("value"))


_KIND = "CASE l_orderkey % 40 WHEN 3 THEN 'short' WHEN 7 THEN 'long' WHEN 11 THEN 'quote' ELSE 'good' END"


@register("feed_line_audit", ("SRC-2",), oracle=f"""
WITH k(line_kind) AS (VALUES ('good'), ('short'), ('long'), ('quote'))
SELECT line_kind, count(l_orderkey) AS n, CAST(coalesce(sum(CASE WHEN line_kind IN ('good', 'short') THEN l_quantity END), 0) AS DOUBLE) AS quantity,
       count(CASE WHEN l_orderkey % 40 = 13 THEN 1 END) AS quoted
FROM k LEFT JOIN lineitem ON {_KIND} = line_kind GROUP BY line_kind
""")
def feed_line_audit(spark, sf_dir):
    """Lines of a written text feed by kind, and what the kept rows add up to."""
    path = scratch(spark, "feed")
    _feed_text(spark, sf_dir).write.text(path)
    lines = FD.read_feed_lines(spark, path, ("order_key", "line_number", "quantity", "note"))
    kept = FD.coerced(lines.drop("line", "file"), ("quantity",)).where("line_kind is null or line_kind = 'short'")
    sums = kept.groupBy(F.coalesce("line_kind", F.lit("good")).alias("line_kind")).agg(
        F.sum("quantity").alias("quantity"), F.count_if(F.col("note") == 'a, "b"').alias("quoted"))
    return FD.line_audit(lines).join(sums, "line_kind", "left").select(
        "line_kind", "n", F.coalesce("quantity", F.lit(0.0)).alias("quantity"), F.coalesce("quoted", F.lit(0)).cast("long").alias("quoted"))


@register("quarantined_lines", ("SRC-2", "SNK-2"), oracle="""
SELECT CASE l_orderkey % 40 WHEN 3 THEN 'short' WHEN 7 THEN 'long' ELSE 'quote' END AS line_kind,
       l_orderkey || ',' || l_linenumber || ',' || CAST(l_quantity AS DOUBLE) || CASE l_orderkey % 40 WHEN 3 THEN ''
       WHEN 7 THEN ',plain,extra' ELSE ',"open' END AS line
FROM lineitem WHERE l_orderkey % 40 IN (3, 7, 11)
""")
def quarantined_lines(spark, sf_dir):
    """The bad lines of the feed as they stand in its files, read back from the quarantine."""
    path, bad = scratch(spark, "feed"), scratch(spark, "quarantine")
    _feed_text(spark, sf_dir).write.text(path)
    FD.read_feed_csv(spark, path, ("quantity",), ("order_key", "line_number", "quantity", "note"), quarantine=bad)
    return spark.read.parquet(bad).select("line_kind", "line")


# ---- SRC-3 / VAL-1

@register("loaded_contract_audit", ("SRC-3", "VAL-1", "SNK-2"), oracle=f"""
WITH {scored_cte()}
SELECT count(*) AS rows, {', '.join(f'count(*) FILTER (WHERE {c} IS NULL) AS missing_{c}' for c in dims.MODEL_FEATURES)},
       CAST(0 AS BIGINT) AS duplicate_rows FROM scored WHERE wqi_class IS NOT NULL
""")
def loaded_contract_audit(spark, sf_dir):
    """The labelled table written, found again through a configuration, and audited."""
    base = scratch(spark, "labelled")
    SK.write_labelled(scored_observations(spark, sf_dir), f"{base}/out")
    df = FD.load_labelled(spark, config={"dataset_path": "out/labelled"}, base=base, validate=False)
    return SK.validate_schema(df)


# ---- SNK-7 / JOIN-3

@register("published_comparison", ("SNK-7", "SET-2"), oracle=f"""
WITH {obs_cte()},
one AS (SELECT state AS model, round(avg(ph), 6) AS score FROM obs GROUP BY ALL),
two AS (SELECT state || ' (Tuned)' AS model, round(avg(ph) + 1, 6) AS score FROM obs GROUP BY ALL)
SELECT model, score FROM one UNION ALL SELECT model, score FROM two
""")
def published_comparison(spark, sf_dir):
    """A comparison table updated twice by swaps: the second tuned rows replace the first, the oldest version is pruned."""
    obs, base = observations(spark, sf_dir), scratch(spark, "comparison")
    per = written(obs.groupBy("state").agg(F.avg("ph").alias("m")), "state-means")
    table = lambda suffix, add: per.select(F.concat("state", F.lit(suffix)).alias("model"), F.round(F.col("m") + add, 6).alias("score"))
    SK.publish(spark, base, SK.new_version(table("", 0.0), base))
    SK.replace_comparison(spark, base, table(" (Tuned)", 5.0))
    SK.replace_comparison(spark, base, table(" (Tuned)", 1.0))
    SK.new_version(table(" (Tuned)", 9.0), base)        # written, never published: nobody sees it
    SK.prune(spark, base, keep=2)
    return SK.read_current(spark, base)


@register("audited_feed_join", ("JOIN-3", "JOIN-1", "SNK-7"), oracle=f"""
WITH {JOINED_SQL}, biological AS (SELECT * FROM bio), chemical AS (SELECT * FROM chem), physical AS (SELECT * FROM phys)
{_audit_sql('biological')} UNION ALL {_audit_sql('chemical')} UNION ALL {_audit_sql('physical')}
UNION ALL SELECT 'joined', count(*), count(*), 0, 0 FROM joined
""")
def audited_feed_join(spark, sf_dir):
    """The three-feed join published with the key audit that was taken while it ran."""
    _, audit = I.audited_join(driver_feeds(spark, sf_dir), scratch(spark, "joined"))
    return audit


# ---- RUL-8

_TEXTS = f"txt(parameter, kind, pos, t) AS (SELECT * FROM (VALUES {_actions_values()}))"
_PHRASES = ", ".join(f"('{p}', '{p.replace(' ', '[[:space:]]+')}')" for p in RU.CAUSAL_PHRASES)


@register("wording_scan", ("RUL-8",), oracle=f"""
WITH {OBS_PROF}, {_elevated_sql('op', OBS_RULE_COLS, ('obs_id',))}, {_TEXTS}, ph(phrase, re) AS (VALUES {_PHRASES}),
acts AS (SELECT DISTINCT obs_id, parameter, priority, t FROM fnd JOIN txt USING (parameter, kind)),
every AS (SELECT 'rule texts' AS source, t FROM txt UNION ALL SELECT 'recommendations', t FROM acts
          UNION ALL SELECT 'part names', p_name || ' caused  by ' || p_brand || CASE WHEN p_partkey % 3 = 0 THEN ', the Culprit' ELSE ', culprits' END FROM part)
SELECT source, phrase, count(*) AS texts, count(*) FILTER (WHERE regexp_matches(lower(t), '(^|[^a-z0-9])' || re || '([^a-z0-9]|$)')) AS hits
FROM every, ph GROUP BY ALL
""")
def wording_scan(spark, sf_dir):
    """Causal phrases in the rule table, in all recommendations given out, and in texts planted with some."""
    rules = spark.createDataFrame(RU.rule_texts(), "parameter string, kind string, t string")
    given = RU.action_items(obs_with_findings(spark, sf_dir))
    planted = read_table(spark, sf_dir, "part").select(F.concat(
        "p_name", F.lit(" caused  by "), "p_brand", F.when(F.col("p_partkey") % 3 == 0, ", the Culprit").otherwise(", culprits")).alias("t"))
    return (RU.causal_wording(rules, "t", "rule texts").unionByName(RU.causal_wording(given, "recommendation", "recommendations"))
            .unionByName(RU.causal_wording(planted, "t", "part names")))


# ---- AGG-30

_OPEN = ("ec", "nitrate_n", "temperature", "turbidity")
_DEPLETION = ("temperature",)


def _limit_sql(c):
    p, side, mark = (0.1, "below", "<") if c in _DEPLETION else (0.9, "above", ">")
    return (f"SELECT obs_id, '{c}' AS feature, {c} AS value, lim AS \"limit\", "
            f"'{S.FALLBACK.format('P10' if c in _DEPLETION else 'P90')}' AS standard_type "
            f"FROM x, (SELECT quantile_cont({c}, {p}) AS lim FROM x WHERE train) WHERE {c} {mark} lim")


_X = (f"x AS (SELECT l_orderkey || '-' || l_linenumber AS obs_id, l_orderkey % 5 <> 0 AS train, "
      f"{', '.join(f'{EXTRAS[c]} AS {c}' for c in _OPEN)} FROM lineitem)")


@register("fallback_findings", ("AGG-30",), oracle=f"""
WITH {_X}, f AS ({' UNION ALL '.join(_limit_sql(c) for c in _OPEN[1:])})
SELECT feature, standard_type, round(any_value("limit"), 6) AS "limit", count(*) AS n, round(sum(value), 3) AS total FROM f GROUP BY ALL
""")
def fallback_findings(spark, sf_dir):
    """Empirical limits of the parameters without a standard (conductivity has one), and what lies beyond them."""
    x = extra_measurements()
    rows = read_table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("obs_id"), (F.col("l_orderkey") % 5 != 0).alias("train"),
        *[x[c].alias(c) for c in _OPEN])
    limits = written(S.fallback_limits(rows.where("train"), _OPEN, standards=("ec",), depletion=_DEPLETION), "fallback-limits")
    found = S.beyond_fallback(rows, limits, _OPEN)
    return found.groupBy("feature", "standard_type").agg(F.round(F.any_value("limit"), 6).alias("limit"), F.count("*").alias("n"),
                                                        F.round(F.sum("value"), 3).alias("total"))


# ---- FEA-6

@register("one_hot_states", ("FEA-6",), oracle=f"""
WITH {obs_cte()}, n AS (SELECT state, count(*) AS n FROM obs GROUP BY state),
i AS (SELECT state, row_number() OVER (ORDER BY n DESC, state) - 1 AS slot FROM n WHERE state < 'R')
SELECT obs.state, CAST(i.slot AS INTEGER) AS slot, count(*) AS n FROM obs LEFT JOIN i USING (state) GROUP BY ALL
""")
def one_hot_states(spark, sf_dir):
    """The hot slot of each state for an encoder fitted on the states before R; the others have none."""
    obs = observations(spark, sf_dir).select("state")
    model = one_hot(obs.where(F.col("state") < "R"), ["state"])
    from pyspark.ml.functions import vector_to_array
    slot = F.array_position(vector_to_array("state_vec"), F.lit(1.0)).cast("int") - 1
    hot = model.transform(obs).select("state", F.when(slot >= 0, slot).alias("slot"))
    return hot.groupBy("state", "slot").agg(F.count("*").alias("n"))


# ---- SCL-5 / SCL-9: the condition texts read back from the documents

_TWO = "CAST(CAST(round(CAST({} AS DECIMAL(38, 12)), 2) AS DECIMAL(38, 2)) AS VARCHAR)"


@register("summary_conditions", ("RUL-4", "SCL-5", "SCL-9"), oracle=f"""
WITH {OBS_PROF}, {_elevated_sql('op', OBS_RULE_COLS, ('obs_id',))}
SELECT obs_id, wqi_class AS label, parameter, priority,
       parameter || CASE kind WHEN 'low' THEN ' below ' ELSE ' above ' END || {_TWO.format('value')} || ' (limit ' || {_TWO.format('limit_value')} || ')' AS condition
FROM fnd
""")
def summary_conditions(spark, sf_dir):
    """What the JSON documents say about each finding."""
    docs = SC.decision_summary_json(obs_with_findings(spark, sf_dir))
    schema = "label string, findings array<struct<parameter:string,priority:string,condition:string>>"
    doc = docs.select("obs_id", F.from_json("document", schema).alias("d"))
    return doc.select("obs_id", F.col("d.label").alias("label"), F.inline("d.findings")).select(
        "obs_id", "label", "parameter", "priority", "condition")
