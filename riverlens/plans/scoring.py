"""Submission scoring queries (VAL-5, SCO-5, SCO-6, SCO-9, WIN-7)."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from riverlens.functions import dims
from riverlens.functions.scalars import log10_floor1
from riverlens.operators import nearest as NN
from riverlens.operators import scoring as SC
from riverlens.operators import split as S
from riverlens.plans.labelling import scored_observations
from riverlens.plans.oracle import class_sql, d, index_ctes, scored_cte
from riverlens.plans.registry import register
from riverlens.plans.rules import OBS_PROF, _elevated_sql, obs_with_findings, OBS_RULE_COLS
from riverlens.plans.training import SPLIT_SQL, split_frame
from riverlens.session import written
from riverlens.sources.tables import submissions

FEATURES = dims.MODEL_FEATURES


# the oracle's own account of what each residue of the key does to a submission
SUBMISSIONS_SQL = f"""subs AS (
  SELECT c_custkey AS submission_id,
         CASE WHEN c_custkey % 17 = 0 OR c_custkey % 41 = 6 OR (c_custkey % 37 = 5 AND c_custkey % 19 <> 1) THEN 'missing'
              WHEN c_custkey % 23 = 2 THEN 'unexpected'
              WHEN c_custkey % 19 = 1 OR c_custkey % 29 = 3 OR c_custkey % 31 = 4 THEN 'outside' END AS gate_reason,
         {d(5.2)} + {d(0.07)} * (c_custkey % 50) AS ph, {d(1.0)} + {d(1.7)} * (c_custkey % 9) AS do_mgl,
         {d(0.9)} * (c_custkey % 11) AS bod_mgl, abs(c_acctbal) / {d(5.0)} AS fc FROM customer)"""


def gated_submissions(spark, sf_dir, dealt: bool = False):
    """The submissions after the gate; ``dealt`` out to all tasks before it, as few bytes of JSON are much work."""
    sent = submissions(spark, sf_dir)
    if dealt:       # written, as Spark would put the gate's filter before the exchange
        sent = written(sent.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))), "submissions")
    return SC.gate_payload(sent)


def accepted_submissions(spark, sf_dir, dealt: bool = False):
    """Accepted submissions as a table of raw measurements, without any label."""
    return gated_submissions(spark, sf_dir, dealt).where(F.col("gate_reason").isNull()).select("submission_id", *FEATURES)


@register("input_gate_summary", ("VAL-5",), oracle=f"""
WITH {SUBMISSIONS_SQL}
SELECT coalesce(gate_reason, 'accepted') AS status, count(*) AS n FROM subs GROUP BY ALL
""")
def input_gate_summary(spark, sf_dir):
    g = gated_submissions(spark, sf_dir)
    return g.groupBy(F.coalesce("gate_reason", F.lit("accepted")).alias("status")).agg(F.count(F.lit(1)).alias("n"))


@register("rejected_submissions", ("VAL-5",), oracle=f"""
WITH {SUBMISSIONS_SQL}
SELECT submission_id, gate_reason FROM subs WHERE gate_reason IS NOT NULL
""")
def rejected_submissions(spark, sf_dir):
    g = gated_submissions(spark, sf_dir)
    return g.where(F.col("gate_reason").isNotNull()).select("submission_id", "gate_reason")


_MEDIANS = " UNION ALL ".join(f"SELECT '{f}' AS feature, quantile_cont({f}, 0.5) AS median FROM tr" for f in FEATURES)


@register("processed_submissions", ("SCO-7", "FEA-2", "FEA-3", "FEA-7", "PRJ-7"), oracle=f"""
WITH {SPLIT_SQL}, tr AS (SELECT * FROM sp WHERE split = 'train'), md AS ({_MEDIANS}), {SUBMISSIONS_SQL},
part AS (SELECT submission_id, {', '.join(f"coalesce(CASE WHEN submission_id % {11 + i} <> 0 THEN {f} END, "
                                           f"(SELECT median FROM md WHERE feature = '{f}')) AS {f}, "
                                           f"CASE WHEN submission_id % {11 + i} <> 0 THEN {f} END AS raw_{f}"
                                           for i, f in enumerate(FEATURES))} FROM subs WHERE gate_reason IS NULL),
med AS (SELECT quantile_cont(log10(greatest(fc, {d(1.0)})), 0.5) AS m FROM tr WHERE fc IS NOT NULL)
SELECT submission_id, {len(FEATURES)} AS input_count, {len(FEATURES) + 1} AS processed_feature_count,
       {', '.join(f'round({f}, 6) AS {f}' for f in FEATURES)},
       round(coalesce(CASE WHEN raw_fc IS NOT NULL THEN log10(greatest(raw_fc, {d(1.0)})) END, (SELECT m FROM med)), 6) AS log10_fc
FROM part
""")
def processed_submissions(spark, sf_dir):
    """Accepted submissions, some values blanked, through the fitted preprocessing stages: the vector the classifier sees."""
    from riverlens.operators import models as MD
    train = written(split_frame(spark, sf_dir).where(F.col("split") == "train").select(*FEATURES), "train")
    stages = MD.build_pipeline("decision_tree").getStages()[:3]
    model = Pipeline(stages=stages).fit(train)
    sparse = accepted_submissions(spark, sf_dir).withColumns(
        {f: F.when(F.col("submission_id") % (11 + i) != 0, F.col(f)) for i, f in enumerate(FEATURES)})
    out = MD.preprocess(model, sparse)
    return out.select("submission_id", "input_count", "processed_feature_count",
                      *[F.round(F.get("processed", F.lit(i)), 6).alias(f) for i, f in enumerate(MD.FEATURES)])


_SUPPORT_PARTS = " UNION ALL ".join(
    f"SELECT obs_id, '{f}' AS feature, {f} AS value FROM sp WHERE split = 'test' AND {f} IS NOT NULL" for f in FEATURES)
_RANGE_PARTS = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, min({f}) AS lo, max({f}) AS hi FROM sp WHERE split = 'train'" for f in FEATURES)


@register("outside_training_support", ("SCO-5",), oracle=f"""
WITH {SPLIT_SQL}, rng AS ({_RANGE_PARTS}), t AS ({_SUPPORT_PARTS})
SELECT obs_id, t.feature, round(value, 6) AS value, round(lo, 6) AS support_min, round(hi, 6) AS support_max
FROM t JOIN rng USING (feature) WHERE value < lo OR value > hi
""")
def outside_training_support(spark, sf_dir):
    sp = split_frame(spark, sf_dir)
    rng = SC.support_ranges(sp.where(F.col("split") == "train"))
    out = SC.outside_support(sp.where(F.col("split") == "test"), rng)
    return out.select("obs_id", "feature", *[F.round(c, 6).alias(c) for c in ("value", "support_min", "support_max")])


def _probe_sql():
    parts = []
    no = 0
    for f, step in SC.PROBE_STEPS.items():
        lo, hi = dims.INPUT_BOUNDS[f]
        for sign in (-1.0, 1.0):
            v = f"({f} + {d(sign * step)})"
            cols = ", ".join(v + f" AS {g}" if g == f else g for g in SC.PROBE_STEPS)
            parts.append(f"SELECT obs_id, wqi_class AS label, {no} AS probe_no, '{f}' AS feature, {v} AS probe_value, "
                         f"{cols} FROM scored WHERE wqi_class IS NOT NULL AND {v} BETWEEN {d(lo)} AND {d(hi)}")
            no += 1
    return " UNION ALL ".join(parts)


_PROBE_IDX, _PROBE_OUT = index_ctes("probes", list(SC.PROBE_STEPS), "pidx")


@register("sensitivity_probes", ("SCO-6", "WIN-7"), oracle=f"""
WITH {scored_cte()}, probes AS ({_probe_sql()}), {_PROBE_IDX},
pc AS (SELECT *, {class_sql('wqi_score')} AS probe_class FROM {_PROBE_OUT}),
ch AS (SELECT * FROM pc WHERE probe_class <> label),
r AS (SELECT *, row_number() OVER (PARTITION BY obs_id ORDER BY probe_no) AS rn FROM ch)
SELECT obs_id, probe_no, feature, round(probe_value, 6) AS probe_value, probe_class, label FROM r WHERE rn = 1
""")
def sensitivity_probes(spark, sf_dir):
    p = SC.sensitivity_probes(scored_observations(spark, sf_dir))
    return p.select("obs_id", "probe_no", "feature", F.round("probe_value", 6).alias("probe_value"),
                    "probe_class", "label")


_POOR = ", ".join(f"'{c}'" for c in dims.POOR_CLASSES)


@register("rule_label_disagreement", ("SCO-9",), oracle=f"""
WITH {OBS_PROF}, {_elevated_sql('op', OBS_RULE_COLS, ('obs_id',))},
bad AS (SELECT DISTINCT obs_id FROM fnd WHERE parameter IN ('pH', 'DO', 'BOD', 'FC'))
SELECT obs_id, wqi_class FROM op WHERE wqi_class IN ({_POOR}) AND obs_id NOT IN (SELECT obs_id FROM bad)
""")
def rule_label_disagreement(spark, sf_dir):
    return SC.rule_label_disagreement(obs_with_findings(spark, sf_dir))


NN_FEATURES = ("ph", "do_mgl", "bod_mgl", "log10_fc")


def _z_sql(prefix, src_alias):
    return ", ".join(
        f"({src_alias}.{f} - (SELECT mean FROM st WHERE feature = '{f}')) / "
        f"(SELECT CASE WHEN std_pop > 0 THEN std_pop ELSE 1 END FROM st WHERE feature = '{f}') AS {prefix}{f}"
        for f in NN_FEATURES)


_NN_STATS = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, avg({f}) AS mean, stddev_pop({f}) AS std_pop FROM tr" for f in NN_FEATURES)


@register("nearest_labelled", ("SCO-10",), oracle=f"""
WITH {SPLIT_SQL}, spl AS (SELECT *, CASE WHEN fc IS NOT NULL THEN log10(greatest(fc, {d(1.0)})) END AS log10_fc FROM sp),
tr AS (SELECT * FROM spl WHERE split = 'train'), st AS ({_NN_STATS}), {SUBMISSIONS_SQL},
qsrc AS (SELECT *, log10(greatest(fc, {d(1.0)})) AS log10_fc FROM subs WHERE gate_reason IS NULL),
q AS (SELECT submission_id AS query_id, {_z_sql('q_', 'qsrc')} FROM qsrc),
r AS (SELECT obs_id, split, wqi_class, {_z_sql('r_', 'spl')} FROM spl
      WHERE {' AND '.join(f'{f} IS NOT NULL' for f in NN_FEATURES)}),
p AS (SELECT query_id, split, obs_id, wqi_class,
             sqrt({' + '.join(f'(r_{f} - q_{f}) * (r_{f} - q_{f})' for f in NN_FEATURES)}) AS distance FROM r, q),
k AS (SELECT query_id, split, unnest(min({{'distance': distance, 'obs_id': obs_id, 'wqi_class': wqi_class}}, 3)) AS x,
             unnest([1, 2, 3][:least(3, count(*))]) AS neighbour_rank FROM p GROUP BY query_id, split)
SELECT query_id, split, CAST(neighbour_rank AS INTEGER) AS neighbour_rank, x.obs_id AS obs_id, x.wqi_class AS wqi_class,
       round(x.distance, 6) AS distance FROM k
""")
def nearest_labelled(spark, sf_dir):
    """Three nearest labelled observations per split for every accepted submission."""
    sp = written(split_frame(spark, sf_dir).withColumn("log10_fc", log10_floor1(F.col("fc")))
                 .select("obs_id", "split", "wqi_class", *NN_FEATURES), "split")
    stats = S.moments(sp.where(F.col("split") == "train"), NN_FEATURES)
    queries = written(accepted_submissions(spark, sf_dir, dealt=True).withColumn("log10_fc", log10_floor1(F.col("fc"))), "queries")
    out = NN.nearest_labelled(queries, sp, stats, NN_FEATURES, query_key="submission_id")
    return out.select("query_id", "split", "neighbour_rank", "obs_id", "wqi_class",
                      F.round("distance", 6).alias("distance"))
