"""Explanations and documents of a literal tree, checkable in SQL (SCO-4, XAI-1/3/4/5, WIN-4/5/6, SCL-8, RUL-5/6, JOIN-5/6).

The fitted-model queries have no SQL equivalent.  Here the same operators run
on a small tree written out below, over all complete labelled observations.
The oracle takes another way: it writes the conditional expectation of the
tree for every subset of features as SQL and applies Shapley's definition.
"""

from __future__ import annotations

from itertools import combinations
from math import factorial

import pandas as pd
from pyspark.sql import functions as F

from riverlens.functions import dims
from riverlens.functions.scalars import log10_floor1, rounded
from riverlens.operators import explain as X
from riverlens.operators import models as MD
from riverlens.operators import profile as P
from riverlens.operators import rules as RU
from riverlens.operators import scoring as SC
from riverlens.plans.labelling import scored_observations
from riverlens.plans.oracle import d, scored_cte
from riverlens.plans.registry import register
from riverlens.plans.rules import OBS_RULE_COLS, _elevated_sql
from riverlens.plans.scoring import SUBMISSIONS_SQL, accepted_submissions

NAMES = tuple(sorted(dims.CLASS_ORDER))     # Excellent, Good, Poor, Unsuitable, Very Poor
FEATURES = MD.FEATURES                      # ph, do_mgl, bod_mgl, fc, log10_fc
# node: (feature number, threshold, left, right) or the class weights of a leaf; the totals of the leaves are
# primes, so that no exact value ends on a 5 behind the sixth digit, where two engines could round differently
TREE = {0: (1, 5.0, 1, 4), 1: (2, 3.0, 2, 3), 2: (0, 5, 20, 10, 26), 3: (0, 0, 5, 60, 18), 4: (3, 250.0, 5, 6),
        5: (13, 31, 11, 3, 9), 6: (0, 7.5, 7, 8), 7: (1, 4, 12, 31, 11), 8: (0, 1, 2, 53, 15)}


def weights(k):
    """Class weights under a node."""
    node = TREE[k]
    return node if len(node) == 5 else tuple(a + b for a, b in zip(weights(node[2]), weights(node[3])))


def node_frame() -> pd.DataFrame:
    """The tree in the form of a saved model's node table."""
    rows = [(k, list(map(float, weights(k))), *((n[2], n[3], n[0], [n[1]]) if len(n) == 4 else (-1, -1, -1, [])))
            for k, n in TREE.items()]
    return pd.DataFrame(rows, columns=["id", "impurityStats", "leftChild", "rightChild", "feature", "thr"])


def _leaf(k=0):
    """Leaf number of a row as nested conditions."""
    n = TREE[k]
    if len(n) == 5:
        return F.lit(k)
    return F.when(F.col(FEATURES[n[0]]) <= n[1], _leaf(n[2])).otherwise(_leaf(n[3]))


def predictions(spark, sf_dir):
    """Complete labelled rows with the tree's label, probabilities and feature values."""
    s = scored_observations(spark, sf_dir).where(F.col("wqi_class").isNotNull()).dropna(subset=list(dims.MODEL_FEATURES))
    return predict(s, ("obs_id", "wqi_class"))


def predict(df, keys):
    """(keys, predicted, probabilities, top_probability, uncertain, features) of rows with the raw features."""
    s = df.withColumn("log10_fc", log10_floor1(F.col("fc"))).withColumn("_leaf", _leaf())
    share = F.create_map(*[x for k, n in TREE.items() if len(n) == 5 for x in (
        F.lit(k), F.array(*[F.lit(v / sum(n)) for v in n]))])
    s = s.withColumn("_p", share[F.col("_leaf")])
    names = F.array(*[F.lit(n) for n in NAMES])
    return s.select(*keys, F.get(names, F.array_position("_p", F.array_max("_p")).cast("int") - 1).alias("predicted"),
                    F.map_from_arrays(names, F.col("_p")).alias("probabilities"), F.array_max("_p").alias("top_probability"),
                    (F.array_max("_p") < dims.UNCERTAIN_BELOW).alias("uncertain"),
                    F.array(*FEATURES).alias("features"))


def attributed(spark, sf_dir):
    return X.attributed(node_frame(), predictions(spark, sf_dir), len(FEATURES))


def explained(spark, sf_dir):
    rows, base = attributed(spark, sf_dir)
    return X.with_explanation(rows, base, NAMES, FEATURES)


# ---- the oracle: expectations given a subset of the features, then Shapley's definition

USED = (0, 1, 2, 3)


def _given(k, subset, cls):
    n = TREE[k]
    if len(n) == 5:
        return d(n[cls] / sum(n))
    left, right = _given(n[2], subset, cls), _given(n[3], subset, cls)
    if n[0] in subset:
        return f"CASE WHEN {FEATURES[n[0]]} <= {d(n[1])} THEN {left} ELSE {right} END"
    a, b = sum(weights(n[2])), sum(weights(n[3]))
    return f"({d(a / (a + b))} * {left} + {d(b / (a + b))} * {right})"


def _phi_sql(j, cls):
    if j not in USED:
        return d(0.0)
    rest = [f for f in USED if f != j]
    terms = []
    for n in range(len(rest) + 1):
        w = factorial(n) * factorial(len(rest) - n) / factorial(len(rest) + 1)
        terms += [f"{d(w)} * (v_{_mask({*s, j})}_{cls} - v_{_mask(s)}_{cls})" for s in combinations(rest, n)]
    return " + ".join(terms)


def _mask(subset):
    return sum(1 << f for f in subset)


_SUBSETS = [s for n in range(len(USED) + 1) for s in combinations(USED, n)]
_V = ", ".join(f"{_given(0, set(s), c)} AS v_{_mask(s)}_{c}" for s in _SUBSETS for c in range(5))
_ALL = _mask(USED)
_TOP = f"greatest({', '.join(f'v_{_ALL}_{c}' for c in range(5))})"
_PICK = " ".join(f"WHEN v_{_ALL}_{c} = top_probability THEN '{n}'" for c, n in enumerate(NAMES))
LITERAL_SQL = (
    f"{scored_cte()}, full_rows AS (SELECT *, log10(greatest(fc, {d(1.0)})) AS log10_fc FROM scored WHERE wqi_class IS NOT NULL "
    f"AND {' AND '.join(f'{c} IS NOT NULL' for c in dims.MODEL_FEATURES)}), "
    f"v AS (SELECT obs_id, {', '.join(FEATURES)}, {_V} FROM full_rows), "
    f"t AS (SELECT *, {_TOP} AS top_probability FROM v), "
    f"lit AS (SELECT *, CASE {_PICK} END AS predicted FROM t), "
    f"phi AS (SELECT *, {', '.join(f'{_phi_sql(j, c)} AS phi_{j}_{c}' for j in range(5) for c in range(5))} FROM lit)")
_MINE = {j: "CASE predicted " + " ".join(f"WHEN '{n}' THEN phi_{j}_{c}" for c, n in enumerate(NAMES)) + " END" for j in range(5)}
_BASE = "CASE predicted " + " ".join(f"WHEN '{n}' THEN v_0_{c}" for c, n in enumerate(NAMES)) + " END"
RANKED_SQL = (
    f"{LITERAL_SQL}, flat AS (" + " UNION ALL ".join(
        f"SELECT obs_id, predicted, {_BASE} AS base_value, {j} AS j, '{f}' AS feature, {f} AS feature_value, {_MINE[j]} AS contribution FROM phi"
        for j, f in enumerate(FEATURES))
    + "), ranked AS (SELECT *, row_number() OVER (PARTITION BY obs_id ORDER BY round(abs(contribution), 9) DESC, j) AS rank FROM flat)")


@register("literal_tree_predictions", ("SCO-2", "SCO-3", "SCO-4"), oracle=f"""
WITH {LITERAL_SQL}
SELECT obs_id, predicted, round(top_probability, 6) AS top_probability, top_probability < {d(dims.UNCERTAIN_BELOW)} AS uncertain FROM lit
""")
def literal_tree_predictions(spark, sf_dir):
    p = predictions(spark, sf_dir)
    return p.select("obs_id", "predicted", F.round("top_probability", 6).alias("top_probability"), "uncertain")


@register("literal_tree_attributions", ("XAI-1", "XAI-2"), oracle=f"""
WITH {LITERAL_SQL}
SELECT obs_id, {', '.join(f'round(phi_{j}_{c}, 6) + 0.0 AS phi_{f}_{c}' for j, f in enumerate(FEATURES) for c in range(5))} FROM phi
""")
def literal_tree_attributions(spark, sf_dir):
    rows, _ = attributed(spark, sf_dir)
    n = len(FEATURES)
    return rows.select("obs_id", *[(F.round(F.get("phi", F.lit(c * n + j)), 6) + 0.0).alias(f"phi_{f}_{c}")
                                   for j, f in enumerate(FEATURES) for c in range(5)])


@register("literal_importance", ("XAI-3", "WIN-5"), oracle=f"""
WITH {LITERAL_SQL}, m AS ({' UNION ALL '.join(
    f"SELECT '{f}' AS feature, ({' + '.join(f'avg(abs(phi_{j}_{c}))' for c in range(5))}) / 5 AS mean_abs FROM phi" for j, f in enumerate(FEATURES))})
SELECT feature, round(mean_abs, 6) AS mean_abs, round(mean_abs / sum(mean_abs) OVER (), 6) AS share,
       CAST(row_number() OVER (ORDER BY mean_abs DESC, feature) AS INTEGER) AS rank FROM m
""")
def literal_importance(spark, sf_dir):
    rows, _ = attributed(spark, sf_dir)
    imp = X.global_importance(X.long_form(rows, FEATURES), NAMES)
    return imp.select("feature", F.round("mean_abs", 6).alias("mean_abs"), F.round("share", 6).alias("share"), "rank")


@register("literal_local_explanations", ("XAI-4", "WIN-4", "WIN-6", "SCL-8"), oracle=f"""
WITH {RANKED_SQL}
SELECT obs_id, predicted, CAST(rank AS INTEGER) AS rank, feature, round(feature_value, 6) AS feature_value,
       round(contribution, 6) + 0.0 AS contribution, round(base_value, 6) AS base_value, true AS additive_ok,
       CASE WHEN contribution > {d(1e-7)} THEN 'increases' WHEN contribution < {d(-1e-7)} THEN 'decreases' ELSE 'neutral' END AS direction
FROM ranked
""")
def literal_local_explanations(spark, sf_dir):
    rows, base = X.attributed(node_frame(), X.answers(predictions(spark, sf_dir)), len(FEATURES), class_names=NAMES)
    rows = X.with_explanation(rows, base, NAMES, FEATURES).withColumn("base_value", rounded(F.col("base_value")))
    out = X.local_explanation(rows)
    return out.select("obs_id", "predicted", "rank", "feature", rounded(F.col("feature_value")).alias("feature_value"),
                      (rounded(F.col("contribution")) + 0.0).alias("contribution"), "base_value", "additive_ok", "direction")


_KEY = "CASE feature " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in RU.MATCH_KEY.items()) + " END"


@register("literal_decision_documents", ("RUL-5", "RUL-6", "JOIN-5", "JOIN-6"), oracle=f"""
WITH {RANKED_SQL}, op AS (SELECT obs_id, {', '.join(FEATURES)}, predicted AS wqi_class FROM lit),
{_elevated_sql('op', OBS_RULE_COLS, ('obs_id',))},
top AS (SELECT obs_id, feature, rank, {_KEY} AS match_key FROM ranked WHERE rank <= 2),
f AS (SELECT obs_id, parameter, priority, CASE parameter WHEN 'Log10_FC' THEN 'FC' ELSE parameter END AS match_key FROM fnd)
SELECT obs_id, 'abnormal_contributing' AS section, feature, parameter, CAST(rank AS INTEGER) AS rank, priority
FROM top JOIN f USING (obs_id, match_key)
UNION ALL SELECT obs_id, 'normal_contributing', feature, NULL, CAST(rank AS INTEGER), NULL FROM top ANTI JOIN f USING (obs_id, match_key)
UNION ALL SELECT obs_id, 'additional_abnormal', NULL, parameter, NULL, priority FROM f ANTI JOIN top USING (obs_id, match_key)
""")
def literal_decision_documents(spark, sf_dir):
    return RU.document_sections(RU.with_document(explained(spark, sf_dir), FEATURES))


@register("literal_vs_separation", ("XAI-5",), oracle=f"""
WITH {LITERAL_SQL}, m AS ({' UNION ALL '.join(
    f"SELECT '{f}' AS feature, ({' + '.join(f'avg(abs(phi_{j}_{c}))' for c in range(5))}) / 5 AS mean_abs FROM phi" for j, f in enumerate(FEATURES))}),
imp AS (SELECT feature, CAST(row_number() OVER (ORDER BY mean_abs DESC, feature) AS INTEGER) AS shap_rank FROM m),
med AS ({' UNION ALL '.join(f"SELECT '{f}' AS feature, wqi_class, round(quantile_cont({f}, 0.5), 6) AS median FROM full_rows GROUP BY wqi_class" for f in FEATURES)}),
sep AS (SELECT feature, max(median) - min(median) AS s FROM med GROUP BY feature),
eda AS (SELECT feature, CAST(row_number() OVER (ORDER BY s DESC, feature) AS INTEGER) AS eda_rank FROM sep)
SELECT feature, shap_rank, eda_rank, shap_rank = eda_rank AS rank_agrees FROM imp JOIN eda USING (feature)
""")
def literal_vs_separation(spark, sf_dir):
    rows, _ = attributed(spark, sf_dir)
    imp = X.global_importance(X.long_form(rows, FEATURES), NAMES)
    s = scored_observations(spark, sf_dir).where(F.col("wqi_class").isNotNull()).dropna(subset=list(dims.MODEL_FEATURES))
    eda = P.five_number_by_class(s.withColumn("log10_fc", log10_floor1(F.col("fc"))), list(FEATURES))
    return X.compare_with_eda(imp, eda).select("feature", "shap_rank", "eda_rank", "rank_agrees")


def _class_sql(k=0):
    """The tree's label of a row as nested conditions."""
    n = TREE[k]
    if len(n) == 5:
        return f"'{NAMES[n.index(max(n))]}'"
    return f"CASE WHEN {FEATURES[n[0]]} <= {d(n[1])} THEN {_class_sql(n[2])} ELSE {_class_sql(n[3])} END"


# ten times the usual steps: the tree has few thresholds
WIDE_STEPS = {f: 10 * step for f, step in SC.PROBE_STEPS.items()}


def _probes_sql():
    parts = [f"SELECT submission_id, -1 AS probe_no, NULL AS feature, NULL AS probe_value, {', '.join(SC.PROBE_STEPS)} FROM acc"]
    for f, step in WIDE_STEPS.items():
        lo, hi = dims.INPUT_BOUNDS[f]
        for sign in (-1.0, 1.0):
            v = f"({f} + {d(sign * step)})"
            cols = ", ".join(f"{v} AS {g}" if g == f else g for g in SC.PROBE_STEPS)
            parts.append(f"SELECT submission_id, {len(parts) - 1}, '{f}', {v}, {cols} FROM acc WHERE {v} BETWEEN {d(lo)} AND {d(hi)}")
    return " UNION ALL ".join(parts)


@register("literal_submission_sensitivity", ("SCO-6", "WIN-7"), oracle=f"""
WITH {SUBMISSIONS_SQL}, acc AS (SELECT * FROM subs WHERE gate_reason IS NULL), probes AS ({_probes_sql()}),
pl AS (SELECT *, {_class_sql()} AS probe_class FROM (SELECT *, log10(greatest(fc, {d(1.0)})) AS log10_fc FROM probes)),
base AS (SELECT submission_id, probe_class AS label FROM pl WHERE probe_no = -1),
ch AS (SELECT pl.*, label, row_number() OVER (PARTITION BY submission_id ORDER BY probe_no) AS rn
       FROM pl JOIN base USING (submission_id) WHERE probe_class <> label)
SELECT submission_id, probe_no, feature, round(probe_value, 6) AS probe_value, probe_class, label FROM ch WHERE rn = 1
""")
def literal_submission_sensitivity(spark, sf_dir):
    """The first small change of each accepted submission that changes the literal tree's answer."""
    out = SC.model_sensitivity(accepted_submissions(spark, sf_dir), predict, WIDE_STEPS)
    return out.select("submission_id", "probe_no", "feature", F.round("probe_value", 6).alias("probe_value"), "probe_class", "label")
