"""Batch scoring of submissions: input gate, support screening, probes, disagreement.

The reference scores one HTTP request at a time; here a table of
submissions is scored in one job.  Everything is row-wise except the
"first changed probe" pick, which brings the few probe rows of one
submission together (they lie next to each other in the same task, so
partial aggregation merges them before any shuffle).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverlens.functions import dims
from riverlens.functions.index import with_index
from riverlens.functions.scalars import in_bounds, no_nan
from riverlens.operators.quantiles import melt
from riverlens.operators.rules import finding_columns

# FIXED VALUES: probe step per model feature for the sensitivity screen.
PROBE_STEPS: dict[str, float] = {"ph": 0.01, "do_mgl": 0.1, "bod_mgl": 0.1, "fc": 1.0}


def input_gate(df: DataFrame, bounds=dims.INPUT_BOUNDS, unexpected: Sequence[str] = ()) -> DataFrame:
    """VAL-5 on typed columns: ``gate_reason`` = missing > unexpected > outside, null when accepted.

    A null, NaN or empty text is missing; a value in one of the ``unexpected``
    columns is unexpected; text, a boolean or a number outside the inclusive
    bounds is outside.
    """
    missing, outside, more = F.lit(False), F.lit(False), F.lit(False)
    for c, (lo, hi) in bounds.items():
        raw, kind = F.col(c), df.schema[c].dataType.typeName()
        if kind in ("string", "boolean"):
            missing = missing | raw.isNull() | (raw.cast("string") == "")
            outside = F.lit(True)
        else:
            num = no_nan(raw)
            missing = missing | num.isNull()
            outside = outside | ~F.coalesce(in_bounds(num, lo, hi), F.lit(False))
    for c in unexpected:
        more = more | F.col(c).isNotNull()
    return df.withColumn("gate_reason", F.when(missing, "missing").when(more, "unexpected").when(outside, "outside"))


def gate_payload(df: DataFrame, payload: str = "payload", bounds=dims.INPUT_BOUNDS) -> DataFrame:
    """VAL-5 on submissions as JSON text: the four columns (null unless numbers) and ``gate_reason``.

    The type decides, not the look: the text "7.2" and a boolean are outside.
    A field that is absent, null or an empty text is missing; a field that is
    not among the four is unexpected.  A payload that is no JSON object lacks
    everything.  The payload is read once as numbers, which
    leaves text and booleans null, and once as text; all in-row.
    """
    number, text = (F.from_json(F.col(payload), ", ".join(f"`{c}` {kind}" for c in bounds)) for kind in ("DOUBLE", "STRING"))
    names = F.coalesce(F.json_object_keys(F.col(payload)), F.array().cast("array<string>"))
    rows = df.withColumns({"_number": number, "_text": text, "_names": names})
    missing, outside = F.lit(False), F.lit(False)
    for c, (lo, hi) in bounds.items():
        missing = missing | (F.coalesce(F.col(f"_text.{c}"), F.lit("")) == "")
        outside = outside | ~F.coalesce(in_bounds(F.col(f"_number.{c}"), lo, hi), F.lit(False))
    more = F.size(F.array_except("_names", F.array(*[F.lit(c) for c in bounds]))) > 0
    reason = F.when(missing, "missing").when(more, "unexpected").when(outside, "outside")
    return rows.withColumns({"gate_reason": reason, **{c: F.col(f"_number.{c}") for c in bounds}}).drop("_number", "_text", "_names")


def support_ranges(train: DataFrame, features: Sequence[str] = dims.MODEL_FEATURES) -> DataFrame:
    """Training support per feature: one row per feature (min, max)."""
    return (melt(train, features).groupBy("feature")
            .agg(F.min("value").alias("support_min"), F.max("value").alias("support_max")))


def outside_support(df: DataFrame, ranges: DataFrame, features: Sequence[str] = dims.MODEL_FEATURES,
                    keys: Sequence[str] = ("obs_id",)) -> DataFrame:
    """SCO-5: (keys, feature, value) for values outside the inclusive training range."""
    long = melt(df, features, keys).where(F.col("value").isNotNull())
    j = long.join(F.broadcast(ranges), "feature")       # one row per feature
    return j.where((F.col("value") < F.col("support_min")) | (F.col("value") > F.col("support_max")))


def probe_values(steps: dict[str, float], bounds) -> list[tuple[int, str, Column, Column]]:
    """(number, feature, value, whether inside the bounds) of each probe: a feature a step lower, then higher."""
    moves = [(f, F.col(f) + F.lit(sign * step)) for f, step in steps.items() for sign in (-1.0, 1.0)]
    return [(no, f, v.cast("double"), v.between(*bounds[f])) for no, (f, v) in enumerate(moves)]


def probe_rows(df: DataFrame, steps: dict[str, float], bounds, keys: Sequence[str]) -> DataFrame:
    """Each row as it is (``probe_no`` -1) and with one feature a step lower or higher, as far as inside the bounds.

    Exploded in-row, two rows a feature at most; ``feature`` and ``probe_value``
    name the change, the feature columns hold it.
    """
    struct = lambda no, f, v: F.struct(F.lit(no).alias("probe_no"), F.lit(f).cast("string").alias("feature"),
                                       v.cast("double").alias("probe_value"))
    probes = [struct(-1, None, F.lit(None)), *[F.when(ok, struct(no, f, v)) for no, f, v, ok in probe_values(steps, bounds)]]
    rows = df.select(*keys, *steps, F.explode(F.array_compact(F.array(*probes))).alias("_p"))
    moved = {f: F.when(F.col("_p.feature") == f, F.col("_p.probe_value")).otherwise(F.col(f)) for f in steps}
    return rows.select(*keys, *[v.alias(f) for f, v in moved.items()], "_p.*")


def first_changes(scored: DataFrame, label: str, keys: Sequence[str]) -> DataFrame:
    """WIN-7: of scored probe rows the first probe (feature order, minus before plus) with another label than the row itself.

    A row and its probes, a bounded handful, come together in one array, merged
    map-side where they still lie next to each other.  Rows without a label,
    or without a change, give nothing.
    """
    probes = F.array_sort(F.collect_list(F.struct("probe_no", "feature", "probe_value", F.col(label).alias("probe_class"))))
    rows = scored.groupBy(*keys).agg(probes.alias("_all")).withColumn("label", F.get("_all", F.lit(0))["probe_class"])
    first = F.get(F.filter("_all", lambda p: (p["probe_no"] >= 0) & (p["probe_class"] != F.col("label"))), F.lit(0))
    return (rows.withColumn("_f", first).where(F.col("_f").isNotNull())
            .select(*keys, "_f.probe_no", "_f.feature", "_f.probe_value", "_f.probe_class", "label"))


def sensitivity_probes(df: DataFrame, steps: dict[str, float] = PROBE_STEPS, bounds=dims.INPUT_BOUNDS,
                       keys: Sequence[str] = ("obs_id",)) -> DataFrame:
    """SCO-6 with the index label as classifier: what ``first_changes`` gives for the ``probe_rows``.

    The index is an expression, so a row's probes are labelled in the row.  Only
    those with another label than the row, and the first with its own, are
    shuffled, once and without the features' names: rows with the same key have
    the smallest of their labels, so for one of them its own may be a change.
    """
    rows = df.select(*keys, *[F.col(f).alias(f"_o_{f}") for f in steps])
    back = {f: F.col(f"_o_{f}") for f in steps}

    def labelled(rows: DataFrame, name: str) -> DataFrame:
        return rows.transform(with_index).withColumnRenamed("wqi_class", name).drop("n_params", "wqi_score", "potability", *steps)

    rows = labelled(rows.withColumns(back), "_own")
    own, other, same = F.col("_own"), [], []
    for no, f, v, ok in probe_values(steps, bounds):
        rows = rows.withColumns(back).withColumns({"_v": v, "_ok": ok})
        rows = labelled(rows.withColumns({f: F.col("_v"), f"_v{no}": F.when(F.col("_ok"), F.col("_v"))}).drop("_v", "_ok"), f"_c{no}")
        probe = F.struct(F.lit(no).alias("probe_no"), F.col(f"_v{no}").alias("probe_value"), F.col(f"_c{no}").alias("probe_class"))
        there = F.col(f"_v{no}").isNotNull()
        other.append(F.when(there & (F.col(f"_c{no}") != own), probe))
        same.append(F.when(there & (F.col(f"_c{no}") == own), probe))
    rows = rows.select(*keys, own, F.array_compact(F.array(*other)).alias("_other"), F.coalesce(*same).alias("_same"))
    # dealt out first: merging before the shuffle would sort rows that hardly ever share a key
    rows = rows.repartition(*keys).groupBy(*keys).agg(
        F.when(F.count("_own") == F.count(F.lit(1)), F.min("_own")).alias("label"),
        F.array_sort(F.concat(F.flatten(F.collect_list("_other")), F.collect_list("_same"))).alias("_all"))
    first = F.get(F.filter("_all", lambda p: p["probe_class"] != F.col("label")), F.lit(0))
    feature = F.get(F.array(*[F.lit(f) for f in steps]), F.floor(F.col("_f.probe_no") / 2).cast("int"))
    return (rows.withColumn("_f", first).where(F.col("_f").isNotNull())
            .select(*keys, "_f.probe_no", feature.alias("feature"), "_f.probe_value", "_f.probe_class", "label"))


def model_sensitivity(df: DataFrame, predict: Callable[[DataFrame, Sequence[str]], DataFrame], steps: dict[str, float] = PROBE_STEPS,
                      bounds=dims.INPUT_BOUNDS, keys: Sequence[str] = ("submission_id",)) -> DataFrame:
    """SCO-6 with a fitted classifier: ``predict(rows, keys)`` gives the keys and ``predicted``.

    The rows and all their probes go through one ``transform`` of the model.
    """
    rows = probe_rows(df, steps, bounds, keys)
    carried = [*keys, "probe_no", "feature", "probe_value"]
    return first_changes(predict(rows, carried), "predicted", keys)


def rule_label_disagreement(findings_df: DataFrame, params: Sequence[str] = ("pH", "DO", "BOD", "FC"),
                            label: str = "wqi_class", keys: Sequence[str] = ("obs_id",)) -> DataFrame:
    """SCO-9: all four core parameters within limits, yet the label is Poor or worse."""
    columns = finding_columns(findings_df)
    if columns:     # plain columns stay in generated code; the array and its filter are made row by row
        core = reduce(or_, [F.coalesce(F.col(c)["parameter"].isin(*params), F.lit(False)) for c in columns])
    else:
        core = F.size(F.filter(F.col("findings"), lambda x: x["parameter"].isin(*params))) > 0
    return findings_df.where(F.col(label).isin(*dims.POOR_CLASSES)).where(~core).select(*keys, label)


def uncertain(prob_max, threshold: float = dims.UNCERTAIN_BELOW):
    """SCO-4: top class probability strictly below the threshold."""
    return prob_max < threshold


def review_limits(rules=dims.RULES) -> dict[str, tuple[str, float | None, float | None, str, str]]:
    """Column to (parameter, lowest, highest, unit, source) acceptable, read off the rules."""
    out: dict[str, tuple] = {}
    for parameter, column, _, side, limit, *_, unit in rules:
        _, lo, hi, *_ = out.get(column, (parameter, None, None))
        lo, hi = (limit, hi) if side == "below" else (lo, limit)
        out[column] = (parameter, lo, hi, unit, dims.STANDARD_SOURCES[parameter])
    return out


def measurement_review(df: DataFrame, keys: Sequence[str] = ("obs_id",), rules=dims.RULES) -> DataFrame:
    """SCO-8: per observation and measured parameter: value, unit, range, source, abnormal flag.

    A value is abnormal when one of its rules finds it so.  Built in-row (array
    of structs + inline) against the fixed rules: no join, no shuffle.
    """
    items = []
    for column, (param, lo, hi, unit, source) in review_limits(rules).items():
        if column not in df.columns:
            continue
        v = no_nan(F.col(column))
        bad = F.lit(False)
        for parameter, _, _, side, limit, *_ in rules:
            if parameter == param:
                bad = bad | (v < limit if side == "below" else v > limit)
        items.append(F.struct(F.lit(param).alias("parameter"), v.alias("value"), F.lit(unit).alias("unit"),
                              F.lit(lo).cast("double").alias("lower_limit"),
                              F.lit(hi).cast("double").alias("upper_limit"), F.lit(source).alias("source"),
                              F.coalesce(bad, F.lit(False)).alias("abnormal")))
    return df.select(*keys, F.inline(F.array(*items)))


def decision_summary_json(findings_df: DataFrame, keys: Sequence[str] = ("obs_id",)) -> DataFrame:
    """RUL-4 / SCL-5 / SCL-9: one JSON document per observation with condition texts.

    The numbers stay in their own fields; the condition text (two decimals)
    is presentation only.
    """
    cond = F.transform(F.col("findings"), lambda x: x.withField(
        "condition", F.format_string("%s %s %.2f (limit %.2f)", x["parameter"],
                                     F.when(x["kind"] == "low", F.lit("below")).otherwise(F.lit("above")),
                                     x["value"], x["limit"])))
    doc = F.struct(*[F.col(k) for k in keys], F.col("wqi_class").alias("label"),
                   "overall_priority", "n_evaluated", "n_abnormal", cond.alias("findings"))
    return findings_df.select(*keys, F.to_json(doc).alias("document"))
