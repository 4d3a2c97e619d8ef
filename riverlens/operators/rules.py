"""Threshold rules, priority elevation, overall priority and actions.

Main path (in-row): each row carries an array of rule structs with its own
measured value; ``filter`` keeps the abnormal ones, elevation and the
overall priority are array expressions over that row's findings.  No
shuffle, no window and no join, so the same code runs on streaming
DataFrames (STR-1).  The rule set is a fixed-size literal built from the
config (``dims.RULES`` or a replacement table).

Alternative path (JOIN-8): measurements melted to long form and joined to
the rule table as a broadcast dimension (15 rows, fixed by the config),
for callers that hold the rules as a DataFrame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverlens.functions import dims
from riverlens.operators.quantiles import melt

# Our own wording of the recommended actions, per (parameter, kind).  Only
# the limits and priorities are fixed values; the text is presentation.
ACTIONS: dict[tuple[str, str], tuple[str, ...]] = {
    ("pH", "low"): ("Trace acidic inflows upstream of the station", "Recalibrate the pH probe and resample"),
    ("pH", "high"): ("Check for alkaline effluent or algal growth upstream", "Recalibrate the pH probe and resample"),
    ("DO", "low"): ("Inspect for organic load and stagnant reaches", "Schedule a repeat oxygen profile"),
    ("DO", "supersaturated"): ("Check for algal blooms near the station", "Repeat the oxygen reading at dawn"),
    ("BOD", "high"): ("Survey sewage and organic discharges upstream", "Review treatment plant outflow records"),
    ("FC", "high"): ("Issue a contact advisory pending resampling", "Trace sewage inflows upstream"),
    ("Log10_FC", "high"): ("Issue a contact advisory pending resampling", "Trace sewage inflows upstream"),
    ("Turbidity", "high"): ("Check for erosion or dredging upstream", "Resample after settling conditions"),
    ("EC", "high"): ("Check for saline or industrial discharge", "Resample conductivity with a fresh probe"),
    ("TDS", "high"): ("Check for saline or industrial discharge", "Review dissolved solids trend at the station"),
    ("COD", "high"): ("Survey industrial discharges upstream", "Review effluent permits in the catchment"),
    ("TC", "high"): ("Trace sewage and runoff inflows", "Resample for coliform confirmation"),
    ("Nitrate", "high"): ("Review fertiliser runoff in the catchment", "Resample for nitrogen species"),
    ("Ammonia", "high"): ("Trace fresh sewage or manure inflows", "Resample for nitrogen species"),
    ("Temperature", "high"): ("Check for thermal discharge upstream", "Log water temperature at the next visit"),
}

FINDING = ("rule_order", "parameter", "kind", "value", "limit", "is_critical", "base", "priority")


def _rule_rows(rules, columns: Sequence[str]):
    """Rules whose measured column is present, in input-column order."""
    order = {c: i for i, c in enumerate(columns)}
    rows = [dict(zip(dims.RULE_COLUMNS, r)) for r in rules]
    rows = [r for r in rows if r["column"] in order]
    rows.sort(key=lambda r: order[r["column"]])
    return rows


def _finding_parts(columns: Sequence[str], rules, label: str | None):
    """Per-rule (abnormal, struct-without-priority, base) scalar expressions."""
    parts = []
    for i, r in enumerate(_rule_rows(rules, columns)):
        v = F.nanvl(F.col(r["column"]).cast("double"), F.lit(None).cast("double"))
        limit = float(r["limit"])
        crit = r["critical"]
        if r["direction"] == "below":
            abnormal = v < limit
            critical = (v < float(crit)) if crit is not None else F.lit(False)
        else:
            abnormal = v > limit
            crit_v = float(crit) if crit is not None else 2.0 * limit
            critical = v > crit_v
        critical = F.coalesce(critical, F.lit(False))
        base = F.when(critical, F.lit(r["critical_priority"])).otherwise(F.lit(r["base_priority"]))
        parts.append((F.coalesce(abnormal, F.lit(False)), i, r, v, limit, critical, base))
    return parts


PRIORITY_CODE = {"Low": 1, "Medium": 2, "High": 3}
PRIORITY_NAMES = ("Low", "Medium", "High")


def with_findings(df: DataFrame, columns: Sequence[str], rules=dims.RULES,
                  label: str | None = "wqi_class") -> DataFrame:
    """RUL-1..4: per-rule priority codes ``_p<i>`` (0 = normal, 1..3 = Low..High
    after elevation), finding structs ``_f<i>`` (null when normal), ``findings``
    (compacted array), ``n_evaluated``, ``n_abnormal`` and ``overall_priority``.

    Each step is a separate projection over small integer codes, so no
    expression is repeated inside another and the generated code stays
    small enough for the JIT (whole-stage codegen).
    """
    parts = _finding_parts(columns, rules, label)
    n = sum((F.when(a, 1).otherwise(0) for a, *_ in parts), F.lit(0))
    poor = F.coalesce(F.col(label).isin(*dims.POOR_CLASSES), F.lit(False)) if label else F.lit(False)
    df = df.withColumns({"n_abnormal": n.cast("int"), "_poor": poor,
                         "n_evaluated": F.lit(len([c for c in columns if c in df.columns]))})
    cnt = F.col("n_abnormal")
    codes = {}
    for abnormal, i, r, v, limit, critical, base in parts:
        base_code = F.when(critical, F.lit(PRIORITY_CODE[r["critical_priority"]])).otherwise(
            F.lit(PRIORITY_CODE[r["base_priority"]]))
        codes[f"_b{i}"] = F.when(abnormal, base_code).otherwise(F.lit(0))
    df = df.withColumns(codes)
    prio = {}
    for abnormal, i, *_ in parts:
        b = F.col(f"_b{i}")
        prio[f"_p{i}"] = (F.when(b == 0, F.lit(0)).when(cnt >= 2, F.lit(3))
                           .when(F.col("_poor") & (b == 2), F.lit(3)).otherwise(b))
    df = df.withColumns(prio)
    top = F.greatest(*[F.col(c) for c in prio], F.lit(0)) if prio else F.lit(0)
    df = df.withColumn("_top", top)
    overall = (F.when(cnt == 0, "None").when(F.col("_top") == 3, "High").when(cnt >= 2, "High")
                .when(F.col("_poor"), "High").when(F.col("_top") == 2, "Medium").otherwise("Low"))
    fcols = {}
    for abnormal, i, r, v, limit, critical, base in parts:
        p = F.col(f"_p{i}")
        fcols[f"_f{i}"] = F.when(p > 0, F.struct(
            F.lit(i).alias("rule_order"), F.lit(r["parameter"]).alias("parameter"),
            F.lit(r["kind"]).alias("kind"), v.alias("value"), F.lit(limit).alias("limit"),
            (F.col(f"_b{i}") == PRIORITY_CODE[r["critical_priority"]]).alias("is_critical")
            if r["critical_priority"] != r["base_priority"] else critical.alias("is_critical"),
            F.element_at(F.array(*[F.lit(x) for x in PRIORITY_NAMES]), F.col(f"_b{i}")).alias("base"),
            F.element_at(F.array(*[F.lit(x) for x in PRIORITY_NAMES]), p).alias("priority")))
    df = df.withColumn("overall_priority", overall).withColumns(fcols)
    names = list(fcols)
    arr = F.array(*[F.col(c) for c in names]) if names else F.array()
    return (df.withColumn("findings", F.filter(arr, lambda x: x.isNotNull()))
              .drop("_poor", "_top", *codes, *prio))


def finding_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("_f") and c[2:].isdigit()]


def findings_long(df: DataFrame, keys: Sequence[str] = ("obs_id",)) -> DataFrame:
    """One row per finding: explode of the per-rule columns, nulls dropped (no HOF)."""
    cols = finding_columns(df)
    return (df.select(*keys, "n_abnormal", F.explode(F.array(*[F.col(c) for c in cols])).alias("_x"))
              .where(F.col("_x").isNotNull()).select(*keys, "n_abnormal", "_x.*"))


def unique_by_parameter(findings: Column) -> Column:
    """RUL-7: one finding per parameter, the last one wins."""
    return F.filter(findings, lambda x, i: ~F.exists(
        F.slice(findings, i + 2, F.greatest(F.size(findings), F.lit(1))),
        lambda y: y["parameter"] == x["parameter"]))


def _action_map(rules) -> Column:
    """Literal map (parameter|kind|priority) -> actions (parameter, priority, recommendation)."""
    pairs = []
    for r in rules:
        texts = ACTIONS.get((r[0], r[2]), ("Review the measurement and resample",))
        for prio in PRIORITY_NAMES:
            pairs += [F.lit(f"{r[0]}|{r[2]}|{prio}"), F.array(*[F.struct(
                F.lit(r[0]).alias("parameter"), F.lit(prio).alias("priority"), F.lit(t).alias("recommendation"))
                for t in texts])]
    return F.create_map(*pairs)


def actions(df: DataFrame, rules=dims.RULES) -> Column:
    """SET-4: ordered, de-duplicated actions (parameter, priority, recommendation) of a row's findings."""
    amap = _action_map(rules)
    empty = F.array().cast("array<struct<parameter:string,priority:string,recommendation:string>>")
    parts = [F.coalesce(F.element_at(amap, F.concat_ws("|", F.col(f"{c}.parameter"), F.col(f"{c}.kind"),
                                                      F.col(f"{c}.priority"))), empty)
             for c in finding_columns(df)]
    return F.array_distinct(F.concat(*parts)) if parts else empty


def action_items(df: DataFrame, keys: Sequence[str] = ("obs_id",), rules=dims.RULES) -> DataFrame:
    """SET-4 / RUL-5 level 3: ordered, de-duplicated (parameter, priority, text) actions.

    Findings are taken in rule order; each finding's actions come from a
    literal map keyed by (parameter, kind, priority).  No join, no shuffle.
    """
    out = df.select(*keys, F.posexplode(actions(df, rules)).alias("pos", "_a"))
    return out.select(*keys, (F.col("pos") + 1).alias("action_rank"), "_a.*")


# FIXED VALUES: model feature -> rule parameter; FC and its log are one parameter.
MATCH_KEY = {"ph": "pH", "do_mgl": "DO", "bod_mgl": "BOD", "fc": "FC", "log10_fc": "FC"}


def with_document(rows: DataFrame, feature_names: Sequence[str], top_n: int = 2) -> DataFrame:
    """RUL-5 / RUL-6 / JOIN-5 / JOIN-6: explained rows with the nested decision ``document``.

    Rule inputs are the row's own measurements where it carries them and the
    attribution's (imputed) feature values otherwise.  The first ``top_n``
    contributions (0: all) meet the findings by parameter in three groups:
    abnormal and contributing, normal and contributing, abnormal in addition.
    All in-row.
    """
    own = set(rows.columns)
    values = {f: F.coalesce(*([F.col(f).cast("double")] if f in own else []), F.get("x", F.lit(i)))
              for i, f in enumerate(feature_names)}
    rows = with_findings(rows.withColumns(values), list(feature_names), label="predicted")
    key = F.create_map(*[x for k, v in MATCH_KEY.items() for x in (F.lit(k), F.lit(v))])
    named = F.transform("ranked", lambda t: t.withField("match_key", key[t["feature"]]))
    rows = rows.withColumn("_top", F.slice(named, 1, top_n) if top_n > 0 else named)
    of = lambda f: F.when(f["parameter"] == "Log10_FC", "FC").otherwise(f["parameter"])
    abnormal = F.flatten(F.transform("_top", lambda t: F.transform(
        F.filter("findings", lambda f: of(f) == t["match_key"]),
        lambda f: F.struct(t["feature"].alias("feature"), f["parameter"].alias("parameter"), t["rank"].alias("rank"),
                           f["priority"].alias("priority")))))
    normal = F.transform(F.filter("_top", lambda t: ~F.exists("findings", lambda f: of(f) == t["match_key"])),
                         lambda t: F.struct(t["feature"].alias("feature"), F.lit(None).cast("string").alias("parameter"),
                                            t["rank"].alias("rank"), F.lit(None).cast("string").alias("priority")))
    additional = F.transform(F.filter("findings", lambda f: ~F.exists("_top", lambda t: of(f) == t["match_key"])),
                             lambda f: F.struct(F.lit(None).cast("string").alias("feature"), f["parameter"].alias("parameter"),
                                                F.lit(None).cast("int").alias("rank"), f["priority"].alias("priority")))
    document = F.struct(
        F.struct("predicted", F.col("probabilities")[F.col("predicted")].alias("probability"), "probabilities").alias("prediction"),
        F.col("_top").alias("top_contributions"), abnormal.alias("abnormal_contributing"),
        normal.alias("normal_contributing"), additional.alias("additional_abnormal"),
        "overall_priority", actions(rows).alias("actions"), "caveat")
    return rows.withColumn("document", document)


SECTIONS = ("abnormal_contributing", "normal_contributing", "additional_abnormal")


def document_sections(rows: DataFrame, keys: Sequence[str] = ("obs_id",)) -> DataFrame:
    """The three groups of a document in long form (keys, section, feature, parameter, rank, priority)."""
    def tagged(section: str) -> Column:
        return F.transform(f"document.{section}", lambda x: F.struct(
            F.lit(section).alias("section"), x["feature"].alias("feature"), x["parameter"].alias("parameter"),
            x["rank"].alias("rank"), x["priority"].alias("priority")))

    parts = [tagged(s) for s in SECTIONS]
    return rows.select(*keys, F.inline(F.concat(*parts)))


def findings_by_join(df: DataFrame, rules_df: DataFrame, columns: Sequence[str],
                     keys: Sequence[str] = ("obs_id",)) -> DataFrame:
    """JOIN-8: melt measurements, broadcast equi-join on column, residual threshold test.

    Returns un-elevated findings (``base`` priority); elevation needs the
    per-row count, which the in-row path has for free.
    """
    long = melt(df, columns, keys, name="column", value="value").where(F.col("value").isNotNull())
    crit = F.coalesce(F.col("critical"),
                      F.when(F.col("direction") == "above", F.col("limit") * 2.0))
    j = long.join(F.broadcast(rules_df), "column")
    below = F.col("direction") == "below"
    abnormal = F.when(below, F.col("value") < F.col("limit")).otherwise(F.col("value") > F.col("limit"))
    is_crit = F.coalesce(F.when(below, F.col("value") < crit).otherwise(F.col("value") > crit), F.lit(False))
    return (j.where(abnormal)
             .select(*keys, "parameter", "kind", "value", "limit", is_crit.alias("is_critical"),
                     F.when(is_crit, F.col("critical_priority")).otherwise(F.col("base_priority")).alias("base")))


def fleet_summary(findings: DataFrame, keys: Sequence[str] = ("state", "month", "priority")) -> DataFrame:
    """RUL-9: findings and affected observations per state, month and priority."""
    return findings.groupBy(*keys).agg(F.count(F.lit(1)).alias("findings"),
                                       F.countDistinct("obs_id").alias("observations"))


# FIXED VALUES: phrases that claim a cause, which no output may contain.
CAUSAL_PHRASES = ("caused by", "proven source", "culprit", "guilty factory", "proves contamination origin")


class CausalWordingError(ValueError):
    """A text claims a cause."""


def rule_texts(rules=dims.RULES) -> list[tuple[str, str, str]]:
    """(parameter, kind, text) of every text that the rules can put out."""
    return [(r[0], r[2], t) for r in rules for t in ACTIONS.get((r[0], r[2]), ("Review the measurement and resample",))]


def causal_wording(texts: DataFrame, column: str, source: str, phrases: Sequence[str] = CAUSAL_PHRASES) -> DataFrame:
    """RUL-8: (source, phrase, texts, hits) of a column of texts, a row per phrase: one aggregation, in any case of letters.

    A phrase counts where it stands as words of its own, with any white space between them.
    """
    low = F.lower(F.col(column))
    pattern = lambda p: r"(?<![\p{L}\p{N}])" + r"\s+".join(p.split()) + r"(?![\p{L}\p{N}])"
    one = texts.agg(F.count(column).alias("texts"), *[F.count_if(low.rlike(pattern(p))).alias(f"h{i}") for i, p in enumerate(phrases)])
    return one.select(F.lit(source).alias("source"), F.inline(F.array(*[
        F.struct(F.lit(p).alias("phrase"), F.col("texts"), F.col(f"h{i}").alias("hits")) for i, p in enumerate(phrases)])))


def check_wording(texts: DataFrame, column: str, source: str) -> None:
    """RUL-8: raise when a text claims a cause."""
    hits = causal_wording(texts, column, source).where("hits > 0").collect()    # a row per phrase
    if hits:
        raise CausalWordingError(f"{source}: {[(r['phrase'], r['hits']) for r in hits]}")
