"""Threshold rule cases (boundaries, elevation, overall priority, config swap)."""

import pytest
from pyspark.sql import functions as F

from riverlens.functions import dims
from riverlens.functions.scalars import log10_floor1
from riverlens.operators import rules as RU

COLS = ("ph", "do_mgl", "bod_mgl", "fc", "log10_fc", "turbidity", "ec", "tds", "cod_mgl", "tc", "nitrate_n")


def evaluate(spark, rows, label=None, rules=dims.RULES):
    base = {c: None for c in COLS if c != "log10_fc"}
    data = []
    for i, r in enumerate(rows):
        d = dict(base, **r)
        data.append((i, label, *[None if d[c] is None else float(d[c]) for c in base]))
    schema = "id int, wqi_class string, " + ", ".join(f"{c} double" for c in base)
    df = spark.createDataFrame(data, schema).withColumn("log10_fc", log10_floor1(F.col("fc")))
    out = RU.with_findings(df, COLS, rules).orderBy("id").collect()
    return [([(f["parameter"], f["priority"]) for f in r["findings"]], r["overall_priority"]) for r in out]


NORMAL = dict(ph=7.4, do_mgl=8, bod_mgl=1.5, fc=50, turbidity=2, ec=350, tds=220)


def test_normal_sample_has_no_finding(spark):
    assert evaluate(spark, [NORMAL]) == [([], "None")]


def test_multiple_findings_all_high(spark):
    (f, overall), = evaluate(spark, [dict(NORMAL, do_mgl=3.5, bod_mgl=5.8, fc=1500)])
    params = [p for p, _ in f]
    assert set(params) >= {"DO", "BOD", "FC"} and all(p == "High" for _, p in f) and overall == "High"


def test_single_medium_elevated_by_poor_label(spark):
    good = evaluate(spark, [dict(NORMAL, bod_mgl=4.2)], label="Good")
    poor = evaluate(spark, [dict(NORMAL, bod_mgl=4.2)], label="Poor")
    assert good == [([("BOD", "Medium")], "Medium")]
    assert poor == [([("BOD", "High")], "High")]


def test_boundaries_are_normal(spark):
    edge = dict(ph=6.5, do_mgl=5, bod_mgl=3, fc=250, turbidity=5, ec=750, tds=500, cod_mgl=10, tc=500,
                nitrate_n=10)
    assert evaluate(spark, [edge, dict(edge, ph=8.5)]) == [([], "None"), ([], "None")]


@pytest.mark.parametrize("change,param", [(dict(bod_mgl=3.01), "BOD"), (dict(do_mgl=4.99), "DO"),
                                          (dict(ph=6.49), "pH"), (dict(ph=8.51), "pH")])
def test_just_outside(spark, change, param):
    (f, _), = evaluate(spark, [dict(NORMAL, **change)])
    assert [p for p, _ in f] == [param]


def test_config_swap(spark):
    swapped = tuple(r if r[0] != "BOD" else (r[0], r[1], r[2], r[3], 1.0, r[5], r[6], r[7], r[8])
                    for r in dims.RULES)
    (f, _), = evaluate(spark, [NORMAL], rules=swapped)
    assert [p for p, _ in f] == ["BOD"]


def test_fc_and_log_fc_both_fire(spark):
    (f, overall), = evaluate(spark, [dict(NORMAL, fc=3000)])
    assert [p for p, _ in f] == ["FC", "Log10_FC"] and overall == "High"


def test_long_form_and_join_agree(spark):
    from riverlens.sources.feeds import thresholds_frame
    rows = [dict(NORMAL, do_mgl=3.5), dict(NORMAL, ph=9.9, tds=2500)]
    base = {c: None for c in COLS if c != "log10_fc"}
    data = [(str(i), *[None if dict(base, **r)[c] is None else float(dict(base, **r)[c]) for c in base])
            for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "obs_id string, " + ", ".join(f"{c} double" for c in base))
    df = df.withColumn("log10_fc", log10_floor1(F.col("fc"))).withColumn("wqi_class", F.lit(None).cast("string"))
    a = sorted((r["obs_id"], r["parameter"], r["base"]) for r in RU.findings_long(RU.with_findings(df, COLS)).collect())
    b = sorted((r["obs_id"], r["parameter"], r["base"])
               for r in RU.findings_by_join(df, thresholds_frame(spark), COLS).collect())
    assert a == b


def test_wording_discipline(spark):
    """RUL-8: recommendations describe checks, never assert a cause."""
    texts = spark.createDataFrame(RU.rule_texts(), "parameter string, kind string, t string")
    scan = RU.causal_wording(texts, "t", "rules").collect()
    assert {r["phrase"] for r in scan} == set(RU.CAUSAL_PHRASES) and all(r["hits"] == 0 and r["texts"] >= 15 for r in scan)
    RU.check_wording(texts, "t", "rules")
    planted = spark.createDataFrame([("It was Caused\n by algae",), ("the culprit!",), ("culprits",), ("because",), (None,)], "t string")
    hits = {r["phrase"]: r["hits"] for r in RU.causal_wording(planted, "t", "planted").collect()}
    assert hits["caused by"] == 1 and hits["culprit"] == 1 and sum(hits.values()) == 2
    with pytest.raises(RU.CausalWordingError, match="culprit"):
        RU.check_wording(planted, "t", "planted")


def test_text_helpers(spark):
    from riverlens.functions.scalars import normalise_text, slug
    r = spark.range(1).select(slug(F.lit("  Dissolved Oxygen (mg/L) ")).alias("s"),
                              normalise_text(F.lit("  BOD ")).alias("n")).first()
    assert r["s"] == "dissolved_oxygen_mg_l_" and r["n"] == "bod"


def test_disagreement_needs_no_array_of_findings(spark):
    """The rows are told apart by plain columns; a frame with the array alone gives the same rows."""
    from riverlens.operators import rules as RU
    from riverlens.operators import scoring as SC
    rows = [("a", 7.0, 8.0, 1.0, 10.0, "Poor"), ("b", 3.0, 8.0, 1.0, 10.0, "Poor"), ("c", 7.0, 8.0, 1.0, 10.0, "Good"),
            ("d", 7.0, None, float("nan"), 10.0, "Unsuitable"), ("e", 7.0, 1.0, 30.0, 1e6, "Very Poor"), ("f", 7.0, 8.0, 1.0, 10.0, None)]
    df = spark.createDataFrame(rows, "obs_id string, ph double, do_mgl double, bod_mgl double, fc double, wqi_class string")
    found = RU.with_findings(df, ("ph", "do_mgl", "bod_mgl", "fc"))
    out = SC.rule_label_disagreement(found)
    assert sorted(tuple(r) for r in out.collect()) == [("a", "Poor"), ("d", "Unsuitable")]
    assert "lambda" not in out._jdf.queryExecution().optimizedPlan().toString()
    array = SC.rule_label_disagreement(found.drop(*RU.finding_columns(found)))
    assert sorted(tuple(r) for r in array.collect()) == [("a", "Poor"), ("d", "Unsuitable")]
