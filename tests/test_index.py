"""Hand-computed index cases and class boundaries."""

import math

import pytest
from pyspark.sql import types as T

from riverlens.operators import labelling as L

SCHEMA = T.StructType([T.StructField(c, T.DoubleType()) for c in ("ph", "do_mgl", "bod_mgl", "fc")])


def score_rows(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return [r.asDict() for r in L.score(df).collect()]


def test_golden_scores(spark):
    out = score_rows(spark, [
        (7.0, 14.6, 0.0, None),
        (8.5, 5.0, 3.0, 250.0),
        (7.6, 6.8, 2.1, 120.0),
        (7.8, 6.3, 2.6, 4.0),
        (7.0, 14.6, 3.0, None),
        (7.0, 14.6, None, None),
        (None, None, None, None),
    ])
    assert out[0]["wqi_score"] == pytest.approx(0.0) and out[0]["wqi_class"] == "Excellent"
    assert out[0]["potability"] == 1
    assert out[1]["wqi_score"] == pytest.approx(100.0) and out[1]["wqi_class"] == "Very Poor"
    assert out[1]["potability"] == 0
    assert out[2]["wqi_score"] == pytest.approx(67.912, abs=1e-3) and out[2]["wqi_class"] == "Poor"
    assert out[3]["wqi_score"] == pytest.approx(80.096238, abs=1e-6) and out[3]["wqi_class"] == "Very Poor"
    expected = 100 * (1 / 3) / (1 / 8.5 + 1 / 5 + 1 / 3)
    assert out[4]["wqi_score"] == pytest.approx(expected)
    assert out[5]["wqi_score"] is None and out[5]["wqi_class"] is None  # two parameters: quarantine
    assert out[6]["wqi_score"] is None and out[6]["n_params"] == 0


@pytest.mark.parametrize("ph,q", [(7.0, 0), (8.5, 100), (7.75, 50), (6.5, 100), (6.75, 50), (5.0, 400)])
def test_ph_sub_index(spark, ph, q):
    from pyspark.sql import functions as F
    from riverlens.functions.dims import PARAMETER_BY_CODE
    from riverlens.functions.index import sub_index
    v = spark.range(1).select(sub_index(PARAMETER_BY_CODE["pH"], F.lit(ph)).alias("q")).first()["q"]
    assert v == pytest.approx(q)


@pytest.mark.parametrize("code,val,q", [("DO", 14.6, 0), ("DO", 5.0, 100), ("DO", 0.0, 152.0833333),
                                        ("BOD", 3.0, 100), ("BOD", 6.0, 200), ("EC", 750.0, 100)])
def test_other_sub_indices(spark, code, val, q):
    from pyspark.sql import functions as F
    from riverlens.functions.dims import PARAMETER_BY_CODE
    from riverlens.functions.index import sub_index
    v = spark.range(1).select(sub_index(PARAMETER_BY_CODE[code], F.lit(val)).alias("q")).first()["q"]
    assert v == pytest.approx(q, abs=1e-6)


EDGES = [(0, "Excellent"), (15, "Excellent"), (25, "Excellent"), (25.0001, "Good"), (50, "Good"),
         (50.0001, "Poor"), (75, "Poor"), (75.0001, "Very Poor"), (100, "Very Poor"),
         (100.0001, "Unsuitable"), (500, "Unsuitable"), (-3, "Excellent"), (float("nan"), None)]


def test_class_edges(spark):
    from pyspark.sql import functions as F
    from riverlens.functions.index import class_label, usable
    df = spark.createDataFrame([(float(s),) for s, _ in EDGES], "s double")
    got = [r["c"] for r in df.select(class_label(usable(F.col("s"))).alias("c")).collect()]
    assert got == [c for _, c in EDGES]


def test_short_and_nan_are_missing(spark):
    out = score_rows(spark, [(7.0, float("nan"), 3.0, None)])
    assert out[0]["n_params"] == 2 and out[0]["wqi_score"] is None
    assert not math.isnan(out[0]["n_params"])
