"""The leakage audit on planted leaks, and limits from the training rows."""

import pytest
from pyspark.sql import functions as F

from riverlens.functions.scalars import log10_floor1
from riverlens.operators import models as MD
from riverlens.operators import split as S

COLS = "obs_id string, wqi_class string, ph double, do_mgl double, bod_mgl double, fc double"


@pytest.fixture(scope="module")
def raw(spark):
    rows = [(f"r{k}", "Good" if k % 3 else "Poor", 6.0 + k / 50, 5.0 + k % 4, None if k % 7 == 0 else k / 9, 10.0 * k) for k in range(90)]
    return spark.createDataFrame(rows, COLS).coalesce(2)


@pytest.fixture(scope="module")
def split(raw):
    return S.stratified_split(raw, materialize=True).withColumn("log10_fc", log10_floor1(F.col("fc"))).cache()


def failed(audit):
    return {r["item"]: r["violations"] for r in audit.collect() if r["status"] == "FAIL"}


def test_clean_split_passes_and_a_leak_of_each_kind_fails(raw, split):
    stats = S.fitted_statistics(split.where("split = 'train'")).cache()
    assert failed(S.leakage_audit(split, MD.FEATURES, stats, raw)) == {}
    # statistics of all rows, of other rows of the same number, and a missing row
    assert failed(S.leakage_audit(split, MD.FEATURES, S.fitted_statistics(split), raw)) == {2: 4}
    shifted = stats.withColumn("median", F.when(F.col("feature") == "ph", F.col("median") + 1e-3).otherwise(F.col("median")))
    assert failed(S.leakage_audit(split, MD.FEATURES, shifted, raw)) == {2: 1}
    assert failed(S.leakage_audit(split, MD.FEATURES, stats.where("feature <> 'fc'"), raw)) == {2: 1}
    # a value from another row: the statistics of these train rows are right, the row is not
    moved = split.withColumn("do_mgl", F.when(F.col("obs_id") == "r5", F.col("do_mgl") + 1).otherwise(F.col("do_mgl")))
    found = failed(S.leakage_audit(moved, MD.FEATURES, S.fitted_statistics(moved.where("split = 'train'")), raw))
    assert found == {7: 1}
    # a row that has no raw measurements at all: its five values have no source
    found = failed(S.leakage_audit(split, MD.FEATURES, stats, raw.where("obs_id <> 'r8'")))
    assert found == {7: 5}
    with pytest.raises(S.DataLeakageError, match="beyond the train rows"):
        S.leakage_audit(split, MD.FEATURES, shifted, raw, raise_on_fail=True)


def test_fallback_limits_are_labelled_and_train_only(spark):
    rows = [(f"r{k}", float(k), float(-k), 1.0, None) for k in range(101)]
    df = spark.createDataFrame(rows, "obs_id string, load double, oxygen double, known double, empty double")
    limits = S.fallback_limits(df.where("load <= 100"), ("load", "oxygen", "known", "empty"), ("known",), ("oxygen",))
    got = {r["feature"]: r for r in limits.collect()}
    assert set(got) == {"load", "oxygen"} and not any(r["regulatory"] for r in got.values())
    assert (got["load"]["direction"], got["load"]["limit"]) == ("above", 90.0)
    assert (got["oxygen"]["direction"], got["oxygen"]["limit"]) == ("below", -90.0)
    assert got["load"]["standard_type"] == "Empirical Statistical Fallback (P90 of Training Baseline)"
    found = S.beyond_fallback(df, limits, ("load", "oxygen", "known", "empty")).groupBy("feature").count().collect()
    assert {r["feature"]: r["count"] for r in found} == {"load": 10, "oxygen": 10}


@pytest.fixture
def no_small_joins(spark):
    """As on tables whose sizes Spark does not know: no join is broadcast unless the code says so."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def largest_part(df):
    return df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]


def test_no_task_takes_a_whole_class(spark, no_small_joins):
    df = spark.range(0, 4000, numPartitions=16).select(
        F.concat(F.lit("r"), "id").alias("obs_id"), F.when(F.col("id") % 40 == 0, "Poor").otherwise("Good").alias("wqi_class"),
        *[(F.col("id") * k % 97).cast("double").alias(f) for k, f in ((3, "ph"), (5, "do_mgl"), (7, "bod_mgl"), (11, "fc"))])
    split = S.stratified_split(df, materialize=True)
    assert split.count() == 4000 and split.where("split = 'test'").count() == 800
    assert largest_part(split) < 1000          # before: 3,998
    more = S.oversample(df)
    assert more.where("wqi_class = 'Poor'").count() == 3900 and largest_part(more) < 2500
    made = S.smote(df).where("synthetic")
    assert made.count() == 3800 and largest_part(made) < 2500
