"""Cleaning cases: sparse drop, fit/transform, drop_rows, protected target, impossible values."""

from pyspark.sql import functions as F

from riverlens.operators import cleaning as C
from riverlens.operators.profile import remove_invalid


def test_all_null_column_dropped(spark):
    df = spark.createDataFrame([(7.0, None), (7.5, None), (6.9, None), (7.1, None)], "ph double, extra double")
    state = C.fit_cleaning(df, ["ph"], threshold=40.0)
    assert state.dropped_columns == ["extra"]
    assert C.apply_cleaning(df, state, ["ph"]).columns == ["ph"]


def test_fit_on_train_apply_to_test(spark):
    train = spark.createDataFrame([(5.0, 2.0), (7.0, 4.0), (9.0, 6.0)], "do_mgl double, bod_mgl double")
    test = spark.createDataFrame([(None, None), (100.0, 50.0), (200.0, 60.0)], "do_mgl double, bod_mgl double")
    state = C.fit_cleaning(train, ["do_mgl", "bod_mgl"])
    out = C.apply_cleaning(test, state, ["do_mgl", "bod_mgl"]).collect()
    assert (out[0]["do_mgl"], out[0]["bod_mgl"]) == (7.0, 4.0)
    assert C.CleaningState.from_json(state.to_json()) == state


def test_drop_rows(spark):
    df = spark.createDataFrame([(7.0, 5.0), (7.1, None), (7.2, 6.0)], "ph double, do_mgl double")
    state = C.fit_cleaning(df, ["ph", "do_mgl"], strategy="drop_rows")
    assert C.apply_cleaning(df, state, ["ph", "do_mgl"]).count() == 2


def test_protected_target_kept(spark):
    df = spark.createDataFrame([(1.0, None, "a"), (None, None, None), (3.0, 4.0, None)],
                               "x double, sparse double, wqi_class string")
    state = C.fit_cleaning(df, ["x"], threshold=50.0, protected=("wqi_class",))
    assert state.dropped_columns == ["sparse"]


def test_impossible_values_removed(spark):
    df = spark.createDataFrame([(7.0, 6.5), (15.0, 5.8), (7.5, -1.0), (6.8, 7.2), (None, None)],
                               "ph double, do_mgl double")
    assert remove_invalid(df).count() == 3   # a null never counts as invalid


def test_canonical_names_prefer_full_header(spark):
    df = spark.createDataFrame([(None, 7.2, 3.0, "x"), (6.9, 7.0, None, "y")],
                               "`Potential of Hydrogen (pH)` double, pH double, BOD double, Station string")
    out = C.canonical_names(df).collect()
    assert [r["ph"] for r in out] == [7.2, 6.9] and out[0]["bod_mgl"] == 3.0 and out[0]["Station"] == "x"


def test_seeded_sample_is_stable(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("obs_id"))
    a = [r["obs_id"] for r in C.seeded_sample(df, 10).collect()]
    b = [r["obs_id"] for r in C.seeded_sample(df.repartition(7), 10).collect()]
    assert a == b and len(set(a)) == 10
