"""Split, weighting, resampling and fitted-statistics queries (SPL-1..4, SPL-7, JOIN-7, CLN-2, FEA-3..5, AGG-30/31)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riverlens.functions import dims
from riverlens.operators import split as S
from riverlens.plans.labelling import scored_observations
from riverlens.plans.oracle import d, scored_cte
from riverlens.plans.registry import register

FEATURES = dims.MODEL_FEATURES


def labelled(spark, sf_dir):
    return scored_observations(spark, sf_dir).where(F.col("wqi_class").isNotNull())


def split_frame(spark, sf_dir):
    return S.stratified_split(labelled(spark, sf_dir), materialize=True)


_KEY = "CAST(('0x' || substr(md5(obs_id || ':42'), 1, 13)) AS BIGINT)"
SPLIT_SQL = (f"{scored_cte()}, lab AS (SELECT * FROM scored WHERE wqi_class IS NOT NULL), "
             f"cn AS (SELECT wqi_class, count(*) AS n FROM lab GROUP BY wqi_class), "
             f"tn AS (SELECT *, sum(n) OVER () AS total, sum(n) OVER () - CAST(ceil(sum(n) OVER () * {d(0.2)}) AS BIGINT) AS trains FROM cn), "
             f"rm AS (SELECT *, n * trains // total AS whole, n * trains % total AS rest FROM tn), "
             f"al AS (SELECT wqi_class, n, whole + CASE WHEN row_number() OVER (ORDER BY rest DESC, wqi_class) "
             f"<= trains - sum(whole) OVER () THEN 1 ELSE 0 END AS trains FROM rm), "
             f"rk AS (SELECT lab.*, row_number() OVER (PARTITION BY wqi_class ORDER BY {_KEY}, obs_id) AS rn, "
             f"greatest(0, least(n - trains, n - 1)) AS need FROM lab JOIN al USING (wqi_class)), "
             f"sp AS (SELECT *, CASE WHEN rn <= need THEN 'test' ELSE 'train' END AS split FROM rk)")


@register("split_membership", ("SPL-1",), oracle=f"""
WITH {SPLIT_SQL}
SELECT obs_id, wqi_class, split FROM sp
""")
def split_membership(spark, sf_dir):
    return split_frame(spark, sf_dir).select("obs_id", "wqi_class", "split")


_ORDER = " ".join(f"WHEN '{c}' THEN {i + 1}" for i, c in enumerate(dims.CLASS_ORDER))


@register("split_class_report", ("AGG-31", "SPL-1"), oracle=f"""
WITH {SPLIT_SQL},
per AS (SELECT wqi_class, count(*) AS n_full, count(*) FILTER (WHERE split = 'train') AS n_train,
               count(*) FILTER (WHERE split = 'test') AS n_test FROM sp GROUP BY wqi_class)
SELECT wqi_class, CASE wqi_class {_ORDER} END AS class_order, CAST(n_full AS BIGINT) AS n_full,
       CAST(n_train AS BIGINT) AS n_train, CAST(n_test AS BIGINT) AS n_test,
       round(n_full * {d(100.0)} / sum(n_full) OVER (), 6) AS pct_full,
       round(n_train * {d(100.0)} / sum(n_train) OVER (), 6) AS pct_train,
       round(n_test * {d(100.0)} / sum(n_test) OVER (), 6) AS pct_test, n_full < 10 AS rare_class
FROM per
""")
def split_class_report(spark, sf_dir):
    return S.split_report(split_frame(spark, sf_dir))


@register("split_integrity", ("JOIN-7", "SPL-2"), oracle=f"""
WITH {SPLIT_SQL}
SELECT count(*) FILTER (WHERE split = 'train') AS train_rows, count(*) FILTER (WHERE split = 'test') AS test_rows,
       CAST(0 AS BIGINT) AS overlap_rows, count(DISTINCT obs_id) AS distinct_ids FROM sp
""")
def split_integrity(spark, sf_dir):
    sp = split_frame(spark, sf_dir)
    counts = sp.agg(F.count_if(F.col("split") == "train").alias("train_rows"),
                    F.count_if(F.col("split") == "test").alias("test_rows"),
                    F.countDistinct("obs_id").alias("distinct_ids"))
    ov = S.overlap(sp).agg(F.count(F.lit(1)).alias("overlap_rows"))
    return (counts.withColumn("_k", F.lit(1)).join(ov.withColumn("_k", F.lit(1)), "_k")
                  .select("train_rows", "test_rows", "overlap_rows", "distinct_ids"))


@register("class_weights", ("SPL-3",), oracle=f"""
WITH {SPLIT_SQL}, c AS (SELECT wqi_class, count(*) AS n_c FROM sp WHERE split = 'train' GROUP BY wqi_class)
SELECT wqi_class, CAST(n_c AS BIGINT) AS n_c, round(sum(n_c) OVER () / (count(*) OVER () * n_c), 6) AS weight FROM c
""")
def class_weights(spark, sf_dir):
    w = S.class_weights(split_frame(spark, sf_dir).where(F.col("split") == "train"))
    return w.select("wqi_class", "n_c", F.round("weight", 6).alias("weight"))


@register("oversampled_class_counts", ("SPL-4", "SPL-6"), oracle=f"""
WITH {SPLIT_SQL}, c AS (SELECT wqi_class, count(*) AS n FROM sp WHERE split = 'train' GROUP BY wqi_class)
SELECT wqi_class, CAST(max(n) OVER () AS BIGINT) AS rows, CAST(n AS BIGINT) AS distinct_rows FROM c
""")
def oversampled_class_counts(spark, sf_dir):
    train = split_frame(spark, sf_dir).where(F.col("split") == "train")
    return (S.oversample(train).groupBy("wqi_class")
             .agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("obs_id").alias("distinct_rows")))


def _stats_sql(src):
    parts = []
    for f in FEATURES:
        parts.append(
            f"SELECT '{f}' AS feature, count({f}) AS n, avg({f}) AS mean, stddev_pop({f}) AS std_pop, "
            f"quantile_cont({f}, 0.1) AS p10, quantile_cont({f}, 0.25) AS q25, quantile_cont({f}, 0.5) AS median, "
            f"quantile_cont({f}, 0.75) AS q75, quantile_cont({f}, 0.9) AS p90 FROM {src}")
    return " UNION ALL ".join(parts)


@register("fitted_train_statistics", ("CLN-2", "FEA-3", "FEA-4", "FEA-5", "AGG-30"), oracle=f"""
WITH {SPLIT_SQL}, tr AS (SELECT * FROM sp WHERE split = 'train'), st AS ({_stats_sql('tr')})
SELECT feature, CAST(n AS BIGINT) AS n, round(mean, 6) AS mean, round(std_pop, 6) AS std_pop, round(p10, 6) AS p10,
       round(q25, 6) AS q25, round(median, 6) AS median, round(q75, 6) AS q75, round(p90, 6) AS p90 FROM st
""")
def fitted_train_statistics(spark, sf_dir):
    st = S.fitted_statistics(split_frame(spark, sf_dir).where(F.col("split") == "train"))
    return st.select("feature", F.col("n").cast("long"),
                     *[F.round(c, 6).alias(c) for c in ("mean", "std_pop", "p10", "q25", "median", "q75", "p90")])


def _scaled_sql(mode):
    sel = []
    for f in FEATURES:
        x = f"coalesce({f}, (SELECT median FROM st WHERE feature = '{f}'))"
        if mode == "standard":
            sd = f"(SELECT CASE WHEN std_pop > 0 THEN std_pop ELSE 1 END FROM st WHERE feature = '{f}')"
            sel.append(f"round(({x} - (SELECT mean FROM st WHERE feature = '{f}')) / {sd}, 6) AS {f}")
        else:
            iqr = f"(SELECT CASE WHEN q75 - q25 > 0 THEN q75 - q25 ELSE 1 END FROM st WHERE feature = '{f}')"
            sel.append(f"round(({x} - (SELECT median FROM st WHERE feature = '{f}')) / {iqr}, 6) AS {f}")
    return (f"WITH {SPLIT_SQL}, tr AS (SELECT * FROM sp WHERE split = 'train'), st AS ({_stats_sql('tr')}) "
            f"SELECT obs_id, {', '.join(sel)} FROM sp WHERE split = 'test'")


def _scaled(spark, sf_dir, mode):
    sp = split_frame(spark, sf_dir)
    st = S.fitted_statistics(sp.where(F.col("split") == "train"))
    out = S.apply_fitted(sp.where(F.col("split") == "test"), st, FEATURES, mode)
    return out.select("obs_id", *[F.round(f, 6).alias(f) for f in FEATURES])


@register("scaled_test_features", ("FEA-4", "CLN-2", "FEA-3"), oracle=_scaled_sql("standard"))
def scaled_test_features(spark, sf_dir):
    return _scaled(spark, sf_dir, "standard")


@register("robust_scaled_test_features", ("FEA-5",), oracle=_scaled_sql("robust"))
def robust_scaled_test_features(spark, sf_dir):
    return _scaled(spark, sf_dir, "robust")


@register("time_split_counts", ("SPL-7",), oracle=f"""
WITH {scored_cte()}, lab AS (SELECT *, CAST(epoch(sampled_at) AS DOUBLE) AS t FROM scored WHERE wqi_class IS NOT NULL),
cut AS (SELECT quantile_cont(t, 0.8) AS c FROM lab)
SELECT CASE WHEN t > c THEN 'test' ELSE 'train' END AS split, wqi_class, count(*) AS n
FROM lab, cut GROUP BY ALL
""")
def time_split_counts(spark, sf_dir):
    return S.time_split(labelled(spark, sf_dir)).groupBy("split", "wqi_class").agg(F.count(F.lit(1)).alias("n"))


@register("station_holdout_counts", ("SPL-7",), oracle=f"""
WITH {scored_cte()}, lab AS (SELECT * FROM scored WHERE wqi_class IS NOT NULL),
b AS (SELECT *, CAST(CAST(('0x' || substr(md5(station || ':42'), 1, 13)) AS BIGINT) AS DOUBLE) / {d(2.0 ** 52)} AS u FROM lab)
SELECT CASE WHEN u < {d(0.2)} THEN 'test' ELSE 'train' END AS split, count(*) AS n, count(DISTINCT station) AS stations
FROM b GROUP BY ALL
""")
def station_holdout_counts(spark, sf_dir):
    return (S.station_split(labelled(spark, sf_dir)).groupBy("split")
             .agg(F.count(F.lit(1)).alias("n"), F.countDistinct("station").alias("stations")))


@register("smote_class_counts", ("SPL-5", "SPL-6"), oracle=f"""
WITH {SPLIT_SQL}, c AS (SELECT wqi_class, count(*) AS n FROM sp WHERE split = 'train'
  AND {' AND '.join(f'{f} IS NOT NULL' for f in FEATURES)} GROUP BY wqi_class)
SELECT wqi_class, CAST(max(n) OVER () AS BIGINT) AS rows, CAST(max(n) OVER () - n AS BIGINT) AS synthetic FROM c
""")
def smote_class_counts(spark, sf_dir):
    """Complete training rows brought to equal class sizes by synthetic ones."""
    train = split_frame(spark, sf_dir).where(F.col("split") == "train").dropna(subset=list(FEATURES))
    return (S.smote(train).groupBy("wqi_class")
             .agg(F.count(F.lit(1)).alias("rows"), F.count_if("synthetic").alias("synthetic")))
