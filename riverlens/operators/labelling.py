"""Labelling: score, split valid / quarantine, class and score reports.

Scoring is a narrow projection.  The reports are single global
aggregations (partial aggregates per task, one tiny final merge), so no
row is ever shuffled; the five-class table is produced from one aggregate
row with ``inline`` so classes with no rows still appear with zero.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverlens.functions import dims
from riverlens.functions.index import contribution_columns, present_parameters, with_index
from riverlens.operators.quantiles import exact_quantiles

REPORT_DIGITS = 6


def r(c, digits: int = REPORT_DIGITS):
    """Round a report double (raw doubles stay unrounded inside)."""
    return F.round(c, digits)


def score(df: DataFrame, min_parameters: int = dims.MIN_PARAMETERS) -> DataFrame:
    """WQI-1..4: n_params, wqi_score, wqi_class, potability."""
    return with_index(df, min_parameters)


def split_labelled(scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """WQI-5: (labelled, quarantine) from one scored plan."""
    ok = F.col("wqi_score").isNotNull()
    return scored.where(ok), scored.where(~ok)


def class_report(scored: DataFrame, classes=dims.CLASSES) -> DataFrame:
    """AGG-4: counts and shares over all classes, zeros included, fixed order."""
    aggs = [F.count_if(F.col("wqi_class") == label).alias(f"_c{i}")
            for i, (label, *_rest) in enumerate(classes)]
    aggs.append(F.count_if(F.col("wqi_score").isNotNull()).alias("_total"))
    one = scored.agg(*aggs)
    items = F.array(*[
        F.struct(F.lit(label).alias("wqi_class"), F.lit(i + 1).alias("class_order"),
                 F.lit(cat).alias("category"), F.lit(rng).alias("wqi_range"),
                 F.lit(pot).alias("binary_potability"), F.col(f"_c{i}").alias("n"))
        for i, (label, _upper, cat, rng, pot) in enumerate(classes)])
    total = F.col("_total")
    return (one.select(total, F.inline(items))
               .select("wqi_class", "class_order", "category", "wqi_range", "binary_potability",
                       F.col("n").cast("long").alias("n"),
                       r(F.when(total > 0, F.col("n") * 100.0 / total).otherwise(0.0)).alias("percentage")))


def label_summary(scored: DataFrame) -> DataFrame:
    """AGG-5, AGG-6, AGG-7: totals, potable share, mean / median score, imbalance."""
    s = F.col("wqi_score")
    class_counts = [F.count_if(F.col("wqi_class") == c).alias(f"_c{i}")
                    for i, c in enumerate(dims.CLASS_ORDER)]
    base = scored.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count(s).alias("labelled_records"),
        F.count_if(s.isNull()).alias("quarantined_records"),
        F.count_if(F.col("potability") == 1).alias("potable_count"),
        F.count_if(F.col("potability") == 0).alias("non_potable_count"),
        F.avg(s).alias("_mean"),
        *class_counts,
    )
    median = (exact_quantiles(scored.select("wqi_score"), "wqi_score", [0.5])
              .select(F.col("quantile").alias("_median")))
    lab = F.col("labelled_records")
    shares = [F.when(lab > 0, F.col(f"_c{i}") * 100.0 / lab).otherwise(0.0)
              for i in range(len(dims.CLASS_ORDER))]
    top = F.greatest(*shares)
    dominant = F.coalesce(*[F.when(sh == top, F.lit(c)) for sh, c in zip(shares, dims.CLASS_ORDER)])
    # both sides are single aggregate rows: a constant-key join lines them up
    joined = base.withColumn("_k", F.lit(1)).join(median.withColumn("_k", F.lit(1)), "_k", "left")
    return joined.select(
        "total_records", "labelled_records", "quarantined_records", "potable_count",
        "non_potable_count",
        r(F.when(lab > 0, F.col("potable_count") * 100.0 / lab).otherwise(0.0)).alias("potable_percentage"),
        r(F.col("_mean")).alias("mean_wqi"),
        r(F.col("_median")).alias("median_wqi"),
        r(top).alias("dominant_percentage"),
        dominant.alias("dominant_class"),
        (top > dims.SEVERE_IMBALANCE_PCT).alias("severely_imbalanced"),
    )


def contributions(scored: DataFrame, keys=("obs_id",)) -> DataFrame:
    """WQI-6: long form of each present parameter's share of the score.

    contribution = q_i * w_i / sum(w) so the contributions of a labelled
    row add up to its score.  Built in-row (array + inline): no shuffle.
    """
    params = present_parameters(scored.columns)
    arr = contribution_columns(params)
    sum_w = F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x["weight"])
    return (scored.where(F.col("wqi_score").isNotNull())
                  .select(*keys, "wqi_score", sum_w.alias("_sw"), F.inline(arr))
                  .select(*keys, "parameter", "value", "sub_index", "weight",
                          (F.col("sub_index") * F.col("weight") / F.col("_sw")).alias("contribution"),
                          "wqi_score"))
