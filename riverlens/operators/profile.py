"""Profiling: moments, exact quantiles, outliers, correlations, crosstabs, histograms.

All column statistics are computed in one aggregation over the wide table
(never a job per column).  Quantiles go through the range-partitioned
ranking in ``quantiles`` so no group's values are gathered in one task.
Per-feature parameter tables (quantile fences, histogram ranges) have one
row per feature: their size is fixed by the schema, not the data, and they
are broadcast back to the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riverlens.functions import dims
from riverlens.functions.scalars import no_nan
from riverlens.operators.quantiles import exact_quantiles, melt, quantiles_wide
from riverlens.session import written

R = 6


def r(c: Column) -> Column:
    return F.round(c, R)


def _corrected_skew(g1: Column, n: Column) -> Column:
    """Bias-corrected sample skewness G1 from the population g1."""
    return F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def _corrected_kurt(g2: Column, n: Column) -> Column:
    """Bias-corrected excess kurtosis G2 from the population excess g2."""
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))


def summary_statistics(df: DataFrame, features: Sequence[str] = dims.MODEL_FEATURES) -> DataFrame:
    """AGG-9 / AGG-10: count, missing, mean, sample std, min, quartiles, max, IQR, G1, G2."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(features):
        v = no_nan(F.col(c))
        aggs += [F.count(v).alias(f"n{i}"), F.avg(v).alias(f"mean{i}"),
                 F.stddev_samp(v).alias(f"std{i}"), F.min(v).alias(f"min{i}"),
                 F.max(v).alias(f"max{i}"), F.skewness(v).alias(f"g1_{i}"),
                 F.kurtosis(v).alias(f"g2_{i}")]
    one = df.agg(*aggs)
    arr = F.array(*[F.struct(
        F.lit(c).alias("feature"), F.lit(i).alias("feature_order"), F.col(f"n{i}").alias("count"),
        F.col(f"mean{i}").alias("mean"), F.col(f"std{i}").alias("std"), F.col(f"min{i}").alias("min"),
        F.col(f"max{i}").alias("max"), F.col(f"g1_{i}").alias("g1"), F.col(f"g2_{i}").alias("g2"))
        for i, c in enumerate(features)])
    moments = one.select("_rows", F.inline(arr))
    quart = quantiles_wide(df, features, [0.25, 0.5, 0.75], names=["q25", "median", "q75"])
    n = F.col("count").cast("double")
    out = moments.join(F.broadcast(quart), "feature", "left")
    return out.select(
        "feature", "feature_order", F.col("count").cast("long").alias("count"),
        (F.col("_rows") - F.col("count")).cast("long").alias("missing_count"),
        r(F.when(F.col("_rows") > 0, (F.col("_rows") - F.col("count")) * 100.0 / F.col("_rows"))).alias("missing_pct"),
        r(F.col("mean")).alias("mean"), r(F.col("std")).alias("std"), r(F.col("min")).alias("min"),
        r(F.col("q25")).alias("q25"), r(F.col("median")).alias("median"), r(F.col("q75")).alias("q75"),
        r(F.col("max")).alias("max"), r(F.col("q75") - F.col("q25")).alias("iqr"),
        r(_corrected_skew(F.col("g1"), n)).alias("skewness"),
        r(_corrected_kurt(F.col("g2"), n)).alias("kurtosis"))


def outlier_audit(df: DataFrame, features: Sequence[str] = dims.MODEL_FEATURES) -> DataFrame:
    """AGG-11 / AGG-29: 1.5xIQR and 3xIQR fences (strict), |z| > 3; rows are kept."""
    long = melt(df, features)
    fences = quantiles_wide(df, features, [0.25, 0.75], names=["q25", "q75"])
    moments = long.groupBy("feature").agg(F.avg("value").alias("mu"), F.stddev_samp("value").alias("sd"),
                                          F.count("value").alias("n"))
    params = fences.join(moments, "feature")
    v = F.col("value")
    iqr = F.col("q75") - F.col("q25")
    hit = long.where(v.isNotNull()).join(F.broadcast(params), "feature")
    out = hit.groupBy("feature").agg(
        F.first("n").alias("n"), F.first("q25").alias("q25"), F.first("q75").alias("q75"),
        F.count_if((v < F.col("q25") - 1.5 * iqr) | (v > F.col("q75") + 1.5 * iqr)).alias("iqr15"),
        F.count_if((v < F.col("q25") - 3.0 * iqr) | (v > F.col("q75") + 3.0 * iqr)).alias("iqr30"),
        F.count_if((F.col("sd") > 0) & (F.abs((v - F.col("mu")) / F.col("sd")) > 3.0)).alias("z3"))
    pct = lambda c: r(F.when(F.col("n") > 0, F.col(c) * 100.0 / F.col("n")).otherwise(0.0))
    q25, q75 = F.col("q25"), F.col("q75")
    return out.select(
        "feature", F.col("n").cast("long").alias("n"),
        r(q25 - 1.5 * (q75 - q25)).alias("lower_fence"), r(q75 + 1.5 * (q75 - q25)).alias("upper_fence"),
        F.col("iqr15").cast("long").alias("iqr_outliers"), pct("iqr15").alias("iqr_outlier_pct"),
        F.col("iqr30").cast("long").alias("extreme_outliers"), pct("iqr30").alias("extreme_outlier_pct"),
        F.col("z3").cast("long").alias("z_outliers"), pct("z3").alias("z_outlier_pct"))


def invalid_mask(bounds: dict[str, tuple[float, float]]) -> dict[str, Column]:
    """Per-feature physically-impossible test; a null or NaN never counts as invalid."""
    return {c: F.coalesce((no_nan(F.col(c)) < lo) | (no_nan(F.col(c)) > hi), F.lit(False)) for c, (lo, hi) in bounds.items()}


def invalid_counts(df: DataFrame, bounds=dims.CLEANING_BOUNDS) -> DataFrame:
    """AGG-12: invalid count per feature and rows with any invalid value."""
    masks = invalid_mask({c: b for c, b in bounds.items() if c in df.columns})
    any_bad = None
    for m in masks.values():
        any_bad = m if any_bad is None else (any_bad | m)
    one = df.agg(*[F.count_if(m).alias(f"_b{i}") for i, m in enumerate(masks.values())],
                 F.count_if(any_bad).alias("_any"), F.count(F.lit(1)).alias("_n"))
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"_b{i}").alias("invalid"))
                    for i, c in enumerate(masks)],
                  F.struct(F.lit("any").alias("feature"), F.col("_any").alias("invalid")))
    return one.select("_n", F.inline(arr)).select(
        "feature", F.col("invalid").cast("long").alias("invalid"), F.col("_n").cast("long").alias("rows"))


def remove_invalid(df: DataFrame, bounds=dims.CLEANING_BOUNDS, enabled: bool = True) -> DataFrame:
    """FLT-1: drop physically impossible rows (pushed down as a plain filter)."""
    if not enabled:
        return df
    return df.where(~any_invalid(df, bounds))


def any_invalid(df: DataFrame, bounds=dims.CLEANING_BOUNDS) -> Column:
    """Whether a row holds a physically impossible value."""
    cond = F.lit(False)
    for m in invalid_mask({c: b for c, b in bounds.items() if c in df.columns}).values():
        cond = cond | m
    return cond


def class_loss(df: DataFrame, kept: Column, label: str = "wqi_class", flag_pct: float = 10.0) -> DataFrame:
    """AGG-13: per-class rows of ``df`` and of its ``kept`` rows, loss share, flag above 10%; one scan."""
    one = df.agg(*[F.count_if(F.col(label) == c).alias(f"b{i}") for i, c in enumerate(dims.CLASS_ORDER)],
                 *[F.count_if((F.col(label) == c) & kept).alias(f"a{i}") for i, c in enumerate(dims.CLASS_ORDER)])
    arr = F.array(*[F.struct(F.lit(c).alias(label), F.lit(i + 1).alias("class_order"),
                             F.col(f"b{i}").alias("before"), F.col(f"a{i}").alias("after"))
                    for i, c in enumerate(dims.CLASS_ORDER)])
    loss = F.when(F.col("before") > 0, (F.col("before") - F.col("after")) * 100.0 / F.col("before")).otherwise(0.0)
    return one.select(F.inline(arr)).select(
        label, "class_order", F.col("before").cast("long").alias("before"),
        F.col("after").cast("long").alias("after"), r(loss).alias("loss_pct"), (loss > flag_pct).alias("loss_flag"))


def class_distribution(df: DataFrame, label: str = "wqi_class") -> DataFrame:
    """AGG-8: classes present (nulls excluded), share, logical order when labels are the five."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    order = F.coalesce(*[F.when(F.col(label) == c, F.lit(i + 1)) for i, c in enumerate(dims.CLASS_ORDER)])
    tot = F.sum("n").over(Window.partitionBy())  # window over the handful of class rows
    return counts.select(label, F.col("n").cast("long").alias("n"), r(F.col("n") / tot).alias("share"),
                         order.alias("class_order"))


def crosstab_percent(df: DataFrame, row: str, label: str = "wqi_class",
                     classes: Sequence[str] = dims.CLASS_ORDER, only_present: bool = False) -> DataFrame:
    """AGG-14 / AGG-15: row-normalised row x class percentages in long form.

    One aggregation per row key with a conditional count per class, then
    melted in-row, so classes absent from a row still get 0.  With
    ``only_present`` classes that never occur are dropped (pandas crosstab).
    """
    base = df.where(F.col(row).isNotNull() & F.col(label).isNotNull())
    agg = base.groupBy(row).agg(*[F.count_if(F.col(label) == c).alias(f"_c{i}") for i, c in enumerate(classes)])
    tot = sum((F.col(f"_c{i}") for i in range(len(classes))), F.lit(0))
    arr = F.array(*[F.struct(F.lit(c).alias(label), F.lit(i + 1).alias("class_order"),
                             F.col(f"_c{i}").alias("n")) for i, c in enumerate(classes)])
    out = agg.select(row, tot.alias("_t"), F.inline(arr)).select(
        row, label, "class_order", F.col("n").cast("long").alias("n"),
        r(F.when(F.col("_t") > 0, F.col("n") * 100.0 / F.col("_t")).otherwise(0.0)).alias("pct"))
    if only_present:
        out = (out.withColumn("_ct", F.sum("n").over(Window.partitionBy(label)))
                  .where(F.col("_ct") > 0).drop("_ct"))
    return out


def state_overview(df: DataFrame) -> DataFrame:
    """AGG-16: observations and distinct stations per state, plus all states (scope 'all')."""
    return (df.rollup("state").agg(F.grouping_id().alias("_all"), F.count(F.lit(1)).alias("observations"),
                                   F.countDistinct("station").alias("stations"))
              .select("state", F.when(F.col("_all") == 1, "all").otherwise("state").alias("scope"),
                      F.col("observations").cast("long"), F.col("stations").cast("long")))


def _pairs(features):
    return [(a, b) for i, a in enumerate(features) for b in features[i + 1:]]


def pearson_matrix(df: DataFrame, features: Sequence[str] = dims.MODEL_FEATURES) -> DataFrame:
    """AGG-17: pairwise-complete Pearson r, full symmetric long form, one aggregation."""
    features = list(features)
    pairs = _pairs(features)
    one = df.agg(*[F.corr(a, b).alias(f"_p{i}") for i, (a, b) in enumerate(pairs)])
    items = []
    for i, (a, b) in enumerate(pairs):
        items.append(F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(f"_p{i}").alias("r")))
        items.append(F.struct(F.lit(b).alias("feature_a"), F.lit(a).alias("feature_b"), F.col(f"_p{i}").alias("r")))
    for a in features:
        items.append(F.struct(F.lit(a).alias("feature_a"), F.lit(a).alias("feature_b"), F.lit(1.0).alias("r")))
    return one.select(F.inline(F.array(*items))).select("feature_a", "feature_b", r(F.col("r")).alias("r"))


def spearman_matrix(df: DataFrame, features: Sequence[str] = dims.MODEL_FEATURES) -> DataFrame:
    """AGG-18: pairwise-complete Spearman rho with average ranks on ties.

    For each pair the rows complete on both sides are ranked separately (as
    pandas does).  Rows collapse to distinct (pair, x, y) with counts first,
    so neither a frequent value nor the join of the ranks meets the rows.  The
    points meet the ranks of one side only: the sum of products goes by the
    distinct values of the other, whose rank multiplies what its points add up to.
    """
    features = list(features)
    pairs = _pairs(features)
    rows = []
    for i, (a, b) in enumerate(pairs):
        both = F.col(a).isNotNull() & F.col(b).isNotNull() & ~F.isnan(a) & ~F.isnan(b)
        rows.append(F.struct(F.lit(i).alias("pair"), F.when(both, F.col(a).cast("double")).alias("x"),
                             F.when(both, F.col(b).cast("double")).alias("y")))
    long = df.select(F.inline(F.array(*rows))).where(F.col("x").isNotNull())     # plain columns: generated code
    points = written(long.groupBy("pair", "x", "y").agg(F.count(F.lit(1)).alias("w")), "rank-points")

    def deviations(values: DataFrame, side: str) -> DataFrame:
        """``values`` (pair, side, cnt) with ``d``: the average rank less the mean rank (n + 1) / 2, which keeps sums small."""
        parts = written(values.repartitionByRange("pair", side).withColumn("_b", F.spark_partition_id()), "rank-values")
        upto = Window.partitionBy("pair").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        offsets = (parts.groupBy("pair", "_b").agg(F.sum("cnt").alias("_t"))
                   .select("pair", "_b", F.coalesce(F.sum("_t").over(upto), F.lit(0)).alias("_off"),
                           F.sum("_t").over(Window.partitionBy("pair")).alias("_n")))
        inside = Window.partitionBy("pair", "_b").orderBy(side).rowsBetween(Window.unboundedPreceding, -1)
        rank = F.col("_off") + F.coalesce(F.sum("cnt").over(inside), F.lit(0)) + (F.col("cnt") + 1) / 2.0
        return parts.join(offsets, ["pair", "_b"]).withColumn("d", rank - (F.col("_n") + 1) / 2.0).drop("_b", "_off", "_n")

    xs = deviations(points.groupBy("pair", "x").agg(F.sum("w").alias("cnt")), "x").select("pair", "x", "d")
    ys = deviations(points.join(xs, ["pair", "x"]).groupBy("pair", "y").agg(
        F.sum("w").alias("cnt"), F.sum(F.col("w") * F.col("d")).alias("_x"),
        F.sum(F.col("w") * F.col("d") * F.col("d")).alias("_xx")), "y")
    rho = ys.groupBy("pair").agg((F.sum(F.col("d") * F.col("_x")) / F.sqrt(
        F.sum("_xx") * F.sum(F.col("cnt") * F.col("d") * F.col("d")))).alias("rho"))
    names = F.array(*[F.struct(F.lit(i).alias("pair"), F.lit(a).alias("a"), F.lit(b).alias("b"))
                      for i, (a, b) in enumerate(pairs)])
    spark = df.sparkSession
    dim = spark.range(1).select(F.inline(names))
    named = rho.join(F.broadcast(dim), "pair")
    sym = named.select(F.col("a").alias("feature_a"), F.col("b").alias("feature_b"), "rho").unionByName(
        named.select(F.col("b").alias("feature_a"), F.col("a").alias("feature_b"), "rho"))
    diag = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("feature_a"), F.lit(a).alias("feature_b"), F.lit(1.0).alias("rho"))
        for a in features])))
    return sym.unionByName(diag).select("feature_a", "feature_b", r(F.col("rho")).alias("rho"))


def redundant_pairs(corr_long: DataFrame, threshold: float = 0.85, value: str = "r") -> DataFrame:
    """AGG-19: upper-triangle pairs with |r| strictly above the threshold."""
    return (corr_long.where((F.col("feature_a") < F.col("feature_b")) & (F.abs(F.col(value)) > threshold))
                     .select("feature_a", "feature_b", F.col(value).alias("correlation"),
                             F.abs(F.col(value)).alias("abs_correlation")))


def five_number_by_class(df: DataFrame, features: Sequence[str] = dims.MODEL_FEATURES,
                         label: str = "wqi_class") -> DataFrame:
    """AGG-20: min, q25, median, q75, max per feature x class (box-plot numbers)."""
    q = quantiles_wide(df.where(F.col(label).isNotNull()), features, [0.0, 0.25, 0.5, 0.75, 1.0],
                       keys=[label], names=["min", "q25", "median", "q75", "max"])
    return q.select(label, "feature", *[r(F.col(c)).alias(c) for c in ("min", "q25", "median", "q75", "max")])


def histogram(df: DataFrame, features: Sequence[str] = dims.MODEL_FEATURES, bins: int = 30,
              single_bin_when_constant: bool = False) -> DataFrame:
    """AGG-21 / AGG-22: equal-width bins from min to max, top edge folded in, zeros kept.

    The per-feature range table (one row per feature) is broadcast back;
    every bin of every feature is emitted, empty ones with 0.
    """
    long = melt(df, features).where(F.col("value").isNotNull() & ~F.isnan("value"))
    rng = long.groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    nb = F.when(F.col("hi") == F.col("lo"), F.lit(1 if single_bin_when_constant else bins)).otherwise(F.lit(bins))
    rng = rng.withColumn("nbins", nb).withColumn("width", (F.col("hi") - F.col("lo")) / F.col("nbins"))
    idx = F.when(F.col("width") > 0,
                 F.least(F.col("nbins") - 1, F.floor((F.col("value") - F.col("lo")) / F.col("width")).cast("int"))
                 ).otherwise(F.lit(0))
    counts = (long.join(F.broadcast(rng.select("feature", "lo", "nbins", "width")), "feature")
                  .groupBy("feature", idx.alias("bin")).agg(F.count(F.lit(1)).alias("n")))
    all_bins = rng.select("feature", "lo", "width", F.explode(F.sequence(F.lit(0), F.col("nbins") - 1)).alias("bin"))
    out = all_bins.join(counts, ["feature", "bin"], "left")
    return out.select("feature", F.col("bin").cast("int").alias("bin"),
                      r(F.col("lo") + F.col("bin") * F.col("width")).alias("bin_start"),
                      r(F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("bin_end"),
                      F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"))


def distribution_summary(df: DataFrame, features: Sequence[str] = dims.MODEL_FEATURES) -> DataFrame:
    """AGG-23: min, max, exact median and missing count per feature."""
    long = melt(df, features)
    base = long.groupBy("feature").agg(
        F.min("value").alias("min"), F.max("value").alias("max"),
        F.count_if(F.col("value").isNull() | F.isnan("value")).alias("missing"))
    med = exact_quantiles(long, "value", [0.5], ["feature"]).select("feature", F.col("quantile").alias("median"))
    return base.join(med, "feature", "left").select(
        "feature", r(F.col("min")).alias("min"), r(F.col("max")).alias("max"),
        r(F.col("median")).alias("median"), F.col("missing").cast("long").alias("missing"))
