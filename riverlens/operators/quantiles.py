"""Exact order statistics without a single-partition window.

``percentile`` in Spark keeps a map of every distinct value of a group in
one aggregation buffer, and a window ordered over a whole column runs in
one task.  Both break when a column has billions of distinct values or one
group holds a third of the rows.  ``ranked_values`` computes exact
cumulative counts over distinct values instead:

1. ``groupBy(keys, value).count()``: partial aggregation collapses
   duplicates map-side, so the shuffle carries distinct values only.
2. The distinct values are range-partitioned by (keys, value) and written
   once with their partition number.  Spark samples the bounds, so the parts
   are even whatever the distribution: a hot group, a uniform key or a single
   infinite value makes no part larger, and the number of parts follows the
   session's shuffle partitions.
3. Prefix sums run per (group, part) in a window; the parts' totals (a row
   per group and part that meet) become offsets.

The result gives for every distinct value its count and the number of
values strictly below it in its group: enough for exact linear-interpolated
quantiles, average ranks (Spearman) and exact-count cuts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riverlens.functions.scalars import no_nan
from riverlens.session import written


def _placed(df: DataFrame, value: str, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Distinct values with counts and part ``_b``; per group and part the rows before it, in it and in all."""
    v = no_nan(F.col(value))
    counts = (df.select(*keys, v.alias(value)).where(F.col(value).isNotNull())
                .groupBy(*keys, value).agg(F.count(F.lit(1)).alias("cnt")))
    placed = written(counts.repartitionByRange(*[F.col(k) for k in keys], F.col(value))
                           .withColumn("_b", F.spark_partition_id()), "ranks")
    totals = placed.groupBy(*keys, "_b").agg(F.sum("cnt").alias("_bt"))
    w_before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    return placed, totals.select(
        *keys, "_b", "_bt", F.coalesce(F.sum("_bt").over(w_before), F.lit(0)).cast("long").alias("_off"),
        F.sum("_bt").over(Window.partitionBy(*keys)).cast("long").alias("n"))


def _counted(placed: DataFrame, offsets: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    w_in = Window.partitionBy(*keys, "_b").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumn("_lb", F.coalesce(F.sum("cnt").over(w_in), F.lit(0)))
    return (local.join(offsets.select(*keys, "_b", "_off", "n"), [*keys, "_b"])
                 .withColumn("before", (F.col("_off") + F.col("_lb")).cast("long")))


def ranked_values(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Distinct non-null values per group with exact cumulative counts.

    Returns ``keys..., value, cnt, before, n`` where ``before`` is the number
    of rows in the group with a smaller value and ``n`` the group size.
    """
    keys = list(keys)
    if not keys:
        return ranked_values(df.withColumn("_all", F.lit(0)), value, ["_all"]).drop("_all")
    placed, offsets = _placed(df, value, keys)
    return _counted(placed, offsets, value, keys).select(*keys, value, "cnt", "before", "n")


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float],
                    keys: Sequence[str] = ()) -> DataFrame:
    """Linear-interpolated quantiles (pandas / ``quantile_cont`` semantics).

    Returns ``keys..., prob, quantile``; groups without a value are absent.
    The parts' totals tell which part holds each wanted position; only these
    parts are read again and ranked.
    """
    keys = list(keys)
    if not keys:
        out = exact_quantiles(df.withColumn("_all", F.lit(0)), value, probs, ["_all"])
        return out.drop("_all")
    placed, offsets = _placed(df, value, keys)
    h = (F.col("n") - 1).cast("double") * F.col("prob")
    pos = (offsets.select(*keys, "_b", "_bt", "_off", "n", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob"))
                  .select(*keys, "_b", "_bt", "_off", "prob", (h - F.floor(h)).alias("frac"), F.inline(F.array(
                      F.struct(F.lit(0).alias("side"), F.floor(h).cast("long").alias("k")),
                      F.struct(F.lit(1).alias("side"), F.ceil(h).cast("long").alias("k")))))
                  .where((F.col("_off") <= F.col("k")) & (F.col("k") < F.col("_off") + F.col("_bt")))
                  .drop("_bt", "_off"))
    wanted = placed.join(pos.select(*keys, "_b").distinct(), [*keys, "_b"], "left_semi")
    hit = (_counted(wanted, offsets, value, keys).join(pos, [*keys, "_b"])
           .where((F.col("before") <= F.col("k")) & (F.col("k") < F.col("before") + F.col("cnt"))))
    out = hit.groupBy(*keys, "prob").agg(F.max(F.when(F.col("side") == 0, F.col(value))).alias("_lo"),
                                         F.max(F.when(F.col("side") == 1, F.col(value))).alias("_hi"),
                                         F.first("frac").alias("_f"))
    return out.select(*keys, "prob",
                      (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_f")).alias("quantile"))


def quantiles_wide(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                   keys: Sequence[str] = (), names: Sequence[str] | None = None) -> DataFrame:
    """Exact quantiles for several columns at once, one row per (keys, feature).

    The columns are melted into one (feature, value) stream so a single
    ranked pass covers all of them.
    """
    keys = list(keys)
    names = list(names) if names else [f"q{int(round(p * 100))}" for p in probs]
    melted = melt(df, columns, keys)
    q = exact_quantiles(melted, "value", probs, keys + ["feature"])
    aggs = [F.max(F.when(F.col("prob") == float(p), F.col("quantile"))).alias(nm)
            for p, nm in zip(probs, names)]
    return q.groupBy(*keys, "feature").agg(*aggs)


def melt(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (),
         name: str = "feature", value: str = "value") -> DataFrame:
    """Wide measurement columns to long (keys..., feature, value) rows, in-row; NaN reads as missing."""
    arr = F.array(*[F.struct(F.lit(c).alias(name), no_nan(F.col(c)).alias(value))
                    for c in columns])
    return (df.select(*keys, F.inline(arr)))
