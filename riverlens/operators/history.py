"""Historical views: filters, monthly series, coverage, station positions, windows.

Every "first / last / latest" takes an explicit order with ``obs_id`` as the
final tie-break (Spark has no file order).  They are written with
``min_by`` / ``max_by`` over struct orderings, which aggregate partially on
the map side: a station holding a third of all rows is reduced in every
task before the shuffle instead of being sorted in one window partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverlens.functions import dims
from riverlens.functions.scalars import in_bounds


def history_records(scored: DataFrame, features: Sequence[str] = dims.MODEL_FEATURES,
                    keep_ts: bool = False) -> DataFrame:
    """PRJ-6: state, station, category, features, day and month text (bad date -> null)."""
    ts = F.col("sampled_at")
    return scored.select("obs_id", "state", "station", F.col("wqi_class").alias("category"), *features,
                         F.date_format(ts, "yyyy-MM-dd").alias("date"),
                         F.date_format(ts, "yyyy-MM").alias("month"), *(["sampled_at"] if keep_ts else []))


def filter_history(records: DataFrame, date_from: str | None = None, date_to: str | None = None,
                   state: str | None = None, station: str | None = None,
                   ts_col: str | None = None) -> DataFrame:
    """FLT-2: dated rows only; inclusive text bounds on the day (or the month
    when no record in the whole set has a day); optional state and station.

    With ``ts_col`` every dated record has a day, so the bounds (``YYYY-MM-DD``
    or ``YYYY-MM``) also hold as a timestamp range, which reaches the parquet
    scan (PushedFilters); the exact text test still decides.  Without it the
    day-precision flag is one boolean, attached by a constant-key join.
    """
    if ts_col:
        if date_from:
            records = records.where(F.col(ts_col) >= F.to_timestamp(F.lit(date_from + "-01" * (len(date_from) == 7))))
        if date_to and len(date_to) == 7:       # day texts of that month sort after the month itself
            records = records.where(F.col(ts_col) < F.to_timestamp(F.lit(date_to + "-01")))
        elif date_to:
            records = records.where(F.col(ts_col) < F.date_add(F.to_date(F.lit(date_to)), 1))
        df, period = records, F.col("date")
    else:
        flag = records.agg(F.max(F.col("date").isNotNull()).alias("_day")).withColumn("_k", F.lit(1))
        df = records.withColumn("_k", F.lit(1)).join(flag, "_k").drop("_k")
        period = F.when(F.coalesce(F.col("_day"), F.lit(False)), F.col("date")).otherwise(F.col("month"))
    cond = period.isNotNull()
    if date_from:
        cond = cond & (period >= F.lit(date_from))
    if date_to:
        cond = cond & (period <= F.lit(date_to))
    if state:
        cond = cond & (F.col("state") == state)
    if station:
        cond = cond & (F.col("station") == station)
    return df.where(cond).drop("_day")


def monthly_means(records: DataFrame, features: Sequence[str] = dims.MODEL_FEATURES) -> DataFrame:
    """AGG-24: per month and feature, mean of present values and n; empty months omitted."""
    aggs = []
    for i, f in enumerate(features):
        aggs += [F.avg(f).alias(f"_m{i}"), F.count(f).alias(f"_n{i}")]
    per = records.where(F.col("month").isNotNull()).groupBy("month").agg(*aggs)
    arr = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"_m{i}").alias("mean"), F.col(f"_n{i}").alias("n"))
                    for i, f in enumerate(features)])
    return (per.select("month", F.inline(arr)).where(F.col("n") > 0)
               .select("month", "feature", F.round("mean", 6).alias("mean"), F.col("n").cast("long").alias("n")))


def monthly_classes(records: DataFrame, label: str = "category") -> DataFrame:
    """AGG-25: per month, counts and shares of all five classes (zeros kept)."""
    per = records.where(F.col("month").isNotNull()).groupBy("month").agg(
        F.count(F.lit(1)).alias("_t"),
        *[F.count_if(F.col(label) == c).alias(f"_c{i}") for i, c in enumerate(dims.CLASS_ORDER)])
    arr = F.array(*[F.struct(F.lit(c).alias("wqi_class"), F.lit(i + 1).alias("class_order"),
                             F.col(f"_c{i}").alias("n")) for i, c in enumerate(dims.CLASS_ORDER)])
    return per.select("month", "_t", F.inline(arr)).select(
        "month", "wqi_class", "class_order", F.col("n").cast("long").alias("n"),
        F.round(F.col("n") / F.col("_t"), 6).alias("share"))


def coverage(records: DataFrame, features: str | Sequence[str]) -> DataFrame:
    """AGG-26: observations, sampled months, missing values per feature, first/last month; one aggregation."""
    features = [features] if isinstance(features, str) else list(features)
    one = records.agg(
        F.count(F.lit(1)).alias("observations"), F.countDistinct("month").alias("sampled_months"),
        F.min("month").alias("first_period"), F.max("month").alias("last_period"),
        *[F.count_if(F.col(f).isNull()).alias(f"_m{i}") for i, f in enumerate(features)])
    arr = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"_m{i}").alias("missing_values")) for i, f in enumerate(features)])
    return one.select("observations", "sampled_months", "first_period", "last_period", F.inline(arr)).select(
        "feature", F.col("observations").cast("long"), F.col("sampled_months").cast("long"),
        F.col("missing_values").cast("long"), "first_period", "last_period")


def overview_metrics(records: DataFrame, features: Sequence[str] = dims.MODEL_FEATURES) -> DataFrame:
    """AGG-27: records, stations, class counts and shares, missing-cell share (long form)."""
    missing_cells = sum((F.when(F.col(f).isNull(), 1).otherwise(0) for f in features), F.lit(0))
    one = records.agg(
        F.count(F.lit(1)).alias("records"),
        F.countDistinct("state", "station").alias("stations"),
        F.sum(missing_cells).alias("missing_cells"),
        *[F.count_if(F.col("category") == c).alias(f"_c{i}") for i, c in enumerate(dims.CLASS_ORDER)])
    nrec = F.col("records")
    items = [
        F.struct(F.lit("records").alias("metric"), nrec.cast("double").alias("value")),
        F.struct(F.lit("stations").alias("metric"), F.col("stations").cast("double").alias("value")),
        F.struct(F.lit("parameters").alias("metric"), F.lit(float(len(features))).alias("value")),
        F.struct(F.lit("missing_cell_pct").alias("metric"),
                 F.when(nrec > 0, F.col("missing_cells") * 100.0 / (nrec * len(features))).alias("value")),
    ]
    for i, c in enumerate(dims.CLASS_ORDER):
        items.append(F.struct(F.lit(f"count:{c}").alias("metric"), F.col(f"_c{i}").cast("double").alias("value")))
        items.append(F.struct(F.lit(f"share:{c}").alias("metric"),
                              F.when(nrec > 0, F.col(f"_c{i}") / nrec).otherwise(0.0).alias("value")))
    return one.select(F.inline(F.array(*items))).select("metric", F.round("value", 6).alias("value"))


def valid_coordinates(df: DataFrame) -> Column:
    return F.col("latitude").between(-90.0, 90.0) & F.col("longitude").between(-180.0, 180.0)


def last_coordinates(df: DataFrame, keys: Sequence[str] = ("state", "station")) -> DataFrame:
    """WIN-2: last valid coordinate pair per station; undated rows sort first."""
    order = F.struct(F.col("sampled_at"), F.col("obs_id"))
    return (df.where(valid_coordinates(df))
              .groupBy(*keys)
              .agg(F.max_by(F.struct("latitude", "longitude"), order).alias("_c"))
              .select(*keys, F.col("_c.latitude").alias("latitude"), F.col("_c.longitude").alias("longitude")))


def stations_with_coordinates(df: DataFrame, keys: Sequence[str] = ("state", "station")) -> DataFrame:
    """SRT-1 + JOIN-4: distinct stations sorted, left-joined to their last coordinates."""
    stations = df.select(*keys).distinct()
    return stations.join(last_coordinates(df, keys), list(keys), "left").orderBy(*keys)


def latest_per_station(records: DataFrame, keys: Sequence[str] = ("state", "station")) -> DataFrame:
    """WIN-3: the most recent record per station; later obs_id wins ties."""
    cols = [c for c in records.columns if c not in keys]
    order = F.struct(F.coalesce(F.col("date"), F.col("month"), F.lit("")), F.col("obs_id"))
    return (records.groupBy(*keys).agg(F.max_by(F.struct(*cols), order).alias("_r"))
                   .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in cols]))


def first_valid_sample(df: DataFrame, bounds=dims.INPUT_BOUNDS) -> DataFrame:
    """FLT-3: first sample (by time, then obs_id) with every feature finite and in bounds."""
    ok = F.lit(True)
    for c, (lo, hi) in bounds.items():
        ok = ok & in_bounds(F.col(c), lo, hi)
    cols = ["obs_id", "state", "station", *bounds]
    row = (df.where(ok).agg(F.min_by(F.struct(*cols), F.struct("sampled_at", "obs_id")).alias("_r")))
    return row.where(F.col("_r").isNotNull()).select(*[F.col(f"_r.{c}").alias(c) for c in cols])


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """SET-3: distinct key sets."""
    return df.select(*cols).distinct()


def deduplicate(df: DataFrame, subset: Sequence[str] | None = None, keep: str = "first",
                order: Sequence[str] = ("obs_id",)) -> DataFrame:
    """WIN-1: full-row or subset de-duplication keeping first / last / none.

    * full row: ``dropDuplicates()`` (nulls compare equal, as in pandas);
    * first / last: ``min_by`` / ``max_by`` over the explicit order, which
      combines map-side so a hot key never lands whole in one task;
    * none: keys seen once; the count and the only row come from one aggregation.
    """
    if not subset:
        return df.dropDuplicates()
    subset = list(subset)
    others = [c for c in df.columns if c not in subset]
    order_col = F.struct(*[F.col(c) for c in order])
    if keep in ("first", "last"):
        pick = F.min_by if keep == "first" else F.max_by
        return (df.groupBy(*subset).agg(pick(F.struct(*others), order_col).alias("_r"))
                  .select(*subset, *[F.col(f"_r.{c}").alias(c) for c in others]))
    if keep == "none":
        single = df.groupBy(*subset).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*others)).alias("_r"))
        return single.where("_n = 1").select(*subset, *[F.col(f"_r.{c}").alias(c) for c in others])
    raise ValueError(f"keep must be first, last or none, not {keep!r}")
