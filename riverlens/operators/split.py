"""Stratified exact-size split, leakage audit, class weights, oversampling.

Order key: the first 52 bits of md5(key || ':' || seed), identical in every
engine, uniform, and exactly representable as a double.  The first rows of a
class in (order key, key) order are found in two steps: a histogram of the
order key (merged map-side, at most 65,536 rows a class) names the one bucket
in which the wanted count is reached, and only that bucket's rows are ordered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riverlens.functions import dims
from riverlens.functions.scalars import log10_floor1, no_nan
from riverlens.operators.quantiles import exact_quantiles, melt
from riverlens.session import written

TEST_SIZE = 0.2
SEED = 42
BUCKET_WIDTH = 2 ** 36   # of the 52-bit order key: 65,536 buckets
CHUNK = 1024


def order_key(key: Column, seed: int = SEED) -> Column:
    """52-bit pseudo-random order key from md5, as double (exact)."""
    h = F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("long").cast("double")


def holdout_counts(sizes: DataFrame, label: str, test_size: float = TEST_SIZE) -> DataFrame:
    """(label, need): test rows per class of ``sizes`` (label, n), ceil(n * size) in all.

    The train rows are dealt to the classes in proportion, whole numbers first
    and the rest by largest remainder (ties by label); a class keeps one train
    row at least.
    """
    whole = Window.partitionBy()    # over one row per class
    t = sizes.select(label, "n", F.sum("n").over(whole).alias("_n"))
    t = t.withColumn("_train", (F.col("_n") - F.ceil(F.col("_n") * F.lit(test_size))).cast("decimal(19,0)"))
    part = F.col("n").cast("decimal(19,0)") * F.col("_train")
    t = t.withColumn("_whole", F.floor(part / F.col("_n")).cast("long")).withColumn(
        "_rest", (part % F.col("_n").cast("decimal(19,0)")).cast("long"))
    by_rest = Window.partitionBy().orderBy(F.desc("_rest"), label)
    extra = F.row_number().over(by_rest) <= F.col("_train").cast("long") - F.sum("_whole").over(whole)
    train = F.col("_whole") + extra.cast("long")
    return t.select(label, F.greatest(F.lit(0), F.least(F.col("n") - train, F.col("n") - 1)).cast("long").alias("need"))


def with_first(df: DataFrame, need: DataFrame, label: str, key: str, seed: int, flag: str) -> DataFrame:
    """``df`` with ``flag``: whether the row is among the first ``need`` of its class in (order key, key) order.

    ``need`` has (label, need).  ``df`` is read twice; write it before if it is
    costly.  Rows that tie in both keys are interchangeable.  The edges, a row
    per class, are broadcast: a shuffle by class would put a class into one task.
    """
    base = df.withColumn("_ok", order_key(F.col(key), seed)).withColumn("_b", F.floor(F.col("_ok") / BUCKET_WIDTH))
    hist = base.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(label).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    edge = (hist.withColumn("_upto", F.sum("_n").over(upto)).join(need.withColumnRenamed("need", "_need"), label)
                .where((F.col("_upto") >= F.col("_need")) & (F.col("_upto") - F.col("_n") < F.col("_need")))
                .select(label, F.col("_b").alias("_edge"), (F.col("_need") - F.col("_upto") + F.col("_n")).alias("_take")))
    out = base.join(F.broadcast(edge), label, "left")     # a class that needs none has no edge
    at = F.coalesce(F.col("_b") == F.col("_edge"), F.lit(False))
    order = Window.partitionBy(label).orderBy("_ok", key)
    ranked = out.where(at).withColumn(flag, F.row_number().over(order) <= F.col("_take"))
    rest = out.where(~at).withColumn(flag, F.coalesce(F.col("_b") < F.col("_edge"), F.lit(False)))
    return rest.unionByName(ranked).drop("_ok", "_b", "_edge", "_take")


def stratified_split(df: DataFrame, label: str = "wqi_class", key: str = "obs_id",
                     test_size: float = TEST_SIZE, seed: int = SEED, materialize: bool = False) -> DataFrame:
    """SPL-1: append ``split`` ('train' / 'test'); exact total and per-class test counts.

    With ``materialize`` the input is written once to the shared folder, so
    upstream joins run once.
    """
    base = written(df, "split-input") if materialize else df
    need = holdout_counts(base.groupBy(label).agg(F.count(F.lit(1)).alias("n")), label, test_size)
    return with_first(base, need, label, key, seed, "_test").withColumn(
        "split", F.when(F.col("_test"), "test").otherwise("train")).drop("_test")


def split_report(split_df: DataFrame, label: str = "wqi_class") -> DataFrame:
    """AGG-31: full / train / test counts and shares per class, rare-class note."""
    per = split_df.groupBy(label).agg(
        F.count(F.lit(1)).alias("n_full"), F.count_if(F.col("split") == "train").alias("n_train"),
        F.count_if(F.col("split") == "test").alias("n_test"))
    order = F.coalesce(*[F.when(F.col(label) == c, F.lit(i + 1)) for i, c in enumerate(dims.CLASS_ORDER)])
    tot = Window.partitionBy()   # window over one row per class
    return per.select(
        label, order.alias("class_order"),
        *[F.col(c).cast("long").alias(c) for c in ("n_full", "n_train", "n_test")],
        *[F.round(F.col(c) * 100.0 / F.sum(c).over(tot), 6).alias(f"pct_{c[2:]}") for c in ("n_full", "n_train", "n_test")],
        (F.col("n_full") < 10).alias("rare_class"))


def overlap(split_df: DataFrame, key: str = "obs_id") -> DataFrame:
    """JOIN-7: identities present in both train and test (must be empty)."""
    train = split_df.where(F.col("split") == "train").select(key)
    test = split_df.where(F.col("split") == "test").select(key)
    return train.join(test, key, "left_semi")


class DataLeakageError(ValueError):
    """An item of the leakage audit failed."""


STATISTICS = ("n", "mean", "std_pop", "p10", "q25", "median", "q75", "p90")


def other_statistics(stats: DataFrame, fresh: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """SPL-2 item 2: the features of ``fresh`` whose row in ``stats`` is missing or has another value."""
    off = F.lit(False)
    for c in STATISTICS:
        if c not in stats.columns:
            return fresh.select("feature")
        a, b = F.col(f"a.{c}").cast("double"), F.col(f"b.{c}").cast("double")
        near = F.abs(a - b) <= tolerance * F.greatest(F.abs(a), F.abs(b), F.lit(1.0))
        off = off | ~F.coalesce(near, a.isNull() & b.isNull())
    both = fresh.alias("a").join(stats.alias("b"), F.col("a.feature") == F.col("b.feature"), "left")
    return both.where(off | F.col("b.feature").isNull()).select("a.feature")


def foreign_features(data: DataFrame, raw: DataFrame, key: str) -> DataFrame:
    """SPL-2 item 7: (key, feature) of ``data`` where the feature is not what its own raw row gives.

    Every feature is made again from the raw measurements of the row with the
    same key; a row without one has no feature of its own.
    """
    made = {f: no_nan(F.col(f)) for f in dims.MODEL_FEATURES} | {dims.ENGINEERED_FEATURE: log10_floor1(no_nan(F.col("fc")))}
    have = [f for f in made if f in data.columns]
    own = raw.select(F.col(key).alias("_key"), *[made[f].alias(f"_{f}") for f in have]).dropDuplicates(["_key"])
    both = data.select(key, *[no_nan(F.col(f)).alias(f) for f in have]).join(own, F.col(key) == F.col("_key"), "left")
    off = F.array_compact(F.array(*[F.when(F.col("_key").isNull() | ~F.col(f).eqNullSafe(F.col(f"_{f}")), F.lit(f)) for f in have]))
    return both.select(key, F.explode(off).alias("feature"))


def leakage_audit(split_df: DataFrame, features: Sequence[str], stats: DataFrame, raw: DataFrame, key: str = "obs_id",
                  label: str = "wqi_class", seed: int | None = SEED, raise_on_fail: bool = False) -> DataFrame:
    """SPL-2: eight rows (item, status, violations) over a split, the feature list and the fitted statistics.

    Counts of violations: features that are target columns; features whose
    statistics are missing or are not those of the train rows, which are fitted
    again and compared value by value; features outside the frozen list; keys on
    both sides; source rows that occur more than once (so one could be on both
    sides); rows that a second split puts elsewhere (all rows without a seed);
    values that are not made from their own row of ``raw``, the measurements
    before any fitting; rows whose log10 feature is not log10(max(fc, 1)).
    """
    frozen = (*dims.MODEL_FEATURES, dims.ENGINEERED_FEATURE)
    data = written(split_df.select(key, label, "split", *[f for f in frozen if f in split_df.columns]), "audited-split")
    again = stratified_split(data.drop("split"), label, key, seed=seed if seed is not None else -1)
    old = F.col("split") == "train"
    fresh = fitted_statistics(data.where(old))
    per_key = data.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.max(old).alias("a"), F.max(~old).alias("b"))
    keys = per_key.agg(F.count_if(F.col("a") & F.col("b")).alias("both"), F.count_if(F.col("n") > 1).alias("twice")).first()
    log10 = F.when(no_nan(F.col("fc")).isNotNull(), F.log10(F.greatest(F.col("fc"), F.lit(1.0))))
    wrong = F.count_if(~log10.eqNullSafe(F.col(dims.ENGINEERED_FEATURE))) if dims.ENGINEERED_FEATURE in data.columns else F.count("*")
    rows = data.agg(F.count("*").alias("n"), wrong.alias("wrong")).first()
    moved = (rows["n"] if seed is None else
             data.select(key, F.col("split").alias("s")).join(again.select(key, "split"), key).where("s <> split").count())
    counts = {
        "target columns among the features": len({f.lower() for f in features} & {"wqi_score", "wqi_class", "potability"}),
        "statistics fitted beyond the train rows": other_statistics(stats, fresh).count(),
        "features outside the frozen list": len(set(features) - set(frozen)),
        "keys on both sides": keys["both"],
        "source rows that repeat": keys["twice"],
        "rows that a second split moves": moved,
        "features that are no function of their row": foreign_features(data, raw, key).count(),
        "rows with another log10 feature": rows["wrong"],
    }
    failed = [k for k, n in counts.items() if n]
    if failed and raise_on_fail:
        raise DataLeakageError(f"leakage audit failed: {failed}")
    out = [(i + 1, k, "FAIL" if n else "PASS", int(n)) for i, (k, n) in enumerate(counts.items())]
    return split_df.sparkSession.createDataFrame(out, "item int, check string, status string, violations long")


def class_weights(train: DataFrame, label: str = "wqi_class") -> DataFrame:
    """SPL-3: balanced weights n / (k * n_c) over the classes present in train."""
    c = train.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    w = Window.partitionBy()   # over the k class rows
    return c.select(label, F.col("n_c").cast("long"),
                    (F.sum("n_c").over(w) / (F.count(F.lit(1)).over(w) * F.col("n_c"))).alias("weight"))


def with_weights(train: DataFrame, label: str = "wqi_class", weight: str = "weight") -> DataFrame:
    """Attach the balanced weight column (class table broadcast: one row per class)."""
    return train.join(F.broadcast(class_weights(train, label).select(label, weight)), label, "left")


def oversample(train: DataFrame, label: str = "wqi_class", key: str = "obs_id", seed: int = SEED) -> DataFrame:
    """SPL-4: deterministic random oversampling of every class to the majority size.

    Each row is repeated q or q + 1 times (q = M div n_c); the r = M mod n_c
    extra copies go to the rows first in (hash, key) order.  No row is dropped;
    ``copy`` counts from 1; a rare class spreads over all tasks.
    """
    rows = written(train, "oversample-train")
    sizes = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    plan = sizes.withColumn("_m", F.max("n").over(Window.partitionBy()))     # one row per class
    plan = plan.select(label, F.expr("_m div n").alias("_q"), (F.col("_m") % F.col("n")).alias("need"))
    out = with_first(rows, plan.select(label, "need"), label, key, seed + 1, "_extra").join(F.broadcast(plan.drop("need")), label)
    out = out.withColumn("_copies", F.col("_q") + F.col("_extra").cast("long")).drop("_q", "_extra")
    return repeated(out, "_copies", key).drop("_copies")


def repeated(rows: DataFrame, copies: str, key: str) -> DataFrame:
    """``rows`` as often as their column ``copies`` says, with ``copy`` counting from 1.

    Up to ``CHUNK`` copies are exploded in-row; a row with more is first exploded
    into chunks, which are dealt out before they are exploded.
    """
    few = rows.where(F.col(copies).between(1, CHUNK)).withColumn(
        "copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))))
    chunks = rows.where(F.col(copies) > CHUNK).withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"({copies} - 1) div {CHUNK}"))))
    first = F.col("_chunk") * CHUNK + 1
    many = chunks.repartition(F.col(key), F.col("_chunk")).withColumn(
        "copy", F.explode(F.sequence(first, F.least(F.col(copies), first + (CHUNK - 1))))).drop("_chunk")
    return few.unionByName(many)


def smote(train: DataFrame, features: Sequence[str] = dims.MODEL_FEATURES, label: str = "wqi_class", key: str = "obs_id",
          k: int = 3, seed: int = SEED) -> DataFrame:
    """SPL-5: every class brought to the majority's size with rows between a row and a near one of its class.

    ``train`` has complete features; the result has (key, label, features,
    synthetic).  A class lacks M - n rows: each of its rows gives q or q + 1 of
    them (the rest to the first in hash order), on the segment to one of its k
    nearest rows of the class in standardised space, both drawn by hash.  The
    neighbours are exact for every row (an adaptive partition of space); a
    row without a neighbour (a class of one) is repeated as it is.
    """
    from riverlens.operators.nearest import nearest_labelled
    rows = written(train.select(key, label, *features), "smote-train")
    stats = moments(rows, features)
    sizes = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    plan = sizes.withColumn("_lack", F.max("n").over(Window.partitionBy()) - F.col("n")).where("_lack > 0")  # one row per class
    plan = plan.select(label, F.expr("_lack div n").alias("_q"), F.expr("_lack % n").alias("need"))
    plan = written(plan, "smote-plan")
    minor = rows.join(F.broadcast(plan.select(label)), label, "left_semi")
    near = nearest_labelled(minor, minor.withColumn("_point", F.struct(*features)), stats, features, k, label, key, key,
                            own_group=True, carry=["_point"])
    near = near.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("neighbour_rank", "_point"))).alias("_near"))  # k at most
    base = with_first(minor, plan.select(label, "need"), label, key, seed + 2, "_extra").join(F.broadcast(plan.drop("need")), label)
    base = base.withColumn("_copies", F.col("_q") + F.col("_extra").cast("long")).drop("_q", "_extra")
    base = base.join(near, F.col(key) == F.col("query_id"), "left").drop("query_id")
    made = repeated(base, "_copies", key)
    name = F.concat(F.col(key).cast("string"), F.lit("#"), F.col("copy").cast("string"))
    pick = F.pmod(order_key(name, seed + 3).cast("long"), F.size("_near")).cast("int")
    part = order_key(name, seed + 4) / F.lit(2.0 ** 52)
    made = made.withColumns({"_other": F.when(F.size("_near") > 0, F.get("_near", pick)["_point"]), "_part": part, "_name": name})
    values = [F.when(F.col("_other").isNull(), F.col(f)).otherwise(
        F.col(f) + F.col("_part") * (F.col(f"_other.{f}") - F.col(f))).alias(f) for f in features]
    made = made.select(F.col("_name").alias(key), label, *values, F.lit(True).alias("synthetic"))
    real = rows.select(F.col(key).cast("string").alias(key), label, *features, F.lit(False).alias("synthetic"))
    return real.unionByName(made)


# FIXED VALUES: names of the resampling methods.
RESAMPLING = {"none": "none", "none_class_weight": "none", "passthrough": "none", "": "none", "smote": "smote",
              "random_oversampler": "oversample", "ros": "oversample", "oversample": "oversample"}


def resample(train: DataFrame, method: str = "none", features: Sequence[str] = dims.MODEL_FEATURES,
             label: str = "wqi_class", key: str = "obs_id", seed: int = SEED, k: int = 3) -> DataFrame:
    """SPL-6: ``train`` resampled by a named method; an unknown name raises.  For training rows only."""
    kind = RESAMPLING.get(str(method).strip().lower())
    if kind is None:
        raise ValueError(f"unknown resampling method {method!r}; one of none, smote, random_oversampler")
    if kind == "smote":
        return smote(train, features, label, key, k, seed).drop("synthetic")
    return oversample(train, label, key, seed).drop("copy") if kind == "oversample" else train


def moments(train: DataFrame, features: Sequence[str] = dims.MODEL_FEATURES) -> DataFrame:
    """(feature, n, mean, std_pop) of the values that are there, in one aggregation."""
    long = melt(train, features).where(F.col("value").isNotNull())
    return long.groupBy("feature").agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std_pop"))


def fitted_statistics(train: DataFrame, features: Sequence[str] = dims.MODEL_FEATURES) -> DataFrame:
    """CLN-2 / FEA-3..5 / AGG-30: train-only medians, mean, population std,
    quartiles and P10/P90, one row per feature (the fitted state)."""
    long = melt(train, features).where(F.col("value").isNotNull() & ~F.isnan("value"))
    mom = long.groupBy("feature").agg(F.count("value").alias("n"), F.avg("value").alias("mean"),
                                      F.stddev_pop("value").alias("std_pop"))
    q = exact_quantiles(long, "value", [0.1, 0.25, 0.5, 0.75, 0.9], ["feature"])
    qw = q.groupBy("feature").agg(*[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(nm)
                                    for p, nm in ((0.1, "p10"), (0.25, "q25"), (0.5, "median"),
                                                  (0.75, "q75"), (0.9, "p90"))])
    return mom.join(qw, "feature")


FALLBACK = "Empirical Statistical Fallback ({} of Training Baseline)"     # FIXED VALUE: the label of such a limit


def fallback_limits(train: DataFrame, columns: Sequence[str], standards: Sequence[str], depletion: Sequence[str] = ()) -> DataFrame:
    """AGG-30: a limit for each of ``columns`` that is not among the ``standards``, from the training rows only.

    P90 and "above" for a load, P10 and "below" for the ``depletion`` columns,
    exact quantiles with linear interpolation, always labelled as empirical and
    not regulatory.  A column without a value has no limit.
    """
    open_ = [c for c in columns if c not in standards]
    q = exact_quantiles(melt(train, open_), "value", [0.1, 0.9], ["feature"])
    low = F.col("feature").isin(*depletion)
    mine = q.where(F.when(low, F.col("prob") == 0.1).otherwise(F.col("prob") == 0.9))
    return mine.select("feature", F.when(low, "below").otherwise("above").alias("direction"), F.col("quantile").alias("limit"),
                       F.when(low, FALLBACK.format("P10")).otherwise(FALLBACK.format("P90")).alias("standard_type"),
                       F.lit(False).alias("regulatory"))


def beyond_fallback(df: DataFrame, limits: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("obs_id",)) -> DataFrame:
    """AGG-30: (keys, feature, value, limit, standard_type) of the values beyond an empirical limit."""
    long = melt(df, columns, keys).where("value is not null").join(F.broadcast(limits), "feature")     # a row per column
    beyond = F.when(F.col("direction") == "below", F.col("value") < F.col("limit")).otherwise(F.col("value") > F.col("limit"))
    return long.where(beyond).select(*keys, "feature", "value", "limit", "standard_type")


def apply_fitted(df: DataFrame, stats: DataFrame, features: Sequence[str] = dims.MODEL_FEATURES,
                 mode: str = "standard") -> DataFrame:
    """FEA-3/4/5: impute with the fitted median, then scale with fitted numbers.

    ``standard``: (x - mean) / population std (zero std -> 1, as sklearn);
    ``robust``: (x - median) / IQR (zero IQR -> 1).  The fitted table has
    one row per feature and is pivoted into a single broadcast row.
    """
    wide = stats.agg(*[F.max(F.when(F.col("feature") == f, F.struct(
        "median", "mean", "std_pop", "q25", "q75"))).alias(f"_s_{f}") for f in features])
    out = df.withColumn("_k", F.lit(1)).join(F.broadcast(wide.withColumn("_k", F.lit(1))), "_k").drop("_k")
    cols = {}
    for f in features:
        s = F.col(f"_s_{f}")
        x = F.coalesce(F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")), s["median"])
        if mode == "standard":
            sd = F.when(s["std_pop"] > 0, s["std_pop"]).otherwise(1.0)
            cols[f] = (x - s["mean"]) / sd
        elif mode == "robust":
            iqr = s["q75"] - s["q25"]
            cols[f] = (x - s["median"]) / F.when(iqr > 0, iqr).otherwise(1.0)
        elif mode == "impute":
            cols[f] = x
        else:
            raise ValueError(mode)
    return out.withColumns(cols).drop(*[f"_s_{f}" for f in features])


def time_split(df: DataFrame, ts: str = "sampled_at", test_size: float = TEST_SIZE) -> DataFrame:
    """SPL-7: the latest ``test_size`` share of time goes to test (cut by exact quantile of time)."""
    secs = F.unix_timestamp(F.col(ts).cast("timestamp")).cast("double")
    tmp = df.withColumn("_t", secs)
    cut = exact_quantiles(tmp.select("_t"), "_t", [1.0 - test_size]).select(F.col("quantile").alias("_cut"))
    out = tmp.withColumn("_k", F.lit(1)).join(F.broadcast(cut.withColumn("_k", F.lit(1))), "_k")
    return out.withColumn("split", F.when(F.col("_t") > F.col("_cut"), "test").otherwise("train")).drop(
        "_k", "_t", "_cut")


def station_split(df: DataFrame, station: str = "station", test_size: float = TEST_SIZE,
                  seed: int = SEED) -> DataFrame:
    """SPL-7: whole stations held out by hashed station bucket (no station in both sides)."""
    bucket = order_key(F.col(station), seed) / float(2 ** 52)
    return df.withColumn("split", F.when(bucket < test_size, "test").otherwise("train"))
