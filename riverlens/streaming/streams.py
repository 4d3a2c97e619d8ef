"""Structured Streaming versions of the row-wise operators (STR-1..3).

The index, labels, rule findings, elevation and overall priority are all
in-row expressions (no window functions, no joins), so the batch
functions apply unchanged to a streaming DataFrame.  Duplicates are
dropped within a watermark; the monthly series keeps one state row per
(month, feature) or (month, class), bounded by the time span, not by the
row count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverlens.functions import dims
from riverlens.functions.index import with_index
from riverlens.functions.scalars import log10_floor1
from riverlens.operators import explain as X
from riverlens.operators import models as MD
from riverlens.operators.rules import with_document, with_findings
from riverlens.operators.scoring import gate_payload

RULE_COLS = (*dims.MODEL_FEATURES, dims.ENGINEERED_FEATURE)


def assess(df: DataFrame, keys: Sequence[str] = ("obs_id",)) -> DataFrame:
    """STR-1: score, label and prioritise each observation (batch or stream)."""
    scored = with_index(df).withColumn("log10_fc", log10_floor1(F.col("fc")))
    w = with_findings(scored, RULE_COLS)
    return w.select(*keys, *[c for c in ("station", "state", "sampled_at") if c in df.columns],
                    "n_params", "wqi_score", "wqi_class", "potability", "n_abnormal", "overall_priority")


def assess_submissions(df: DataFrame, model, payload: str = "payload", keys: Sequence[str] = ("submission_id",)) -> DataFrame:
    """STR-1: submissions (keys, payload) from gate to decision document, batch or stream.

    ``model`` is a fitted tree pipeline.  Rejected rows carry their reason and no
    document.  Every step is on the row itself, so a stream keeps no state.
    """
    gated = gate_payload(df.select(*keys, payload), payload)
    out = [gated.where(F.col("gate_reason").isNotNull()).select(
        *keys, "gate_reason", F.lit(None).cast("string").alias("predicted"), F.lit(None).cast("boolean").alias("uncertain"),
        F.lit(None).cast("string").alias("document"))]
    accepted = gated.where(F.col("gate_reason").isNull()).select(*keys, *MD.RAW)
    nodes = X.node_table(X.tree_from_pipeline(model), df.sparkSession)
    rows, base = X.attributed(nodes, MD.predict(model, accepted, keys), len(MD.FEATURES))
    rows = with_document(X.with_explanation(rows, base, MD.label_names(model), MD.FEATURES), MD.FEATURES)
    out.append(rows.select(*keys, F.lit(None).cast("string").alias("gate_reason"), "predicted", "uncertain",
                           F.to_json("document").alias("document")))
    return out[0].unionByName(out[1])


def deduplicate_events(df: DataFrame, keys: Sequence[str], event_time: str, delay: str = "1 day") -> DataFrame:
    """STR-2: drop repeated events by key within the watermark delay."""
    ts = df.withColumn(event_time, F.col(event_time).cast("timestamp"))  # watermarks need TIMESTAMP (not NTZ)
    return ts.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def monthly_running(df: DataFrame, event_time: str = "sampled_at",
                    features: Sequence[str] = dims.MODEL_FEATURES, delay: str | None = None) -> DataFrame:
    """STR-3: running monthly sums / counts per feature and class counts.

    Without ``delay`` for batch or update mode.  With it, a watermark: groups
    are (month, day window), a window leaves the state once it is ``delay``
    old, and append mode emits it then; months are sums over their windows.
    """
    month = F.date_format(F.col(event_time), "yyyy-MM").alias("month")
    groups = [month]
    if delay:
        df = df.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(event_time, delay)
        groups.append(F.window(event_time, "1 day").alias("window"))
    aggs = []
    for f in features:
        aggs += [F.sum(f).alias(f"{f}_sum"), F.count(f).alias(f"{f}_n")]
    aggs += [F.count_if(F.col("wqi_class") == c).alias(f"n_{c.replace(' ', '_').lower()}") for c in dims.CLASS_ORDER]
    return with_index(df).groupBy(*groups).agg(F.count(F.lit(1)).alias("observations"), *aggs)


def start_assessment_stream(spark, source_dir: str, schema, sink_dir: str, checkpoint_dir: str,
                            available_now: bool = True):
    """Run STR-1 from a parquet folder to a parquet folder with a checkpoint (exactly once)."""
    src = spark.readStream.schema(schema).parquet(source_dir)
    w = assess(src).writeStream.format("parquet").option("path", sink_dir) \
        .option("checkpointLocation", checkpoint_dir).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
