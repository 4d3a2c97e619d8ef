"""Streaming operators give the batch results (STR-1..3)."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from riverlens.sources.tables import observations
from riverlens.streaming import streams as ST


def _write_source(spark):
    d = tempfile.mkdtemp(prefix="riverlens-stream-", dir="/tmp")
    src = os.path.join(d, "src")
    observations(spark, SF_SMALL).repartition(4).write.parquet(src)
    return d, src


def test_assessment_stream_matches_batch(spark):
    d, src = _write_source(spark)
    schema = spark.read.parquet(src).schema
    q = ST.start_assessment_stream(spark, src, schema, os.path.join(d, "out"), os.path.join(d, "ckpt"))
    q.awaitTermination(120)
    streamed = spark.read.parquet(os.path.join(d, "out"))
    batch = ST.assess(spark.read.parquet(src))
    cols = ["obs_id", "wqi_class", "overall_priority", "n_abnormal"]
    assert sorted(map(tuple, streamed.select(cols).collect())) == sorted(map(tuple, batch.select(cols).collect()))


def test_dedupe_and_monthly_running(spark):
    d, src = _write_source(spark)
    schema = spark.read.parquet(src).schema
    stream = spark.readStream.schema(schema).parquet(src)
    doubled = stream.unionByName(spark.readStream.schema(schema).parquet(src))
    dd = ST.deduplicate_events(doubled, ["obs_id"], "sampled_at", "3650 days")
    q = dd.writeStream.format("memory").queryName("dedup_out").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("dedup_out").count() == spark.read.parquet(src).count()
    m = ST.monthly_running(stream)
    q2 = m.writeStream.format("memory").queryName("monthly_out").outputMode("complete") \
        .trigger(availableNow=True).start()
    q2.awaitTermination(120)
    got = {r["month"]: r["observations"] for r in spark.table("monthly_out").collect()}
    batch = {r["month"]: r["c"] for r in spark.read.parquet(src)
             .groupBy(F.date_format("sampled_at", "yyyy-MM").alias("month")).agg(F.count("*").alias("c")).collect()}
    assert got == batch


def test_monthly_state_leaves_after_the_watermark(spark):
    d, src = _write_source(spark)
    schema = spark.read.parquet(src).schema
    stream = ST.monthly_running(spark.readStream.schema(schema).parquet(src), delay="1 day")
    q = stream.writeStream.format("memory").queryName("monthly_append").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {(r["month"], str(r["window"]["start"])[:10]): r["observations"] for r in spark.table("monthly_append").collect()}
    batch = {(r["m"], r["d"]): r["n"] for r in spark.read.parquet(src).groupBy(
        F.date_format("sampled_at", "yyyy-MM").alias("m"), F.date_format("sampled_at", "yyyy-MM-dd").alias("d")).agg(F.count("*").alias("n")).collect()}
    assert got and all(batch[k] == n for k, n in got.items())      # closed windows only, each once and whole


def test_submissions_from_gate_to_document(spark, tmp_path):
    from riverlens.operators import models as MD
    from riverlens.operators.split import with_weights
    from riverlens.plans.labelling import scored_observations
    from riverlens.sources.tables import submissions
    train = scored_observations(spark, SF_SMALL).where("wqi_class is not null").select("obs_id", "wqi_class", *MD.RAW)
    model = MD.build_pipeline("decision_tree", max_depth=4).fit(with_weights(train))
    src = str(tmp_path / "in")
    submissions(spark, SF_SMALL).repartition(3).write.parquet(src)
    batch = ST.assess_submissions(spark.read.parquet(src), model)
    stream = ST.assess_submissions(spark.readStream.schema(spark.read.parquet(src).schema).parquet(src), model)
    q = stream.writeStream.format("memory").queryName("submission_out").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = spark.table("submission_out").collect()
    assert sorted(map(str, got)) == sorted(map(str, batch.collect())) and len(got) == spark.read.parquet(src).count()
    assert {r["gate_reason"] for r in got} >= {None, "missing", "outside"}
    assert all((r["document"] is None) == (r["gate_reason"] is not None) for r in got)
