"""Streams over the whole tables, run to their end, and what they have written (STR-1..3)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from riverlens.functions import dims
from riverlens.plans.oracle import obs_cte, scored_cte
from riverlens.plans.registry import register
from riverlens.plans.rules import OBS_PROF, OBS_RULE_COLS, POOR, _elevated_sql
from riverlens.session import ensure_checkpoint_dir
from riverlens.sources.tables import observations, stream_table
from riverlens.streaming import streams as ST


def _events(spark, sf_dir):
    """The observations as a stream of the lineitem files, joined to the static stations."""
    return observations(spark, sf_dir, lineitem=stream_table(spark, sf_dir, "lineitem"))


def _run(stream, name):
    """Everything that is there, appended to files in the shared folder; the files as a table."""
    spark = stream.sparkSession
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/riverlens-{name}-{uuid.uuid4().hex}"
    query = (stream.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state")
             .outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


@register("streamed_assessment", ("STR-1",), oracle=f"""
WITH {OBS_PROF}, {_elevated_sql('op', OBS_RULE_COLS, ('obs_id',))},
per AS (SELECT obs_id, count(*) AS n, bool_or(priority = 'High') AS any_high,
               bool_or(priority = 'Medium') AS any_medium FROM fnd GROUP BY obs_id)
SELECT op.obs_id, op.station, op.wqi_class, CAST(coalesce(n, 0) AS INTEGER) AS n_abnormal,
  CASE WHEN coalesce(n, 0) = 0 THEN 'None' WHEN any_high THEN 'High' WHEN n >= 2 THEN 'High'
       WHEN coalesce(op.wqi_class IN ({POOR}), false) THEN 'High' WHEN any_medium THEN 'Medium' ELSE 'Low' END
  AS overall_priority
FROM op LEFT JOIN per USING (obs_id)
""")
def streamed_assessment(spark, sf_dir):
    """Every observation scored, labelled and prioritised as it arrives."""
    out = ST.assess(_events(spark, sf_dir))
    return _run(out, "assessed").select("obs_id", "station", "wqi_class", "n_abnormal", "overall_priority")


@register("streamed_unique_events", ("STR-2",), oracle=f"""
WITH {obs_cte()}
SELECT state, count(*) AS n, count(DISTINCT obs_id) AS events FROM obs GROUP BY state
""")
def streamed_unique_events(spark, sf_dir):
    """A stream in which a third of the events arrive twice, without the repeats."""
    one, two = _events(spark, sf_dir), _events(spark, sf_dir)
    again = two.where(F.split("obs_id", "-")[0].cast("long") % 3 == 0)
    cols = ["obs_id", "state", "sampled_at"]
    unique = ST.deduplicate_events(one.select(*cols).union(again.select(*cols)), ["obs_id"], "sampled_at", "3650 days")
    return _run(unique, "unique").groupBy("state").agg(F.count("*").alias("n"), F.countDistinct("obs_id").alias("events"))


_CLASS_COUNTS = ", ".join(f"count(*) FILTER (WHERE wqi_class = '{c}') AS n_{c.replace(' ', '_').lower()}" for c in dims.CLASS_ORDER)


@register("streamed_monthly_state", ("STR-3",), oracle=f"""
WITH {scored_cte()}
SELECT strftime(sampled_at, '%Y-%m') AS month, count(*) AS observations, count(ph) AS ph_n, round(sum(ph), 3) AS ph_sum,
       count(fc) AS fc_n, {_CLASS_COUNTS} FROM scored GROUP BY 1
""")
def streamed_monthly_state(spark, sf_dir):
    """The running monthly state after the last event; one row a month, kept in the driver's memory table."""
    name = f"monthly_{uuid.uuid4().hex}"
    query = (ST.monthly_running(_events(spark, sf_dir)).writeStream.format("memory").queryName(name)
             .outputMode("complete").trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.table(name).select("month", "observations", "ph_n", F.round("ph_sum", 3).alias("ph_sum"), "fc_n",
                                    *[f"n_{c.replace(' ', '_').lower()}" for c in dims.CLASS_ORDER])
