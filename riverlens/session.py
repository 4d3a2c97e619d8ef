"""Session helpers for tests, the bench and command-line use.

Library code never creates its own session: every operator receives
DataFrames.  These helpers only build a local session and make sure a
checkpoint directory exists when the cluster did not name one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "riverlens") -> SparkSession:
    """A local session configured the way the tests and bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("RIVERLENS_DRIVER_MEMORY", "8g"))
        .config("spark.sql.codegen.hugeMethodLimit", os.environ.get("RIVERLENS_HUGE_METHOD_LIMIT", "65535"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory.

    ``spark.checkpoint.dir`` (or an earlier ``setCheckpointDir``) is used as
    is.  Where it is unset, a scratch folder is made only for a ``local``
    master, whose executors share the driver's disk; on a cluster an unset
    folder is an error, since a driver-local path would not be readable by
    the executors.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="riverlens-ckpt-")
    sc.setCheckpointDir(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """Compute ``df`` once into the shared folder and return the written table.

    Several readers then share one run of what came before, a lost executor
    costs a reread only, and the files' size tells Catalyst whether a side is
    small.  The files can go once the job's last output is written.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/riverlens-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
