"""Helpers shared by the operators: written cuts of the lineage and components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverlens.session import ensure_checkpoint_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/riverlens-{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the written table.

    Later stages read the files, so a lost executor costs a reread, not the
    recomputation of what came before; the written size also tells Catalyst
    honestly whether a side is small enough to broadcast.  The files may be
    removed as soon as the job's last output is written.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def packed(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct, so that own columns cannot clash."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


HEAVY = 1000    # a key on more than one in HEAVY rows is joined by broadcast


def join_known(rows: DataFrame, side: DataFrame, keys: list[str], n: str, total: int, every: DataFrame | None = None) -> DataFrame:
    """Inner join of ``rows`` with ``side``, which has one row a key and in ``n`` how many rows the key has.

    Of ``total`` rows fewer than ``HEAVY`` keys can have more than one in
    ``HEAVY`` each: their rows of ``side`` are broadcast, whatever the size of the
    table, and the others shuffle, so no task gets a hot key.  Where ``side`` lacks
    some of the hot keys, ``every`` has them (keys, n), so that they do not shuffle.
    """
    heavy = F.col(n) * HEAVY > total
    hot = (side if every is None else every).where(heavy).select(*keys)
    rest = rows.join(F.broadcast(hot), keys, "left_anti").join(side.where(~heavy).drop(n), keys)
    return rows.join(F.broadcast(side.where(heavy).drop(n)), keys).unionByName(rest)


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest reachable id of every node of the undirected ``edges`` (a, b).

    Returns one row (node, component) per node.  Labels spread by repeated
    minimum over neighbours with pointer jumping, so the number of rounds
    follows the logarithm of the diameter.  Every round is joins and
    pre-aggregated minima on Spark; the driver sees one count per round.
    """
    both = cut(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
               .where("a <> b").distinct(), "edges")
    labels = cut(both.groupBy(F.col("a").alias("node"))
                 .agg(F.least(F.col("node"), F.min("b")).alias("component")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("seen")))
        # hook: what a node saw is also news for the node that was its label
        news = (labels.join(near, "node").select("node", "component", F.least("component", "seen").alias("best")))
        hooks = (news.where("best < component")
                 .groupBy(F.col("component").alias("node")).agg(F.min("best").alias("hook")))
        hooked = (news.join(hooks, "node", "left")
                  .select("node", "component", F.least("best", "hook").alias("best")))
        parents = hooked.select(F.col("node").alias("best"), F.col("best").alias("jump"))
        fresh = cut(hooked.join(parents, "best", "left")
                    .select("node", "component", F.least("best", "jump").alias("best")), "labels")
        moved = fresh.where("best <> component").limit(1).count()
        labels = fresh.select("node", F.col("best").alias("component"))
        if not moved:
            return labels
