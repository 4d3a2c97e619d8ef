"""Exact top-k search by inner product with dual cover trees.

Vectors of integer components are grouped around pivots; the rows of a group
form blocks of about ``BLOCK`` rows.  Queries and data are indexed alike: a
block is a cover tree in numpy, whose nodes know a centre, a covering radius
and their largest norm.  For a query node q and a data node p no inner product
below them exceeds

    c_q . c_p + r_q |c_p| + r_p |c_q| + r_q r_p ,

so a pair of nodes whose bound is under the worst kth score of the query
node's queries is pruned, and so is a pair of whole blocks before it is sent
anywhere.  Scores are integers; ties go to the smaller id.

Defined cases: a vector that is null or empty, or holds a null or non-finite
component, takes no part, as query or as candidate; components that one of two
vectors lacks count as zero; a query gets all candidates if there are fewer
than k; a row is not its own candidate, and rows that repeat a query's id are
not either; other rows of equal vectors are; repeated ids with equal vectors
count once; a null id takes no part; an empty table gives an empty result.

Scale: of equal vectors only the k + 1 smallest ids can be in any answer, so
they are cut to these, map-side first, before anything is grouped, and a very
common vector never fills a block.  A first round compares each query block
with the data blocks around its own pivot; its kth scores prune the pairs of
blocks of the second.  Both rounds cogroup one query block with one data block,
so a task holds two blocks at a time, whatever the number of rows.  The driver
holds the pivots (from ``SAMPLE`` rows) and two numbers for each; the pairs of
blocks are a table that Spark makes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riverlens.llm.common import cut

BLOCK = 4096            # rows of a data block, about
QUERY_BLOCK = 1024      # rows of a query block, about
SAMPLE = 4096           # rows that the pivots are chosen from
PIVOTS = 1024           # pivots at most: more rows make more blocks around each
LEAF = 256              # rows under a node that is not split further


# ---- cover trees within a block

class Tree:
    """A cover tree as arrays: every node covers a run of the reordered rows."""

    def __init__(self, vectors: np.ndarray):
        self.order = np.arange(len(vectors))
        self.vectors = vectors
        self.lo: list[int] = []
        self.hi: list[int] = []
        self.children: list[list[int]] = []
        centres, radii = [], []
        todo = [(0, len(vectors), -1)]
        while todo:
            lo, hi, parent = todo.pop()
            rows = vectors[self.order[lo:hi]]
            # the node's point is the row nearest to the mean; all its rows lie within the radius
            point = rows[((rows - rows.mean(0)) ** 2).sum(1).argmin()]
            dist = np.sqrt(((rows - point) ** 2).sum(1))
            node = len(self.lo)
            self.lo.append(lo), self.hi.append(hi), self.children.append([])
            centres.append(point), radii.append(float(dist.max()))
            if parent >= 0:
                self.children[parent].append(node)
            if hi - lo <= LEAF or radii[-1] == 0:
                continue
            # children by separation: points further than half the radius from every earlier one
            near, owner, far = dist, np.zeros(hi - lo, dtype=np.int64), 1
            while near.max() > radii[-1] / 2 and far < 16:
                fresh = np.sqrt(((rows - rows[near.argmax()]) ** 2).sum(1))
                owner[fresh < near] = far
                near, far = np.minimum(near, fresh), far + 1
            sizes = np.bincount(owner, minlength=far)
            if sizes.max() == hi - lo:
                continue
            self.order[lo:hi] = self.order[lo:hi][np.argsort(owner, kind="stable")]
            ends = lo + np.cumsum(sizes)
            todo += [(int(e - s), int(e), node) for s, e in zip(sizes, ends) if s]
        self.centres, self.radii = np.array(centres), np.array(radii) * (1 + 1e-9)
        self.norms = np.sqrt((self.centres ** 2).sum(1))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows; in floating point only where that is exact."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2 ** 53:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def dual_search(q_ids: np.ndarray, q: np.ndarray, p_ids: np.ndarray, p: np.ndarray, k: int,
                floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, id, score) of the k best of ``p`` for each row of ``q``, as far as they reach ``floor``."""
    none = np.zeros(0, dtype=np.int64)
    if not len(q) or not len(p):
        return none, none, none
    one, two = Tree(q), Tree(p)
    q_ids, q, worst = q_ids[one.order], q[one.order], floor[one.order].astype(np.float64)
    p_ids, p = p_ids[two.order], p[two.order]
    best: dict[int, tuple] = {}     # by leaf of the query tree: (row, id, score), the k best of each row
    todo = [(0, 0)]
    while todo:
        a, b = todo.pop()
        lo, hi = one.lo[a], one.hi[a]
        bound = (one.centres[a] @ two.centres[b] + one.radii[a] * two.norms[b] + two.radii[b] * one.norms[a]
                 + one.radii[a] * two.radii[b])
        # worst: the score that a candidate has to reach, by query
        if bound * (1 + 1e-9 * np.sign(bound)) + 1e-6 < worst[lo:hi].min():
            continue
        if not one.children[a] and not two.children[b]:
            under = slice(two.lo[b], two.hi[b])
            scores = products(q[lo:hi], p[under])
            own = q_ids[lo:hi, None] == p_ids[None, under]
            scores[own] = np.iinfo(np.int64).min
            need = worst[lo:hi]
            if scores.shape[1] > k:
                need = np.maximum(need, np.partition(scores, -k, axis=1)[:, -k])
            row, col = np.nonzero((scores >= need[:, None]) & ~own)
            if not len(row):
                continue
            rows, ids, found = best.get(a, (none, none, none))
            rows, ids = np.concatenate([rows, row + lo]), np.concatenate([ids, p_ids[under][col]])
            found = np.concatenate([found, scores[row, col]])
            order = np.lexsort((ids, -found, rows))
            rows, ids, found = rows[order], ids[order], found[order]
            nth = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left")
            best[a] = rows[nth < k], ids[nth < k], found[nth < k]
            last = nth == k - 1
            worst[rows[last]] = np.maximum(worst[rows[last]], found[last])
        elif one.children[a] and (not two.children[b] or one.radii[a] > two.radii[b]):
            todo += [(c, b) for c in one.children[a]]
        else:
            # the most promising child last, so that it is searched first
            todo += [(a, c) for c in sorted(two.children[b], key=lambda c: one.centres[a] @ two.centres[c])]
    rows, ids, found = (np.concatenate([x[n] for x in best.values()]) if best else none for n in range(3))
    return one.order[rows], ids, found


# ---- blocks

def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component, null where the vector takes no part."""
    whole = F.transform(vector, lambda x: x.cast("double") * scale)
    fine = (F.size(vector) > 0) & F.forall(whole, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(fine, F.transform(whole, lambda x: F.floor(x)))


def _pivots(rows: DataFrame, n: int) -> tuple[np.ndarray, int]:
    """Pivots by farthest-first traversal over the sample that comes first in hash order, and the width of a vector."""
    width = rows.agg(F.max(F.size("v"))).first()[0] or 0
    sample = [r["v"] for r in rows.orderBy(F.xxhash64("vec_id", F.lit(3)), "vec_id").limit(SAMPLE).select("v").collect()]
    if not sample:
        return np.zeros((0, 0)), 0
    x = _matrix(sample, width)
    chosen = [0]
    dist = ((x - x[0]) ** 2).sum(1)
    while len(chosen) < min(n, len(x)) and dist.max() > 0:
        chosen.append(int(dist.argmax()))
        dist = np.minimum(dist, ((x - x[chosen[-1]]) ** 2).sum(1))
    return x[chosen], width


def _matrix(vectors, width: int) -> np.ndarray:
    """Rows of integers as a matrix of doubles, missing components as zeros."""
    out = np.zeros((len(vectors), width))
    for r, v in enumerate(vectors):
        out[r, :len(v)] = v
    return out


def _unpacked(column: pd.Series, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.float64).reshape(-1, width)


def _grouped(rows: DataFrame, pivots: np.ndarray, width: int, block: int) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """Rows with pivot and block, the (pivot, block) pairs, and the covering radius of each pivot (-1 without rows)."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = shared.value
        for part in batches:
            x = _matrix(part["v"].tolist(), width)
            d = (x ** 2).sum(1)[:, None] - 2 * x @ c.T + (c ** 2).sum(1)[None, :]
            at = d.argmin(1)
            away = np.sqrt(((x - c[at]) ** 2).sum(1))
            yield pd.DataFrame({"vec_id": part["vec_id"], "v": [r.tobytes() for r in x], "pivot": at.astype(np.int32), "away": away})

    placed = cut(rows.select("vec_id", "v").mapInPandas(nearest, "vec_id long, v binary, pivot int, away double"), "placed")
    groups = placed.groupBy("pivot").agg(F.count("*").alias("n"), F.max("away").alias("radius"))
    groups = groups.withColumn("parts", F.ceil(F.col("n") / block))
    radii, parts = np.full(len(pivots), -1.0), [1] * len(pivots)
    for r in groups.collect():      # a row per pivot
        radii[r["pivot"]], parts[r["pivot"]] = r["radius"], r["parts"]
    part = F.pmod(F.xxhash64("vec_id", F.lit(4)), F.get(F.lit(parts).cast("array<bigint>"), F.col("pivot")))
    blocks = groups.select("pivot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    return (placed.select("pivot", F.concat_ws("-", "pivot", part).alias("block"), "vec_id", "v"),
            blocks.select("pivot", F.concat_ws("-", "pivot", "part").alias("block")), radii)


def _compared(queries: DataFrame, data: DataFrame, cells: DataFrame, floors: DataFrame | None, width: int,
              k: int) -> DataFrame:
    """(query_id, vec_id, score): the k best within each cell (q_block, p_block)."""
    queries, data = queries.drop("pivot"), data.drop("pivot")
    if floors is None:
        queries = queries.withColumn("floor", F.lit(None).cast("long"))
    else:
        queries = queries.join(floors, queries["vec_id"] == floors["query_id"], "left").drop("query_id")
    left = queries.withColumnRenamed("block", "q_block").join(cells, "q_block")
    right = data.withColumnRenamed("block", "p_block").join(cells, "p_block")

    def search(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        floor = a["floor"].astype("float64").fillna(-math.inf).to_numpy()
        q_ids, p_ids = a["vec_id"].to_numpy(np.int64), b["vec_id"].to_numpy(np.int64)
        row, ids, scores = dual_search(q_ids, _unpacked(a["v"], width), p_ids, _unpacked(b["v"], width), k, floor)
        return pd.DataFrame({"query_id": q_ids[row], "vec_id": ids, "score": scores})

    keys = ["q_block", "p_block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(search, "query_id long, vec_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(rows: DataFrame, is_query: Column, k: int = 5, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) for ``rows`` (vec_id, v: array<long> or null); ``is_query`` picks the queries."""
    rows = cut(rows.where("vec_id is not null and v is not null").select("vec_id", "v", is_query.alias("q")).distinct(), "vectors")
    # of equal vectors only the k + 1 smallest ids can be among a query's k best
    same = Window.partitionBy("v").orderBy("vec_id")
    data = rows.withColumn("nth", F.row_number().over(same)).where(F.col("nth") <= k + 1).select("vec_id", "v")
    n = rows.count()
    pivots, width = _pivots(rows, min(PIVOTS, max(1, n // block)))
    if not n:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score"))
    data, p_blocks, p_radii = _grouped(data, pivots, width, block)
    # the queries gather around fewer of the same pivots, the ones that were chosen first
    lead = max(1, min(len(pivots), rows.where("q").count() // query_block))
    queries, q_blocks, q_radii = _grouped(rows.where("q").select("vec_id", "v"), pivots[:lead], width, query_block)

    def cells(pairs: DataFrame) -> DataFrame:
        return (pairs.join(q_blocks.select(F.col("pivot").alias("q_pivot"), F.col("block").alias("q_block")), "q_pivot")
                .join(p_blocks.select(F.col("pivot").alias("p_pivot"), F.col("block").alias("p_block")), "p_pivot")
                .select("q_block", "p_block"))

    # first round: each query block with the data blocks of its own pivot
    home = q_blocks.select(F.col("pivot").alias("q_pivot"), F.col("pivot").alias("p_pivot")).distinct()
    first = cut(_best(_compared(queries, data, cells(home), None, width, k), k), "home-scores")
    floors = first.where(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))
    worst = queries.join(floors, F.col("vec_id") == F.col("query_id"), "left").groupBy("pivot").agg(
        F.min("floor").alias("floor"), F.bool_or(F.col("floor").isNull()).alias("open"))
    floor = np.full(lead, -math.inf)
    for r in worst.collect():       # a row per pivot
        floor[r["pivot"]] = -math.inf if r["open"] else r["floor"]
    # second round: the pairs of pivots whose bound reaches the worst kth score around the query pivot
    norms = np.sqrt((pivots ** 2).sum(1))
    bound = (pivots[:lead] @ pivots.T + q_radii[:, None] * norms[None, :] + p_radii[None, :] * norms[:lead, None]
             + q_radii[:, None] * p_radii[None, :])
    near = (bound + 1e-6 * (1 + np.abs(bound)) >= floor[:, None]) & (q_radii >= 0)[:, None] & (p_radii >= 0)[None, :]
    np.fill_diagonal(near, False)
    far = rows.sparkSession.createDataFrame(pd.DataFrame(np.argwhere(near), columns=["q_pivot", "p_pivot"], dtype="int32"),
                                            "q_pivot int, p_pivot int")
    rest = _compared(queries, data, cells(far), floors, width, k)
    found = first.select("query_id", "vec_id", "score").union(rest)
    return _best(found, k).select("query_id", "rank", "vec_id", "score")


ORACLE = r"""
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda z: coalesce(z[1], 0) * coalesce(z[2], 0)))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 5
"""
