"""Hard-negative mining by slot-decomposed selection.

An anchor's positives are its best rows of the same label.  A row of another
label is a negative for a positive p if its score lies in the window
[low * p, high * p].  The upper limits of an anchor's windows, in falling
order, cut the scores into disjoint slots: slot i holds the scores up to limit
i and above limit i + 1.  Every task keeps the k best rows of each slot, those
lists are merged by (anchor, slot), and the answer to window i is the k best of
slots i, i + 1, ... that reach its lower end: the overlapping windows share one
pass and one list a slot.

Both passes compare blocks of anchors with blocks of rows.  The first, for the
positives, pairs blocks of one bucket of labels only; the second all blocks.
Scores are integers; a product of matrices in floating point is used only where
the norms show it to be exact.  Ties go to the smaller vec_id.

Defined cases: rows with a null label, a null or empty vector, a null or
non-finite component, or a null vec_id take no part; components that one of two
vectors lacks count as zero; rows that repeat vec_id, label and vector count
once, and a row with an anchor's vec_id is none of its positives or negatives;
an anchor with fewer positives has fewer windows, a window with fewer rows
gives fewer; without positives, or in an empty table, nothing is returned; a
window of a negative positive score is empty (its upper end is the lower).

Scale: of equal vectors of one label only the few smallest ids can be in an
answer, so they are cut to these, map-side first, and a very common vector
never fills a block.  A hot label only has more blocks.  A cell holds one block
of ``ANCHORS`` anchors and one of ``ROWS`` rows (fewer if a vector has more than
``WIDE`` components), compared a tile at a time, and returns k rows an anchor and
slot at most; rows are shipped once for every ``ANCHORS`` anchors.  Scores must
fit a long.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riverlens.llm.common import cut
from riverlens.llm.topk import quantised     # noqa: F401  (the vectors' integers, as in the search)

ANCHORS, ROWS = 16_384, 65_536      # rows of a block, about
WIDE = 64                           # components of a vector that such blocks are meant for
TILE_A, TILE_B = 512, 8192          # rows of a tile: what is compared at once
LABELS = 256                        # buckets of labels in the first pass
LOWEST = np.iinfo(np.int64).min


def prepared(rows: DataFrame, is_anchor: Column, keep: int) -> tuple[DataFrame, int, int]:
    """Written (vec_id, label, v: binary longs, anchor, nth), the width of a vector and the largest square norm.

    ``nth`` numbers the rows of equal label and vector by vec_id: beyond
    ``keep`` they are dropped, unless they are anchors.
    """
    fit = (rows.where("vec_id is not null and label is not null and v is not null and size(v) > 0")
           .select("vec_id", "label", "v", is_anchor.alias("anchor")).distinct())
    same = Window.partitionBy("label", "v").orderBy("vec_id")
    first = (fit.select("vec_id", "label", "v").withColumn("nth", F.row_number().over(same)).where(F.col("nth") <= keep)
             .withColumn("anchor", F.lit(False)))
    both = first.unionByName(fit.where("anchor").withColumn("nth", F.lit(0)))
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    both = cut(both.withColumn("square", square), "mined-vectors")
    size = both.agg(F.max(F.size("v")).alias("d"), F.max("square").alias("s")).first()
    return both, size["d"] or 0, size["s"] or 0.0


def _matrix(vectors: pd.Series, width: int, kind: np.dtype) -> np.ndarray:
    flat, sizes = np.concatenate(vectors.to_list()), vectors.str.len().to_numpy()
    if (sizes == width).all():
        return flat.reshape(-1, width).astype(kind)
    out = np.zeros((len(sizes), width), dtype=kind)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def number_kind(square: float) -> np.dtype:
    """The numbers in which products of vectors of this square norm are exact: every partial sum stays below it."""
    return np.dtype(np.float32 if square < 2 ** 24 else np.float64 if square < 2 ** 53 else np.int64)


def best_per_list(lists: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best (score falling, id rising) of each list."""
    order = np.lexsort((ids, -scores, lists))
    of = lists[order]
    nth = np.arange(len(of)) - np.searchsorted(of, of, side="left")
    return order[nth < k]


def slot_tops(a: np.ndarray, b: np.ndarray, b_ids: np.ndarray, barred: Callable[[np.ndarray, np.ndarray], np.ndarray],
              limits: np.ndarray, floors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row of a, slot, id, score): the k best rows of ``b`` in each slot of each row of ``a``.

    ``limits`` (rows of a, slots) are the slots' upper ends in falling order;
    slot i ends above limit i + 1, the last one at its floor.  ``floors`` are
    the least scores that matter in a slot.  ``barred`` says which pairs, given
    by their rows, may not be compared.
    """
    most = {4: 2 ** 24, 8: 2 ** 53}[a.itemsize] if a.dtype.kind == "f" else np.iinfo(np.int64).max
    # no score is as large as ``most`` in size, so clipped ends stay right and fit the scores' type
    under = np.concatenate([np.clip(limits[:, 1:], -most, most - 1) + 1, np.full((len(limits), 1), -most)], axis=1)
    limits = np.clip(limits, -most, most).astype(a.dtype)
    need = np.maximum(under, np.clip(floors, -most, most)).astype(a.dtype)      # rises to the kth best score so far
    slots = limits.shape[1]
    held = tuple(np.zeros(0, dtype=np.int64) for _ in range(3))     # list (row * slots + slot), id, score
    for lo in range(0, len(a), TILE_A):
        mine = np.arange(lo, min(lo + TILE_A, len(a)))
        for at in range(0, len(b), TILE_B):
            theirs = np.arange(at, min(at + TILE_B, len(b)))
            scores = a[mine] @ b[theirs].T
            if at == 0 and len(theirs) > k:
                # the kth best of the first tile, so that few pairs are left to sort
                free = ~barred(mine[:, None], theirs[None, :])
                for s in range(slots):
                    inside = free & (scores <= limits[mine, s, None]) & (scores >= need[mine, s, None])
                    if inside.any():
                        kth = np.partition(np.where(inside, scores, a.dtype.type(-most)), -k, axis=1)[:, -k]
                        need[mine, s] = np.maximum(need[mine, s], kth)
            row, col = np.nonzero(scores >= need[mine].min(1)[:, None])
            found = scores[row, col]
            row, col = row + lo, col + at
            slot = (limits[row] >= found[:, None]).sum(1) - 1
            fit = np.flatnonzero(slot >= 0)
            fit = fit[found[fit] >= need[row[fit], slot[fit]]]
            fit = fit[~barred(row[fit], col[fit])]
            if not len(fit):
                continue
            lists = np.concatenate([held[0], row[fit] * slots + slot[fit]])
            ids = np.concatenate([held[1], b_ids[col[fit]]])
            found = np.concatenate([held[2], found[fit].astype(np.int64)])
            best = best_per_list(lists, found, ids, k)
            held = lists[best], ids[best], found[best]
            full = np.flatnonzero(np.bincount(held[0]) >= k)
            ends = np.searchsorted(held[0], full, side="right") - 1
            need[full // slots, full % slots] = np.maximum(need[full // slots, full % slots], held[2][ends])
    return held[0] // slots, held[0] % slots, held[1], held[2]


def compared(anchors: DataFrame, data: DataFrame, cells: DataFrame, width: int, square: float, k: int,
             same_label: bool) -> DataFrame:
    """(anchor_id, slot, vec_id, score): the k best rows of each slot within each cell (a_block, b_block)."""
    kind = number_kind(square)

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        ids, b_ids = left["vec_id"].to_numpy(np.int64), right["vec_id"].to_numpy(np.int64)
        if not len(ids) or not len(b_ids):
            return pd.DataFrame({"anchor_id": ids[:0], "slot": ids[:0].astype(np.int32), "vec_id": ids[:0], "score": ids[:0]})
        codes = pd.factorize(pd.concat([left["label"], right["label"]]))[0]
        labels, b_labels = codes[:len(ids)], codes[len(ids):]

        def barred(mine: np.ndarray, theirs: np.ndarray) -> np.ndarray:
            return ((labels[mine] == b_labels[theirs]) != same_label) | (ids[mine] == b_ids[theirs])

        limits = np.array(left["limits"].to_list(), dtype=np.int64)
        floors = np.array(left["floors"].to_list(), dtype=np.int64)
        row, slot, found, score = slot_tops(_matrix(left["v"], width, kind), _matrix(right["v"], width, kind), b_ids,
                                            barred, limits, floors, k)
        return pd.DataFrame({"anchor_id": ids[row], "slot": slot.astype(np.int32), "vec_id": found, "score": score})

    # both sides stem from one table: the anchors' columns get names of their own
    left = anchors.join(cells, "a_block").select(*[F.col(c).alias(c) for c in (
        "a_block", "b_block", "vec_id", "label", "v", "limits", "floors")])
    right = data.join(cells, "b_block").select("a_block", "b_block", "vec_id", "label", "v")
    keys = ["a_block", "b_block"]
    return (left.groupBy(*keys).cogroup(right.groupBy(*keys))
            .applyInPandas(search, "anchor_id long, slot int, vec_id long, score long"))


def blocked(rows: DataFrame, group: Column, size: int, name: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` with a column ``name`` (group, part), and the blocks that there are: about ``size`` rows each."""
    rows = rows.withColumn("_group", group)
    sizes = rows.groupBy("_group").agg(F.ceil(F.count("*") / size).cast("int").alias("_parts"))
    part = F.pmod(F.xxhash64("vec_id", "label"), F.col("_parts")).cast("int").alias("part")
    blocks = sizes.select("_group", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("part"))
    # a row for each group, LABELS at most
    rows = rows.join(F.broadcast(sizes), "_group").withColumn(name, F.struct(F.col("_group").alias("grp"), part))
    return rows.drop("_group", "_parts"), blocks.select(F.struct(F.col("_group").alias("grp"), "part").alias(name))


def best_of(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k)


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
                   anchor_block: int = ANCHORS, row_block: int = ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` has vec_id, label and v (array<long> or null); ``is_anchor`` picks
    the anchors.  A negative n of a positive p satisfies, in hundredths,
    low * p <= 100 * n <= high * p, so ``low`` <= ``high`` <= 100.
    """
    both, width, square = prepared(rows, is_anchor, max(positives, negatives) + 1)
    part = max(1, -(-width // WIDE))
    anchor_block, row_block = max(1, anchor_block // part), max(1, row_block // part)
    every = F.array(F.lit(np.iinfo(np.int64).max))
    anchors = both.where("anchor").select("vec_id", "label", "v")
    data = both.where("not anchor").select("vec_id", "label", "v")
    bucket = F.pmod(F.xxhash64("label"), F.lit(LABELS)).cast("int")

    # first pass: one slot without limits, among the rows of the anchor's label
    left, a_blocks = blocked(anchors.withColumn("limits", every).withColumn("floors", F.array(F.lit(LOWEST))), bucket, anchor_block, "a_block")
    right, b_blocks = blocked(data, bucket, row_block, "b_block")
    cells = a_blocks.join(b_blocks, F.col("a_block.grp") == F.col("b_block.grp"))
    near = compared(left, right, cells, width, square, positives, same_label=True)
    near = cut(best_of(near, ["anchor_id"], positives), "positives")

    # second pass: the slots between the windows' upper ends, among the rows of other labels
    upper, lower = (F.expr(f"score * {high} div 100 - if(score * {high} % 100 < 0, 1, 0)"),
                    F.expr(f"score * {low} div 100 + if(score * {low} % 100 > 0, 1, 0)"))
    windows = near.select("anchor_id", F.col("nth").alias("window"), F.col("vec_id").alias("positive_id"),
                          F.col("score").alias("positive_score"), upper.alias("upper"), lower.alias("lower"))
    ends = (windows.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("window", "upper", "lower"))).alias("w"))
            .select("anchor_id", F.col("w.upper").alias("limits"), F.col("w.lower").alias("floors")))
    # a slot also serves the windows before it, whose lower ends are higher: its own is the least that matters;
    # every anchor gets the same number of slots, those beyond its windows are empty
    pad = F.array_repeat(F.lit(LOWEST), positives)
    limits = F.slice(F.concat("limits", pad), 1, positives)
    floors = F.slice(F.concat("floors", F.array_repeat(F.lit(np.iinfo(np.int64).max), positives)), 1, positives)
    left = anchors.join(ends, anchors["vec_id"] == ends["anchor_id"]).drop("anchor_id").withColumns({"limits": limits, "floors": floors})
    one = F.lit(0)
    left, a_blocks = blocked(cut(left, "windowed-anchors"), one, anchor_block, "a_block")
    right, b_blocks = blocked(data, one, row_block, "b_block")
    cells = a_blocks.join(b_blocks, F.col("a_block.grp") == F.col("b_block.grp"))
    tops = compared(left, right, cells, width, square, negatives, same_label=False)
    tops = best_of(tops, ["anchor_id", "slot"], negatives).drop("nth")

    # an answer is a suffix of the slots: the slots in falling order of score, k for each at most
    lists = tops.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct(
        "slot", (-F.col("score")).alias("order"), "vec_id", "score"))).alias("found"))
    answers = windows.join(lists, "anchor_id").withColumn("answer", F.slice(F.filter("found", lambda x: (
        x["slot"] >= F.col("window") - 1) & (x["score"] >= F.col("lower")) & (x["score"] <= F.col("upper"))), 1, negatives))
    return answers.select("anchor_id", "positive_id", "positive_score", F.posexplode("answer").alias("k", "hit")).select(
        "anchor_id", "positive_id", (F.col("k") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("negative_id"),
        "positive_score", F.col("hit.score").alias("negative_score"))


ORACLE = r"""
WITH r AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike,
         list_sum(list_transform(list_zip(a.v, b.v), lambda z: coalesce(z[1], 0) * coalesce(z[2], 0)))::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.alike
               AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
