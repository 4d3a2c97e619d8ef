"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight and, over training time 0..1, a piecewise linear
schedule.  The weights fix how many words a source gives in all (its target);
the integral of its schedule, scaled to that target, is its cumulative
demand.  The documents of a source, in a fixed pseudo-random order and read
round and round, fill that demand; the inverse of the demand at the middle of
a document is the training position of that copy.  The mix is all copies,
range-sorted by position.

Size of a document: its number of words, 0 for a null text.  Targets stop at
``most`` times their source's size; the excess goes to the others by weight
until none is above.  A copy is taken when its middle lies below the target,
so a source's words differ from the target by half a document at most, and no
document is taken more than ``most`` times.

Defined cases: a null source is a source of its own, last in order; empty
texts have size 0 and change no target; a table without words has targets 0
and takes nothing of any size; ties in the order break by doc_id and size, so
equal rows are interchangeable; rows of one doc_id share a place in the order;
columns of any other name pass through ``mix``.

Scale: prefix sums run in two levels.  A source is cut into as many buckets
as its rows ask for (about ``bucket_rows`` each), so no window holds a hot
source.  Sources are ranked by a distributed sort, and the reshare loop sends
three numbers a round to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riverlens.llm.common import cut, packed

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: Knots (time, rate) per weight: the heavy sources fade, the light ones grow.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)))


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5,
                   most: int = 2) -> DataFrame:
    """(source, source_size, n_rows, turn, target) from rows (source, size); turn indexes ``weights``."""
    spark = sizes.sparkSession
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    ranked = sums.orderBy(F.col("source").asc_nulls_last()).rdd.zipWithIndex()
    turns = len(weights)
    rows = spark.createDataFrame(ranked.map(lambda x: (*x[0], x[1] % turns)),
                                 "source string, source_size long, n_rows long, turn long")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), F.col("turn").cast("int") + 1)
    rows = cut(rows.withColumn("weight", weight).withColumn("cap", most * F.col("source_size")), "sources")
    asked = share * (rows.agg(F.sum("source_size")).first()[0] or 0)
    level, below = 0.0, -1
    while True:
        capped = F.col("weight") * F.lit(level) > F.col("cap")
        n, used, left = rows.agg(F.count(F.when(capped, 1)), F.sum(F.when(capped, F.col("cap"))),
                                 F.sum(F.when(~capped, F.col("weight")))).first()
        if n == below or not left:
            break
        below, level = n, (asked - (used or 0)) / left
    target = F.least(F.col("weight") * F.lit(level), F.col("cap").cast("double"))
    return rows.select("source", "source_size", "n_rows", "turn", target.alias("target"))


def position(demand: Column, turn: Column, schedules: Sequence) -> Column:
    """Time at which the share ``demand`` (0..1) of a source's words is used up."""
    out = F.lit(None).cast("double")
    for k, knots in enumerate(schedules):
        areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:])]
        total, done, inverse = sum(areas), 0.0, F.lit(float(knots[-1][0]))
        parts = []
        for (t0, w0), (t1, w1), area in zip(knots, knots[1:], areas):
            x = demand * F.lit(total) - F.lit(done)
            root = F.sqrt(F.greatest(F.lit(0.0), w0 * w0 + F.lit(2 * (w1 - w0) / (t1 - t0)) * x))
            parts.append((done + area, F.lit(t0) + F.when(x > 0, 2 * x / (w0 + root)).otherwise(0.0)))
            done += area
        for upto, expr in reversed(parts):
            inverse = F.when(demand * F.lit(total) < F.lit(upto), expr).otherwise(inverse)
        out = F.when(turn == k, inverse).otherwise(out)
    return out


def mix_plan(rows: DataFrame, weights: Sequence[int] = WEIGHTS, schedules: Sequence = SCHEDULES,
             share: float = 1.5, most: int = 2, bucket_rows: int = 4096) -> DataFrame:
    """``rows`` (doc_id, source, size, ...) with source_size, target, copies and positions (array).

    The added columns also include ``turn`` and ``before``, the words that
    precede the document in one reading of its source.
    """
    if len(schedules) != len(weights):
        raise ValueError("one schedule per weight")
    targets = cut(source_targets(rows, weights, share, most), "targets")
    order = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, 13),
                   16, 10).cast("long")
    rows = rows.withColumn("order", order)
    targets = targets.withColumnRenamed("source", "t_source").withColumn(
        "buckets", F.ceil(F.col("n_rows") / bucket_rows).cast("long"))
    rows = rows.join(targets, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")
    rows = rows.withColumn("bucket", F.floor(F.col("order") / F.lit(2.0 ** 52) * F.col("buckets")))
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("s_source"), F.col("bucket").alias("s_bucket"),
                       F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("base"))
    inside = (Window.partitionBy("source", "bucket").orderBy("order", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(sums, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("bucket") == F.col("s_bucket")))
    rows = rows.withColumn("before", F.col("base") + F.col("inner"))
    middle = F.col("before") + F.col("size") / 2
    copies = F.when(F.col("source_size") > 0, F.greatest(
        F.lit(0), F.ceil((F.col("target") - middle) / F.col("source_size")))).otherwise(0).cast("int")
    rows = rows.withColumn("copies", copies)
    demand = lambda e: (middle + e * F.col("source_size")) / F.col("target")
    places = F.when(F.col("copies") > 0, F.transform(
        F.sequence(F.lit(0), F.col("copies") - 1), lambda e: position(demand(e), F.col("turn"), schedules)))
    return (rows.withColumn("positions", F.coalesce(places, F.array().cast("array<double>")))
            .drop("order", "bucket", "buckets", "n_rows", "s_source", "s_bucket", "base", "inner"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The training stream: a row of ``docs`` per taken copy, range-sorted by its training position.

    Once written, ``stream_order`` reads the order off the files.
    """
    rows = docs.select("doc_id", "source", size_of(F.col("text")).alias("size"), packed(docs).alias("row"))
    copies = mix_plan(rows, **options).select("row", F.explode("positions").alias("position"))
    return (copies.repartitionByRange("position").sortWithinPartitions("position", "row.doc_id")
            .select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns]))


def stream_order(written: DataFrame) -> DataFrame:
    """(doc_id, text, position) of a written stream, range-sorted by the row's place in it, 0 for the first.

    A reread packs files by size, so the place comes from the number of the
    range part, which is in the file's name, and the row's place in the file.
    The driver sees one count per file.
    """
    file = F.col("_metadata.file_name")
    rows = written.select("doc_id", "text", F.regexp_extract(file, r"^part-(\d+)", 1).cast("long").alias("part"),
                          F.coalesce(F.regexp_extract(file, r"-c(\d+)\.", 1).try_cast("long"), F.lit(0)).alias("piece"),
                          F.col("_metadata.row_index").alias("at"))
    ahead, bases = 0, []
    for part, piece, n in sorted(map(tuple, rows.groupBy("part", "piece").count().collect())):
        bases.append((part, piece, ahead))
        ahead += n
    bases = written.sparkSession.createDataFrame(bases, "part long, piece long, base long")
    return (rows.join(F.broadcast(bases), ["part", "piece"])
            .select("doc_id", "text", (F.col("base") + F.col("at")).alias("position"))
            .repartitionByRange("position").sortWithinPartitions("position"))


ORACLE = r"""
WITH s AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM s GROUP BY source),
ranked AS (
  SELECT *, 2 * source_size AS cap,
         [5, 2, 1][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1] AS weight FROM per),
filled AS (
  SELECT *, (SELECT 1.5::DOUBLE * sum(source_size) FROM per) AS asked,
         coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, source
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS used,
         sum(weight) OVER (ORDER BY cap::DOUBLE / weight, source
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS free FROM ranked),
level AS (SELECT max((asked - used) / free) AS l FROM filled),
targets AS (SELECT source, source_size, least(weight * l, cap::DOUBLE) AS target FROM ranked, level),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         coalesce(sum(s.size) OVER (PARTITION BY s.source
           ORDER BY substr(md5(coalesce(s.doc_id::VARCHAR, '')), 1, 13), s.doc_id, s.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * CASE WHEN source_size > 0
                    THEN greatest(0, ceil((target - (before + size / 2.0::DOUBLE)) / source_size)) ELSE 0 END)::BIGINT AS taken
FROM placed
"""
