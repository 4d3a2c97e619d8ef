"""Whitening of embeddings with a weighted covariance of the distinct vectors.

Each component c becomes the integer x = floor(scale * c) + shift.  Equal x
vectors are grouped; a group counts in the fit with its number of rows as its
weight (``weighted``) or with one.  The fit: exact integer sums per dimension,
then one centred product of matrices (X - S/n)' W (X - S/n) for each task over
its distinct vectors, added up over the tasks, and the eigenvectors of the d x d
result.  Each distinct vector is projected and scaled once, and the rows get the
values of their vector by a join.

Defined cases: a row whose vector is null, or holds a null or non-finite entry
(or one too large for a long), is dropped; a vector that is shorter than the
longest counts as if filled up with zeros; every other row counts, also with
a null or repeated vec_id, and repeated rows give repeated results; a component
without variance (its eigenvalue within rounding of zero) has ``explained`` of
its eigenvalue and a null ``whitened``, and takes no part in ``identity_error``,
which is null if there is no other; ``deviation`` is null where a long cannot
hold it; an empty table, or one without components, gives an empty result.

Scale: one shuffle groups the vectors, merged map-side, so a vector on a third
of all rows is one partial row a task.  The driver gets two numbers for each
dimension and d x d sums, whatever the number of rows.  In the join back,
vectors on more than one in ``HEAVY`` rows, so fewer than ``HEAVY`` of them, are
broadcast; the rest shuffle, and no key has more rows than that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverlens.llm.common import cut

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
HEAVY = 500             # a vector on more than one in HEAVY rows is joined by broadcast
RANK = 1e-12            # eigenvalues below this part of the largest are zero


def shifted(vector: Column, scale: int = SCALE, shift: int = SHIFT) -> Column:
    """floor(scale * c) + shift of each entry c, null where the vector takes no part."""
    whole = F.transform(vector, lambda c: c.cast("double") * scale)
    fine = F.forall(whole, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < 2.0 ** 62))
    return F.when(fine, F.transform(whole, lambda c: F.floor(c) + shift))


def _matrix(column: pa.Array, width: int, fill: int) -> np.ndarray:
    """Lists of longs as the rows of a matrix; entries that a row lacks are ``fill``."""
    ends = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)[ends[0]:ends[-1]]
    sizes = np.diff(ends)
    if (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.full((len(sizes), width), fill, dtype=np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """(x, copies): each x vector of ``rows`` (vec_id, x) once, with the number of its rows."""
    return cut(rows.groupBy("x").agg(F.count("*").alias("copies")), "distinct-vectors")


def sums(vectors: DataFrame, width: int, fill: int) -> list[int]:
    """The exact sum of each dimension over ``vectors`` (x, w)."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * width
        for batch in batches:
            x, w = _matrix(batch.column("x"), width, fill), batch.column("w").to_numpy()
            if float(np.abs(x).max(initial=0)) * float(w.sum()) >= 2.0 ** 62:
                x = x.astype(object)
            total = [a + int(b) for a, b in zip(total, (x * w[:, None]).sum(0))]
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array([str(v) for v in total])], ["k", "s"])

    parts = vectors.select("x", "w").mapInArrow(add, "k int, s string")
    found = parts.groupBy("k").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()    # a row per dimension
    return [int(r["s"]) for r in sorted(found, key=lambda r: r["k"])]


def scatter(vectors: DataFrame, centre: np.ndarray, fill: int, basis: np.ndarray | None = None) -> np.ndarray:
    """sum w (x - centre)' (x - centre) over ``vectors`` (x, w); with ``basis``, of the projections on its columns."""
    width = len(centre)
    size = width if basis is None else basis.shape[1]

    def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            y = _matrix(batch.column("x"), width, fill) - centre
            if basis is not None:
                y = y @ basis
            total += (y * batch.column("w").to_numpy()[:, None]).T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size * size)), pa.array(total.reshape(-1))], ["k", "v"])

    parts = vectors.select("x", "w").mapInArrow(product, "k long, v double")
    out = np.zeros(size * size)
    for r in parts.groupBy("k").agg(F.sum("v").alias("v")).collect():       # size x size rows
        out[r["k"]] = r["v"]
    return out.reshape(size, size)


def whitened_rows(rows: DataFrame, components: int = COMPONENTS, weighted: bool = True, fill: int = SHIFT) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of ``rows`` (vec_id, x: array<long> or null).

    ``weighted``: a distinct vector weighs as many as its rows in the fit, else
    one.  ``fill`` is the x of an entry that a vector lacks.
    """
    spark = rows.sparkSession
    rows = cut(rows.where("x is not null").select("vec_id", "x"), "vectors")
    vectors = distinct_vectors(rows)
    weight = F.col("copies") if weighted else F.lit(1).cast("long")
    vectors = vectors.withColumn("w", weight)
    size = vectors.agg(F.sum("w").alias("n"), F.max(F.size("x")).alias("d"), F.sum("copies").alias("rows")).first()
    n, width, kind = size["n"] or 0, size["d"] or 0, rows.schema["vec_id"].dataType.simpleString()
    if not width:
        return spark.createDataFrame([], f"vec_id {kind}, component int, n long, deviation long, whitened double, "
                                         "explained double, identity_error double")
    total = sums(vectors, width, fill)
    centre = np.array([s // n + (s % n) / n for s in total])
    values, basis = np.linalg.eigh(scatter(vectors, centre, fill) / n)
    values, basis = np.maximum(values[::-1], 0.0), basis[:, ::-1]
    trace, used = values.sum(), min(components, width)
    real = int((values[:used] > RANK * max(values[0], 1e-300)).sum()) if trace > 0 else 0
    scaled = basis[:, :real] / np.sqrt(values[:real])
    error = float(np.abs(scatter(vectors, centre, fill, scaled) / n - np.eye(real)).max()) if real else None
    explained = values[:used] / trace if trace > 0 else np.zeros(used)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.array(total, dtype=object)
        near = max(abs(v) for v in total) / n
        for batch in batches:
            x = _matrix(batch.column("x"), width, fill)
            white = np.full((len(x), used), np.nan)
            white[:, :real] = (x - centre) @ scaled
            # n x - S fits a long and its square sum too, or Python's integers take over
            most = float(n) * (float(np.abs(x).max(initial=0)) + near)
            if most < 2.0 ** 62 and (far := n * x - np.array(total, dtype=np.int64)).size and width * float(np.abs(far).max()) ** 2 < 2.0 ** 62:
                deviation = (far * far).sum(1).tolist()
            else:
                deviation = [int(v) if v < 2 ** 63 else None for v in ((n * x.astype(object) - whole) ** 2).sum(1)]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * used, pa.int32()),
                                             pa.array(white.reshape(-1), from_pandas=True))
            yield pa.RecordBatch.from_arrays([batch.column("x"), batch.column("copies"), pa.array(deviation, pa.int64()), lists],
                                             ["x", "copies", "deviation", "white"])

    done = cut(vectors.select("x", "copies").mapInArrow(project, "x array<long>, copies long, deviation long, white array<double>"),
               "whitened")
    heavy = F.col("copies") * HEAVY > size["rows"]
    common, rest = done.where(heavy).drop("copies"), done.where(~heavy).drop("copies")
    marked = rows.join(F.broadcast(common.withColumn("heavy", F.lit(True))), "x", "left")
    found = (marked.where("heavy").select("vec_id", "deviation", "white")
             .unionByName(marked.where("heavy is null").select("vec_id", "x").join(rest, "x").select("vec_id", "deviation", "white")))
    share = F.array(*[F.lit(float(v)) for v in explained])
    return found.select("vec_id", "deviation", F.posexplode("white").alias("k", "whitened")).select(
        "vec_id", (F.col("k") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("k")).alias("explained"), F.lit(error).cast("double").alias("identity_error"))
