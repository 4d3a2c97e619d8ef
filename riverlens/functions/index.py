"""Weighted arithmetic quality index as pure Column expressions.

Score = sum(q_i * w_i) / sum(w_i) over the parameters present in the row,
with w_i = 1 / S_i.  Everything is a Catalyst expression, so scoring is a
narrow projection inside whole-stage codegen: no UDF, no shuffle, and it
works unchanged on streaming DataFrames.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import dims
from .dims import IndexParameter


def usable(c: Column) -> Column:
    """A measurement as double with NaN treated as missing (pandas semantics)."""
    d = c.cast("double")
    return F.nanvl(d, F.lit(None).cast("double"))


def sub_index(param: IndexParameter, value: Column) -> Column:
    """Quality rating q_i for one parameter (null when the value is null)."""
    if param.code == "pH":
        return (F.when(value >= dims.PH_NEUTRAL,
                       (value - dims.PH_NEUTRAL) / dims.PH_SPAN_ABOVE * 100.0)
                .otherwise((dims.PH_NEUTRAL - value) / dims.PH_SPAN_BELOW * 100.0))
    if param.code == "DO":
        return F.abs(value - dims.DO_SATURATION) / dims.DO_SPAN * 100.0
    return F.abs(value - param.ideal) / (param.limit - param.ideal) * 100.0


def present_parameters(columns: Iterable[str]) -> list[IndexParameter]:
    """Index parameters whose canonical column exists, in summation order."""
    cols = set(columns)
    return [p for p in dims.INDEX_PARAMETERS if p.column in cols]


def compensated_sum(terms: Sequence[Column]) -> Column:
    """Sum of ``terms`` with Neumaier compensation, as one ``aggregate`` fold.

    This is the float summation of Python 3.12+ ``sum`` (the reference's
    arithmetic): an exactly-at-limit sample scores 99.99999999999997, not
    100.00000000000001, and keeps its class.  The running (sum, carry) pair
    is a lambda accumulator, so the optimizer can inline the score into
    filters and aggregates without duplicating any sub-expression.
    """
    zero = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("c"))

    def step(acc, x):
        t = acc["s"] + x
        comp = F.when(F.abs(acc["s"]) >= F.abs(x), (acc["s"] - t) + x).otherwise((x - t) + acc["s"])
        return F.struct(t.alias("s"), (acc["c"] + comp).alias("c"))

    def finish(acc):
        c = acc["c"]
        ok = (c != 0.0) & ~F.isnan(c) & (F.abs(c) != float("inf"))
        return F.when(ok, acc["s"] + c).otherwise(acc["s"])

    return F.aggregate(F.array(*terms), zero, step, finish)


# Relative distance to a class edge inside which the compensated sum is used.
EDGE_BAND = 1e-9


def with_score(df: DataFrame, params: Sequence[IndexParameter],
               min_parameters: int = dims.MIN_PARAMETERS, n_name: str = "n_params",
               score_name: str = "wqi_score") -> DataFrame:
    """Append n_params and wqi_score for the given parameter columns.

    Weights are redistributed over the parameters present in each row; rows
    with fewer than ``min_parameters`` usable values score null.
    """
    if not params:
        return df.withColumns({n_name: F.lit(0).cast("int"), score_name: F.lit(None).cast("double")})
    n = None
    wq_terms, w_terms = [], []
    for p in params:
        v = usable(F.col(p.column))
        weight = 1.0 / p.limit
        n_i = F.when(v.isNotNull(), 1).otherwise(0)
        n = n_i if n is None else n + n_i
        wq_terms.append(F.coalesce(sub_index(p, v) * weight, F.lit(0.0)))
        w_terms.append(F.when(v.isNotNull(), F.lit(weight)).otherwise(F.lit(0.0)))
    naive_wq = sum(wq_terms[1:], wq_terms[0])
    naive_w = sum(w_terms[1:], w_terms[0])
    df = df.withColumns({n_name: n.cast("int"), "_wq": naive_wq, "_w": naive_w})
    ok = (F.col(n_name) >= min_parameters) & (F.col("_w") > 0.0)
    naive = F.col("_wq") / F.col("_w")
    # The compensated fold (interpreted) only runs where rounding can move a class edge.
    edges = [u for _, u, *_ in dims.CLASSES if u is not None]
    near = None
    for e in edges:
        t = F.abs(naive - e) <= EDGE_BAND * e
        near = t if near is None else (near | t)
    exact = compensated_sum(wq_terms) / compensated_sum(w_terms)
    score = F.when(ok, F.when(near, exact).otherwise(naive))
    return df.withColumn(score_name, score).drop("_wq", "_w")


def class_label(score: Column, classes=dims.CLASSES) -> Column:
    """Class from score: upper edges inclusive, negatives in the first class."""
    expr = None
    for label, upper, *_ in classes:
        if upper is None:
            cond = F.lit(True)
        else:
            cond = score <= upper
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return F.when(score.isNotNull(), expr.otherwise(classes[-1][0]))


def potability(score: Column) -> Column:
    """1 when the score is at most 50, 0 above, null when unscored."""
    return F.when(score.isNotNull(),
                  F.when(score <= dims.POTABLE_MAX_SCORE, 1).otherwise(0)).cast("int")


def with_index(df: DataFrame, min_parameters: int = dims.MIN_PARAMETERS,
               classes=dims.CLASSES) -> DataFrame:
    """Append n_params, wqi_score, wqi_class and potability."""
    return (with_score(df, present_parameters(df.columns), min_parameters)
              .withColumns({"wqi_class": class_label(F.col("wqi_score"), classes),
                            "potability": potability(F.col("wqi_score"))}))


def contribution_columns(params: Sequence[IndexParameter]) -> Column:
    """Array of (parameter, value, sub_index, weight) structs for present values.

    Used by the long-form contribution operator; the array is built in-row
    and exploded, so it never groups or shuffles.
    """
    items = []
    for p in params:
        v = usable(F.col(p.column))
        items.append(F.when(v.isNotNull(), F.struct(
            F.lit(p.code).alias("parameter"),
            v.alias("value"),
            sub_index(p, v).alias("sub_index"),
            F.lit(1.0 / p.limit).alias("weight"),
        )))
    return F.filter(F.array(*items), lambda x: x.isNotNull())
