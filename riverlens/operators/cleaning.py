"""Cleaning with fitted state (CLN-1..5), name canonicalisation (PRJ-2/3), down-sampling (FLT-4).

The fitted state (dropped columns, imputation values) is computed by one
aggregation on the fitting frame and stored in a small dataclass; applying
it to another frame never recomputes anything (no leakage from test data).
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverlens.functions import dims
from riverlens.functions.scalars import no_nan
from riverlens.operators.history import deduplicate
from riverlens.operators.profile import remove_invalid
from riverlens.operators.quantiles import exact_quantiles, melt
from riverlens.operators.split import order_key


@dataclass
class CleaningState:
    """CLN-1/2 fitted state; JSON-serialisable."""
    dropped_columns: list[str] = field(default_factory=list)
    fill_values: dict[str, float] = field(default_factory=dict)
    strategy: str = "median"

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @staticmethod
    def from_json(text: str) -> "CleaningState":
        return CleaningState(**json.loads(text))


def is_missing(df: DataFrame, c: str) -> Column:
    """Null, or NaN in a floating-point column."""
    if df.schema[c].dataType.typeName() in ("double", "float"):
        return F.col(f"`{c}`").isNull() | F.isnan(F.col(f"`{c}`"))
    return F.col(f"`{c}`").isNull()


def missing_shares(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing percentage per column, one aggregation (long form)."""
    one = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(is_missing(df, c)).alias(f"_m{i}")
                                                   for i, c in enumerate(columns)])
    arr = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_m{i}").alias("missing"))
                    for i, c in enumerate(columns)])
    return one.select("_n", F.inline(arr)).select(
        "column_name", F.when(F.col("_n") > 0, F.col("missing") * 100.0 / F.col("_n")).otherwise(0.0).alias("pct"))


def sparse_columns(df: DataFrame, threshold: float = 40.0, protected: Sequence[str] = ()) -> DataFrame:
    """CLN-1: columns whose missing share is strictly above the threshold (as rows)."""
    cols = [c for c in df.columns if c not in protected]
    return missing_shares(df, cols).where(F.col("pct") > threshold)


def fit_cleaning(df: DataFrame, features: Sequence[str] = dims.MODEL_FEATURES, threshold: float = 40.0,
                 protected: Sequence[str] = (), strategy: str = "median",
                 constant: float = 0.0) -> CleaningState:
    """CLN-1 + CLN-2 fit: sparse columns to drop, fill values from this frame only."""
    dropped = [r["column_name"] for r in sparse_columns(df, threshold, protected).collect()]  # <= #columns
    keep = [c for c in features if c not in dropped]
    fills: dict[str, float] = {}
    if strategy == "median" and keep:
        for r in exact_quantiles(melt(df, keep), "value", [0.5], ["feature"]).collect():  # one row per column
            fills[r["feature"]] = r["quantile"]
    elif strategy == "mean" and keep:
        row = df.agg(*[F.avg(no_nan(F.col(c))).alias(c) for c in keep]).first()
        fills = {c: row[c] for c in keep if row[c] is not None}
    elif strategy == "constant":
        fills = {c: float(constant) for c in keep}
    elif strategy != "drop_rows":
        raise ValueError(f"unknown strategy {strategy!r}")
    return CleaningState(dropped, fills, strategy)


def apply_cleaning(df: DataFrame, state: CleaningState, features: Sequence[str] = dims.MODEL_FEATURES) -> DataFrame:
    """CLN-1/2/3 transform with a fitted state (CLN-3: ``drop_rows`` drops incomplete rows)."""
    out = df.drop(*[c for c in state.dropped_columns if c in df.columns])
    if state.strategy == "drop_rows":
        return out.dropna(subset=[c for c in features if c in out.columns])
    return out.fillna(state.fill_values)


def imputation_audit(before: DataFrame, state: CleaningState) -> DataFrame:
    """CLN-4: values filled per column and the shape change, one aggregation."""
    cols = [c for c in state.fill_values if c in before.columns]
    one = before.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(is_missing(before, c)).alias(c) for c in cols])
    arr = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("imputed")) for c in cols]) if cols \
        else F.array().cast("array<struct<column_name:string,imputed:bigint>>")
    return one.select("rows", F.inline(arr)).select(
        "column_name", F.col("imputed").cast("long"), F.col("rows").cast("long"),
        F.lit(len(before.columns) - len([c for c in state.dropped_columns if c in before.columns])).alias("columns_after"))


def run_cleaning(df: DataFrame, features: Sequence[str] = dims.MODEL_FEATURES, threshold: float = 40.0,
                 protected: Sequence[str] = ("wqi_class", "potability"), strategy: str = "median",
                 remove_invalid_rows: bool = True) -> tuple[DataFrame, CleaningState]:
    """CLN-5: duplicates -> missing values -> impossible values, on one plan."""
    dedup = deduplicate(df)
    state = fit_cleaning(dedup, features, threshold, protected, strategy)
    cleaned = apply_cleaning(dedup, state, features)
    return remove_invalid(cleaned, enabled=remove_invalid_rows), state


def canonical_names(df: DataFrame, aliases: dict[str, str] = dims.ALIASES) -> DataFrame:
    """PRJ-2 / PRJ-3: rename known headers and short codes to canonical columns.

    When a long header and a short code both map to one parameter, the long
    header's value wins and the short code fills its gaps (``coalesce``).
    Unknown names pass through unchanged.
    """
    code_to_col = dims.CODE_COLUMNS
    groups: dict[str, list[str]] = {}
    passthrough = []
    for c in df.columns:
        code = aliases.get(c.strip().lower())
        if code and code in code_to_col:
            groups.setdefault(code_to_col[code], []).append(c)
        else:
            passthrough.append(c)
    sel = [F.col(f"`{c}`") for c in passthrough if c not in groups]
    for target, names in groups.items():
        names = sorted(names, key=lambda n: len(n), reverse=True)   # full header first
        sel.append(F.coalesce(*[F.col(f"`{n}`") for n in names]).alias(target))
    return df.select(*sel)


def seeded_sample(df: DataFrame, n: int, key: str = "obs_id", seed: int = 42) -> DataFrame:
    """FLT-4: a seeded down-sample of exactly ``n`` rows (top-k by the split's order key, not a full sort)."""
    return df.orderBy(order_key(F.col(key), seed), F.col(key)).limit(n)
