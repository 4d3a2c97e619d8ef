"""Small scalar helpers shared by several operators (all Catalyst expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riverlens.functions import dims


def log10_floor1(c: Column) -> Column:
    """SCL-2: log10(max(x, 1)); null stays null (``greatest`` alone would skip it)."""
    return F.when(c.isNotNull(), F.log10(F.greatest(c.cast("double"), F.lit(1.0))))


def no_nan(c: Column) -> Column:
    """A number as double with NaN read as missing (null)."""
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def rounded(c: Column, digits: int = 6) -> Column:
    """``F.round`` of a double column, in plain arithmetic where the value is not close to a rounding edge.

    Spark rounds a double through its decimal text.  Away from an edge the whole number of units is
    the same either way, and dividing it by a power of ten gives the double nearest to the decimal.
    """
    unit = 10.0 ** digits
    units = c * F.lit(unit)
    clear = (F.abs(units) < 1e12) & (F.abs(units - F.floor(units) - 0.5) > 1e-3)
    return F.when(clear, F.floor(units + 0.5) / F.lit(unit)).otherwise(F.round(c, digits))


def is_finite(c: Column) -> Column:
    """SCL-7: not null, not NaN, not infinite."""
    d = c.cast("double")
    return (d.isNotNull() & ~F.isnan(d) & (d != float("inf")) & (d != float("-inf")))


def in_bounds(c: Column, lo: float, hi: float) -> Column:
    """SCL-7: finite and inside the inclusive range."""
    return is_finite(c) & c.between(lo, hi)


def direction(c: Column, eps: float = dims.DIRECTION_EPS) -> Column:
    """SCL-8: sign label of an attribution with a small dead band."""
    return F.when(c > eps, "increases").when(c < -eps, "decreases").otherwise("neutral")


def slug(c: Column) -> Column:
    """SCL-4: lower-case, trimmed, non-alphanumerics collapsed to underscores."""
    return F.regexp_replace(F.lower(F.trim(c)), r"[^a-z0-9]+", "_")


def normalise_text(c: Column) -> Column:
    """SCL-4: strip + lower."""
    return F.lower(F.trim(c))
