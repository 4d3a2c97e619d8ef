"""Every registered query against its DuckDB oracle on the smallest tables."""

import math

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL


def norm(v):
    """A value as the driver compares it: floats as they are, without any tolerance."""
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    if hasattr(v, "item"):
        return norm(v.item())
    return v if v is None or isinstance(v, (int, str, bool)) else str(v)


def rows(records, cols):
    return sorted((tuple(norm(r[c]) for c in cols) for r in records),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


ORACLES = entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF_SMALL)
    scols = sorted(sdf.columns)
    srec = [r.asDict() for r in sdf.collect()]
    rel = duck.sql(ORACLES[name])
    dcols = sorted(rel.columns)
    drec = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    assert scols == dcols
    assert rows(srec, scols) == rows(drec, dcols)


def test_every_query_runs(spark):
    for name, fn in entry.queries().items():
        df = fn(spark, SF_SMALL)
        assert df.columns, name


def test_entry_flagship(spark):
    out = entry.entry(spark).collect()
    assert [r["wqi_class"] for r in out] == ["Excellent", "Good", "Poor", "Very Poor", "Unsuitable"]
    assert sum(r["n"] for r in out) == 5959  # 6000 observations, 41 quarantined
