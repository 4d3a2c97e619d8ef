"""SQL fragments for the independent DuckDB check.

The driver registers the parquet tables as views; every oracle query starts
from the same observation mapping as ``riverlens.sources.tables``, written
here as plain SQL.  Doubles are spelled ``CAST('x' AS DOUBLE)`` so DuckDB
does not fall back to DECIMAL arithmetic.
"""

from __future__ import annotations

from riverlens.functions import dims


def d(x: float) -> str:
    """A double literal both engines read identically."""
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def _residue_null(mod: int, expr: str) -> str:
    return f"CASE WHEN l_orderkey % {mod} = 0 THEN NULL ELSE {expr} END"


OBS_ID = ("concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), "
          "CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), strftime(l_shipdate, '%Y%m%d'))")

MEASUREMENTS = {
    "ph": f"{d(5.2)} + {d(0.07)} * l_quantity",
    "do_mgl": _residue_null(37, f"{d(1.0)} + {d(170.0)} * l_tax + {d(0.0)}"),
    "bod_mgl": _residue_null(19, f"{d(90.0)} * l_discount + {d(0.0)}"),
    "fc": _residue_null(13, f"l_extendedprice / {d(50.0)}"),
}

RAW_MEASUREMENTS = {
    "ph": f"CASE WHEN l_orderkey % 41 = 0 THEN {d(15.0)} ELSE {MEASUREMENTS['ph']} END",
    "do_mgl": (f"CASE WHEN l_orderkey % 43 = 0 THEN {d(16.0)} WHEN l_orderkey % 47 = 0 THEN {d(31.0)} "
               f"ELSE {MEASUREMENTS['do_mgl']} END"),
    "bod_mgl": f"CASE WHEN l_orderkey % 53 = 0 THEN {d(-1.0)} ELSE {MEASUREMENTS['bod_mgl']} END",
    "fc": (f"CASE WHEN l_orderkey % 59 = 0 THEN NULL WHEN l_orderkey % 61 = 0 THEN {d(2.5e8)} "
           f"ELSE {MEASUREMENTS['fc']} END"),
}

COORDINATES = {
    "latitude": (f"CASE WHEN l_orderkey % 11 = 0 THEN NULL WHEN l_orderkey % 17 = 0 THEN {d(95.0)} "
                 f"ELSE {d(8.0)} + CAST(l_suppkey % 25 AS DOUBLE) + CAST(l_linenumber AS DOUBLE) / {d(100.0)} END"),
    "longitude": (f"CASE WHEN l_orderkey % 11 = 0 THEN NULL "
                  f"ELSE {d(68.0)} + CAST(l_suppkey % 29 AS DOUBLE) + l_quantity / {d(1000.0)} END"),
}

EXTRAS = {
    "ec": f"{d(100.0)} + CAST(l_partkey % 300 AS DOUBLE) * {d(8.0)}",
    "nitrate_n": f"CAST(l_partkey % 60 AS DOUBLE) / {d(2.0)}",
    "temperature": f"{d(14.0)} + CAST(l_partkey % 29 AS DOUBLE)",
    "turbidity": f"CAST(l_partkey % 23 AS DOUBLE) * {d(0.6)}",
}


def obs_cte(with_coordinates: bool = False, name: str = "obs", raw: bool = False) -> str:
    cols = [f"{OBS_ID} AS obs_id", "s_name AS station", "n_name AS state", "l_shipdate AS sampled_at"]
    cols += [f"{v} AS {k}" for k, v in (RAW_MEASUREMENTS if raw else MEASUREMENTS).items()]
    if with_coordinates:
        cols += [f"{v} AS {k}" for k, v in COORDINATES.items()]
    return (f"{name} AS (SELECT {', '.join(cols)} FROM lineitem "
            "JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)")


def sub_index_sql(p: dims.IndexParameter, v: str) -> str:
    if p.code == "pH":
        return (f"(CASE WHEN {v} >= {d(dims.PH_NEUTRAL)} THEN ({v} - {d(dims.PH_NEUTRAL)}) / "
                f"{d(dims.PH_SPAN_ABOVE)} * {d(100.0)} ELSE ({d(dims.PH_NEUTRAL)} - {v}) / "
                f"{d(dims.PH_SPAN_BELOW)} * {d(100.0)} END)")
    if p.code == "DO":
        return f"(abs({v} - {d(dims.DO_SATURATION)}) / {d(dims.DO_SPAN)} * {d(100.0)})"
    return f"(abs({v} - {d(p.ideal)}) / ({d(p.limit)} - {d(p.ideal)}) * {d(100.0)})"


def _neumaier_ctes(src: str, terms: list[str], out: str, tmp: str, name: str) -> tuple[str, str]:
    """CTE chain computing ``out`` = compensated (Neumaier) sum of ``terms``."""
    ctes = [f"{name}0 AS (SELECT *, {d(0.0)} AS {tmp}_s, {d(0.0)} AS {tmp}_c FROM {src})"]
    for i, x in enumerate(terms):
        s, c = f"{tmp}_s", f"{tmp}_c"
        ctes.append(
            f"{name}{i + 1} AS (SELECT * EXCLUDE ({s}, {c}), {s} + ({x}) AS {s}, {c} + CASE WHEN abs({s}) >= abs({x}) "
            f"THEN ({s} - ({s} + ({x}))) + ({x}) ELSE (({x}) - ({s} + ({x}))) + {s} END AS {c} "
            f"FROM {name}{i})")
    last = f"{name}{len(terms)}"
    ctes.append(f"{name}_out AS (SELECT * EXCLUDE ({tmp}_s, {tmp}_c), CASE WHEN {tmp}_c <> 0 AND isfinite({tmp}_c) "
                f"THEN {tmp}_s + {tmp}_c ELSE {tmp}_s END AS {out} FROM {last})")
    return ", ".join(ctes), f"{name}_out"


def index_ctes(src: str, columns, name: str = "_idx") -> tuple[str, str]:
    """CTE chain adding n_params and wqi_score to ``src``; returns (sql, final cte)."""
    params = [p for p in dims.INDEX_PARAMETERS if p.column in set(columns)]
    n_terms, wq_terms, w_terms = [], [], []
    for p in params:
        v = p.column
        w = d(1.0 / p.limit)
        n_terms.append(f"(CASE WHEN {v} IS NOT NULL THEN 1 ELSE 0 END)")
        wq_terms.append(f"coalesce({sub_index_sql(p, v)} * {w}, {d(0.0)})")
        w_terms.append(f"(CASE WHEN {v} IS NOT NULL THEN {w} ELSE {d(0.0)} END)")
    base = f"{name}_n AS (SELECT *, CAST({' + '.join(n_terms)} AS INTEGER) AS n_params FROM {src})"
    a_sql, a_out = _neumaier_ctes(f"{name}_n", wq_terms, "_wq", "_a", f"{name}_a")
    b_sql, b_out = _neumaier_ctes(a_out, w_terms, "_w", "_b", f"{name}_b")
    fin = (f"{name} AS (SELECT * EXCLUDE (_wq, _w), CASE WHEN n_params >= {dims.MIN_PARAMETERS} AND _w > 0 "
           f"THEN _wq / _w END AS wqi_score FROM {b_out})")
    return ", ".join([base, a_sql, b_sql, fin]), name


def class_sql(score: str) -> str:
    parts = []
    for label, upper, *_ in dims.CLASSES:
        if upper is None:
            parts.append(f"ELSE '{label}'")
        else:
            parts.append(f"WHEN {score} <= {d(upper)} THEN '{label}'")
    return f"CASE WHEN {score} IS NULL THEN NULL {' '.join(parts)} END"


def potability_sql(score: str) -> str:
    return (f"CAST(CASE WHEN {score} IS NULL THEN NULL WHEN {score} <= {d(dims.POTABLE_MAX_SCORE)} "
            "THEN 1 ELSE 0 END AS INTEGER)")


def scored_cte(name: str = "scored", src: str = "obs", with_coordinates: bool = False, raw: bool = False) -> str:
    """obs CTE followed by a CTE adding n_params, wqi_score, wqi_class, potability."""
    cols = ["ph", "do_mgl", "bod_mgl", "fc"]
    idx_sql, idx = index_ctes(src, cols)
    return (f"{obs_cte(with_coordinates, raw=raw)}, {idx_sql}, "
            f"{name} AS (SELECT *, {class_sql('wqi_score')} AS wqi_class, "
            f"{potability_sql('wqi_score')} AS potability FROM _idx)")


def class_dim_sql(name: str = "classes") -> str:
    rows = []
    for i, (label, upper, cat, rng, pot) in enumerate(dims.CLASSES, start=1):
        rows.append(f"('{label}', {i}, '{cat}', '{rng}', {pot})")
    return (f"{name}(wqi_class, class_order, category, wqi_range, binary_potability) AS "
            f"(SELECT * FROM (VALUES {', '.join(rows)}))")
