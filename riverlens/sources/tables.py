"""Driver tables and the observation view derived from them.

The sampling domain is carried on the TPC-H-style driver tables: one
observation per lineitem, the supplier is the station, its nation is the
state, the ship date is the sampling time and four measurements are
arithmetic on lineitem columns (some nulled by key residue so that every
missing-value path is exercised).  The same arithmetic is written as SQL in
``riverlens.plans.oracle`` for the DuckDB check.

Scale notes
-----------
* ``nation`` is a fixed 25-row dimension and is broadcast explicitly.
* ``supplier`` grows with the data, so it carries no hint: Spark broadcasts
  it only when its measured size is under ``autoBroadcastJoinThreshold``
  (and AQE re-checks at run time); otherwise the join is a sort-merge join
  with AQE skew splitting for a hot supplier.
* Only the columns each query needs reach the scan (Catalyst prunes the
  projection below), and filters on ``sampled_at`` push into parquet.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverlens.functions.scalars import no_nan

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table (parquet) by name."""
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _null_when_residue(key: Column, modulus: int, value: Column) -> Column:
    return F.when(key % modulus == 0, F.lit(None).cast("double")).otherwise(value)


def observation_id(orderkey: Column, linenumber: Column, partkey: Column,
                   suppkey: Column, shipdate: Column) -> Column:
    """Readable unique observation key (the five-column lineitem key)."""
    return F.concat_ws("-", orderkey.cast("string"), linenumber.cast("string"),
                       partkey.cast("string"), suppkey.cast("string"),
                       F.date_format(shipdate, "yyyyMMdd"))


def measurement_columns(li: str = "") -> dict[str, Column]:
    """Core measurements derived from lineitem columns.

    ``+ 0.0`` turns the ``-0.0`` present in discount and tax into ``0.0`` so
    that grouping and hashing see one zero.
    """
    c = lambda n: F.col(f"{li}{n}")
    key = c("l_orderkey")
    return {
        "ph": F.lit(5.2) + F.lit(0.07) * c("l_quantity"),
        "do_mgl": _null_when_residue(key, 37, F.lit(1.0) + F.lit(170.0) * c("l_tax") + F.lit(0.0)),
        "bod_mgl": _null_when_residue(key, 19, F.lit(90.0) * c("l_discount") + F.lit(0.0)),
        "fc": _null_when_residue(key, 13, c("l_extendedprice") / F.lit(50.0)),
    }


def coordinate_columns() -> dict[str, Column]:
    """Station coordinates; some rows carry none or an impossible latitude."""
    key = F.col("l_orderkey")
    supp = F.col("l_suppkey")
    lat = (F.lit(8.0) + (supp % 25).cast("double")
           + F.col("l_linenumber").cast("double") / F.lit(100.0))
    lon = F.lit(68.0) + (supp % 29).cast("double") + F.col("l_quantity") / F.lit(1000.0)
    lat = (F.when(key % 11 == 0, F.lit(None).cast("double"))
           .when(key % 17 == 0, F.lit(95.0)).otherwise(lat))
    lon = F.when(key % 11 == 0, F.lit(None).cast("double")).otherwise(lon)
    return {"latitude": lat, "longitude": lon}


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table as a stream of its files."""
    path = os.path.join(sf_dir, f"{name}.parquet*")     # a pattern: the table may be one file or a folder
    return spark.readStream.schema(read_table(spark, sf_dir, name).schema).parquet(path)


def observations(spark: SparkSession, sf_dir: str, with_coordinates: bool = False, raw: bool = False,
                 lineitem: DataFrame | None = None) -> DataFrame:
    """One row per sampling event; with ``raw`` before any cleaning.

    ``lineitem`` stands in for the table of that name, for instance as a stream.

    Columns: obs_id, station, state, sampled_at, ph, do_mgl, bod_mgl, fc
    (+ latitude, longitude).  Key: obs_id (unique at every scale factor).
    """
    li = read_table(spark, sf_dir, "lineitem") if lineitem is None else lineitem
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    cols = {
        "obs_id": observation_id(F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"),
                                 F.col("l_suppkey"), F.col("l_shipdate")),
        "station": F.col("s_name"),
        "state": F.col("n_name"),
        "sampled_at": F.col("l_shipdate"),
        **(raw_measurement_columns() if raw else measurement_columns()),
    }
    if with_coordinates:
        cols.update(coordinate_columns())
    joined = (li.join(supplier, li.l_suppkey == supplier.s_suppkey, "inner")
                .join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"), "inner"))
    return joined.select(*[v.alias(k) for k, v in cols.items()])


def raw_measurement_columns() -> dict[str, Column]:
    """The measurements with what raw feeds also hold: impossible values, supersaturated DO and NaN.

    NaN is read as missing at ingest, so it is null here already.
    """
    key, m = F.col("l_orderkey"), measurement_columns()
    m["ph"] = F.when(key % 41 == 0, F.lit(15.0)).otherwise(m["ph"])
    m["do_mgl"] = F.when(key % 43 == 0, F.lit(16.0)).when(key % 47 == 0, F.lit(31.0)).otherwise(m["do_mgl"])
    m["bod_mgl"] = F.when(key % 53 == 0, F.lit(-1.0)).otherwise(m["bod_mgl"])
    m["fc"] = F.when(key % 59 == 0, F.lit(float("nan"))).when(key % 61 == 0, F.lit(2.5e8)).otherwise(m["fc"])
    return {c: no_nan(v) for c, v in m.items()}


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One submission per customer (submission_id, payload): JSON with the four measurements and no label.

    By residue of the key some lack a value, hold text or a boolean where a
    number is due, carry a field too many, or a value out of bounds.
    """
    k = F.col("c_custkey")
    number = lambda x: x.cast("string")
    ph = number(F.lit(5.2) + F.lit(0.07) * (k % 50))
    ph = F.when(k % 19 == 1, F.lit('"7.2"')).when(k % 37 == 5, F.lit('""')).otherwise(ph)
    do = F.when(k % 29 == 3, F.lit("31.5")).otherwise(number(F.lit(1.0) + F.lit(1.7) * (k % 9)))
    bod = F.when(k % 31 == 4, F.lit("true")).otherwise(number(F.lit(0.9) * (k % 11)))
    fc = F.when(k % 17 != 0, number(F.abs(F.col("c_acctbal")) / F.lit(5.0)))
    field = lambda name, v: F.concat(F.lit(f'"{name}": '), v)
    fields = F.concat_ws(", ", field("ph", ph), field("do_mgl", do), field("bod_mgl", bod), field("fc", fc),
                         F.when(k % 23 == 2, F.lit('"station": "x"')))
    payload = F.when(k % 41 == 6, F.lit(None).cast("string")).otherwise(F.concat(F.lit("{"), fields, F.lit("}")))
    return read_table(spark, sf_dir, "customer").select(k.alias("submission_id"), payload.alias("payload"))


def extra_measurements() -> dict[str, Column]:
    """Further parameters carried by the chemical and physical feeds."""
    part = F.col("l_partkey")
    return {
        "ec": F.lit(100.0) + (part % 300).cast("double") * F.lit(8.0),
        "nitrate_n": (part % 60).cast("double") / F.lit(2.0),
        "temperature": F.lit(14.0) + (part % 29).cast("double"),
        "turbidity": (part % 23).cast("double") * F.lit(0.6),
    }
