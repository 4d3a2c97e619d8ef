"""Raw feeds: three measurement categories per state, and CSV / config readers.

On the driver tables the feeds are projections of the same lineitem rows:
biological (line number <= 6), chemical (all) and physical (line number
<= 3).  Each feed carries the event key, station metadata and a day-first
acquisition-time text in its own format, so the join, the metadata drop and
the mixed-format timestamp parse all run on whole tables.

For files on disk (the reference's layout of one CSV per state and
category) ``locate_feeds`` and ``read_feed_csv`` do the same with
``spark.read``.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverlens.functions.scalars import no_nan
from riverlens.session import written
from riverlens.sources.tables import (extra_measurements, measurement_columns, observation_id,
                                      read_table)

EVENT_KEY = ("state", "station", "event_key")
METADATA = ("station_code", "acquired_text")
CATEGORIES = ("biological", "chemical", "physical")

# FIXED VALUES: tokens read as missing in text feeds (pandas defaults).
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
             "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (li.join(supplier, li.l_suppkey == supplier.s_suppkey, "inner")
              .join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"), "inner"))


def driver_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three feeds on the driver tables, keyed by category."""
    base = _base(spark, sf_dir)
    m = measurement_columns()
    x = extra_measurements()
    key = {
        "state": F.col("n_name"),
        "station": F.col("s_name"),
        "event_key": observation_id(F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"),
                                    F.col("l_suppkey"), F.col("l_shipdate")),
        "station_code": F.col("s_suppkey"),
    }

    def project(where, fmt, cols):
        sel = {**key, "acquired_text": F.date_format(F.col("l_shipdate"), fmt), **cols}
        df = base.where(where) if where is not None else base
        return df.select(*[v.alias(k) for k, v in sel.items()])

    line = F.col("l_linenumber")
    return {
        "biological": project(line <= 6, "dd/MM/yyyy HH:mm",
                              {"bod_mgl": m["bod_mgl"], "do_mgl": m["do_mgl"], "fc": m["fc"]}),
        "chemical": project(None, "dd-MM-yyyy HH:mm",
                            {"ph": m["ph"], "ec": x["ec"], "nitrate_n": x["nitrate_n"]}),
        "physical": project(line <= 3, "dd-MM-yyyy HH:mm",
                            {"temperature": x["temperature"], "turbidity": x["turbidity"]}),
    }


def locate_feeds(spark: SparkSession, raw_dir: str, states: tuple[str, ...]) -> dict[tuple[str, str], str]:
    """SRC-1: one CSV per (state, category): the first path whose name holds both, in any case.

    The names come from Spark's own listing, so any store it reads will do; no
    file content is read.  A missing pair raises.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.[cC][sS][vV]*").load(raw_dir).select("path")
    paths = sorted(r["path"] for r in listed.collect())      # a few files per state
    found, missing = {}, []
    for state in states:
        for category in CATEGORIES:
            hits = [p for p in paths if re.search(
                f"{re.escape(state.lower())}.*{category}", unquote(p).rsplit("/", 1)[-1].lower())]
            if hits:
                found[state, category] = hits[0]
            else:
                missing.append((state, category))
    if missing:
        raise FileNotFoundError(f"missing raw feeds: {missing}")
    return found


def coerced(df: DataFrame, numeric: tuple[str, ...] = ()) -> DataFrame:
    """VAL-4: text columns trimmed, NA tokens null, ``numeric`` ones as doubles (null where no number)."""
    out = []
    for c in df.columns:
        v = F.trim(F.col(f"`{c}`"))
        v = F.when(~v.isin(*NA_TOKENS), v)
        out.append((no_nan(v.try_cast("double")) if c in numeric else v).alias(c))
    return df.select(*out)


# what is wrong with a line: fewer cells than columns, more, or a quoted cell that is not closed
LINE_KINDS = ("short", "long", "quote")
_QUOTED = r'(^|,)\s*"[^"]*(?:""[^"]*)*"(?=\s*(?:,|$))'


def read_feed_lines(spark: SparkSession, path: str, columns: tuple[str, ...] | None = None) -> DataFrame:
    """SRC-2: the cells of a CSV as text, with ``line_kind`` (null for a good line), ``line`` (as it stands in the file) and ``file``.

    ``columns`` names the columns of files without a header; else the first
    line of every file is one.  A line is a row (cells with line breaks are not
    supported, so that large files can be split); blank lines are none.  The
    reader's own PERMISSIVE mode keeps a bad line only where it has too few or
    too many cells and loses an open quote at the end, so the lines are read as
    text, judged, and parsed by ``from_csv``.  Written once.
    """
    options = {"escape": '"', "mode": "PERMISSIVE"}
    names = list(columns or spark.read.options(header=True, encoding="UTF-8", **options).csv(path).columns)
    places = [f"_c{i}" for i in range(len(names))]
    line = F.col("value")
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file")).where(F.trim(line) != "")
    lines = lines.withColumn("_cells", F.from_csv(line, ", ".join(f"{c} STRING" for c in places), options))
    if not columns:
        header = F.array(*[F.coalesce(F.col(f"_cells.{c}"), F.lit("")) for c in places])
        lines = lines.where(header != F.array(*[F.lit(n) for n in names]))
    bare = F.regexp_replace(line, _QUOTED, "$1")
    cells = F.length(bare) - F.length(F.replace(bare, F.lit(","))) + 1
    kind = (F.when(bare.rlike(r'(^|,)\s*"'), "quote").when(cells < len(names), "short").when(cells > len(names), "long"))
    return written(lines.select(*[F.col(f"_cells.{c}").alias(n.strip()) for c, n in zip(places, names)], kind.alias("line_kind"),
                                line.alias("line"), "file"), "feed-lines")


def read_feed_csv(spark: SparkSession, path: str, numeric: tuple[str, ...] = (), columns: tuple[str, ...] | None = None,
                  quarantine: str | None = None) -> DataFrame:
    """SRC-2 / PRJ-1 / VAL-4: header CSV, trimmed names and keys, NA tokens null.

    Everything is read as text (no schema inference pass), then numeric
    columns are converted with ``try_cast`` so a bad cell becomes null
    instead of failing the job.  A short line is a row whose last cells are
    missing; a long line, or one with an open quote, is no row.  Such lines are
    counted, and with ``quarantine`` kept there (file, line_kind, line), the short
    ones too.
    """
    lines = read_feed_lines(spark, path, columns)
    if quarantine:
        lines.where("line_kind is not null").select("file", "line_kind", "line").write.mode("overwrite").parquet(quarantine)
    rows = lines.where("line_kind is null or line_kind = 'short'").drop("line_kind", "line", "file")
    return coerced(rows, numeric)


def line_audit(lines: DataFrame) -> DataFrame:
    """SRC-2: (line_kind, n) with 'good' for the lines that parsed; kinds without a line count zero."""
    kinds = ("good", *LINE_KINDS)
    kind = F.coalesce("line_kind", F.lit("good"))
    one = lines.agg(*[F.count_if(kind == k).alias(k) for k in kinds])
    return one.select(F.inline(F.array(*[F.struct(F.lit(k).alias("line_kind"), F.col(k).alias("n")) for k in kinds])))


# ---- SRC-3: the labelled table by configuration

#: Where the labelled table lies unless a path or a configuration says otherwise.
LABELLED = "data/labelled"


class DataNotFoundError(FileNotFoundError):
    """There is no table at the path."""


def read_config(spark: SparkSession, path: str) -> dict[str, str]:
    """SRC-3: a configuration file of one JSON object, wherever Spark can read it."""
    rows = spark.read.json(path, multiLine=True).collect()      # a configuration file
    if len(rows) != 1:
        raise ValueError(f"{path} is no JSON object")
    return rows[0].asDict()


def load_labelled(spark: SparkSession, path: str | None = None, config: dict | str | None = None, validate: bool = True,
                  base: str = ".") -> DataFrame:
    """SRC-3: the labelled table, by default from the configured path, checked against the contract (VAL-1).

    The path is the first of ``path``, ``dataset_path`` in ``config`` (an object
    or the path of its file), ``dataset_path`` of the session (key
    ``riverlens.dataset_path``) and ``LABELLED``; one without a scheme or a
    leading slash lies under ``base``.  A name that ends in .csv is read as a feed
    with numbers where the contract has them, anything else as Parquet.
    """
    from riverlens.functions import dims
    from riverlens.sources.sinks import validate_schema
    found = read_config(spark, config) if isinstance(config, str) else dict(config or {})
    path = path or found.get("dataset_path") or spark.conf.get("riverlens.dataset_path", LABELLED)
    if not re.match(r"^(/|[a-zA-Z][a-zA-Z0-9+.-]*:)", path):
        path = f"{base.rstrip('/')}/{path}"
    try:
        df = (read_feed_csv(spark, path, (*dims.MODEL_FEATURES, "wqi_score")) if path.lower().endswith(".csv")
              else spark.read.parquet(path))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise DataNotFoundError(f"no labelled table at {path}") from e
        raise
    if validate:
        validate_schema(df)
    return df


def union_states(frames: list[DataFrame]) -> DataFrame:
    """SET-1: concatenate state tables by column name; absent columns become null."""
    if not frames:
        raise ValueError("no frames to union")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


RULE_SCHEMA = ("parameter string, column string, kind string, direction string, `limit` double, critical double, "
               "base_priority string, critical_priority string, unit string")


def thresholds_frame(spark: SparkSession, rules=None) -> DataFrame:
    """SRC-4: the rule table as a (small, fixed-size) DataFrame."""
    from riverlens.functions import dims
    return spark.createDataFrame(list(rules or dims.RULES), RULE_SCHEMA)


def read_thresholds(spark: SparkSession, path: str) -> list[tuple]:
    """SRC-4: rules from a user's JSON-lines file with the columns of ``RULE_SCHEMA``; raises when one is not usable."""
    rows = spark.read.schema(RULE_SCHEMA).json(path).collect()      # a configuration file
    bad = [r for r in rows if None in (r["parameter"], r["column"], r["kind"], r["limit"])
           or r["direction"] not in ("below", "above")]
    if bad or not rows:
        raise ValueError(f"unusable rules in {path}: {bad[:3]}" if rows else f"no rules in {path}")
    return [tuple(r) for r in rows]
