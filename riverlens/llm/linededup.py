"""Line dedup by distinct-site spread.

A line is boilerplate when it stands on at least ``min_sites`` different
sites (the ``source`` column).  One HyperLogLog sketch per line hash, merged
by aggregation, gives the spread of every line; lines whose estimate is near
the threshold get an exact distinct count.  Of each boilerplate line the
first occurrence (smallest doc_id, then line number) stays, every other one
is removed.

Defined cases: a null or empty text has no lines and stays as it is; a null
site counts for no site; a line is compared without the white space around
it; a blank line is no line; rows that
repeat one doc_id and text count as one document, so both keep a first
occurrence; an empty table gives an empty result; other columns, whatever
their names, pass through.

Scale: what moves per line is a 16-byte hash, never the line.  Sketches merge
map-side, so a line on a third of all rows is one partial sketch per task.
The exact counts are a two-step distinct.  A line on more than one in 1,000
of all lines meets its copies by broadcast, the others in a shuffle.  No window,
no group is collected but the line numbers that leave one document.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from riverlens.llm.common import cut, join_known, packed

BLANK = r"^[ \t\r]+|[ \t\r]+$"
WORD = r"[^ \t\r]+"
PART = 4_000_000    # characters of texts that are strings of Python at once


def line_hashes(docs: DataFrame, min_words: int = 1) -> DataFrame:
    """(h1, h2, site, doc_id, t, line_no) for each line that may be boilerplate."""
    lines = docs.select("doc_id", F.col("source").alias("site"), F.xxhash64("text").alias("t"),
                        F.posexplode(F.split("text", "\n", -1)).alias("line_no", "raw"))
    lines = lines.withColumn("line", F.regexp_replace("raw", BLANK, ""))
    return (lines.where(F.regexp_count("line", F.lit(WORD)) >= min_words)
            .select(F.xxhash64("line").alias("h1"), F.xxhash64("line", F.lit(1)).alias("h2"),
                    "site", "doc_id", "t", "line_no"))


def line_spread(lines: DataFrame, min_sites: int = 2, lg_k: int = 12) -> DataFrame:
    """(h1, h2, n, first, sites) of the lines that occur ``min_sites`` times; sites is the sketch's estimate."""
    spread = (lines.groupBy("h1", "h2")
              .agg(F.count("*").alias("n"), F.hll_sketch_agg("site", F.lit(lg_k)).alias("sketch"),
                   F.min(F.struct("doc_id", "line_no")).alias("first"))
              .where(F.col("n") >= min_sites)
              .select("h1", "h2", "n", "first", F.hll_sketch_estimate("sketch").alias("sites")))
    return cut(spread, "line-spread")


def boilerplate_lines(lines: DataFrame, spread: DataFrame, total: int, min_sites: int = 2, lg_k: int = 12) -> DataFrame:
    """(h1, h2, n, first) of the lines on at least ``min_sites`` distinct sites, n of them in all; ``lines`` has ``total`` rows."""
    # three standard errors of the sketch, one site at least
    band = max(1.0, 3 * 1.04 / (2 ** lg_k) ** 0.5 * min_sites)
    near = spread.where(F.abs(F.col("sites") - min_sites) <= band)
    exact = (join_known(lines.where("site is not null").select("h1", "h2", "site"), near.select("h1", "h2", "n"),
                        ["h1", "h2"], "n", total, spread).distinct()
             .groupBy("h1", "h2").count().where(F.col("count") >= min_sites))
    clear = spread.where(F.col("sites") > min_sites + band)
    return (clear.select("h1", "h2", "n", "first")
            .union(near.join(exact, ["h1", "h2"], "left_semi").select("h1", "h2", "n", "first")))


@F.arrow_udf(StringType())
def without_lines(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Texts without the lines of the given numbers, ``PART`` bytes of texts at a time."""
    for texts, drops in batches:
        done, kept, held = [], [], 0
        for text, drop in zip(texts, drops):
            value = text.as_py()
            if value is not None:
                gone = set(drop.as_py())
                value = "\n".join([x for i, x in enumerate(value.split("\n")) if i not in gone])
                held += len(value)
            kept.append(value)
            if held > PART:
                done.append(pa.array(kept, pa.string()))
                kept, held = [], 0
        yield pa.concat_arrays([*done, pa.array(kept, pa.string())])
        del done, kept, texts, drops
        pa.default_memory_pool().release_unused()


def remove_boilerplate(docs: DataFrame, min_sites: int = 2, min_words: int = 1, lg_k: int = 12,
                       removed: str | None = None) -> DataFrame:
    """``docs`` (doc_id, text, source, ...) with the boilerplate lines taken out.

    Lines of fewer than ``min_words`` words are left alone: by default only blank
    ones.  ``removed`` names a column for the number of removed lines, if wanted.
    ``n_chars``, where there is one, follows the new text.
    """
    lines = cut(line_hashes(docs, min_words), "line-hashes")
    spread, total = line_spread(lines, min_sites, lg_k), lines.count()
    known = cut(boilerplate_lines(lines, spread, total, min_sites, lg_k), "boilerplate")
    gone = (join_known(lines.select("h1", "h2", "doc_id", "t", "line_no"), known, ["h1", "h2"], "n", total, spread)
            .where(~F.struct("doc_id", "line_no").eqNullSafe(F.col("first")))
            .groupBy("doc_id", "t").agg(F.collect_set("line_no").alias("drop")))
    gone = gone.select(F.col("doc_id").alias("g_id"), F.col("t").alias("g_t"), "drop")
    rows = docs.select(F.col("doc_id").alias("d_id"), F.xxhash64("text").alias("d_t"), packed(docs).alias("row"))
    rows = rows.join(gone, F.col("d_id").eqNullSafe(F.col("g_id")) & (F.col("d_t") == F.col("g_t")), "left")
    hit = F.col("drop").isNotNull()
    rows = rows.withColumn("kept", without_lines(F.when(hit, F.col("row.text")), F.col("drop")))
    text = F.when(hit, F.col("kept")).otherwise(F.col("row.text"))
    out = {"text": text} | ({"n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)}
                            if "n_chars" in docs.columns else {})
    cols = [(out[c] if c in out else F.col(f"row.`{c}`")).alias(c) for c in docs.columns]
    if removed:
        cols.append(F.when(hit, F.size("drop")).otherwise(0).cast("long").alias(removed))
    return rows.select(*cols)


ORACLE = r"""
WITH raw AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS raw,
         generate_subscripts(string_split(text, chr(10)), 1) AS line_no
  FROM documents WHERE text IS NOT NULL),
lines AS (
  SELECT doc_id, source, raw, line_no,
         regexp_replace(raw, '^[ \t\r]+|[ \t\r]+$', '', 'g') AS line FROM raw),
spread AS (
  SELECT line, min({'a': doc_id, 'b': line_no}) AS first FROM lines
  WHERE len(regexp_extract_all(line, '[^ \t\r]+')) >= 1
  GROUP BY line HAVING count(DISTINCT source) >= 2),
kept AS (
  SELECT l.doc_id, l.raw, l.line_no,
         s.line IS NOT NULL AND s.first <> {'a': l.doc_id, 'b': l.line_no} AS gone
  FROM lines l LEFT JOIN spread s ON l.line = s.line)
SELECT d.doc_id,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       coalesce(k.n, 0)::BIGINT AS n_removed
FROM documents d LEFT JOIN (
  SELECT doc_id, string_agg(raw, chr(10) ORDER BY line_no) FILTER (WHERE NOT gone) AS text,
         count(*) FILTER (WHERE gone) AS n
  FROM kept GROUP BY doc_id) k USING (doc_id)
"""
