"""URL filters: captures against dated list entries.

A list is a log of dated events on entries: an entry of kind ``domain`` (a
host and all below it) or ``path`` (a host with leading path segments) and
verdict ``block`` or ``allow`` is added or removed on a day.  The events of an
entry become validity intervals [from, to); an as-of join evaluates every
capture against the entries active on the day it was fetched.  A capture is
blocked when a block entry and no allow entry is active for it.

Defined cases: a null or unparsable URL, or a null day, meets no entry; host
names compare in lower case, paths as they are; a host of more than 253
characters is no host (the limit of DNS); events of one day apply in the order
add, remove, and repeated events count once; a removal without an addition
does nothing; repeated captures are evaluated once and each gets the result;
an empty list blocks nothing; other columns pass through.

Scale: a capture becomes its few possible entry keys (the suffixes of its host
and the leading path segments up to the labels and segments that the deepest
entry has), so the as-of join is
an equi-join on (key, period) that AQE can split where a host is hot; an
interval is repeated for each period it touches, which keeps the candidates of
one key few however often the list flips it.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riverlens.llm.common import cut, packed

HOST = r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
PATH = r"(?i)^[a-z][a-z0-9+.-]*://[^/?#]*([^?#]*)"
PERIOD_DAYS = 32
LAST = "9999-12-31"


def host_of(url: Column) -> Column:
    host = F.regexp_replace(F.lower(F.regexp_extract(url, HOST, 1)), r"\.$", "")
    return F.when(F.length(host) > 0, host)


def validity(entries: DataFrame) -> DataFrame:
    """Intervals (kind, key, verdict, valid_from, valid_to) of events (kind, key, verdict, listed_on, action)."""
    events = (entries.where("kind is not null and key is not null and verdict is not null and listed_on is not null")
              .where(F.col("action").isin("add", "remove"))
              .select("kind", "key", "verdict", "listed_on", "action").distinct())
    later = Window.partitionBy("kind", "key", "verdict").orderBy("listed_on", "action")
    return (events.withColumn("valid_to", F.coalesce(F.lead("listed_on").over(later), F.lit(LAST).cast("date")))
            .where("action = 'add' and valid_to > listed_on")
            .select("kind", "key", "verdict", F.col("listed_on").alias("valid_from"), "valid_to"))


def _period(day: Column) -> Column:
    return F.floor(F.unix_date(day) / PERIOD_DAYS)


def candidate_keys(captures: DataFrame, levels: int, depth: int) -> DataFrame:
    """(url, day, tag, period): every entry key that could cover each capture.

    Domain keys of up to ``levels`` labels, path keys of up to ``depth`` segments.
    """
    labels = F.split("host", r"\.")
    k = F.least(F.size("labels"), F.lit(levels))
    domains = F.when(k > 0, F.transform(F.sequence(F.lit(1), k), lambda i: F.concat(
        F.lit("domain "), F.array_join(F.slice("labels", -i, i), "."))))
    none = F.array().cast("array<string>")
    # empty segments do not count; the limit leaves what lies deeper than any entry in one piece
    path = F.regexp_replace(F.regexp_extract("url", PATH, 1), "^/+|/+$|/+(?=/)", "")
    parts = F.when(path != "", F.split(path, "/", depth + 1)).otherwise(none)
    m = F.least(F.size("parts"), F.lit(depth))
    paths = F.when(m > 0, F.transform(F.sequence(F.lit(1), m), lambda i: F.concat(
        F.lit("path "), "host", F.lit("/"), F.array_join(F.slice("parts", F.lit(1), i), "/"))))
    keys = F.concat(F.coalesce(domains, none), F.coalesce(paths, none))
    return (captures.withColumn("host", host_of(F.col("url"))).where("host is not null and day is not null")
            .withColumn("labels", labels).withColumn("parts", parts)
            .select("url", "day", F.explode(keys).alias("tag"))
            .withColumn("period", _period(F.col("day"))))


def evaluate(captures: DataFrame, entries: DataFrame, url: str = "url", day: str = "fetched_on") -> DataFrame:
    """``captures`` with blocked (boolean), n_active (long) and entry (the first active key, null if none)."""
    spans = cut(validity(entries), "list-intervals")
    deep = lambda kind, n: spans.where(F.col("kind") == kind).agg(F.max(n)).first()[0] or 0
    levels, depth = deep("domain", F.size(F.split("key", r"\."))), deep("path", F.size(F.split("key", "/")) - 1)
    asked = captures.select(F.col(f"`{url}`").alias("url"), F.col(f"`{day}`").alias("day")).distinct()
    keys = candidate_keys(asked, levels, depth)
    # no interval matters beyond the last capture, and none at all without one
    latest = keys.agg(F.max("day")).first()[0] or date.min
    last = F.least(F.date_sub("valid_to", 1), F.lit(str(latest)).cast("date"))
    tiles = (spans.withColumn("last", last).where("last >= valid_from")
             .select(F.concat("kind", F.lit(" "), "key").alias("tag"), "verdict", "valid_from", "valid_to",
                     F.explode(F.sequence(_period(F.col("valid_from")), _period(F.col("last")))).alias("period")))
    active = (keys.join(tiles, ["tag", "period"]).where("day >= valid_from and day < valid_to")
              .groupBy("url", "day")
              .agg(F.count("*").alias("n"), F.min("tag").alias("tag"),
                   (F.bool_or(F.col("verdict") == "block") & ~F.bool_or(F.col("verdict") == "allow")).alias("b")))
    active = active.select(F.col("url").alias("a_url"), F.col("day").alias("a_day"), "n", "tag", "b")
    rows = captures.select(F.col(f"`{url}`").alias("c_url"), F.col(f"`{day}`").alias("c_day"),
                           packed(captures).alias("row"))
    rows = rows.join(active, (F.col("c_url") == F.col("a_url")) & (F.col("c_day") == F.col("a_day")), "left")
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in captures.columns],
                       F.coalesce("b", F.lit(False)).alias("blocked"),
                       F.coalesce("n", F.lit(0)).cast("long").alias("n_active"), F.col("tag").alias("entry"))


# ---- the query's inputs: the tables have no lists and no fetch days, so both are derived from ``pages``

def captures_of(pages: DataFrame) -> DataFrame:
    """(page_id, url, fetched_on): a day of a leap year by page_id."""
    return pages.select("page_id", "url", F.date_add(
        F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id") * 37, F.lit(366)).cast("int")).alias("fetched_on"))


def lists_of(pages: DataFrame) -> DataFrame:
    """List events over the hosts and first path segments of ``pages``, by a fixed rule on their digests."""
    host = host_of(F.col("url"))
    seg = F.regexp_extract(F.regexp_extract("url", PATH, 1), "^/+([^/]+)", 1)
    hosts = pages.select(host.alias("host"), seg.alias("seg")).where("host is not null").distinct()
    keys = (hosts.select(F.lit("domain").alias("kind"), F.col("host").alias("key"))
            .union(hosts.select(F.lit("domain"), F.regexp_replace("host", r"^[^.]*\.", "")))
            .union(hosts.where("seg <> ''").select(F.lit("path"), F.concat_ws("/", "host", "seg"))).distinct())
    v = F.conv(F.substring(F.md5(F.concat("kind", "key").cast("binary")), 1, 6), 16, 10).cast("int")
    keys = keys.withColumn("v", v)
    at = lambda n: F.date_add(F.lit("2024-01-01").cast("date"), n)
    day = F.pmod("v", F.lit(200)).cast("int")
    event = lambda verdict, when, action: F.struct(
        F.lit(verdict).alias("verdict"), at(when).alias("listed_on"), F.lit(action).alias("action"))
    events = F.filter(F.array(
        F.when(F.col("v") % 3 == 0, event("block", day, "add")),
        F.when(F.col("v") % 2 == 0, event("block", day + 60, "remove")),
        F.when(F.col("v") % 5 == 0, event("block", day + 150, "add")),
        F.when(F.col("v") % 7 == 0, event("allow", F.lit(100), "add")),
        F.when(F.col("v") % 4 == 0, event("allow", F.lit(250), "remove"))), lambda x: x.isNotNull())
    return keys.select("kind", "key", F.explode(events).alias("e")).select("kind", "key", "e.*")


ORACLE = r"""
WITH captures AS (
  SELECT page_id, url, DATE '2024-01-01' + ((((page_id * 37) % 366) + 366) % 366)::INT AS fetched_on,
         nullif(regexp_replace(lower(regexp_extract(url, '(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '\.$', ''), '') AS host,
         list_aggregate(list_filter(string_split(regexp_extract(url, '(?i)^[a-z][a-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> ''), 'string_agg', '/') AS path
  FROM pages),
hosts AS (SELECT DISTINCT host, split_part(coalesce(path, ''), '/', 1) AS seg FROM captures WHERE host IS NOT NULL),
keys AS (
  SELECT 'domain' AS kind, host AS key FROM hosts
  UNION SELECT 'domain', regexp_replace(host, '^[^.]*\.', '') FROM hosts
  UNION SELECT 'path', host || '/' || seg FROM hosts WHERE seg <> ''),
v AS (SELECT *, ('0x' || substr(md5(kind || key), 1, 6))::INT AS v FROM keys),
events AS (
  SELECT kind, key, 'block' AS verdict, v % 200 AS d, 'add' AS action FROM v WHERE v % 3 = 0
  UNION SELECT kind, key, 'block', v % 200 + 60, 'remove' FROM v WHERE v % 2 = 0
  UNION SELECT kind, key, 'block', v % 200 + 150, 'add' FROM v WHERE v % 5 = 0
  UNION SELECT kind, key, 'allow', 100, 'add' FROM v WHERE v % 7 = 0
  UNION SELECT kind, key, 'allow', 250, 'remove' FROM v WHERE v % 4 = 0),
spans AS (
  SELECT kind, key, verdict, action, DATE '2024-01-01' + d::INT AS valid_from,
         coalesce(DATE '2024-01-01' + (lead(d) OVER (PARTITION BY kind, key, verdict ORDER BY d, action))::INT, DATE '9999-12-31') AS valid_to
  FROM events),
active AS (
  SELECT c.page_id, count(*) AS n, min(s.kind || ' ' || s.key) AS entry,
         bool_or(s.verdict = 'block') AND NOT bool_or(s.verdict = 'allow') AS blocked
  FROM captures c JOIN spans s ON s.action = 'add' AND c.fetched_on >= s.valid_from AND c.fetched_on < s.valid_to
    AND CASE WHEN s.kind = 'domain' THEN c.host = s.key OR ends_with(c.host, '.' || s.key)
             ELSE c.host || '/' || c.path = s.key OR starts_with(c.host || '/' || c.path, s.key || '/') END
  GROUP BY c.page_id)
SELECT c.page_id, c.url, c.fetched_on, coalesce(a.blocked, false) AS blocked,
       coalesce(a.n, 0)::BIGINT AS n_active, a.entry
FROM captures c LEFT JOIN active a USING (page_id)
"""
