from datetime import date

from pyspark.sql import functions as F

from riverlens.llm import urlfilter

D = lambda n: date(2024, 1, n)
ENTRIES = [
    ("domain", "bad.com", "block", D(5), "add"), ("domain", "bad.com", "block", D(10), "remove"),
    ("domain", "bad.com", "block", D(10), "remove"), ("domain", "bad.com", "block", D(20), "add"),
    ("path", "ok.com/x/y", "block", D(1), "add"), ("domain", "good.bad.com", "allow", D(6), "add"),
    ("domain", "late.com", "block", D(8), "remove"), ("domain", "same.com", "block", D(9), "add"),
    ("domain", "same.com", "block", D(9), "remove"), (None, "n.com", "block", D(1), "add"), ("domain", "m.com", "block", None, "add"),
]
CAPTURES = [
    (1, "http://bad.com/", D(4), False), (2, "http://BAD.com", D(5), True), (3, "https://u:p@a.bad.com:80/q?x#y", D(9), True),
    (4, "http://bad.com/", D(10), False), (5, "http://bad.com/", D(28), True), (6, "http://notbad.com/", D(7), False),
    (7, "http://good.bad.com/", D(5), True), (8, "http://good.bad.com/", D(6), False),
    (9, "http://ok.com/x/y/z", D(2), True), (10, "http://ok.com/x/yz", D(2), False), (11, "http://ok.com/x", D(2), False),
    (12, "http://ok.com//x//y?z", D(2), True), (13, None, D(2), False), (14, "junk", D(2), False), (15, "http://bad.com/", None, False),
    (16, "http://late.com/", D(9), False), (17, "http://same.com/", D(9), False), (2, "http://BAD.com", D(5), True),
    (18, "http://" + "a." * 200 + "bad.com/", D(6), True), (20, "http://" + "a." * 30000 + "ok.com/x/y", D(6), False), (19, "http://bad.com/" + "p/" * 20000, D(6), True),
    (None, "http://bad.com./", D(6), True),
]


def frames(spark):
    entries = spark.createDataFrame(ENTRIES, "kind string, key string, verdict string, listed_on date, action string")
    captures = spark.createDataFrame([c[:3] + (1, "t") for c in CAPTURES],
                                     "page_id long, url string, fetched_on date, n long, tag string")
    return captures, entries


def test_validity_and_as_of(spark):
    captures, entries = frames(spark)
    out = urlfilter.evaluate(captures, entries)
    got = sorted(((r["page_id"], r["url"], r["blocked"]) for r in out.collect()), key=str)
    assert got == sorted(((i, u, b) for i, u, _, b in CAPTURES), key=str)
    assert out.columns == ["page_id", "url", "fetched_on", "n", "tag", "blocked", "n_active", "entry"]


def test_empty_sides(spark):
    captures, entries = frames(spark)
    assert urlfilter.evaluate(captures.limit(0), entries).count() == 0
    undated = captures.withColumn("fetched_on", F.lit(None).cast("date"))
    assert not any(r["blocked"] for r in urlfilter.evaluate(undated, entries).collect())
    assert not any(r["blocked"] for r in urlfilter.evaluate(captures, entries.limit(0)).collect())


def test_many_flips_of_one_entry(spark):
    events = [("domain", "flip.com", "block", date.fromordinal(738000 + k), "add" if k % 2 == 0 else "remove") for k in range(700)]
    entries = spark.createDataFrame(events, "kind string, key string, verdict string, listed_on date, action string")
    days = [(k, "http://www.flip.com/", date.fromordinal(738000 + k)) for k in range(-2, 705)]
    out = urlfilter.evaluate(spark.createDataFrame(days, "page_id long, url string, fetched_on date"), entries)
    assert {r["page_id"] for r in out.where("blocked").collect()} == {k for k in range(700) if k % 2 == 0}
