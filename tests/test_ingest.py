"""Three-feed join from CSV files, key guards, timestamp parsing."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from riverlens.operators import ingest as I
from riverlens.sources import feeds as FD


def write(dirname, name, text):
    with open(os.path.join(dirname, name), "w", encoding="utf-8") as fh:
        fh.write(text)


@pytest.fixture()
def raw_dir():
    d = tempfile.mkdtemp(prefix="riverlens-feeds-", dir="/tmp")
    write(d, "Alpha_biological.csv",
          "SlNo, Station ,State,acquired_text,bod_mgl,do_mgl,fc\n"
          "1,S1,Alpha,01/01/2023 10:00,2.0,7.0,100\n"
          "2,S1,Alpha,15/02/2023 09:30,3.5,NA,200\n"
          "3, S2 ,Alpha,05/03/2023 08:00,1.0,8.0,50\n"
          "4,S2,Alpha,20/03/2023 08:00,bad,6.0,\n")
    write(d, "Alpha_chemical.csv",
          "SlNo,Station,State,acquired_text,ph,chloride\n"
          "1,S1,Alpha,01/01/2023 10:00,7.1,10\n"
          "2,S1,Alpha,15/02/2023 09:30,7.2,11\n"
          "3,S2,Alpha,05/03/2023 08:00,7.3,12\n"
          "4,S2,Alpha,20/03/2023 08:00,7.4,13\n")
    write(d, "Alpha_physical.csv",
          "SlNo,Station,State,acquired_text,temperature,turbidity\n"
          "1,S1,Alpha,01/01/2023 10:00,25.0,3.0\n")
    return d


def load(spark, raw_dir):
    located = FD.locate_feeds(spark, raw_dir, ("Alpha",))
    numeric = ("bod_mgl", "do_mgl", "fc", "ph", "chloride", "temperature", "turbidity")
    out = {}
    for (state, cat), path in located.items():
        df = FD.read_feed_csv(spark, path, numeric).withColumnRenamed("Station", "station") \
            .withColumnRenamed("State", "state").withColumn("event_key", F.col("acquired_text"))
        out[cat] = df.withColumnRenamed("SlNo", "station_code")
    return out


def test_join_from_csv(spark, raw_dir):
    feeds = load(spark, raw_dir)
    joined = I.checked_join(feeds).orderBy("sampled_at").collect()
    assert len(joined) == 4
    assert [r["has_physical_record"] for r in joined] == [True, False, False, False]
    assert joined[0]["temperature"] == 25.0 and joined[1]["temperature"] is None
    assert joined[1]["do_mgl"] is None            # NA token
    assert joined[3]["bod_mgl"] is None           # bad number -> null, no failure
    assert joined[2]["station"] == "S2"           # trimmed key text
    assert [r["month"] for r in joined] == [1, 2, 3, 3]
    assert joined[3]["day"] == 20                 # day-first


def test_missing_pair_raises(spark, raw_dir):
    os.remove(os.path.join(raw_dir, "Alpha_physical.csv"))
    with pytest.raises(FileNotFoundError):
        FD.locate_feeds(spark, raw_dir, ("Alpha",))


def test_duplicate_key_raises(spark, raw_dir):
    feeds = load(spark, raw_dir)
    feeds["chemical"] = feeds["chemical"].unionByName(feeds["chemical"].limit(1))
    with pytest.raises(I.DuplicateKeyError):
        I.checked_join(feeds)


def test_mixed_formats(spark):
    df = spark.createDataFrame([("01-02-2023 10:00",), ("01/02/2023 10:00",), ("31/12/2023",), ("garbage",)], "t string")
    got = [r["d"] for r in df.select(F.date_format(I.parse_day_first(F.col("t")), "yyyy-MM-dd").alias("d")).collect()]
    assert got == ["2023-02-01", "2023-02-01", "2023-12-31", None]


def test_union_states(spark):
    a = spark.createDataFrame([(1, 2.0)], "k int, x double")
    b = spark.createDataFrame([(2, 3.0)], "k int, y double")
    out = FD.union_states([a, b]).orderBy("k").collect()
    assert out[0]["y"] is None and out[1]["x"] is None


def unique_feeds(spark, copies=0):
    key = "state string, station string, event_key string, "
    bio = [("A", f"s{k % 3}", f"e{k}", "c", "01/01/2023 10:00", float(k)) for k in range(30)]
    chem = [(*r[:5], 7.0) for r in bio[:25]] + [("A", "s9", "x", "c", "01/01/2023 10:00", 7.0)]
    phys = [(*r[:5], 20.0) for r in bio[:10]]
    chem += chem[:1] * copies
    make = lambda rows, c: spark.createDataFrame(rows, key + f"station_code string, acquired_text string, {c} double")
    return {"biological": make(bio, "bod_mgl"), "chemical": make(chem, "ph"), "physical": make(phys, "temperature")}


def test_join_is_audited_while_it_runs(spark, tmp_path):
    from riverlens.sources import sinks as SK
    feeds, base = unique_feeds(spark), str(tmp_path / "joined")
    joined, audit = I.audited_join(feeds, base)
    rows = {r["feed"]: tuple(r)[1:] for r in audit.collect()}
    assert rows.pop("joined") == (25, 25, 0, 0)
    assert rows == {r["feed"]: tuple(r)[1:] for r in I.key_audit(feeds).collect()}
    same = I.join_feeds(feeds)
    assert joined.select(same.columns).exceptAll(same).count() == 0 and joined.count() == same.count()
    with pytest.raises(I.DuplicateKeyError, match="chemical"):
        I.audited_join(unique_feeds(spark, copies=1), base)
    # nothing was published, and the inflated version is gone
    assert SK.read_current(spark, base).count() == 25
    assert len([n for n in os.listdir(base) if n.startswith("version=")]) == 1


def test_audited_join_adds_no_exchange(spark):
    feeds = unique_feeds(spark)
    single = {n: f.groupBy(*I.EVENT_KEY).agg(F.first(F.struct(*[c for c in f.columns if c not in I.EVENT_KEY])).alias("r"))
              .select(*I.EVENT_KEY, "r.*") for n, f in feeds.items()}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = I.join_feeds(single)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Exchange hashpartitioning") == 3


def test_bad_lines_are_judged_kept_and_counted(spark, tmp_path):
    lines = ["a, b ,c", "1,2,3", "4,5", "6,7,8,9", '"x,2,3', 'x"y,2,3', '"q,1",2,3', '1,2,"open', ",,", "", '"a""b",1,2', "9,9,9"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "in" / "two.csv").write_text("a, b ,c\r\n10,11,12\r\n")
    path, bad = str(tmp_path / "in"), str(tmp_path / "bad")
    got = FD.read_feed_lines(spark, path)
    assert got.columns == ["a", "b", "c", "line_kind", "line", "file"]
    assert {r["line"]: r["line_kind"] for r in got.where("line_kind is not null").collect()} == {
        "4,5": "short", "6,7,8,9": "long", '"x,2,3': "quote", '1,2,"open': "quote"}
    assert {r["line_kind"]: r["n"] for r in FD.line_audit(got).collect()} == {"good": 7, "short": 1, "long": 1, "quote": 2}
    rows = {tuple(r) for r in FD.read_feed_csv(spark, path, ("b",), quarantine=bad).collect()}
    assert rows == {("1", 2.0, "3"), ("4", 5.0, None), ('x"y', 2.0, "3"), ("q,1", 2.0, "3"), (None, None, None), ('a"b', 1.0, "2"),
                    ("9", 9.0, "9"), ("10", 11.0, "12")}
    kept = {(r["file"], r["line_kind"], r["line"]) for r in spark.read.parquet(bad).collect()}
    assert ("one.csv", "long", "6,7,8,9") in kept and len(kept) == 4
