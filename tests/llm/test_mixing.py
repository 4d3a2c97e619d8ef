import pytest
from helpers import docs_frame, prose
from pyspark.sql import functions as F

from riverlens.llm import mixing


def plan(spark, rows):
    df = docs_frame(spark, rows).select("doc_id", "source", mixing.size_of(F.col("text")).alias("size"))
    return mixing.mix_plan(df, bucket_rows=16).collect()


def targets(sizes, weights, total):
    """Water filling by hand: excess is reshared until none is above its cap."""
    out = {s: 0.0 for s in sizes}
    open_, left = set(sizes), total
    while True:
        level = left / sum(weights[s] for s in open_)
        over = {s for s in open_ if weights[s] * level > 2 * sizes[s]}
        for s in open_ - over:
            out[s] = weights[s] * level
        if not over:
            return out
        for s in over:
            out[s] = 2.0 * sizes[s]
        left -= sum(2 * sizes[s] for s in over)
        open_ -= over


ROWS = [(k, prose(k, 1 + k * 37 % 90), "en", ["b", "a", "c", None, "é"][(k * k + k // 3) % 5]) for k in range(300)]


def test_targets_and_taken(spark):
    got = plan(spark, ROWS)
    sizes = {}
    for _, text, _, s in ROWS:
        sizes[s] = sizes.get(s, 0) + len(text.split())
    order = sorted([s for s in sizes if s is not None], key=lambda s: s.encode()) + [None]
    want = targets(sizes, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}, 1.5 * sum(sizes.values()))
    taken, largest = {}, max(len(t.split()) for _, t, _, _ in ROWS)
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == sizes[r["source"]]
        assert r["copies"] <= 2 and len(r["positions"]) == r["copies"]
        assert all(0 <= p <= 1 for p in r["positions"]) and list(r["positions"]) == sorted(r["positions"])
        taken[r["source"]] = taken.get(r["source"], 0) + r["size"] * r["copies"]
    for s, n in taken.items():
        assert abs(n - want[s]) <= largest
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_schedule_inverse_matches_integration(spark):
    for turn, knots in enumerate(mixing.SCHEDULES):
        areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:])]
        for share in (0.0, 0.1, 0.5, 0.77, 0.999):
            row = spark.range(1).select(mixing.position(F.lit(share), F.lit(turn), mixing.SCHEDULES).alias("t")).first()
            done = 0.0
            for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
                u = min(max(row["t"] - t0, 0), t1 - t0)
                done += u * w0 + u * u * (w1 - w0) / (t1 - t0) / 2
            assert done / sum(areas) == pytest.approx(share, abs=1e-9)


def test_reruns_agree_and_edges(spark):
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, "one", "en", "a"), (None, "two words", "en", None),
            (3, "one", "en", "a"), (4, "w " * 50000, "en", "a")]
    one, two = (sorted(map(str, plan(spark, rows))) for _ in range(2))
    assert one == two
    assert plan(spark, rows[:0]) == []
    assert all(r["target"] == 0 for r in plan(spark, rows[:2]))


def test_stream_is_sorted_and_columns_pass(spark):
    df = docs_frame(spark, ROWS, extra=True)
    out = mixing.mix(df)
    assert out.schema == df.schema
    got = [r["doc_id"] for r in out.collect()]
    places = {r["doc_id"]: list(r["positions"]) for r in plan(spark, ROWS)}
    assert sorted(got) == sorted(d for d, p in places.items() for _ in p)
    assert mixing.mix(df.limit(0)).count() == 0
    sorted_places, seen = [], {}
    for d in got:
        sorted_places.append(places[d][seen.get(d, 0)])
        seen[d] = seen.get(d, 0) + 1
    assert sorted_places == sorted(sorted_places)
