import sys
from hashlib import sha256
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parents[2]))

import corpus_pipeline as cp  # noqa: E402
from helpers import docs_frame, prose  # noqa: E402
from test_linededup import brute as brute_lines  # noqa: E402
from test_neardup import brute_classes  # noqa: E402

from riverlens.llm import mixing  # noqa: E402
from riverlens.llm.common import cut  # noqa: E402
from riverlens.sources.tables import read_table  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """Each stage's input and output over the smallest tables."""
    docs, out = read_table(spark, SF, "documents"), []
    for name, stage in cp.STAGES:
        after = cut(stage(spark, docs, SF), name)
        out.append((name, docs, after))
        docs = after
    return {name: (before, after) for name, before, after in out}


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source").collect()]


def test_columns(spark, steps):
    for name, (before, after) in steps.items():
        if name != "bpe":
            assert after.columns == before.columns == read_table(spark, SF, "documents").columns


def test_toxicity_rejects_labelled_and_keeps_the_rest(spark, steps):
    before, after = steps["toxicity"]
    labels = {r["doc_id"]: r["toxic"] for r in read_table(spark, SF, "labels").collect()}
    kept = {r["doc_id"] for r in after.collect()}
    clean = [r["doc_id"] for r in before.collect() if labels.get(r["doc_id"]) == 0]
    assert sum(d in kept for d in clean) >= 0.97 * len(clean)
    assert set(rows_of(after)) <= set(rows_of(before))


def test_line_dedup(steps):
    before, after = steps["line_dedup"]
    assert sorted(((i, t) for i, t, _, _ in rows_of(after)), key=str) == brute_lines(rows_of(before))


def test_near_dedup(steps):
    before, after = steps["near_dedup"]
    rows, kept = rows_of(before), [r[0] for r in rows_of(after)]
    assert set(rows_of(after)) <= set(rows) and len(kept) == len(set(kept))
    groups = brute_classes(rows)
    assert all(len(g & set(kept)) <= 1 for g in groups)
    for g in brute_classes(rows, 0.6):      # nothing unlike a kept document has gone
        assert g & set(kept)


def test_mix(steps):
    before, after = steps["mix"]
    size = {r[0]: len((r[1] or "").split()) for r in rows_of(before)}
    total, taken, copies = sum(size.values()), 0, {}
    for r in rows_of(after):
        taken += size[r[0]]
        copies[r[0]] = copies.get(r[0], 0) + 1
    assert set(rows_of(after)) <= set(rows_of(before)) and max(copies.values()) <= 2
    assert abs(taken - 1.5 * total) <= 25 * max(size.values())


def test_bpe(steps):
    before, after = steps["bpe"]
    want = sorted((r[0], sha256((r[1] or "").encode()).hexdigest()) for r in rows_of(before))
    assert sorted((r["doc_id"], r["decoded_sha256"]) for r in after.collect()) == want


def test_run_is_the_stages(spark, steps):
    out = sorted(map(str, cp.run(spark, SF).collect()))
    assert out == sorted(map(str, steps["bpe"][1].collect()))


def test_token_ids_come_in_training_order(spark, steps):
    docs, _ = steps["mix"]
    sizes = docs.select("doc_id", "source", mixing.size_of(F.col("text")).alias("size"))
    want = sorted((p, r["doc_id"]) for r in mixing.mix_plan(sizes).collect() for p in r["positions"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        stream = cut(mixing.mix(docs), "stream")
        assert len(stream.inputFiles()) > 3
        out = cp.encode_texts(spark, stream, SF).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r["position"] for r in out] == list(range(len(want)))
    assert [r["doc_id"] for r in out] == [d for _, d in want]


def awkward(spark, folder, rows, extra=True):
    """A tables folder with these documents and no usable label."""
    docs_frame(spark, rows, extra).coalesce(2).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_run_over_awkward_rows(spark, tmp_path):
    """Nulls in every column, empty and long texts, ties, repeated rows and clashing columns, through all stages."""
    rows = [(1, prose(1, 60), "en", "a"), (1, prose(1, 60), "en", "a"), (2, prose(1, 60), "en", "b"), (3, None, None, None),
            (4, "", "en", "a"), (None, prose(2, 40), None, "b"), (5, prose(3, 30_000), "en", None), (6, "one", "en", "b"),
            (7, prose(4, 50) + "\nshared line of words", "en", "a"), (8, prose(5, 50) + "\nshared line of words", "en", "b"),
            (9, "\n \n", "en", "c"), (10, None, "en", "c")]
    out = cp.run(spark, awkward(spark, tmp_path, rows)).collect()
    assert [r["position"] for r in out] == list(range(len(out)))
    found = {}
    for r in out:
        found.setdefault(r["doc_id"], []).append(r)
        assert len(r["ids"]) == r["n_tokens"]
    # of the copies of one text one document stays; what is left of the other is the first of the empty texts
    assert set(found) <= {1, 2, None, 5, 6, 7, 8} and all(r["n_tokens"] == 0 for r in found.get(2, []))
    assert len({r["decoded_sha256"] for r in found.get(1, [])}) <= 1
    assert max(map(len, found.values())) <= 2


def test_run_over_no_rows(spark, tmp_path):
    assert cp.run(spark, awkward(spark, tmp_path, [], extra=False)).count() == 0


def test_stages_keep_other_columns(spark, tmp_path):
    rows = [(k, prose(k, 40) + "\nsame line here", "en", f"s{k % 3}") for k in range(9)] + [(9, None, None, None)]
    folder = awkward(spark, tmp_path, rows)
    docs = read_table(spark, folder, "documents")
    for name, stage in cp.STAGES[:-1]:
        after = cut(stage(spark, docs, folder), name)
        assert after.columns == docs.columns, name
        docs = after
    assert {(r["row"], r["node"], r["position"]) for r in docs.collect()} == {(1, "n", 0.5)}
