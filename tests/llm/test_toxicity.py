import numpy as np
from helpers import docs_frame, prose

from riverlens.llm import toxicity

BAD, WORSE = ["snarlish", "grumpole"], ["vilething", "foulmouth"]


def doc(k):
    """Text and grade: a third of the documents hold bad words, some of them worse ones."""
    words = prose(k, 30 + k % 50).split()
    grade = 0
    if k % 3 == 0:
        words[k % len(words)] = BAD[k // 3 % 2] + ("ed" if k % 2 else "")
        grade = 1
    if k % 9 == 0:
        words[(k + 7) % len(words)] = WORSE[k // 9 % 2]
        words[(k + 11) % len(words)] = BAD[0]
        grade = 2
    return " ".join(words), grade


ROWS = [(k, doc(k)[0], "en", "s") for k in range(900)]
TRAIN = {k for k in range(900) if k // 7 % 2 == 0}


def grades_frame(spark, ids):
    return spark.createDataFrame([(k, doc(k)[1]) for k in ids], "doc_id long, grade int")


def test_held_out_severity(spark):
    docs = docs_frame(spark, ROWS)
    model = toxicity.fit(docs, grades_frame(spark, TRAIN))
    assert len(model.thresholds) == 2 and model.thresholds[0] < model.thresholds[1]
    got = {r["doc_id"]: r for r in toxicity.severity(docs, model).collect()}
    odd = [k for k in range(900) if k not in TRAIN]
    wrong = [(k, doc(k)[1], got[k]["severity"]) for k in odd if got[k]["toxic"] != (doc(k)[1] > 0)]
    assert not wrong, wrong
    assert sum(got[k]["grade"] == doc(k)[1] for k in odd) >= 0.98 * len(odd)
    mean = [np.mean([got[k]["severity"] for k in odd if doc(k)[1] == g]) for g in range(3)]
    assert mean[0] < 0.2 < 0.7 < mean[1] < 1.3 < mean[2] <= 2
    again = toxicity.severity(docs, toxicity.fit(docs, grades_frame(spark, TRAIN))).collect()
    assert {r["doc_id"]: r["severity"] for r in again} == {k: r["severity"] for k, r in got.items()}


def test_scores_match_brute_force(spark):
    docs = docs_frame(spark, ROWS[:60])
    model = toxicity.fit(docs_frame(spark, ROWS), grades_frame(spark, range(900)))
    for r in toxicity.severity(docs, model).collect():
        found = {f for w in ROWS[r["doc_id"]][1].split() for f in toxicity.features_of(w)}
        eta = sum(model.weights.get(f, 0.0) for f in found)
        assert abs(r["severity"] - sum(1 / (1 + np.exp(t - eta)) for t in model.thresholds)) < 1e-9


def test_keep_clean_and_edges(spark):
    model = toxicity.fit(docs_frame(spark, ROWS), grades_frame(spark, range(900)))
    rows = [(1, None, None, None), (2, "", "en", "s"), (3, "123 !!", "en", "s"), (4, ROWS[9][1], "en", "s"),
            (None, ROWS[1][1], "en", "s"), (5, ROWS[1][1], "en", "s"), (5, ROWS[1][1], "en", "s"),
            (6, " ".join(prose(2, 200000).split() + ["vilething", "snarlish"]), "en", "s")]
    df = docs_frame(spark, rows, extra=True)
    out = toxicity.keep_clean(df, model)
    assert out.schema == df.schema
    assert sorted((r["doc_id"] or 0 for r in out.collect())) == [0, 1, 2, 3, 5, 5]
    assert toxicity.keep_clean(df.limit(0), model).count() == 0


def test_without_usable_labels(spark):
    docs = docs_frame(spark, ROWS[:30])
    for grades in (grades_frame(spark, []), grades_frame(spark, [1, 2]), grades_frame(spark, [5000]),
                   spark.createDataFrame([(0, None), (None, 1)], "doc_id long, grade int")):
        model = toxicity.fit(docs, grades)
        got = toxicity.severity(docs, model).collect()
        assert len(got) == 30 and not any(r["toxic"] or r["severity"] for r in got)
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (3, 0, 0), (4, None, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    assert sorted(tuple(r) for r in toxicity.label_grades(labels).where("grade is not null").collect()) == [(1, 0), (2, 2), (3, 0), (4, 1)]
    # the highest of several labels counts
    double = grades_frame(spark, range(900)).union(spark.createDataFrame([(k, 0) for k in range(0, 900, 3)], "doc_id long, grade int"))
    assert len(toxicity.fit(docs_frame(spark, ROWS), double).thresholds) == 2
