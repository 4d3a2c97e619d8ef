import numpy as np
from helpers import docs_frame, prose
from pyspark.sql import functions as F

from riverlens.llm import langid

SYLLABLES = {"xx": "tha ren oul ing bet".split(), "yy": "ción ñad rre llo ueb".split(), "zz": "ßen üch keit auf pfo".split()}


def text(lang, seed, n):
    words = prose(seed, n).split()
    s = SYLLABLES[lang]
    return " ".join(s[len(w) % 5] + s[sum(w.encode()) % 5] for w in words)


ROWS = [(k, text(lang, k, 5 + k % 60), lang, "s") for k in range(600) for lang in [["xx", "yy", "zz"][k % 3 if k % 20 else 0]]]
EDGE = [(1000, None, "xx", "s"), (1001, "", "xx", "s"), (1002, "123 --- !", "yy", "s"), (1003, text("yy", 3, 30000), None, None),
        (None, text("zz", 5, 40), "zz", "s"), (5, ROWS[5][1], "xx", "s"), (5, ROWS[5][1], "xx", "s")]


def test_held_out_accuracy_and_edges(spark):
    docs = docs_frame(spark, ROWS + EDGE, extra=True).withColumn("held_out", langid.held_out(F.col("doc_id")))
    model = langid.fit(docs.where("not held_out"))
    got = langid.predict(docs, model).collect()
    assert len(got) == len(ROWS) + len(EDGE)
    truth = {r[0]: r[2] for r in ROWS}
    unseen = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert len(unseen) > 100
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in unseen) >= 0.97 * len(unseen)
    by_id = {r["doc_id"]: r for r in got}
    for k in (1000, 1001, 1002):
        assert (by_id[k]["lang_pred"], by_id[k]["score"]) == ("und", 0.0)
    assert by_id[1003]["lang_pred"] == "yy" and by_id[None]["lang_pred"] == "zz"
    assert all(0 <= r["score"] <= 1 for r in got)
    again = langid.predict(docs, langid.fit(docs.where("not held_out"))).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_labels_of_the_held_out_fold_do_not_matter(spark):
    docs = docs_frame(spark, ROWS).withColumn("held_out", langid.held_out(F.col("doc_id")))
    other = docs.withColumn("lang", F.when(F.col("held_out"), "xx").otherwise(F.col("lang")))
    one, two = (langid.fit(d.where("not held_out")) for d in (docs, other))
    assert all(np.array_equal(a, b) for a, b in zip(one.parameters(), two.parameters()))


def test_nothing_to_learn_from(spark):
    docs = docs_frame(spark, [(1, "some text", None, "s")]).withColumn("held_out", F.lit(False))
    assert [tuple(r) for r in langid.predict(docs, langid.fit(docs)).collect()] == [(1, False, "und", 0.0)]
    empty = docs.limit(0)
    assert langid.predict(empty, langid.fit(empty)).count() == 0
    single = docs_frame(spark, ROWS[:1]).withColumn("held_out", F.lit(True))
    assert langid.predict(single, langid.fit(single)).first()["lang_pred"] == "xx"


def test_tabulated_filters_match_plain_convolution():
    model = langid.Model(["a", "b"], seed=3)
    x = np.random.default_rng(1).integers(0, 256, (5, langid.WINDOW), dtype=np.uint8)
    pooled = []
    for w, f in zip(langid.WIDTHS, model.filters):
        span = langid.WINDOW - w + 1
        pooled.append(sum(f[j][x[:, j:j + span]] for j in range(w)).max(1))
    h = np.maximum(np.concatenate(pooled, 1) + model.bias, 0)
    want = langid.softmax(h @ model.out + model.out_bias)
    assert np.allclose(langid.Predictor(model).probabilities(x), want, atol=1e-5)
