import random

import numpy as np
from helpers import docs_frame, prose

from riverlens.llm import neardup
from riverlens.llm.common import connected_components


def grams(text):
    w = (text or "").lower().split()
    return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute_classes(rows, similar=0.8):
    """Components over all pairs: plain shingle Jaccard, and equal texts."""
    sets = [grams(t) for _, t, _, _ in rows]
    at = list(range(len(rows)))

    def root(k):
        while at[k] != k:
            k = at[k]
        return k
    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if (rows[a][1] or "") == (rows[b][1] or "") or (x and y and len(x & y) >= similar * len(x | y)):
                at[root(a)] = root(b)
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(root(k), set()).add(rows[k][0])
    return {frozenset(g) for g in groups.values()}


def variant(seed, n, edits):
    words = prose(seed, n).split()
    for e in edits:
        words[e * 31 % n] = f"edit{e}"
    return " ".join(words)


def corpus():
    rows, k = [], 0
    for seed in range(40):                                    # groups of copies and near copies of several sizes
        for copy in range(1 + seed % 6):
            rows.append((k, variant(seed, 120 + seed, range(copy * 2, copy * 2 + copy % 3)), "en", "s"))
            k += 1
    for copy in range(60):                                    # a large group of near copies, and half alike ones
        rows.append((k, variant(999, 200, range(copy, copy + 3)), "en", "s"))
        rows.append((k + 1, prose(999, 200)[:600] + " " + prose(2000 + copy, 90), "en", "s"))
        k += 2
    rows += [(k, None, None, None), (k + 1, "", "en", "s"), (k + 2, "  ", "en", "s"), (k + 3, "one two", "en", "s"),
             (k + 4, "One  TWO", "en", "s"), (k + 5, "one two three", "en", "s"), (k + 6, prose(5, 50000), "en", "s"),
             (k + 7, prose(5, 50000) + " more", "en", "s")]
    return rows


def found(df):
    groups = {}
    for r in df.collect():
        groups.setdefault(r["class_id"], set()).add(r["doc_id"])
    assert all(c == min(g) for c, g in groups.items())
    return {frozenset(g) for g in groups.values()}


def test_classes_hold_every_link(spark):
    rows = corpus()
    got = found(neardup.near_duplicates(docs_frame(spark, rows)))
    for group in brute_classes(rows):
        assert any(group <= g for g in got), group
    assert sum(len(g) for g in got) == len(rows)
    # texts that are plainly different stay apart
    loose = brute_classes(rows, 0.6)
    assert all(any(g <= other for other in loose) for g in got)


def test_chain_is_joined_over_small_tiles(spark, monkeypatch):
    # a chain: neighbours are similar, the ends are not
    monkeypatch.setattr(neardup, "TILE", 2)
    words = prose(77, 400).split()
    rows = []
    for k in range(12):
        rows.append((k, " ".join([f"new{k}x{j}" if j // 8 < k else w for j, w in enumerate(words)]), "en", "s"))
        rows.append((100 + k, " ".join([f"new{k}y{j}" if j // 5 < k else w for j, w in enumerate(words)]), "en", "s"))
    got = found(neardup.near_duplicates(docs_frame(spark, rows)))
    assert all(any(g <= x for x in got) for g in brute_classes(rows))
    assert all(any(x <= g for g in brute_classes(rows, 0.7)) for x in got)


def test_word_hashes_follow_the_words():
    import pyarrow as pa
    texts = ["a b  a", None, "", " \n", "B\ta", "caf\u00e9 CAF\u00c9", "ab", "a" * 3_000_000 + " b"]
    hashes, ends = neardup.word_hashes(pa.array(texts, pa.string()).slice(0))
    lo, seen = 0, {}
    for t, hi in zip(texts, ends):
        words = (t or "").lower().split()
        assert hi - lo == len(words)
        for w, h in zip(words, hashes[lo:hi].tolist()):
            assert seen.setdefault(w, h) == h
        lo = hi
    assert len(set(seen.values())) == len(seen)
    again, _ = neardup.word_hashes(pa.array(["zzz", *texts], pa.string()).slice(1))
    assert again.tolist() == hashes.tolist()


def test_keep_one_passes_columns(spark):
    rows = corpus()[:60]
    rows += [rows[3], rows[3], (None, rows[3][1], "en", "s")]
    df = docs_frame(spark, rows, extra=True)
    out = neardup.keep_one(df)
    assert out.schema == df.schema
    kept = [r["doc_id"] for r in out.collect()]
    classes = found(neardup.near_duplicates(df.where("doc_id is not null").dropDuplicates(["doc_id"])))
    assert sorted(kept) == sorted(min(g) for g in classes)
    assert neardup.keep_one(df.limit(0)).count() == 0


def test_samples_estimate_weighted_jaccard():
    idf = np.linspace(1, 3, neardup.BUCKETS).astype(np.float32)
    rng = np.random.default_rng(4)
    names = np.sort(rng.integers(0, 2 ** 63, 300, dtype=np.uint64))
    agree, want = [], []
    for trial in range(150):
        a = (names[:240], rng.uniform(1, 3, 240).astype(np.float32))
        b = (names[40:], np.concatenate([a[1][40:] * rng.uniform(.9, 1.1, 200), rng.uniform(1, 3, 60)]).astype(np.float32))
        want.append(neardup.similarity(a, b)[0] ** neardup.ROWS)
        agree.append((neardup.band_keys(a) == neardup.band_keys(b))[:neardup.BANDS].mean())
        names = np.sort(rng.integers(0, 2 ** 63, 300, dtype=np.uint64))
    assert abs(np.mean(agree) - np.mean(want)) < 0.04
    assert len(idf) == neardup.BUCKETS


def test_connected_components(spark):
    edges = [(f"{k:04}", f"{k + 1:04}") for k in range(0, 300) if k % 50 != 49] + [("x", "x"), ("hub", "0007")]
    got = {}
    for r in connected_components(spark.createDataFrame(edges, "a string, b string")).collect():
        got.setdefault(r["component"], set()).add(r["node"])
    assert len(got) == 6 and got["0000"] == {f"{k:04}" for k in range(50)} | {"hub"}
    assert connected_components(spark.createDataFrame([], "a string, b string")).count() == 0


def hot_passage_pairs():
    """12 pairs of a plain similarity of 0.806, each around a passage that stands in a third of all rows."""
    rng = random.Random(7)
    words = lambda name, n: [f"{name}w{k}" for k in range(n)]
    own = lambda name: [*words(name, 7), *[name] * 40]
    passages = [words(f"p{p}", 104) for p in range(12)]
    texts = [x for p, passage in enumerate(passages) for x in (passage + own(f"a{p}"), own(f"b{p}") + passage)]
    for k in range(60):
        texts.append(words(f"own{k}", 400) + [w for p in rng.sample(range(12), 5) for w in [f"gap{k}x{p}", *passages[p]]])
    return [(k, " ".join(t), "en", "s") for k, t in enumerate(texts)]


def test_pairs_around_a_common_passage_are_found(spark):
    rows = hot_passage_pairs()
    sets = [grams(t) for _, t, _, _ in rows]
    assert all(len(sets[k] & sets[k + 1]) >= 0.8 * len(sets[k] | sets[k + 1]) for k in range(0, 24, 2))
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(docs_frame(spark, rows)).collect()}
    assert [p for p in range(12) if got[2 * p + 1] != 2 * p] == []


def test_plain_keys_follow_plain_jaccard():
    rng, agree = np.random.default_rng(5), []
    for _ in range(300):
        names = rng.integers(0, 2 ** 63, 300, dtype=np.uint64)
        # whatever the weights
        a, b = (neardup.band_keys((x, rng.choice([1, 3, 7.9], len(x)).astype(np.float32))) for x in (names[:270], names[30:]))
        agree.append((a == b)[neardup.BANDS:].mean())
    assert abs(np.mean(agree) - 0.8 ** neardup.ROWS) < 0.03
