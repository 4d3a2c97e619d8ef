import collections
from hashlib import sha256

import numpy as np
from helpers import docs_frame, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from riverlens.llm import fingerprint as fp


def brute_bins(text):
    out = []
    for k in range(len(text) - fp.WINDOW + 1):
        total = sum(int(fp._STEP[:c].sum()) for c in collections.Counter(text[k:k + fp.WINDOW]).values())
        out.append(fp.BINS - 1 - total * (fp.BINS - 1) // fp._FULL)
    return out


def brute_features(text, ranks):
    """Places of the features by the definition, one window at a time."""
    w = fp.WINDOW
    bins = brute_bins(text)
    keys = [(int(ranks[b]), k) for k, b in enumerate(bins)]
    runs = [keys[k:k + w] for k in range(max(1, len(keys) - w + 1))]
    votes = collections.Counter(min(r)[1] for r in runs)
    enough = min(w // 4, max(votes.values()))
    return sorted(k for k, n in votes.items() if n >= enough)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=fp.WINDOW, max_size=3 * fp.SEGMENT).map(lambda b: bytes(x % 7 for x in b)), min_size=1, max_size=5))
def test_entropies_and_features_match_brute_force(texts):
    buf, starts, lengths = fp._flat(texts)
    assert fp._entropy_bins(buf, starts, lengths).tolist() == [b for t in texts for b in brute_bins(t)]
    ranks = fp.rarity_ranks(fp.entropy_histogram(texts))
    for t, d in zip(texts, fp.digests(texts, ranks)):
        places = brute_features(t, ranks)
        assert int(d.counts.sum()) == len({t[k:k + fp.WINDOW] for k in places})


def test_digests_do_not_depend_on_the_batch():
    texts = [prose(k, 1 + 53 * k % 700).encode() for k in range(60)] + [b"", b"x", b"y" * 31, b"z" * 32, b"q" * 20000]
    ranks = fp.rarity_ranks(fp.entropy_histogram(texts))
    together = [d.text() for d in fp.digests(texts, ranks)]
    assert together == [fp.digests([t], ranks)[0].text() for t in texts]
    assert fp.Digest.parse(together[5]).text() == together[5]
    long = max(fp.digests(texts, ranks), key=lambda d: len(d.counts))
    assert set(long.counts[:-1].tolist()) <= {fp.FILTER_FEATURES}


def test_long_texts_in_segments(monkeypatch):
    texts = [prose(3, 3000).encode(), b"ab" * 4000, prose(4, 40).encode(), bytes(range(256)) * 20, b"q" * 9000, b"", b"short"]
    histogram = fp.entropy_histogram(texts)
    ranks = fp.rarity_ranks(histogram)
    whole = [d.text() for d in fp.digests(texts, ranks)]
    for size in (64, 333, 5000):
        monkeypatch.setattr(fp, "GROUP", size)
        assert (fp.entropy_histogram(texts) == histogram).all()
        assert [d.text() for d in fp.digests(texts, ranks)] == whole


def test_memory_of_a_long_text():
    import resource
    text, ranks = (prose(7, 200_000) + " ").encode() * 8, np.arange(fp.BINS)      # about 20 MB
    fp.digests([text[:100_000]], ranks)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    fp.digests([text], ranks)
    assert (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) * 1024 < 20 * len(text)


def test_likeness_follows_the_share_of_common_text():
    ranks = np.arange(fp.BINS)
    a, b = prose(1, 2000).encode(), prose(2, 2000).encode()
    mixed = a[:len(a) * 3 // 4] + b[len(b) * 3 // 4:]
    one, two, three, none = fp.digests([a, b, mixed, b""], ranks)
    assert fp.likeness(one, one) == 1 and fp.likeness(none, none) == 1 and fp.likeness(one, none) == 0
    assert fp.likeness(one, three) > 0.55 > fp.likeness(one, two) + 0.3
    assert fp.likeness(one, three) == fp.likeness(three, one)


def brute_edits(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    out = []
    for k, (i, t, _, _) in enumerate(order):
        text, after = t or "", order[(k + 1) % len(order)][1] or ""
        q = len(text) // 4
        out.append((i, len(text), sha256((text[:len(text) - q] + after[:q]).encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = ([(k * 7 % 101, prose(k, 5 + k * 13 % 200) + " é😀", "en", "s") for k in range(101)]
        + [(200, None, None, None), (201, "", "en", "s"), (202, "short", "en", "s"), (50, prose(9, 30), "en", "s"), (50, prose(9, 30), "en", "s"),
           (None, "no id", "en", "s"), (203, prose(4, 40000), "en", "s")])


def test_next_document_and_edited_text(spark):
    got = fp.compare_edits(docs_frame(spark, ROWS, extra=True)).collect()
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=str) == brute_edits(ROWS)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[200]["fingerprint"] == by_id[201]["fingerprint"] == ":" and by_id[200]["near_next"] == 1
    assert all(0 <= r[c] <= 1 for r in got for c in ("near_edited", "near_next"))
    long = [r for r in got if r["n_chars"] > 400]
    assert sum(r["near_edited"] for r in long) / len(long) > 0.5 > 0.2 > sum(r["near_next"] for r in long) / len(long)
    alone = sorted((str(r["doc_id"]), r["fingerprint"]) for r in fp.fingerprints(docs_frame(spark, ROWS)).collect())
    assert alone == sorted((str(r["doc_id"]), r["fingerprint"]) for r in got)


def test_one_row_and_no_row(spark):
    one = fp.compare_edits(docs_frame(spark, ROWS[:1])).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1
    assert fp.compare_edits(docs_frame(spark, ROWS[:0])).count() == 0
    none = fp.compare_edits(docs_frame(spark, [(None, "a b", "en", "s"), (None, None, "en", "s")]))
    assert none.count() == 2
