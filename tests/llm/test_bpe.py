import base64
import random
from hashlib import sha256

import public_tokenizers
import tiktoken
from helpers import docs_frame
from hypothesis import given, settings
from hypothesis import strategies as st

from riverlens.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
CODER = bpe.Coder(bpe.vocabulary(PATH), PATTERN)
with open(PATH, "rb") as f:
    RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
REFERENCE = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})


def ids(text):
    return [int(k) for run in CODER.runs(text) for k in run.split(",")]


def test_perfect_hash_is_minimal_and_exact():
    find = CODER.vocabulary.find
    assert sorted(find.key) == list(range(len(RANKS)))
    assert all(CODER.vocabulary.rank(t) == k for t, k in RANKS.items())
    assert CODER.vocabulary.rank(b"no such token at all") == -1


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60))
def test_same_ids_as_the_library(text):
    got = ids(text)
    assert got == REFERENCE.encode_ordinary(text)
    assert b"".join(CODER.vocabulary.tokens[k] for k in got).decode() == text


def test_long_texts_and_runs():
    for text in ("ab" * 150000, "word " * (bpe.RUN + 7), "\n" * 50000, "é😀" * 60000):
        assert ids(text) == REFERENCE.encode_ordinary(text)


def test_long_pre_tokens_by_arrays(monkeypatch):
    rng = random.Random(3)
    pieces = ["".join(rng.choice("abcdefé") for _ in range(n)) for n in (4097, 9000, 60_000)] + ["a" * 5000, "ab" * 4000]
    for text in pieces:
        assert ids(text) == REFERENCE.encode_ordinary(text)
    short = ["".join(rng.choice("aabc") for _ in range(rng.randrange(1, 40))).encode() for _ in range(300)]
    want = [CODER.vocabulary.merged(p) for p in short]
    monkeypatch.setattr(bpe, "LONG", 0)
    assert [CODER.vocabulary.merged(p) for p in short] == want


def test_memory_is_bounded_by_bytes():
    rng = random.Random(4)
    coder = bpe.Coder(CODER.vocabulary, PATTERN, memory=50)
    for _ in range(30):
        text = " ".join("".join(rng.choice("abcdefgh") for _ in range(3000)) for _ in range(3)) + " " + "z" * 5000
        assert [int(k) for run in coder.runs(text) for k in run.split(",")] == REFERENCE.encode_ordinary(text)
        assert sum(len(w) + len(v) for d in (coder.memo, coder.older) for w, v in d.items()) < 3 * 50 * bpe.ENTRY + 60_000
        assert all(len(w) <= bpe.LONG for d in (coder.memo, coder.older) for w in d)


def test_tables(spark):
    rows = [(1, "Hello world", "en", "a"), (1, "Hello world", "en", "a"), (2, None, None, None), (3, "", "en", "a"),
            (None, "<|endoftext|> é", "en", "b"), (4, "x" * 200000, "en", "b")]
    df = docs_frame(spark, rows, extra=True)
    got = bpe.round_trip(df, PATH, PATTERN, with_ids=True).collect()
    assert len(got) == len(rows)
    want = {(i, sha256((t or "").encode()).hexdigest()): REFERENCE.encode_ordinary(t or "") for i, t, _, _ in rows}
    for r in got:
        assert want[r["doc_id"], r["decoded_sha256"]] == r["ids"] and r["n_tokens"] == len(r["ids"])
        assert r["ids_sha256"] == sha256(",".join(map(str, r["ids"])).encode()).hexdigest()
    back = bpe.decode(bpe.encode(df, PATH, PATTERN), PATH)
    assert sorted(map(str, back.collect())) == sorted(map(str, (r for r in df.na.fill("", ["text"]).select("doc_id", "text").collect())))
    assert bpe.round_trip(df.limit(0), PATH, PATTERN).count() == 0
