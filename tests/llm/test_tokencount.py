import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from riverlens.llm import tokencount as T

from helpers import docs_frame, prose, sorted_rows

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def merges():
    return T.Merges(PATH)


def lib(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_any_character_as_the_library(library, merges):
    texts = [f"a{chr(k)}b 1{chr(k)}2 {chr(k)}  {chr(k)}{chr(k)} x" for k in range(0, 0x30000) if not 0xd800 <= k < 0xe000]
    assert T.Counter(merges).counts(texts) == lib(library, texts)


def test_random_texts_and_forgetting(library, merges):
    rng = random.Random(1)
    letters = "abcdeéß ñ日本 \n\t'!1234567890"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(300))) for _ in range(1500)]
    texts += ["<|endoftext|>" * 3 + " a <|endoftext|>b", "a" * 5000, "ab" * 700 + " " * 2000, " " * 100_000, ""]
    want = lib(library, texts)
    assert T.Counter(merges).counts(texts) == want
    small = T.Counter(merges, memory=1000)
    assert [n for k in range(0, len(texts), 100) for n in small.counts(texts[k:k + 100])] == want
    assert len(small.known) < 5000


def test_rounds_and_waiting_lists_agree(library, merges, monkeypatch):
    rng = random.Random(2)
    words = [bytes(rng.choice(b"aaabcdeft ") for _ in range(rng.randrange(1, 900))) for _ in range(200)]
    assert [merges.long_count(w) for w in words] == merges.counts(words).tolist()


def test_long_texts_in_slices(library, merges, monkeypatch):
    monkeypatch.setattr(T, "GROUP", 1000)
    monkeypatch.setattr(T, "SLICE", 37)
    texts = [prose(3, 2000), "", prose(4, 50) + "<|endoftext|>" + prose(5, 400), "x" * 30_000]
    assert T.Counter(merges).counts(texts) == lib(library, texts)


def test_defined_cases(spark, library):
    rows = [(1, "one two", "en", "s"), (2, None, None, None), (3, "", "en", "s"), (None, "né <|endoftext|>", "en", "s"),
            (1, "one two", "en", "s"), (4, "word " * 1025, "en", "s"), (5, "\x00\r\n　", "en", "s")]
    got = sorted_rows(T.count_tokens(docs_frame(spark, rows, extra=True), PATH))
    want = []
    for i, t, _, _ in rows:
        n = lib(library, [t or ""])[0]
        want.append((i, len((t or "").encode()), n, n > 1024))
    assert got == sorted(want, key=str)
    assert T.count_tokens(docs_frame(spark, []), PATH).collect() == []


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        T.Merges(public_tokenizers.path("word_bpe_49k.json"))
