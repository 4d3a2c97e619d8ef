"""Byte-level BPE encoding and decoding with a two-tier lookup.

A text is cut into pre-tokens by a pattern.  Tier one: a minimal perfect hash
over the vocabulary resolves a pre-token that is a token as a whole.  Tier
two: any other pre-token is merged from its bytes, held in a linked list, with
a heap of the adjacent pairs ordered by (rank, place), which takes n log n
steps for n bytes.  Decoding maps ids back to bytes.

Defined cases: a null text is encoded as the empty text (no ids); any valid
UTF-8 round-trips; special tokens are never produced, their strings are
ordinary text; columns of other names do not matter; repeated rows give
repeated results; an empty table gives an empty result.

Scale: a narrow map over the documents, no shuffle.  The vocabulary and its
hash (about 1 MB at 50,000 tokens, fixed by the rank file) are read on the
driver and broadcast.  A worker remembers the pieces of the last one
or two times ``memory`` different pre-tokens it met, fewer if they are long
(``ENTRY`` bytes each on average, none of over ``LONG``); long texts are encoded
in runs of pre-tokens.  A pre-token of over ``LONG`` bytes is merged over arrays
and a heap of plain numbers: about 60 bytes of memory a byte.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame

MEMO = 220_000
ENTRY = 200     # bytes of a remembered pre-token and its ids, on average, at most
LONG = 4096     # bytes of a pre-token that is merged over arrays and not remembered
RUN = 100_000  # pre-tokens encoded at once


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file in order of their ids."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens = [b""] * (max(int(n) for _, n in pairs) + 1)
    for token, n in pairs:
        tokens[int(n)] = base64.b64decode(token)
    return tokens


class PerfectHash:
    """A minimal perfect hash by displacement: each of n keys has a slot of its own in 0..n-1."""

    def __init__(self, keys: list[bytes], per_bucket: int = 3):
        self.n, self.m = len(keys), max(1, len(keys) // per_bucket)
        buckets: list[list[tuple[int, int]]] = [[] for _ in range(self.m)]
        for k, key in enumerate(keys):
            h = xxhash.xxh64_intdigest(key)
            buckets[h % self.m].append((h, k))
        self.shift = [0] * self.m
        self.key = np.full(self.n, -1, dtype=np.int32)
        free = np.ones(self.n, dtype=bool)
        for b in sorted(range(self.m), key=lambda b: -len(buckets[b])):
            d = 0
            while buckets[b]:
                slots = [self._slot(h, d) for h, _ in buckets[b]]
                if len(set(slots)) == len(slots) and free[slots].all():
                    break
                d += 1
            self.shift[b] = d
            for h, k in buckets[b]:
                slot = self._slot(h, d)
                free[slot], self.key[slot] = False, k
        self.key = self.key.tolist()

    def _slot(self, h: int, d: int) -> int:
        return ((h >> 20) ^ (d * 0x9E3779B97F5)) % self.n

    def __call__(self, key: bytes) -> int:
        """The number of the only key that ``key`` can be; the caller compares."""
        h = xxhash.xxh64_intdigest(key)
        return self.key[self._slot(h, self.shift[h % self.m])]


class Vocabulary:
    """Tokens by id, and ids by token through the perfect hash."""

    def __init__(self, tokens: list[bytes]):
        held = [(t, k) for k, t in enumerate(tokens) if t]
        self.tokens, self.ids = tokens, [k for _, k in held]
        self.print = xxhash.xxh64_intdigest(b"\n".join(tokens))
        self.find = PerfectHash([t for t, _ in held])
        self.parts = dict(held)     # for the merges: a part, or a pair by its joined bytes

    def rank(self, piece: bytes) -> int:
        """The id of ``piece``, -1 if it is no token."""
        k = self.ids[self.find(piece)]
        return k if self.tokens[k] == piece else -1

    def merged(self, piece: bytes) -> list[int]:
        """Ids of a pre-token: itself if it is a token, else by merges of lowest rank, leftmost first."""
        if (whole := self.rank(piece)) >= 0:
            return [whole]
        if len(piece) > LONG:
            return self._merged_long(piece)
        n, parts = len(piece), self.parts
        rank, push, pop = parts.get, heapq.heappush, heapq.heappop
        # the parts as a linked list by their first byte; ends[i] < 0: merged into the part before it
        before, ends = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, end = pop(heap)
            # a pair is stale once its left part is gone or either part has grown
            j = ends[i]
            if j < 0 or j >= n or ends[j] != end:
                continue
            ends[i], ends[j] = end, -1
            if end < n:
                before[end] = i
                if (r := rank(piece[i:ends[end]])) is not None:
                    push(heap, (r, i, ends[end]))
            if (p := before[i]) >= 0 and (r := rank(piece[p:end])) is not None:
                push(heap, (r, p, end))
        out, i = [], 0
        while i < n:
            out.append(parts[piece[i:ends[i]]])     # a vocabulary that lacks a single byte raises here
            i = ends[i]
        return out


    def _merged_long(self, piece: bytes) -> list[int]:
        """The same for a long pre-token: the linked list as arrays, a pair on the heap as one number (rank, place)."""
        n, rank, none = len(piece), self.parts.get, -1
        before, ends = array("i", range(-1, n - 1)), array("i", range(1, n + 1))
        # the rank of the pair that begins at a place; a number on the heap with another one is stale
        pair = array("i", (rank(piece[i:i + 2], none) for i in range(n - 1)))
        pair.append(none)
        heap = [r * n + i for i, r in enumerate(pair) if r >= 0]
        heapq.heapify(heap)
        while heap:
            r, i = divmod(heapq.heappop(heap), n)
            if pair[i] != r:
                continue
            j = ends[i]
            end = ends[j]
            ends[i], ends[j], pair[j] = end, -1, none
            fresh = none
            if end < n:
                before[end] = i
                fresh = rank(piece[i:ends[end]], none)
            pair[i] = fresh
            if fresh >= 0:
                heapq.heappush(heap, fresh * n + i)
            if (p := before[i]) >= 0:
                pair[p] = fresh = rank(piece[p:end], none)
                if fresh >= 0:
                    heapq.heappush(heap, fresh * n + p)
        out, i = [], 0
        while i < n:
            out.append(self.parts[piece[i:ends[i]]])
            i = ends[i]
        return out


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(read_ranks(path))


class Coder:
    """Encoder and decoder of a worker, with its memory of pre-tokens."""

    def __init__(self, vocabulary: Vocabulary, pattern: str, memory: int = MEMO):
        self.vocabulary, self.pattern, self.memory = vocabulary, regex.compile(pattern), memory
        self.memo: dict[str, str] = {}      # met lately
        self.older: dict[str, str] = {}     # met before that
        self.held = 0                       # characters of what was met lately, and of its ids
        self.pieces = {str(k): t for k, t in enumerate(vocabulary.tokens) if t}

    def runs(self, text: str) -> Iterator[str]:
        """The ids of ``text`` as decimal numbers joined by commas, one string for each run of pre-tokens."""
        if len(text) <= RUN:
            found: Iterable[list[str]] = (x for x in (self.pattern.findall(text),) if x)
        else:
            matches = (m[0] for m in self.pattern.finditer(text))
            found = iter(lambda: list(islice(matches, RUN)), [])
        for words in found:
            memo, long = self.memo, []
            for word in set(words).difference(memo):
                memo[word] = self.older.get(word) or ",".join(map(str, self.vocabulary.merged(word.encode())))
                if len(word) > LONG:
                    long.append(word)
                else:
                    self.held += len(word) + len(memo[word])
            yield ",".join([memo[w] for w in words])
            for word in long:
                del memo[word]
            if len(memo) > self.memory or self.held > self.memory * ENTRY:
                self.memo, self.older, self.held = {}, memo, 0

    def decoded(self, ids: str) -> bytes:
        pieces = self.pieces
        return b"".join([pieces[k] for k in ids.split(",")])


_CODERS: dict[tuple[int, str, int], Coder] = {}


def coder_of(shared: Broadcast, pattern: str, memory: int = MEMO) -> Coder:
    """The worker's coder for a broadcast token list; made once per worker process."""
    key = (shared.value.print, pattern, memory)
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = Coder(shared.value, pattern, memory)
    return _CODERS[key]


def _texts(batch: pa.RecordBatch, column: str) -> Iterator[str]:
    for value in batch.column(column):
        yield value.as_py() or ""


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``docs`` (doc_id, text) to (doc_id, ids array<int>)."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(shared, pattern)
        for batch in batches:
            ids = [[int(k) for part in coder.runs(t) for k in part.split(",")] for t in _texts(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))],
                                             ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(rows: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) to (doc_id, text); bytes that are no UTF-8 become the replacement character."""
    shared = rows.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = shared.value
            texts = [None if (ids := x.as_py()) is None else b"".join([tokens[k] for k in ids]).decode(errors="replace")
                     for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def round_trip(docs: DataFrame, path: str, pattern: str, with_ids: bool = False, memory: int = MEMO,
               carried: Sequence[str] = ()) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]): encodes every text and decodes the ids, in one pass.

    ``memory`` is how many pre-tokens a worker remembers once or twice: it costs
    memory that the worker keeps, and saves merges.  ``carried`` columns follow
    doc_id; the rows stay in their order.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(shared, pattern, memory)
        for batch in batches:
            counts, hashes, backs, all_ids = [], [], [], []
            for text in _texts(batch, "text"):
                n, ids, back, parts = 0, hashlib.sha256(), hashlib.sha256(), []
                for part in coder.runs(text):
                    if with_ids:
                        parts.append(np.array(part.split(","), dtype=np.int32))
                    ids.update(b"," * (n > 0) + part.encode())
                    back.update(coder.decoded(part))
                    n += part.count(",") + 1
                counts.append(n), hashes.append(ids.hexdigest()), backs.append(back.hexdigest())
                all_ids.append(np.concatenate(parts) if parts else np.zeros(0, dtype=np.int32))
            out = {"doc_id": batch.column("doc_id"), **{c: batch.column(c) for c in carried}, "n_tokens": pa.array(counts, pa.int64()),
                   "ids_sha256": pa.array(hashes, pa.string()), "decoded_sha256": pa.array(backs, pa.string())}
            if with_ids:
                ends = np.cumsum([0, *(len(x) for x in all_ids)])
                flat = np.concatenate(all_ids) if all_ids else np.zeros(0, dtype=np.int32)
                out["ids"] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_pydict(out)
        pa.default_memory_pool().release_unused()

    kind = docs.schema["doc_id"].dataType.simpleString()
    extra = "".join(f"{c} {docs.schema[c].dataType.simpleString()}, " for c in carried)
    schema = f"doc_id {kind}, {extra}n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", *carried, "text").mapInArrow(run, schema + ", ids array<int>" * with_ids)
