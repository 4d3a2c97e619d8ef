"""Token counts by rank-synchronous merging of ragged arrays.

A text is cut at the added tokens of the tokenizer file, which count one each,
and the rest by the byte-level pattern into pre-tokens.  The pre-tokens of many
texts are held as one flat numpy array of symbols with the length of each
sequence.  A round finds the lowest-ranked adjacent pair of every sequence and
merges all its occurrences, from the left, in all sequences at once; sequences
without a pair of any rank leave the array, and what is left of their symbols
is their count.  A merged symbol only takes part in pairs of a higher rank, so
this equals one merge at a time by (rank, place).  A pre-token of more than
``LONG`` bytes is merged alone: its pairs wait in one list of places a rank, so
a round costs what it merges and not the length of the text.

Defined cases: a null text is empty (0 bytes, 0 tokens, not over the limit); a
null doc_id passes through; repeated rows give repeated results; columns of
other names do not matter; an empty table gives an empty result; a file with
a normalizer, a prefix space, an unknown token or another model is refused.

Scale: a narrow map over the documents, no shuffle; the merge table (about
2 MB, fixed by the file) is read on the driver and broadcast.  Texts are worked
on ``GROUP`` characters at a time, long ones in slices, and a worker remembers
the counts of pre-tokens of ``MEMORY`` bytes in all, once or twice, so neither
very long texts nor texts of junk fill it.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame

LIMIT = 1024            # tokens of a training window
GROUP = 2_000_000       # characters of the texts that are merged together
SLICE = 200_000         # pre-tokens of a long text that are merged together
LONG = 1024             # bytes of a pre-token that is merged alone
MEMORY = 16_000_000     # bytes of the pre-tokens that a worker remembers
NEVER = np.iinfo(np.int32).max

# FIXED VALUES: the pattern of byte-level pre-tokens; white space is Unicode's White_Space.
WHITE = r"\t-\r \x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
PATTERN = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+"
           rf"|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + others.index(b)) for b in range(256)]


class Merges:
    """Ranked pairs of symbols as sorted arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, cutter = spec["model"], spec.get("pre_tokenizer") or {}
        if (model.get("type") != "BPE" or model.get("unk_token") or model.get("dropout") or model.get("ignore_merges")
                or spec.get("normalizer") or cutter.get("type") != "ByteLevel" or cutter.get("add_prefix_space")
                or not cutter.get("use_regex", True)):
            raise ValueError(f"{path} is no plain byte-level BPE")
        vocab = model["vocab"]
        self.size = max(vocab.values()) + 1
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right = (np.array([vocab[p[k]] for p in pairs], dtype=np.int64) for k in (0, 1))
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.made = np.array([vocab["".join(p)] for p in pairs], dtype=np.int32)    # by rank
        self.left, self.right = left.astype(np.int32), right.astype(np.int32)       # by rank
        self.byte = np.array([vocab[s] for s in byte_symbols()], dtype=np.int32)
        bytes_ = self.byte.astype(np.int64)
        self.first = self._search(bytes_[:, None] * self.size + bytes_[None, :])    # rank of two bytes
        self.added = sorted((t["content"] for t in spec.get("added_tokens") or []), key=lambda t: (-len(t), t))
        if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in spec.get("added_tokens") or []):
            raise ValueError(f"{path} has added tokens that take in what stands around them")

    def _search(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(keys.shape, NEVER, dtype=np.int32)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], NEVER)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair of symbols, NEVER where they do not merge."""
        return self._search(a.astype(np.int64) * self.size + b)

    def counts(self, words: list[bytes]) -> np.ndarray:
        """How many symbols are left of each pre-token; none is empty."""
        out = np.zeros(len(words), dtype=np.int64)
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        for k in np.flatnonzero(sizes > LONG):
            out[k] = self.long_count(words[k])
        short = np.flatnonzero(sizes <= LONG)
        if not len(short):
            return out
        length = sizes[short]
        raw = np.frombuffer(b"".join([words[k] for k in short]), dtype=np.uint8)
        symbol, last = self.byte[raw], np.zeros(len(raw), dtype=bool)
        last[np.cumsum(length) - 1] = True
        rank = np.full(len(raw), NEVER, dtype=np.int32)
        rank[:-1] = self.first[raw[:-1], raw[1:]]
        rank[last] = NEVER
        while True:
            # the lowest rank of every sequence; those without one are done
            low = np.minimum.reduceat(rank, np.cumsum(length) - length)
            going = low < NEVER
            out[short[~going]] = length[~going]
            if not going.any():
                return out
            if not going.all():
                held = np.repeat(going, length)
                symbol, last, rank = symbol[held], last[held], rank[held]
                short, length, low = short[going], length[going], low[going]
            of = np.repeat(np.arange(len(length)), length)
            at = _from_left(np.flatnonzero(rank == low[of]))
            symbol[at] = self.made[rank[at]]
            last[at] = last[at + 1]
            kept = np.ones(len(symbol), dtype=bool)
            kept[at + 1] = False
            length = length - np.bincount(of[at], minlength=len(length))
            at = at - np.arange(len(at))        # places after the merged right parts are gone
            symbol, last, rank = symbol[kept], last[kept], rank[kept]
            changed = np.concatenate([at, at[at > 0] - 1])
            rank[changed] = NEVER
            changed = changed[~last[changed]]
            rank[changed] = self.rank(symbol[changed], symbol[changed + 1])

    def long_count(self, word: bytes) -> int:
        """The same for one long pre-token, with the places of each waiting rank."""
        raw = np.frombuffer(word, dtype=np.uint8)
        n = len(raw)
        symbol = self.byte[raw]
        after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        waiting: dict[int, list[np.ndarray]] = {}
        ranks: list[int] = []
        left = n

        def wait(places: np.ndarray, rank: np.ndarray) -> None:
            fit = rank < NEVER
            places, rank = places[fit], rank[fit]
            order = np.argsort(rank, kind="stable")
            places, rank = places[order], rank[order]
            edges = np.flatnonzero(np.diff(rank, prepend=-1))
            for lo, hi in zip(edges.tolist(), [*edges[1:].tolist(), len(rank)]):
                r = int(rank[lo])
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(ranks, r)
                waiting[r].append(places[lo:hi])

        for lo in range(0, n - 1, GROUP):
            hi = min(n - 1, lo + GROUP)
            wait(np.arange(lo, hi, dtype=np.int32), self.first[raw[lo:hi], raw[lo + 1:hi + 1]])
        while ranks:
            r = heapq.heappop(ranks)
            places = waiting.pop(r)
            at = np.unique(np.concatenate(places)) if len(places) > 1 else np.sort(places[0])
            # a place counts if its pair is still there: symbol -1 is merged into the one before it
            nxt = after[at]
            still = (symbol[at] == self.left[r]) & (nxt < n)
            still[still] = symbol[nxt[still]] == self.right[r]
            at, nxt = at[still], nxt[still]
            if self.left[r] == self.right[r] and len(at):
                joined = np.zeros(len(at), dtype=bool)
                joined[1:] = nxt[:-1] == at[1:]
                at = at[_even(joined)]
            if not len(at):
                continue
            gone = after[at]
            symbol[at], symbol[gone] = self.made[r], -1
            end = after[gone]
            after[at] = end
            inner = end < n
            before[end[inner]] = at[inner]
            left -= len(at)
            wait(at[inner], self.rank(symbol[at[inner]], symbol[end[inner]]))
            prior = before[at]
            inner = prior >= 0
            wait(prior[inner], self.rank(symbol[prior[inner]], symbol[at[inner]]))
        return left


def _even(joined: np.ndarray) -> np.ndarray:
    """Every other element of each run; ``joined`` says which elements touch the one before."""
    k = np.arange(len(joined))
    return (k - np.maximum.accumulate(np.where(joined, 0, k))) % 2 == 0


def _from_left(at: np.ndarray) -> np.ndarray:
    """Sorted places of one pair a sequence, without those that overlap a merge to their left."""
    joined = np.zeros(len(at), dtype=bool)
    joined[1:] = np.diff(at) == 1
    return at[_even(joined)] if joined.any() else at


class Counter:
    """A worker's merge table, pattern and memory of pre-tokens."""

    def __init__(self, merges: Merges, memory: int = MEMORY):
        self.merges, self.memory = merges, memory
        self.pattern = regex.compile(PATTERN)
        self.added = regex.compile("|".join(map(regex.escape, merges.added))) if merges.added else None
        self.known: dict[str, int] = {}     # met lately
        self.older: dict[str, int] = {}     # met before that
        self.held = 0

    def _learn(self, words: set[str]) -> list[str]:
        """Make the counts of ``words`` known; returns those that are too long to be remembered."""
        fresh = []
        for word in words.difference(self.known):
            if (n := self.older.get(word)) is not None:
                self.known[word] = n
                self.held += len(word) + 100
            else:
                fresh.append(word)
        for word, n in zip(fresh, self.merges.counts([w.encode() for w in fresh]).tolist()):
            self.known[word] = n
            self.held += len(word) + 100
        return [w for w in fresh if len(w) > LONG]

    def _sum(self, lists: list[list[str]]) -> list[int]:
        long = self._learn(set().union(*lists))
        out = [sum(map(self.known.__getitem__, words)) for words in lists]
        for word in long:
            del self.known[word]
            self.held -= len(word) + 100
        if self.held > self.memory:
            self.known, self.older, self.held = {}, self.known, 0
        return out

    def _parts(self, text: str) -> tuple[int, list[str]]:
        """Number of added tokens in the text, and what stands between them."""
        if self.added is None or not self.added.search(text):
            return 0, [text]
        parts = self.added.split(text)
        return len(parts) - 1, parts

    def counts(self, texts: Iterable[str]) -> list[int]:
        """Tokens of each text."""
        out: list[int] = []
        waiting: list[list[str]] = []
        base, size = [], 0
        for text in texts:
            n, parts = self._parts(text)
            words: list[str] = []
            if len(text) > GROUP:
                matches = (m[0] for part in parts for m in self.pattern.finditer(part))
                while run := list(islice(matches, SLICE)):
                    n += self._sum([run])[0]
            else:
                for part in parts:
                    words += self.pattern.findall(part)
                size += len(text)
            base.append(n), waiting.append(words)
            if size >= GROUP:
                out += [a + b for a, b in zip(base, self._sum(waiting))]
                waiting, base, size = [], [], 0
        return out + [a + b for a, b in zip(base, self._sum(waiting))] if waiting else out


_COUNTERS: dict[tuple[str, int], Counter] = {}


def counter_of(shared: Broadcast, path: str, memory: int) -> Counter:
    """The worker's counter; made once per worker process and file."""
    key = (path, memory)
    if key not in _COUNTERS or _COUNTERS[key].merges.size != shared.value.size:
        _COUNTERS.clear()
        _COUNTERS[key] = Counter(shared.value, memory)
    return _COUNTERS[key]


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, memory: int = MEMORY) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs`` (doc_id, text, ...)."""
    shared = docs.sparkSession.sparkContext.broadcast(Merges(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(shared, path, memory)
        for batch in batches:
            text = batch.column("text")
            n = pa.array(counter.counts(t.as_py() or "" for t in text), pa.int64())
            size = pc.fill_null(pc.binary_length(text), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), size, n, pc.greater(n, limit)],
                                             ["doc_id", "n_bytes", "n_tokens", "over_limit"])
        pa.default_memory_pool().release_unused()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
