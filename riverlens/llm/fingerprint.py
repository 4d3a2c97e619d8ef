"""Document fingerprints of statistically improbable features.

Every window of ``WINDOW`` bytes of the UTF-8 text has a Shannon entropy.  One
pass over all documents counts how often each entropy occurs; the rarer, the
better the rank.  In every run of ``WINDOW`` neighbouring windows the best
ranked (the leftmost of equals) gets a vote, and windows with a quarter of the
possible votes are the document's features.  Features go, in order and each
once, into Bloom filters of 2048 bits with five bits a feature; a filter takes
160 and the next one is chained on.  Two fingerprints are compared filter by
filter: the overlap of bits beyond chance and a 30 % cut-off, normalised to
0..1, best match for each filter of the shorter chain, averaged by features.

Defined cases: a null text is empty; an empty text has no feature, its
fingerprint is that of every empty text and its likeness is 1 to these and 0
to others; a text shorter than a window is one feature as a whole; equal texts
have equal fingerprints, in any batch; documents are ordered by (doc_id, text),
null ids first, so repeated rows follow one another; a lone document is
followed by itself; an empty table gives an empty result; other columns do not
matter.

Scale: one pass that counts entropies (1001 numbers a task), one pass over the
ids that finds where the ordered partitions begin, and one shuffle of the
texts into them.  The first document of each partition is also sent to the one
before, so the following document is always at hand and no window runs over
the whole table.  A task streams its documents; a long one is worked on in
segments of ``GROUP`` bytes, so beside the text itself its features are held.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 32
BINS = 1001
FILTER_BITS, FEATURE_BITS, FILTER_FEATURES = 2048, 5, 160
CUT = 0.3
SEGMENT = 512           # windows worked on in one row of the entropy matrix
GROUP = 2_000_000       # bytes worked on at once
_COUNT = np.arange(WINDOW + 2, dtype=np.float64)
_TERM = np.where(_COUNT > 0, _COUNT * np.log2(np.maximum(_COUNT, 1)), 0.0)
_STEP = np.round((_TERM[1:] - _TERM[:-1]) * 2 ** 20).astype(np.int64)  # growth of the sum when a count rises by one
_FULL = int(_STEP[:WINDOW].sum())
_WEIGHTS = np.random.default_rng(20).integers(1, 2 ** 63, WINDOW, dtype=np.uint64) | np.uint64(1)


class Digest:
    """A chain of Bloom filters (rows of 256 bytes) and the number of features in each."""

    def __init__(self, filters: np.ndarray, counts: np.ndarray):
        self.filters, self.counts = filters, counts

    def text(self) -> str:
        return ",".join(map(str, self.counts.tolist())) + ":" + base64.b64encode(self.filters.tobytes()).decode()

    @staticmethod
    def parse(text: str) -> Digest:
        counts, _, bits = text.partition(":")
        counts = np.array([int(x) for x in counts.split(",") if x], dtype=np.int64)
        return Digest(np.frombuffer(base64.b64decode(bits), dtype=np.uint8).reshape(len(counts), -1), counts)


def likeness(a: Digest, b: Digest) -> float:
    """Normalised bit overlap of two digests, 0..1; the same either way."""
    if not len(a.counts) or not len(b.counts):
        return float(len(a.counts) == len(b.counts))
    if (len(a.counts), int(a.counts.sum()), a.filters.tobytes()) > (len(b.counts), int(b.counts.sum()), b.filters.tobytes()):
        a, b = b, a
    y = np.unpackbits(b.filters, axis=1).astype(np.float32)
    ny, best = y.sum(1), []
    for k in range(0, len(a.counts), 256):
        x = np.unpackbits(a.filters[k:k + 256], axis=1).astype(np.float32)
        nx = x.sum(1)
        most = np.minimum(nx[:, None], ny[None, :])
        chance = nx[:, None] * ny[None, :] / FILTER_BITS
        least = chance + CUT * (most - chance)
        best.append(np.clip((x @ y.T - least) / np.maximum(most - least, 1e-9), 0, 1).max(1))
    return float(np.average(np.concatenate(best), weights=a.counts))


def _groups(texts: list[bytes]) -> Iterator[list[int]]:
    """Numbers of consecutive texts of about ``GROUP`` bytes in all; a longer text is a group of its own."""
    group, size = [], 0
    for k, t in enumerate(texts):
        if len(t) > GROUP and group:
            yield group
            group, size = [], 0
        group.append(k)
        size += len(t)
        if size >= GROUP:
            yield group
            group, size = [], 0
    if group:
        yield group


def _entropy_bins(buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Entropy bins of all windows of the texts buf[start:start+length], text after text; each has a window."""
    wins = lengths - WINDOW + 1
    pieces = -(-wins // SEGMENT)
    text = np.repeat(np.arange(len(wins)), pieces)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    at = starts[text] + nth * SEGMENT
    here = np.minimum(SEGMENT, wins[text] - nth * SEGMENT)
    order = np.argsort(-here, kind="stable")  # long pieces first: a step works on a leading part only
    at, here = at[order], here[order]
    out = np.empty((len(at), SEGMENT), dtype=np.int16)
    for lo in range(0, len(at), 4096):
        _slide(buf, at[lo:lo + 4096], here[lo:lo + 4096], out[lo:lo + 4096])
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    size = here[back]
    return out[back][np.arange(SEGMENT)[None, :] < size[:, None]]


def _slide(buf: np.ndarray, at: np.ndarray, here: np.ndarray, out: np.ndarray) -> None:
    """Slide over up to 4096 pieces at once, one byte in and one byte out of every window per step."""
    counts = np.zeros(len(at) * 256, dtype=np.uint8)
    row = np.arange(len(at)) * 256
    total = np.zeros(len(at), dtype=np.int64)
    for t in range(int(here[0]) + WINDOW - 1):
        if t >= WINDOW:
            n = int(np.searchsorted(-here, -(t - WINDOW + 1), side="left"))  # pieces with a window that ends here
            if n < len(at):
                at, row, total = at[:n], row[:n], total[:n]
            cell = row + buf[at + (t - WINDOW)]
            c = counts[cell] - 1
            total -= _STEP[c]
            counts[cell] = c
        cell = row + buf[at + t]
        c = counts[cell]
        total += _STEP[c]
        counts[cell] = c + 1
        if t >= WINDOW - 1:
            out[:len(at), t - WINDOW + 1] = (BINS - 1) - total * (BINS - 1) // _FULL


def entropy_histogram(texts: list[bytes]) -> np.ndarray:
    """How many windows of ``texts`` have each entropy bin."""
    found = np.zeros(BINS, dtype=np.int64)
    # a very long text in segments, which share no window
    texts = [part for t in texts for part in ([t] if len(t) <= GROUP else [
        t[a:a + GROUP + WINDOW - 1] for a in range(0, len(t) - WINDOW + 1, GROUP)])]
    for group in _groups(texts):
        long = [texts[k] for k in group if len(texts[k]) >= WINDOW]
        if long:
            buf, starts, lengths = _flat(long)
            found += np.bincount(_entropy_bins(buf, starts, lengths), minlength=BINS)
    return found


def _flat(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    buf = np.frombuffer(b"".join(texts) + bytes(SEGMENT + 2 * WINDOW), dtype=np.uint8)
    return buf, np.cumsum(lengths) - lengths, lengths


def rarity_ranks(histogram: np.ndarray) -> np.ndarray:
    """Rank of each entropy bin, the rarest first; equal counts by bin."""
    ranks = np.empty(BINS, dtype=np.int64)
    ranks[np.argsort(histogram, kind="stable")] = np.arange(BINS)
    return ranks


def _best_of_runs(key: np.ndarray) -> np.ndarray:
    """The least key of each run of ``WINDOW`` neighbours."""
    best, span = key, 1
    while span < WINDOW:
        best = np.minimum(best[:-span], best[span:])
        span *= 2
    return best


def _long_features(text: bytes, ranks: np.ndarray) -> np.ndarray:
    """The features of one text of more than ``GROUP`` bytes, in order and with repeats, a segment at a time.

    A window's votes come from the runs that hold it, so a segment that reaches
    a run further on both sides has all votes of its own windows.
    """
    wins, reach, enough = len(text) - WINDOW + 1, WINDOW - 1, WINDOW // 4
    while True:
        most, out = 0, []
        for a in range(0, wins, GROUP):
            b = min(wins, a + GROUP)
            lo, hi = max(0, a - reach), min(wins, b + reach)
            buf, starts, lengths = _flat([text[lo:hi + reach]])
            key = ranks[_entropy_bins(buf, starts, lengths)] << 40 | np.arange(hi - lo)
            votes = np.bincount(_best_of_runs(key) & ((1 << 40) - 1), minlength=hi - lo)[a - lo:b - lo]
            most = max(most, int(votes.max()))
            at = np.flatnonzero(votes >= enough) + a - lo
            hashed = np.zeros(len(at), dtype=np.uint64)
            for k in range(WINDOW):
                hashed += buf[at + k].astype(np.uint64) * _WEIGHTS[k]
            out.append(hashed)
        if most >= enough:
            return np.concatenate(out)
        enough = most


def _features(texts: list[bytes], ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, 64-bit feature) of all features of the texts, in order."""
    if len(texts) == 1 and len(texts[0]) > GROUP:
        value = _mixed(_long_features(texts[0], ranks))
        value = value[np.sort(np.unique(value, return_index=True)[1])]     # the first place counts
        return np.zeros(len(value), dtype=np.int64), value
    whole = [k for k, t in enumerate(texts) if 0 < len(t) < WINDOW]
    long = np.array([k for k, t in enumerate(texts) if len(t) >= WINDOW], dtype=np.int64)
    owner, value = [], []
    if whole:
        rows = np.zeros((len(whole), WINDOW), dtype=np.uint64)
        for r, k in enumerate(whole):
            rows[r, :len(texts[k])] = np.frombuffer(texts[k], dtype=np.uint8).astype(np.uint64) + np.uint64(256)
        owner.append(np.array(whole)), value.append((rows * _WEIGHTS).sum(1))
    if len(long):
        buf, starts, lengths = _flat([texts[k] for k in long])
        wins = lengths - WINDOW + 1
        slot = np.maximum(wins, WINDOW)     # too few windows for a run: padded with the worst rank
        ends = np.cumsum(slot)
        place = ends - slot
        key = np.full(int(ends[-1]), np.int64(1) << 62, dtype=np.int64)
        inside = np.arange(int(wins.sum())) + np.repeat(place - (np.cumsum(wins) - wins), wins)
        key[inside] = ranks[_entropy_bins(buf, starts, lengths)] << 40 | inside
        best = _best_of_runs(key)
        runs = slot - WINDOW + 1
        first = np.arange(int(runs.sum())) + np.repeat(place - (np.cumsum(runs) - runs), runs)
        votes = np.bincount(best[first] & ((1 << 40) - 1), minlength=int(ends[-1]))
        enough = np.minimum(WINDOW // 4, np.maximum.reduceat(votes, place))
        chosen = np.flatnonzero(votes >= np.repeat(enough, slot))
        chosen = chosen[votes[chosen] > 0]
        mine = np.searchsorted(ends, chosen, side="right")
        at = starts[mine] + chosen - place[mine]
        hashed = np.zeros(len(at), dtype=np.uint64)
        for k in range(WINDOW):
            hashed += buf[at + k].astype(np.uint64) * _WEIGHTS[k]
        owner.append(long[mine]), value.append(hashed)
    if not owner:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    owner, value = np.concatenate(owner), _mixed(np.concatenate(value))
    # each feature once a text, the first place counts
    _, kept = np.unique(_mixed(value + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
    kept = kept[np.lexsort((kept, owner[kept]))]
    return owner[kept], value[kept]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def digests(texts: list[bytes], ranks: np.ndarray) -> list[Digest]:
    """The digest of each text."""
    out: list[Digest] = []
    for group in _groups(texts):
        owner, value = _features([texts[k] for k in group], ranks)
        n = np.bincount(owner, minlength=len(group))
        chain = -(-n // FILTER_FEATURES)
        base = np.cumsum(chain) - chain
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        bits = np.zeros((int(chain.sum()), FILTER_BITS), dtype=bool)
        for k in range(FEATURE_BITS):
            bits[base[owner] + nth // FILTER_FEATURES, (value >> np.uint64(11 * k)).astype(np.int64) % FILTER_BITS] = True
        packed = np.packbits(bits, axis=1)
        for k in range(len(group)):
            c = int(chain[k])
            counts = np.full(c, FILTER_FEATURES, dtype=np.int64)
            if c:
                counts[-1] = n[k] - FILTER_FEATURES * (c - 1)
            out.append(Digest(packed[base[k]:base[k] + c], counts))
    return out


def corpus_ranks(docs: DataFrame) -> np.ndarray:
    """Rarity ranks of the entropies over all texts: a fixed number of counts reaches the driver."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(BINS, dtype=np.int64)
        for batch in batches:
            found += entropy_histogram([(x.as_py() or "").encode() for x in batch.column("text")])
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(found), pa.int32()),
                                          pa.array(found[found > 0], pa.int64())], ["bin", "n"])

    counts = docs.select("text").mapInArrow(count, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n"))
    histogram = np.zeros(BINS, dtype=np.int64)
    for row in counts.collect():
        histogram[row["bin"]] = row["n"]
    return rarity_ranks(histogram)


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (slot, ahead, doc_id, text) in order within their partition; ``ahead`` marks the row after a slot's last.

    The slots cut the order of doc_id into as many parts as the session has
    shuffle partitions; the driver holds one bound and one first id for each.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select("doc_id", "text")
    ids = docs.select("doc_id")
    marks = [float(k) / parts for k in range(1, parts)] or [0.5]
    bounds = sorted(set(ids.agg(F.percentile_approx("doc_id", marks, 100 * parts)).first()[0] or [0]))
    high = 1 << max(0, len(bounds).bit_length() - 1)
    steps = F.array(*[F.lit(high >> k) for k in range(high.bit_length())])
    cuts = F.lit(bounds).cast("array<bigint>")
    # binary search: the number of bounds up to the id; a null id comes first
    slot = F.aggregate(steps, F.lit(0), lambda at, k: F.when(
        (at + k <= len(bounds)) & (F.get(cuts, at + k - 1) <= F.col("doc_id")), at + k).otherwise(at))
    low, null = F.min("doc_id").alias("low"), F.bool_or(F.col("doc_id").isNull()).alias("null")
    heads = sorted((r["slot"], None if r["null"] else r["low"])
                   for r in ids.withColumn("slot", slot).groupBy("slot").agg(low, null).collect())
    head, before = [None] * (len(bounds) + 1), [0] * (len(bounds) + 1)
    for k, (s, first) in enumerate(heads):
        head[s], before[s] = first, heads[k - 1][0]
    firsts, befores = F.array(*[F.lit(x).cast("long") for x in head]), F.lit(before).cast("array<int>")
    to = lambda s, ahead: F.struct(s.alias("slot"), F.lit(ahead).alias("ahead"))
    sent = F.when(F.col("doc_id").cast("long").eqNullSafe(F.get(firsts, F.col("slot"))),
                  F.array(to(F.col("slot"), False), to(F.get(befores, F.col("slot")), True))
                  ).otherwise(F.array(to(F.col("slot"), False)))
    rows = docs.withColumn("slot", slot).select(F.explode(sent).alias("to"), "doc_id", "text")
    return (rows.select("to.slot", "to.ahead", "doc_id", "text")
            .repartitionById(len(bounds) + 1, F.col("slot"))
            .sortWithinPartitions("slot", "ahead", F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()))


def edited(text: str, following: str) -> str:
    """``text`` whose last quarter gives way to the start of the following one."""
    q = len(text) // 4
    return text[:len(text) - q] + following[:q]


def fingerprints(docs: DataFrame) -> DataFrame:
    """The fingerprint of each text (doc_id, fingerprint)."""
    ranks = corpus_ranks(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = digests([(x.as_py() or "").encode() for x in batch.column("text")], ranks)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([d.text() for d in found], pa.string())],
                                             ["doc_id", "fingerprint"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fingerprint string")


def compare_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and its edited text, and their likeness (the contract's columns)."""
    from hashlib import sha256

    ranks = corpus_ranks(docs)
    kind = docs.schema["doc_id"].dataType
    schema = (f"doc_id {kind.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []  # the slot's last document, whose follower has yet to come
        for batch in batches:
            texts = [x or "" for x in batch.column("text").to_pylist()]
            own = digests([t.encode() for t in texts], ranks)
            pairs = []
            for slot, ahead, doc_id, text, digest in zip(batch.column("slot").to_pylist(), batch.column("ahead").to_pylist(),
                                                         batch.column("doc_id"), texts, own):
                if held and held[0] == slot:
                    pairs.append((*held[1:], text, digest))
                held = [] if ahead else [slot, doc_id, text, digest]
            changed = [edited(text, after) for _, text, _, after, _ in pairs]
            marks = digests([t.encode() for t in changed], ranks)
            yield pa.RecordBatch.from_arrays([
                pa.array([p[0].as_py() for p in pairs], batch.column("doc_id").type),
                pa.array([len(p[1]) for p in pairs], pa.int64()),
                pa.array([sha256(t.encode()).hexdigest() for t in changed], pa.string()),
                pa.array([p[2].text() for p in pairs], pa.string()), pa.array([d.text() for d in marks], pa.string()),
                pa.array([likeness(p[2], d) for p, d in zip(pairs, marks)], pa.float64()),
                pa.array([likeness(p[2], p[4]) for p in pairs], pa.float64())],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return with_next(docs).mapInArrow(run, schema)
