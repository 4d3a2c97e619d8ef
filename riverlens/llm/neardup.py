"""Near-duplicate classes by improved consistent weighted sampling.

A text is the bag of its five-word shingles (lower-cased words between ASCII
white space; a shorter text is one shingle).  A shingle weighs its count in the text
times its idf, which is estimated over all documents by one hashed count per
bucket: the load of the shingle's bucket above the mean load.  Shingles in
less than ``RARE`` of all documents share the highest idf, so only frequent
shingles matter there, and they are few at any size.  Texts that share a key
are compared: a link needs a weighted Jaccard similarity, or a plain one of the
shingle sets, of ``SIMILAR`` or more.  Each of the two has its own family of
``BANDS`` x ``ROWS`` samples that make its bands' keys: consistent weighted
samples (Ioffe's ICWS, with draws by table from one hash for each sample) and least hashes of the shingle set.  So a pair at the
threshold by either similarity shares no key with a probability of
(1 - SIMILAR^ROWS)^BANDS, 1 in 100,000.  Classes are the connected components
of the links; exact copies of a text are one node.

Which members of a bucket are compared: all with the bucket's first; then, in
tiles, the members that are in different components by now.  Every pair that
shares a key is thus compared or already joined, so no link between two
components is lost; a tile returns one link for each two components it joins,
and a bucket of any size is cut into tiles of a bounded number of members.

Defined cases: a null text is empty; texts without words are alike only if
equal; equal texts are one class even in repeated rows; the class id is the
smallest doc_id of the class (null only if all are null); an empty table gives
an empty result; other columns pass through ``keep_one``.

Scale: the shuffles carry 32-character text keys and band keys; texts travel
only for pairs to verify.  Counts and first members merge map-side, hot
leaders join through AQE's skew handling, components are found by distributed
rounds, and the broadcast idf table has ``BUCKETS`` entries at any size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverlens.llm.common import HEAVY, connected_components, cut, join_known, packed

WORDS, SIMILAR = 5, 0.8
BANDS, ROWS = 16, 3
BUCKETS, RARE = 1 << 18, 1e-3
PART = 1_000_000        # bytes of text worked on at once
TILE = 256              # members of a bucket, about, on a side of a tile
_WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS: list[np.ndarray] = []
_SEED = np.random.default_rng(33)
_PLACE = _SEED.integers(1, 2 ** 63, WORDS, dtype=np.uint64) | np.uint64(1)
_DRAW = (_SEED.integers(1, 2 ** 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1))[:, None]


def text_key(text: Column) -> Column:
    """128-bit key of a text; null counts as empty."""
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
    return x ^ (x >> np.uint64(28))


def _parts(column: pa.Array) -> Iterator[pa.Array]:
    """Slices of a string column of about ``PART`` bytes."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes) // PART
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(column)]
    for lo, hi in zip(edges, edges[1:]):
        yield column.slice(lo, hi - lo)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the polynomial's base and of its inverse modulo 2^64, kept for the next call."""
    if len(_POWERS) == 0 or len(_POWERS[0]) < n:
        size = max(n, PART + PART // 8)
        up, down = np.full(size, _BASE, dtype=np.uint64), np.full(size, pow(int(_BASE), -1, 1 << 64), dtype=np.uint64)
        up[0] = down[0] = 1
        _POWERS[:] = [np.multiply.accumulate(up), np.multiply.accumulate(down)]
    return _POWERS[0], _POWERS[1]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of lower-cased texts, and where each text's words end.

    Words lie between ASCII white space.  A word's hash is a polynomial of its
    bytes, read off running sums over the whole buffer.
    """
    low = pc.utf8_lower(pc.fill_null(texts, "")).cast(pa.large_string())
    offsets = np.frombuffer(low.buffers()[1], dtype=np.int64)[low.offset:low.offset + len(low) + 1]
    if offsets[-1] == offsets[0]:
        return np.zeros(0, dtype=np.uint64), np.zeros(len(low), dtype=np.int64)
    buf = np.frombuffer(low.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    inside = ~_WHITE[buf]
    cut_before = np.zeros(len(buf) + 1, dtype=bool)     # a text begins here, or white space stands around
    cut_before[offsets] = True
    cut_before[1:-1] |= ~inside[:-1] | ~inside[1:]
    starts = np.flatnonzero(inside & cut_before[:-1])
    ends = np.flatnonzero(inside & cut_before[1:]) + 1
    up, down = _powers(len(buf))
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[:len(buf)])])
    return _mixed((sums[ends] - sums[starts]) * down[starts]), np.searchsorted(starts, offsets[1:], side="left")


def shingles(column: pa.Array) -> Iterator[np.ndarray]:
    """The hashed shingles of each text, in order and with repeats."""
    for texts in _parts(column):
        words, ends = word_hashes(texts)
        n = max(0, len(words) - WORDS + 1)
        runs = np.zeros(n, dtype=np.uint64)
        for k in range(WORDS):
            runs += words[k:k + n] * _PLACE[k]
        runs, lo = _mixed(runs), 0
        for hi in ends.tolist():
            if hi - lo >= WORDS:
                yield runs[lo:hi - WORDS + 1]
            elif hi > lo:
                w = words[lo:hi]
                yield _mixed(np.array([(w * _PLACE[:len(w)]).sum() + np.uint64(len(w))], dtype=np.uint64))
            else:
                yield words[:0]
            lo = hi


def bucket_of(shingle: np.ndarray) -> np.ndarray:
    return (shingle >> np.uint64(46)).astype(np.int64) % BUCKETS


def idf_table(docs: DataFrame) -> np.ndarray:
    """idf of each bucket of shingles, over all documents."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = np.zeros(BUCKETS, dtype=np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for s in shingles(batch.column("text")):
                np.add.at(found, bucket_of(np.unique(s)), 1)
        bucket = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(bucket, -1), pa.int32()),
                                          pa.array(np.append(found[bucket], n), pa.int64())], ["bucket", "n"])

    loads = cut(docs.select("text").mapInArrow(count, "bucket int, n long")
                .groupBy("bucket").agg(F.sum("n").alias("n")), "shingle-loads")
    documents = loads.where("bucket < 0").agg(F.sum("n")).first()[0] or 0
    mean = (loads.where("bucket >= 0").agg(F.sum("n")).first()[0] or 0) / BUCKETS
    least = max(1.0, RARE * documents)
    idf = np.full(BUCKETS, 1 + np.log(max(1.0, documents / least)), dtype=np.float64)
    for r in loads.where((F.col("bucket") >= 0) & (F.col("n") > mean + least)).collect():
        idf[r["bucket"]] = 1 + np.log(max(1.0, documents / (r["n"] - mean)))
    return idf.astype(np.float32)


def weights(shingle: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles, sorted, and their weights."""
    names, counts = np.unique(shingle, return_counts=True)
    return names, counts.astype(np.float32) * idf[bucket_of(names)]


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[float, float]:
    """Weighted and plain Jaccard similarity of two bags."""
    if not len(a[0]) or not len(b[0]):
        return 0.0, 0.0
    _, x, y = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    least = float(np.minimum(a[1][x], b[1][y]).sum(dtype=np.float64))
    total = float(a[1].sum(dtype=np.float64) + b[1].sum(dtype=np.float64))
    return least / (total - least), len(x) / (len(a[0]) + len(b[0]) - len(x))


def _gamma_quantiles(u: np.ndarray) -> np.ndarray:
    """Quantiles of the gamma distribution of shape 2, for 0 < u < 1, by Newton's method."""
    c = np.sqrt(2 * u) - np.log1p(-u)
    for _ in range(60):
        tail = np.where(c < 1e-3, c * c / 2 - c ** 3 / 3, -np.expm1(-c) - c * np.exp(-c))
        c = np.maximum(c - (tail - u) / (c * np.exp(-c)), c / 4)
    return c


# Draws by table.  r and beta take 16 bits of a hash each.  c takes 31: its table goes by the upper half of the bits
# of the float u, 128 steps for each halving of u, since the least c of a long text lies far out in the tail.
_STEPS = (np.arange(1 << 16) + 0.5) / (1 << 16)
_R, _BETA = _gamma_quantiles(_STEPS).astype(np.float32), _STEPS.astype(np.float32)
_INVERSE_R = 1 / _R
_U = ((np.arange(0x3F80, dtype=np.uint32) << np.uint32(16)) + np.uint32(1 << 15)).view(np.float32).astype(np.float64)
_LOG_C = np.log(_gamma_quantiles(np.maximum(_U, 2.0 ** -33))).astype(np.float32)


def band_keys(bag: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The keys of a bag, ``BANDS`` by improved consistent weighted sampling, then ``BANDS`` by least hashes of its set.

    One 64-bit hash of a shingle for each sample gives the draws of both.
    """
    names, log_w = bag[0], np.log(bag[1])
    samples = BANDS * ROWS
    chosen, level = np.empty(samples, dtype=np.uint64), np.empty(samples, dtype=np.int64)
    lowest = np.full(samples, np.inf, dtype=np.float32)
    least = np.full(samples, np.iinfo(np.uint64).max, dtype=np.uint64)
    at = np.arange(samples)
    for lo in range(0, len(names), 512):
        part = names[lo:lo + 512]
        x = _mixed(part[None, :] * _DRAW)
        np.minimum(least, x.min(1), out=least)
        lanes = x.view(np.uint16).reshape(samples, -1, 4)
        draw, beta = lanes[:, :, 0], _BETA.take(lanes[:, :, 1])
        t = np.floor(log_w[None, lo:lo + 512] * _INVERSE_R.take(draw) + beta)
        u = ((x >> np.uint64(33)).astype(np.int32).astype(np.float32) + np.float32(0.5)) * np.float32(2.0 ** -31)
        u = np.minimum(u, np.float32(1 - 2.0 ** -8))
        a = _LOG_C.take(u.view(np.uint32) >> np.uint32(16)) - _R.take(draw) * (t - beta + 1)
        best = a.argmin(1)
        low = a[at, best]
        better = low < lowest
        lowest[better] = low[better]
        chosen[better] = part[best[better]]
        level[better] = t[at, best][better].astype(np.int64)
    weighted = _mixed(chosen * _PLACE[0] + level.astype(np.uint64) * _PLACE[1]).reshape(BANDS, ROWS)
    return np.concatenate([_band_hashes(weighted, 0), _band_hashes(_mixed(least).reshape(BANDS, ROWS), BANDS)])


def _band_hashes(signature: np.ndarray, first: int) -> np.ndarray:
    """One key a row of samples; ``first`` is the number of the first band."""
    band = np.arange(first, first + BANDS, dtype=np.uint64)
    return _mixed(sum(signature[:, j] * _PLACE[j] for j in range(ROWS)) + band * _PLACE[4]).view(np.int64)


def bands(docs: DataFrame, idf: np.ndarray) -> DataFrame:
    """(node, keys, copies): each distinct text that has words, with the band keys of both families and its number of rows."""
    shared = docs.sparkSession.sparkContext.broadcast(idf)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [band_keys(weights(s, shared.value)) if len(s) else None for s in shingles(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(keys, pa.list_(pa.int64()))],
                                             ["node", "keys"])
        pa.default_memory_pool().release_unused()

    signed = (docs.select(text_key(F.col("text")).alias("node"), "text")
              .mapInArrow(sign, "node string, keys array<long>").where("keys is not null"))
    return signed.groupBy("node").agg(F.first("keys").alias("keys"), F.count("*").alias("copies"))


def texts_of(docs: DataFrame, asked: DataFrame, signed: DataFrame) -> DataFrame:
    """(node, text) of the ``asked`` nodes, each once.

    A text with more copies than one in ``HEAVY`` rows, so one of fewer than
    ``HEAVY``, leaves each task once; the others shuffle by their node.
    """
    # only texts with words are ever asked for
    rows = docs.where(F.col("text").rlike(r"[^\t-\r ]")).select(text_key(F.col("text")).alias("node"), "text")
    total = signed.agg(F.sum("copies")).first()[0] or 0
    common = F.broadcast(signed.where(F.col("copies") * HEAVY > total).select("node"))
    one = lambda df: df.groupBy("node").agg(F.first("text").alias("text"))
    hot = one(rows.join(common, "node", "left_semi"))
    rest = one(rows.join(common, "node", "left_anti").join(asked, "node", "left_semi"))
    return hot.join(asked, "node", "left_semi").unionByName(rest)


def verified(pairs: DataFrame, texts: DataFrame, idf: np.ndarray, similar: float) -> DataFrame:
    """The pairs (a, b) of text keys that are links; ``texts`` has (node, text), each node once."""
    shared = pairs.sparkSession.sparkContext.broadcast(idf)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: tuple = (None, None)  # the leader seen last: rows come sorted by it
        for batch in batches:
            ok, names = [], batch.column("b").to_pylist()
            left = (weights(s, shared.value) for s in shingles(batch.column("a_text")))
            fresh = [k for k, name in enumerate(names) if k == 0 or name != names[k - 1]]
            right = (weights(s, shared.value) for s in shingles(batch.column("b_text").take(pa.array(fresh, pa.int64()))))
            for k, bag in enumerate(left):
                if k == 0 or names[k] != names[k - 1]:
                    known = (names[k], next(right))
                ok.append(max(similarity(bag, known[1])) >= similar)
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))
        pa.default_memory_pool().release_unused()

    rows = (pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("a_text")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("b_text")), "b"))
    return rows.select("a", "b", "a_text", "b_text").mapInArrow(check, "a string, b string")


def tiles(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(tile, side, node, component, band): members of open buckets, in pairs of tiles that may hold a new link.

    A component with more than ``TILE`` members in a bucket is cut into tiles
    of its own; the smaller ones share tiles.  A tile of one component is not
    paired with itself or with another tile of the same component.
    """
    named = cut(members.join(labels, "node", "left")
                .select("band", "key", "node", F.coalesce("component", "node").alias("component")), "bucket-components")
    parts = named.groupBy("band", "key", "component").agg(F.count("*").alias("n"))
    open_ = parts.groupBy("band", "key").agg(
        F.count("*").alias("parts"), F.sum(F.when(F.col("n") <= TILE, F.col("n")).otherwise(0)).alias("few")).where("parts > 1")
    parts = cut(parts.join(open_.drop("parts"), ["band", "key"]), "open-buckets")
    large = F.col("n") > TILE
    number = F.when(large, F.ceil(F.col("n") / TILE)).otherwise(F.ceil(F.col("few") / TILE)).cast("int")
    group = F.when(large, F.col("component")).otherwise("")
    lots = parts.select("band", "key", group.alias("lot"), number.alias("number")).distinct().select(
        "band", "key", "lot", F.explode(F.sequence(F.lit(0), F.col("number") - 1)).alias("no"))
    a, b = (lots.select("band", "key", F.struct("lot", "no").alias(x)) for x in "ab")
    pairs = a.join(b, ["band", "key"]).where("a <= b").where("a.lot <> b.lot or a.lot = ''")
    tile = F.xxhash64("band", "key", "a.lot", "a.no", "b.lot", "b.no")
    sides = pairs.select("band", "key", F.struct("band", "key", "a", "b").alias("tile"), tile.alias("deal"), F.inline(F.when(
        F.col("a") == F.col("b"), F.array(F.struct(F.lit(0).alias("side"), F.col("a").alias("lot"))))
        .otherwise(F.array(F.struct(F.lit(0).alias("side"), F.col("a").alias("lot")),
                           F.struct(F.lit(1).alias("side"), F.col("b").alias("lot"))))))
    mine = named.join(parts.select("band", "key", "component", group.alias("lot"), number.alias("number")),
                      ["band", "key", "component"])
    by = F.when(F.col("lot") == "", F.xxhash64("component")).otherwise(F.xxhash64("node"))
    mine = mine.select("band", "key", "node", "component", F.struct("lot", F.pmod(by, F.col("number")).cast("int").alias("no")).alias("lot"))
    return sides.join(mine, ["band", "key", "lot"]).select(
        "deal", F.to_json("tile").alias("tile"), "side", "node", "component", "band")


def tile_links(rows: DataFrame, texts: DataFrame, signed: DataFrame, idf: np.ndarray, similar: float) -> DataFrame:
    """Links (a, b) between different components within each tile; a pair counts in the first band it shares."""
    shared = rows.sparkSession.sparkContext.broadcast(idf)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []     # the members of the tile that is being read: two sides of a tile at most
        for batch in batches:
            bags = (weights(x, shared.value) for x in shingles(batch.column("text")))
            cols = [batch.column(c).to_pylist() for c in ("tile", "side", "node", "component", "band", "keys")]
            found: list = []
            for *row, bag in zip(*cols, bags):
                if held and held[-1][0] != row[0]:
                    found += _links_of(held, similar)
                    held = []
                held.append((*row, bag))
            yield _pairs_batch(found)
        if held:
            yield _pairs_batch(_links_of(held, similar))
        pa.default_memory_pool().release_unused()

    full = rows.join(texts, "node").join(signed.select("node", "keys"), "node")
    return (full.repartition("deal").sortWithinPartitions("deal", "tile", "side")
            .select("tile", "side", "node", "component", "band", "text", "keys")
            .mapInArrow(compare, "a string, b string"))


def _pairs_batch(found: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.string()),
                                       pa.array([y for _, y in found], pa.string())], ["a", "b"])


def _links_of(rows: list, similar: float) -> list[tuple[str, str]]:
    """Links that join the components of the rows (tile, side, node, component, band, keys, bag) of one tile."""
    side = np.array([r[1] for r in rows])
    part = np.unique([r[3] for r in rows], return_inverse=True)[1]
    keys, band = np.array([r[5] for r in rows], dtype=np.int64), rows[0][4]
    mass = np.array([[r[6][1].sum(dtype=np.float64), len(r[6][0])] for r in rows])
    two = side.any()
    out = []
    for i in np.flatnonzero(side == 0):
        rest = side == 1 if two else np.arange(len(rows)) > i
        # sizes too different, or already compared in an earlier band
        ratio = np.minimum(mass, mass[i]) / np.maximum(mass, mass[i])
        rest &= (part != part[i]) & (ratio.max(1) >= similar) & ~(keys[:, :band] == keys[i, :band]).any(1)
        for j in np.flatnonzero(rest):
            # what a link has joined needs no other link
            if part[j] != part[i] and max(similarity(rows[i][6], rows[j][6])) >= similar:
                out.append((rows[i][2], rows[j][2]))
                part[part == part[j]] = part[i]
    return out


def classes(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """(node, component) of the texts that have a link to another text."""
    idf = idf_table(docs)
    signed = cut(bands(docs, idf), "signatures")
    members = signed.select("node", F.posexplode("keys").alias("band", "key"))
    first = (members.groupBy("band", "key").agg(F.min("node").alias("leader"), F.max("node").alias("last"))
             .where("leader < last").select("band", "key", "leader"))
    members = cut(members.join(first, ["band", "key"]), "bucket-members")
    # only texts that share a key with another one are ever read again
    asked = members.select("node").distinct()
    texts = cut(texts_of(docs, asked, signed), "bucket-texts")
    # each text with its first leader: most of a class hangs together after this one comparison a text
    led = members.where("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b"))
    asked_first = cut(led.groupBy("a").agg(F.min("b").alias("b")), "first-pairs")
    labels = roots(cut(verified(asked_first, texts, idf, similar), "first-links"))
    # the other leaders, only where the components still differ
    more = between(led.distinct().join(asked_first, ["a", "b"], "left_anti"), labels).select("a", "b")
    labels = joined_labels(labels, cut(verified(cut(more, "more-pairs"), texts, idf, similar), "more-links"))
    # and all other members that share a key
    open_ = tiles(members.drop("leader"), labels)
    return joined_labels(labels, cut(tile_links(open_, texts, signed, idf, similar), "tile-links"))


def roots(parents: DataFrame) -> DataFrame:
    """(node, component) of a forest of links (a, b) with one parent b < a a node, by pointer jumping."""
    tops = parents.select(F.col("b").alias("node")).distinct().join(
        parents.select(F.col("a").alias("node")), "node", "left_anti")
    labels = cut(parents.select(F.col("a").alias("node"), F.col("b").alias("component"))
                 .union(tops.select("node", F.col("node").alias("component"))), "labels")
    while True:
        up = labels.select(F.col("node").alias("component"), F.col("component").alias("above"))
        fresh = cut(labels.join(up, "component").select("node", "component", "above"), "labels")
        labels = fresh.select("node", F.col("above").alias("component"))
        if fresh.where("above <> component").isEmpty():
            return labels


def between(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components, with these as a_part and b_part."""
    for x in "ab":
        part = labels.select(F.col("node").alias(x), F.col("component").alias(f"{x}_part"))
        pairs = pairs.join(part, x, "left").withColumn(f"{x}_part", F.coalesce(f"{x}_part", x))
    return pairs.where("a_part <> b_part")


def joined_labels(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after the links (a, b): only components are joined, not their members."""
    edges = between(links, labels).select(F.col("a_part").alias("a"), F.col("b_part").alias("b"))
    merged = connected_components(edges).select(F.col("node").alias("component"), F.col("component").alias("to"))
    known = labels.join(merged, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    single = (merged.join(labels.select("component").distinct(), "component", "left_anti")
              .select(F.col("component").alias("node"), F.col("to").alias("component")))
    return cut(known.union(single), "labels")


def near_duplicates(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """(doc_id, class_id, class_size): a row per document; class_size counts documents."""
    rows, texts = by_text(docs, similar)
    sizes = class_sizes(texts)
    named = join_known(texts.select("node", "component", "copies"), sizes, ["component"], "texts", texts.count())
    out = join_known(rows, named.select("node", "copies", "class_size", F.col("first.doc_id").alias("class_id")), ["node"],
                     "copies", rows.count())
    return out.select("doc_id", "class_id", "class_size")


def by_text(docs: DataFrame, similar: float) -> tuple[DataFrame, DataFrame]:
    """Written (doc_id, node) of every row, and (node, component, copies, first) of every distinct text."""
    labels = classes(docs, similar)
    rows = cut(docs.select("doc_id", text_key(F.col("text")).alias("node")), "class-members")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "node"))
    texts = rows.groupBy("node").agg(F.count("*").alias("copies"), first.alias("first"))
    return rows, cut(texts.join(labels, "node", "left").select(
        "node", F.coalesce("component", "node").alias("component"), "copies", "first"), "class-texts")


def class_sizes(texts: DataFrame) -> DataFrame:
    """(component, texts, class_size, first): first is the struct (unknown, doc_id, node) of the class's first document."""
    return texts.groupBy("component").agg(F.count("*").alias("texts"), F.sum("copies").alias("class_size"), F.min("first").alias("first"))


def keep_one(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """The rows of ``docs`` that are the first document of their class; repeated rows count once."""
    names = docs.columns
    _, texts = by_text(docs, similar)
    firsts = class_sizes(texts).select(F.col("first.doc_id").alias("f_id"), F.col("first.node").alias("f_node"))
    rows = docs.select(text_key(F.col("text")).alias("node"), F.col("doc_id").alias("r_id"), packed(docs).alias("row"))
    # by text and doc_id, so the copies of a text are spread and only the first one meets its class
    kept = rows.join(firsts, (F.col("node") == F.col("f_node")) & F.col("r_id").eqNullSafe(F.col("f_id")))
    return kept.dropDuplicates(["node"]).select(*[F.col(f"row.`{c}`").alias(c) for c in names])
