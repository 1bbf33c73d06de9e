"""Near-duplicate documents by b-bit MinHash.

A document's set holds the hashes of its distinct word shingles. Rows of equal sets are one node. Each node has 128
minima; bands of four give candidate pairs, and the two low bits of each minimum are packed into four longs.

Nodes that share a band bucket, directly or through others, form a cluster; a cluster only says which nodes travel
together. Buckets with one smallest node form a star, and where the stars of a cluster cost fewer comparisons than the
cluster (long chains of texts), its stars travel, not the whole. Small units of either kind are put many to a task, larger ones
are cut into blocks of nodes, a task for each pair of blocks, at every size alike. A first pass sees 32 bytes of low bits and the band keys of each node: pairs that share a band, and
whose similarity as estimated from the low bits (corrected for chance agreement) is not far below the threshold,
stay. A second pass gets the full sets of nodes that are in such a pair, confirms the pairs on them and returns a
spanning forest of the links it found, never all pairs. At the threshold a pair misses all 32 bands with a chance of
5e-8 and the low-bit filter with 1e-9.

Scale: only slim rows (ids and hashes) are grouped and joined; keys with very many rows (a text or a group of copies that is
a third of the table) get their facts by broadcast, of which there are at most `MOST_HOT`, so no task holds all rows of a
key. A cluster of n nodes costs n * n / 2 comparisons of 32 bytes, or what its stars cost if that is less: a chain in which each text
shares buckets with a bounded number of others costs a bounded number of comparisons a text.

Edge cases: every row is a document of its own, also where ids repeat or are null. A null or empty text, or one without
words, has an empty set and is linked with nothing; a text with fewer words than a shingle has its whole word sequence as
one; a very long text is one set as well. Of a group the row of the smallest id stays (null ids last; among equal ids the
first row read), whatever its text; a group without ids has a null component_id. An empty table gives no rows; extra
columns play no part and may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import _text as X
from ._links import components
from ._store import attach, keep

HASHES, ROWS, BITS = 128, 4, 2
BANDS = HASHES // ROWS
#: Standard deviations of the low-bit estimate below the threshold at which a pair is refused.
SLACK = 6.5
#: Nodes of a block, and of small units put together in one task.
BLOCK_NODES, PACK_NODES = 1024, 256
#: Candidate pairs in a task above which intersections are counted by matrix products.
DENSE_PAIRS, DENSE_COLUMNS = 2000, 4096
#: Row keys that may be broadcast (16 bytes each).
BROADCAST_KEYS = 500_000
#: Pairs whose band keys are compared at a time.
PAIRS_AT_A_TIME = 1 << 15

_rng = np.random.default_rng(20240229)
_A = (_rng.integers(0, 1 << 31, HASHES, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_B = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)


def shingle_sets(texts: pa.Array, words_each: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each pass over the batch: its first document, all sets' sorted hashes, and where each set starts."""
    raw_all, at_all = X.as_bytes(texts)
    for i, j in X.passes(at_all):
        raw, at = X.lower(raw_all[at_all[i] : at_all[j]]), at_all[i : j + 1] - at_all[i]
        start, end, edge = X.word_spans(raw, at)
        words = X.span_hashes(raw, start, end)
        runs = X.rolling(words, words_each)
        sets, sizes = [], []
        for d in range(j - i):
            a, b = edge[d], edge[d + 1]
            if b - a >= words_each:
                s = np.unique(runs[a : b - words_each + 1])
            elif b > a:
                s = X.rolling(words[a:b], int(b - a)) ^ np.uint64(b - a)
            else:
                s = np.zeros(0, np.uint64)
            sets.append(s)
            sizes.append(len(s))
        yield i, np.concatenate(sets), np.concatenate([[0], np.cumsum(sizes)])


def minima(hashes: np.ndarray) -> np.ndarray:
    """The least value of each of the hash functions over the set."""
    x = (hashes >> np.uint64(32)).astype(np.uint32) ^ hashes.astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(x), 2048):
        v = x[k : k + 2048][None, :] * _A[:, None]
        v += _B[:, None]
        v ^= v >> np.uint32(16)
        v *= np.uint32(0x7FEB352D)
        np.minimum(least, v.min(axis=1), out=least)
    return least


def pack_low_bits(least: np.ndarray) -> np.ndarray:
    """Two low bits of each minimum, 32 of them in a long; rows are documents."""
    low = (least & np.uint32((1 << BITS) - 1)).astype(np.uint64).reshape(len(least), -1, 64 // BITS)
    return (low << (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS))).sum(axis=2, dtype=np.uint64)


def band_keys(least: np.ndarray) -> np.ndarray:
    m = least.astype(np.uint64).reshape(len(least), BANDS, ROWS)
    h = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), m.shape[:2]).copy()
    for r in range(ROWS):
        h = X.mix(h * np.uint64(0x9E3779B97F4A7C15) + m[:, :, r])
    return h


_WORDS = [f"s{k}" for k in range(HASHES * BITS // 64)]
_ROW_KEY = ("key_1", "key_2")


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, text and two hashes of both together, by which a row is found again."""
    key = [F.col(id_col).cast("long"), F.col(text_col)]
    return docs.select(key[0].alias("id"), key[1].alias("text"), F.xxhash64(F.lit(1), *key).alias("key_1"), F.xxhash64(F.lit(2), *key).alias("key_2"))


def _set_hashes(hashes: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit hashes of each set."""
    out = []
    for v in (X.mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)), X.mix(hashes + np.uint64(0x5851F42D4C957F2D))):
        run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(v, dtype=np.uint64)])
        out.append((run[at[1:]] - run[at[:-1]]).view(np.int64))
    return out


def signatures(rows: DataFrame, words_each: int) -> DataFrame:
    """From `keyed` rows: id, the row's keys, n_shingles, a 128-bit hash of the set, its packed low bits and its band keys."""
    carried = ["id", *_ROW_KEY]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, hashes, at in shingle_sets(X.column(b, "text"), words_each):
                n = len(at) - 1
                least = np.stack([minima(hashes[at[d] : at[d + 1]]) for d in range(n)])
                hi, lo = _set_hashes(hashes, at)
                bits, keys = pack_low_bits(least), band_keys(least)
                listed = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * BANDS, pa.int32()), pa.array(keys.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays([*(X.column(b, c).slice(i, n) for c in carried), pa.array(np.diff(at), pa.int64()), pa.array(hi), pa.array(lo), *(pa.array(np.ascontiguousarray(bits[:, k]).view(np.int64)) for k in range(bits.shape[1])), listed], [*carried, "n_shingles", "set_hi", "set_lo", *_WORDS, "bands"])
        X.give_back()

    schema = "id long, key_1 long, key_2 long, n_shingles long, set_hi long, set_lo long, " + ", ".join(f"{w} long" for w in _WORDS) + ", bands array<long>"
    return rows.mapInArrow(run, schema)


def _sets(rows: DataFrame, words_each: int) -> DataFrame:
    """From `keyed` rows: the row's keys, the hash of its set and the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, hashes, at in shingle_sets(X.column(b, "text"), words_each):
                yield pa.RecordBatch.from_arrays([*(X.column(b, c).slice(i, len(at) - 1) for c in _ROW_KEY), *map(pa.array, _set_hashes(hashes, at)), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(hashes.view(np.int64)))], [*_ROW_KEY, "set_hi", "set_lo", "members"])
        X.give_back()

    return rows.mapInArrow(run, "key_1 long, key_2 long, set_hi long, set_lo long, members array<long>")


def estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of every row of packed low bits in a with every one in b, corrected for chance agreement."""
    mask = np.uint64(0x5555555555555555)
    equal = np.zeros((len(a), len(b)), np.int32)
    for k in range(a.shape[1]):
        x = a[:, k][:, None] ^ b[:, k][None, :]
        x |= x >> np.uint64(1)
        equal += np.bitwise_count(~x & mask)
    chance = 0.5**BITS
    return (equal / HASHES - chance) / (1 - chance)


def least_estimate(percent: int) -> float:
    j, chance = percent / 100, 0.5**BITS
    agree = chance + (1 - chance) * j
    return j - SLACK * (agree * (1 - agree) / HASHES) ** 0.5 / (1 - chance)


def common_members(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets x[k] and y[k]."""
    if len(x) <= DENSE_PAIRS:
        return np.array([len(np.intersect1d(sets[p], sets[q], assume_unique=True)) for p, q in zip(x, y, strict=True)], np.int64)
    size = np.array([len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), size)
    shared = np.flatnonzero(times > 1)
    place = np.full(len(times), -1)
    place[shared] = np.arange(len(shared))
    column = place[column]
    row, column = row[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    p, q = np.unique(x), np.unique(y)
    counts = np.zeros((len(p), len(q)), np.float32)
    for k in range(0, len(shared), DENSE_COLUMNS):
        i, j = np.searchsorted(column, [k, k + DENSE_COLUMNS])
        dense = np.zeros((len(sets), DENSE_COLUMNS), np.float32)
        dense[row[i:j], column[i:j] - k] = 1
        counts += dense[p] @ dense[q].T
    return counts[np.searchsorted(p, x), np.searchsorted(q, y)].astype(np.int64)


def spanning_forest(n: int, x: np.ndarray, y: np.ndarray) -> list[tuple[int, int]]:
    """Links that join the same of n nodes together as the links (x, y) do."""
    root = list(range(n))
    out = []
    for p, q in zip(x.tolist(), y.tolist(), strict=True):
        a, b = p, q
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        while root[b] != b:
            root[b] = root[root[b]]
            b = root[b]
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((p, q))
    return out


def _pairs(t: pa.Table, percent: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Candidate pairs of a task's rows: they share a band, and neither low bits nor sizes rule them out."""
    node, n = X.column(t, "node").to_numpy(), X.column(t, "n_shingles").to_numpy()
    left, right = (X.column(t, c).to_numpy(zero_copy_only=False) for c in ("left", "right"))
    bits = np.stack([X.column(t, w).to_numpy().view(np.uint64) for w in _WORDS], 1)
    bands = X.column(t, "bands").flatten().to_numpy().reshape(-1, BANDS)
    i, j = np.flatnonzero(left), np.flatnonzero(right)
    ok = estimates(bits[i], bits[j]) >= least
    ok &= 100 * np.minimum(n[i][:, None], n[j][None, :]) >= percent * np.maximum(n[i][:, None], n[j][None, :])
    if (left & right).any():  # a block with itself
        ok &= node[i][:, None] < node[j][None, :]
    p, q = np.nonzero(ok)
    x, y = i[p], j[q]
    near = [(bands[x[k : k + PAIRS_AT_A_TIME]] == bands[y[k : k + PAIRS_AT_A_TIME]]).any(axis=1) for k in range(0, len(x), PAIRS_AT_A_TIME)]
    near = np.concatenate([np.zeros(0, bool), *near])
    return x[near], y[near]


def _screen(percent: int):
    """First pass: the rows of a task that are in a candidate pair."""
    least = least_estimate(percent)

    def run(t: pa.Table) -> pa.Table:
        used = np.zeros(len(t), bool)
        for side in _pairs(t, percent, least):
            used[side] = True
        return t.select(_PLACE).filter(pa.array(used))

    return run


def _confirm(percent: int):
    """Second pass: a spanning forest of the candidate pairs that the full sets confirm."""
    least = least_estimate(percent)

    def run(t: pa.Table) -> pa.Table:
        node, n = X.column(t, "node").to_numpy(), X.column(t, "n_shingles").to_numpy()
        listed = X.column(t, "members")
        edge, flat = np.asarray(listed.offsets), listed.values.to_numpy()
        sets = [flat[edge[k] : edge[k + 1]] for k in range(len(t))]
        x, y = _pairs(t, percent, least)
        common = common_members(sets, x, y)
        link = 100 * common >= percent * (n[x] + n[y] - common)
        found = spanning_forest(len(t), x[link], y[link])
        X.give_back()
        return pa.Table.from_arrays([pa.array([node[a] for a, _ in found], pa.int64()), pa.array([node[b] for _, b in found], pa.int64())], names=["a", "b"])

    return run


_PLACE = ["task", "i", "j", "node", "left", "right"]


def _units(shared: DataFrame) -> DataFrame:
    """Which nodes are compared with each other: node, unit, n (nodes of the unit).

    The nodes that meet one smallest node in some bucket are a star, so nodes of a common bucket are in one star at least. A cluster is
    one unit, or each of its stars is one where those together cost fewer comparisons than the cluster."""
    cluster = components(shared.select(F.col("low").alias("a"), F.col("node").alias("b")).where("a < b"))
    stars = keep(shared.groupBy("low").agg(F.count(F.lit(1)).alias("n")))
    square = F.col("n").cast("double") * F.col("n")
    in_stars = F.sum(F.col("n").cast("double") * F.greatest("n", F.lit(2 * PACK_NODES)))  # small ones meet those they are put together with
    apart = stars.join(cluster.withColumnRenamed("node", "low"), "low").groupBy("comp").agg(in_stars.alias("in_stars"))
    sizes = cluster.groupBy("comp").agg(F.count(F.lit(1)).alias("n")).join(apart, "comp")
    sizes = keep(sizes.select("comp", "n", ((F.col("n") > PACK_NODES) & (F.col("in_stars") < square)).alias("apart")))
    cluster = keep(attach(cluster, sizes, ["comp"], "n"))
    whole = cluster.where("not apart").select("node", F.col("comp").alias("unit"), "n")
    split = attach(shared.join(cluster.where("apart").select("node"), "node"), stars, ["low"], "n")
    return keep(whole.unionByName(split.select("node", F.col("low").alias("unit"), "n")))


def _places(shared: DataFrame) -> DataFrame:
    """Which nodes are compared in which task. shared: node, low (the smallest node of a bucket that the node is in)."""
    units = _units(shared)
    small = F.col("n") <= PACK_NODES
    packs = units.where(small).count() // (2 * PACK_NODES) + 1
    every = units.select("node", F.when(small, -1 - F.pmod(F.xxhash64("unit"), F.lit(packs))).otherwise(F.col("unit")).alias("task"), F.when(small, 1).otherwise(F.ceil(F.col("n") / BLOCK_NODES)).cast("int").alias("blocks")).distinct()
    every = every.withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    every = every.select("node", "task", "mine", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    return every.select("task", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "node", (F.col("mine") <= F.col("other")).alias("left"), (F.col("mine") >= F.col("other")).alias("right"))


def _groups(docs: DataFrame, words_each: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """One row a row of docs: row, id, its keys, n_shingles, component_id and kept."""
    source = keyed(docs, id_col, text_col)
    rows = keep(signatures(source, words_each).withColumn("row", F.monotonically_increasing_id()))
    full = rows.where("n_shingles > 0")
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "row"))  # the smallest id, null ones last
    sets = keep(full.groupBy("set_hi", "set_lo").agg(F.min("row").alias("node"), first.alias("low"), F.count(F.lit(1)).alias("n")))
    nodes = keep(full.join(sets.select(F.col("node").alias("row")), "row", "left_semi").withColumnRenamed("row", "node").drop("id"))
    entries = nodes.select("node", F.explode("bands").alias("key"))
    hubs = keep(entries.groupBy("key").agg(F.min("node").alias("low"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    shared = keep(attach(entries, hubs, ["key"], "n").select("node", "low").distinct())

    places = keep(_places(shared))
    facts = nodes.select("node", "n_shingles", *_ROW_KEY, "set_hi", "set_lo", *_WORDS, "bands")
    facts = keep(facts.join(shared.select("node").distinct(), "node"))
    slim = places.join(facts.select("node", "n_shingles", *_WORDS, "bands"), "node")
    pairs = keep(slim.groupBy("task", "i", "j").applyInArrow(_screen(percent), places.select(_PLACE).schema))

    asked = keep(facts.join(pairs.select("node").distinct(), "node"))
    small = F.broadcast if asked.count() <= BROADCAST_KEYS else (lambda x: x)
    texts = source.join(small(asked.select(*_ROW_KEY)), list(_ROW_KEY), "left_semi")
    members = _sets(texts, words_each).join(asked, [*_ROW_KEY, "set_hi", "set_lo"]).drop(*_ROW_KEY, "set_hi", "set_lo").dropDuplicates(["node"])
    links = pairs.join(members, "node").groupBy("task", "i", "j").applyInArrow(_confirm(percent), "a long, b long")
    comp = components(links)

    sets = keep(sets.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node")))
    heads = keep(sets.groupBy("comp").agg(F.min("low").alias("head"), F.count(F.lit(1)).alias("held")))
    sets = attach(sets.select("comp", "set_hi", "set_lo", "n"), heads, ["comp"], "held").select("set_hi", "set_lo", "n", "head")
    slim = full.select("row", "id", *_ROW_KEY, "n_shingles", "set_hi", "set_lo")
    found = attach(slim, keep(sets), ["set_hi", "set_lo"], "n").select("row", "id", *_ROW_KEY, "n_shingles", F.col("head.id").alias("component_id"), (F.col("row") == F.col("head.row")).alias("kept"))
    return found.unionByName(rows.where("n_shingles = 0").select("row", "id", *_ROW_KEY, "n_shingles", F.col("id").alias("component_id"), F.lit(True).alias("kept")))


def near_duplicates(docs: DataFrame, words_each: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles, component_id (smallest id reachable) and kept (the row that stays of its group) for each row of docs."""
    return _groups(docs, words_each, percent, id_col, text_col).select(F.col("id").alias(id_col), "n_shingles", "component_id", "kept")


def keep_first(docs: DataFrame, words_each: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, that `near_duplicates` marks as kept. Of rows equal in id and text any one stands for the kept one."""
    found = _groups(docs, words_each, percent, id_col, text_col).where("n_shingles > 0")
    keys = keep(found.groupBy(*_ROW_KEY).agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")).where("not kept or n > 1"))
    names = {"key_1": "_near_key_1", "key_2": "_near_key_2"}
    key = [F.col(id_col).cast("long"), F.col(text_col)]
    left = docs.withColumns({names["key_1"]: F.xxhash64(F.lit(1), *key), names["key_2"]: F.xxhash64(F.lit(2), *key)})
    keys = keys.withColumnsRenamed(names)
    on = list(names.values())
    small = F.broadcast if keys.count() <= BROADCAST_KEYS else (lambda x: x)
    out = left.join(small(keys.select(*on)), on, "left_anti")
    twice = keys.where("kept").select(*on)
    if not twice.isEmpty():
        out = out.unionByName(left.join(small(twice), on, "left_semi").dropDuplicates(on))
    return out.drop(*on)
