"""Removing passages that repeat across documents, by suffix sorting.

A byte is removed if it lies in a string of `length` bytes that also starts in a document of smaller id; matches never
cross documents. Copies of a whole text are found by hash first and only the smallest id of each text goes on.

Every string of `length` bytes has an anchor: the least hash of its `GRAM`-byte grams. Equal strings have equal
anchors, so neighbouring strings of one anchor travel together, as one segment, to the bucket of that anchor.
  1. Blocks of documents send the hashes of their anchors (4 bytes each, once a block) to buckets; a bucket answers
     which of them occur in two documents. Other text is never sent.
  2. Blocks send the segments of those anchors. An anchor with very many documents is split: its strings go, one by
     one and once a block, to buckets of their own hash; in a block all but the smallest id are settled on the spot.
  3. A bucket concatenates its distinct segments and sorts their suffixes in two stages: suffixes smaller than their
     successors are sorted directly, the others are induced by scans of the buckets of first bytes. The lengths of the common
     prefixes of neighbours mark equal strings; each gets its smallest document, and larger ids lose the bytes.
     Segments of equal hashes are put together only where their bytes are equal.
  4. Blocks join the spans of each document.

Scale: texts are shuffled once (all passes over blocks reuse that exchange); blocks and buckets have a bounded mean
size, their number grows with the bytes. No list of documents or matches reaches the driver.

Edge cases: null and empty texts have no bytes; a null id counts as larger than all others; equal ids never remove from
each other; repeated rows are treated alike; a very long text is looked at in pieces that overlap by a string's length and sits in
one block; an empty table gives no rows; extra columns play no part, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import _text as X

LENGTH = 50
GRAM = 20
#: Mean bytes of text in a block, and of the text whose anchors a bucket gets. A task takes some hundred bytes of memory
#: for each of them.
BLOCK_BYTES = 2 << 20
#: Documents of an anchor above which its strings are dealt one by one.
HOT_DOCS = 2000
LAST_ID = (1 << 63) - 1


# Suffix sorting --------------------------------------------------------------------------------------------------


def words_at(text: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on as a big-endian number; zeros follow the end."""
    w = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    for k in (1, 2, 4):
        w = (w[:-k] << np.uint64(8 * k)) | w[k:]
    return np.concatenate([w[: len(text)], np.zeros(64, np.uint64)])


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor; inside a run of one byte the run's end decides."""
    n = len(text)
    step = np.zeros(n, np.int16)
    step[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1])
    step[-1] = -1
    at = np.flatnonzero(step)
    nxt = at[np.searchsorted(at, np.arange(n))]
    # a run longer than the sort depth is sorted directly, else inducing would take a round for each byte of it
    return (step[nxt] > 0) | (nxt - np.arange(n) >= LENGTH)


def sort_directly(at: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first `depth` bytes; each further word is read only where the ones before are equal."""
    at = at[np.argsort(words[at], kind="stable")]
    key = words[at]
    new = np.ones(len(at), bool)
    new[1:] = key[1:] != key[:-1]
    for k in range(8, depth, 8):
        group = np.cumsum(new)
        tied = ~new
        tied[:-1] |= ~new[1:]
        t = np.flatnonzero(tied)
        if not len(t):
            break
        key = words[at[t] + k]
        order = np.lexsort((key, group[t]))
        at[t] = at[t][order]
        key, g = key[order], group[t]
        new[t[1:]] |= (g[1:] == g[:-1]) & (key[1:] != key[:-1])
    return at


def suffix_order(text: np.ndarray, depth: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """All suffixes of the bytes in the order of at least their first `depth` bytes, by two-stage sorting; and `words_at`."""
    n = len(text)
    words = words_at(text)
    if not n:
        return np.zeros(0, np.int64), words
    direct = smaller_than_next(text)
    first = sort_directly(np.flatnonzero(direct), words, depth)
    edge = np.searchsorted(text[first], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[text[-1]].append(np.array([n - 1]))
    out = []
    for c in range(256):
        induced = []
        new = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        waiting[c] = []
        while len(new):
            induced.append(new)
            before = new[new > 0] - 1
            new = before[(text[before] == c) & ~direct[before]]
        own = [*induced, first[edge[c] : edge[c + 1]]]
        own = np.concatenate(own)
        if not len(own):
            continue
        out.append(own)
        before = own[own > 0] - 1
        before = before[~direct[before] & (text[before] > c)]
        heads = text[before]
        before = before[np.argsort(heads, kind="stable")]
        cut = np.cumsum(np.bincount(heads, minlength=256))
        for h in np.unique(heads):
            waiting[h].append(before[cut[h - 1] if h else 0 : cut[h]])
    return np.concatenate(out), words


def common_prefixes(order: np.ndarray, words: np.ndarray, most: int = LENGTH) -> np.ndarray:
    """Bytes that each suffix in order has in common with the one before, `most` at most; 0 for the first."""
    out = np.zeros(len(order), np.int64)
    open_ = np.arange(1, len(order))
    for k in range(0, most, 8):
        differ = words[order[open_] + k] ^ words[order[open_ - 1] + k]
        out[open_] = k + sum((differ >> np.uint64(64 - 8 * b) == 0).astype(np.int64) for b in range(1, 9))
        open_ = open_[differ == 0]
    return np.minimum(out, most)


# Anchors ---------------------------------------------------------------------------------------------------------


def _sliding_min(g: np.ndarray, width: int) -> np.ndarray:
    m, k = g, 1
    while 2 * k <= width:
        m = np.minimum(m[:-k], m[k:])
        k *= 2
    return np.minimum(m[: len(g) - width + 1], m[width - k :]) if width > k else m


def anchor_runs(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of neighbouring strings with one anchor: document, first start in it, last start, anchor."""
    out: list[tuple[np.ndarray, ...]] = []
    for i, j in X.passes(at):
        if j == i + 1:  # one document, perhaps long
            whole = int(at[j] - at[i])
            for a in range(0, max(whole - LENGTH + 1, 0), X.CHUNK_BYTES):
                z = min(a + X.CHUNK_BYTES + LENGTH - 1, whole)
                d, first, last, v = _runs(raw[at[i] + a : at[i] + z], np.array([0, z - a]))
                out.append((d + i, first + a, last + a, v))
        else:
            d, first, last, v = _runs(raw[at[i] : at[j]], at[i : j + 1] - at[i])
            out.append((d + i, first, last, v))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)


def _runs(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    n = len(raw) - LENGTH + 1
    if n < 1:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    up, down = X.powers(len(raw) + 1)
    run = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=run[1:])
    g = X.mix((run[GRAM:] - run[:-GRAM]) * down[: len(raw) - GRAM + 1])
    v = _sliding_min(g, LENGTH - GRAM + 1)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    ok = doc[:n] == doc[LENGTH - 1 :]
    new = ok.copy()
    new[1:] &= (v[1:] != v[:-1]) | ~ok[:-1] | (doc[1:n] != doc[: n - 1])
    end = ok.copy()
    end[:-1] &= (v[1:] != v[:-1]) | ~ok[1:] | (doc[1:n] != doc[: n - 1])
    first, last = np.flatnonzero(new), np.flatnonzero(end)
    return doc[first], first - at[doc[first]], last - at[doc[first]], v[first]


class _Block:
    """The texts of a block in a fixed order; only those that are the smallest id of their text are looked at."""

    def __init__(self, texts: pa.Table, firsts: pa.Table):
        ids = X.column(texts, "id").to_numpy(zero_copy_only=False)
        digest = X.column(texts, "digest").to_numpy(zero_copy_only=False)
        order = np.lexsort((digest, ids))
        self.table = texts.take(pa.array(order))
        self.ids, self.digest = ids[order], digest[order]
        self.raw, self.at = X.as_bytes(X.column(self.table, "text"))
        pairs = np.concatenate([np.stack([self.ids, self.digest], 1), np.stack([X.column(firsts, c).to_numpy(zero_copy_only=False).astype(np.int64) for c in "ab"], 1)])
        _, number = np.unique(pairs, axis=0, return_inverse=True)
        number = number.ravel()
        self.first = np.isin(number[: len(self.ids)], number[len(self.ids) :])

    def runs(self) -> tuple[np.ndarray, ...]:
        keep = np.flatnonzero(self.first)
        size = np.diff(self.at)[keep]
        at = np.concatenate([[0], np.cumsum(size)])
        if len(keep) == len(self.first):
            raw = self.raw
        else:
            raw = np.concatenate([self.raw[self.at[k] : self.at[k + 1]] for k in keep]) if len(keep) else self.raw[:0]
        d, first, last, v = anchor_runs(raw, at)
        return keep[d] if len(keep) else d, first, last, v


def _split(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each key, the order that sorts by bucket, and where each bucket that occurs begins."""
    bucket = (keys % np.uint64(parts)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    b = bucket[order]
    begin = np.flatnonzero(np.r_[True, b[1:] != b[:-1]]) if len(b) else np.zeros(0, np.int64)
    return b, order, begin


def _blobs(values: np.ndarray, begin: np.ndarray) -> list[bytes]:
    return [x.tobytes() for x in np.split(values, begin[1:])] if len(begin) else []


def _ragged(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... for each run of the given size, one after another."""
    starts = np.cumsum(size) - size
    return np.repeat(begin - starts, size) + np.arange(int(size.sum()))


_EXTRA = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("x", pa.binary()), ("y", pa.binary()), ("z", pa.binary())])
_EXTRA_DDL = "block long, kind int, a long, b long, x binary, y binary, z binary"
_FIRST, _ANSWER, _SPANS = 0, 1, 2


def _extra(kind: int, block: list, a: list, x: list[bytes], y: list[bytes], z: list[bytes]) -> pa.Table:
    n = len(block)
    return pa.Table.from_arrays([pa.array(block, pa.int64()), pa.array([kind] * n, pa.int32()), pa.array(a, pa.int64()), pa.nulls(n, pa.int64()), pa.array(x, pa.binary()), pa.array(y, pa.binary()), pa.array(z, pa.binary())], schema=_EXTRA)


def _of(extra: pa.Table, kind: int) -> pa.Table:
    import pyarrow.compute as pc

    return extra.filter(pc.equal(extra.column("kind"), kind))


# The passes ------------------------------------------------------------------------------------------------------


def _ask(parts: int):
    """Pass 1, blocks: anchors, once each, with the number of documents (255 at most)."""

    def run(texts: pa.Table, extra: pa.Table) -> pa.Table:
        if not len(texts):
            return pa.Table.from_arrays([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.binary()), pa.array([], pa.binary())], names=["bucket", "block", "high", "docs"])
        block = texts.column("block")[0].as_py()
        d, _, _, v = _Block(texts, _of(extra, _FIRST)).runs()
        v, n = _distinct(v, d)
        bucket, order, begin = _split(v, parts)
        return pa.Table.from_arrays([pa.array(bucket[begin]), pa.array([block] * len(begin), pa.int64()), pa.array(_blobs((v[order] >> np.uint64(32)).astype("<u4"), begin), pa.binary()), pa.array(_blobs(np.minimum(n[order], 255).astype(np.uint8), begin), pa.binary())], names=["bucket", "block", "high", "docs"])

    return run


def _distinct(v: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct anchors and the number of documents of each."""
    if not len(v):
        return v, np.zeros(0, np.int64)
    order = np.argsort(v, kind="stable")  # documents stay in order
    v, d = v[order], d[order]
    new = np.r_[True, v[1:] != v[:-1]]
    docs = np.cumsum(np.r_[True, (v[1:] != v[:-1]) | (d[1:] != d[:-1])])
    at = np.flatnonzero(new)
    return v[at], np.diff(np.r_[docs[at], docs[-1] + 1])


def _answer(asked: pa.Table) -> pa.Table:
    """Pass 1, buckets: which anchors of a block occur in two documents, and which of them in very many."""
    high = [np.frombuffer(x, "<u4") for x in asked.column("high").to_pylist()]
    docs = np.concatenate([np.frombuffer(x, np.uint8) for x in asked.column("docs").to_pylist()]).astype(np.int64)
    blocks = asked.column("block").to_pylist()
    size = np.array([len(x) for x in high])
    owner = np.repeat(np.arange(len(high)), size)
    values, which = np.unique(np.concatenate(high), return_inverse=True)
    total = np.bincount(which, docs, len(values))
    keep = total[which] >= 2
    owner, which = owner[keep], which[keep]
    begin = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, np.int64)
    bucket = asked.column("bucket")[0].as_py()
    return _extra(_ANSWER, [blocks[k] for k in owner[begin]], [bucket] * len(begin), _blobs(values[which].astype("<u4"), begin), _blobs((total[which] > HOT_DOCS).astype(np.uint8), begin), [b""] * len(begin))


_SEGMENTS_DDL = "bucket long, block long, ids binary, rows binary, starts binary, sizes binary, parts binary, data binary, settled binary"
_SEGMENTS = ["bucket", "block", "ids", "rows", "starts", "sizes", "parts", "data", "settled"]
#: Strings whose bytes are compared at a time.
_AT_A_TIME = 1 << 14
#: Parts of a bucket that are sorted one after another; equal strings are in one part.
_PARTS = 8


def _send(parts: int):
    """Pass 2, blocks: segments of shared anchors."""

    def run(texts: pa.Table, extra: pa.Table) -> pa.Table:
        answers = _of(extra, _ANSWER)
        none = pa.Table.from_arrays([pa.array([], pa.int64())] * 2 + [pa.array([], pa.binary())] * 7, names=_SEGMENTS)
        if not len(texts) or not len(answers):
            return none
        block = texts.column("block")[0].as_py()
        held = _Block(texts, _of(extra, _FIRST))
        d, first, last, v = held.runs()
        wanted = np.concatenate([(np.uint64(a) << np.uint64(32)) | np.frombuffer(x, "<u4").astype(np.uint64) for a, x in zip(answers.column("a").to_pylist(), answers.column("x").to_pylist(), strict=True)])
        hot = np.concatenate([np.frombuffer(y, np.uint8) for y in answers.column("y").to_pylist()])
        order = np.argsort(wanted)
        wanted, hot = wanted[order], hot[order]
        own = ((v % np.uint64(parts)) << np.uint64(32)) | (v >> np.uint64(32))
        at = np.minimum(np.searchsorted(wanted, own), len(wanted) - 1)
        shared = wanted[at] == own
        many = shared & (hot[at] > 0)
        shared &= ~many
        key, row, start, size = v[shared], d[shared], first[shared], (last - first)[shared] + LENGTH
        settled = b""
        if many.any():
            k2, r2, s2, settled = _one_by_one(held, d[many], first[many], last[many])
            key, row, start, size = np.concatenate([key, k2]), np.concatenate([row, r2]), np.concatenate([start, s2]), np.concatenate([size, np.full(len(k2), LENGTH)])
        bucket, order, begin = _split(key, parts)
        row, start, size = row[order], start[order], size[order]
        part = ((key[order] // np.uint64(parts)) % np.uint64(_PARTS)).astype(np.uint8)
        data = held.raw[_ragged(held.at[row] + start, size)]
        cut = np.r_[0, np.cumsum(size)]
        ends = np.r_[begin[1:], len(row)]
        cols = [_blobs(x, begin) for x in (held.ids[row].astype("<i8"), row.astype("<i4"), start.astype("<i8"), size.astype("<i8"), part)]
        datas = [data[cut[a] : cut[z]].tobytes() for a, z in zip(begin, ends, strict=True)]
        buckets = bucket[begin].tolist()
        if settled:
            buckets.append(block)
            for c in (*cols, datas):
                c.append(b"")
        n = len(buckets)
        return pa.Table.from_arrays([pa.array(buckets, pa.int64()), pa.array([block] * n, pa.int64()), *(pa.array(c, pa.binary()) for c in (*cols, datas)), pa.array([b""] * (n - bool(settled)) + [settled] * bool(settled), pa.binary())], names=_SEGMENTS)

    return run


def _one_by_one(held: _Block, d: np.ndarray, first: np.ndarray, last: np.ndarray):
    """Single strings of hot anchors: those of the smallest id in the block are sent, the rest of the block is settled."""
    n = last - first + 1
    row, start = np.repeat(d, n), _ragged(first, n)
    begin = held.at[row] + start
    key = X.span_hashes(held.raw, begin, begin + LENGTH)
    _, one, which = np.unique(key, return_index=True, return_inverse=True)
    least = np.full(len(one), LAST_ID, np.int64)
    np.minimum.at(least, which, held.ids[row])
    sent = held.ids[row] == least[which]
    for k in range(0, len(begin), _AT_A_TIME):  # a string is settled only if its bytes, not just its hash, are those of another
        p = slice(k, k + _AT_A_TIME)
        at = np.arange(LENGTH)
        sent[p] |= (held.raw[begin[p, None] + at] != held.raw[begin[one[which[p]], None] + at]).any(axis=1)
    gone = ~sent
    settled = np.stack([row[gone], start[gone], start[gone] + LENGTH]).astype("<i8").tobytes() if gone.any() else b""
    return key[sent], row[sent], start[sent], settled


def _match(sent: pa.Table) -> pa.Table:
    """Pass 3, buckets: suffix-sort the distinct segments; bytes of larger ids in equal strings go."""
    rows = [k for k, x in enumerate(sent.column("sizes").to_pylist()) if x]
    out = [np.zeros((4, 0), np.int64)]  # block, row, start, end of removed spans
    for block, s in zip(sent.column("block").to_pylist(), sent.column("settled").to_pylist(), strict=True):
        if s:
            spans = np.frombuffer(s, "<i8").reshape(3, -1)
            out.append(np.concatenate([np.full((1, spans.shape[1]), block), spans]))
    if rows:
        get = lambda c, t: np.concatenate([np.frombuffer(sent.column(c)[k].as_py(), t) for k in rows])
        ids, row, start, size = get("ids", "<i8"), get("rows", "<i4").astype(np.int64), get("starts", "<i8"), get("sizes", "<i8")
        part, data = get("parts", np.uint8), get("data", np.uint8)
        block = np.repeat(np.array([sent.column("block")[k].as_py() for k in rows]), [len(sent.column("sizes")[k].as_py()) // 8 for k in rows])
        end = np.cumsum(size)
        for p in range(_PARTS):
            k = np.flatnonzero(part == p)
            if len(k):
                out.append(_match_part(ids[k], block[k], row[k], start[k], size[k], data[_ragged((end - size)[k], size[k])]))
    spans = np.concatenate(out, axis=1)
    spans = spans[:, np.argsort(spans[0], kind="stable")]
    cut = np.flatnonzero(np.r_[True, spans[0, 1:] != spans[0, :-1]]) if spans.shape[1] else np.zeros(0, np.int64)
    X.give_back()
    return _extra(_SPANS, spans[0, cut].tolist(), [0] * len(cut), *(_blobs(v.astype("<i8"), cut) for v in spans[1:]))


def _unlike(data: np.ndarray, begin: np.ndarray, size: np.ndarray, like: np.ndarray) -> np.ndarray:
    """Which spans differ in bytes from the span `like` that has the same hash."""
    wrong = size != size[like]
    k = np.flatnonzero(~wrong & (like != np.arange(len(like))))
    if len(k):
        differ = data[_ragged(begin[k], size[k])] != data[_ragged(begin[like[k]], size[k])]
        wrong[k] = np.add.reduceat(differ, np.cumsum(size[k]) - size[k]) > 0
    return np.flatnonzero(wrong)


def _match_part(ids: np.ndarray, block: np.ndarray, row: np.ndarray, start: np.ndarray, size: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Removed spans: block, row, start, end."""
    end = np.cumsum(size)
    # one of each content, with its smallest id
    h = X.span_hashes(data, end - size, end)
    _, one, which = np.unique(h, return_index=True, return_inverse=True)
    other = _unlike(data, end - size, size, one[which])
    which[other] = len(one) + np.arange(len(other))  # equal hashes of different bytes: a content of its own each
    one = np.concatenate([one, other])
    least = np.full(len(one), LAST_ID, np.int64)
    np.minimum.at(least, which, ids)
    length = size[one]
    text = data[_ragged((end - size)[one], length)]
    text_end = np.cumsum(length)
    windows = length - LENGTH + 1
    starts = np.zeros(len(text), bool)
    starts[_ragged(text_end - length, windows)] = True
    order, words = suffix_order(text)
    order = order[starts[order]]
    begin = np.flatnonzero(common_prefixes(order, words) < LENGTH)
    low = np.minimum.reduceat(least[np.searchsorted(text_end, order, "right")], begin)
    smallest = np.full(len(text), LAST_ID, np.int64)
    smallest[order] = np.repeat(low, np.diff(np.r_[begin, len(order)]))
    # every segment's strings, against the smallest id of their equals
    n = windows[which]
    string = _ragged((text_end - length)[which], n)
    seg = np.repeat(np.arange(len(ids)), n)
    gone = smallest[string] < ids[seg]
    fresh = np.r_[True, seg[1:] != seg[:-1]]
    a = np.flatnonzero(gone & (fresh | ~np.r_[False, gone[:-1]]))
    z = np.flatnonzero(gone & (np.r_[fresh[1:], True] | ~np.r_[gone[1:], False]))
    place = start[seg] + (string - (text_end - length)[which[seg]])
    return np.stack([block[seg[a]], row[seg[a]], place[a], place[z] + LENGTH])


def _spans(held: _Block, extra: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
    """Maximal removed runs of each text of a block."""
    got = _of(extra, _SPANS)
    r, a, z = (np.concatenate([np.frombuffer(x, "<i8") for x in got.column(c).to_pylist()] or [np.zeros(0, np.int64)]) for c in "xyz")
    size = np.diff(held.at)
    copies = np.flatnonzero(~held.first & (size >= LENGTH))
    r, a, z = np.concatenate([r, copies]), np.concatenate([a, np.zeros(len(copies), np.int64)]), np.concatenate([z, size[copies]])
    order = np.lexsort((z, a, r))
    r, a, z = r[order], a[order], z[order]
    edge = np.searchsorted(r, np.arange(len(size) + 1))
    out = []
    for k in range(len(size)):
        x, y = a[edge[k] : edge[k + 1]], z[edge[k] : edge[k + 1]]
        if len(x):
            far = np.maximum.accumulate(y)
            new = np.r_[True, x[1:] > far[:-1]]
            at = np.flatnonzero(new)
            x, y = x[at], far[np.r_[at[1:] - 1, len(far) - 1]]
        out.append((x, y))
    return out


def _left(raw: np.ndarray, x: np.ndarray, y: np.ndarray) -> bytes:
    if not len(x):
        return raw.tobytes()
    return b"".join(raw[a:z].tobytes() for a, z in zip(np.r_[0, y], np.r_[x, len(raw)], strict=True))


def _report(texts: pa.Table, extra: pa.Table) -> pa.Table:
    """Pass 4, blocks: spans of each document and what they leave."""
    held = _Block(texts, _of(extra, _FIRST))
    spans = _spans(held, extra)
    size = np.diff(held.at)
    gone = [int((y - x).sum()) for x, y in spans]
    digest = [hashlib.sha256(_left(held.raw[held.at[k] : held.at[k + 1]], x, y)).hexdigest() for k, (x, y) in enumerate(spans)]
    listed = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(x) for x, _ in spans)]), pa.int32()), pa.StructArray.from_arrays([pa.array(np.concatenate([s[k] for s in spans]), pa.int64()) for k in (0, 1)], ["start", "end"]))
    return pa.Table.from_arrays([X.column(held.table, "own_id"), pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array([len(x) for x, _ in spans], pa.int64()), pa.array(digest), listed], names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])


def whole_characters(raw: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Removed runs narrowed so that they begin and end between UTF-8 characters."""
    head = np.append((raw & 0xC0) != 0x80, True)
    places = np.flatnonzero(head)
    x, y = places[np.searchsorted(places, x)], places[np.searchsorted(places, y, "right") - 1]
    return x[x < y], y[x < y]


class Repeats:
    """The passes over one table. `docs` needs an integer id and a text."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
        base = docs.select(F.col(id_col).cast("long").alias("own_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        total = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        self.parts = int(max(1, -(-total // BLOCK_BYTES)))
        block = F.pmod(F.xxhash64("id", "digest"), F.lit(self.parts))
        base = base.withColumn("digest", F.xxhash64("text")).withColumn("block", block)
        self.base = base
        slim = base.select("block", "id", "digest", F.xxhash64(F.lit(1), "text").alias("more"))
        least = slim.groupBy("digest", "more").agg(F.min("id").alias("least"))
        firsts = slim.join(least, ["digest", "more"]).where("id = least").select(F.col("block").alias("block"), F.lit(_FIRST).alias("kind"), F.col("id").alias("a"), F.col("digest").alias("b")).distinct()
        self.firsts = firsts.select("block", "kind", "a", "b", *(F.lit(None).cast("binary").alias(c) for c in "xyz"))

    def _texts(self) -> DataFrame:
        return self.base.select("block", "own_id", "id", "digest", "text")

    def _with(self, extra: DataFrame | None):
        both = self.firsts if extra is None else self.firsts.unionByName(extra)
        return self._texts().groupBy("block").cogroup(both.groupBy("block"))

    def spans(self) -> DataFrame:
        asked = self._with(None).applyInArrow(_ask(self.parts), "bucket long, block long, high binary, docs binary")
        answers = asked.groupBy("bucket").applyInArrow(_answer, _EXTRA_DDL)
        sent = self._with(answers).applyInArrow(_send(self.parts), _SEGMENTS_DDL)
        return sent.groupBy("bucket").applyInArrow(_match, _EXTRA_DDL)

    def report(self) -> DataFrame:
        """id, n_bytes, n_removed, n_spans, kept_sha256 and the removed spans of each document."""
        return self._with(self.spans()).applyInArrow(_report, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>")


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """docs, all columns, with repeated passages cut out of the texts (whole characters only) and chars_col counted anew; null texts stay null."""
    schema = docs.schema
    packed = docs.select(F.struct(*(c for c in docs.columns if c != text_col)).alias("rest"), F.col(id_col).alias("key"), F.col(text_col).alias("body"))
    work = Repeats(packed, "key", "body")
    base = packed.select(F.col("key").cast("long").alias("own_id"), F.coalesce(F.col("key").cast("long"), F.lit(LAST_ID)).alias("id"), F.coalesce("body", F.lit("")).alias("text"), F.col("body").isNull().alias("was_null"), "rest")
    base = base.withColumn("digest", F.xxhash64("text")).withColumn("block", F.pmod(F.xxhash64("id", "digest"), F.lit(work.parts)))
    extra = work.firsts.unionByName(work.spans())
    out_type = packed.select("rest", F.col("body").alias("text")).schema  # texts may be null

    def run(texts: pa.Table, more: pa.Table) -> pa.Table:
        held = _Block(texts, _of(more, _FIRST))
        bodies = []
        for k, (x, y) in enumerate(_spans(held, more)):
            raw = held.raw[held.at[k] : held.at[k + 1]]
            bodies.append(_left(raw, *whole_characters(raw, x, y)).decode("utf-8", "replace"))
        null = X.column(held.table, "was_null").to_pylist()
        return pa.Table.from_arrays([X.column(held.table, "rest"), pa.array([None if w else b for w, b in zip(null, bodies, strict=True)], pa.string())], names=["rest", "text"])

    got = base.select("block", "own_id", "id", "digest", "text", "was_null", "rest").groupBy("block").cogroup(extra.groupBy("block")).applyInArrow(run, out_type)
    out = got.select(*(F.col("text").alias(c) if c == text_col else F.col("rest")[c].alias(c) for c in docs.columns))
    if chars_col in docs.columns:
        out = out.withColumn(chars_col, F.length(F.col(text_col)).cast(schema[chars_col].dataType))
    return out
