"""Periodic runs of words, found with suffix trees.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) that has at least `LEAST_LENGTH` words and
`LEAST_PERIODS` periods, and that neither neighbouring word extends. Every run has a Lyndon root: under one of the two orders of the alphabet (the
order itself and its reverse) the longest Lyndon word at some place of the run is one period. These words follow from the ranks of the suffixes, which are
the order of the leaves of a suffix tree (Ukkonen's construction); each gives a candidate, which is extended to the right by the
longest common extension of two places, and to the left by that of the reversed words. An extension is the depth of the lowest common ancestor of two
leaves: the smallest depth between them on the tree's Euler tour, found in constant time from minima of blocks.

Before trees are built, words that no run can hold are set aside, exactly: of every window of `WINDOW` words in a run there is another copy
a period away in that run, so only stretches covered by windows that occur twice in a document can hold runs, each wholly. Equal hashes of
different windows only add stretches.

Scale: documents are read once, in batches, and not shuffled. A stretch is one tree of a task, at most a document's words (some 400 bytes a word
while it is looked at). No cap, no sample.

Edge cases: a null or empty text, or one of white space, has no words and no runs; a text shorter than a run has none; a very long text is
looked at whole; repeated rows and null ids are documents like others; an empty table gives no rows; extra columns play no part,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from . import _text as X

LEAST_LENGTH, LEAST_PERIODS = 24, 3
#: In a run of length L and period q, windows of up to L - 2q + 1 words have a second copy; this is the least of it over all runs.
WINDOW = LEAST_LENGTH * (LEAST_PERIODS - 2) // LEAST_PERIODS + 1
#: Bytes of text that one pass splits.
PASS_BYTES = 4 << 20
#: Numbers in a block of the minima.
_BLOCK = 16
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class RangeMinimum:
    """Smallest number between two places, in constant time: minima inside blocks, and of 2^k blocks in a row."""

    def __init__(self, values: np.ndarray) -> None:
        n = -(-len(values) // _BLOCK)
        padded = np.full(n * _BLOCK, np.iinfo(np.int32).max, np.int32)
        padded[: len(values)] = values
        rows = padded.reshape(n, _BLOCK)
        self.values = padded
        self.to = np.minimum.accumulate(rows, axis=1).ravel()  # from the block's start
        self.on = np.ascontiguousarray(np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1]).ravel()  # to the block's end
        self.levels = [self.to[_BLOCK - 1 :: _BLOCK]]
        while 2 << (len(self.levels) - 1) <= n:
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def between(self, a: np.ndarray, z: np.ndarray) -> np.ndarray:
        """Of places a to z, both included, a <= z."""
        first, last = a // _BLOCK, z // _BLOCK
        out = np.minimum(self.on[a], self.to[z])
        inner = last - first - 1
        level = np.zeros(len(a), np.int64)
        some = inner > 0
        level[some] = np.frexp(inner[some].astype(float))[1] - 1
        for k in np.unique(level[some]):
            at = np.flatnonzero(some & (level == k))
            held = self.levels[k]
            out[at] = np.minimum(out[at], np.minimum(held[first[at] + 1], held[last[at] - (1 << int(k))]))
        same = np.flatnonzero(first == last)
        if len(same):
            x, y = a[same], z[same]
            least = self.values[x]
            for d in range(1, _BLOCK):
                least = np.minimum(least, self.values[np.minimum(x + d, y)])
            out[same] = least
        return out


class SuffixTree:
    """Of numbers from 1 on; a 0 is put at the end. Built by Ukkonen's method, then kept as its Euler tour."""

    def __init__(self, numbers: list[int]) -> None:
        s = [*numbers, 0]
        n, k = len(s), max(numbers, default=0) + 1
        start, end, link = [0], [0], [0]  # of the edge into a node; node 0 is the root
        down: dict[int, int] = {}  # node * k + first number of the edge: the node below
        leaves: list[int] = []  # in the order of their suffixes
        node = length = edge = left = 0
        for i in range(n):
            c, left, pending = s[i], left + 1, 0
            while left:
                if not length:
                    edge = i
                key = node * k + s[edge]
                below = down.get(key)
                if below is None:
                    down[key] = len(start)
                    leaves.append(len(start))
                    start.append(i)
                    end.append(n)
                    link.append(0)
                    if pending:
                        link[pending] = node
                        pending = 0
                else:
                    first = start[below]
                    size = end[below] - first
                    if length >= size:
                        edge += size
                        length -= size
                        node = below
                        continue
                    if s[first + length] == c:
                        length += 1
                        if pending:
                            link[pending] = node
                        break
                    split = len(start)
                    leaf = split + 1
                    start += (first, i)
                    end += (first + length, n)
                    link += (0, 0)
                    leaves.append(leaf)
                    down[key] = split
                    down[split * k + c] = leaf
                    start[below] = first + length
                    down[split * k + s[first + length]] = below
                    if pending:
                        link[pending] = split
                    pending = split
                left -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - left + 1
        self._tour(np.fromiter(down.keys(), np.int64, len(down)), np.fromiter(down.values(), np.int64, len(down)), k, np.array(end) - np.array(start), np.array(leaves))

    def _tour(self, keys: np.ndarray, below: np.ndarray, k: int, size: np.ndarray, leaves: np.ndarray) -> None:
        """Depths along the Euler tour, children in the order of their edges' first numbers, and where each suffix's leaf is on it."""
        order = np.argsort(keys)
        child = below[order].tolist()
        turn = np.searchsorted(keys[order] // k, np.arange(len(size) + 1)).tolist()  # next child of each node
        stop = turn[1:]
        size = size.tolist()
        at = [0] * len(size)
        tour: list[int] = []
        above: list[int] = []
        node = depth = 0
        while True:
            tour.append(depth)
            x = turn[node]
            if x < stop[node]:
                turn[node] = x + 1
                above.append(node)
                node = child[x]
                depth += size[node]
                at[node] = len(tour)
            elif above:
                depth -= size[node]
                node = above.pop()
            else:
                break
        self.at = np.array(at, np.int64)[leaves]
        self.depths = RangeMinimum(np.array(tour, np.int32))

    def ranks(self) -> np.ndarray:
        """Rank of each suffix, but that of the end mark."""
        out = np.empty(len(self.at), np.int64)
        out[np.argsort(self.at)] = np.arange(len(self.at))
        return out[:-1]

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Longest common extension from different places i and j."""
        a, z = self.at[i], self.at[j]
        return self.depths.between(np.minimum(a, z), np.maximum(a, z)).astype(np.int64)


def next_beyond(ranks: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """For each place the next one with a smaller rank, and the next one with a larger rank; else the end."""
    n = len(ranks)
    out = []
    for sign in (1, -1):
        found, open_ = [n] * n, []
        for i, r in enumerate(ranks):
            while open_ and sign * ranks[open_[-1]] > sign * r:
                found[open_.pop()] = i
            open_.append(i)
        out.append(np.array(found, np.int64))
    return out[0], out[1]


def runs(words: np.ndarray, least_length: int = LEAST_LENGTH, least_periods: int = LEAST_PERIODS) -> np.ndarray:
    """start, length, period of all runs of a sequence of numbers from 0 on, a row a run, by start and period."""
    n = len(words)
    if n < max(least_length, least_periods):
        return np.zeros((0, 3), np.int64)
    _, dense = np.unique(words, return_inverse=True)
    numbers = (dense.ravel() + 1).tolist()
    tree = SuffixTree(numbers)
    place = np.arange(n)
    i = np.concatenate([place, place])
    p = np.concatenate(next_beyond(tree.ranks().tolist())) - i
    short = p * least_periods <= n
    i, p = i[short], p[short]
    right = tree.extension(i, i + p)
    del tree
    left = SuffixTree(numbers[::-1]).extension(n - i, n - i - p)
    found = np.stack([i - left, left + p + right, p], 1)
    found = found[(found[:, 1] >= least_length) & (found[:, 1] >= least_periods * p)]
    # where the text ends inside a run, a place of the reverse order may give several periods; such a stretch is the run of the smallest one
    found = np.unique(found, axis=0)
    found = found[np.append(True, (found[1:, :2] != found[:-1, :2]).any(axis=1))[: len(found)]]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def stretches(words: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Start and end of the stretches that may hold runs: words covered by windows that occur more than once in their document."""
    if len(words) < LEAST_LENGTH:
        return np.zeros((0, 2), np.int64)
    keys = X.rolling(X.mix(words.astype(np.uint64) + np.uint64(1)), WINDOW)
    last = len(keys)
    own = doc[:last] == doc[WINDOW - 1 : WINDOW - 1 + last]
    at = np.flatnonzero(own)
    at = at[X.repeated(X.mix(keys[at] ^ X.mix(doc[at].astype(np.uint64) + np.uint64(1))))]
    if not len(at):
        return np.zeros((0, 2), np.int64)
    # windows that overlap or touch inside a document are one stretch
    new = np.flatnonzero(np.append(True, (at[1:] > at[:-1] + WINDOW) | (doc[at[1:]] != doc[at[:-1]])))
    out = np.stack([at[new], at[np.append(new[1:], len(at)) - 1] + WINDOW], 1)
    return out[out[:, 1] - out[:, 0] >= LEAST_LENGTH]


def repeats(n: int, found: np.ndarray) -> np.ndarray:
    """Which of n words any run holds after its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, found[:, 0] + found[:, 2], 1)
    np.add.at(edge, found[:, 0] + found[:, 1], -1)
    return np.cumsum(edge[:-1]) > 0


def _numbers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Each word's number (equal words, equal numbers) and document."""
    split = pc.ascii_split_whitespace(texts)
    coded = split.values.dictionary_encode()
    words = np.asarray(coded.indices, np.int64)
    doc = np.repeat(np.arange(len(texts)), np.diff(np.asarray(split.offsets, np.int64)))
    real = pc.not_equal(coded.dictionary, "").to_numpy(zero_copy_only=False)[words] if len(words) else np.zeros(0, bool)
    return words[real], doc[real]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, runs (start, length, period in words, by start and period) and collapsed: the words that no run repeats, one space between."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key, texts = X.column(b, id_col), X.column(b, text_col).cast(pa.large_string()).fill_null("")
            _, at = X.as_bytes(texts)
            for i, j in X.passes(at, PASS_BYTES):
                part = texts.slice(i, j - i)
                words, doc = _numbers(part)
                first = np.searchsorted(doc, np.arange(j - i + 1))
                found: dict[int, list[np.ndarray]] = {}
                for a, z in stretches(words, doc):
                    got = runs(words[a:z])
                    if len(got):
                        d = int(doc[a])
                        found.setdefault(d, []).append(got + [a - first[d], 0, 0])
                rows = []
                for d, text in enumerate(part.to_pylist()):
                    held, n = text.encode().split(), int(first[d + 1] - first[d])  # bytes split at ASCII white space
                    mine = np.concatenate(found[d]) if d in found else np.zeros((0, 3), np.int64)
                    if len(mine):
                        held = [w for w, gone in zip(held, repeats(n, mine).tolist(), strict=True) if not gone]
                    rows.append((n, [dict(zip(("start", "length", "period"), r, strict=True)) for r in mine.tolist()], b" ".join(held).decode()))
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([key.slice(i, j - i), pa.array(cols[0], pa.int64()), pa.array(cols[1], _RUNS_ARROW), pa.array(cols[2], pa.string())], [id_col, "n_words", "runs", "collapsed"])
        X.give_back()

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type}, n_words long, runs {RUNS}, collapsed string")


_RUNS_ARROW = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))


def strongest(found: Column) -> Column:
    """The run with the most periods (exactly compared; ties: smallest start, then period); null without runs."""
    best = lambda b, r: F.when(b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b)
    return F.aggregate(found, F.lit(None).cast(RUNS[6:-1]), best)
