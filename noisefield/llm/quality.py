"""Quality rules by repetition coverage.

Each text is cut into words (runs of bytes other than ASCII white space). Rolling hashes of several
n-gram lengths mark the words inside n-grams that occur twice or more in the same text, and line hashes
mark lines equal to an earlier line. Coverage is the share of the words' characters (code points) that
lie inside marked n-grams or lines. One pass over each Arrow batch; no shuffle.

In prose the share of words and word pairs seen before grows with length, so for the verdict the n-grams of `SHORT` are
looked for twice in each window of `WINDOW_WORDS` consecutive words, over all windows of the text; a text of one window
is judged as a whole. The counts `rep_n` are those of the whole text for every n.

Edge cases: a null text reads as empty; a text without words has zero counts and fails the base rules; a very long text is a numpy
pass of its own; repeated rows are judged each by itself; an empty table gives no rows; other columns of the
input play no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import _text as X

#: Largest share of characters inside repeated n-grams, by n. The short lengths catch stuttered and doubled words,
#: the long ones pasted passages; running prose stays well below all of them.
NGRAM_LIMITS = {1: 0.7, 2: 0.45, 3: 0.35, 5: 0.25, 7: 0.25, 10: 0.25}
#: Lengths judged by windows, and the words of a window: about the longest text that the limits were set on.
SHORT, WINDOW_WORDS = (1, 2), 20_000
LINE_LIMIT = 0.2

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars"]


def _names(lengths: tuple[int, ...]) -> list[str]:
    return [*_COUNTS, *(f"rep_{n}" for n in lengths), *(f"win_{n}" for n in lengths if n in SHORT)]


def _judged(n: int) -> str:
    return f"win_{n}" if n in SHORT else f"rep_{n}"


def _covered(words: np.ndarray, group: np.ndarray, n: int) -> np.ndarray:
    """Which words lie inside n-grams that occur twice or more in the same group; groups are numbered runs of words."""
    if len(words) < n:
        return np.zeros(len(words), bool)
    salt = X.mix(np.arange(1, group[-1] + 2, dtype=np.uint64))
    h = X.rolling(words, n)
    inside = np.flatnonzero(group[: len(h)] == group[n - 1 :])
    twice = inside[X.repeated(h[inside] ^ salt[group[inside]])]
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, twice, 1)
    np.add.at(step, twice + n, -1)
    return np.cumsum(step[:-1]) > 0


def measure_batch(texts: pa.Array, lengths: tuple[int, ...]) -> dict[str, np.ndarray]:
    """Counts of each text, and for each n the characters inside repeated n-grams as `rep_n`, inside those repeated in a window as `win_n`."""
    raw_all, at_all = X.as_bytes(texts)
    out = {k: [] for k in _names(lengths)}
    for i, j in X.passes(at_all):
        raw, at = raw_all[at_all[i] : at_all[j]], at_all[i : j + 1] - at_all[i]
        docs = j - i
        start, end, edge = X.word_spans(raw, at)
        points = np.zeros(len(raw) + 1, np.int64)
        np.cumsum((raw & 0xC0) != 0x80, out=points[1:])
        chars = points[end] - points[start]
        owner = np.repeat(np.arange(docs), np.diff(edge))
        salt = X.mix(np.arange(1, docs + 1, dtype=np.uint64))
        words = X.span_hashes(raw, start, end)
        out["n_words"].append(np.diff(edge))
        out["word_chars"].append(X.sums(chars, edge))
        marks = np.zeros(len(raw) + 1, np.int64)
        np.cumsum(_SYMBOL[raw], out=marks[1:])
        out["n_symbols"].append(marks[at[1:]] - marks[at[:-1]])
        place = np.arange(len(start)) - edge[owner]
        window = np.cumsum(place % WINDOW_WORDS == 0) - 1
        several = len(place) > 0 and place.max() >= WINDOW_WORDS
        for n in {5, *lengths}:
            covered = _covered(words, owner, n)
            if n == 5:
                out["n_repeat_words"].append(X.sums(covered, edge))
            if n in lengths:
                out[f"rep_{n}"].append(X.sums(np.where(covered, chars, 0), edge))
            if n in lengths and n in SHORT:
                near = _covered(words, window, n) if several else covered
                out[f"win_{n}"].append(X.sums(np.where(near, chars, 0), edge))
        out_lines = _line_repeats(raw, at, start, chars, edge, salt)
        out["n_dup_lines"].append(out_lines[0])
        out["dup_line_chars"].append(out_lines[1])
    return {k: np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in out.items()}


def _line_repeats(raw, at, word_start, word_chars, edge, salt):
    """Lines with a word that equal an earlier line of their text: their number, and their words' characters."""
    docs = len(at) - 1
    breaks = np.flatnonzero(raw == 10)
    begin = np.unique(np.concatenate([at[:-1], breaks + 1]))
    begin = begin[begin < len(raw)]
    if not len(begin):
        return np.zeros(docs, np.int64), np.zeros(docs, np.int64)
    stop = np.append(begin[1:], len(raw))
    stop = np.where((stop > begin) & (raw[stop - 1] == 10), stop - 1, stop)
    w0, w1 = np.searchsorted(word_start, begin), np.searchsorted(word_start, stop)
    begin, stop, w0, w1 = (x[w1 > w0] for x in (begin, stop, w0, w1))
    owner = np.searchsorted(at, begin, "right") - 1
    h = X.span_hashes(raw, begin, stop) ^ salt[owner]
    order = np.argsort(h, kind="stable")
    later = np.zeros(len(h), bool)
    later[order[1:]] = h[order[1:]] == h[order[:-1]]
    run = np.zeros(len(word_chars) + 1, np.int64)
    np.cumsum(word_chars, out=run[1:])
    held = run[w1] - run[w0]
    return np.bincount(owner[later], minlength=docs), np.bincount(owner[later], held[later], docs).astype(np.int64)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lengths: tuple[int, ...] = tuple(NGRAM_LIMITS)) -> DataFrame:
    """One row a document: its id and the counts of `measure_batch`."""
    names = _names(lengths)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = measure_batch(X.column(b, text_col), lengths)
            yield pa.RecordBatch.from_arrays([X.column(b, id_col), *(pa.array(got[k], pa.int64()) for k in names)], [id_col, *names])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type}, " + ", ".join(f"{k} long" for k in names))


def base_failed(m):
    """The base rules, on numpy arrays or on columns by name."""
    return (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])


def verdict(m, limits: dict[int, float] = NGRAM_LIMITS, line_limit: float = LINE_LIMIT):
    """Whether the base rules and the repetition coverage let a text pass, on numpy arrays or on columns by name."""
    ok = ~base_failed(m) & (m["dup_line_chars"] <= line_limit * m["word_chars"])
    for n, most in limits.items():
        ok = ok & (m[_judged(n)] <= most * m["word_chars"])
    return ok


def judge(measured: DataFrame, limits: dict[int, float] = NGRAM_LIMITS, line_limit: float = LINE_LIMIT) -> DataFrame:
    """Adds base_failed and kept to the rows of `measure`."""
    m = {c: F.col(c) for c in measured.columns}
    return measured.withColumn("base_failed", base_failed(m)).withColumn("kept", verdict(m, limits, line_limit))


def keep_good(docs: DataFrame, text_col: str = "text", limits: dict[int, float] = NGRAM_LIMITS, line_limit: float = LINE_LIMIT) -> DataFrame:
    """The rows of docs, all columns, whose texts pass. The verdict is made beside the row itself, so no join follows."""
    lengths = tuple(limits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(verdict(measure_batch(X.column(b, text_col), lengths), limits, line_limit)))

    return docs.mapInArrow(run, docs.schema)
