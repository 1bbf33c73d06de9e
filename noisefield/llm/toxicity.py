"""Toxicity by a classifier chain.

Categories are predicted one after another: the first by a linear model of a text's words, each later one by a linear
model of the words and of the earlier categories' probabilities. While training, those probabilities are
out-of-fold predictions, so a later model sees earlier ones as uncertain as they will be on new texts. A feature is
a word's presence; words are known by 64-bit hashes. The chain is fitted in one task on at most `sample_rows` labelled rows,
those of least seeded hash; the model holds the words with a weight alone, and every document is scored where it is read by
looking its words up, so an unseen word has no weight however long the text is.

The labels hold two judgements of a document, its quality and its toxicity, so the chain has two links: low quality, then toxic
given the words and the probability of low quality. A third category made from these two would have nothing of its own to learn.
`categories` may name others where labels hold them.

Edge cases: a null or empty text has no words and gets the models' intercepts; a null label counts as 0, and where
labels repeat an id each category has its largest value; rows that repeat an id are scored each by itself, and the one whose text has the
least hash is fitted on; labels of unknown ids are unused; without any labels all probabilities
are 0; very long texts are scored whole; an empty table gives no rows; extra columns play no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import _text as X
from ._store import keep

CATEGORIES = ("low_quality", "toxic")
#: Labelled rows in the sample.
SAMPLE_ROWS = 20_000
FOLDS, STEPS, RATE, DECAY = 3, 300, 0.5, 1e-5
#: A word's weight is learnt if this many sample texts hold it and its chi-squared against the label is at least so large
#: (about one word in a million by chance). Rarer or weaker words would only be learnt by heart.
LEAST_TEXTS, LEAST_CHI2 = 5, 24.0
THRESHOLD = 0.5

_LETTER = np.ones(256, bool)
_LETTER[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = False


def word_features(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each pass over the batch: its first document, distinct words' hashes of all its documents, and where each document's start.

    Words here are runs of letters and digits in lower case (bytes from 0x80 on count as letters)."""
    raw_all, at_all = X.as_bytes(texts)
    for i, j in X.passes(at_all):
        raw, at = X.lower(raw_all[at_all[i] : at_all[j]]), at_all[i : j + 1] - at_all[i]
        start, end, edge = X.word_spans(np.where(_LETTER[raw], raw, 32).astype(np.uint8), at)
        known, h = np.unique(X.span_hashes(raw, start, end), return_inverse=True)
        top = max(len(known), 1)
        key = np.unique(np.repeat(np.arange(j - i), np.diff(edge)) * top + h)
        yield i, known[key % top], np.searchsorted(key, np.arange(j - i + 1) * top)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class _Rows:
    """Sparse rows of present words plus dense columns."""

    def __init__(self, words: list[np.ndarray], width: int):
        self.size = np.array([len(w) for w in words])
        self.at = np.concatenate([[0], np.cumsum(self.size)])
        self.words = np.concatenate(words) if words else np.zeros(0, np.int64)
        self.width = width

    def take(self, rows: np.ndarray) -> _Rows:
        return _Rows([self.words[self.at[r] : self.at[r + 1]] for r in rows], self.width)

    def only(self, words: np.ndarray) -> _Rows:
        """The same rows with these words alone, numbered from 0."""
        place = np.full(self.width, -1)
        place[words] = np.arange(len(words))
        got = place[self.words]
        edge = np.concatenate([[0], np.cumsum(got >= 0)])[self.at]
        out = _Rows([], len(words))
        out.words, out.at, out.size = got[got >= 0], edge, np.diff(edge)
        return out

    def dot(self, w: np.ndarray) -> np.ndarray:
        run = np.concatenate([[0.0], np.cumsum(w[self.words])])
        return run[self.at[1:]] - run[self.at[:-1]]

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.words, np.repeat(g, self.size), self.width)


def telling_words(rows: _Rows, y: np.ndarray) -> np.ndarray:
    """Which words are common enough and go with the label more than chance would have it."""
    n, pos = len(y), y.sum()
    df = np.bincount(rows.words, minlength=rows.width)
    a = np.bincount(rows.words, np.repeat(y, rows.size), rows.width)
    off = a * n - df * pos
    chi2 = off * off * n / np.maximum(df * (n - df) * pos * (n - pos), 1e-9)
    return (df >= LEAST_TEXTS) & (chi2 >= LEAST_CHI2)


def fit_linear(rows: _Rows, extra: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights of words, and of (intercept, extra columns), by logistic loss with adaptive steps and class weights."""
    n = max(len(y), 1)
    dense = np.concatenate([np.ones((len(y), 1)), extra], axis=1)
    useful = np.flatnonzero(telling_words(rows, y))
    few = rows.only(useful)
    rate = np.clip(y.mean() if len(y) else 0.5, 1e-4, 1 - 1e-4)
    weight = np.where(y > 0, min(1 / rate, 8), 1.0) / n
    w, b = np.zeros(few.width), np.zeros(dense.shape[1])
    b[0] = np.log(rate / (1 - rate))
    gw, gb = np.full(few.width, 1e-10), np.full(len(b), 1e-10)
    for _ in range(STEPS):
        r = (_sigmoid(few.dot(w) + dense @ b) - y) * weight
        g = few.back(r) + DECAY * w
        d = r @ dense
        gw += g * g
        gb += d * d
        w -= RATE * g / np.sqrt(gw)
        b -= RATE * d / np.sqrt(gb)
    out = np.zeros(rows.width)
    out[useful] = w
    return out, b


def fit_chain(words: list[np.ndarray], labels: np.ndarray, fold: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words with a weight in order, their weights and dense weights of each category; labels has a column for each category in order."""
    n = labels.shape[1]
    known, place, seen = np.unique(np.concatenate([np.zeros(0, np.uint64), *words]), return_inverse=True, return_counts=True)
    common = seen >= LEAST_TEXTS  # a rarer word has no weight in any fold
    rows = _Rows([], len(known))
    rows.size = np.array([len(w) for w in words])
    rows.at, rows.words = np.concatenate([[0], np.cumsum(rows.size)]), place
    rows, known = rows.only(np.flatnonzero(common)), known[common]
    weights, dense = np.zeros((n, len(known)), np.float32), np.zeros((n, n), np.float64)
    earlier = np.zeros((len(fold), 0))
    for c in range(n):
        y = labels[:, c].astype(float)
        out = np.zeros(len(y))
        for f in range(FOLDS):
            held, rest = np.flatnonzero(fold == f), np.flatnonzero(fold != f)
            if len(held) and len(rest):
                w, b = fit_linear(rows.take(rest), earlier[rest], y[rest])
                out[held] = _sigmoid(rows.take(held).dot(w) + np.concatenate([np.ones((len(held), 1)), earlier[held]], axis=1) @ b)
        w, b = fit_linear(rows, earlier, y)
        weights[c], dense[c, : len(b)] = w, b
        earlier = np.concatenate([earlier, out[:, None]], axis=1)
    used = (weights != 0).any(axis=0)
    return known[used], weights[:, used], dense


def categories_of(labels: DataFrame) -> DataFrame:
    """doc_id with a 0/1 column for each category, from quality and toxic."""
    low, toxic = F.coalesce(F.col("quality"), F.lit(1)) == 0, F.coalesce(F.col("toxic"), F.lit(0)) == 1
    return labels.select("doc_id", *(c.cast("int").alias(k) for k, c in zip(CATEGORIES, (low, toxic), strict=True)))


def train(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...] = CATEGORIES, sample_rows: int = SAMPLE_ROWS, seed: int = 7, id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The chain fitted on a bounded sample of labelled rows."""
    key: Column = F.xxhash64(F.lit(seed), id_col)
    one = labels.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(*(F.max(c).alias(c) for c in categories))
    chosen = keep(one.withColumn("draw", key).orderBy("draw", id_col).limit(sample_rows))
    sample = docs.select(F.col(id_col).alias("sample_id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), F.col("sample_id") == F.col(id_col))  # at most sample_rows ids
    # a row an id before anything is gathered, however often the table repeats it: the one with the least hash of its text
    sample = sample.groupBy("draw", id_col).agg(F.min(F.struct(F.xxhash64("text").alias("text_hash"), "text", *categories)).alias("least")).select("draw", "least.*")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, words, at in word_features(X.column(b, "text")):
                n = len(at) - 1
                yield pa.RecordBatch.from_arrays([X.column(b, "draw").slice(i, n), X.column(b, "text_hash").slice(i, n), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(words.view(np.int64))), *(X.column(b, c).slice(i, n) for c in categories)], ["draw", "text_hash", "words", *categories])

    rows = sample.mapInArrow(features, "draw long, text_hash long, words array<long>, " + ", ".join(f"{c} int" for c in categories))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["draw", "text_hash"]).drop_duplicates("draw")
        known, w, b = fit_chain([np.asarray(x, np.int64).view(np.uint64) for x in pdf["words"]], pdf[list(categories)].to_numpy(), pdf["draw"].to_numpy() % FOLDS)
        return pd.DataFrame({"category": range(len(categories)), "known": [known.tobytes()] * len(categories), "weights": [x.tobytes() for x in w], "dense": [x.tobytes() for x in b]})

    got = rows.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(fit, "category int, known binary, weights binary, dense binary").collect()
    got.sort(key=lambda r: r["category"])
    n = len(categories)
    if not got:
        return np.zeros(0, np.uint64), np.zeros((n, 0), np.float32), np.concatenate([np.full((n, 1), -30.0), np.zeros((n, n - 1))], axis=1)
    return np.frombuffer(got[0]["known"], np.uint64), np.stack([np.frombuffer(r["weights"], np.float32) for r in got]), np.stack([np.frombuffer(r["dense"], np.float64) for r in got])


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, np.ndarray], categories: tuple[str, ...] = CATEGORIES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words and the probability of each category."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the words that passed the screen, from a bounded sample
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weights, dense = shared.value
        for b in batches:
            for i, words, at in word_features(X.column(b, text_col)):
                n = len(at) - 1
                where = np.searchsorted(known, words)
                where[np.append(known, np.uint64(0))[where] != words] = len(known)
                hit = np.flatnonzero(where < len(known))
                edge, where = np.searchsorted(hit, at), where[hit]
                p: list[np.ndarray] = []
                for c in range(len(categories)):
                    run_ = np.concatenate([[0.0], np.cumsum(weights[c][where], dtype=np.float64)])
                    z = run_[edge[1:]] - run_[edge[:-1]] + dense[c, 0]
                    for k, earlier in enumerate(p):
                        z = z + dense[c, k + 1] * earlier
                    p.append(_sigmoid(z))
                yield pa.RecordBatch.from_arrays([X.column(b, id_col).slice(i, n), pa.array(np.diff(at), pa.int64()), *(pa.array(x) for x in p)], [id_col, "n_distinct_words", *(f"p_{c}" for c in categories)])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type}, n_distinct_words long, " + ", ".join(f"p_{c} double" for c in categories))
