"""How far the sources of a language differ in their words, from run-length columns.

Terms are runs of letters (A-Z lower-cased, all characters outside ASCII); a language keeps those in at least `LEAST_DOCS` of its
documents. A group is a source of a language; its column holds its counts of the language's kept terms. The vocabulary is reordered
so that terms with equal counts in all groups stand together, and each group's column is run-length encoded. A pair of groups is compared over
the intersections of their runs: the divergence of one term, times the length of the intersection. Terms that stand out in a group
against its language are listed with the same measure. All arithmetic is in whole numbers.

Scale: tasks count terms of a few megabytes of text at a time, so counts are shuffled, not words, and a hot group is spread by its terms. The
ordered vocabulary is cut into blocks where range partitions end; a task encodes a block, a second one compares tiles of `TILE` groups over a block,
so no task holds a whole vocabulary or all pairs of groups of a language; sums over blocks follow. A block in which a group has no
term is a run of zeros. What a pair costs is its runs, not its terms.

Edge cases: null text, language or source reads as empty; a group without terms and a language without kept terms have pairs of value 0;
a language of one source has no pairs; ties in rank go to the smaller name in UTF-8 order; very long texts are counted whole; repeated rows
count each; an empty table gives no rows; extra columns play no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from . import _text as X
from ._store import attach, keep

#: Documents of a language that a kept term is in, at least.
LEAST_DOCS = 10
#: Terms in a block of the reordered vocabulary, on average, and groups in a tile.
BLOCK, TILE = 8192, 64
#: Bytes of text whose terms are counted at once.
PASS_BYTES = 8 << 20
#: Unit of the shares p: thousands, three times over.
_THOUSANDS = 3
SCALE = 1000**_THOUSANDS

_LETTERS = np.full(256, 0x20, np.uint8)
_LETTERS[97:123] = _LETTERS[65:91] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)


# Counts -----------------------------------------------------------------------------------------------------------


def _terms(raw: np.ndarray, at: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct terms of texts, and the number of the term and of the text of each occurrence."""
    plain = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(np.ascontiguousarray(at)), pa.py_buffer(_LETTERS[raw]))
    split = pc.ascii_split_whitespace(plain)
    coded = split.values.dictionary_encode()
    which = np.asarray(coded.indices, np.int64)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(np.asarray(split.offsets, np.int64)))
    real = pc.not_equal(coded.dictionary, "").to_numpy(zero_copy_only=False)[which] if len(which) else np.zeros(0, bool)
    return coded.dictionary, which[real], doc[real]


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents with the term); the row of a null term has a group's documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lang", "source", "term", "n", "docs"]
        for b in batches:
            raw, at = X.as_bytes(X.column(b, "text"))
            lang, source = (X.column(b, c).dictionary_encode() for c in names[:2])
            group = np.asarray(lang.indices, np.int64) * len(source.dictionary) + np.asarray(source.indices, np.int64)
            for i, j in X.passes(at, PASS_BYTES):
                terms, which, doc = _terms(raw[at[i] : at[j]], at[i : j + 1] - at[i])
                held, n = np.unique(doc * len(terms) + which, return_counts=True)
                key = group[i:j][held // max(len(terms), 1)] * len(terms) + held % max(len(terms), 1)
                order = np.argsort(key, kind="stable")
                key, begin = np.unique(key[order], return_index=True)
                each, n = np.diff(np.append(begin, len(order))), np.add.reduceat(n[order], begin) if len(begin) else n
                alone, docs_of = np.unique(group[i:j], return_counts=True)
                g = np.concatenate([key // max(len(terms), 1), alone])
                term = pa.concat_arrays([terms.take(pa.array(key % max(len(terms), 1))).cast(pa.string()), pa.nulls(len(alone), pa.string())])
                cols = [lang.dictionary.take(pa.array(g // len(source.dictionary))), source.dictionary.take(pa.array(g % len(source.dictionary))), term]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(np.append(n, np.zeros(len(alone), np.int64))), pa.array(np.append(each, docs_of))], names)
        X.give_back()

    text = lambda c, name: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
    rows = docs.select(text(lang_col, "lang"), text(source_col, "source"), F.col(text_col).alias("text")).mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(counts: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """lang, term and its counts by source (an ordered array of the sources that have it)."""
    by = counts.where("term is not null").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sort_array(F.collect_list(F.struct("source", "n"))).alias("counts"))
    return by.where(F.col("docs") >= least_docs).select("lang", "term", "counts")


def group_facts(counts: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, number (from 0 in a language), n_terms (kept terms that it has), width (kept terms of the language), and the bases of shares in the group and in the language."""
    each = kept.select("lang", F.inline("counts")).groupBy("lang", "source").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_terms"))
    width = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("width"))
    whole = each.groupBy("lang").agg(F.sum("n").alias("whole"))
    out = counts.where("term is null").select("lang", "source").join(each, ["lang", "source"], "left").join(width, "lang", "left").join(whole, "lang", "left").na.fill(0)
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    return out.select("lang", "source", number.alias("number"), "n_terms", "width", (F.col("n") + 2 * F.col("width")).alias("base"), (F.col("whole") + 2 * F.col("width")).alias("lang_base"))


# Run-length columns -----------------------------------------------------------------------------------------------


def run_lengths(place: np.ndarray, n: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and values of the runs of a column of `length` numbers, from its places other than 0, in order."""
    dense = np.zeros(length, np.int64)
    dense[place] = n
    start = np.flatnonzero(np.append(length > 0, dense[1:] != dense[:-1]))
    return start, dense[start]


def columns(kept: DataFrame) -> DataFrame:
    """lang, block, length (terms), source, starts and values of its runs: the vocabulary ordered by its counts, each group's column encoded block by block.

    A block is what one range of the order holds of a language; groups without a term in it have no row."""
    order = ["lang", "counts", "term"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if len(b)]
        if not held:
            return
        t = pa.Table.from_batches(held).combine_chunks()
        lang, counts = X.column(t, "lang").dictionary_encode(), X.column(t, "counts")
        edge = np.asarray(counts.offsets, np.int64)
        flat = counts.values.slice(edge[0], edge[-1] - edge[0])
        place = np.repeat(np.arange(len(t)), np.diff(edge))
        sources, n = flat.field("source").dictionary_encode(), flat.field("n").to_numpy()
        source = np.asarray(sources.indices, np.int64)
        of = np.asarray(lang.indices, np.int64)
        rows = []
        for first in np.flatnonzero(np.append(True, of[1:] != of[:-1])):
            length = int((of == of[first]).sum())
            mine = np.flatnonzero((place >= first) & (place < first + length))
            by = mine[np.argsort(source[mine], kind="stable")]
            for part in np.split(by, np.flatnonzero(np.diff(source[by])) + 1):
                if len(part):
                    start, values = run_lengths(place[part] - first, n[part], length)
                    rows.append({"lang": lang.dictionary[of[first]].as_py(), "block": TaskContext.get().partitionId(), "length": length, "source": sources.dictionary[source[part[0]]].as_py(), "starts": start.astype(np.int32), "values": values})
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("lang", pa.string()), ("block", pa.int32()), ("length", pa.int32()), ("source", pa.string()), ("starts", pa.list_(pa.int32())), ("values", pa.list_(pa.int64()))]))

    tasks = max(1, -(-kept.count() // BLOCK))
    return kept.repartitionByRange(tasks, *order).sortWithinPartitions(*order).mapInArrow(run, "lang string, block int, length int, source string, starts array<int>, values array<long>")


def shares(n: np.ndarray, base: int) -> np.ndarray:
    """1 + floor(SCALE * (n + 2) / base), exactly, for bases below 2^63 / 1000."""
    out, rest = np.zeros(len(n), np.int64), n.astype(np.int64) + 2
    for _ in range(_THOUSANDS):
        rest = rest * 1000
        out, rest = out * 1000 + rest // base, rest % base
    return out + 1


def divergence(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], length: int) -> int:
    """Sum over terms of floor((p - q)^2 / (p + q)) of two run-length columns of shares, run by run."""
    start = np.union1d(a[0], b[0])
    p, q = (s[np.searchsorted(at, start, "right") - 1] for at, s in (a, b))
    return int(((p - q) * (p - q) // np.maximum(p + q, 1) * np.diff(np.append(start, length))).sum())


def pair_values(runs: DataFrame, facts: DataFrame) -> DataFrame:
    """lang, a, b (numbers of sources, a < b) and value, summed over blocks."""
    blocks = runs.groupBy("lang", "block").agg(F.first("length").alias("length"))
    bare = facts.where("width = 0").select("lang", F.lit(-1).alias("block"), F.lit(0).alias("length")).distinct()
    # every group in every block of its language: without runs there, it is a run of zeros
    full = blocks.unionByName(bare).join(facts.select("lang", "source", "number", "base"), "lang").join(runs.drop("length"), ["lang", "block", "source"], "left")
    tile = F.floor(F.col("number") / TILE).cast("int")
    last = facts.groupBy("lang").agg(F.floor(F.max("number") / TILE).cast("int").alias("last"))
    sent = full.withColumn("tile", tile).join(last, "lang").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
    sent = sent.withColumns({"i": F.least("tile", "other"), "j": F.greatest("tile", "other")}).select("lang", "block", "i", "j", "tile", "length", "number", "base", "starts", "values")

    def run(t: pa.Table) -> pa.Table:
        lang, length = t.column("lang")[0], t.column("length")[0].as_py()
        i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        own = sorted(zip(t.column("number").to_pylist(), t.column("tile").to_pylist(), t.column("base").to_pylist(), range(len(t))))
        cols = []
        for number, of, base, k in own:
            starts, values = t.column("starts")[k], t.column("values")[k]
            start, n = (np.asarray(x.values.to_numpy(), np.int64) for x in (starts, values)) if starts.is_valid else (np.zeros(min(length, 1), np.int64),) * 2
            cols.append((number, of, (start, shares(n, base))))
        rows = [(a[0], b[0], divergence(a[2], b[2], length)) for k, a in enumerate(cols) for b in cols[k + 1 :] if (a[1], b[1]) in ((i, j), (j, i))]
        a, b, v = (pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int32(), pa.int32(), pa.int64())))
        return pa.Table.from_arrays([pa.array([lang.as_py()] * len(rows), pa.string()), a, b, v], ["lang", "a", "b", "value"])

    each = sent.groupBy("lang", "block", "i", "j").applyInArrow(run, "lang string, a int, b int, value long")
    return each.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


# The audit --------------------------------------------------------------------------------------------------------


def _share(n: Column, base: Column) -> Column:
    return F.expr("1L") + F.call_function("div", (n + 2).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(11,0)"), base.cast("decimal(20,0)"))


def _ranked(rows: DataFrame) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))


def pairs(runs: DataFrame, facts: DataFrame) -> DataFrame:
    """lang, source, item (each other source of the language), value and rank."""
    name = lambda k: facts.select("lang", F.col("number").alias(k), F.col("source").alias(f"{k}_source"))
    named = pair_values(runs, facts).join(name("a"), ["lang", "a"]).join(name("b"), ["lang", "b"])
    both = F.array(*(F.struct(F.col(f"{x}_source").alias("source"), F.col(f"{y}_source").alias("item")) for x, y in ("ab", "ba")))
    return _ranked(named.select("lang", F.inline(both), "value"))


def outstanding(kept: DataFrame, facts: DataFrame, most: int = 10) -> DataFrame:
    """lang, source, item (a term that the group has, with a larger share than in the language), value and rank, to rank `most`."""
    total = F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + x["n"])
    rows = kept.select("lang", F.col("term").alias("item"), total.alias("total"), F.inline("counts"))
    rows = attach(rows, facts.where("n_terms > 0").select("lang", "source", "base", "lang_base", "n_terms"), ["lang", "source"], "n_terms")
    p, q = F.col("p"), F.col("q")
    rows = rows.select("lang", "source", "item", _share(F.col("n"), F.col("base")).alias("p"), _share(F.col("total"), F.col("lang_base")).alias("q")).where(p > q)
    return _ranked(rows.select("lang", "source", "item", F.call_function("div", (p - q) * (p - q), p + q).alias("value"))).where(F.col("rank") <= most)


def audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", least_docs: int = LEAST_DOCS, most: int = 10) -> DataFrame:
    """lang, source, part (`pair` or `term`), item, value and rank."""
    counts = keep(term_counts(docs, lang_col, source_col, text_col))
    kept = keep(kept_terms(counts, least_docs))
    facts = keep(group_facts(counts, kept))
    runs = keep(columns(kept))
    out = None
    for part, rows in (("pair", pairs(runs, facts)), ("term", outstanding(kept, facts, most))):
        rows = rows.select("lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank"))
        out = rows if out is None else out.unionByName(rows)
    return out
