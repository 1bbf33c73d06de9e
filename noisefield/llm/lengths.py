"""Token counts from an exact histogram of encoded lengths.

Documents are tokenized where they are read, once, and counted by encoded length; only (length, count) pairs are
shuffled, after partial counts, and the histogram is kept. Sums over all longer lengths then answer, for every context limit,
how many documents and tokens are longer, how many tokens remain when every document is cut to the limit, and
which share of documents is no longer: for all lengths that occur in `suffix_report`, for any other limit in `at_limits`, and
the other way round, from shares to lengths, in `quantiles`. Running sums go over blocks of lengths first and over lengths inside a
block second, so no task holds all lengths.

Edge cases: a null or empty text has length 0; a very long text has a length of its own; ties and repeated rows count each; an
empty table gives no rows; extra columns play no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from . import _text as X, _tokens
from ._store import keep

#: Lengths in one block of the running sums.
BLOCK = 512


def encoded_lengths(docs: DataFrame, tokenizer_path: str, text_col: str = "text") -> DataFrame:
    """One row a document: n_tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = [np.diff(at) for _, _, at in _tokens.encode(X.column(b, text_col), tokenizer_path)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sizes) if sizes else np.zeros(0, np.int64), pa.int64())], ["n_tokens"])

    return docs.select(text_col).mapInArrow(run, "n_tokens long")


def histogram(lengths: DataFrame) -> DataFrame:
    """length, n_docs; kept, so that the documents are not tokenized again where it is used twice."""
    return keep(lengths.groupBy(F.col("n_tokens").alias("length")).agg(F.count(F.lit(1)).alias("n_docs")))


COLUMNS = ["context_limit", "n_docs", "docs_at_least", "tokens_at_least", "total_docs", "total_tokens", "truncated_tokens", "share_fitting"]


def _answers(at: DataFrame) -> DataFrame:
    """COLUMNS from context_limit, the documents of just that length, the documents and tokens at least that long, and the totals."""
    at = at.withColumn("truncated_tokens", F.col("total_tokens") - F.col("tokens_at_least") + F.col("context_limit") * F.col("docs_at_least"))
    return at.withColumn("share_fitting", (F.col("total_docs") - F.col("docs_at_least") + F.col("n_docs")) / F.col("total_docs")).select(*COLUMNS)


def suffix_report(hist: DataFrame) -> DataFrame:
    """For each length that occurs, as a context limit: documents and tokens at least that long, totals, truncated totals and the share of documents that fit."""
    h = hist.withColumn("n_tokens", F.col("length") * F.col("n_docs")).withColumn("block", F.floor(F.col("length") / BLOCK))
    sums = h.groupBy("block").agg(F.sum("n_docs").alias("b_docs"), F.sum("n_tokens").alias("b_tokens"))
    above = Window.partitionBy(F.lit(0)).orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    blocks = sums.select("block", *(F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"above_{c}") for c in ("b_docs", "b_tokens")), F.sum("b_docs").over(whole).alias("total_docs"), F.sum("b_tokens").over(whole).alias("total_tokens"))
    inside = Window.partitionBy("block").orderBy(F.desc("length"))
    out = h.join(blocks, "block").withColumn("docs_at_least", F.col("above_b_docs") + F.sum("n_docs").over(inside)).withColumn("tokens_at_least", F.col("above_b_tokens") + F.sum("n_tokens").over(inside))
    return _answers(out.withColumn("context_limit", F.col("length")))


def at_limits(report: DataFrame, limits: list[int]) -> DataFrame:
    """The same answers for any limits: the sums of the smallest length that is not below a limit, zeros beyond the longest."""
    at_least = F.col("context_limit")
    found = [F.min(F.when(at_least >= c, F.struct("context_limit", "n_docs", "docs_at_least", "tokens_at_least"))).alias(f"l{k}") for k, c in enumerate(limits)]
    wide = report.agg(F.max("total_docs").alias("total_docs"), F.max("total_tokens").alias("total_tokens"), *found).where("total_docs is not null")
    zero = F.lit(0).cast("long")
    each = [
        F.struct(F.lit(c).cast("long").alias("context_limit"), F.when(F.col(f"l{k}.context_limit") == c, F.col(f"l{k}.n_docs")).otherwise(zero).alias("n_docs"), *(F.coalesce(F.col(f"l{k}.{x}"), zero).alias(x) for x in ("docs_at_least", "tokens_at_least")))
        for k, c in enumerate(limits)
    ]
    return _answers(wide.select("total_docs", "total_tokens", F.inline(F.array(*each))))


def quantiles(report: DataFrame, shares: list[float]) -> DataFrame:
    """share, and the answers for the smallest length that holds at least that share of the documents, exactly."""
    found = [F.min(F.when(F.col("share_fitting") >= float(s), F.struct(*COLUMNS))) for s in shares]
    each = F.array(*(F.struct(F.lit(float(s)).alias("share"), x.alias("at")) for s, x in zip(shares, found, strict=True)))
    return report.agg(each.alias("all")).select(F.inline("all")).where("at is not null").select("share", "at.*")
