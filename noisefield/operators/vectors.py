"""Sums and means of equally long arrays by key.

Short arrays are aggregated number by number inside the JVM. For long ones that would write out an aggregate for each
number, so batches are summed by key in numpy first and only those partial sums are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Longest array that is aggregated number by number.
JVM_WIDTH = 128


def lists(rows: np.ndarray) -> pa.ListArray:
    """Rows of numbers as an array column."""
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32()), pa.array(np.ascontiguousarray(rows).ravel()))


def rows_of(batch: pa.RecordBatch, column: str) -> np.ndarray:
    """An array column of equal lengths as rows of numbers."""
    return np.asarray(batch.column(column).flatten().to_numpy(zero_copy_only=False), float).reshape(len(batch), -1)


def _same_width(column: str, width: int):
    """The column, or an error for the first array of another length."""
    wrong = F.concat(F.lit(f"{column}: arrays of {width} numbers are summed, not of "), F.size(column).cast("string"))
    return F.when(F.assert_true(F.size(column) == width, wrong).isNull(), F.col(column)).alias(column)


def sum_arrays(df: DataFrame, keys: list[str], width: int, count: str, column: str = "data") -> DataFrame:
    """keys, count (rows of the key) and the sum of the arrays; an array of another length than `width` is an error."""
    df = df.select(*keys, _same_width(column, width))
    if width <= JVM_WIDTH:
        sums = [F.sum(F.col(column)[k]).alias(f"v{k}") for k in range(width)]
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count), *sums).select(*keys, count, F.array(*(f"v{k}" for k in range(width))).alias(column))
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join(f"`{k}` {types[k]}" for k in keys) + f", {count} long, {column} array<double>"

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            group = pd.MultiIndex.from_arrays([b.column(k).to_pandas() for k in keys])
            codes, _ = pd.factorize(group)
            rows = rows_of(b, column)
            order = np.argsort(codes, kind="stable")
            begin = np.flatnonzero(np.r_[True, np.diff(codes[order]) > 0])
            sums = np.add.reduceat(rows[order], begin, axis=0)
            first = pa.array(order[begin])
            yield pa.RecordBatch.from_arrays([*(b.column(k).take(first) for k in keys), pa.array(np.diff(np.r_[begin, len(b)]), pa.int64()), lists(sums)], [*keys, count, column])

    def final(t: pd.DataFrame) -> pd.DataFrame:
        out = t[keys].iloc[:1].copy()
        out[count] = t[count].sum()
        out[column] = [np.sum(np.stack(t[column].to_numpy()), axis=0)]
        return out

    return df.select(*keys, column).mapInArrow(partial, schema).groupBy(*keys).applyInPandas(final, schema)


def mean_arrays(df: DataFrame, keys: list[str], width: int, count: str, column: str = "data") -> DataFrame:
    """keys, count and the mean of the arrays."""
    s = sum_arrays(df, keys, width, count, column)
    return s.withColumn(column, F.transform(column, lambda v: v / F.col(count)))
