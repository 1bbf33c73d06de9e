"""Linear stacks over the records of several runs, from a table that is laid out for it.

`bucket_records` writes the records of each run once, bucketed by pair and slot and sorted by time, into one table; later runs can be appended. A
bucket then holds files of every run, and `merged_stack` reads them in one task, so nothing is exchanged, and a task streams through
the records of one pair and slot after another. (A union of a table a run would not do: Spark 4.1 trusts such a union to be aligned by buckets, which
it is not where scans are columnar.) The first record in time (then by place) lends the stack its header. Records of a stack that
differ in length or in sampling interval are an error that names the record.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .vectors import lists

KEYS = ["path_id", "slot"]
COLUMNS = [*KEYS, "timestamp", "record_path", "record_offset", "delta", "head", "data"]
#: Sampling intervals that far apart are the same. Fixed value.
CLOSE_DELTA = 1e-7


def bucket_records(runs: list[DataFrame], name: str, folder: str, buckets: int = 64, append: bool = False) -> DataFrame:
    """Writes the records of each run (COLUMNS; head: header fields in JSON or null) into the table `name` in a folder, anew or after those that it has."""
    for k, records in enumerate(runs):
        rows = records.select("path_id", F.col("slot").cast("int").alias("slot"), F.col("timestamp").cast("timestamp").alias("timestamp"), "record_path", F.col("record_offset").cast("long").alias("record_offset"), F.col("delta").cast("double").alias("delta"), "head", F.col("data").cast("array<double>").alias("data"))
        rows.repartition(buckets, *KEYS).write.mode("append" if append or k else "overwrite").bucketBy(buckets, *KEYS).sortBy(*KEYS, "timestamp").option("path", folder).saveAsTable(name)
    return runs[0].sparkSession.table(name)


def merged_stack(table: DataFrame) -> DataFrame:
    """path_id, slot, n, delta, first_timestamp, head (of the first record) and the mean of the records of all runs in a table of `bucket_records`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n, first, delta, keys = None, 0, None, 0.0, None
        for b in batches:
            if not len(b):
                continue
            data, each = b.column("data"), b.column("delta").to_numpy(zero_copy_only=False)
            size = np.diff(data.offsets.to_numpy())
            if total is None:
                keys, delta, total = [b.column(c).slice(0, 1) for c in KEYS], each[0], np.zeros(size[0])
            wrong = np.flatnonzero((size != len(total)) | ~(np.abs(each - delta) <= CLOSE_DELTA))
            if len(wrong):
                k = int(wrong[0])
                raise ValueError(f"{b.column('record_path')[k]}: {size[k]} numbers {each[k]:g} s apart cannot be stacked with {len(total)} numbers {delta:g} s apart")
            total = total + data.flatten().to_numpy().reshape(len(b), -1).sum(axis=0)
            n += len(b)
            order = pa.table({c: b.column(c) for c in ("timestamp", "record_path", "record_offset", "head")}).sort_by([(c, "ascending") for c in ("timestamp", "record_path", "record_offset")]).slice(0, 1)
            place = tuple((x.as_py() is None, x.as_py()) for x in (order.column(c)[0] for c in ("timestamp", "record_path", "record_offset")))
            if first is None or place < first[0]:
                first = (place, order.combine_chunks())
        if total is not None:
            yield pa.RecordBatch.from_arrays([*keys, pa.array([n], pa.int64()), pa.array([delta]), first[1].column("timestamp").combine_chunks(), first[1].column("head").combine_chunks(), lists((total / n)[None])], [*KEYS, "n", "delta", "first_timestamp", "head", "data"])

    return table.select(COLUMNS).groupBy(*KEYS).applyInArrow(run, "path_id long, slot int, n long, delta double, first_timestamp timestamp, head string, data array<double>")
