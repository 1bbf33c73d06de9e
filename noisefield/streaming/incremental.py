"""Stacks that take in new days as they arrive.

The linear stack needs only sums and counts, so it is a streaming aggregate; `linear_updates` keeps it in Spark's state
store. `materialize` appends what each batch of new records adds to a table of sums, keyed by batch so that a batch that is
run again replaces its own part, and `stack_of` reads the stack from that table. Every few batches the sums so far are put together.

The phase-weighted stacks need their chunks too: `weighted_updates` keeps, for each pair and slot (and block of frequencies), the sums of the
closed chunks, the chunk that is still open and the time of the last record in Spark's state store. Records of a key come in the order of
time from batch to batch, in any order inside a batch; one that is not later than the last of its key is refused and counted as `late`, so that files that are
read twice change nothing. However the records are split into batches, the last update of a key is the stack of all its records.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.stack import KEYS as PAIR, Phases, PhaseSums, assemble
from ..sources import store

KEYS = ["path_id", "slot", "lag"]


def read_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 64) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def linear_updates(lags: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Running n and mean of each lag; lags: the keys and v."""
    return lags.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg("v").alias("v"))


def windowed_counts(events: DataFrame, time_col: str, late: str, size: str, *keys: str) -> DataFrame:
    """Records of each window of time; rows later than `late` are dropped. Times without a zone are read as UTC."""
    e = events.withColumn("_t", F.col(time_col).cast("timestamp"))
    return e.withWatermark("_t", late).groupBy(F.window("_t", size), *keys).agg(F.count(F.lit(1)).alias("n"))


def materialize_windows(counts: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Runs `windowed_counts` over all files there are, then stops; each batch leaves in `table`/batch=<id> the windows that it closed.

    A window is given out once, when the watermark has passed its end; rows that come after that are dropped, rows of a window that is still open
    count however late they are. Windows that are open at the end stay in the state store and go on with the next files."""

    def batch(df: DataFrame, number: int) -> None:
        df.write.mode("overwrite").parquet(f"{table}/batch={number}")

    return counts.writeStream.outputMode("append").foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windows_of(spark: SparkSession, table: str) -> DataFrame:
    """The windows that are closed."""
    return spark.read.parquet(table).drop("batch")


# Tables of sums ---------------------------------------------------------------------------------------------------


def _parts(spark: SparkSession, table: str) -> tuple[list[int], list[int]]:
    """The batches whose sums are whole, and the batches up to which sums have been put together, as folders name them."""
    held: dict[str, list[int]] = {"batch": [], "upto": []}
    for name in store.folders(spark, table):
        kind, _, number = name.partition("=")
        if kind in held and number.isdigit() and store.exists(spark, f"{table}/{name}/_SUCCESS"):
            held[kind].append(int(number))
    return sorted(held["batch"]), sorted(held["upto"])


def _sums(spark: SparkSession, table: str, most: int | None = None) -> DataFrame | None:
    """The sums that stand in the table, of batches up to `most`."""
    batches, upto = _parts(spark, table)
    ready = [k for k in upto if most is None or k <= most]
    names = ([f"upto={ready[-1]}"] if ready else []) + [f"batch={k}" for k in batches if k > (ready[-1] if ready else -1) and (most is None or k <= most)]
    return spark.read.parquet(*(f"{table}/{x}" for x in names)) if names else None


def _put_together(spark: SparkSession, table: str, number: int, keys: list[str]) -> None:
    """Writes the sums up to a batch as one part; what an earlier such part made needless is removed.

    A batch that is run again finds all that its own part was made from: only folders before the last part but this one go."""
    _, upto = _parts(spark, table)
    done = [k for k in upto if k < number]
    _sums(spark, table, number).groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("total").alias("total")).write.mode("overwrite").parquet(f"{table}/upto={number}")
    for name in store.folders(spark, table) if done else []:
        kind, _, k = name.partition("=")
        if k.isdigit() and (kind == "batch" and int(k) <= done[-1] or kind == "upto" and int(k) < done[-1]):
            store.remove(spark, f"{table}/{name}")


def materialize(lags: DataFrame, table: str, checkpoint: str, keys: list[str] = KEYS, every: int = 16) -> StreamingQuery:
    """Runs over all files there are, then stops; each batch leaves its sums in `table`/batch=<id>, every `every`-th the sums so far in `table`/upto=<id>."""

    def batch(df: DataFrame, number: int) -> None:
        sums = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("total"))
        sums.write.mode("overwrite").parquet(f"{table}/batch={number}")
        if number % every == every - 1:
            _put_together(df.sparkSession, table, number, keys)

    return lags.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stack_of(spark: SparkSession, table: str, keys: list[str] = KEYS) -> DataFrame:
    t = _sums(spark, table)
    if t is None:
        raise FileNotFoundError(f"no sums in {table}")
    return t.groupBy(*keys).agg(F.sum("n").alias("n"), (F.sum("total") / F.sum("n")).alias("v"))


# Weighted stacks --------------------------------------------------------------------------------------------------

_STATE = "n long, chunks int, late long, last {time}, open int, open_sum array<double>, total array<double>, re array<double>, im array<double>"
UPDATES = "path_id long, slot int, first int, n long, chunks int, data array<double>, late long"


def weighted_updates(records: DataFrame, how: Phases, size: int) -> DataFrame:
    """UPDATES of every key that a batch has records of; records: timestamp, path_id, slot, data. `chunks` counts the open one.

    The rows of the time-frequency stack are pieces: `assemble` makes stacks of them."""
    time = records.schema["timestamp"].dataType.simpleString()

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        sums = PhaseSums(how, int(key[2]))
        late, last, count, held = 0, None, 0, np.zeros(how.width)
        if state.exists:
            sums.n, sums.chunks, late, last, count, *arrays = state.get
            held, sums.total, re, im = (np.array(x, float) for x in arrays)
            sums.sums = (re + 1j * im).reshape(how.shape(sums.first))
        rows = pd.concat(list(frames))
        for at, x in sorted(zip(rows["timestamp"].tolist(), rows["data"], strict=True), key=lambda r: r[0]):
            if last is not None and at <= last:
                late += 1
                continue
            if len(x) != how.width:
                raise ValueError(f"records of {how.width} numbers are stacked, not of {len(x)}")
            last, count, held = at, count + 1, held + np.asarray(x, float)
            if count == size:
                sums.add(held[None], np.array([float(count)]))
                count, held = 0, np.zeros(how.width)
        flat = sums.sums.ravel()
        state.update((sums.n, sums.chunks, late, last, count, *(v.tolist() for v in (held, sums.total, flat.real, flat.imag))))
        if count:  # the open chunk counts in what is given out, not in what is kept
            sums.add(held[None], np.array([float(count)]))
        yield pd.DataFrame({"path_id": [key[0]], "slot": [key[1]], "first": [key[2]], "n": [sums.n], "chunks": [sums.chunks], "data": [sums.stack()], "late": [late]})

    sent = records.select("timestamp", *PAIR, F.explode(F.array(*map(F.lit, how.firsts))).alias("first"), F.col("data").cast("array<double>").alias("data"))
    return sent.groupBy(*PAIR, "first").applyInPandasWithState(update, UPDATES, _STATE.format(time=time), "update", GroupStateTimeout.NoTimeout)


def materialize_weighted(records: DataFrame, how: Phases, size: int, table: str, checkpoint: str) -> StreamingQuery:
    """Runs `weighted_updates` over all files there are, then stops; each batch leaves the rows of its keys in `table`/batch=<id>."""

    def batch(df: DataFrame, number: int) -> None:
        df.write.mode("overwrite").parquet(f"{table}/batch={number}")

    return weighted_updates(records, how, size).writeStream.outputMode("update").foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def weighted_stack_of(spark: SparkSession, table: str, how: Phases) -> DataFrame:
    """path_id, slot, n, chunks and data: of each key what its last batch gave."""
    t = spark.read.parquet(table)
    last = t.groupBy(*PAIR, "first").agg(F.max_by(F.struct("n", "chunks", "data", "late"), "batch").alias("x")).select(*PAIR, "first", "x.*")
    return assemble(last, how) if len(how.firsts) > 1 else last.drop("first", "late")
