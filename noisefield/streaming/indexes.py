"""The record index of each timestamp, written once when the timestamp is finished.

Rows of a stream are records (timestamp, path_id, slot, record_path, record_offset, bytes) and marks (timestamp, expected): a mark says how many
records, counted by pair and slot, a timestamp has. Both may come in any order, over any number of batches. A timestamp is finished when its mark is there
and as many different records; the batch that sees this writes its index, ordered by pair and slot, and closes it.

Rules: of records that repeat a pair and slot the one with the least (record_path, record_offset) stays, and `repeated` counts the others;
more different records than the mark said are all indexed and counted in `surplus`; rows of a timestamp that is closed are refused and kept
apart, so an index never changes; a timestamp without its mark or without all its records stays open, and `unfinished` says what it lacks;
of several marks of an open timestamp the largest counts; a timestamp that expects no records is closed with an empty index; rows
without a timestamp are refused.

Folders: pending/batch=, index/built=, refused/batch=, closed/built=. A batch that runs again writes the same folders anew; its table in
`closed` comes last and is what counts. Nothing is collected but folder numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources import store

SCHEMA = "timestamp string, path_id long, slot int, record_path string, record_offset long, bytes long, expected long"
KEY = ["timestamp", "path_id", "slot"]
CLOSED = "timestamp string, records long, repeated long, surplus long, built int"


def _numbers(spark: SparkSession, folder: str, kind: str) -> list[int]:
    """Numbers of the whole tables of a kind."""
    found = [x.partition("=")[2] for x in store.folders(spark, f"{folder}/{kind}")]
    return sorted(int(k) for k in found if k.isdigit() and store.exists(spark, f"{folder}/{kind}/{_part(kind)}={k}/_SUCCESS"))


def _part(kind: str) -> str:
    return "built" if kind in ("index", "closed") else "batch"


def _read(spark: SparkSession, folder: str, kind: str, schema: str, numbers: list[int]) -> DataFrame:
    part = _part(kind)
    if not numbers:
        return spark.createDataFrame([], f"{schema}, {part} int" if f"{part} int" not in schema else schema)
    plain = schema.replace(f", {part} int", "")
    return spark.read.option("basePath", f"{folder}/{kind}").schema(f"{plain}, {part} int").parquet(*(f"{folder}/{kind}/{part}={k}" for k in numbers))


def closed(spark: SparkSession, folder: str, before: int | None = None) -> DataFrame:
    """CLOSED, a row for each finished timestamp."""
    return _read(spark, folder, "closed", CLOSED, [k for k in _numbers(spark, folder, "closed") if before is None or k < before])


def _counts(rows: DataFrame) -> DataFrame:
    """timestamp, expected (null without a mark), records (different ones) and all_records."""
    return rows.groupBy("timestamp").agg(F.max("expected").alias("expected"), F.count_distinct("path_id", "slot").alias("records"), F.count(F.when(F.col("expected").isNull(), 1)).alias("all_records"))


def _batch(folder: str, tidy_every: int):
    def batch(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        df.write.mode("overwrite").parquet(f"{folder}/pending/batch={number}")
        mine = _read(spark, folder, "pending", SCHEMA, [number])
        done = closed(spark, folder, number).select("timestamp")
        refused = mine.join(done, "timestamp", "left_semi").unionByName(mine.where("timestamp is null"))
        refused.drop("batch").write.mode("overwrite").parquet(f"{folder}/refused/batch={number}")
        held = _read(spark, folder, "pending", SCHEMA, [k for k in _numbers(spark, folder, "pending") if k <= number])
        touched = mine.select("timestamp").distinct().join(done, "timestamp", "left_anti")
        rows = held.join(touched, "timestamp", "left_semi")
        ready = _counts(rows).where("records >= expected")
        best = F.min(F.struct("record_path", "record_offset", "bytes"))
        index = rows.where("expected is null").join(ready.select("timestamp"), "timestamp", "left_semi").groupBy(*KEY).agg(best.alias("r")).select(*KEY, "r.*")
        index.repartitionByRange(*KEY).sortWithinPartitions(*KEY).write.mode("overwrite").parquet(f"{folder}/index/built={number}")
        last = ready.select("timestamp", "records", (F.col("all_records") - F.col("records")).alias("repeated"), (F.col("records") - F.col("expected")).alias("surplus"))
        last.write.mode("overwrite").parquet(f"{folder}/closed/built={number}")
        if number % tidy_every == tidy_every - 1:
            tidy(spark, folder, number)

    return batch


def tidy(spark: SparkSession, folder: str, before: int) -> None:
    """Removes pending rows of batches before one, if all their timestamps were closed by batches before it; a batch that runs again does not need them."""
    numbers = [k for k in _numbers(spark, folder, "pending") if k < before]
    rows = _read(spark, folder, "pending", SCHEMA, numbers).where("timestamp is not null")
    needed = {r.batch for r in rows.join(closed(spark, folder, before).select("timestamp"), "timestamp", "left_anti").select("batch").distinct().collect()}  # folder numbers
    for k in set(numbers) - needed:
        store.remove(spark, f"{folder}/pending/batch={k}")


def materialize(rows: DataFrame, folder: str, checkpoint: str, tidy_every: int = 16) -> StreamingQuery:
    """Takes in all rows of SCHEMA there are, batch by batch, then stops."""
    return rows.writeStream.foreachBatch(_batch(folder, tidy_every)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def index_of(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all finished timestamps: timestamp, path_id, slot, record_path, record_offset, bytes."""
    schema = SCHEMA.replace(", expected long", "")
    return _read(spark, folder, "index", schema, _numbers(spark, folder, "closed")).drop("built")


def refused(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that came after their timestamp was closed, or without one."""
    return _read(spark, folder, "refused", SCHEMA, _numbers(spark, folder, "refused"))


def unfinished(spark: SparkSession, folder: str) -> DataFrame:
    """timestamp, expected (null: no mark yet), records, first_batch of the timestamps that are not closed."""
    rows = _read(spark, folder, "pending", SCHEMA, _numbers(spark, folder, "pending")).where("timestamp is not null").join(closed(spark, folder).select("timestamp"), "timestamp", "left_anti")
    return _counts(rows).drop("all_records").join(rows.groupBy("timestamp").agg(F.min("batch").alias("first_batch")), "timestamp")


def finish(spark: SparkSession, folder: str) -> dict[str, int]:
    """Marks the whole folder as done and returns its counts; a timestamp that is not finished is an error, and then there is no mark."""
    left = unfinished(spark, folder)
    some = left.orderBy("timestamp").limit(3).collect()
    if some:
        store.remove(spark, f"{folder}/_SUCCESS")
        raise ValueError(f"{left.count()} timestamps are not finished, among them {', '.join(f'{r.timestamp} ({r.records} of {r.expected})' for r in some)}")
    facts = closed(spark, folder).agg(F.count(F.lit(1)).alias("timestamps"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("records", "repeated", "surplus"))).first().asDict()
    facts["refused"] = refused(spark, folder).count()
    store.write_text(spark, f"{folder}/_SUCCESS", "".join(f"{k}\t{v}\n" for k, v in facts.items()))
    return facts
