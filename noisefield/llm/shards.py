"""Two-pass external shuffle into shards.

First pass: a seeded hash of a record's columns scatters the records uniformly over buckets that fit a task's memory. Second
pass: each bucket is shuffled by Fisher and Yates' method and written. The draws are hashes of (seed, bucket, step), and a
bucket's records are first put in the order of their hashes, so the result depends on the records, the seed and
the number of shards alone, not on partitions or on which task runs. Buckets follow one another; the sequence is cut into runs
of equal length, the shards, whose row counts differ by at most one (law `rows`). Only DataFrame operations are used.

Scale: records are shuffled once. A task writes whole buckets, so a shard is made of many files of bounded size, each a run
of slots. Buckets are sized by bytes and by rows. Records that are equal in all columns, maps too, are copies of one another (by 128 bits of
hash): where they are more than a bucket holds, one of them is read and its copies are dealt to buckets by number. Shuffling a
bucket of n records costs n times the square root of n.

Edge cases: nulls hash like any value; a null text has size 1 and the check sum of no bytes; a record with a very long text
fills its bucket; repeated rows get a slot each; an empty table gives no rows; a record travels as one struct, so column names cannot
clash.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window, functions as F

from ._store import BROADCAST_FACTS, hashable, keep, shared_dir

#: Bytes and records of a bucket, on average.
BUCKET_BYTES, BUCKET_ROWS = 8 << 20, 2000
#: Bytes of records that a task shuffles and writes, on average.
TASK_BYTES = 64 << 20
#: Copies of a record that one array lists.
_RUN = 1_000_000
#: Buckets whose offsets one task sums.
_BLOCK = 1024


def record_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def offsets(counts: DataFrame, key: str, n: str) -> DataFrame:
    """Rows before each key, summed over blocks of keys and then inside each block."""
    c = counts.withColumn("block", F.floor(F.col(key) / _BLOCK))
    blocks = c.groupBy("block").agg(F.sum(n).alias("held"))
    before = Window.partitionBy(F.lit(0)).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("block", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("block").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return c.join(blocks, "block").select(key, n, (F.col("ahead") + F.coalesce(F.sum(n).over(inside), F.lit(0))).alias("offset"))


def fisher_yates(n: Column, *seed: Column) -> Column:
    """A permutation of 0 .. n - 1: step i puts i at a place drawn from 0 .. i, and what was there at the end.

    The places are held in runs of about the square root of n, so a step copies two runs and not all places."""
    run = F.ceil(F.sqrt(F.greatest(n, F.lit(1)))).cast("int")

    def step(out: Column, i: Column) -> Column:
        j = F.pmod(F.xxhash64(*seed, i), i + 1).cast("int")
        held, at = F.floor(j / run).cast("int"), F.pmod(j, run)
        put = lambda x: F.concat(F.slice(x, F.lit(1), at), F.array(i), F.slice(x, at + 2, run))
        swapped = F.when(j == i, out).otherwise(F.concat(F.slice(out, F.lit(1), held), F.array(put(F.get(out, held))), F.slice(out, held + 2, run + 1)))
        last = F.array(F.when(j == i, i).otherwise(F.get(F.get(out, held), at)))
        longer = F.concat(F.slice(swapped, F.lit(1), F.size(swapped) - 1), F.array(F.concat(F.element_at(swapped, -1), last)))
        return F.when(F.pmod(i, run) == 0, F.concat(swapped, F.array(last))).otherwise(longer)

    return F.aggregate(F.sequence(F.lit(0), n.cast("int") - 1), F.array().cast("array<array<int>>"), step, F.flatten)


def two_pass(docs: DataFrame, shards: int = 16, seed: int = 7, text_col: str = "text", bucket_bytes: int = BUCKET_BYTES, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """record (a struct of the columns of docs), shard and slot of each row, in tasks of whole buckets."""
    plain = [hashable(f) for f in docs.schema.fields]
    rows = docs.select(F.struct("*").alias("record"), record_size(F.col(text_col)).alias("size"), F.xxhash64(F.lit(1), *plain).alias("k1"), F.xxhash64(F.lit(2), *plain).alias("k2"))
    count, total = rows.agg(F.count(F.lit(1)), F.sum("size")).first()
    buckets = max(1, -(-(total or 0) // bucket_bytes), -(-count // bucket_rows))
    key = ["k1", "k2"]
    hot = keep(rows.groupBy(*key).agg(F.count(F.lit(1)).cast("long").alias("n")).where(F.col("n") > bucket_rows))
    spread, n_hot = rows.withColumn("copy", F.lit(0).cast("long")), hot.count()
    if n_hot:
        hot = F.broadcast(hot) if n_hot <= BROADCAST_FACTS else hot
        runs = F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / _RUN).cast("long"))
        one = rows.join(hot, key).dropDuplicates(key).withColumn("run", F.explode(runs))
        copy = F.explode(F.sequence(F.col("run") * _RUN, F.least(F.col("n"), (F.col("run") + 1) * _RUN) - 1))
        spread = spread.join(hot, key, "left_anti").unionByName(one.withColumn("copy", copy).select(spread.columns))
    spread = spread.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), *key, "copy"), F.lit(buckets)))
    plan = offsets(spread.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")), "bucket", "n")
    plan = plan.select("bucket", "offset", fisher_yates(F.col("n"), F.lit(seed), F.col("bucket")).alias("places"))
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), (total or 0) // TASK_BYTES)
    order = Window.partitionBy("bucket").orderBy(*key, "copy")
    dealt = spread.repartition(tasks, "bucket").withColumn("at", F.row_number().over(order) - 1)
    placed = dealt.join(plan.repartition(tasks, "bucket"), "bucket").select("record", (F.col("offset") + F.get("places", F.col("at"))).alias("place"))
    # shard s holds the places from s * count // shards on
    shard = F.expr(f"cast(((place + 1) * {shards} - 1) div {max(count, 1)} as int)")
    start = F.expr(f"(shard * {count}L) div {shards}")
    return placed.withColumn("shard", shard).select("record", "shard", (F.col("place") - start).cast("long").alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = 16, seed: int = 7, text_col: str = "text", **sizes: int) -> DataFrame:
    """Writes the shards below path, a folder a shard; each file holds records with runs of slots, in order. Returns them read again."""
    out = two_pass(docs, shards, seed, text_col, **sizes)
    out.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    schema = f"record {out.schema['record'].dataType.simpleString()}, slot long, shard int"
    return docs.sparkSession.read.schema(schema).parquet(path)


def shard_documents(docs: DataFrame, shards: int = 16, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", **sizes: int) -> DataFrame:
    """Writes the documents to shards in the session's shared folder; returns id, size, text_crc32, shard and slot as read from the files."""
    files = write_shards(docs.select(id_col, text_col), f"{shared_dir(docs.sparkSession)}/shards-{uuid.uuid4().hex}", shards, seed, text_col, **sizes)
    text = F.col(f"record.{text_col}")
    return files.select(F.col(f"record.{id_col}").alias(id_col), record_size(text).alias("size"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), "shard", "slot")
