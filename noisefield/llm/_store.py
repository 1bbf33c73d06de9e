"""Where intermediate results go: the folder that the session's cluster names; and joins that a hot key does not slow down."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField

#: Keys whose facts are broadcast because each of them has more than one in so many of all rows; so there are no more of them.
MOST_HOT = 2000
#: Rows below which a key is never hot.
LEAST_HOT = 500
#: Facts (slim rows) that are broadcast as a whole.
BROADCAST_FACTS = 50_000


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; a temporary one only where none is set and the session runs on one machine."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
            spark.sparkContext.setCheckpointDir(named)
        return named
    known = spark.sparkContext._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get()
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    made = tempfile.mkdtemp(prefix="noisefield-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def keep(df: DataFrame, replaces: DataFrame | None = None) -> DataFrame:
    """The frame computed once into a Parquet table in the shared folder, its lineage cut there.

    The table stays, since later stages may read it again after an executor is lost; `replaces`, an earlier table that only
    this one was made from, is removed once this one is whole."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/kept-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._kept = path
    if replaces is not None:
        old = spark._jvm.org.apache.hadoop.fs.Path(replaces._kept)
        old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)
    return out


def hashable(field: StructField) -> Column:
    """A column as hash functions take it: one with maps inside as JSON, in which every value and null stands."""
    column = F.col(f"`{field.name}`")
    return F.to_json(F.struct(column), {"ignoreNullFields": "false"}) if "map<" in field.dataType.simpleString() else column


def attach(rows: DataFrame, facts: DataFrame, keys: list[str], size: str) -> DataFrame:
    """rows joined (inner) with facts, slim rows that hold each key once and in `size` its number of rows.

    Few facts are broadcast. Of many, a key with more than one in `MOST_HOT` of all rows would fill one task of a shuffled join;
    the facts of such keys, at most `MOST_HOT`, are broadcast, those of the others are not."""
    n, total = facts.agg(F.count(F.lit(1)), F.sum(size)).first()
    if n <= BROADCAST_FACTS:
        return rows.join(F.broadcast(facts), keys)
    hot = F.col(size) > max(LEAST_HOT, total // MOST_HOT)
    many = F.broadcast(facts.where(hot))
    others = rows.join(many.select(*keys), keys, "left_anti")
    return others.join(facts.where(~hot), keys).unionByName(rows.join(many, keys))
