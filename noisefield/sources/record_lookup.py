"""Large record indexes laid out for finding one record: a lookup opens few files and reads few row groups of them.

Rows are clustered by (timestamp, source, receiver): a folder for each day, files that are ranges of that order, rows sorted inside them.
A lookup with a time is pruned to a folder, then by the least and greatest time of each row group; one without goes by the bloom filters of
the two stations' names. What is appended later is clustered in itself, so an index grows by its new rows alone.

Edge cases: times that cannot be read (of a stack, say) and null ones share the folder `none`; rows with a null station are kept and never found by name;
equal rows are all kept and all found; other columns are carried, one named like those below is an error; an empty index finds nothing.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators import lookup
from ..operators.inventory import read_time
from . import store

#: Bytes of a row group: what a lookup reads at least.
GROUP_BYTES = 8 << 20
#: Bytes that a row of an index has at least once it is written; from it the bloom filters get their size.
LEAST_ROW_BYTES = 64
#: Columns that are added. The first names the folders.
KEYS = ("index_day", "index_time", "index_pair")
DAY = "yyyyMMdd"


def _day(time_name: Column, grain: str) -> Column:
    """The folder of a time as `lookup.safe_name` writes it."""
    return F.concat(F.lit("d"), F.coalesce(F.date_format(read_time(F.translate(time_name, "_", ":")), grain), F.lit("none")))


def _pair(src: Column, rec: Column) -> Column:
    return F.concat(src, F.lit("|"), rec)


def write(index: DataFrame, path: str, mode: str = "append", grain: str = DAY, group_bytes: int = GROUP_BYTES) -> None:
    """Writes, or adds, the rows of a record index: timestamp, src_station, rec_station and any others.

    grain: pattern of the time that names a folder; the same one is given to `find`."""
    clash = set(KEYS) & {c.lower() for c in index.columns}
    if clash:
        raise ValueError(f"the record index has columns of its own named {', '.join(sorted(clash))}")
    name = lookup.safe_name(F.col("timestamp").cast("string"))
    t = index.withColumns({"index_day": _day(name, grain), "index_time": name, "index_pair": _pair(F.col("src_station"), F.col("rec_station"))})
    order = [*KEYS, *(c for c in ("src_component", "rec_component", "record_path", "record_offset") if c in t.columns)]
    out = t.repartitionByRange(*order).sortWithinPartitions(*order).write.mode(mode).partitionBy("index_day")
    out = out.option("parquet.block.size", group_bytes).option("parquet.bloom.filter.enabled#index_pair", "true")
    out.option("parquet.bloom.filter.expected.ndv#index_pair", max(group_bytes // LEAST_ROW_BYTES, 1)).parquet(path)


def is_lookup(spark: SparkSession, path: str) -> bool:
    """Whether a folder was written by `write`."""
    return not path.endswith((".tsv", ".txt")) and any(x.startswith("index_day=") for x in store.folders(spark, path))


def find(spark: SparkSession, path: str, timestamp: str | None, src: str, rec: str, component_pair: str, allow_reverse: bool = False, grain: str = DAY, **more: str | None) -> DataFrame:
    """The rows that `lookup.extract` finds in the index, by the same rules."""
    t = spark.read.parquet(path)
    ends = [(src, rec), (rec, src)] if allow_reverse else [(src, rec)]
    t = t.where(F.col("index_pair").isin(sorted({"|".join(x) for x in ends})))
    if timestamp is not None:
        name = re.sub("[^0-9A-Za-z._:-]+", "-", timestamp).replace(":", "_")
        t = t.where((F.col("index_day") == _day(F.lit(name), grain)) & (F.col("index_time") == name))
    return lookup.extract(t, timestamp, src, rec, component_pair, allow_reverse, **more).drop(*KEYS)
