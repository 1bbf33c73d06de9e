"""Text tables: station coordinates, station lists, time lists, tables of allowed pairs, and the tables of a finished run."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.inventory import read_time, time_text
from ..operators.lookup import id_text
from ..operators.pairs import ID_BASE
from . import store

# The columns of a record index file, in its order.
INDEX_COLUMNS = (
    "timestamp path_id component_slot source_key receiver_key src_id rec_id src_network src_station src_location src_component rec_network rec_station rec_location "
    "rec_component npts dt dist az baz record_path record_offset bytes storage_kind final_pair_path"
).split()
_NUMBERS = {"path_id": "long", "component_slot": "int", "src_id": "int", "rec_id": "int", "npts": "int", "dt": "double", "dist": "double", "az": "double", "baz": "double", "record_offset": "long", "bytes": "long"}


def _tsv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True)


def require_columns(df: DataFrame, names: list[str], what: str) -> DataFrame:
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks the columns {', '.join(missing)}")
    return df


def station_coordinates(spark: SparkSession, path: str) -> DataFrame:
    """station, network, location, lat, lon, ele; a station given twice is an error."""
    t = require_columns(_tsv(spark, path), ["station"], "the coordinate table")

    def either(*names: str):
        held = [F.col(c).cast("double") for c in names if c in t.columns]
        if not held:
            raise ValueError(f"the coordinate table lacks {' or '.join(names)}")
        return F.coalesce(*held)

    text = lambda c: F.nullif(F.trim(F.col(c)), F.lit("")) if c in t.columns else F.lit(None).cast("string")
    out = t.select(F.trim("station").alias("station"), text("network").alias("network"), text("location").alias("location"), either("lat", "latitude").alias("lat"), either("lon", "longitude").alias("lon"), (either("ele", "elevation") if {"ele", "elevation"} & set(t.columns) else F.lit(None).cast("double")).alias("ele"))
    twice = out.groupBy("station", "network", "location").count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"the coordinate table names {twice[0]['station']} more than once")
    return out


def listed(spark: SparkSession, path: str, name: str = "station") -> DataFrame:
    """One value a line; blank lines and those from # on are skipped."""
    t = spark.read.text(path).select(F.trim("value").alias(name))
    return t.where((F.col(name) != "") & ~F.col(name).startswith("#")).distinct()


def times(spark: SparkSession, path: str) -> DataFrame:
    t = listed(spark, path, "text").withColumn("timestamp", read_time(F.col("text")))
    return t.select("timestamp", F.assert_true(F.col("timestamp").isNotNull(), F.concat(F.lit("not a time: "), "text")).alias("_")).drop("_")


# The columns of a table of allowed pairs, the shorter form without the angle, and the kilometres of a degree that it is then taken from.
PAIR_COLUMNS = "path_id src_id rec_id src_group rec_group gcarc_deg distance_km azimuth_deg back_azimuth_deg".split()
KM_A_DEGREE = 111.195
#: Why a line of such a table is not used.
PAIR_FAULTS = ("short", "malformed", "not_canonical")
PAIR_SCHEMA = "path_id long, src_id long, rec_id long, src_group string, rec_group string, gcarc_deg double, distance_km double, azimuth_deg double, back_azimuth_deg double"


def parse_pairs(lines: DataFrame, column: str = "value", base: int = ID_BASE) -> DataFrame:
    """Lines of a table of allowed pairs as PAIR_SCHEMA and `fault`, null where the pair may be used.

    Fields are parted by tabs, of which several in a row count as one. Nine fields are PAIR_COLUMNS; eight lack the angle. Blank lines, comments from
    # on and the header are no rows. `short` lines have fewer fields; in `malformed` ones a number cannot be read; of pairs that are
    `not_canonical` the id is not src * base + rec, or not above 0, or the source has the larger number."""
    line = F.rtrim(F.translate(F.col(column), "\r", ""))
    rows = lines.where((F.trim(line) != "") & ~line.startswith("#") & ~line.startswith("path_id")).select(F.filter(F.split(line, "\t+"), lambda x: x != "").alias("f"))
    n = F.size("f")
    number = lambda k, kind: F.expr(f"try_cast(trim(get(f, {k})) as {kind})")
    last = lambda back: F.try_element_at("f", F.when(n >= 9, 10 - back).otherwise(9 - back)).try_cast("double")
    read = rows.select(
        n.alias("n"), *(number(k, "bigint").alias(c) for k, c in enumerate(PAIR_COLUMNS[:3])), *(F.get("f", k).alias(c) for k, c in enumerate(PAIR_COLUMNS[3:5], 3)),
        F.when(n >= 9, number(5, "double")).otherwise(last(3) / KM_A_DEGREE).alias("gcarc_deg"), *(last(3 - k).alias(c) for k, c in enumerate(PAIR_COLUMNS[6:])),
    )
    unread = F.greatest(*(F.col(c).isNull() for c in PAIR_COLUMNS))
    canonical = (F.col("path_id") > 0) & (F.col("src_id") <= F.col("rec_id")) & (F.col("rec_id") < base) & (F.col("path_id") == F.col("src_id") * base + F.col("rec_id"))
    fault = F.when(F.col("n") < 8, PAIR_FAULTS[0]).when(unread, PAIR_FAULTS[1]).when(~canonical, PAIR_FAULTS[2])
    return read.select(*PAIR_COLUMNS, fault.alias("fault"))


def allowed_pairs(parsed: DataFrame) -> DataFrame:
    """The pairs that may be used, each once; of lines with one id that with the least values stays."""
    least = F.min(F.struct(*PAIR_COLUMNS[3:]))
    return parsed.where("fault is null").groupBy(*PAIR_COLUMNS[:3]).agg(least.alias("_x")).select(*PAIR_COLUMNS[:3], "_x.*")


def pair_faults(parsed: DataFrame) -> DataFrame:
    """fault, lines; a row for every fault, also where there is none of it."""
    each = F.array(*(F.struct(F.lit(x).alias("fault"), F.count_if(F.col("fault") == x).alias("lines")) for x in PAIR_FAULTS))
    return parsed.agg(each.alias("x")).select(F.inline("x"))


def find_pairs(asked: DataFrame, allowed: DataFrame, src: str = "src_id", rec: str = "rec_id", base: int = ID_BASE) -> DataFrame:
    """The rows of `asked` whose two stations are an allowed pair in either order: path_id, its geometry, and `reversed` where it is the other way round.

    Both orders have one canonical id, so this is one equi-join."""
    a, b = F.col(src).cast("long"), F.col(rec).cast("long")
    key = F.least(a, b) * base + F.greatest(a, b)
    own = [c for c in PAIR_COLUMNS[5:] if c not in asked.columns]
    return asked.withColumn("path_id", key).join(allowed.select("path_id", *own), "path_id").withColumn("reversed", a > b)


def pair_file(spark: SparkSession, path: str, base: int = ID_BASE) -> DataFrame:
    """`parse_pairs` of a file or folder."""
    return parse_pairs(spark.read.text(path), base=base)


def found_indexes(spark: SparkSession, place: str, name: str = "record_index.tsv") -> list[str]:
    """The record indexes at a place: a file of that kind itself, one in the folder, or one in each folder below; a list file (.txt) names them a line each."""
    if place.endswith(".txt"):
        base = place.rpartition("/")[0]
        found = [r.text if "/" == r.text[:1] or "://" in r.text else f"{base}/{r.text}" for r in listed(spark, place, "text").collect()]  # names of files
    elif place.endswith(".tsv"):
        found = [place]
    else:
        files = store.listed(place, f"/{name}")
        own = [x for x in files if x.rpartition("/")[0].rstrip("/").endswith(place.rpartition("://")[2].rstrip("/"))]
        found = own or files
    if not found:
        raise FileNotFoundError(f"no {name} in {place}")
    return sorted(found)


def record_index(spark: SparkSession, paths: str | list[str], strict: bool = True) -> DataFrame:
    """The record indexes of one run or several, as one table of INDEX_COLUMNS.

    Rows whose numbers cannot be read, or without a record path or with an offset below 0, are an error; where not `strict` they are left out."""
    t = require_columns(_tsv(spark, paths), INDEX_COLUMNS, "the record index")
    read = t.select(*(F.expr(f"try_cast(trim(`{c}`) as {_NUMBERS[c]})").alias(c) if c in _NUMBERS else F.col(c) for c in INDEX_COLUMNS))
    good = F.col("record_path").isNotNull() & (F.col("record_offset") >= 0) & F.col("path_id").isNotNull() & F.col("component_slot").between(0, 8) & (F.col("bytes") > 0)
    if not strict:
        return read.where(good)
    checked = F.assert_true(F.coalesce(good, F.lit(False)), F.concat_ws(" ", F.lit("the record index has a row that cannot be read:"), F.col("timestamp"), F.col("record_path")))
    return read.where(checked.isNull())


def write_tsv(df: DataFrame, path: str, floats: str = "%.7g", mode: str = "errorifexists", *folders: str) -> None:
    """Tab-separated with a header; floats with seven digits, nulls empty; a folder for each value of the columns `folders`."""
    cols = [F.when(F.col(c).isNotNull(), F.format_string(floats, F.col(c))).alias(c) if t in ("float", "double") else F.col(c) for c, t in df.dtypes]
    df.select(*cols).write.mode(mode).partitionBy(*folders).csv(path, sep="\t", header=True, emptyValue="")


def write_catalog(stations: DataFrame, pairs: DataFrame, channels: DataFrame, path: str) -> None:
    """What a run has planned as text: stations.tsv; pairs.tsv, which another run can be given as its pair table; pair_ids.txt; and of the channels in a
    pair manifests.tsv, a folder for each timestamp, rows in the order of station, component (E, N, Z, others) and path, with timestamps.tsv as its index.

    Pairs without coordinates stand there with empty fields, which a reader of pair tables counts as short lines."""
    name = F.concat_ws(".", "group", "network", "station", F.coalesce("location", F.lit("")))
    number = lambda c: id_text(F.col(c), 4).alias(c)
    put = lambda df, to, *folders: write_tsv(df, f"{path}/{to}", "%.7g", "overwrite", *folders)
    put(stations.select(number("nsl_id"), "group", "network", "station", "location", "lat", "lon", "path").orderBy("nsl_id"), "stations.tsv")
    named = stations.select("nsl_id", name.alias("_name"))  # at most 9999 stations
    for end in ("src", "rec"):
        pairs = pairs.drop(f"{end}_group").join(F.broadcast(named.withColumnsRenamed({"nsl_id": f"{end}_id", "_name": f"{end}_group"})), f"{end}_id")
    text_id = id_text(F.col("path_id"), 8)
    put(pairs.select(text_id.alias("path_id"), number("src_id"), number("rec_id"), *PAIR_COLUMNS[3:]).orderBy("path_id"), "pairs.tsv")
    pairs.select(text_id.alias("value")).orderBy("value").write.mode("overwrite").text(f"{path}/pair_ids.txt")
    rows = channels.select(time_text(F.col("timestamp")).alias("timestamp"), number("nsl_id"), "group", "network", "station", "location", "component", "path")
    rank = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, "ENZ")), F.col("component")), F.lit(0)), F.lit(99))
    put(rows.repartition("timestamp").sortWithinPartitions("timestamp", "nsl_id", rank, "component", "path"), "manifests.tsv", "timestamp")
    put(rows.groupBy("timestamp").agg(F.count(F.lit(1)).alias("row_count")).orderBy("timestamp"), "timestamps.tsv")


def write_by_time(df: DataFrame, path: str, *order: str) -> None:
    """Parquet, a folder for each timestamp, rows in order inside it."""
    df.repartition("timestamp").sortWithinPartitions("timestamp", *order).write.partitionBy("timestamp").parquet(path)


def write_summary(spark: SparkSession, path: str, facts: dict[str, object]) -> None:
    """Facts of a stage as one JSON document."""
    spark.createDataFrame([(json.dumps(facts, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)
