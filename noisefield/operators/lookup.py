"""Finding, naming and laying out results."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window, functions as F


def safe_name(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"[^0-9A-Za-z._:-]+", "-"), ":", "_")


def id_text(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def final_path(r: dict[str, Column]) -> Column:
    """SRC/REC/net-net.sta-sta.loc-loc.cmp-cmp.ncf.SAC from the columns src_*, rec_* of both ends; the location keeps records apart."""
    key = lambda p: F.concat_ws(".", r[f"{p}_network"], r[f"{p}_station"])
    both = lambda c: F.concat_ws("-", r[f"src_{c}"], r[f"rec_{c}"])
    return F.concat(key("src"), F.lit("/"), key("rec"), F.lit("/"), F.concat_ws(".", both("network"), both("station"), both("location"), both("component")), F.lit(".ncf.SAC"))


def parse_component_pair(text: str) -> tuple[str, str]:
    """Two components as A-B or A/B."""
    parts = [x.strip() for x in re.split("[-/]", text) if x.strip()]
    if len(parts) != 2:
        raise ValueError(f"{text!r} is not a pair of components; write SRC-REC, for example BHE-BHZ")
    return parts[0], parts[1]


def parse_final_path(path: Column) -> dict[str, Column]:
    """The names in a path of `final_path`: src_ and rec_network, station, location and component."""
    held = F.split_part(path, F.lit("/"), F.lit(-1))
    out = {}
    for k, name in enumerate(("network", "station", "location", "component"), 1):
        part = F.split_part(held, F.lit("."), F.lit(k))
        out[f"src_{name}"], out[f"rec_{name}"] = F.split_part(part, F.lit("-"), F.lit(1)), F.split_part(part, F.lit("-"), F.lit(2))
    return out


def extract(index: DataFrame, timestamp: str | None, src: str, rec: str, component_pair: str, allow_reverse: bool = False, **more: str | None) -> DataFrame:
    """Records of a station pair and component pair at one time, or at all; `reversed` is set where the ends are swapped.

    more: src_network, rec_network, src_location and rec_location, each only if it is to be the same. Times may be written with : or _."""
    unknown = set(more) - {f"{p}_{c}" for p in ("src", "rec") for c in ("network", "location")}
    if unknown:
        raise TypeError(f"unknown: {', '.join(sorted(unknown))}")
    sc, rc = parse_component_pair(component_pair)
    wanted = {"src_station": src, "rec_station": rec, "src_component": sc, "rec_component": rc} | {k: v for k, v in more.items() if v is not None}
    swap = {"src": "rec", "rec": "src"}

    def matches(turned: bool) -> Column:
        ok = F.lit(True)
        for k, v in wanted.items():
            ok = ok & (F.col(f"{swap[k[:3]]}{k[3:]}" if turned else k) == v)
        return ok

    hit = matches(False)
    ok = hit | matches(True) if allow_reverse else hit
    if timestamp is not None:
        ok = ok & (safe_name(F.col("timestamp").cast("string")) == re.sub("[^0-9A-Za-z._:-]+", "-", timestamp).replace(":", "_"))
    return index.where(ok).withColumn("reversed", ~F.coalesce(hit, F.lit(False)))


def one(found: DataFrame) -> DataFrame:
    """The frame if it has exactly one row."""
    n = len(found.limit(2).take(2))
    if n != 1:
        raise LookupError("no record matches" if not n else "more than one record matches; give src_network, rec_network, src_location or rec_location")
    return found


def source_index(timestamps: DataFrame, records: DataFrame) -> DataFrame:
    """Records ordered by (path_id, slot) inside each timestamp; a timestamp without records keeps one row of nulls."""
    return timestamps.join(records, "timestamp", "left").sortWithinPartitions("timestamp", "path_id", "slot")


def two_sided(ncf: DataFrame, half: int, dt: float, *keys: str) -> DataFrame:
    """Rows of lag time t, negative side reversed from lag -dt on, positive side from lag 0 on; the shorter is padded with 0."""
    neg = F.concat(F.reverse(F.slice("data", 1, half)), F.array(F.lit(0.0)))
    pos = F.slice("data", half + 1, half + 1)
    return ncf.select(*keys, F.posexplode(F.arrays_zip(neg.alias("negative"), pos.alias("positive"))).alias("k", "x")).select(*keys, (F.col("k") * dt).alias("t"), F.col("x.negative").alias("negative"), F.col("x.positive").alias("positive"))


def evenly(df: DataFrame, partition: list[str], order: list[str], count: int) -> DataFrame:
    """At most `count` rows of each partition, evenly spaced from first to last in order."""
    w = Window.partitionBy(*partition)
    d = df.withColumn("_k", F.row_number().over(w.orderBy(*order)) - 1).withColumn("_n", F.count(F.lit(1)).over(w))
    places = F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: F.bround(i * (F.col("_n") - 1) / max(count - 1, 1)).cast("int"))
    return d.where((F.col("_n") <= count) | F.array_contains(places, F.col("_k"))).drop("_k", "_n")


def stride(df: DataFrame, partition: list[str], order: list[str], step: int) -> DataFrame:
    d = df.withColumn("_k", F.row_number().over(Window.partitionBy(*partition).orderBy(*order)) - 1)
    return d.where(F.col("_k") % step == 0).drop("_k")


def auto_scale(df: DataFrame, partition: list[str], distance: str, least: float = 0.08) -> DataFrame:
    """0.55 times the median positive gap between neighbouring distances, at least `least`."""
    gap = F.col(distance) - F.lag(distance).over(Window.partitionBy(*partition).orderBy(distance))
    g = df.withColumn("_gap", gap)
    return g.groupBy(*partition).agg(F.greatest(F.lit(least), 0.55 * F.coalesce(F.percentile(F.when(F.col("_gap") > 0, F.col("_gap")), 0.5), F.lit(0.0))).alias("scale"))


def task_chunks(timestamps: DataFrame, tasks: int, column: str = "timestamp") -> DataFrame:
    """Distinct timestamps in order, dealt in contiguous chunks with borders i * n // tasks."""
    whole = Window.partitionBy(F.lit(0))
    d = timestamps.select(column).distinct().withColumn("_k", F.row_number().over(whole.orderBy(column))).withColumn("_n", F.count(F.lit(1)).over(whole))
    return d.select(column, F.floor((F.col("_k") * tasks - 1) / F.col("_n")).cast("int").alias("task_id"))
