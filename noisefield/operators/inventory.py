"""The catalogue: paths to fields, filters, groups, stations and their coordinates."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

# The names a path pattern may use, and what each matches.
DATE_FIELDS = {"YYYY": r"\d{4}", "YY": r"\d{2}", "MM": r"\d{2}", "DD": r"\d{2}", "JJJ": r"\d{3}", "HH": r"\d{2}", "MI": r"\d{2}"}
NAME_FIELDS = ("network", "event", "station", "location", "component", "channel", "sampleF", "quality", "locid", "suffix", "arrayID", *(f"label{k}" for k in range(10)))
NAME = r"[A-Za-z0-9_-]+"
DEFAULTS = {"network": "VV", "location": "00"}


@dataclass
class PathPattern:
    """A pattern such as {home}/{YYYY}/{station}.{component}.sac; {*} is any text, {?} a piece without `. _/`."""

    pattern: str
    home: str
    custom: dict[str, str] = field(default_factory=dict)
    regex: str = ""
    fields: list[str] = field(default_factory=list)

    def __post_init__(self) -> None:
        known = DATE_FIELDS | dict.fromkeys(NAME_FIELDS, NAME) | self.custom
        text = self.pattern.strip().replace("\\", "/")
        used = re.findall(r"\{([A-Za-z0-9]+)\}", text)
        wrong = sorted(set(used) - set(known) - {"home"})
        if wrong:
            raise ValueError(f"unknown fields {wrong}; known: {', '.join(known)}")
        if not text.startswith("{home}/"):
            raise ValueError("a pattern begins with {home}/")
        if "station" not in used:
            raise ValueError("a pattern needs {station}")
        if not {"component", "channel"} & set(used):
            raise ValueError("a pattern needs {component} or {channel}")
        if not ({"YYYY", "YY"} & set(used) and ({"MM", "DD"} <= set(used) or "JJJ" in used)):
            raise ValueError("a pattern needs a whole date: a year, and month and day or day of year")
        out = []
        for piece in re.split(r"(\{[^{}]*\})", text[len("{home}/") :]):
            name = piece[1:-1] if piece.startswith("{") else None
            if name == "*":
                out.append(".*")
            elif name == "?":
                out.append("[^. _/]*")
            elif name is None:
                out.append("".join(c if c.isalnum() or c in "/_" else "\\" + c for c in piece))
            elif name == "home":
                raise ValueError("{home} stands only at the start")
            elif name in self.fields:
                out.append(rf"\k<{name}>")
            else:
                self.fields.append(name)
                out.append(f"(?<{name}>{known[name]})")
        self.regex = "^" + "".join(out) + "$"

    def match(self, paths: DataFrame, path_col: str = "path") -> DataFrame:
        """Rows whose path below home matches whole, with the pattern's fields, component and channel standing in for each other."""
        home = self.home.rstrip("/") + "/"
        rel = F.when(F.col(path_col).startswith(home), F.substring(F.col(path_col), len(home) + 1, 1 << 20))
        got = paths.withColumn("_rel", rel).where(F.col("_rel").rlike(self.regex))
        for k, name in enumerate(self.fields, 1):
            got = got.withColumn(name, F.regexp_extract("_rel", self.regex, k))
        for a, b in (("component", "channel"), ("channel", "component")):
            if a not in self.fields:
                got = got.withColumn(a, F.col(b))
        for name, value in DEFAULTS.items():
            if name not in self.fields:
                got = got.withColumn(name, F.lit(value))
        return got.withColumn("time", self._time()).drop("_rel")

    def read(self, path: str) -> dict[str, object] | None:
        """What `match` gives for one path, in Python: network, station, location, component and time; None if it does not match."""
        home = self.home.rstrip("/") + "/"
        found = re.match(re.sub(r"\\k<(\w+)>", r"(?P=\1)", self.regex.replace("(?<", "(?P<")), path[len(home) :]) if path.startswith(home) else None
        if not found:
            return None
        held = found.groupdict()
        number = lambda k: int(held.get(k) or 0)
        year = number("YYYY") if "YYYY" in held else number("YY") + 2000
        try:
            day = datetime(year, number("MM"), number("DD")) if {"MM", "DD"} <= set(held) else datetime(year, 1, 1) + timedelta(days=number("JJJ") - 1)
            time = day.replace(hour=number("HH"), minute=number("MI"))
        except ValueError:
            time = None
        component = held.get("component") or held["channel"]
        return {"network": held.get("network", DEFAULTS["network"]), "station": held["station"], "location": held.get("location", DEFAULTS["location"]), "component": component, "time": time}

    def _time(self) -> Column:
        num = lambda k: F.col(k).cast("int") if k in self.fields else F.lit(0)
        year = F.col("YYYY").cast("int") if "YYYY" in self.fields else F.col("YY").cast("int") + 2000
        if {"MM", "DD"} <= set(self.fields):
            day = F.try_to_timestamp(F.format_string("%04d-%02d-%02d", year, num("MM"), num("DD")), F.lit("yyyy-MM-dd"))
        else:
            day = F.date_add(F.make_date(year, F.lit(1), F.lit(1)), num("JJJ") - 1).cast("timestamp")
        ok = (num("HH") < 24) & (num("MI") < 60)
        return F.when(ok, day + F.make_dt_interval(F.lit(0), num("HH"), num("MI")))


def in_list(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    return df.where(F.col(column).isin(values))


def in_table(df: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """Rows whose value is in the table's first column; Spark sizes the join."""
    return df.join(values.select(F.col(values.columns[0]).alias(column)).distinct(), column, "left_semi")


def in_ranges(df: DataFrame, column: str, ranges: list[tuple[object, object]]) -> DataFrame:
    """Rows whose value lies in any of the closed ranges."""
    ok = F.lit(False)
    for low, high in ranges:
        ok = ok | F.col(column).between(low, high)
    return df.where(ok)


def group_channels(files: DataFrame, keys: list[str], path_col: str = "path") -> DataFrame:
    """One row a key with its channels in parallel lists, in component order."""
    held = F.sort_array(F.collect_list(F.struct("component", F.col(path_col).alias("path"))))
    out = files.groupBy(*keys).agg(held.alias("held"))
    return out.select(*keys, F.transform("held", lambda x: x["component"]).alias("component_list"), F.transform("held", lambda x: x["path"]).alias("path_list"))


def relabel_components(files: DataFrame, labels: list[str]) -> DataFrame:
    """Three labels become E, N, Z in the order given (the file's own label stays in raw_component); one label stays."""
    if len(set(labels)) != len(labels) or len(labels) not in (1, 3):
        raise ValueError("give one component label or three different ones")
    out = files.withColumn("raw_component", F.col("component")).where(F.col("component").isin(labels))
    if len(labels) == 1:
        return out
    new = F.create_map(*(F.lit(x) for pair in zip(labels, "ENZ", strict=True) for x in pair))
    return out.withColumn("component", new[F.col("component")])


def time_text(time: Column) -> Column:
    """YYYY.JJJ.HHMM."""
    return F.date_format(time, "yyyy.DDD.HHmm")


#: Spellings of a time that `read_time` accepts.
TIME_SPELLINGS = ("yyyyMMdd'T'HH:mm", "yyyyMMdd'T'HHmm", "yyyyMMddHHmm", "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd HH:mm", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy.DDD.HHmm", "yyyyDDDHHmm", "yyyy.DDD.HH.mm")


def read_time(text: Column) -> Column:
    return F.coalesce(*(F.try_to_timestamp(text, F.lit(f)) for f in TIME_SPELLINGS))


def timestamp_index(files: DataFrame, time_col: str = "timestamp") -> DataFrame:
    return files.groupBy(time_col).agg(F.count(F.lit(1)).alias("sac_row_count"))


def complete_groups(channels: DataFrame, keys: list[str], components: int, seen: Observation | None = None) -> DataFrame:
    """Only rows of groups with exactly as many channels as there are components; with one component all stay.

    seen: counts `channels_read`, `channels_dropped` and `groups_dropped`."""
    size = F.count(F.lit(1)).over(Window.partitionBy(*keys)) if components > 1 else F.lit(1)
    rows = channels.withColumn("_n", size)
    wrong = F.col("_n") != components
    if seen is not None:
        rows = rows.observe(seen, F.count(F.lit(1)).alias("channels_read"), F.count_if(wrong).alias("channels_dropped"), F.coalesce(F.round(F.sum(F.when(wrong, 1 / F.col("_n")))), F.lit(0.0)).cast("long").alias("groups_dropped"))
    return rows.where(~wrong).drop("_n")


#: Stations of a run: their numbers fill four digits of a pair id.
MOST_STATIONS = 9999


def stations(channels: DataFrame) -> DataFrame:
    """Stations with ids from 1 in the order of (group, network, station, location), their components and first file."""
    key = ["group", "network", "station", "location"]
    nodes = channels.groupBy(*key).agg(F.sort_array(F.collect_set("component")).alias("components"), F.min("path").alias("path"))
    found = len(nodes.select("station").take(MOST_STATIONS + 1))
    if found > MOST_STATIONS:
        raise ValueError(f"more than {MOST_STATIONS} stations; choose some by a list or split the run")
    return nodes.withColumn("nsl_id", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*key)))  # few rows, as just counted


def with_geometry(nodes: DataFrame, table: DataFrame, close: float = 1e-6) -> DataFrame:
    """Coordinates from a table of (station, lat, lon[, network, location]); a row of the very station wins over one by code.

    `updated` marks values that change, `conflict` those that replace other ones."""
    exact = table.where("network is not null and location is not null").select("network", "station", "location", F.col("lat").alias("lat_x"), F.col("lon").alias("lon_x"))
    loose = table.where("network is null or location is null").select("station", F.col("lat").alias("lat_s"), F.col("lon").alias("lon_s"))
    out = nodes.join(exact, ["network", "station", "location"], "left").join(loose, ["station"], "left")
    out = out.withColumn("new_lat", F.coalesce("lat_x", "lat_s", "lat")).withColumn("new_lon", F.coalesce("lon_x", "lon_s", "lon"))
    moved = lambda c: F.col(f"new_{c}").isNotNull() & (F.col(c).isNull() | (F.abs(F.col(c) - F.col(f"new_{c}")) > close))
    out = out.withColumn("updated", moved("lat") | moved("lon")).withColumn("conflict", F.col("updated") & F.col("lat").isNotNull() & F.col("lon").isNotNull())
    return out.drop("lat", "lon", "lat_x", "lon_x", "lat_s", "lon_s").withColumnsRenamed({"new_lat": "lat", "new_lon": "lon"})


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what}: no rows; check the pattern, the station list and the filters")
    return df


def channel_count(channels: DataFrame, key: str) -> int:
    """Channels of every station, which must be the same for all."""
    got = channels.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.min("n"), F.max("n")).first()
    if got[0] != got[1]:
        raise ValueError(f"stations have between {got[0]} and {got[1]} channels")
    return got[0]
