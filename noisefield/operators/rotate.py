"""Rotation of the nine component pairs of a station pair from east, north, up to radial, transverse, up.

`rotate` takes stacks and a table of geometry; `rotate_records` takes records with their headers, and finds the geometry of each pair in
the header of its last component pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..functions.geodesy import with_distaz
from ..sources import sac
from . import lookup
from .correlate import slot as slot_of

ENZ = [a + b for a in "ENZ" for b in "ENZ"]
RTZ = [a + b for a in "RTZ" for b in "RTZ"]


def basis(azimuth: Column, back_azimuth: Column) -> tuple[dict[str, dict[str, Column]], dict[str, dict[str, Column]]]:
    """Each rotated component as a combination of east, north and up: at the source, and at the receiver, whose radial points back to the source."""
    az, baz = F.radians(azimuth), F.radians(back_azimuth)
    one = F.lit(1.0)
    src = {"R": {"E": F.sin(az), "N": F.cos(az)}, "T": {"E": F.cos(az), "N": -F.sin(az)}, "Z": {"Z": one}}
    rec = {"R": {"E": -F.sin(baz), "N": -F.cos(baz)}, "T": {"E": -F.cos(baz), "N": F.sin(baz)}, "Z": {"Z": one}}
    return src, rec


def weighted_sum(parts: list[tuple[str, Column]]) -> Column:
    """Sample by sample, the sum of array columns times weights."""
    return F.transform(F.arrays_zip(*(name for name, _ in parts)), lambda t: sum((weight * t[name] for name, weight in parts), F.lit(0.0)))


#: Sampling intervals that far apart are the same. Fixed value.
CLOSE_DELTA = 1e-7


def _turned(key: str, azimuth: Column, back_azimuth: Column, *more: str) -> list[Column]:
    """key, the columns `more`, slot, component_pair and data of the rotated pairs, from columns named as ENZ."""
    src, rec = basis(azimuth, back_azimuth)
    rows = []
    for k, (s, r) in enumerate((s, r) for s in "RTZ" for r in "RTZ"):
        parts = [(a + b, x * y) for a, x in src[s].items() for b, y in rec[r].items()]
        rows.append(F.struct(F.lit(k).alias("slot"), F.lit(s + r).alias("component_pair"), weighted_sum(parts).alias("data")))
    return [F.col(key), *map(F.col, more), F.inline(F.array(*rows))]


def _whole(wide: DataFrame, key: str, seen: Observation | None) -> DataFrame:
    """Rows that have all nine component pairs, of one length. seen: counts `pairs` and `pairs_not_rotated`, those that lack some."""
    if seen is not None:
        lacks = F.greatest(*(F.col(c).isNull() for c in ENZ))
        wide = wide.observe(seen, F.count(F.lit(1)).alias("pairs"), F.count_if(lacks).alias("pairs_not_rotated"))
    equal = F.size(F.array_distinct(F.array(*(F.size(c) for c in ENZ)))) == 1
    return wide.dropna(subset=ENZ).where(F.assert_true(equal, F.concat(F.lit("component pairs of different lengths cannot be rotated: pair "), F.col(key).cast("string"))).isNull())


def rotate(stacks: DataFrame, geometry: DataFrame, seen: Observation | None = None) -> DataFrame:
    """path_id, slot (of the rotated pair), component_pair and data; pairs without all nine component pairs are left out and counted in `seen`.

    stacks: path_id, slot, data. geometry: path_id, azimuth_deg, back_azimuth_deg."""
    wide = stacks.groupBy("path_id").agg(*(F.max(F.when(F.col("slot") == k, F.col("data"))).alias(name) for k, name in enumerate(ENZ)))
    wide = _whole(wide, "path_id", seen).join(geometry.select("path_id", "azimuth_deg", "back_azimuth_deg"), "path_id")
    return wide.select(*_turned("path_id", F.col("azimuth_deg"), F.col("back_azimuth_deg")))


GEOMETRY = ("gcarc_deg", "distance_km", "azimuth_deg", "back_azimuth_deg")


def rotate_records(records: DataFrame, key: str = "pair", seen: Observation | None = None) -> DataFrame:
    """key, gcarc_deg, distance_km, azimuth_deg, back_azimuth_deg, geometry (`coordinates` or `header`), delta, slot, component_pair and data.

    records: the key, slot, data and the header fields delta, evla, evlo, stla, stlo, gcarc, dist, az, baz. The geometry is that of the coordinates
    of both ends in the header of the pair of the last components (slot 8); where one is missing, the header's own azimuths; where these are missing too,
    an error. Sampling intervals of a pair that differ from that header's are an error. Of records that repeat a slot the one with the largest data stays."""
    head = F.struct(*(F.col(c).cast("double").alias(c) for c in ("delta", "evla", "evlo", "stla", "stlo", "gcarc", "dist", "az", "baz")))
    held = [F.max(F.when(F.col("slot") == k, F.struct(F.col("data").cast("array<double>").alias("data"), head.alias("head")))).alias(f"_{name}") for k, name in enumerate(ENZ)]
    wide = records.groupBy(key).agg(*held)
    wide = wide.select(key, *(F.col(f"_{c}.data").alias(c) for c in ENZ), F.array(*(F.col(f"_{c}.head.delta") for c in ENZ)).alias("deltas"), f"_{ENZ[-1]}.head.*")
    wide = _whole(wide, key, seen)
    what = lambda text: F.concat(F.lit(text), F.col(key).cast("string"))
    same = F.coalesce(F.forall("deltas", lambda d: F.abs(d - F.col("delta")) <= CLOSE_DELTA), F.lit(False))
    placed = F.greatest(*(F.col(c).isNull() for c in ("evla", "evlo", "stla", "stlo"))) == F.lit(False)
    known = F.col("az").isNotNull() & F.col("baz").isNotNull()
    wide = wide.where(F.assert_true(same, what("component pairs of different sampling intervals cannot be rotated: pair ")).isNull())
    wide = wide.where(F.assert_true(placed | known, what("neither coordinates nor azimuths in the header: pair ")).isNull())
    wide = with_distaz(wide, "evla", "evlo", "stla", "stlo")
    own = dict(zip(GEOMETRY, ("gcarc", "dist", "az", "baz"), strict=True))
    wide = wide.withColumns({c: F.when(placed, F.col(c)).otherwise(F.col(h)) for c, h in own.items()} | {"geometry": F.when(placed, "coordinates").otherwise("header")})
    return wide.select(*_turned(key, F.col("azimuth_deg"), F.col("back_azimuth_deg"), *GEOMETRY, "geometry", "delta"))


def rotate_files(places: DataFrame, path_col: str = "path", seen: Observation | None = None) -> DataFrame:
    """`rotate_records` of the files that a table names by the paths of `lookup.final_path`; the key `pair` is a path without its components."""
    name = lookup.parse_final_path(F.col(path_col))
    pair = F.regexp_replace(path_col, r"[^./-]+-[^./-]+(\.ncf\.SAC)$", "*$1")
    keyed = places.select(F.col(path_col).alias("path"), pair.alias("pair"), slot_of(name["src_component"], name["rec_component"]).alias("slot"))
    return rotate_records(sac.read_records(keyed, carry=("pair", "slot")), "pair", seen)


def incomplete(stacks: DataFrame) -> DataFrame:
    """Pairs that cannot be rotated, and how many component pairs they have."""
    return stacks.where(F.col("slot").between(0, 8)).groupBy("path_id").agg(F.countDistinct("slot").alias("n_slots")).where("n_slots < 9")
