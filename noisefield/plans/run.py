"""A run from waveform files to stacked and rotated correlations, stage by stage.

Each stage reads and writes Parquet tables below the output folder, so a run goes on where another one ended. Tables:
channels, timestamps, stations, pairs, spectra, ncf, stack_<method>, rotated_<method>, and inventory.json with their counts.
"""

from __future__ import annotations

import difflib
import hashlib
import warnings

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..functions import arrays as A
from ..operators import correlate, inventory, lookup, merge, pairs, rotate, stack
from ..sources import pack, record_lookup, sac, tables
from .config import RunConfig

STAGES = ("prepare", "spectra", "correlate", "pack", "stack", "rotate", "unpack")
METHODS = ("linear", "pws", "tfpws")


def chosen_stages(only: list[str] | None = None, skip: list[str] | None = None) -> list[str]:
    for name in [*(only or []), *(skip or [])]:
        if name not in STAGES:
            near = difflib.get_close_matches(name, STAGES, 1)
            raise ValueError(f"no stage {name!r}" + (f"; did you mean {near[0]!r}?" if near else f"; stages: {', '.join(STAGES)}"))
    return [s for s in STAGES if (not only or s in only) and s not in (skip or [])]


class Run:
    def __init__(self, spark: SparkSession, config: RunConfig):
        self.spark, self.config = spark, config
        self.chain = config.conditioning()

    def path(self, name: str) -> str:
        return f"{self.config.output}/{name}"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def _write(self, df: DataFrame, name: str, drop: tuple[str, ...] = (), **counts: Column) -> dict[str, int]:
        """Writes a table, and counts as it is written."""
        seen = Observation()
        if counts:
            df = df.observe(seen, *(c.alias(k) for k, c in counts.items()))
        df.drop(*drop).write.mode("overwrite").parquet(self.path(name))
        return dict(seen.get) if counts else {}

    def methods(self) -> list[str]:
        return [m for m, on in zip(METHODS, self.config.stack_flag, strict=True) if on == "1"]

    # stages

    def prepare(self) -> None:
        """Files to channels, stations and pairs; only channels of stations that are in a pair stay."""
        c = self.config
        found = None
        for s in c.sources:
            listed = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(s.path).select(F.regexp_replace("path", "^file:/*", "/").alias("path"))
            got = inventory.PathPattern(s.pattern, s.path).match(listed).withColumn("group", F.lit(s.group))
            got = inventory.relabel_components(got, list(s.components))
            if s.stations:
                got = inventory.in_table(got, "station", tables.listed(self.spark, s.stations))
            got = got.select("group", "network", "station", "location", "component", "time", "path")
            found = got if found is None else found.unionByName(got)
        if c.time_start or c.time_end:
            found = inventory.in_ranges(found, "time", [(F.lit(c.time_start or "0001-01-01").cast("timestamp"), F.lit(c.time_end or "9999-12-31").cast("timestamp"))])
        if c.time_list:
            found = found.join(tables.times(self.spark, c.time_list).withColumnRenamed("timestamp", "time"), "time", "left_semi")
        nodes = inventory.stations(inventory.require_rows(found, "inventory"))
        heads = sac.station_geometry(nodes)  # one header a station
        nodes = nodes.join(heads.select("path", F.col("stla").alias("lat"), F.col("stlo").alias("lon")), "path", "left")
        if c.geometry:
            nodes = inventory.with_geometry(nodes, tables.station_coordinates(self.spark, c.geometry))
        else:
            nodes = nodes.withColumns({"updated": F.lit(False), "conflict": F.lit(False)})
        rows = F.count(F.lit(1))
        bare = F.col("lat").isNull() | F.col("lon").isNull()
        facts = self._write(nodes, "stations", ("updated", "conflict"), stations=rows, stations_without_coordinates=F.count_if(bare), coordinates_updated=F.count_if("updated"), coordinates_in_conflict=F.count_if("conflict"))
        facts |= self._write_pairs(self.table("stations"))
        inventory.require_rows(self.table("pairs"), "pairs")
        kept = pairs.retained(self.table("stations"), self.table("pairs"))
        keys = ["group", "network", "station", "location"]
        facts["stations_in_pairs"] = kept.count()
        facts |= self._write(found.join(kept.select(*keys, "nsl_id"), keys).withColumn("timestamp", F.col("time")), "channels", channels=rows)
        facts |= self._write(inventory.timestamp_index(self.table("channels")), "timestamps", timestamps=rows)
        if c.text_tables:
            tables.write_catalog(self.table("stations"), self.table("pairs"), self.table("channels"), self.path("catalog"))
        tables.write_summary(self.spark, self.path("inventory.json"), facts | {"sources": [s.path for s in c.sources]})

    def _write_pairs(self, nodes: DataFrame) -> dict[str, int]:
        """The pairs of the stations: those of a given table, as they stand there, or all that pass the filters. Returns what a table's lines were, counted as they are read."""
        c = self.config
        if not c.pair_table:
            full = c.azimuth_deg[0] <= 0 and c.azimuth_deg[1] >= 360
            return self._write(pairs.station_pairs(nodes, c.group_pairs, c.autocorr, c.distance_km, None if full else [c.azimuth_deg]), "pairs", pairs=F.count(F.lit(1)), pairs_without_coordinates=F.count_if(F.col("distance_km").isNull()))
        seen = Observation()
        lines = tables.pair_file(self.spark, c.pair_table).observe(seen, F.count(F.lit(1)).alias("pair_lines"), *(F.count_if(F.col("fault") == x).alias(f"pair_lines_{x}") for x in tables.PAIR_FAULTS))
        ends = {p: nodes.select(F.col("nsl_id").alias(f"{p}_id"), F.col("group").alias(f"{p}_group")) for p in ("src", "rec")}
        known = tables.allowed_pairs(lines).drop("src_group", "rec_group").join(F.broadcast(ends["src"]), "src_id").join(F.broadcast(ends["rec"]), "rec_id")  # at most 9999 stations
        facts = self._write(known.select("path_id", *(F.col(x).cast("int").alias(x) for x in ("src_id", "rec_id")), *(x for x in tables.PAIR_COLUMNS[3:])), "pairs", pairs=F.count(F.lit(1)))
        return facts | dict(seen.get)

    def spectra(self) -> None:
        """Traces of the channels, cut or padded to the record's length, to conditioned spectra."""
        c = self.config
        channels = self.table("channels")
        n = int(round(c.record_seconds / c.delta))
        c.check_skipped_steps()
        # the files of the channels that are in a pair; what a channel is goes along, so traces are shuffled once, to their group
        data = sac.read_records(channels.select("path", "timestamp", "nsl_id", "component"), carry=("timestamp", "nsl_id", "component"))
        rows = data.select("path", "timestamp", "nsl_id", "component", "delta", F.col("data").cast("array<double>").alias("data"))
        close = F.abs(F.col("delta") - c.delta) <= F.greatest(F.lit(1e-6), 1e-5 * F.col("delta"))
        rows = rows.withColumn("data", F.when(F.assert_true(close, F.concat(F.lit("sampling interval of "), "path")).isNull(), A.fit_length(F.col("data"), n)))
        wanted = max(len(s.components) for s in c.sources)
        seen = Observation()
        rows = inventory.complete_groups(rows.select("timestamp", "nsl_id", "component", "data"), ["timestamp", "nsl_id"], wanted, seen)
        facts = self._write(correlate.spectra(rows, self.chain), "spectra", spectra=F.count(F.lit(1))) | dict(seen.get)
        tables.write_summary(self.spark, self.path("spectra.json"), facts)
        if facts["groups_dropped"]:
            warnings.warn(f"{facts['groups_dropped']} groups have not {wanted} channels and are left out ({facts['channels_dropped']} channels)", stacklevel=2)

    def correlate(self) -> None:
        x = correlate.correlate_spectra(self.table("spectra"), self.table("pairs"), self.chain.max_lag, self.chain.length, self.chain.delta, self.config.steps())
        self._write(x, "ncf")

    def pack(self) -> None:
        """The correlations as packs of records, a record index by which other runs can use them, and the same index laid out for finding single records."""
        sac.register(self.spark)
        s = self.table("stations").select("nsl_id", "network", "station", "location")
        end = lambda p: s.select(F.col("nsl_id").alias(f"{p}_id"), *(F.col(k).alias(f"{p}_{k}") for k in ("network", "station", "location")))
        half, dt = self.chain.max_lag, self.chain.delta
        order = ["path_id", "slot", "timestamp"]
        rows = self.table("ncf").select(*order, F.lit(dt).cast("float").alias("delta"), F.lit(-half * dt).cast("float").alias("b"), F.col("data").cast("array<float>").alias("data"))
        rows.repartitionByRange(*order).sortWithinPartitions(*order).write.format("sacpack").mode("overwrite").option("keys", ",".join(order)).save(self.path("packs"))
        t = pack.pack_index(self.spark, self.path("packs")).join(self.table("pairs"), "path_id").join(end("src"), "src_id").join(end("rec"), "rec_id")
        letter = F.array(*map(F.lit, "ENZ"))
        t = t.withColumns({"src_component": F.element_at(letter, (F.floor(F.col("slot") / 3) + 1).cast("int")), "rec_component": F.element_at(letter, (F.col("slot") % 3 + 1).cast("int"))})
        key = lambda p: F.concat_ws(".", f"{p}_network", f"{p}_station", f"{p}_location")
        t = t.withColumns({"timestamp": inventory.time_text(F.col("timestamp")), "source_key": key("src"), "receiver_key": key("rec"), "dt": F.lit(dt), "dist": F.col("distance_km"), "az": F.col("azimuth_deg"), "baz": F.col("back_azimuth_deg"), "storage_kind": F.lit("pack")})
        t = t.withColumn("component_slot", F.col("slot")).withColumn("final_pair_path", lookup.final_path({k: F.col(k) for k in t.columns}))
        tables.write_tsv(t.select(*tables.INDEX_COLUMNS), f"{self.path('packs')}/record_index.tsv")
        record_lookup.write(t.select(*tables.INDEX_COLUMNS), self.path("record_lookup"), "overwrite")

    def correlations(self) -> list[DataFrame]:
        """The records to stack: those of this run, and those that the indexes of other runs name; `merge.COLUMNS`."""
        none = lambda t: F.lit(None).cast(t)
        out = [self.table("ncf").select("path_id", "slot", "timestamp", none("string").alias("record_path"), none("long").alias("record_offset"), F.lit(self.chain.delta).alias("delta"), none("string").alias("head"), "data")]
        for place in self.config.other_indexes:
            index = tables.record_index(self.spark, tables.found_indexes(self.spark, place))
            time = inventory.read_time(F.col("timestamp"))
            keyed = index.select("path_id", F.col("component_slot").alias("slot"), F.when(F.assert_true(time.isNotNull(), F.concat(F.lit("not a time: "), "timestamp")).isNull(), time).alias("timestamp"), "record_path", "record_offset", "bytes")
            rows = sac.read_records(keyed, "record_path", "record_offset", "bytes", carry=("path_id", "slot", "timestamp"))
            head = F.to_json(F.struct(*(c for c in sac.COLUMNS if c != "npts")))
            out.append(rows.select("path_id", "slot", "timestamp", F.col("path").alias("record_path"), "record_offset", F.col("delta").cast("double").alias("delta"), head.alias("head"), F.col("data").cast("array<double>").alias("data")))
        return out

    def stack(self) -> None:
        c, width = self.config, 2 * self.chain.max_lag + 1
        ncf, parts = self.table("ncf"), self.correlations()
        if len(parts) > 1:  # laid out once by pair and slot
            ncf = merge.bucket_records(parts, f"noisefield_{hashlib.sha256(c.output.encode()).hexdigest()[:16]}", self.path("records"), c.buckets)
        for m in self.methods():
            if m == "linear" and len(parts) > 1:
                self._write(merge.merged_stack(ncf).drop("delta"), f"stack_{m}")
                continue
            if m == "linear":
                out = stack.linear_stack(ncf, width)
            elif m == "pws":
                out = stack.phase_weighted_stack(ncf, c.pre_stack_size, width)
            else:
                out = stack.time_frequency_stack(ncf, c.pre_stack_size, width, c.delta, c.tf_band, c.tf_taper_hz)
            self._write(out, f"stack_{m}")

    def rotate(self) -> None:
        """Only where stations have three components; pairs that lack some are left out and counted."""
        facts = {}
        for m in self.methods():
            seen = Observation()
            self._write(rotate.rotate(self.table(f"stack_{m}"), self.table("pairs"), seen), f"rotated_{m}")
            facts |= {f"{m}_{k}": v for k, v in seen.get.items()}
        tables.write_summary(self.spark, self.path("rotate.json"), facts)

    def records(self, name: str, labels: str) -> DataFrame:
        """Stacks or rotated stacks with the names and geometry that a record carries, its extremes, and in the user fields what it was made of."""
        s = self.table("stations").select("nsl_id", "network", "station", "location", "lat", "lon")
        end = lambda p: s.select(*(F.col(k).alias(f"{p}_{k}") for k in ("network", "station", "location", "lat", "lon")), F.col("nsl_id").alias(f"{p}_id"))
        t = self.table(name).join(self.table("pairs"), "path_id").join(end("src"), "src_id").join(end("rec"), "rec_id")
        letter = F.array(*map(F.lit, labels))
        t = t.withColumn("src_component", F.element_at(letter, (F.floor(F.col("slot") / 3) + 1).cast("int"))).withColumn("rec_component", F.element_at(letter, (F.col("slot") % 3 + 1).cast("int")))
        half, dt = self.chain.max_lag, self.chain.delta
        t = t.withColumn("output_path", F.concat(F.lit(f"{name}/"), lookup.final_path({k: F.col(k) for k in t.columns})))
        head = {"delta": dt, "b": -half * dt, "e": half * dt, "iftype": 1, "nzyear": 2010, "nzjday": 214, "nzhour": 0, "nzmin": 0, "nzsec": 0, "nzmsec": 0}
        if "chunks" in t.columns:
            user = {"user0": F.col("n"), "user1": F.col("chunks"), "user2": F.lit(self.config.pre_stack_size), "kuser0": F.lit("NTRACE"), "kuser1": F.lit("NGROUP"), "kuser2": F.lit("SUBSTK")}
        elif "n" in t.columns:  # user0 is the divisor of a linear stack
            user = {"user0": F.col("n"), "user1": F.col("rec_id"), "user2": F.col("path_id")}
        else:
            user = {"user0": F.col("src_id"), "user1": F.col("rec_id"), "user2": F.col("path_id")}
        turned = {"cmpaz": F.pmod(F.col("back_azimuth_deg") + 180.0, F.lit(360.0)), "cmpinc": F.lit(90.0)} if labels == "RTZ" else {}
        mean = A.total(F.col("data")) / F.size("data")
        return t.select(
            "output_path", *(F.lit(v).alias(k) for k, v in head.items()), *(v.alias(k) for k, v in (user | turned).items()),
            F.array_min("data").alias("depmin"), F.array_max("data").alias("depmax"), mean.alias("depmen"),
            F.col("rec_station").alias("kstnm"), F.col("rec_network").alias("knetwk"), F.concat_ws(".", "src_network", "src_station").alias("kevnm"), F.concat_ws("-", "src_component", "rec_component").alias("kcmpnm"),
            F.col("rec_lat").alias("stla"), F.col("rec_lon").alias("stlo"), F.col("src_lat").alias("evla"), F.col("src_lon").alias("evlo"),
            F.col("distance_km").alias("dist"), F.col("azimuth_deg").alias("az"), F.col("back_azimuth_deg").alias("baz"), F.col("gcarc_deg").alias("gcarc"), "data",
        )

    def unpack(self) -> None:
        if not self.config.unpack:
            return
        want = self.config.unpack_target
        made = None
        for m in self.methods():
            for kind, labels in (("stack", "ENZ"), ("rotated", "RTZ")):
                if want == "ALL" or want == {"stack": "STACK", "rotated": "ROTATE"}[kind] or want == "FINAL" and kind == "rotated":
                    out = sac.write(self.records(f"{kind}_{m}", labels), self.path("sac"))
                    made = out if made is None else made.unionByName(out)
        if made is not None:
            self._write(made, "written")

    def go(self, only: list[str] | None = None, skip: list[str] | None = None) -> list[str]:
        todo = [x for x in chosen_stages(only, skip) if x != "pack" or "pack" in (only or []) or self.config.pack]
        for name in todo:
            getattr(self, name)()
        return todo
