"""Waveform files in the SAC binary format: records as rows, and back.

A record is a header of 632 bytes (70 floats, 40 integers, 23 text fields) and its samples. Rows have one column for each
header field in use, with the format's null marks as nulls, and `data`. `register` adds the data source
`spark.read.format("sac")`, which reads a folder of files, a task for each batch of them.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator
from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..operators.inventory import PathPattern
from .store import listed, read_bytes, write_bytes

HEADER_BYTES = 632
NULL = -12345.0
# Header fields in the order of the format; words not named here are unused.
FLOAT_FIELDS = (
    "delta depmin depmax scale odelta b e o a _1 t0 t1 t2 t3 t4 t5 t6 t7 t8 t9 f resp0 resp1 resp2 resp3 resp4 resp5 resp6 resp7 resp8 resp9 "
    "stla stlo stel stdp evla evlo evel evdp mag user0 user1 user2 user3 user4 user5 user6 user7 user8 user9 dist az baz gcarc _2 _3 depmen cmpaz cmpinc "
    "xminimum xmaximum yminimum ymaximum _4 _5 _6 _7 _8 _9 _10"
).split()
INT_FIELDS = (
    "nzyear nzjday nzhour nzmin nzsec nzmsec nvhdr norid nevid npts _11 nwfid nxsize nysize _12 iftype idep iztype _13 iinst istreg ievreg ievtyp iqual isynth "
    "imagtyp imagsrc _14 _15 _16 _17 _18 _19 _20 _21 leven lpspol lovrok lcalda _22"
).split()
TEXT_FIELDS = "kstnm kevnm khole ko ka kt0 kt1 kt2 kt3 kt4 kt5 kt6 kt7 kt8 kt9 kf kuser0 kuser1 kuser2 kcmpnm knetwk kdatrd kinst".split()
IXY = 4
#: Header fields that rows carry.
COLUMNS = {
    "delta": "float", "b": "float", "e": "float", "o": "float", "a": "float", **{f"t{k}": "float" for k in range(10)}, "depmin": "float", "depmax": "float", "depmen": "float", "stla": "float", "stlo": "float", "stel": "float", "evla": "float", "evlo": "float",
    "dist": "float", "az": "float", "baz": "float", "gcarc": "float", "cmpaz": "float", "cmpinc": "float", "user0": "float", "user1": "float", "user2": "float",
    "nzyear": "int", "nzjday": "int", "nzhour": "int", "nzmin": "int", "nzsec": "int", "nzmsec": "int", "npts": "int", "iftype": "int",
    "kstnm": "string", "kevnm": "string", "kcmpnm": "string", "knetwk": "string", "khole": "string", "kuser0": "string", "kuser1": "string", "kuser2": "string",
}
SCHEMA = "path string, " + ", ".join(f"{k} {t}" for k, t in COLUMNS.items()) + ", data array<float>"


def _places() -> dict[str, tuple[int, int]]:
    """Byte place and width of each text field; the second one has 16 bytes, the others 8."""
    out, at = {}, 440
    for name in TEXT_FIELDS:
        width = 16 if name == "kevnm" else 8
        out[name] = (at, width)
        at += width
    return out


_TEXT_AT = _places()


def byte_order(raw: bytes) -> str:
    """< or >: by the header version, else by plausible sample counts and intervals, else that of this machine."""
    votes = {}
    for order in "<>":
        version, npts = (int(np.frombuffer(raw, order + "i4", 1, 280 + 4 * INT_FIELDS.index(k))[0]) for k in ("nvhdr", "npts"))
        delta = float(np.frombuffer(raw, order + "f4", 1, 0)[0])
        votes[order] = 4 * (version in (6, 7)) + (0 < npts < 1 << 28) + (1e-6 < delta < 1e5)
    return max(votes, key=lambda k: (votes[k], k == ("<" if (sys.byteorder == "little") else ">"))) if len(set(votes.values())) > 1 else "<" if (sys.byteorder == "little") else ">"


def decode(raw: bytes) -> dict[str, object]:
    """Header fields and samples of a record."""
    if len(raw) < HEADER_BYTES:
        raise ValueError(f"a record has at least {HEADER_BYTES} bytes, not {len(raw)}")
    order = byte_order(raw)
    floats = np.frombuffer(raw, order + "f4", 70)
    ints = np.frombuffer(raw, order + "i4", 40, 280)
    out: dict[str, object] = {}
    for names, values, kind in ((FLOAT_FIELDS, floats, float), (INT_FIELDS, ints, int)):
        for name, value in zip(names, values, strict=True):
            if name in COLUMNS:
                out[name] = None if abs(float(value) - NULL) <= 1e-3 else kind(value)
    for name, (at, width) in _TEXT_AT.items():
        if name in COLUMNS:
            text = raw[at : at + width].split(b"\0")[0].decode("ascii", "replace").strip()
            out[name] = None if text in ("", "-12345") else text
    count = (out["npts"] or 0) * (2 if out["iftype"] == IXY else 1)
    if len(raw) < HEADER_BYTES + 4 * count:
        raise ValueError(f"the header promises {count} samples; {(len(raw) - HEADER_BYTES) // 4} are there")
    out["data"] = np.frombuffer(raw, order + "f4", count, HEADER_BYTES).astype(np.float32)
    return out


def encode(fields: dict[str, object]) -> bytes:
    """A little-endian record; fields that are missing or null get the format's null mark."""
    data = np.asarray(fields["data"], "<f4")
    npts = len(data) // (2 if fields.get("iftype") == IXY else 1)
    values = {"nvhdr": 6, "iftype": 1, "leven": 1, **{k: v for k, v in fields.items() if v is not None and not (isinstance(v, float) and np.isnan(v))}, "npts": npts}
    head = np.array([values.get(k, NULL) for k in FLOAT_FIELDS], "<f4").tobytes() + np.array([int(values.get(k, NULL)) for k in INT_FIELDS], "<i4").tobytes()
    for name in TEXT_FIELDS:
        width = _TEXT_AT[name][1]
        head += str(values.get(name, "-12345")).encode("ascii", "replace")[:width].ljust(width)
    return head + data.tobytes()


def read(spark: SparkSession, path: str) -> DataFrame:
    """All files below path as rows of SCHEMA; Spark lists and reads the files, tasks decode them in batches."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [{"path": p, **decode(c)} for p, c in zip(b["path"], b["content"], strict=True)]
            yield pd.DataFrame(rows, columns=["path", *COLUMNS, "data"])

    return found.mapInPandas(run, SCHEMA)


def read_records(places: DataFrame, path_col: str = "path", offset_col: str | None = None, bytes_col: str | None = None, files_each: int = 256, carry: tuple[str, ...] = ()) -> DataFrame:
    """The records at the places that a table names, and no other bytes: rows of SCHEMA with the offset as `record_offset` and the columns `carry` of the table.

    A file holds one record, or several, each at its offset; a number of bytes that is not the record's own is an error. Tasks open `files_each` records each."""
    taken = sorted({"path", "record_offset", "data", *COLUMNS} & set(carry))
    if taken:
        raise ValueError(f"records have columns {', '.join(taken)} of their own")
    want = places.select(F.col(path_col).alias("path"), (F.col(offset_col) if offset_col else F.lit(0)).cast("long").alias("record_offset"), (F.col(bytes_col) if bytes_col else F.lit(None)).cast("long").alias("bytes"), *carry)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, offset, size in zip(b["path"], b["record_offset"], b["bytes"], strict=True):
                head = read_bytes(path, int(offset), HEADER_BYTES)
                whole = HEADER_BYTES + 4 * _samples(head)
                if size is not None and size == size and int(size) != whole:
                    raise ValueError(f"{path}: a record of {int(size)} bytes is named, its header says {whole}")
                rows.append({"path": path, "record_offset": offset, **decode(head + read_bytes(path, int(offset) + HEADER_BYTES, whole - HEADER_BYTES))})
            yield pd.DataFrame(rows, columns=["path", "record_offset", *COLUMNS, "data"]).assign(**{c: b[c].to_numpy() for c in carry})

    carried = "".join(f", `{c}` {places.schema[c].dataType.simpleString()}" for c in carry)
    return _spread(want, files_each).mapInPandas(run, SCHEMA.replace("path string", "path string, record_offset long") + carried)


#: What a window's times may count from: header fields, or the record's own clock.
MARKS = (*(f"t{k}" for k in range(10)), "b", "o", "a", "absolute")


def read_windows(places: DataFrame, mark: str, first: float, last: float, path_col: str = "path", offset_col: str | None = None, files_each: int = 256, carry: tuple[str, ...] = ()) -> DataFrame:
    """Windows of records from `first` to `last` seconds after a mark: path, record_offset, `carry`, delta, b (time of the first sample), npts, bytes_read and data.

    A window has rint((last - first) / delta) samples and begins at the sample nearest to its first time; samples outside the record are 0. Of a
    file only the header and the bytes of the window are read. A record without the mark, or without a positive interval, is an error."""
    if mark not in MARKS or last < first:
        raise ValueError(f"a window counts from one of {', '.join(MARKS)} and ends after it begins")
    want = places.select(F.col(path_col).alias("path"), (F.col(offset_col) if offset_col else F.lit(0)).cast("long").alias("record_offset"), *carry)
    names = ["path", "record_offset", "delta", "b", "npts", "bytes_read", "data"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, offset in zip(batch["path"], batch["record_offset"], strict=True):
                head = read_bytes(path, int(offset), HEADER_BYTES)
                order = byte_order(head)
                value = dict(zip(FLOAT_FIELDS, np.frombuffer(head, order + "f4", 70).astype(float), strict=True))
                known = mark == "absolute" or abs(value[mark] - NULL) > 1e-3
                if not known or value["delta"] <= 0:
                    raise ValueError(f"{path}: the header has no {'sampling interval' if known else mark}")
                begin = value["b"] if abs(value["b"] - NULL) > 1e-3 else 0.0
                start = round(((0.0 if mark == "absolute" else value[mark]) + first - begin) / value["delta"])
                n = round((last - first) / value["delta"])
                a, z = max(start, 0), min(start + n, _samples(head))
                data = np.zeros(n, np.float32)
                raw = read_bytes(path, int(offset) + HEADER_BYTES + 4 * a, 4 * (z - a)) if z > a else b""
                data[a - start : a - start + len(raw) // 4] = np.frombuffer(raw, order + "f4")
                rows.append((path, offset, value["delta"], begin + start * value["delta"], n, HEADER_BYTES + len(raw), data))
            yield pd.DataFrame(rows, columns=names).assign(**{c: batch[c].to_numpy() for c in carry})

    carried = "".join(f", `{c}` {places.schema[c].dataType.simpleString()}" for c in carry)
    return _spread(want, files_each).mapInPandas(run, "path string, record_offset long, delta double, b double, npts int, bytes_read long, data array<float>" + carried)


def _samples(head: bytes) -> int:
    """Numbers that follow a header."""
    npts, kind = (int(np.frombuffer(head, byte_order(head) + "i4", 1, 280 + 4 * INT_FIELDS.index(k))[0]) for k in ("npts", "iftype"))
    return max(npts, 0) * (2 if kind == IXY else 1)


def _spread(df: DataFrame, each: int) -> DataFrame:
    """Rows dealt over tasks, `each` to a task."""
    return df.repartition(max(1, -(-df.count() // each)))


def station_geometry(places: DataFrame, path_col: str = "path", files_each: int = 256) -> DataFrame:
    """path, kstnm, stla, stlo, stel from the headers of the files that a table names, 632 bytes of each; places outside the globe are null."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path in b["path"]:
                raw = read_bytes(path, 0, HEADER_BYTES)
                floats = np.frombuffer(raw, byte_order(raw) + "f4", 70)
                lat, lon, ele = (float(floats[FLOAT_FIELDS.index(k)]) for k in ("stla", "stlo", "stel"))
                ok = abs(lat) <= 90 and abs(lon) <= 360
                rows.append((path, raw[440:448].decode("ascii", "replace").strip(), lat if ok else None, lon if ok else None, ele if abs(ele - NULL) > 1e-3 else None))
            yield pd.DataFrame(rows, columns=["path", "kstnm", "stla", "stlo", "stel"])

    return _spread(places.select(F.col(path_col).alias("path")), files_each).mapInPandas(run, "path string, kstnm string, stla double, stlo double, stel double")


#: Columns that a source with a pattern takes from the path.
PATH_FIELDS = {"network": "string", "station": "string", "location": "string", "component": "string", "time": "timestamp"}


class _Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


#: Filters that are decided from a path alone, so that no file that they exclude is opened.
_DECIDED = {
    "EqualTo": lambda x, v: x == v,
    "In": lambda x, v: x in v,
    "GreaterThan": lambda x, v: x > v,
    "GreaterThanOrEqual": lambda x, v: x >= v,
    "LessThan": lambda x, v: x < v,
    "LessThanOrEqual": lambda x, v: x <= v,
    "StringStartsWith": lambda x, v: x.startswith(v),
}


class _Folder:
    """The files below a folder, those of a pattern if one is given, with the fields of their paths."""

    def __init__(self, options: dict[str, str]):
        self.folder, self.each = options["path"], int(options.get("files", 256))
        self.pattern = PathPattern(options["pattern"], re.sub("^file:/*", "/", self.folder)) if "pattern" in options else None
        self.filters: list[tuple[str, str, object]] = []

    def fields(self, path: str) -> dict[str, object] | None:
        return {"path": path} if self.pattern is None else (got := self.pattern.read(path)) and {"path": path, **got}

    def wanted(self, paths: list[str]) -> list[str]:
        held = []
        for path in paths:
            own = self.fields(path)
            if own and all(own[c] is not None and _DECIDED[kind](own[c], value) for kind, c, value in self.filters):
                held.append(path)
        return held

    def parts(self, paths: list[str]) -> list[_Files]:
        return [_Files(paths[k : k + self.each]) for k in range(0, max(len(paths), 1), self.each)]

    def rows(self, partition: _Files) -> Iterator[tuple]:
        for path in partition.paths:
            got = decode(read_bytes(path))
            own = self.fields(path)
            yield (path, *(got[k] for k in COLUMNS), got["data"].tolist(), *(own[k] for k in PATH_FIELDS if self.pattern))


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.held = _Folder(options)

    def pushFilters(self, filters):
        known = {"path", *(PATH_FIELDS if self.held.pattern else ())}
        for f in filters:
            kind, column = type(f).__name__, f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            value = getattr(f, "value", None)
            if kind in _DECIDED and column in known and value is not None and not (kind == "In" and None in value):
                self.held.filters.append((kind, column, value.replace(tzinfo=None) if isinstance(value, datetime) else value))
            else:
                yield f

    def partitions(self) -> list[_Files]:
        return self.held.parts(self.held.wanted(listed(self.held.folder)))

    def read(self, partition: _Files) -> Iterator[tuple]:
        return self.held.rows(partition)


class _StreamReader(DataSourceStreamReader):
    """Offsets are numbers of log entries; an entry names files that were new when it was made. Each file is in one entry, whatever its time."""

    def __init__(self, options: dict[str, str]):
        self.held, self.log, self.most = _Folder(options), options.get("log"), int(options.get("files_per_batch", 1 << 30))
        if not self.log:
            raise ValueError("a stream of records needs the option log, a folder of its own")

    def _entry(self, k: int) -> str:
        return f"{self.log.rstrip('/')}/{k:09}.json"

    def _logged(self) -> list[str]:
        try:
            return listed(self.log, ".json")
        except FileNotFoundError:
            return []

    def initialOffset(self) -> dict:
        return {"entry": 0}

    def latestOffset(self) -> dict:
        entries = self._logged()
        seen = {path for e in entries for path in json.loads(read_bytes(e))}
        fresh = [x for x in self.held.wanted(listed(self.held.folder)) if x not in seen][: self.most]
        if fresh:
            write_bytes(self._entry(len(entries) + 1), json.dumps(fresh).encode())
        return {"entry": len(entries) + bool(fresh)}

    def partitions(self, start: dict, end: dict) -> list[_Files]:
        return self.held.parts([path for k in range(start["entry"] + 1, end["entry"] + 1) for path in json.loads(read_bytes(self._entry(k)))])

    def read(self, partition: _Files) -> Iterator[tuple]:
        return self.held.rows(partition)

    def commit(self, end: dict) -> None:
        pass


class SacSource(DataSource):
    """spark.read.format("sac").load(folder), or readStream with the option `log`, for folders that all executors see.

    With the option `pattern` (as in a configuration) only files that match it are read, the rows carry PATH_FIELDS, and filters on these and
    on the path are decided before files are opened. A stream takes in each new file once; files must appear whole, as `write` leaves them."""

    @classmethod
    def name(cls) -> str:
        return "sac"

    def schema(self) -> str:
        return SCHEMA + ("".join(f", {k} {t}" for k, t in PATH_FIELDS.items()) if "pattern" in self.options else "")

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)

    def streamReader(self, schema) -> _StreamReader:
        return _StreamReader(self.options)


def register(spark: SparkSession) -> None:
    """Makes the formats `sac` and `sacpack` known, and lets filters reach them."""
    from .pack import PackSink

    spark.dataSource.register(SacSource)
    spark.dataSource.register(PackSink)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def write(df: DataFrame, folder: str, name_col: str = "output_path") -> DataFrame:
    """One file a name below a folder that all executors see; records of one name follow one another. Returns name, records, bytes.

    A file appears under its name only when it is whole."""
    order = [c for c in ("timestamp",) if c in df.columns]

    def run(t: pd.DataFrame) -> pd.DataFrame:
        t = t.sort_values(order) if order else t
        raw = b"".join(encode(r) for r in t.to_dict("records"))
        name = t[name_col].iloc[0]
        write_bytes(f"{folder}/{name}", raw)
        return pd.DataFrame({"name": [name], "records": [len(t)], "bytes": [len(raw)]})

    return df.groupBy(name_col).applyInPandas(run, "name string, records long, bytes long")


def write_dat(df: DataFrame, folder: str, half: int, name_col: str = "output_path") -> DataFrame:
    """One text file a record (rows with the header's columns and data): two lines with longitude, latitude and elevation of source and receiver, then time, negative and positive side.

    The negative side is read backwards from lag -dt on, the positive from lag 0 on. Returns name and lines."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.to_dict("records"):
                number = lambda k, r=r: 0.0 if r.get(k) is None or r[k] != r[k] else float(r[k])
                if number("delta") <= 0:
                    raise ValueError(f"{r[name_col]}: the sampling interval is {number('delta')}")
                x = np.asarray(r["data"], float)
                sides = np.stack([np.arange(half + 1) * number("delta"), np.append(x[:half][::-1], 0.0), x[half:]], 1)
                rows = [[number(k) for k in ks] for ks in (("evlo", "evla", "evel"), ("stlo", "stla", "stel"))] + sides.tolist()
                name = re.sub(r"\.sac$", "", r[name_col], flags=re.IGNORECASE) + ".dat"
                write_bytes(f"{folder}/{name}", "".join(" ".join(f"{v:.7e}" for v in row) + "\n" for row in rows).encode())
                out.append((name, len(rows)))
            yield pd.DataFrame(out, columns=["name", "lines"])

    return df.mapInPandas(run, "name string, lines long")
