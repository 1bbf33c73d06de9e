"""Packs: many records a file, with an index of where each one is, that appear all at once.

`df.write.format("sacpack").option("keys", "timestamp,path_id,slot").save(folder)` writes the rows (header fields, data and keys) as records
one after another. A task starts a new file where one would grow beyond `roll_bytes`, and writes an index table for each file. All of that stands in a
folder of the job until every task is done; then the files are moved into the folder, and a commit, a small file that names
them, is written last. Readers see what commits name and nothing else, so a task that was killed, run twice or left behind by a lost executor
leaves nothing visible; an aborted job removes its folder. Appending adds a commit; overwriting writes a commit that leaves out those before,
whose files are then removed.

Rows keep the order of their task: sort within partitions first for packs in the order of time and pair.
"""

from __future__ import annotations

import io
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from . import sac
from .store import delete, filesystem, listed, move, read_bytes, write_bytes

#: Bytes beyond which a pack file is not continued.
ROLL_BYTES = 4 << 30
#: Index rows of a file that a task holds, at most; a file ends there too.
ROLL_RECORDS = 1_000_000
PLACES = "record_path string, record_offset long, bytes long, npts long"


@dataclass
class _Written(WriterCommitMessage):
    #: name, bytes, records of each file
    files: list[tuple[str, int, int]] = field(default_factory=list)


class PackWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], columns: list[str], overwrite: bool) -> None:
        self.folder, self.overwrite = options["path"].rstrip("/"), overwrite
        self.keys = [k.strip() for k in options.get("keys", "timestamp,path_id,slot").split(",") if k.strip()]
        missing = [c for c in (*self.keys, "data") if c not in columns]
        if missing:
            raise ValueError(f"a pack needs the columns {', '.join(missing)}")
        self.roll, self.most = int(options.get("roll_bytes", ROLL_BYTES)), int(options.get("roll_records", ROLL_RECORDS))
        self.job = uuid.uuid4().hex

    @property
    def staging(self) -> str:
        return f"{self.folder}/_job-{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        out, places, stream, at, name = _Written(), [], None, 0, ""
        files, inner = filesystem(self.staging)
        files.create_dir(inner, recursive=True)

        def close() -> None:
            stream.close()
            index = _index(places)
            raw = io.BytesIO()
            pq.write_table(index, raw)
            write_bytes(f"{self.staging}/{name}.index.parquet", raw.getvalue())
            out.files.append((name, at, len(index)))

        for batch in iterator:
            keys = pa.Table.from_batches([batch.select(self.keys)])
            for k, row in enumerate(batch.to_pylist()):
                raw = sac.encode(row)
                if stream is not None and (at + len(raw) > self.roll or sum(len(p) for _, p in places) >= self.most):
                    close()
                    stream, places = None, []
                if stream is None:
                    name, at = f"pack-{uuid.uuid4().hex}", 0
                    stream = files.open_output_stream(f"{inner}/{name}.sac")
                stream.write(raw)
                if not places or places[-1][0] is not keys:
                    places.append((keys, []))
                places[-1][1].append((k, at, len(raw), (len(raw) - sac.HEADER_BYTES) // 4))
                at += len(raw)
        if stream is not None:
            close()
        return out

    def commit(self, messages: list[_Written | None]) -> None:
        held = sorted(x for m in messages if m is not None for x in m.files)
        for name, _, _ in held:
            for end in (".sac", ".index.parquet"):
                move(f"{self.staging}/{name}{end}", f"{self.folder}/{name}{end}")
        before = _commits(self.folder)
        number = max((c["number"] for c in before), default=0) + 1
        facts = {"number": number, "replaces": number if self.overwrite else 0, "keys": self.keys, "files": [{"name": n, "bytes": b, "records": r} for n, b, r in held]}
        write_bytes(f"{self.folder}/_commit-{number:06}-{self.job}.json", json.dumps(facts).encode())
        delete(self.staging)
        if self.overwrite:
            for c in before:
                for f in c["files"]:
                    for end in (".sac", ".index.parquet"):
                        delete(f"{self.folder}/{f['name']}{end}")
                delete(c["path"])

    def abort(self, messages: list[_Written | None]) -> None:
        delete(self.staging)


def _index(places: list[tuple[pa.Table, list[tuple[int, int, int, int]]]]) -> pa.Table:
    """The keys of the records of a file, and where each is in it."""
    parts = []
    for keys, held in places:
        rows, *cols = zip(*held, strict=True)
        part = keys.take(pa.array(rows))
        for name, values in zip(("record_offset", "bytes", "npts"), cols, strict=True):
            part = part.append_column(name, pa.array(values, pa.int64()))
        parts.append(part)
    return pa.concat_tables(parts)


class PackSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sacpack"

    def writer(self, schema, overwrite: bool) -> PackWriter:
        return PackWriter(self.options, schema.fieldNames(), overwrite)


def _commits(folder: str) -> list[dict]:
    """Commits that count, in order."""
    try:
        found = [x for x in listed(folder, ".json") if x.rpartition("/")[2].startswith("_commit-")]
    except FileNotFoundError:
        return []
    held = sorted(({**json.loads(read_bytes(x)), "path": x} for x in found), key=lambda c: (c["number"], c["path"]))
    since = max((c["replaces"] for c in held), default=0)
    return [c for c in held if c["number"] >= since]


def pack_index(spark: SparkSession, folder: str) -> DataFrame:
    """The keys of all records that commits name, with record_path, record_offset, bytes and npts."""
    folder = folder.rstrip("/")
    names = [f["name"] for c in _commits(folder) for f in c["files"]]  # file names
    if not names:
        raise FileNotFoundError(f"no records have been committed in {folder}")
    index = spark.read.parquet(*(f"{folder}/{n}.index.parquet" for n in names))
    return index.withColumn("record_path", F.concat(F.lit(f"{folder}/"), F.regexp_extract("_metadata.file_path", r"([^/]+)\.index\.parquet$", 1), F.lit(".sac")))


def read_pack(places: DataFrame) -> DataFrame:
    """The records at rows of `pack_index` (all, or those that a filter left), with their keys."""
    keys = tuple(c for c in places.columns if c not in ("record_path", "record_offset", "bytes", "npts"))
    return sac.read_records(places, "record_path", "record_offset", "bytes", carry=keys).withColumnRenamed("path", "record_path")
