"""Token ids as binary files: one zstandard frame a document, and a trailing seek table with a checksum a frame.

A file is

    a zstandard frame a document: its ids as little-endian unsigned 32-bit integers
    a skippable frame, the directory: a signed 64-bit id a document, then a byte a document, 1 where the id is null
    a skippable frame, the seek table: for each frame before it the compressed size, the size of the ids in bytes and the low
        32 bits of the 64-bit xxHash of the ids (of the directory: its own bytes), then the number of frames, 0x80 and the magic number

which is the published layout of seekable zstandard files: plain `zstd -d` gives the ids of all documents one after another. A reader takes
the table from the end of a file, then fetches and decompresses the frames of the documents it wants, and no others.

Scale: documents are dealt by ranges of ids, each range sorted and written by one task as it is tokenized, so a task holds one pass of
text and the directory of its file. Files have some `FILE_BYTES` of text each. A task writes under a name of its own and moves the
whole file to the name of its range, so a task that runs again replaces its file by the same one. Where a document's ids start is summed over
files, from their seek tables, in blocks. Ids and texts are shuffled once.

Edge cases: a null or empty text is its end id alone; a very long text is one frame (more than 2^30 ids are an error); rows with equal ids stand in the order
of their places in the table, null ids last, so a hot id fills several files; an empty table gives no files and no rows; extra columns play no part,
whatever their names.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..sources import store
from . import _pieces, _text as X
from ._store import keep, shared_dir
from .shards import offsets

#: Bytes of text in a file, on average, and zstandard's level.
FILE_BYTES, LEVEL = 16 << 20, 3
#: Bytes of ids that a reading task hands over at once.
BATCH_BYTES = 4 << 20
# Fixed values of the seekable format: skippable frames, the table's end and its flag for checksums.
DIRECTORY_MAGIC, TABLE_MAGIC, END_MAGIC, CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
_ENTRY = np.dtype([("packed", "<u4"), ("size", "<u4"), ("check", "<u4")])
_END = struct.Struct("<IBI")
FILES = "file int, path string, n_docs long, n_tokens long, first_id long, last_id long"


def _check(raw: bytes) -> int:
    return xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF


# One file ---------------------------------------------------------------------------------------------------------


class FrameWriter:
    """Frames to an open stream, then `close` with the document ids."""

    def __init__(self, stream) -> None:
        self.stream, self.entries = stream, []
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)

    def add(self, ids: np.ndarray) -> None:
        raw = ids.astype("<u4", copy=False).tobytes()
        if len(raw) > 0xFFFFFFFF:
            raise ValueError(f"a document of {len(ids)} ids does not fit a frame")
        frame = self.packer.compress(raw)
        self.stream.write(frame)
        self.entries.append((len(frame), len(raw), _check(raw)))

    def close(self, doc_ids: pa.Array) -> None:
        held = doc_ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes() + np.asarray(doc_ids.is_null()).astype(np.uint8).tobytes()
        self.stream.write(struct.pack("<II", DIRECTORY_MAGIC, len(held)) + held)
        table = np.array([*self.entries, (8 + len(held), 0, _check(held))], _ENTRY)
        end = _END.pack(len(table), CHECKSUMS, END_MAGIC)
        self.stream.write(struct.pack("<II", TABLE_MAGIC, table.nbytes + len(end)) + table.tobytes() + end)


class FrameReader:
    """A file's table and directory; `ids(k)` fetches, decompresses and checks the frame of the k-th document alone."""

    def __init__(self, path: str) -> None:
        self.path = path
        files, inner = store.filesystem(path)
        self.stream = files.open_input_file(inner)
        try:
            size = self.stream.size()
            frames, flags, magic = _END.unpack(self._bytes(size - _END.size, _END.size))
            self._want(magic == END_MAGIC and flags == CHECKSUMS, "has no seek table with checksums at its end")
            at = size - _END.size - frames * _ENTRY.itemsize
            self._want(frames > 0 and struct.unpack("<I", self._bytes(at - 8, 4))[0] == TABLE_MAGIC, "has a damaged seek table")
            self.table = np.frombuffer(self._bytes(at, frames * _ENTRY.itemsize), _ENTRY)
            self.begin = np.cumsum(self.table["packed"], dtype=np.int64) - self.table["packed"]
            self._want(self.begin[-1] + self.table["packed"][-1] == at - 8, "has a damaged seek table")
            n = frames - 1
            held = self._bytes(int(self.begin[-1]) + 8, 9 * n)
            self._want(_check(held) == self.table["check"][-1], "has a damaged directory")
            self.doc_ids = pa.array(np.frombuffer(held, "<i8", n), mask=np.frombuffer(held, np.uint8, n, 8 * n).astype(bool))
            self.n_tokens = self.table["size"][:-1].astype(np.int64) // 4
        except BaseException:
            self.stream.close()
            raise

    def _want(self, ok: bool, what: str) -> None:
        if not ok:
            raise ValueError(f"{self.path} {what}")

    def _bytes(self, at: int, size: int) -> bytes:
        self._want(at >= 0, "is too short")
        got = self.stream.read_at(size, at)
        self._want(len(got) == size, "is too short")
        return got

    def ids(self, k: int) -> bytes:
        """The ids of the k-th document, little-endian unsigned 32-bit."""
        packed, size, check = (int(x) for x in self.table[k])
        raw = zstandard.ZstdDecompressor().decompress(self._bytes(int(self.begin[k]), packed), max_output_size=size)
        self._want(len(raw) == size and _check(raw) == check, f"has a damaged frame {k}")
        return raw

    def __enter__(self) -> FrameReader:
        return self

    def __exit__(self, *_) -> None:
        self.stream.close()


# Tables of files --------------------------------------------------------------------------------------------------


def write_documents(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes files below `folder` in ascending order of ids; returns FILES, a row a file, in the order of `file`."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // file_bytes))
    order = [F.col("id").asc_nulls_last(), F.col("place")]
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("place"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        path = f"{folder}/ids-{number:07}.zst"
        files, inner = store.filesystem(path)
        part, stream, held, tokens = f"{inner}.{uuid.uuid4().hex}", None, [], 0
        for b in batches:
            if not len(b):
                continue
            if stream is None:
                files.create_dir(inner.rpartition("/")[0], recursive=True)
                stream = files.open_output_stream(part)
                writer = FrameWriter(stream)
            held.append(X.column(b, "id"))
            for _, ids, at in _pieces.encode(X.column(b, "text"), tokenizer_path, end_id):
                tokens += len(ids)
                for a, z in zip(at[:-1], at[1:], strict=True):
                    writer.add(ids[a:z])
        if stream is not None:
            ids = pa.concat_arrays(held)
            writer.close(ids)
            stream.close()
            files.move(part, inner)
            some = ids.drop_null()
            first, last = (some[0].as_py(), some[-1].as_py()) if len(some) else (None, None)
            yield pa.RecordBatch.from_pylist([{"file": number, "path": path, "n_docs": len(ids), "n_tokens": tokens, "first_id": first, "last_id": last}], _FILES_ARROW)

    return keep(rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order).select("id", "text").mapInArrow(run, FILES))


_FILES_ARROW = pa.schema([("file", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("first_id", pa.int64()), ("last_id", pa.int64())])


def _one_each(files: DataFrame) -> DataFrame:
    """A task for each file."""
    return files.repartition(max(1, files.count()))


def starts(files: DataFrame) -> DataFrame:
    """file, path and `start`, the ids of all files before, from the files' own seek tables."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sums = []
            for path in b.column("path").to_pylist():
                with FrameReader(path) as f:
                    sums.append(int(f.n_tokens.sum()))
            yield pa.RecordBatch.from_arrays([b.column("file"), b.column("path"), pa.array(sums, pa.int64())], ["file", "path", "held"])

    held = keep(_one_each(files.select("file", "path")).mapInArrow(run, "file int, path string, held long"))
    before = offsets(held.select("file", "held"), "file", "held")
    return held.join(before.select("file", F.col("offset").alias("start")), "file").select("file", "path", F.col("start").cast("long").alias("start"))


READ = "doc_id long, file int, place int, start long, n_tokens long, ids binary"


def read_documents(files: DataFrame, wanted: list[int] | None = None) -> DataFrame:
    """READ of all documents, or of those with the ids in `wanted`, whose frames alone are read; place: number in the file, start: ids of all documents before.

    files: as `starts` gives them. A frame that does not fit its checksum is an error."""
    asked = None if wanted is None else pa.array(wanted, pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for number, path, start in zip(*(b.column(c).to_pylist() for c in ("file", "path", "start")), strict=True):
                with FrameReader(path) as f:
                    own = np.cumsum(f.n_tokens) - f.n_tokens + start
                    places = np.arange(len(own)) if asked is None else np.flatnonzero(np.asarray(pc.is_in(f.doc_ids, value_set=asked)))
                    edges = np.flatnonzero(np.diff(np.cumsum(f.n_tokens[places]) * 4 // BATCH_BYTES)) + 1
                    for held in np.split(places, edges):
                        if len(held):
                            raw = pa.array([f.ids(int(k)) for k in held], pa.binary())
                            yield pa.RecordBatch.from_arrays([f.doc_ids.take(pa.array(held)), pa.array(np.full(len(held), number), pa.int32()), pa.array(held, pa.int32()), pa.array(own[held], pa.int64()), pa.array(f.n_tokens[held], pa.int64()), raw], ["doc_id", "file", "place", "start", "n_tokens", "ids"])

    return _one_each(files.select("file", "path", "start")).mapInArrow(run, READ)


def token_files(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the documents to files in the session's shared folder and returns READ, read back from them."""
    folder = f"{shared_dir(docs.sparkSession)}/token-files-{uuid.uuid4().hex}"
    return read_documents(starts(write_documents(docs, folder, tokenizer_path, end_id, id_col, text_col)))
