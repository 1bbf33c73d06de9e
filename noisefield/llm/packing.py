"""Best-two-fit packing of tokenized documents into sequences of a fixed length.

Documents become ids and an end id; only those longer than a sequence are cut. The pieces (numbers only) are written to a table; they are dealt by a hash of their
place in it, so that repeated rows are spread too and a lost task deals as before, to groups of a bounded mean size, and each group is packed by one task: fill a sequence greedily
with the largest piece that fits, then put its smallest piece back if two unpacked pieces fill the widened gap
more tightly. A group wastes at most its last sequence, so the count stays within one a group of packing all
together. Full pieces need no packing and get a sequence each where they are cut.

Edge cases: a null or empty text is its end id alone; a very long text is cut into full pieces, and only its last piece is packed; repeated
rows and null ids are packed each by itself; an empty table gives no rows; extra columns play no part, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from . import _text as X, _tokens
from ._store import keep

SEQUENCE = 4096
#: Mean number of documents whose pieces one task packs.
GROUP_DOCS = 40_000


def pack(lengths: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each length; lengths are 1 to `most`."""
    n = len(lengths)
    order = np.argsort(lengths, kind="stable")
    left = np.bincount(lengths, minlength=most + 1)
    top = np.cumsum(left)  # the next piece of a length is order[top - 1]
    axis = np.arange(most + 1)
    seq, offset = np.empty(n, np.int64), np.empty(n, np.int64)
    fits = np.maximum.accumulate(np.where(left > 0, axis, 0))
    done = number = 0

    def take(size: int) -> None:
        nonlocal fits
        left[size] -= 1
        if not left[size]:
            fits = np.maximum.accumulate(np.where(left > 0, axis, 0))

    while done < n:
        held, gap = [], most
        while gap and fits[gap]:
            size = int(fits[gap])
            take(size)
            held.append(size)
            gap -= size
        if gap and done + len(held) < n:
            small = held[-1]
            room = gap + small
            a = np.flatnonzero(left[: room + 1])
            b = fits[room - a]
            alone = (b == a) & (left[a] == 1)
            b = np.where(alone, fits[np.maximum(a - 1, 0)], b)
            total = np.where(b > 0, a + b, 0)
            if len(total) and total.max() > small:
                k = int(total.argmax())
                held[-1:] = [int(a[k]), int(b[k])]
                take(int(a[k]))
                take(int(b[k]))
                left[small] += 1
                fits = np.maximum.accumulate(np.where(left > 0, axis, 0))
        place = 0
        for size in held:
            x = order[top[size] - 1]
            top[size] -= 1
            seq[x], offset[x] = number, place
            place += size
        done += len(held)
        number += 1
    return seq, offset


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int = 1, most: int = SEQUENCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece; full pieces also carry a sequence of their own."""
    id_type = docs.schema[id_col].dataType.simpleString()
    names = ["piece", "start", "length", "ids_crc32", "full_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = -(TaskContext.get().partitionId() << 36) - 1
        for b in batches:
            key = X.column(b, id_col)
            rows: list[tuple[int, int, int, int, int, int | None]] = []
            for i, ids, at in _tokens.encode(X.column(b, text_col), tokenizer_path, end_id):
                raw = memoryview(ids).cast("B")
                for d in range(len(at) - 1):
                    for p, a in enumerate(range(at[d], at[d + 1], most)):
                        z = min(a + most, int(at[d + 1]))
                        full = None
                        if z - a == most:
                            full, own = own, own - 1
                        rows.append((i + d, p, p * most, z - a, zlib.crc32(raw[4 * a : 4 * z]), full))
            cols = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([key.take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[2:])], [id_col, *names])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type}, piece int, start long, length long, ids_crc32 long, full_id long")


def best_two_fit(docs: DataFrame, tokenizer_path: str, end_id: int = 1, most: int = SEQUENCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a piece with its sequence_id and offset."""
    groups = max(1, -(-docs.count() // GROUP_DOCS))
    cut = keep(pieces(docs, tokenizer_path, end_id, most, id_col, text_col))
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        group = int(pdf["pack_group"].iloc[0])
        full = pdf["full_id"].notna().to_numpy()
        seq = np.zeros(len(pdf), np.int64)
        offset = np.zeros(len(pdf), np.int64)
        seq[full] = pdf["full_id"][full].astype("int64")
        rest = pdf[~full].sort_values([id_col, "piece", "ids_crc32"], kind="stable")
        if len(rest):
            s, o = pack(rest["length"].to_numpy(np.int64), most)
            where = pdf.index.get_indexer(rest.index)
            seq[where], offset[where] = s + (group << 36), o
        return pd.DataFrame({id_col: pdf[id_col], "piece": pdf["piece"], "start": pdf["start"], "length": pdf["length"], "ids_crc32": pdf["ids_crc32"], "sequence_id": seq, "offset": offset})

    dealt = cut.withColumn("pack_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    return dealt.groupBy("pack_group").applyInPandas(run, schema)
