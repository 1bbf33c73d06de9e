"""Stacks over time of the correlations of a pair and slot.

All three are sums. The linear stack is an aggregate of each lag. The phase-weighted stacks first sum records in time order in
chunks of `size`. The chunks of a key go to one task, batch by batch; there each gives its counted unit phasors, of which only the sums
are held, and the stack is finished from them: what is shuffled are chunks, never phasors. For the time-frequency stack a key has a block of
frequencies too, so a task holds the phasors of one block, and a chunk is sent once to each block. `streaming.incremental` adds records to the same sums as they come in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..functions import spectral as S
from .vectors import lists, mean_arrays, rows_of, sum_arrays

KEYS = ["path_id", "slot"]


def linear_stack(ncf: DataFrame, width: int, keys: list[str] | None = None) -> DataFrame:
    """keys, n and the mean of the records. width: numbers in data, the same in all records."""
    return mean_arrays(ncf, keys or KEYS, width, "n")


def chunks(ncf: DataFrame, size: int, width: int) -> DataFrame:
    """Sums of consecutive records: path_id, slot, chunk, count, data. Records are numbered by their keys alone."""
    order = Window.partitionBy(*KEYS).orderBy("timestamp")
    number = ncf.select(*KEYS, "timestamp").distinct().withColumn("chunk", F.floor((F.row_number().over(order) - 1) / max(size, 1)).cast("int"))
    return sum_arrays(ncf.join(number, [*KEYS, "timestamp"]), [*KEYS, "chunk"], width, "count")


class Phases:
    """The phase-weighted stack of a key: the mean of the records times the coherence of the chunks' phases, sample by sample."""

    firsts: tuple[int, ...] = (0,)

    def __init__(self, width: int) -> None:
        self.width = width

    def shape(self, first: int) -> tuple[int, ...]:
        return (self.width,)

    def phasors(self, x: np.ndarray, count: np.ndarray, first: int) -> np.ndarray:
        """The unit phasors of the sums of chunks, counted and added up."""
        z, count = S.analytic(x), count[:, None]
        # the means of the chunks have the phases of their sums
        return (z / np.maximum(np.abs(z), 1e-7 * count) * count).sum(axis=0)

    def finish(self, total: np.ndarray, n: int, sums: np.ndarray, first: int) -> np.ndarray:
        return total / n * np.abs(sums) / n


#: Frequencies in a block, and chunks whose local spectra are held at once.
BLOCK, AT_ONCE = 64, 16


class LocalPhases(Phases):
    """The time-frequency stack, block by block of frequencies: the mean's local spectrum weighted by the coherence of the chunks' local phases.

    What a block gives is its part of the stack's spectrum, real parts before imaginary ones; the first number -1 stands for the mean's own spectrum, which
    stays outside `band`."""

    def __init__(self, width: int, delta: float = 1.0, band: tuple[float, float] | None = None, taper: float | None = None, zero_shift_gain: float = 1.0, scale: float = 0.1) -> None:
        super().__init__(width)
        self.half, self.gain, self.scale = width // 2 + 1, zero_shift_gain, scale
        self.alpha = S.band_share(width, delta, band, taper)
        self.firsts = (-1, *(k for k in range(0, self.half, BLOCK) if self.alpha[k : k + BLOCK].any()))

    def _range(self, first: int) -> slice:
        return slice(0, self.half) if first < 0 else slice(first, min(first + BLOCK, self.half))

    def shape(self, first: int) -> tuple[int, ...]:
        return (0,) if first < 0 else (self._range(first).stop - first, self.width)

    def _local(self, x: np.ndarray, first: int) -> np.ndarray:
        return S.s_transform(S.positive(np.fft.fft(x)), first, self._range(first).stop, self.scale, self.gain)

    def phasors(self, x: np.ndarray, count: np.ndarray, first: int) -> np.ndarray:
        out = np.zeros(self.shape(first), complex)
        for k in range(0, len(x) if first >= 0 else 0, AT_ONCE):
            z = self._local(x[k : k + AT_ONCE], first)
            size = np.abs(z)
            out += (z / np.where(size <= 1e-7, 1.0, size) * count[k : k + AT_ONCE, None, None]).sum(axis=0)
        return out

    def finish(self, total: np.ndarray, n: int, sums: np.ndarray, first: int) -> np.ndarray:
        held = self._range(first)
        own = S.positive(np.fft.fft(total / n))[held]
        if first >= 0:
            z = (self._local(total[None] / n, first)[0] * (np.abs(sums) / n)).sum(axis=-1)
            own = own * (1 - self.alpha[held]) + z * self.alpha[held]
        return np.concatenate([own.real, own.imag])

    def whole(self, pieces: dict[int, np.ndarray]) -> np.ndarray:
        """The stack from the parts of its spectrum."""
        out = np.zeros(self.width, complex)
        for first in sorted(pieces):
            re, im = np.split(np.asarray(pieces[first], float), 2)
            out[self._range(first)] = re + 1j * im
        return np.fft.ifft(out).real


class PhaseSums:
    """What a stack needs of the records so far: their number, that of the chunks, and the sums of both and of the phasors."""

    def __init__(self, how: Phases, first: int = 0) -> None:
        self.how, self.first, self.n, self.chunks = how, first, 0, 0
        self.total, self.sums = np.zeros(how.width), np.zeros(how.shape(first), complex)

    def add(self, x: np.ndarray, count: np.ndarray) -> None:
        """Sums of chunks, and their numbers of records."""
        self.n, self.chunks = self.n + int(count.sum()), self.chunks + len(x)
        self.total = self.total + x.sum(axis=0)
        self.sums = self.sums + self.how.phasors(x, count, self.first)

    def stack(self) -> np.ndarray:
        return self.how.finish(self.total, self.n, self.sums, self.first)


PIECES = "path_id long, slot int, first int, n long, chunks int, data array<double>"


def weighted_pieces(parts: DataFrame, how: Phases) -> DataFrame:
    """PIECES of each key from its chunks, a row for each of `how.firsts`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, key = None, None
        for b in batches:
            if len(b):
                if sums is None:
                    key = [b.column(c).slice(0, 1) for c in (*KEYS, "first")]
                    sums = PhaseSums(how, key[2][0].as_py())
                sums.add(rows_of(b, "data"), b.column("count").to_numpy().astype(float))
        if sums is not None:
            yield pa.RecordBatch.from_arrays([*key, pa.array([sums.n], pa.int64()), pa.array([sums.chunks], pa.int32()), lists(sums.stack()[None])], [*KEYS, "first", "n", "chunks", "data"])

    sent = parts.withColumn("first", F.explode(F.array(*map(F.lit, how.firsts)))).select(*KEYS, "first", "count", "data")
    return sent.groupBy(*KEYS, "first").applyInArrow(run, PIECES)


def assemble(pieces: DataFrame, how: LocalPhases) -> DataFrame:
    """path_id, slot, n, chunks and data from the pieces of the time-frequency stack."""

    def run(t: pa.Table) -> pa.Table:
        data = how.whole(dict(zip(t.column("first").to_pylist(), t.column("data").to_pylist(), strict=True)))
        one = t.slice(0, 1).combine_chunks()
        return pa.Table.from_arrays([one.column(c) for c in (*KEYS, "n", "chunks")] + [lists(data[None])], [*KEYS, "n", "chunks", "data"])

    return pieces.groupBy(*KEYS).applyInArrow(run, "path_id long, slot int, n long, chunks int, data array<double>")


def phase_weighted_stack(ncf: DataFrame, size: int, width: int) -> DataFrame:
    """path_id, slot, n, chunks and the mean of the records times the coherence of the chunks' phases, sample by sample."""
    return weighted_pieces(chunks(ncf, size, width), Phases(width)).drop("first")


def time_frequency_stack(ncf: DataFrame, size: int, width: int, delta: float = 1.0, band: tuple[float, float] | None = None, taper: float | None = None, zero_shift_gain: float = 1.0, scale: float = 0.1) -> DataFrame:
    """path_id, slot, n, chunks and the mean of the records, its local spectrum weighted by the coherence of the chunks' local phases; outside `band` the mean's spectrum stays."""
    how = LocalPhases(width, delta, band, taper, zero_shift_gain, scale)
    return assemble(weighted_pieces(chunks(ncf, size, width), how), how)
