"""Conditioning, spectra and pairwise correlations.

channels: timestamp, nsl_id, component, data (array of doubles). Traces and spectra are computed once a channel, before pairs
are formed; records are cut into windows inside the task.

Stations are dealt into blocks of neighbouring numbers, and a task gets a tile: two blocks at one timestamp. A trace or
spectrum is sent once to each tile that its block is in and has pairs, not once a pair; the tile correlates its pairs,
sums over steps and returns lags. What is shuffled grows with stations times blocks; a tile's memory is bounded by `TILE_BYTES`. Where
the spectra of two blocks are more than that, they are cut into ranges of frequency, a tile for each: the inverse transform is
linear, so the lags of a pair's ranges are added up. `layout` chooses stations of a block and ranges so that spectra and partial lags
together are least.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import spectral as S
from .vectors import lists, sum_arrays

#: Order of components inside a pair.
COMPONENT_RANK = {"E": 0, "1": 0, "R": 0, "N": 1, "2": 1, "T": 1, "Z": 2, "3": 2}


def component_rank(component: Column) -> Column:
    last = F.substring(component, -1, 1)
    out = F.lit(100)
    for name, rank in COMPONENT_RANK.items():
        out = F.when(last == name, rank).otherwise(out)
    return out


def slot(src: Column, rec: Column) -> Column:
    return component_rank(src) * 3 + component_rank(rec)


@dataclass
class Conditioning:
    """How traces become spectra. Bands in Hz; normalize is OFF, ONE-BIT, RUN-ABS, RUN-ABS-MF or AUTO; whiten OFF, BEFORE, AFTER or BOTH.

    Filters run on windows padded by twice their impulse length, a window at most."""

    delta: float
    window: int
    shift: int
    max_lag: int
    bands: tuple[tuple[float, float], ...] = ()
    normalize: str = "AUTO"
    whiten: str = "AFTER"
    phase_only: bool = False
    skip_steps: tuple[int, ...] = ()

    def __post_init__(self) -> None:
        if self.normalize == "AUTO":
            self.normalize = "OFF" if not self.bands else "RUN-ABS" if len(self.bands) == 1 else "RUN-ABS-MF"
        if self.normalize not in ("OFF", "ONE-BIT", "RUN-ABS", "RUN-ABS-MF"):
            raise ValueError(f"unknown normalisation {self.normalize!r}")
        if self.whiten not in ("OFF", "BEFORE", "AFTER", "BOTH"):
            raise ValueError(f"unknown whitening {self.whiten!r}")
        self.length = S.output_length(self.window, self.max_lag)
        self.filter_length = S.filter_length(S.filter_bank(list(self.bands), self.delta), self.window) if self.bands else None


def condition(rows: np.ndarray, c: Conditioning) -> np.ndarray:
    """Components of one station and step (the last two axes: component, sample) through the whole chain; time domain."""
    n = rows.shape[-1]
    x = np.nan_to_num(rows, nan=0.0, posinf=0.0, neginf=0.0)
    x = x - x.mean(axis=-1, keepdims=True)
    i = np.arange(n) - (n - 1) / 2
    x = x - (x @ i / max((i @ i), 1e-300))[..., None] * i
    bank = S.filter_bank(list(c.bands), c.delta)
    if bank:
        low = bank[0][0]
        ramp = min(int(2 / low / c.delta), n)
        head = np.ones(n)
        k = np.arange(n)
        head[n - ramp + 1 :] = 0.5 * (1 - np.cos(np.pi * (n - k[n - ramp + 1 :]) / ramp))
        head[:ramp] = 0.5 * (1 - np.cos(np.pi * k[:ramp] / ramp))
        x = S.band_filter(x * head, bank[0][2], bank[0][3], c.filter_length)
        if c.whiten in ("BEFORE", "BOTH"):
            x = S.whiten(x, bank[0][0], bank[0][1], c.delta)
    if c.normalize == "ONE-BIT":
        x = np.sign(x)
    elif c.normalize == "RUN-ABS":
        x = S.run_abs(x, S.running_window(bank[0][0], c.delta) if bank else n)
    elif c.normalize == "RUN-ABS-MF":
        x = S.run_abs_bands(x, bank, c.delta, c.filter_length)
    if bank and c.whiten in ("AFTER", "BOTH"):
        x = S.whiten(x, bank[0][0], bank[0][1], c.delta)
    return x


def windows(x: np.ndarray, c: Conditioning) -> np.ndarray:
    """The windows of a trace, a shift apart; a rest that fills no window is dropped."""
    if len(x) < c.window:
        return np.zeros((0, c.window))
    return np.lib.stride_tricks.sliding_window_view(x, c.window)[:: c.shift]


def spectra(channels: DataFrame, c: Conditioning, keys: list[str] | None = None) -> DataFrame:
    """One row a channel and step: keys, component, step, re, im. All components of a station and step share their weights.

    A task works on one station's record of one timestamp at a time, all its steps at once. A record all of whose steps are to be skipped is an error."""
    keys = keys or ["timestamp", "nsl_id"]
    skipped = np.array(c.skip_steps, int)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("component")
        cut = [windows(np.asarray(x, float), c) for x in pdf["data"]]
        count = np.array([len(x) for x in cut])
        found = []
        # channels may have different numbers of windows: stretches of steps with the same channels
        edges = np.unique(np.append(count, 0))
        for first, last in zip(edges[:-1], edges[1:], strict=True):
            steps = np.setdiff1d(np.arange(first, last), skipped)
            if len(steps):
                held = np.flatnonzero(count >= last)
                z = S.spectrum(condition(np.stack([cut[k][steps] for k in held], 1), c), c.length, c.delta)
                if c.phase_only:
                    size = np.abs(z)
                    z = np.where(size <= 1e-30, 0, z / np.maximum(size, 1e-30))
                found += [(k, s, z[i, j]) for i, s in enumerate(steps) for j, k in enumerate(held)]
        if not found and count.any():
            raise ValueError(f"skip_steps leaves none of the {count.max()} steps of a record")
        at = [k for k, _, _ in found]
        out = pdf[[*keys, "component"]].iloc[at].reset_index(drop=True)
        out["step"] = np.array([s for _, s, _ in found], np.int32)
        out["re"], out["im"] = [z.real for *_, z in found], [z.imag for *_, z in found]
        return out

    types = {f.name: f.dataType.simpleString() for f in channels.schema.fields}
    return channels.select(*keys, "component", "data").groupBy(*keys).applyInPandas(run, ", ".join(f"{k} {types[k]}" for k in keys) + ", component string, step int, re array<double>, im array<double>")


def plain_spectra(channels: DataFrame, length: int, delta: float) -> DataFrame:
    """timestamp, nsl_id, component, re, im of whole traces of equal length, without conditioning and without a shuffle."""
    names = ["timestamp", "nsl_id", "component"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                z = S.spectrum(b.column("data").flatten().to_numpy(zero_copy_only=False).reshape(len(b), -1), length, delta)
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), lists(z.real), lists(z.imag)], [*names, "re", "im"])

    types = {f.name: f.dataType.simpleString() for f in channels.schema.fields}
    return channels.select(*names, "data").mapInArrow(run, ", ".join(f"{c} {types[c]}" for c in names) + ", re array<double>, im array<double>")


#: Bytes of the traces or spectra of a tile, on average, and most stations of a block.
TILE_BYTES, MOST_BLOCK = 128 << 20, 64

#: From an array (channel, step, number), the places of sources and receivers in it and the first number's frequency: the lags of each pair, summed over steps.
Kernel = Callable[[np.ndarray, np.ndarray, np.ndarray, int], np.ndarray]


def layout(station_bytes: int, lag_bytes: int, numbers: int, tile_bytes: int | None = None) -> tuple[int, int]:
    """Stations of a block, and ranges into which the numbers of a spectrum are cut.

    With b stations a block and r ranges, station_bytes / b are sent for each pair of stations and 9 * r * lag_bytes / 2 come back if r > 1; a tile holds
    2 * b * station_bytes / r."""
    tile = tile_bytes or TILE_BYTES
    whole = tile // (2 * max(station_bytes, 1))
    if whole >= 8:  # blocks of a good size without a cut
        return min(MOST_BLOCK, whole), 1
    block = max(2, min(MOST_BLOCK, round(math.sqrt(tile / (9 * max(lag_bytes, 1))))))
    return block, min(-(-2 * block * station_bytes // tile), numbers)


def _tiles(rows: DataFrame, paths: DataFrame, carry: list[str], numbers: int, station_bytes: int, half: int, kernel: Kernel, tile_bytes: int | None = None) -> DataFrame:
    """timestamp, path_id, slot, steps and data (the mean over common steps) of all pairs of `paths`. rows: timestamp, nsl_id, component, step and `carry` (arrays of `numbers`), at most once each."""
    width = 2 * half + 1
    block, ranges = layout(station_bytes, 8 * width, numbers, tile_bytes) if len(carry) == 2 else (max(1, min(MOST_BLOCK, (tile_bytes or TILE_BYTES) // (2 * max(station_bytes, 1)))), 1)
    of = lambda c: F.floor(F.col(c) / block).cast("int")
    pairs = paths.select("path_id", "src_id", "rec_id", of("src_id").alias("i"), of("rec_id").alias("j"))
    # where a station's rows go: as a source with its receivers there (a block of them at most), as a receiver without
    sources = pairs.groupBy(F.col("src_id").alias("nsl_id"), "i", "j").agg(F.collect_list("rec_id").alias("receivers"), F.collect_list("path_id").alias("path_ids"))
    none = [F.lit(None).cast(t).alias(c) for c, t in sources.dtypes[3:]]
    ends = sources.unionByName(pairs.select(F.col("rec_id").alias("nsl_id"), "i", "j").distinct().select("*", *none))
    rows = rows.select("timestamp", "nsl_id", "component", "step", F.lit(0).alias("first"), *carry)
    if ranges > 1:
        each = -(-numbers // ranges)
        cut = F.array(*(F.struct(F.lit(k).alias("first"), *(F.slice(c, k + 1, each).alias(c) for c in carry)) for k in range(0, numbers, each)))
        rows = rows.select("timestamp", "nsl_id", "component", "step", F.inline(cut))
    sent = rows.join(ends, "nsl_id")
    time_type = rows.schema["timestamp"].dataType.simpleString()

    def run(t: pa.Table) -> pa.Table:
        station, step = _column(t, "nsl_id").to_numpy(), _column(t, "step").to_numpy()
        rank = np.array([COMPONENT_RANK.get(c[-1:], 100) for c in _column(t, "component").to_pylist()], np.int64)
        lists_at = np.flatnonzero(_column(t, "receivers").is_valid().to_numpy(zero_copy_only=False))
        _, first = np.unique(station[lists_at], return_index=True)
        told = t.take(pa.array(lists_at[first]))
        path, rec = (_column(told, c).flatten().to_numpy() for c in ("path_ids", "receivers"))
        src = np.repeat(_column(told, "nsl_id").to_numpy(), _column(told, "receivers").value_lengths().to_numpy())
        channel, which = np.unique(np.stack([station, rank], 1), axis=0, return_inverse=True)
        which = which.ravel()
        steps, at = np.unique(step, return_inverse=True)
        values = _numbers(t, carry)
        x = np.zeros((len(channel), len(steps), values.shape[1]), values.dtype)
        x[which, at] = values
        there = np.zeros((len(channel), len(steps)))
        there[which, at] = 1
        # every channel of a pair's source with every one of its receiver
        begin, end = (np.searchsorted(channel[:, 0], np.concatenate([src, rec]), side) for side in ("left", "right"))
        n_src, n_rec = (end - begin)[: len(src)], (end - begin)[len(src) :]
        pair = np.repeat(np.arange(len(src)), n_src * n_rec)
        turn = np.arange(len(pair)) - np.repeat(np.cumsum(n_src * n_rec) - n_src * n_rec, n_src * n_rec)
        p, q = begin[: len(src)][pair] + turn // np.maximum(n_rec[pair], 1), begin[len(src) :][pair] + turn % np.maximum(n_rec[pair], 1)
        common = (there[p] * there[q]).sum(axis=1)
        p, q, pair, common = (v[common > 0] for v in (p, q, pair, common))
        lags = kernel(x, p, q, t.column("first")[0].as_py()) / common[:, None] if len(p) else np.zeros((0, width))
        slots = channel[p, 1] * 3 + channel[q, 1]
        when = t.column("timestamp").take(pa.array(np.zeros(len(p), np.int64)))
        return pa.Table.from_arrays([when, pa.array(path[pair]), pa.array(slots, pa.int32()), pa.array(common.astype(np.int64)), lists(lags)], names=["timestamp", "path_id", "slot", "steps", "data"])

    parts = sent.groupBy("timestamp", "i", "j", "first").applyInArrow(run, f"timestamp {time_type}, path_id long, slot int, steps long, data array<double>")
    return parts if ranges == 1 else sum_arrays(parts, ["timestamp", "path_id", "slot", "steps"], width, "_ranges").drop("_ranges")


def _column(t: pa.Table, name: str) -> pa.Array:
    return t.column(name).combine_chunks()


def _numbers(t: pa.Table, carry: list[str]) -> np.ndarray:
    """The array columns of a table as rows of numbers; two columns are the parts of complex ones."""
    parts = [_column(t, c).flatten().to_numpy(zero_copy_only=False).reshape(len(t), -1) for c in carry]
    return parts[0] + 1j * parts[1] if len(parts) == 2 else parts[0]


def _blocks(p: np.ndarray, most: int) -> Iterator[slice]:
    for k in range(0, len(p), most):
        yield slice(k, k + most)


def correlate_direct(channels: DataFrame, paths: DataFrame, half: int, dt: float = 1.0, samples: int = 64) -> DataFrame:
    """Correlations in the time domain: timestamp, path_id, slot, data; dt * sum over t of source[t] * receiver[t + lag]. samples: numbers in a trace."""

    def kernel(x: np.ndarray, p: np.ndarray, q: np.ndarray, first: int) -> np.ndarray:
        n = x.shape[-1]
        out = np.zeros((len(p), 2 * half + 1))
        for s in _blocks(p, 4096):
            a, b = x[p[s], 0], x[q[s], 0]
            for lag in range(-min(half, n - 1), min(half, n - 1) + 1):
                out[s, lag + half] = dt * np.einsum("ij,ij->i", a[:, max(-lag, 0) : n - max(lag, 0)], b[:, max(lag, 0) : n - max(-lag, 0)])
        return out

    rows = channels.withColumn("step", F.lit(0))
    return _tiles(rows, paths, ["data"], samples, 3 * 8 * samples, half, kernel).drop("steps")


def correlate_spectra(spec: DataFrame, paths: DataFrame, half: int, length: int, delta: float, steps: int = 1, tile_bytes: int | None = None) -> DataFrame:
    """Mean over steps of the correlations from spectra: timestamp, path_id, slot, steps, data. steps: those of a record, by which blocks are sized."""
    numbers = length // 2 + 1

    def kernel(x: np.ndarray, p: np.ndarray, q: np.ndarray, first: int) -> np.ndarray:
        out = np.zeros((len(p), 2 * half + 1))
        for s in _blocks(p, max(1, (16 << 20) // (16 * max(x.shape[1] * x.shape[2], numbers, 1)))):
            cross = np.zeros((len(p[s]), numbers), complex)  # frequencies of other ranges are 0
            cross[:, first : first + x.shape[2]] = np.einsum("psf,psf->pf", np.conj(x[p[s]]), x[q[s]])
            out[s] = S.correlation(np.ones(1), cross, half, length, delta)
        return out

    return _tiles(spec, paths, ["re", "im"], numbers, 3 * 16 * numbers * steps, half, kernel, tile_bytes)


def lags_of(ncf: DataFrame, half: int, *keys: str) -> DataFrame:
    """One row a lag: keys, lag, v."""
    return ncf.select(*keys, F.posexplode("data").alias("k", "v")).select(*keys, (F.col("k") - half).alias("lag"), "v")
