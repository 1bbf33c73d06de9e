"""Choosing spectra and correlations to look at, and the numbers of charts."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import arrays as A

COMPONENT_MODES = ("exact", "tail", "auto")


def station_matches(df_columns: dict[str, Column], asked: str) -> Column:
    """A station by its code, by network.code, or by the whole dotted key."""
    c = df_columns
    key = F.concat_ws(".", c["network"], c["station"])
    return (c["station"] == asked) | (key == asked) | (F.concat_ws(".", key, c["location"]) == asked)


def component_matches(component: Column, asked: list[str], mode: str = "auto") -> Column:
    """Components by their whole label, by their last letter, or by either; no list is every component."""
    if mode not in COMPONENT_MODES:
        raise ValueError(f"mode is one of {', '.join(COMPONENT_MODES)}")
    if not asked:
        return F.lit(True)
    whole = F.upper(component).isin([a.upper() for a in asked])
    tail = F.upper(F.right(component, F.lit(1))).isin([a.upper() for a in asked if len(a) == 1])
    return {"exact": whole, "tail": tail, "auto": whole | tail}[mode]


def select_spectra(spectra: DataFrame, station: str, components: list[str] | None = None, mode: str = "auto", network: str | None = None, location: str | None = None) -> DataFrame:
    c = {k: F.col(k) for k in ("network", "station", "location")}
    ok = station_matches(c, station) & component_matches(F.col("component"), components or [], mode)
    for name, value in (("network", network), ("location", location)):
        if value is not None:
            ok = ok & (F.col(name) == value)
    return spectra.where(ok)


def select_receivers(traces: DataFrame, receivers: list[str] | None = None, distance: tuple[float | None, float | None] = (None, None)) -> DataFrame:
    """Traces of the listed receivers (by code or network.code; a name without a trace is an error) at distances in a closed range."""
    names = [r.strip() for r in receivers or [] if r.strip()]
    if names:
        c = {k: F.col(f"rec_{k}") for k in ("network", "station", "location")}
        ok = [station_matches(c, r) for r in names]
        held = traces.agg(*(F.max(k).alias(f"m{i}") for i, k in enumerate(ok))).first()
        missing = [r for r, k in zip(names, held, strict=True) if not k]
        if missing:
            raise ValueError(f"no traces of {', '.join(missing)}")
        any_ = F.lit(False)
        for k in ok:
            any_ = any_ | k
        traces = traces.where(any_)
    low, high = distance
    if low is not None:
        traces = traces.where(F.col("distance") >= low)
    return traces if high is None else traces.where(F.col("distance") <= high)


def gaussian_smooth(values: np.ndarray, sigma: tuple[float, float]) -> np.ndarray:
    """Rows and columns smoothed with normalised Gaussians of 4 sigma; beyond the edges the outermost value stands."""
    for axis, s in enumerate(sigma):
        if s > 0:
            r = int(4 * s + 0.5)
            w = np.exp(-0.5 * (np.arange(-r, r + 1) / s) ** 2)
            padded = np.pad(values, [(r, r) if k == axis else (0, 0) for k in range(2)], mode="edge")
            values = np.apply_along_axis(lambda v, w=w: np.convolve(v, w / w.sum(), "valid"), axis, padded)
    return values


def smooth_spectra(spectra: DataFrame, kind: str, step: float, frequency: float, keys: list[str]) -> DataFrame:
    """keys, step and the smoothed quantity over steps and frequencies; phases are smoothed as unit vectors."""
    types = {f.name: f.dataType.simpleString() for f in spectra.schema.fields}

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("step")
        z = np.stack(pdf["re"].to_numpy()) + 1j * np.stack(pdf["im"].to_numpy())
        if kind == "phase":
            size = np.abs(z)
            unit = np.where(size > 0, z / np.where(size > 0, size, 1), 0)
            out = np.angle(gaussian_smooth(unit.real, (step, frequency)) + 1j * gaussian_smooth(unit.imag, (step, frequency)))
        else:
            out = gaussian_smooth({"amplitude": np.abs(z), "power": np.abs(z) ** 2, "real": z.real, "imag": z.imag}[kind], (step, frequency))
        got = pdf[[*keys, "step"]].copy()
        got["value"] = list(out)
        return got

    return spectra.select(*keys, "step", "re", "im").groupBy(*keys).applyInPandas(run, ", ".join(f"{k} {types[k]}" for k in keys) + f", step {types['step']}, value array<double>")


def lag_window(points: DataFrame, most: float) -> DataFrame:
    """Points whose lag lies within +-most."""
    return points.where(F.abs("lag") <= most)


def frequency_range(bins: DataFrame, low: float, high: float, step: float = 1.0) -> DataFrame:
    """Bins (k, a frequency step apart) whose frequency lies in a closed range."""
    return bins.where((F.col("k") * step).between(low, high))


def lines(traces: DataFrame, half: int, dt: float, window: float, scale: Column, *keys: str) -> DataFrame:
    """Points of a record section: keys, lag in seconds, and distance plus the normalised trace times scale."""
    t = traces.select(*keys, "distance", scale.alias("scale"), F.posexplode(A.normalized(F.col("data"))).alias("k", "v"))
    t = t.withColumn("lag", (F.col("k") - half) * dt)
    return lag_window(t, window).select(*keys, "lag", (F.col("distance") + F.col("v") * F.col("scale")).alias("y"))


def grid_layout(traces: DataFrame) -> tuple[int, int]:
    """1 x 1 for one component pair, 3 x 3 for all nine; anything else is an error."""
    n = traces.select("slot").distinct().count()
    if n not in (1, 9):
        raise ValueError(f"a grid shows one or nine component pairs, not {n}")
    return (1, 1) if n == 1 else (3, 3)
