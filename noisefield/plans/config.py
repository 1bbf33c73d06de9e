"""The configuration of a run, from an INI file or from Python."""

from __future__ import annotations

import configparser
import difflib
import os
import re
import warnings
from dataclasses import dataclass, field, fields

from ..operators.correlate import Conditioning
from ..operators.pairs import AUTOCORR_MODES, GROUP_MODES

_TRUE, _FALSE = ("1", "true", "yes", "on"), ("0", "false", "no", "off")


def read_bool(text: str) -> bool:
    if text.strip().lower() in _TRUE + _FALSE:
        return text.strip().lower() in _TRUE
    raise ValueError(f"{text!r} is neither true nor false")


def read_range(text: str) -> tuple[float, float]:
    """lo/hi."""
    try:
        low, high = (float(x) for x in text.split("/"))
    except ValueError:
        raise ValueError(f"{text!r} is not a range lo/hi") from None
    return low, high


@dataclass
class Source:
    """One tree of waveform files."""

    path: str
    pattern: str
    stations: str | None = None
    components: tuple[str, ...] = ("Z",)
    group: int = 1

    def __post_init__(self) -> None:
        if not 1 <= len(self.components) <= 3 or len(set(self.components)) != len(self.components):
            raise ValueError("a source has one to three different components")
        if not 1 <= self.group <= 9:
            raise ValueError("a group is a number from 1 to 9")


@dataclass
class RunConfig:
    """Every setting of a run; `init` writes a file with all defaults."""

    sources: list[Source] = field(default_factory=list)
    time_start: str | None = None
    time_end: str | None = None
    time_list: str | None = None
    geometry: str | None = None
    pair_table: str | None = None
    record_seconds: float = 86400.0
    window_seconds: float = 3600.0
    shift_seconds: float | None = None
    delta: float = 1.0
    bands: tuple[tuple[float, float], ...] = ()
    normalize: str = "AUTO"
    whiten: str = "AFTER"
    skip_steps: tuple[int, ...] = ()
    phase_only: bool = False
    max_lag_seconds: float = 100.0
    distance_km: tuple[float, float] = (-1.0, 50000.0)
    azimuth_deg: tuple[float, float] = (-1.0, 360.0)
    group_pairs: str = "all"
    autocorr: str = "off"
    stack_flag: str = "100"
    pre_stack_size: int = 10
    other_indexes: tuple[str, ...] = ()
    tf_band: tuple[float, float] | None = None
    tf_taper_hz: float | None = None
    buckets: int = 64
    pack: bool = False
    text_tables: bool = False
    unpack: bool = True
    unpack_target: str = "ALL"
    output: str = "output"

    def __post_init__(self) -> None:
        for name in ("record_seconds", "window_seconds", "delta", "max_lag_seconds"):
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be larger than 0")
        for low, high in self.bands:
            if not 0 < low < high < 0.5 / self.delta:
                raise ValueError(f"band {low:g}/{high:g} must lie between 0 and the Nyquist frequency {0.5 / self.delta:g}")
        self.normalize, self.whiten, self.unpack_target = self.normalize.upper(), self.whiten.upper(), self.unpack_target.upper()
        for name, known in (("normalize", ("AUTO", "OFF", "RUN-ABS", "ONE-BIT", "RUN-ABS-MF")), ("whiten", ("OFF", "BEFORE", "AFTER", "BOTH")), ("group_pairs", GROUP_MODES), ("autocorr", AUTOCORR_MODES), ("unpack_target", ("FINAL", "STACK", "ROTATE", "ALL"))):
            if getattr(self, name) not in known:
                raise ValueError(f"{name} is one of {', '.join(known)}")
        if self.distance_km[0] > self.distance_km[1]:
            raise ValueError("a distance range begins with the smaller value")
        if not re.fullmatch("[01]{3}", self.stack_flag):
            raise ValueError("stack_flag has three digits 0 or 1: linear, phase-weighted, time-frequency")
        if self.pre_stack_size < 1 or self.buckets < 1 or (self.tf_taper_hz or 0) < 0:
            raise ValueError("pre_stack_size and buckets are at least 1 and tf_taper_hz at least 0")

    def steps(self) -> int:
        """Windows of a record."""
        c, n = self.conditioning(), int(round(self.record_seconds / self.delta))
        return max((n - c.window) // c.shift + 1, 0)

    def check_skipped_steps(self) -> None:
        """All steps skipped is an error; a step that a record does not have is a warning."""
        n = self.steps()
        if n and set(self.skip_steps) >= set(range(n)):
            raise ValueError(f"skip_steps leaves none of the {n} steps of a record")
        beyond = sorted(k for k in self.skip_steps if not 0 <= k < n)
        if beyond:
            warnings.warn(f"skip_steps names {', '.join(map(str, beyond))}; a record has the steps 0 to {n - 1}", stacklevel=2)

    def conditioning(self) -> Conditioning:
        from ..functions.spectral import segment_samples

        window = segment_samples(self.window_seconds, self.delta)
        shift = segment_samples(self.shift_seconds, self.delta) if self.shift_seconds else window
        return Conditioning(self.delta, window, shift, round(self.max_lag_seconds / self.delta), self.bands, self.normalize, self.whiten, self.phase_only, self.skip_steps)


#: Section of each setting in a file.
SECTIONS = {
    "time": ("time_start", "time_end", "time_list"),
    "geometry": ("geometry",),
    "spectra": ("record_seconds", "window_seconds", "shift_seconds", "delta", "bands", "normalize", "whiten", "skip_steps", "phase_only"),
    "pairs": ("pair_table", "max_lag_seconds", "distance_km", "azimuth_deg", "group_pairs", "autocorr"),
    "stack": ("stack_flag", "pre_stack_size", "other_indexes", "buckets", "tf_band", "tf_taper_hz"),
    "output": ("pack", "text_tables", "unpack", "unpack_target", "output"),
}


def _value(name: str, text: str) -> object:
    text = os.path.expandvars(os.path.expanduser(text.strip()))
    if name == "bands":
        return tuple(read_range(x) for x in text.split())
    if name == "other_indexes":
        return tuple(text.split())
    if name in ("distance_km", "azimuth_deg"):
        return read_range(text)
    if name == "tf_band":
        return None if text.upper() == "FULL" else read_range(text)
    if name == "skip_steps":
        return () if text == "-1" else tuple(int(x) for x in text.split(","))
    if name in ("shift_seconds", "tf_taper_hz") and text.upper() == "AUTO":
        return None
    if name in ("phase_only", "pack", "text_tables", "unpack"):
        return read_bool(text)
    if name in ("pre_stack_size", "buckets"):
        return int(text)
    if name.endswith("_seconds") or name in ("delta", "tf_taper_hz"):
        return float(text)
    return text


def load(path: str) -> RunConfig:
    """A configuration file: sections source.<name>, and those of SECTIONS."""
    ini = configparser.ConfigParser(interpolation=None)
    if not ini.read(path):
        raise FileNotFoundError(path)
    given: dict[str, object] = {}
    sources = []
    for section in ini.sections():
        if section.startswith("source"):
            s = ini[section]
            parts = {k: os.path.expandvars(os.path.expanduser(v)) for k, v in s.items()}
            unknown = set(parts) - {f.name for f in fields(Source)}
            if unknown:
                raise ValueError(f"section {section} has no setting {', '.join(sorted(unknown))}")
            sources.append(Source(parts["path"], parts["pattern"], parts.get("stations"), tuple(x.strip() for x in parts.get("components", "Z").split(",")), int(parts.get("group", 1))))
            continue
        if section not in SECTIONS:
            raise ValueError(f"no section {section!r}{_hint(section, list(SECTIONS))}")
        for name, text in ini[section].items():
            if name not in SECTIONS[section]:
                raise ValueError(f"section {section} has no setting {name!r}{_hint(name, list(SECTIONS[section]))}")
            given[name] = _value(name, text)
    return RunConfig(sources=sources, **given)


def _hint(word: str, known: list[str]) -> str:
    near = difflib.get_close_matches(word, known, 1)
    return f"; did you mean {near[0]!r}?" if near else f"; known: {', '.join(known)}"


def dump(c: RunConfig, path: str) -> None:
    ini = configparser.ConfigParser(interpolation=None)
    for k, s in enumerate(c.sources, 1):
        ini[f"source.{k}"] = {"path": s.path, "pattern": s.pattern, "components": ",".join(s.components), "group": str(s.group)} | ({"stations": s.stations} if s.stations else {})
    rng = lambda r: f"{r[0]:g}/{r[1]:g}"
    for section, names in SECTIONS.items():
        held = {}
        for name in names:
            v = getattr(c, name)
            if name == "bands":
                v = " ".join(map(rng, v))
            elif name == "other_indexes":
                v = " ".join(v)
            elif name == "skip_steps":
                v = ",".join(map(str, v)) or "-1"
            elif isinstance(v, tuple):
                v = rng(v)
            elif v is None:
                v = {"shift_seconds": "AUTO", "tf_taper_hz": "AUTO", "tf_band": "FULL"}.get(name)
            if v not in (None, ""):
                held[name] = str(v)
        if held:
            ini[section] = held
    with open(path, "w") as f:
        ini.write(f)
