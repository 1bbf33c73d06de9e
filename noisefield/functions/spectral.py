"""Spectral kernels in numpy for use inside Arrow batches: filters, whitening, spectra, correlations and stacks."""

from __future__ import annotations

import numpy as np


def smooth_length(n: int, even: bool = False) -> int:
    """The next length from n on whose only prime factors are 2, 3, 5 and 7."""
    n = max(int(n), 1)
    while True:
        rest = n
        for p in (2, 3, 5, 7):
            while rest % p == 0:
                rest //= p
        if rest == 1 and not (even and n % 2):
            return n
        n += 1


def segment_samples(seconds: float, delta: float) -> int:
    """Samples of a window: the nearest count, then the next smooth length."""
    return smooth_length(int(np.floor(seconds / delta + 0.5)))


def output_length(segment: int, max_lag: int) -> int:
    """Transform length of a spectrum for correlation up to max_lag: even and smooth, at most twice the segment."""
    return min(smooth_length(segment + max_lag, even=True), 2 * segment)


def butterworth_bandpass(low: float, high: float, delta: float, order: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Digital band-pass coefficients (b, a) by the bilinear transform with prewarped edges."""
    nyquist = 0.5 / delta
    if not 0 < low < high < nyquist:
        raise ValueError(f"band {low}/{high} must lie inside 0 and the Nyquist frequency {nyquist:g}")
    fs = 2.0
    w1, w2 = (2 * fs * np.tan(np.pi * f / nyquist / fs) for f in (low, high))
    centre, width = np.sqrt(w1 * w2), w2 - w1
    proto = np.exp(1j * np.pi * (2 * np.arange(order) + order + 1) / (2 * order))
    half = proto * width / 2
    root = np.sqrt(half**2 - centre**2 + 0j)
    poles = np.concatenate([half + root, half - root])
    gain = width**order
    z = (2 * fs + poles) / (2 * fs - poles)
    k = gain * (2 * fs) ** order / np.prod(2 * fs - poles)
    b = np.real(k) * np.poly(np.concatenate([np.ones(order), -np.ones(order)]))
    return np.real(b), np.real(np.poly(z))


def filter_bank(bands: list[tuple[float, float]], delta: float) -> list[tuple[float, float, np.ndarray, np.ndarray]]:
    """The band over all bands first, then each band: low, high, b, a."""
    if not bands:
        return []
    outer = (min(lo for lo, _ in bands), max(hi for _, hi in bands))
    return [(lo, hi, *butterworth_bandpass(lo, hi, delta)) for lo, hi in [outer, *bands]]


def power_response(b: np.ndarray, a: np.ndarray, n: int) -> np.ndarray:
    """|H|^2 at the frequencies of a real transform of length n: filtering forward and back has no phase."""
    z = np.exp(-2j * np.pi * np.arange(n // 2 + 1) / n)
    h = np.polyval(b[::-1], z) / np.polyval(a[::-1], z)
    return np.abs(h) ** 2


def impulse_padding(b: np.ndarray, a: np.ndarray, segment: int, tail: float = 1e-6) -> int:
    """Twice the samples after which less than `tail` of the impulse response's energy is left, at most a segment."""
    n = max(segment, len(b))
    x = np.zeros(n)
    y = np.zeros(n)
    x[0] = 1
    for i in range(n):
        y[i] = sum(b[k] * x[i - k] for k in range(min(len(b), i + 1))) - sum(a[k] * y[i - k] for k in range(1, min(len(a), i + 1)))
    energy = np.cumsum(y**2)
    long = int(np.searchsorted(energy, (1 - tail) * energy[-1])) + 1
    return min(2 * long, segment)


def filter_length(bank: list[tuple[float, float, np.ndarray, np.ndarray]], segment: int) -> int:
    """Transform length of the bank's filters: the segment and the largest padding, even and smooth, at most twice the segment."""
    padding = max((impulse_padding(b, a, segment) for _, _, b, a in bank), default=0)
    return min(smooth_length(segment + padding, even=True), 2 * segment)


def band_filter(x: np.ndarray, b: np.ndarray, a: np.ndarray, length: int | None = None) -> np.ndarray:
    """Zero-phase filter of the rows of x, padded with zeros to a transform of `length`; without one the filter is circular."""
    n = length or x.shape[-1]
    return np.fft.irfft(np.fft.rfft(x, n) * power_response(b, a, n), n)[..., : x.shape[-1]]


def rolling_mean(x: np.ndarray, width: int) -> np.ndarray:
    """Means over [i - width // 2, i - width // 2 + width - 1] of rows, zeros outside, constant divisor."""
    left = width // 2
    padded = np.concatenate([np.zeros((*x.shape[:-1], left + 1)), x, np.zeros((*x.shape[:-1], width))], axis=-1)
    run = np.cumsum(padded, axis=-1)
    n = x.shape[-1]
    return (run[..., width : width + n] - run[..., :n]) / width


def running_window(f_low: float, delta: float, factor: float = 0.667) -> int:
    return 2 * int(1 / (factor * f_low * delta)) + 1


def run_abs(x: np.ndarray, width: int, clip: float = 20.0) -> np.ndarray:
    """Rows (components of one station and step) divided by the sum over rows of their rolling mean magnitude."""
    weight = rolling_mean(np.abs(x), width).sum(axis=-2, keepdims=True)
    out = np.where(weight < 1e-30, 0.0, x / np.maximum(weight, 1e-30))
    return np.clip(np.nan_to_num(out, nan=0.0, posinf=0.0, neginf=0.0), -clip, clip)


def run_abs_bands(x: np.ndarray, bank: list[tuple[float, float, np.ndarray, np.ndarray]], delta: float, length: int | None = None) -> np.ndarray:
    """Sum over the bands after the first of the filtered rows, each normalised with its own window."""
    return sum((run_abs(band_filter(x, b, a, length), running_window(lo, delta, 1.0)) for lo, _, b, a in bank[1:]), np.zeros_like(x))


def spectral_taper(n_freq: int, df: float, low: float, high: float) -> np.ndarray:
    """1 inside [low, high], cosine ramps down to 0.667 low and 1.333 high, 0 beyond."""
    f = np.arange(n_freq) * df
    f1, f4 = 0.667 * low, 1.333 * high
    out = ((f >= low) & (f <= high)).astype(float)
    up, down = (f > f1) & (f < low), (f > high) & (f < f4)
    out[up] = 0.5 * (1 - np.cos(np.pi * (f[up] - f1) / (low - f1)))
    out[down] = 0.5 * (1 + np.cos(np.pi * (f[down] - high) / (f4 - high)))
    return out


def whiten(x: np.ndarray, low: float, high: float, delta: float, smooth_hz: float = 0.02) -> np.ndarray:
    """Rows (components of one station and step) with a spectrum divided by the components' summed smooth amplitude and tapered."""
    n = x.shape[-1]
    spec = np.fft.rfft(x)
    width = max(int(smooth_hz * n * delta), 1)
    weight = np.maximum(rolling_mean(np.abs(spec), width).sum(axis=-2, keepdims=True), 1e-30)
    spec = np.nan_to_num(spec / weight * spectral_taper(spec.shape[-1], 1 / (n * delta), low, high))
    return np.fft.irfft(spec, n)


def spectrum(x: np.ndarray, n: int, delta: float) -> np.ndarray:
    return np.fft.rfft(x, n) * delta


def correlation(source: np.ndarray, receiver: np.ndarray, half: int, n: int, delta: float) -> np.ndarray:
    """Rows of correlations for lags -half .. half from spectra of transform length n."""
    whole = np.fft.irfft(np.conj(source) * receiver, n) / delta
    return np.concatenate([whole[..., n - half :], whole[..., : half + 1]], axis=-1) if half else whole[..., :1]


def positive(spec: np.ndarray) -> np.ndarray:
    """Spectra with only positive frequencies, doubled; the constant part and the rest are 0."""
    n = spec.shape[-1]
    keep = np.zeros(n)
    keep[1 : (n + 1) // 2] = 2
    return spec * keep


def analytic(x: np.ndarray) -> np.ndarray:
    return np.fft.ifft(positive(np.fft.fft(x)))


def gaussian_windows(n: int, first: int, last: int, scale: float = 0.1, zero_shift_gain: float = 1.0) -> np.ndarray:
    """Windows of the S-transform for the frequencies first .. last - 1 over all circular shifts."""
    f = np.arange(first, last)[:, None]
    shift = np.arange(n)[None, :]
    half = (n + 1) // 2
    m = np.where(shift < half, shift, n - shift)
    with np.errstate(divide="ignore", invalid="ignore"):
        w = np.exp(-2 * np.pi**2 * m**2 * scale / (f * f))
    w = np.where((shift >= half) & (m >= half), 0.0, w)
    w[:, 0] = zero_shift_gain
    w[f[:, 0] == 0] = 1.0
    return w


def s_transform(spec: np.ndarray, first: int, last: int, scale: float, gain: float) -> np.ndarray:
    """Local spectra of rows (given by their analytic spectra): row, frequency, time."""
    n = spec.shape[-1]
    at = (np.arange(first, last)[:, None] + np.arange(n)[None, :]) % n
    return np.fft.ifft(spec[:, at] * gaussian_windows(n, first, last, scale, gain))


def band_mix(freq: np.ndarray, low: float, high: float, taper: float) -> np.ndarray:
    """Share of the weighted stack at each frequency: 1 inside the band, cosine ramps of `taper` at its edges, 0 outside."""
    taper = min(taper, 0.5 * (high - low))
    inside = (freq >= low) & (freq <= high)
    if taper <= 0:
        return inside.astype(float)
    edge = np.minimum(np.minimum(freq - low, high - freq), taper) / taper
    return np.where(inside, 0.5 - 0.5 * np.cos(np.pi * np.clip(edge, 0, 1)), 0.0)


def band_share(n: int, delta: float, band: tuple[float, float] | None, taper: float | None) -> np.ndarray:
    """Share of the weighted stack at the frequencies of a transform of length n; 1 everywhere without a band."""
    if band is None:
        return np.ones(n // 2 + 1)
    low, high = band[0], min(band[1], 0.5 / delta)
    return band_mix(np.arange(n // 2 + 1) / (n * delta), low, high, 0.05 * (high - low) if taper is None else taper)
