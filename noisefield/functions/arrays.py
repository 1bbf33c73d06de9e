"""Conditioning of traces held as arrays of doubles, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ZERO = 0.0


def total(x: Column) -> Column:
    return F.aggregate(x, F.lit(ZERO), lambda a, v: a + v)


def sanitize(x: Column) -> Column:
    """NaN, infinite and null samples become 0."""
    return F.transform(x, lambda v: F.when(v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")), F.lit(ZERO)).otherwise(v))


def demean(x: Column) -> Column:
    mean = total(x) / F.size(x)
    return F.transform(x, lambda v: v - mean)


def detrend(x: Column) -> Column:
    """Without the least-squares line over i = 0 .. n - 1; a single sample becomes 0."""
    n = F.size(x).cast("double")
    isum = F.aggregate(F.zip_with(x, F.sequence(F.lit(0), F.size(x) - 1), lambda v, i: v * i), F.lit(ZERO), lambda a, v: a + v)
    si, sii = n * (n - 1) / 2, (n - 1) * n * (2 * n - 1) / 6
    det = n * sii - si * si
    slope = F.when(det == 0, F.lit(ZERO)).otherwise((n * isum - si * total(x)) / F.when(det != 0, det))
    start = (total(x) - slope * si) / n
    return F.transform(x, lambda v, i: v - (slope * i + start))


def taper(x: Column, length: int) -> Column:
    """Cosine ramps of `length` samples at both ends; the head's ramp wins where they overlap."""
    n = F.size(x)

    def one(v: Column, i: Column) -> Column:
        head = 0.5 * (1 - F.cos(F.pi() * i / length))
        tail = 0.5 * (1 - F.cos(F.pi() * (n - i) / length))
        return F.when(i < length, v * head).when(i > n - length, v * tail).otherwise(v)

    return F.transform(x, one) if length > 0 else x


def one_bit(x: Column) -> Column:
    return F.transform(x, F.signum)


def rolling_mean(x: Column, width: int) -> Column:
    """Means over [i - width // 2, i - width // 2 + width - 1] with zeros outside and a constant divisor.

    Differences of one running sum would lose digits on long traces; windows are summed."""
    left = width // 2
    padded = F.concat(F.array_repeat(F.lit(ZERO), left), x, F.array_repeat(F.lit(ZERO), width))
    return F.transform(x, lambda v, i: total(F.slice(padded, i + 1, F.lit(width))) / width)


def divide_by(x: Column, weight: Column, clip: float = 20.0) -> Column:
    """x / weight; weights below 1e-30 give 0, results stay within +-clip."""
    return F.zip_with(x, weight, lambda v, w: F.when(w < 1e-30, F.lit(ZERO)).otherwise(F.greatest(F.lit(-clip), F.least(F.lit(clip), v / F.when(w >= 1e-30, w)))))


def segment_count(n: Column, length: int, shift: int) -> Column:
    return F.greatest(F.floor((n - length) / shift) + 1, F.lit(0)).cast("int")


def segments(x: Column, length: int, shift: int) -> Column:
    """Windows of a trace, a shift apart; a rest that fills no window is dropped."""
    count = segment_count(F.size(x), length, shift)
    starts = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda s: F.slice(x, s * shift + 1, F.lit(length)))


def fit_length(x: Column, n: int) -> Column:
    """Cut or padded with zeros to n samples."""
    return F.slice(F.concat(x, F.array_repeat(F.lit(ZERO), n)), 1, n)


def window(x: Column, begin: Column, delta: float, t1: float, t2: float) -> Column:
    """Samples from t1 to t2 of a trace that begins at `begin`; zeros where the window leaves the trace."""
    n = round((t2 - t1) / delta)
    first = F.rint((t1 - begin) / delta).cast("int")
    lead = F.least(F.greatest(-first, F.lit(0)), F.lit(n))
    held = F.slice(x, F.greatest(first, F.lit(0)) + 1, F.greatest(n - lead, F.lit(0)))
    return F.slice(F.concat(F.array_repeat(F.lit(ZERO), lead), held, F.array_repeat(F.lit(ZERO), n)), 1, n)


def phase_only(re: Column, im: Column) -> tuple[Column, Column]:
    size = F.zip_with(re, im, lambda a, b: F.sqrt(a * a + b * b))
    unit = lambda x: F.zip_with(x, size, lambda v, s: F.when(s <= 1e-30, F.lit(ZERO)).otherwise(v / F.when(s > 1e-30, s)))
    return unit(re), unit(im)


def quantity(re: Column, im: Column, kind: str) -> Column:
    """amplitude, power, phase, real or imag of complex values; amplitude_db and power_db in decibels."""
    power = re * re + im * im
    kinds = {"amplitude": F.sqrt(power), "power": power, "phase": F.atan2(im, re), "real": re, "imag": im, "amplitude_db": 20 * F.log10(F.sqrt(power)), "power_db": 10 * F.log10(power)}
    if kind not in kinds:
        raise ValueError(f"unknown quantity {kind!r}; one of {', '.join(kinds)}")
    return kinds[kind]


def normalized(x: Column) -> Column:
    """Divided by the largest magnitude; all zeros if that is 0."""
    most = F.array_max(F.transform(x, F.abs))
    return F.transform(x, lambda v: F.when(most > 0, v / F.when(most > 0, most)).otherwise(F.lit(ZERO)))


def cross_correlation(source: Column, receiver: Column, half: int, dt: float = 1.0) -> Column:
    """dt * sum over t of source[t] * receiver[t + lag] for lag = -half .. half; positive lag: the receiver is later."""
    n = F.size(source)

    def one(lag: Column) -> Column:
        a = F.slice(source, F.greatest(-lag, F.lit(0)) + 1, F.greatest(n - F.abs(lag), F.lit(0)))
        b = F.slice(receiver, F.greatest(lag, F.lit(0)) + 1, F.greatest(n - F.abs(lag), F.lit(0)))
        return dt * total(F.zip_with(a, b, lambda p, q: p * q))

    return F.transform(F.sequence(F.lit(-half), F.lit(half)), one)
