import numpy as np
import pytest

from noisefield.functions import spectral as S

rng = np.random.default_rng(5)


def test_smooth_lengths():
    assert [S.smooth_length(n) for n in (1, 11, 61, 64, 121)] == [1, 12, 63, 64, 125]
    assert S.smooth_length(62, even=True) == 64
    assert S.output_length(100, 5000) == 200


def test_butterworth_known_coefficients():
    # order 2, 0.1 to 0.2 of the sampling rate: the usual textbook values
    b, a = S.butterworth_bandpass(0.1, 0.2, 1.0)
    assert b == pytest.approx([0.06745527, 0, -0.13491055, 0, 0.06745527], abs=1e-7)
    assert a == pytest.approx([1, -1.94246878, 2.1192024, -1.21665164, 0.4128016], abs=1e-7)
    with pytest.raises(ValueError):
        S.butterworth_bandpass(0.3, 0.6, 1.0)


def test_response_is_one_inside_and_small_outside():
    b, a = S.butterworth_bandpass(0.1, 0.2, 1.0)
    h = S.power_response(b, a, 1000)
    assert h[141] == pytest.approx(1, abs=1e-3) and h[0] < 1e-20 and h[450] < 1e-3
    assert 0 < S.impulse_padding(b, a, 500) <= 500


@pytest.mark.parametrize("normalize", ["OFF", "RUN-ABS-MF"])
def test_filters_of_a_run_do_not_wrap(normalize):
    from dataclasses import replace

    from noisefield.operators.correlate import condition
    from noisefield.plans.config import RunConfig

    run = RunConfig(window_seconds=400, delta=1.0, bands=((0.03, 0.06), (0.06, 0.12)), normalize=normalize, whiten="OFF").conditioning()
    bank = S.filter_bank(list(run.bands), 1.0)
    assert run.filter_length == S.filter_length(bank, run.window) == S.smooth_length(run.window + max(S.impulse_padding(b, a, run.window) for _, _, b, a in bank), even=True) <= 2 * run.window
    x = rng.normal(size=(3, run.window)) * np.linspace(0, 1, run.window) ** 4
    long, bare = replace(run), replace(run)
    long.filter_length, bare.filter_length = 20 * run.window, None
    want = condition(x, long)
    assert np.abs(condition(x, run) - want).max() < 1e-3 * np.abs(want).max() < np.abs(condition(x, bare) - want).max()


def test_rolling_mean_has_a_constant_divisor():
    x = np.arange(6.0)
    assert S.rolling_mean(x, 4) == pytest.approx([sum(x[max(i - 2, 0) : i + 2]) / 4 for i in range(6)])


def test_run_abs_of_a_shared_weight():
    x = rng.normal(size=(3, 200))
    out = S.run_abs(x, 11)
    weight = sum(S.rolling_mean(np.abs(r), 11) for r in x)
    assert out == pytest.approx(np.clip(x / weight, -20, 20))
    assert (S.run_abs(np.zeros((3, 50)), 5) == 0).all()


def test_correlation_equals_the_time_domain():
    x, y = rng.normal(size=(2, 64))
    n = S.output_length(64, 10)
    got = S.correlation(S.spectrum(x, n, 0.5), S.spectrum(y, n, 0.5), 10, n, 0.5)
    want = [0.5 * sum(x[t] * y[t + lag] for t in range(64) if 0 <= t + lag < 64) for lag in range(-10, 11)]
    assert got == pytest.approx(want, abs=1e-9)
    assert S.correlation(S.spectrum(y, n, 1), S.spectrum(x, n, 1), 10, n, 1) == pytest.approx(S.correlation(S.spectrum(x, n, 1), S.spectrum(y, n, 1), 10, n, 1)[::-1])


@pytest.fixture()
def stacked(spark):
    """A stack of records of one pair, one record a timestamp."""
    from noisefield.operators import stack

    def run(records, method, size=2, **kw):
        df = spark.createDataFrame([(k, 1, 0, x.tolist()) for k, x in enumerate(records)], "timestamp int, path_id long, slot int, data array<double>").repartition(3)
        row = getattr(stack, method)(df, size, len(records[0]), **kw).first()
        return np.array(row.data), row.n, row.chunks

    return run


def _all_at_once(sums, counts, alpha, scale=0.1, gain=1.0):
    """The time-frequency stack with all chunks and frequencies in memory."""
    n, half = sums.shape[-1], sums.shape[-1] // 2 + 1
    own = S.positive(np.fft.fft(sums.sum(axis=0) / counts.sum()))
    local = S.s_transform(S.positive(np.fft.fft(sums)), 0, half, scale, gain)
    size = np.abs(local)
    coherence = np.abs(np.einsum("c,cft->ft", counts / counts.sum(), local / np.where(size <= 1e-7, 1.0, size)))
    mine = (S.s_transform(own[None], 0, half, scale, gain)[0] * coherence).sum(axis=-1)
    whole = np.zeros(n, complex)
    whole[:half] = own[:half] * (1 - alpha) + mine * alpha
    return np.fft.ifft(whole).real


def test_phase_weighted_stack(stacked):
    x = rng.normal(size=65)
    got, n, chunks = stacked([x] * 5, "phase_weighted_stack")
    assert got == pytest.approx(x) and (n, chunks) == (5, 3)
    records = rng.normal(size=(7, 65))
    means = np.stack([records[k : k + 3].mean(axis=0) for k in (0, 3, 6)])
    weights = np.array([3, 3, 1]) / 7
    z = S.analytic(means)
    got, *_ = stacked(records, "phase_weighted_stack", 3)
    assert got == pytest.approx(records.mean(axis=0) * np.abs(weights @ (z / np.maximum(np.abs(z), 1e-7))))


@pytest.mark.parametrize("block", [64, 7])
def test_time_frequency_stack(stacked, monkeypatch, block):
    from noisefield.operators import stack

    monkeypatch.setattr(stack, "BLOCK", block)
    x = rng.normal(size=65)
    assert stacked([x] * 5, "time_frequency_stack")[0] == pytest.approx(x - x.mean())
    records = rng.normal(size=(9, 65))
    sums, counts = np.stack([records[k : k + 2].sum(axis=0) for k in range(0, 9, 2)]), np.array([2, 2, 2, 2, 1.0])
    assert stacked(records, "time_frequency_stack")[0] == pytest.approx(_all_at_once(sums, counts, np.ones(33)))
    band = {"band": (0.2, 0.3), "taper": 0.02}
    got = stacked(records, "time_frequency_stack", **band)[0]
    assert got == pytest.approx(_all_at_once(sums, counts, S.band_share(65, 1.0, **band)))
    out, linear, f = np.fft.rfft(got), np.fft.rfft(records.mean(axis=0)), np.arange(33) / 65
    assert out[(f > 0) & (f < 0.2)] == pytest.approx(linear[(f > 0) & (f < 0.2)])
    assert not np.allclose(out[(f > 0.24) & (f < 0.26)], linear[(f > 0.24) & (f < 0.26)])


def test_records_of_other_lengths_are_an_error(stacked):
    with pytest.raises(Exception, match="arrays of 65 numbers are summed, not of 64"):
        stacked([np.zeros(65), np.zeros(64)], "phase_weighted_stack")


def test_whitening_keeps_the_band():
    x = rng.normal(size=(3, 512))
    z = np.abs(np.fft.rfft(S.whiten(x, 0.1, 0.2, 1.0)))
    f = np.arange(257) / 512
    assert z[:, f < 0.06].max() < 1e-9 and z[:, f > 0.27].max() < 1e-9 and z[:, (f > 0.1) & (f < 0.2)].mean() > 0.1
