"""Box least squares: short boxes grow point by point, long ones are searched, both alike."""

import numpy as np

from photospark.operators import period

PERIODS, DURATIONS = np.linspace(0.5, 15, 800), np.linspace(0.01, 0.2, 10)


def series(seed, n, clumped=False):
    r = np.random.default_rng(seed)
    t = np.sort(r.choice([0.0, 1.0, 2.5, 7.0], n) + r.uniform(0, 0.05, n) if clumped else r.uniform(0, 30, n))
    y = 1 + r.normal(0, 0.05, n) - 0.2 * (t % 2.7 < 0.15)
    return t, y, np.where(r.random(n) < 0.1, np.nan, r.uniform(0.01, 0.1, n))


def test_short_boxes_need_no_search(monkeypatch):
    cases = [series(i, n, i == 3) for i, n in enumerate((20, 33, 50, 66, 40))]
    want = [period._boxes(*c, PERIODS, DURATIONS, short=0)[0] for c in cases]

    def no(*_):
        raise AssertionError("searched")

    monkeypatch.setattr(period, "_searched_boxes", no)
    for case, w in zip(cases, want):
        got = period._boxes(*case, PERIODS, DURATIONS, short=1000)[0]
        assert all(abs(got[k] - w[k]) < 1e-9 for k in w), (got, w)


def test_against_all_boxes_one_by_one():
    t, y, error = series(9, 25)
    x, mid = t - t[0], np.median(y)
    e = error / mid
    w = np.where(np.isfinite(e), 1 / e**2, 0)
    w = w / w.sum()
    wy = w * (y / mid - (w * y / mid).sum())
    best = 0.0
    for p in PERIODS:
        for a in x % p:
            for d in DURATIONS:
                held = (x % p - a) % p <= d + 1e-12
                r, s = w[held].sum(), wy[held].sum()
                if 0 < r < 1 - 1e-12 and s < 0:
                    best = max(best, s * s / (r * (1 - r)))
    assert abs(period._boxes(t, y, error, PERIODS, DURATIONS)[0]["power"] - best) < 1e-12


def test_ties_go_to_the_first_period():
    t = np.arange(40.0) * 0.7
    y = np.ones(40)
    y[7] = 0.5
    got = period._boxes(t, y, np.full(40, 0.1), PERIODS, DURATIONS)[0]
    again = period._boxes(t, y, np.full(40, 0.1), PERIODS[: int(np.searchsorted(PERIODS, got["period"])) + 1], DURATIONS)[0]
    assert got == again and got["duration"] == DURATIONS[0]
