import numpy as np
import pytest

from posegrain.operators import sync
from posegrain.plans import reference as R


def series(spark, t, speed, name="s"):
    return spark.createDataFrame([(name, float(a), float(b)) for a, b in zip(t, speed)], "session_id string, t double, speed double")


def beat(t):
    """Quick motion: the peak of the correlation is narrower than a tenth of a second."""
    return 1 + sum(np.sin(w * t + k) for k, w in enumerate((31.0, 37.7, 44.9, 53.3)))


def slow(t):
    return 1 + np.sin(0.9 * t) + 0.5 * np.sin(2.1 * t + 1)


@pytest.mark.parametrize("speed, shift", [(beat, 0.354), (slow, 1.433)])
def test_registered_steps(spark, monkeypatch, speed, shift):
    """To a millisecond, also where the clock is off by more than the radius and the score rises towards the edge."""
    t, s = np.arange(0, 30, 0.02), np.arange(-3, 33, 0.01)
    monkeypatch.setattr(R, "speed_pairs", lambda *_: (series(spark, t, speed(t)), series(spark, s, speed(s + shift))))
    r = R.sync_time_offset(spark, "").first()
    assert abs(r.offset_s + shift) <= 0.0011 and r.score > 0.99


def test_scores_across_blocks_and_gaps(spark):
    """Equal to one interpolation over the whole series, with gaps, around ten minutes, far from zero."""
    rng = np.random.default_rng(6)
    t, s = np.sort(rng.uniform(500, 1900, 1500)), np.sort(rng.uniform(500, 1900, 4000))
    u, v = rng.normal(5, 1, len(t)), rng.normal(3, 1, len(s))
    around = spark.createDataFrame([("s", 0.3)], "session_id string, base double")
    got = {r.step: r for r in sync.offset_scores(series(spark, t, u), series(spark, s, v), ["session_id"], around, 0.5, 0.1, 0.5).collect()}
    assert set(got) == set(range(-5, 6))
    for k, r in got.items():
        q = t + 0.3 + k * 0.1
        hi = np.clip(np.searchsorted(s, q), 1, len(s) - 1)
        ok = (s[hi - 1] <= q) & (q <= s[hi]) & (s[hi] - s[hi - 1] <= 0.5)
        assert r.n == ok.sum() and abs(r.score - np.corrcoef(u[ok], np.interp(q, s, v)[ok])[0, 1]) < 1e-9
