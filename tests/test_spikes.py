import numpy as np
import pytest

from posegrain.operators import spikes as S

F = S.Field(-100, 100, 1e-4)
ANGLE = S.Field(-180, 180, 0.02, True)


def series(n=400, seed=0):
    rng = np.random.default_rng(seed)
    t = np.cumsum(rng.uniform(0.1, 0.4, n))
    return t, 2 * np.sin(t / 9) + rng.normal(0, 0.004, n)


def test_spikes_of_one_to_three_rows():
    t, x = series()
    want = np.zeros(len(x), int)
    for i, n, d in [(50, 1, 0.5), (120, 2, -0.8), (200, 3, 1.5), (260, 1, 60.0), (330, 1, 0.2)]:
        x[i : i + n] += d
        want[i : i + n] = 3
    assert (S.judge(t, x, F, S.Rule()) == want).all()


def test_lasting_change_and_gap_are_none():
    t, x = series(seed=1)
    x[200:] += 1.0
    t[300:] += 60
    x[300:] -= 0.7
    assert not S.judge(t, x, F, S.Rule()).any()


def test_turn_across_180_is_none_but_a_jump_is():
    t = np.arange(300) * 0.2
    a = (170 + 0.3 * np.arange(300) + np.random.default_rng(2).normal(0, 0.3, 300) + 180) % 360 - 180
    b = a.copy()
    b[100] = (b[100] + 40 + 180) % 360 - 180
    assert not S.judge(t, a, ANGLE, S.Rule()).any()
    assert np.flatnonzero(S.judge(t, b, ANGLE, S.Rule())).tolist() == [100]


def test_stuck_and_impossible():
    t, x = series(seed=3)
    x[100:106] = x[100]
    x[200:205] = x[200]
    x[300] = 9999.0
    k = S.judge(t, x, F, S.Rule())
    assert (k[100:106] == 2).all() and not (k[200:205] == 2).any() and k[300] == 1


@pytest.mark.parametrize("n", [0, 1, 2, 5, 6, 7, 31, 33])
def test_short_series(n):
    t, x = series(40, seed=4)
    assert len(S.judge(t[:n], x[:n], F, S.Rule())) == n


@pytest.mark.parametrize("n", [6, 8, 10, 13, 16, 20, 24, 31, 40])
def test_spikes_in_short_series(n):
    """One reading, or three from sixteen on, a thousand times the noise off the course, wherever but at the ends."""
    rng = np.random.default_rng(n)
    for trial in range(40):
        t = np.cumsum(rng.uniform(0.1, 0.3, n))
        x = 0.3 * rng.normal() * t + rng.normal(0, 0.004, n)
        assert not (S.judge(t, x, F, S.Rule()) == 3).any()
        rows = 1 if n < 16 else int(rng.integers(1, 4))
        i = int(rng.integers(1, n - rows))
        x[i : i + rows] += rng.choice([-4.0, 4.0])
        k = S.judge(t, x, F, S.Rule())
        assert (k[i : i + rows] == 3).all() and (k == 3).sum() <= rows + (n < 8), (trial, i, rows)


@pytest.mark.parametrize("rows", [70, 150, 100_000])
def test_pieces_give_what_whole_series_give(spark, monkeypatch, rows):
    monkeypatch.setattr(S, "PIECE_ROWS", rows)
    out, want = [], set()
    for s in range(3):
        t, x = series(900, seed=10 + s)
        for i in range(40, 880, 60):
            x[i] += 0.7
        x[500:509] = x[500]
        ids = np.arange(len(x)) + 10_000 * s
        out += [(f"s{s}" if s else None, float(a), int(i), int(i), float(v), 1) for a, i, v in zip(t, ids, x)]
        want |= {(int(i), str(S.NAMES[k])) for i, k in zip(ids, S.judge(t, x, F, S.Rule())) if k}
    out += [("s1", None, 1, -1, 5.0, 1), ("s1", 3.0, 2, -2, None, 1), ("s1", 3.0, 3, -3, float("nan"), 1)]
    d = spark.createDataFrame(out, "s string, t double, frame long, id long, x double, reason int").repartition(5)
    got = S.implausible_readings(d, "s", ["t", "frame"], "id", {"x": F})
    assert {(r.id, r.reason) for r in got.collect()} == want
    assert S.implausible_readings(d.limit(0), "s", ["t", "frame"], "id", {"x": F}).count() == 0


def test_midnight_and_partitions_do_not_matter(spark):
    t, x = series(700, seed=9)
    t += 1.5 * S.DAY_S - 80
    i = int(np.searchsorted(t, 1.5 * S.DAY_S))
    x[[i - 20, i - 1, i, i + 40]] += [0.8, 1.0, 1.0, -0.9]
    x[i + 60 : i + 70] = x[i + 60]
    want = {(int(k), str(S.NAMES[v])) for k, v in enumerate(S.judge(t, x, F, S.Rule())) if v}
    assert {(i - 1, "spike"), (i, "spike")} <= want
    d = spark.createDataFrame([("s", float(a), int(k), int(k), float(b)) for k, (a, b) in enumerate(zip(t, x))], "s string, t double, frame long, id long, x double")
    for parts in (1, 7):
        got = S.implausible_readings(d.repartition(parts), "s", ["t", "frame"], "id", {"x": F})
        assert {(r.id, r.reason) for r in got.collect()} == want
