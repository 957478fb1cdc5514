import numpy as np
from pyspark.sql import functions as F

from posegrain.operators.regular_grid import covered_steps, regular_grid


def grid(d, **k):
    return {(r.s, r.step_no): r for r in regular_grid(d, "s", "t", F.col("y"), F.col("ok"), **k).collect()}


def test_line_is_met_and_gaps_marked(spark):
    rng = np.random.default_rng(0)
    t = np.sort(np.concatenate([rng.uniform(0, 20, 120), rng.uniform(40, 60, 120)]))
    d = spark.createDataFrame([("a", float(x), float(3 + 0.5 * x), True) for x in t], "s string, t double, y double, ok boolean")
    g = grid(d)
    assert sorted(n for _, n in g) == list(range(int(t[0]), int(t[-1]) + 1))
    for (_, n), r in g.items():
        if r.state == "missing":
            assert r.value is None and 20 <= n < 40
        else:
            assert abs(r.value - (3 + 0.5 * (n + 0.5))) < 1e-6
    assert g["a", 30].support == 0 and g["a", 5].n_inside > 0


def test_against_brute_force(spark):
    rng = np.random.default_rng(1)
    t, y = np.sort(rng.uniform(0, 12, 60)), rng.normal(size=60)
    g = grid(spark.createDataFrame([("a", float(a), float(b), True) for a, b in zip(t, y)], "s string, t double, y double, ok boolean"))
    for (_, n), r in g.items():
        d = t - (n + 0.5)
        u = 1 - (d / 2.5) ** 2
        w = np.where(u > 0, u**3, 0)
        m = np.stack([np.ones_like(d), d], 1)
        want = np.linalg.lstsq(m * np.sqrt(w)[:, None], y * np.sqrt(w), rcond=None)[0][0]
        if r.value is not None:
            assert abs(r.value - want) < 1e-6
        assert abs(r.support - w.sum() ** 2 / (w**2).sum()) < 1e-6


def test_pauses_and_odd_rows(spark):
    rows = [("a", 0.5, 1.0, True), ("a", 800.2, 2.0, True), ("a", 800.2, 2.0, True), ("a", None, 5.0, True), ("a", 802.0, float("nan"), True), ("a", 803.0, None, True), ("a", 804.0, 7.0, False), ("b", 3.0, 1.0, None), (None, 1.0, 1.0, True)]
    d = spark.createDataFrame(rows, "s string, t double, y double, ok boolean")
    g = grid(d)
    assert sorted(n for s, n in g if s == "a") == [0, 800, 801, 802, 803, 804]
    assert g["a", 800].state == "observed" and g["a", 800].n_inside == 2 and abs(g["a", 800].value - 2) < 1e-9
    assert g["a", 804].state != "observed" and g["b", 3].state == "missing" and g[None, 1].state == "observed"
    assert regular_grid(d.limit(0), "s", "t", F.col("y"), F.col("ok")).count() == 0
    spans = d.filter("t IS NOT NULL AND s = 'a'").select(F.col("s").alias("source"), F.col("t").alias("_from"), F.col("t").alias("_to"))
    assert covered_steps(spans, 1.0, None).count() == 805
