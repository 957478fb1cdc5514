import numpy as np

from posegrain.plans import reference as R


def test_registered_draws(spark, monkeypatch):
    """A second to a block and 1,000 draws, each drawn on its own, also for a session of a few seconds and one drawn in several goes."""
    rng = np.random.default_rng(5)
    times = {"short": np.sort(rng.uniform(0, 4, 60)), "long": np.arange(0, 400, 0.5)}
    errors = {k: np.abs(rng.normal(size=len(t))) for k, t in times.items()}
    d = spark.createDataFrame([(k, float(a), float(b)) for k, t in times.items() for a, b in zip(t, errors[k])], "session_id string, t double, rmse double")
    monkeypatch.setattr(R, "poses", lambda *_: d)
    got = {r.session_id: r for r in R.agg_bootstrap(spark, "").collect()}
    for k, t in times.items():
        _, b = np.unique(np.floor(t - t.min()), return_inverse=True)
        ss, c = np.bincount(b, errors[k] ** 2), np.bincount(b)
        draw = np.random.default_rng(42)
        picks = [np.sqrt(ss[i].sum() / c[i].sum()) for i in (draw.integers(0, len(c), len(c)) for _ in range(1000))]
        assert got[k].n_blocks == len(c)
        assert np.allclose([got[k].low, got[k].high], np.percentile(picks, [2.5, 97.5]), atol=1e-6)
