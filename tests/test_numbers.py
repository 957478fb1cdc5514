import numpy as np
import pytest
from pyspark.sql import functions as F

from posegrain.functions import rotations as rot
from posegrain.operators import aggregates as agg
from posegrain.operators import alignment as al
from posegrain.operators import smoothing as sm
from posegrain.operators import sync


def matrix(roll, pitch, yaw):
    a, b, c = np.deg2rad([roll, pitch, yaw])
    rx = np.array([[1, 0, 0], [0, np.cos(a), -np.sin(a)], [0, np.sin(a), np.cos(a)]])
    ry = np.array([[np.cos(b), 0, np.sin(b)], [0, 1, 0], [-np.sin(b), 0, np.cos(b)]])
    rz = np.array([[np.cos(c), -np.sin(c), 0], [np.sin(c), np.cos(c), 0], [0, 0, 1]])
    return rz @ ry @ rx


def test_exact_percentiles(spark):
    rng = np.random.default_rng(0)
    rows = []
    for g in ("a", "b", None, "one"):
        x = np.round(rng.normal(0, 100, 1 if g == "one" else 500), 1 if g == "a" else 6)
        rows += [(g, float(v)) for v in x] + [(g, None), (g, float("nan"))]
    d = spark.createDataFrame(rows, "g string, x double").repartition(5)
    got = {r.g: r for r in agg.percentiles(d, ["g"], "x", {"p5": 0.05, "p50": 0.5, "p95": 0.95, "p100": 1.0}).collect()}
    stats = {r.g: r for r in agg.error_stats(d, ["g"], "x").collect()}
    for g in ("a", "b", None, "one"):
        x = np.array([v for k, v in rows if k == g and v is not None and v == v])
        assert got[g].n == len(x)
        assert np.allclose([got[g].p5, got[g].p50, got[g].p95, got[g].p100], np.percentile(x, [5, 50, 95, 100]))
        assert np.allclose([stats[g].rmse, stats[g].max], [np.sqrt((x**2).mean()), x.max()])
    assert agg.percentiles(d.limit(0), ["g"], "x", {"m": 0.5}).count() == 0


def test_correlation_guards(spark):
    d = spark.createDataFrame([("a", float(i), 2.0 * i) for i in range(30)] + [("b", float(i), 1.0) for i in range(30)] + [("c", 1.0, 2.0)], "g string, x double, y double")
    got = {r.g: r.r for r in d.groupBy("g").agg(agg.correlation(F.col("x"), F.col("y"), 20).alias("r")).collect()}
    assert abs(got["a"] - 1) < 1e-12 and got["b"] is None and got["c"] is None


def test_bootstrap_is_the_same_draw(spark):
    rng = np.random.default_rng(1)
    t, x = np.sort(rng.uniform(0, 30, 200)), rng.normal(size=200)
    d = spark.createDataFrame([("g", float(a), float(b)) for a, b in zip(t, x)], "g string, t double, x double")
    r = agg.block_bootstrap(d, ["g"], "t", "x", draws=50).first()
    b = np.floor(t - t.min()).astype(int)
    blocks = [x[b == k] for k in np.unique(b)]
    draw = np.random.default_rng(42)
    picks = []
    for _ in range(50):
        y = np.concatenate([blocks[i] for i in draw.integers(0, len(blocks), len(blocks))])
        picks.append(np.sqrt((y**2).mean()))
    assert np.allclose([r.low, r.high], np.percentile(picks, [2.5, 97.5]))


def test_rotations(spark):
    rng = np.random.default_rng(2)
    e = [(float(a), float(b), float(c)) for a, b, c in zip(rng.uniform(-180, 180, 50), rng.uniform(-89, 89, 50), rng.uniform(-180, 180, 50))] + [(10.0, 90.0, 0.0)]
    d = spark.createDataFrame(e, "r double, p double, y double").withColumn("q", rot.from_euler(F.col("r"), F.col("p"), F.col("y")))
    m = rot.to_matrix(F.col("q"))
    roll, pitch, yaw = rot.to_euler(F.col("q"))
    v = rot.rotate(F.col("q"), rot.vector(F.lit(1.0), F.lit(2.0), F.lit(3.0)))
    d = d.withColumn("v", v)
    rows = d.select("r", "p", "y", F.array(*[c for line in m for c in line]).alias("m"), roll.alias("r2"), pitch.alias("p2"), yaw.alias("y2"), "v").collect()
    for r in rows:
        want = matrix(r.r, r.p, r.y)
        assert np.allclose(np.array(r.m).reshape(3, 3), want)
        assert np.allclose(matrix(r.r2, r.p2, r.y2), want, atol=1e-7)
        assert np.allclose([r.v.x, r.v.y, r.v.z], want @ [1, 2, 3])
    one = spark.range(1).select(rot.from_euler(F.lit(0.0), F.lit(0.0), F.lit(10.0)).alias("a"), rot.from_euler(F.lit(0.0), F.lit(0.0), F.lit(50.0)).alias("b"), rot.from_euler(F.lit(0.0), F.lit(0.0), F.lit(20.0)).alias("half"))
    one = one.withColumn("quarter", rot.slerp(F.col("a"), F.col("b"), F.lit(0.25)))
    r = one.select(rot.angle_deg(F.col("a"), F.col("b")).alias("d"), rot.angle_deg(F.col("quarter"), F.col("half")).alias("s")).first()
    assert abs(r.d - 40) < 1e-9 and r.s < 1e-9


def test_kabsch(spark):
    a = np.array([[0, 0, 0], [1, 0, 0], [0, 2, 0], [0, 0, 3.0]])
    r, t = matrix(0, 0, 37), np.array([0.4, -0.2, 1.3])
    b = a @ r.T + t
    d = spark.createDataFrame([("g", *map(float, p), *map(float, q)) for p, q in zip(a, b)] + [("h", 1.0, 1.0, 1.0, 1.0, 1.0, None)], "g string, x double, y double, z double, mx double, my double, mz double")
    got = al.fit_rigid(d, ["g"], ["x", "y", "z"], ["mx", "my", "mz"]).collect()
    assert len(got) == 1
    assert np.allclose([[got[0][f"r{i}{j}"] for j in (1, 2, 3)] for i in (1, 2, 3)], r, atol=1e-12) and np.allclose([got[0].t1, got[0].t2, got[0].t3], t)
    moved = al.apply_rigid(d, al.fit_rigid(d, ["g"], ["x", "y", "z"], ["mx", "my", "mz"]), ["g"], ["x", "y", "z"]).filter("g = 'g'").collect()
    assert all(abs(m.x_aligned - m.mx) < 1e-9 for m in moved)


def test_mean_rotation(spark):
    d = spark.createDataFrame([("g", -10.0), ("g", 30.0)], "g string, yaw double").withColumn("q", rot.from_euler(F.lit(0.0), F.lit(0.0), F.col("yaw")))
    m = al.mean_rotation(d, ["g"], "q").first()
    assert abs(np.rad2deg(2 * np.arctan2(m.qz, m.qw)) - 10) < 1e-9


def test_hand_eye_closed_form():
    rng = np.random.default_rng(7)

    def rigid(e, t):
        m = np.eye(4)
        m[:3, :3], m[:3, 3] = matrix(*e), t
        return m

    x, z = rigid((18, -9, 33), (0.1, -0.2, 0.05)), rigid((-12, 7, 41), (1, 2, 3))
    b = np.array([rigid(rng.uniform(-60, 60, 3), rng.normal(size=3)) for _ in range(80)])
    a = np.array([z @ m @ np.linalg.inv(x) for m in b])
    gx, gz = al.hand_eye(a, b)
    assert np.allclose(gx, x, atol=1e-6) and np.allclose(gz, z, atol=1e-6)


def test_robust_inliers(spark):
    rng = np.random.default_rng(3)
    x = np.abs(np.concatenate([rng.normal(0, 0.01, 200), [1.0, 2.0, 3.0]]))
    got = al.robust_inliers(spark.createDataFrame([("g", float(v)) for v in x], "g string, r double"), ["g"], "r", 0.002)
    keep = np.ones(len(x), bool)
    for _ in range(5):
        m = np.median(x[keep])
        keep = x <= m + max(4 * 1.4826 * np.median(np.abs(x[keep] - m)), 0.002)
    assert got.filter("inlier").count() == keep.sum()


def full_smoother(t, z, sm_, sa, r0):
    """Textbook filter and smoother with matrices."""
    n = len(t)
    x, p = np.array([z[0], 0.0]), np.diag([sm_**2, r0**2])
    h = np.array([[1.0, 0.0]])
    xs, ps, xp, pp, fs = [], [], [], [], []
    for i in range(n):
        f = np.eye(2)
        if i:
            dt = t[i] - t[i - 1]
            f = np.array([[1, dt], [0, 1]])
            x, p = f @ x, f @ p @ f.T + sa**2 * np.array([[dt**3 / 3, dt**2 / 2], [dt**2 / 2, dt]])
        xp.append(x)
        pp.append(p)
        fs.append(f)
        if not np.isnan(z[i]):
            k = p @ h.T / (h @ p @ h.T + sm_**2)
            x, p = x + (k @ (z[i] - h @ x[:, None])).ravel(), (np.eye(2) - k @ h) @ p
        xs.append(x)
        ps.append(p)
    for i in range(n - 2, -1, -1):
        g = ps[i] @ fs[i + 1].T @ np.linalg.inv(pp[i + 1])
        xs[i] = xs[i] + g @ (xs[i + 1] - xp[i + 1])
    return np.array(xs)


def test_kalman_against_matrices():
    rng = np.random.default_rng(4)
    t = np.cumsum(rng.uniform(0.02, 0.5, 60))
    z = np.sin(t) + rng.normal(0, 0.05, 60)
    z[[10, 11, 30]] = np.nan
    x, v = sm.smooth_constant_velocity(t, z, 0.04, 0.8, 0.5)
    want = full_smoother(t, z, 0.04, 0.8, 0.5)
    assert np.allclose(x, want[:, 0]) and np.allclose(v, want[:, 1])
    assert np.isnan(sm.smooth_constant_velocity(t[:2], np.array([np.nan, np.nan]), 1, 1, 1)[0]).all()


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 9, 10, 40])
def test_savgol_keeps_parabolas(n):
    x = np.arange(n, dtype=float)
    y = 1 + 2 * x - 0.3 * x * x
    assert np.allclose(sm.savgol(y), y)
    assert len(sm.despike_and_smooth(y)) == n


def test_offset_is_found(spark):
    t1, t2 = np.arange(0, 21, 0.05), np.arange(0, 24, 1 / 60)
    speed = lambda t: 1 + np.sin(1.3 * t) + 0.5 * np.sin(3.1 * t + 1)
    left = spark.createDataFrame([("s", float(t), float(speed(t))) for t in t1], "s string, t double, speed double")
    right = spark.createDataFrame([("s", float(t), float(speed(t + 0.37))) for t in t2], "s string, t double, speed double")
    r = sync.find_offset(left, right, ["s"], radius=1.0, coarse=0.05, fine=0.005).first()
    assert abs(r.offset_s + 0.37) <= 0.005 and r.score > 0.99
