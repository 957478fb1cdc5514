import numpy as np
import pytest

from posegrain.plans import pipelines as P


def walk(t):
    """Positions and Euler angles in degrees."""
    p = np.stack([np.sin(0.9 * t) + 0.3 * np.sin(2.3 * t), np.cos(0.7 * t), 0.4 * np.sin(1.9 * t + 1)], 1)
    return p, np.stack([25 * np.sin(0.8 * t), 20 * np.sin(1.1 * t + 2), 70 * np.sin(0.5 * t)], 1)


def quaternions(e):
    a, b, c = np.deg2rad(e.T) / 2
    return np.stack([
        np.sin(a) * np.cos(b) * np.cos(c) - np.cos(a) * np.sin(b) * np.sin(c), np.cos(a) * np.sin(b) * np.cos(c) + np.sin(a) * np.cos(b) * np.sin(c),
        np.cos(a) * np.cos(b) * np.sin(c) - np.sin(a) * np.sin(b) * np.cos(c), np.cos(a) * np.cos(b) * np.cos(c) + np.sin(a) * np.sin(b) * np.sin(c),
    ], 1)


def times(q, r):
    x, y, z, w = q.T
    X, Y, Z, W = r.T
    return np.stack([w * X + x * W + y * Z - z * Y, w * Y - x * Z + y * W + z * X, w * Z + x * Y - y * X + z * W, w * W - x * X - y * Y - z * Z], 1)


def rotate(q, v):
    conj = q * [-1, -1, -1, 1]
    return times(times(q, np.concatenate([v, np.zeros((len(v), 1))], 1)), conj)[:, :3]


def compose(a, b):
    (p, q), (r, s) = a, b
    q, s = np.broadcast_to(q, (max(len(q), len(s)), 4)), np.broadcast_to(s, (max(len(q), len(s)), 4))
    return p + rotate(q, np.broadcast_to(r, (len(q), 3))), times(q, s)


def fixed(p, e):
    return np.array([p], float), quaternions(np.array([e], float))


WORLD, BODY = fixed((0.4, -0.2, 0.1), (11, -6, 28)), fixed((0.06, 0.03, -0.08), (-20, 9, 14))


def track(t):
    p, e = walk(t)
    return p, quaternions(e)


def table(spark, t, pose, **more):
    rows = [("s", float(a), i, *map(float, p), *map(float, q), *more.values()) for i, (a, p, q) in enumerate(zip(t, *pose))]
    kinds = {str: "string", bool: "boolean"}
    return spark.createDataFrame(rows, "s string, t double, frame long, x double, y double, z double, qx double, qy double, qz double, qw double" + "".join(f", {k} {kinds[type(v)]}" for k, v in more.items()))


def test_evaluation_finds_offset_frame_and_body(spark):
    tv, tt = np.arange(0, 60, 0.1), np.arange(-2, 62, 0.02)
    # The camera's track, and the marker body's in its own world: camera = world^-1 body x.
    truth = table(spark, tt, compose(compose(WORLD, track(tt + 0.34)), BODY)).drop("frame")
    matched, report = P.evaluate(table(spark, tv, track(tv), source="direct", recovered=True), truth, ["s"], radius=0.5)
    r = report.first()
    assert r.verdict == "FORMAL_ACCURACY" and r.rmse < 0.004 and r.orientation_rmse < 0.2 and r.score > 0.98
    assert abs(r.offset_s + 0.34) <= 0.002 and r.recovery_n == r.n and r.rpe_m_rmse < 0.01 and r.rmse_low <= r.rmse <= r.rmse_high if hasattr(r, "rmse_low") else True
    assert {x.status for x in matched.select("status").distinct().collect()} == {"RECOVERED_DIRECT"}
    _, flow = P.evaluate(table(spark, tv[:150], track(tv[:150]), source="optical_flow"), truth, ["s"], radius=0.5)
    assert set(flow.first().reasons.split()) >= {"uses_flow", "few_test_rows"}


def test_pair_in_another_world(spark):
    tl, tr = np.arange(0, 30, 0.05), np.arange(0, 30, 0.04)
    right = compose(WORLD, track(tr - 0.53))
    right[0][100:104] += 0.15  # does not belong
    aligned, report, curve = P.align_pair(table(spark, tl, track(tl), direct=True), table(spark, tr, right, direct=True), ["s"], radius=0.8)
    r = report.first()
    assert (r.verdict, r.failed, r.fit_source) == ("PASS", "", "both_direct") and abs(r.offset_s - 0.53) <= 0.005 and r.position_median < 0.005
    assert 0 < r.n - r.n_inliers < 30 and curve.count() == 161
    _, few, _ = P.align_pair(table(spark, tl, track(tl), direct=True), table(spark, tr, right, direct=False), ["s"], radius=0.8)
    assert few.first().fit_source == "all_valid"


def test_ground_truth_report(spark):
    tv, tt = np.arange(0, 40, 0.1), np.arange(-3, 44, 0.03)
    truth = table(spark, tt, compose(WORLD, track(tt + 0.3))).drop("frame")
    frames = spark.createDataFrame([("s", float(t), i, not 100 <= i < 110) for i, t in enumerate(tv)], "s string, t double, frame long, valid boolean")
    matched, report = P.ground_truth_report(table(spark, tv, track(tv)).drop("frame"), truth, ["s"], frames=frames)
    r = report.first()
    assert abs(r.offset_s + 0.3) <= 0.051 and r.rmse < 0.01 and r.orientation_rmse < 1.0 and r.rpe_m_rmse < 0.01
    assert r.n_losses == 1 and abs(r.longest_loss_s - 1.0) < 1e-9 and r.recovery_rmse < 0.02


def test_stages(tmp_path):
    ran = []
    stages = {n: (lambda n=n: ran.append(n)) for n in ("track", "score", "render")}
    folder = str(tmp_path / "run")
    assert P.run_stages(stages, folder, {"a": 1}, dry_run=True) == ["track", "score", "render"] and not ran
    assert P.run_stages(stages, folder, {"a": 1}) == ["track", "score", "render"] == ran
    assert P.run_stages(stages, folder, {"a": 1}) == []
    assert P.run_stages(stages, folder, {"a": 1}, start="score") == ["score", "render"]
    with pytest.raises(ValueError):
        P.run_stages(stages, folder, {"a": 2})
    assert len(P.run_stages(stages, folder, {"a": 2}, force=True)) == 3
    with pytest.raises(ValueError):
        P.run_stages(stages, folder, {"a": 2}, start="none")
