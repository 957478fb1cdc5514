"""Fits of poses on closed forms, with numbers of their own."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from posegrain.functions import poses as ps
from posegrain.operators import alignment as al
from test_pipelines import BODY, WORLD, compose, track


def pairs(spark, left, right):
    rows = [("g", i, *map(float, np.concatenate([*a, *b]))) for i, (a, b) in enumerate(zip(zip(*left), zip(*right)))]
    names = [f"{s}{c}" for s in "lr" for c in ("x", "y", "z", "qx", "qy", "qz", "qw")]
    d = spark.createDataFrame(rows, "g string, i long, " + ", ".join(f"{n} double" for n in names))
    return d.select("g", "i", ps.from_columns("l").alias("l"), ps.from_columns("r").alias("r"))


@pytest.mark.parametrize("model", ["world", "rig"])
def test_robust_pose_fit(spark, model):
    left = track(np.arange(0, 12, 0.1))
    if model == "world":
        inverse = (-_rotated(WORLD), WORLD[1] * [-1, -1, -1, 1])
        right = compose(inverse, left)
    else:
        right = compose(left, BODY)
    right = (right[0].copy(), right[1])
    right[0][[5, 40, 77]] += [0.5, -0.3, 0.2]
    want = WORLD if model == "world" else BODY
    fit, aligned = al.fit_poses(pairs(spark, left, right), ["g"], "l", "r", F.lit(True), model)
    r = fit.first()
    assert np.allclose([r.fit.p.x, r.fit.p.y, r.fit.p.z], want[0][0], atol=1e-8)
    q = np.array([r.fit.q.x, r.fit.q.y, r.fit.q.z, r.fit.q.w])
    assert abs(abs(q @ want[1][0]) - 1) < 1e-10
    assert {x.i for x in aligned.filter("NOT inlier").collect()} == {5, 40, 77}
    assert aligned.filter("inlier").agg(F.max("position_error_m")).first()[0] < 1e-8
    assert al.fit_poses(pairs(spark, left, right).limit(6), ["g"], "l", "r", F.lit(True), model)[1].count() == 0


def _rotated(pose):
    from test_pipelines import rotate

    return rotate(pose[1] * [-1, -1, -1, 1], pose[0])


def test_hand_eye_seeds_agree_and_outliers_weigh_little():
    rng = np.random.default_rng(11)

    def rigid(v, t):
        m = np.eye(4)
        m[:3, :3], m[:3, 3] = al._exp(np.array(v)), t
        return m

    x, z = rigid((0.3, -0.5, 0.8), (0.2, 0.1, -0.3)), rigid((-0.6, 0.2, 0.4), (2, -1, 0.5))
    b = np.array([rigid(rng.normal(0, 0.7, 3), rng.normal(size=3)) for _ in range(60)])
    a = z @ b @ np.linalg.inv(x)
    ra, rb = np.linalg.inv(a[:-1]) @ a[1:], np.linalg.inv(b[:-1]) @ b[1:]
    for r in al.hand_eye_seeds(ra[:, :3, :3], rb[:, :3, :3]):
        assert np.allclose(r, x[:3, :3], atol=1e-9)
    assert len(al.hand_eye_seeds(ra[:, :3, :3], rb[:, :3, :3])) == 3
    noisy = a.copy()
    noisy[::15, :3, 3] += 1.0
    gx, gz = al.hand_eye(noisy, b)
    assert np.abs(gx - x).max() < 0.02 and np.abs(gz - z).max() < 0.05
