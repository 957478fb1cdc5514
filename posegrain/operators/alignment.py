"""Rigid alignment: sums over all rows in Spark, small solves on the sums.

Each solve needs a dozen sums per group, so the rows never leave the executors and groups are bounded.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posegrain.functions import poses
from posegrain.functions import rotations as rot
from posegrain.operators.aggregates import join_null_safe, percentiles
from posegrain.session import ship_package, written


def kabsch(means_a: np.ndarray, means_b: np.ndarray, cross: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(R, t) with b ≈ R a + t from the means of both sides and the centred cross products a bᵀ; never a reflection."""
    u, _, vt = np.linalg.svd(cross)
    d = np.sign(np.linalg.det(vt.T @ u.T)) or 1.0
    r = vt.T @ np.diag([1.0, 1.0, d]) @ u.T
    return r, means_b - r @ means_a


def quaternion_of(r: np.ndarray) -> np.ndarray:
    """(x, y, z, w), w ≥ 0, from the eigenvector of the symmetric form, which has no branches."""
    k = np.array([
        [r[0, 0] - r[1, 1] - r[2, 2], r[1, 0] + r[0, 1], r[2, 0] + r[0, 2], r[2, 1] - r[1, 2]],
        [r[1, 0] + r[0, 1], r[1, 1] - r[0, 0] - r[2, 2], r[2, 1] + r[1, 2], r[0, 2] - r[2, 0]],
        [r[2, 0] + r[0, 2], r[2, 1] + r[1, 2], r[2, 2] - r[0, 0] - r[1, 1], r[1, 0] - r[0, 1]],
        [r[2, 1] - r[1, 2], r[0, 2] - r[2, 0], r[1, 0] - r[0, 1], r[0, 0] + r[1, 1] + r[2, 2]],
    ])
    v = np.linalg.eigh(k)[1][:, -1]
    return -v if v[3] < 0 else v


def fit_rigid(pairs: DataFrame, keys: list[str], a: list[str], b: list[str]) -> DataFrame:
    """The rotation and translation that map points ``a`` onto points ``b`` best, without scale, per group.

    Columns: ``keys``, ``n``, ``r11`` … ``r33``, ``t1`` … ``t3`` and the rotation as ``qx`` … ``qw``. Rows with a NULL coordinate are left out;
    groups of fewer than three pairs have no row.
    """
    ship_package(pairs.sparkSession)
    rows = pairs.dropna(subset=[*a, *b])
    sums = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m_{s}{i}") for s, cols in (("a", a), ("b", b)) for i, c in enumerate(cols)], *[F.covar_pop(x, y).alias(f"c{i}{j}") for i, x in enumerate(a) for j, y in enumerate(b)]
    )
    types = ", ".join(f"`{k}` {pairs.schema[k].dataType.simpleString()}" for k in keys)
    names = [*[f"r{i}{j}" for i in (1, 2, 3) for j in (1, 2, 3)], *[f"t{i}" for i in (1, 2, 3)], *[f"q{c}" for c in "xyzw"]]

    def solve(frames):
        for f in frames:
            f = f[f["n"] >= 3]
            out = []
            for row in f.to_dict("records"):
                r, t = kabsch(np.array([row[f"m_a{i}"] for i in range(3)]), np.array([row[f"m_b{i}"] for i in range(3)]), np.array([[row[f"c{i}{j}"] for j in range(3)] for i in range(3)]))
                out.append([*(row[k] for k in keys), row["n"], *r.ravel(), *t, *quaternion_of(r)])
            yield pd.DataFrame(out, columns=[*keys, "n", *names])

    return sums.mapInPandas(solve, f"{types}, n long, {', '.join(f'{n} double' for n in names)}")


def apply_rigid(df: DataFrame, fit: DataFrame, keys: list[str], points: list[str], suffix: str = "_aligned") -> DataFrame:
    """Adds the points moved by their group's fit; rows of groups without a fit get NULL."""
    d = join_null_safe(df, fit.drop("n", "qx", "qy", "qz", "qw"), keys, "left")
    for i, p in enumerate(points, 1):
        d = d.withColumn(p + suffix, F.col(f"r{i}1") * F.col(points[0]) + F.col(f"r{i}2") * F.col(points[1]) + F.col(f"r{i}3") * F.col(points[2]) + F.col(f"t{i}"))
    return d.drop(*[f"r{i}{j}" for i in (1, 2, 3) for j in (1, 2, 3)], *[f"t{i}" for i in (1, 2, 3)])


def mean_rotation(df: DataFrame, keys: list[str], q: str) -> DataFrame:
    """The chordal mean of unit quaternions (struct x, y, z, w) per group: top eigenvector of Σ q qᵀ; w ≥ 0."""
    ship_package(df.sparkSession)
    parts = "xyzw"
    sums = df.filter(F.col(q).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col(f"{q}.{parts[i]}") * F.col(f"{q}.{parts[j]}")).alias(f"s{i}{j}") for i in range(4) for j in range(i, 4)])
    types = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)

    def solve(frames):
        for f in frames:
            m = np.zeros((len(f), 4, 4))
            for i in range(4):
                for j in range(i, 4):
                    m[:, i, j] = m[:, j, i] = f[f"s{i}{j}"]
            v = np.linalg.eigh(m)[1][:, :, -1] if len(f) else np.zeros((0, 4))
            v = np.where(v[:, 3:] < 0, -v, v)
            yield pd.DataFrame({**{k: f[k] for k in keys}, "n": f["n"], **{f"q{c}": v[:, i] for i, c in enumerate(parts)}})

    return sums.mapInPandas(solve, f"{types}, n long, qx double, qy double, qz double, qw double")


def robust_inliers(df: DataFrame, keys: list[str], residual: str, floor: float, rounds: int = 5, least: int = 10) -> DataFrame:
    """Adds ``inlier``: residual within median + 4·1.4826·MAD (at least ``floor`` beyond the median), refitted.

    Each round takes the limits from the inliers of the last; a group stops below ``least`` inliers. Two
    exact percentiles per round and group travel, no rows.
    """
    d = df.withColumn("inlier", F.col(residual).isNotNull())
    for _ in range(rounds):
        m = percentiles(d.filter("inlier"), keys, residual, {"_m": 0.5}).withColumnRenamed("n", "_n")
        spread = join_null_safe(d.filter("inlier"), m, keys).withColumn("_d", F.abs(F.col(residual) - F.col("_m")))
        s = percentiles(spread, keys, "_d", {"_s": 0.5}).drop("n")
        limits = join_null_safe(m, s, keys).select(*keys, "_n", (F.col("_m") + F.greatest(4 * 1.4826 * F.col("_s"), F.lit(floor))).alias("_limit"))
        d = join_null_safe(d, limits, keys, "left")
        d = d.withColumn("inlier", F.when(F.col("_n") >= least, F.coalesce(F.col(residual) <= F.col("_limit"), F.lit(False))).otherwise(F.col("inlier"))).drop("_n", "_limit")
        d = written(d)  # else each round would repeat all before it
    return d


def _axes(d: DataFrame, keys: list[str], values: dict[str, Column], share: str) -> DataFrame:
    """Exact medians of several columns at once: ``keys`` and ``<name>_<share>``."""
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("_axis"), c.alias("_value")) for n, c in values.items()])).alias("_e")
    p = percentiles(d.select(*keys, each).select(*keys, "_e._axis", "_e._value"), [*keys, "_axis"], "_value", {"_median": 0.5})
    return p.groupBy(*keys).agg(*[F.max(F.when(F.col("_axis") == n, F.col("_median"))).alias(f"{n}_{share}") for n in values])


def fit_poses(pairs: DataFrame, keys: list[str], left: str, right: str, eligible: Column, model: str = "world", rounds: int = 5, least: int = 10, floor_m: float = 0.002, floor_deg: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """The fixed transform between two tracks of poses (struct columns ``left``, ``right``), robustly, per group.

    ``world``: left = T right, the tracks' frames differ. ``rig``: right = left T, the bodies differ. The rotation is the chordal
    mean, the translation the median by axis, over rows within median + 4·1.4826·deviation of both errors (or the floors);
    limits and fit are made again up to ``rounds`` times, as long as ``least`` rows stay. Returns (``keys``, n, struct ``fit``) and the
    pairs with ``aligned`` (right brought to left), ``position_error_m``, ``orientation_error_deg`` and ``inlier``. Groups with fewer than ``least``
    eligible rows have no fit, and no rows. NULL poses are left out.
    """
    if model not in ("world", "rig"):
        raise ValueError(f"no model {model!r}")
    d = pairs.filter(F.col(left).isNotNull() & F.col(right).isNotNull()).withColumn("_eligible", F.coalesce(eligible, F.lit(False))).withColumn("inlier", F.col("_eligible"))
    counts = d.groupBy(*keys).agg(F.sum(F.col("inlier").cast("long")).alias("_n")).filter(F.col("_n") >= least).select(*keys)
    d = written(join_null_safe(d, counts, keys, "left_semi"))
    a, b = F.col(left), F.col(right)
    fit = None
    for k in range(rounds):
        kept = d.filter("inlier")
        between = rot.multiply(a["q"], rot.inverse(b["q"])) if model == "world" else rot.multiply(rot.inverse(a["q"]), b["q"])
        mean = mean_rotation(kept.withColumn("_d", between), keys, "_d").withColumn("_r", rot.quaternion(*(F.col(f"q{c}") for c in "xyzw"))).select(*keys, "n", "_r")
        moved = join_null_safe(kept, mean, keys)
        off = poses.difference(a["p"], rot.rotate(F.col("_r"), b["p"])) if model == "world" else rot.rotate(rot.inverse(a["q"]), poses.difference(b["p"], a["p"]))
        middle = _axes(moved.withColumn("_o", off), keys, {c: F.col(f"_o.{c}") for c in "xyz"}, "m")
        fit = join_null_safe(mean, middle, keys).select(*keys, "n", poses.pose(rot.vector(F.col("x_m"), F.col("y_m"), F.col("z_m")), F.col("_r")).alias("fit"))
        fit = written(fit)
        d = join_null_safe(d.drop("aligned", "position_error_m", "orientation_error_deg", "fit"), fit.drop("n"), keys)
        d = d.withColumn("aligned", poses.compose(F.col("fit"), b) if model == "world" else poses.compose(b, poses.invert(F.col("fit"))))
        d = d.withColumns({"position_error_m": poses.length(poses.difference(a["p"], F.col("aligned.p"))), "orientation_error_deg": rot.angle_deg(a["q"], F.col("aligned.q"))})
        d = written(d)
        errors = {"p": F.col("position_error_m"), "o": F.col("orientation_error_deg")}
        limits = _axes(d.filter("inlier"), keys, errors, "m")
        spread = _axes(join_null_safe(d.filter("inlier"), limits, keys), keys, {n: F.abs(c - F.col(f"{n}_m")) for n, c in errors.items()}, "s")
        limits = join_null_safe(limits, spread, keys)
        top = lambda n, floor: F.greatest(F.col(f"{n}_m") + 4 * 1.4826 * F.col(f"{n}_s"), F.lit(floor))
        d2 = join_null_safe(d, limits.select(*keys, top("p", floor_m).alias("_pl"), top("o", floor_deg).alias("_ol")), keys)
        d2 = d2.withColumn("_next", F.col("_eligible") & (errors["p"] <= F.col("_pl")) & (errors["o"] <= F.col("_ol")))
        groups = d2.groupBy(*keys).agg(F.sum(F.col("_next").cast("long")).alias("_n"), F.max(F.col("_next") != F.col("inlier")).alias("_new"))
        groups = written(groups.withColumn("_new", F.col("_new") & (F.col("_n") >= least)).select(*keys, "_new"))
        if groups.filter("_new").isEmpty():
            break
        d = written(join_null_safe(d2, groups, keys).withColumn("inlier", F.when(F.col("_new"), F.col("_next")).otherwise(F.col("inlier"))).drop("_pl", "_ol", "_next", "_new"))
    return fit, d.drop("_eligible", "fit")


def _logs(r: np.ndarray) -> np.ndarray:
    """Rotation vectors of rotation matrices (n, 3, 3)."""
    c = np.clip((np.trace(r, axis1=1, axis2=2) - 1) / 2, -1, 1)
    angle = np.arccos(c)
    v = np.stack([r[:, 2, 1] - r[:, 1, 2], r[:, 0, 2] - r[:, 2, 0], r[:, 1, 0] - r[:, 0, 1]], 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        out = v * np.where(angle < 1e-6, 0.5, angle / (2 * np.sin(angle)))[:, None]
    for i in np.flatnonzero(np.pi - angle < 1e-5):
        axis = np.linalg.eigh((r[i] + r[i].T) / 2)[1][:, -1]
        out[i] = axis * angle[i] * (np.sign(v[i] @ axis) or 1)
    return out


def _exp(v: np.ndarray) -> np.ndarray:
    a = np.linalg.norm(v)
    k = np.array([[0, -v[2], v[1]], [v[2], 0, -v[0]], [-v[1], v[0], 0]])
    if a < 1e-12:
        return np.eye(3) + k
    return np.eye(3) + np.sin(a) / a * k + (1 - np.cos(a)) / a**2 * (k @ k)


def _inverses(m: np.ndarray) -> np.ndarray:
    out = np.zeros_like(m)
    out[..., :3, :3] = np.swapaxes(m[..., :3, :3], -1, -2)
    out[..., :3, 3] = -np.einsum("...ij,...j->...i", out[..., :3, :3], m[..., :3, 3])
    out[..., 3, 3] = 1
    return out


def _skew(v: np.ndarray) -> np.ndarray:
    zero = np.zeros(len(v))
    return np.stack([zero, -v[:, 2], v[:, 1], v[:, 2], zero, -v[:, 0], -v[:, 1], v[:, 0], zero], 1).reshape(-1, 3, 3)


def _nearest_rotation(m: np.ndarray) -> np.ndarray:
    u, _, vt = np.linalg.svd(m)
    return u @ vt


def hand_eye_seeds(ra: np.ndarray, rb: np.ndarray) -> list[np.ndarray]:
    """Rotations X with A X = X B for relative motions, by three methods: axes as modified Rodrigues vectors (Tsai, Lenz), logarithms
    (Park, Martin), quaternions (Horaud, Dornaika). Reflections are no rotations and are left out."""
    la, lb = _logs(ra), _logs(rb)
    size_a, size_b = np.linalg.norm(la, axis=1), np.linalg.norm(lb, axis=1)
    unit_a, unit_b = la / np.maximum(size_a, 1e-12)[:, None], lb / np.maximum(size_b, 1e-12)[:, None]
    found = []
    # 2 sin(angle / 2) times the axis of both: skew(a + b) x = b - a.
    pa, pb = 2 * np.sin(size_a / 2)[:, None] * unit_a, 2 * np.sin(size_b / 2)[:, None] * unit_b
    x = np.linalg.lstsq(_skew(pa + pb).reshape(-1, 3), (pb - pa).ravel(), rcond=None)[0]
    p = 2 * x / np.sqrt(1 + x @ x)
    found.append((1 - p @ p / 2) * np.eye(3) + (np.outer(p, p) + np.sqrt(max(0.0, 4 - p @ p)) * _skew(p[None])[0]) / 2)
    # The orthogonal matrix that best turns the logarithms of b into those of a.
    found.append(_nearest_rotation(la.T @ lb))
    # qa x = x qb for unit quaternions (w, v): the eigenvector of the smallest eigenvalue.
    qa = np.concatenate([np.cos(size_a / 2)[:, None], np.sin(size_a / 2)[:, None] * unit_a], 1)
    qb = np.concatenate([np.cos(size_b / 2)[:, None], np.sin(size_b / 2)[:, None] * unit_b], 1)
    m = np.zeros((len(qa), 4, 4))
    dv, sv = qa[:, 1:] - qb[:, 1:], _skew(qa[:, 1:] + qb[:, 1:])
    m[:, 0, 1:], m[:, 1:, 0], m[:, 1:, 1:] = -dv, dv, sv
    m += (qa[:, 0] - qb[:, 0])[:, None, None] * np.eye(4)
    w, i, j, k = np.linalg.eigh(np.einsum("nij,nik->jk", m, m))[1][:, 0]
    found.append(np.array([[1 - 2 * (j * j + k * k), 2 * (i * j - k * w), 2 * (i * k + j * w)], [2 * (i * j + k * w), 1 - 2 * (i * i + k * k), 2 * (j * k - i * w)], [2 * (i * k - j * w), 2 * (j * k + i * w), 1 - 2 * (i * i + j * j)]]))
    return [_nearest_rotation(r) for r in found if np.isfinite(r).all() and np.linalg.det(r) > 0]


def hand_eye(a: np.ndarray, b: np.ndarray, rounds: int = 50, huber: float = 1.0, scale_t: float = 0.02, scale_r: float = np.deg2rad(2)) -> tuple[np.ndarray, np.ndarray]:
    """(X, Z), 4x4, with a[i] X ≈ Z b[i] for matched pose sequences.

    Each seed's rotation gets its translation by least squares and Z as the mean of a X b⁻¹; the seed of the smallest median error
    (the identity where there is none) starts damped Gauss-Newton steps with Huber weights on both.
    """
    n = len(a)
    step = max(1, n // 60)
    ra, rb = _inverses(a[:-step]) @ a[step:], _inverses(b[:-step]) @ b[step:]

    def whole(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x, z = np.eye(4), np.eye(4)
        x[:3, :3] = r
        lhs = (ra[:, :3, :3] - np.eye(3)).reshape(-1, 3)
        x[:3, 3] = np.linalg.lstsq(lhs, (rb[:, :3, 3] @ r.T - ra[:, :3, 3]).ravel(), rcond=None)[0]
        zs = a @ x @ _inverses(b)
        u, _, vt = np.linalg.svd(zs[:, :3, :3].sum(0))
        z[:3, :3] = u @ np.diag([1, 1, np.linalg.det(u @ vt)]) @ vt
        z[:3, 3] = np.median(zs[:, :3, 3], 0)
        return x, z

    def residuals(x: np.ndarray, z: np.ndarray, s_r: float = scale_r, s_t: float = scale_t) -> np.ndarray:
        e = _inverses(a @ x) @ (z @ b)
        return np.concatenate([_logs(e[:, :3, :3]) / s_r, e[:, :3, 3] / s_t], 1)

    seeds = [whole(r) for r in hand_eye_seeds(ra[:, :3, :3], rb[:, :3, :3]) or [np.eye(3)]]
    x, z = min(seeds, key=lambda s: float(np.median(np.linalg.norm(residuals(*s, 1.0, 1.0), axis=1))))

    def moved(m: np.ndarray, d: np.ndarray) -> np.ndarray:
        out = m.copy()
        out[:3, :3], out[:3, 3] = m[:3, :3] @ _exp(d[:3]), m[:3, 3] + d[3:]
        return out

    def cost(r: np.ndarray) -> float:
        r = np.abs(r)
        return float(np.where(r <= huber, r * r, 2 * huber * r - huber * huber).sum())

    base, damping = residuals(x, z), 1e-9
    for _ in range(rounds):
        weight = np.sqrt(np.where(np.abs(base) <= huber, 1, huber / np.maximum(np.abs(base), 1e-12)))
        jac = np.stack([((residuals(moved(x, d[:6]), moved(z, d[6:])) - base) * weight / 1e-6).ravel() for d in np.eye(12) * 1e-6], 1)
        normal, slope = jac.T @ jac, -jac.T @ (base * weight).ravel()
        d = np.linalg.lstsq(normal + damping * np.diag(np.diag(normal)), slope, rcond=None)[0]
        nx, nz = moved(x, d[:6]), moved(z, d[6:])
        new = residuals(nx, nz)
        if cost(new) <= cost(base):
            x, z, base, damping = nx, nz, new, max(damping / 10, 1e-12)
            if np.abs(d).max() < 1e-10:
                break
        else:
            damping *= 100
            if damping > 1e3:
                break
    return x, z
