"""The recursive filters, robust limits and fits in SQL text, for the queries' checks."""

from __future__ import annotations

from posegrain.plans import rotation_sql as rs


def kalman(source: str, discrete: bool = False) -> str:
    """CTE text ``smooth_`` (g, n, axis, out): constant-velocity filter and backward smoother of ``source`` (g, n from 1, t, axis, z, r, q, v0), where z may be NULL but at n = 1.

    ``r`` and ``q`` are the variances of a measurement and of the acceleration, ``v0`` that of the first rate.
    """
    qa, qb, qc = ("dt*dt*dt*dt/4", "dt*dt*dt/2", "dt*dt") if discrete else ("dt*dt*dt/3", "dt*dt/2", "dt")
    return f"""
fwd_ AS (SELECT g, axis, n, t, z AS x, 0.0::DOUBLE AS v, r * (1 - r/(r + r)) AS a, 0.0::DOUBLE AS b, v0 AS c, z AS px, 0.0::DOUBLE AS pv, r AS pa, 0.0::DOUBLE AS pb, v0 AS pc, 0.0::DOUBLE AS dt FROM {source} WHERE n = 1
  UNION ALL
  SELECT g, axis, n, t, px + k*off AS x, pv + h*off AS v, (1 - k)*pa AS a, (1 - k)*pb AS b, pc - h*pb AS c, px, pv, pa, pb, pc, dt FROM (
    SELECT *, CASE WHEN z IS NULL THEN 0 ELSE pa/(pa + r) END AS k, CASE WHEN z IS NULL THEN 0 ELSE pb/(pa + r) END AS h, coalesce(z - px, 0) AS off FROM (
      SELECT g, axis, n, t, z, r, dt, x + v*dt AS px, v AS pv, a + 2*dt*b + dt*dt*c + q*({qa}) AS pa, b + dt*c + q*({qb}) AS pb, c + q*({qc}) AS pc FROM (
        SELECT o.g, o.axis, o.n, o.t, o.z, o.r, o.q, o.t - f.t AS dt, f.x, f.v, f.a, f.b, f.c FROM fwd_ f JOIN {source} o ON o.g = f.g AND o.axis = f.axis AND o.n = f.n + 1)))),
pass_ AS MATERIALIZED (SELECT * FROM fwd_),
back_ AS (SELECT g, axis, n, x AS out_, v AS rate_, px, pv, pa, pb, pc, dt FROM pass_ p WHERE n = (SELECT max(n) FROM pass_ m WHERE m.g = p.g AND m.axis = p.axis)
  UNION ALL
  SELECT f.g, f.axis, f.n,
         CASE WHEN det > 0 THEN f.x + ((u*d.pc - f.b*d.pb)*dx + (f.b*d.pa - u*d.pb)*dv)/det ELSE f.x END, CASE WHEN det > 0 THEN f.v + ((w*d.pc - f.c*d.pb)*dx + (f.c*d.pa - w*d.pb)*dv)/det ELSE f.v END, f.px, f.pv, f.pa, f.pb, f.pc, f.dt
  FROM (SELECT *, pa*pc - pb*pb AS det, out_ - px AS dx, rate_ - pv AS dv FROM back_) d JOIN pass_ f ON f.g = d.g AND f.axis = d.axis AND f.n = d.n - 1, LATERAL (SELECT f.a + d.dt*f.b AS u, f.b + d.dt*f.c AS w) l),
smooth_ AS (SELECT g, axis, n, out_ FROM back_)"""


def robust_limits(source: str, keys: str, value: str, floor: float, rounds: int = 5, least: int = 10) -> str:
    """CTE text ``kept_``: rows of ``source`` with ``inlier`` after ``rounds`` refits of median + 4·1.4826·deviation; groups under ``least`` inliers stay as they are."""
    text = f"k0_ AS (SELECT *, true AS inlier FROM {source})"
    for i in range(rounds):
        text += f""",
m{i}_ AS (SELECT {keys}, count(*) AS n_, quantile_cont({value}, 0.5) AS med_ FROM k{i}_ WHERE inlier GROUP BY {keys}),
d{i}_ AS (SELECT {keys}, max(n_) AS n_, max(med_) + greatest(4 * 1.4826 * quantile_cont(abs({value} - med_), 0.5), {floor}) AS limit_ FROM k{i}_ JOIN m{i}_ USING ({keys}) WHERE inlier GROUP BY {keys}),
k{i + 1}_ AS (SELECT k.* EXCLUDE (inlier), CASE WHEN n_ >= {least} THEN {value} <= limit_ ELSE inlier END AS inlier FROM k{i}_ k JOIN d{i}_ USING ({keys}))"""
    return text + f", kept_ AS (SELECT * FROM k{rounds}_)"


def rigid(source: str, keys: str) -> str:
    """CTE text ``rigid_`` (keys, n, r11 … r33, t1 … t3): the rotation and translation of the points x, y, z onto mx, my, mz, by the quaternion
    form: the largest eigenvector of a 4 x 4 matrix of cross products."""
    s = lambda a, b: f"s{a}{b}"
    sums = ", ".join(f"covar_pop({a}, m{b}) AS s{a}{b}" for a in "xyz" for b in "xyz")
    n = [
        [f"{s('x', 'x')}+{s('y', 'y')}+{s('z', 'z')}", f"{s('y', 'z')}-{s('z', 'y')}", f"{s('z', 'x')}-{s('x', 'z')}", f"{s('x', 'y')}-{s('y', 'x')}"],
        ["", f"{s('x', 'x')}-{s('y', 'y')}-{s('z', 'z')}", f"{s('x', 'y')}+{s('y', 'x')}", f"{s('z', 'x')}+{s('x', 'z')}"],
        ["", "", f"-{s('x', 'x')}+{s('y', 'y')}-{s('z', 'z')}", f"{s('y', 'z')}+{s('z', 'y')}"],
        ["", "", "", f"-{s('x', 'x')}-{s('y', 'y')}+{s('z', 'z')}"],
    ]
    size = "sqrt(" + "+".join(f"s{a}{b}*s{a}{b}" for a in "xyz" for b in "xyz") + ")"
    cells = ", ".join(f"({n[i][j]}){f' + 2 * {size} + 1e-12' if i == j else ''} AS h{i}{j}" for i in range(4) for j in range(i, 4))
    m = rs.matrix(("e1", "e2", "e3", "e0"))
    entries = ", ".join(f"{m[i][j]} AS r{i + 1}{j + 1}" for i in range(3) for j in range(3))
    moved = ", ".join(f"b{a} - (r{i}1*ax + r{i}2*ay + r{i}3*az) AS t{i}" for i, a in enumerate("xyz", 1))
    return f"""
sum_ AS (SELECT {keys}, count(*) AS n, avg(x) AS ax, avg(y) AS ay, avg(z) AS az, avg(mx) AS bx, avg(my) AS by_, avg(mz) AS bz, {sums} FROM {source} GROUP BY {keys} HAVING count(*) >= 3),
horn_ AS (SELECT {keys}, {cells} FROM sum_), {rs.top_eigenvector('horn_', [keys], 'h')},
rot_ AS (SELECT {keys}, n, ax, ay, az, bx, by_, bz, {entries} FROM pow_ JOIN sum_ USING ({keys})),
rigid_ AS (SELECT {keys}, n, r11, r12, r13, r21, r22, r23, r31, r32, r33, {moved.replace('by -', 'by_ -')} FROM rot_)"""


def despiked(source: str, limit: float = 0.12, width: int = 9, degree: int = 2) -> str:
    """CTE text ``flat_`` (g, n, out_): of ``source`` (g, n from 1, x) first readings farther than ``limit`` from the median of five (zeros beyond the ends) take it, then
    each takes its value of the parabola through the ``width`` around it, or through those at the end."""
    import numpy as np

    cells = []
    for w in range(3, width + 1, 2):
        at = np.vander(np.arange(w) - w // 2, degree + 1, increasing=True).astype(float)
        h = at @ np.linalg.pinv(at)
        cells += [f"({w},{r},{j},{float(h[r, j])!r})" for r in range(w) for j in range(w)]
    five = ", ".join(f"coalesce(lag(x, {k}) OVER w, 0)" if k > 0 else f"coalesce(lead(x, {-k}) OVER w, 0)" if k < 0 else "x" for k in range(-2, 3))
    return f"""
hat_ AS (SELECT * FROM (VALUES {', '.join(cells)}) AS t(w, r, j, h)),
five_ AS (SELECT g, n, x, list_sort([{five}])[3] AS med, count(*) OVER (PARTITION BY g) AS m FROM {source} WINDOW w AS (PARTITION BY g ORDER BY n)),
calm_ AS (SELECT g, n, m, CASE WHEN m >= 3 AND abs(x - med) > {limit} THEN med ELSE x END AS y, least({width}, CASE WHEN m % 2 = 1 THEN m ELSE m - 1 END) AS w FROM five_),
seat_ AS (SELECT *, greatest(1, least(n - w // 2, m - w + 1)) AS a FROM calm_),
flat_ AS (SELECT s.g, s.n, sum(h * c.y) AS out_ FROM seat_ s JOIN hat_ k ON k.w = s.w AND k.r = s.n - s.a JOIN calm_ c ON c.g = s.g AND c.n = s.a + k.j WHERE s.w > {degree} GROUP BY s.g, s.n UNION ALL SELECT g, n, y FROM calm_ WHERE w <= {degree})"""
