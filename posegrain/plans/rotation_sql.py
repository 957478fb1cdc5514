"""Rotations in SQL text, for the queries' checks. A quaternion is a tuple of four expressions x, y, z, w; a vector one of three."""

from __future__ import annotations


def q(prefix: str = "") -> tuple[str, ...]:
    return tuple(f"{prefix}q{c}" for c in "xyzw")


def v(prefix: str = "") -> tuple[str, ...]:
    return tuple(f"{prefix}{c}" for c in "xyz")


def inverse(a: tuple[str, ...]) -> tuple[str, ...]:
    return (f"(-{a[0]})", f"(-{a[1]})", f"(-{a[2]})", a[3])


def multiply(a: tuple[str, ...], b: tuple[str, ...]) -> tuple[str, ...]:
    x, y, z, w = a
    X, Y, Z, W = b
    return (f"({w}*{X} + {x}*{W} + {y}*{Z} - {z}*{Y})", f"({w}*{Y} - {x}*{Z} + {y}*{W} + {z}*{X})", f"({w}*{Z} + {x}*{Y} - {y}*{X} + {z}*{W})", f"({w}*{W} - {x}*{X} - {y}*{Y} - {z}*{Z})")


def matrix(a: tuple[str, ...]) -> list[list[str]]:
    x, y, z, w = a
    return [
        [f"(1 - 2*({y}*{y} + {z}*{z}))", f"(2*({x}*{y} - {z}*{w}))", f"(2*({x}*{z} + {y}*{w}))"],
        [f"(2*({x}*{y} + {z}*{w}))", f"(1 - 2*({x}*{x} + {z}*{z}))", f"(2*({y}*{z} - {x}*{w}))"],
        [f"(2*({x}*{z} - {y}*{w}))", f"(2*({y}*{z} + {x}*{w}))", f"(1 - 2*({x}*{x} + {y}*{y}))"],
    ]


def rotate(a: tuple[str, ...], p: tuple[str, ...]) -> tuple[str, ...]:
    return tuple("(" + " + ".join(f"{m}*{c}" for m, c in zip(row, p)) + ")" for row in matrix(a))


def minus(a: tuple[str, ...], b: tuple[str, ...]) -> tuple[str, ...]:
    return tuple(f"({x} - {y})" for x, y in zip(a, b))


def norm(p: tuple[str, ...]) -> str:
    return "sqrt(" + " + ".join(f"{c}*{c}" for c in p) + ")"


def turn(a: tuple[str, ...]) -> str:
    return f"(2*degrees(atan2({norm(a[:3])}, abs({a[3]}))))"


def named(values: tuple[str, ...], *names: str) -> str:
    return ", ".join(f"{e} AS {n}" for e, n in zip(values, names))


def entries(a: tuple[str, ...], *which: str) -> str:
    m = matrix(a)
    return ", ".join(f"round({m[int(w[1]) - 1][int(w[2]) - 1]} + 1e-9, 5) AS {w}" for w in which)


#: Samples around each query of ``ask`` (session_id, frame, t) among ``mq`` (session_id, t, x … qw): lo, hi and whether lo lies before.
AROUND = """
mq AS (SELECT session_id, t, x, y, z, qx/n AS qx, qy/n AS qy, qz/n AS qz, qw/n AS qw FROM (SELECT *, sqrt(qx*qx + qy*qy + qz*qz + qw*qw) AS n FROM m) WHERE n > 0.5),
so AS (SELECT session_id, t, {'t': t, 'x': x, 'y': y, 'z': z, 'qx': qx, 'qy': qy, 'qz': qz, 'qw': qw} AS o FROM mq),
sn AS (SELECT *, lead(o) OVER (PARTITION BY session_id ORDER BY t, o) AS n FROM so),
un AS (SELECT session_id, t, 1 AS kind, {'o': o, 'n': n} AS s, NULL::BIGINT AS frame FROM sn UNION ALL SELECT session_id, t, 0, NULL, frame FROM ask),
br AS (SELECT session_id, frame, t, kind,
              last_value(s IGNORE NULLS) OVER (PARTITION BY session_id ORDER BY t, kind, s, frame ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l,
              first_value(s IGNORE NULLS) OVER (PARTITION BY session_id ORDER BY t, kind, s, frame ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS r FROM un),
ar AS (SELECT session_id, frame, t, l IS NOT NULL AS inner_, CASE WHEN l IS NOT NULL THEN l.o ELSE r.o END AS lo, CASE WHEN l IS NOT NULL THEN r.o ELSE r.n END AS hi FROM br WHERE kind = 0),
a0 AS (SELECT *, CASE WHEN hi.t > lo.t THEN (t - lo.t) / (hi.t - lo.t) ELSE 0 END AS u, lo.qx*hi.qx + lo.qy*hi.qy + lo.qz*hi.qz + lo.qw*hi.qw AS dot FROM ar),
a1 AS (SELECT *, acos(least(abs(dot), 1)) AS th FROM a0),
a2 AS (SELECT *, CASE WHEN abs(dot) > 0.9995 THEN 1 - u ELSE sin((1 - u)*th) / sin(th) END AS wa, CASE WHEN abs(dot) > 0.9995 THEN u ELSE sin(u*th) / sin(th) END * CASE WHEN dot < 0 THEN -1 ELSE 1 END AS wb FROM a1),
a3 AS (SELECT *, lo.x + u*(hi.x - lo.x) AS x, lo.y + u*(hi.y - lo.y) AS y, lo.z + u*(hi.z - lo.z) AS z, wa*lo.qx + wb*hi.qx AS bx, wa*lo.qy + wb*hi.qy AS by_, wa*lo.qz + wb*hi.qz AS bz, wa*lo.qw + wb*hi.qw AS bw FROM a2),
found AS (SELECT session_id, frame, t, inner_, lo, hi, x, y, z, bx/k AS qx, by_/k AS qy, bz/k AS qz, bw/k AS qw FROM (SELECT *, sqrt(bx*bx + by_*by_ + bz*bz + bw*bw) AS k FROM a3))"""

#: Valid poses (e) with the truth at their time (m), where its samples are at most half a second apart.
PAIRS = f"""
ask AS (SELECT session_id, frame, t FROM vq), {AROUND},
pairs AS (SELECT f.session_id, f.frame, f.t, e.tags, e.source, {named(v("e."), "ex", "ey", "ez")}, {named(q("e."), "eqx", "eqy", "eqz", "eqw")}, {named(v("f."), "mx", "my", "mz")}, {named(q("f."), "mqx", "mqy", "mqz", "mqw")}
          FROM found f JOIN vq e USING (session_id, frame) WHERE f.lo.t <= f.t AND f.t <= f.hi.t AND f.hi.t - f.lo.t <= 0.5)"""


def top_eigenvector(source: str, keys: list[str], entry: str, size: int = 4, steps: int = 40) -> str:
    """CTE text ``pow_``: for each row of ``source`` (keys and the symmetric matrix ``<entry>ij``, i <= j, made positive before) the column
    of its high power that is largest, as ``e0`` …, by repeated squaring."""
    at = lambda i, j: f"{entry}{min(i, j)}{max(i, j)}"
    cells = [(i, j) for i in range(size) for j in range(i, size)]
    trace = " + ".join(at(i, i) for i in range(size))
    squared = ", ".join(f"({' + '.join(f'{at(i, k)}*{at(k, j)}' for k in range(size))}) AS {at(i, j)}" for i, j in cells)
    scaled = ", ".join(f"{at(i, j)} / tr AS {at(i, j)}" for i, j in cells)
    key = ", ".join(keys)
    largest = "greatest(" + ", ".join(at(i, i) for i in range(size)) + ")"
    picked = ", ".join("CASE " + " ".join(f"WHEN {at(k, k)} = {largest} THEN {at(i, k)} / sqrt({' + '.join(f'{at(j, k)}*{at(j, k)}' for j in range(size))})" for k in range(size)) + f" END AS e{i}" for i in range(size))
    return f"""sq_ AS (SELECT {key}, 0 AS step_, {scaled} FROM (SELECT *, {trace} AS tr FROM {source})
  UNION ALL SELECT {key}, step_ + 1, {scaled} FROM (SELECT *, {trace} AS tr FROM (SELECT {key}, step_, {squared} FROM sq_ WHERE step_ < {steps}))),
pow_ AS (SELECT {key}, {picked} FROM sq_ WHERE step_ = {steps})"""
