"""Rotations as column expressions. Quaternions are structs (x, y, z, w); vectors are structs (x, y, z).

Euler angles are extrinsic xyz in degrees, R = Rz·Ry·Rx. The sign of a quaternion means nothing; compare
rotations by their angle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from posegrain.functions.angles import DEGREES, RADIANS


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once; expressions are trees, so repeated use would repeat it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def vector(x: Column, y: Column, z: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"), z.alias("z"))


def quaternion(x: Column, y: Column, z: Column, w: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"), z.alias("z"), w.alias("w"))


def normalised(q: Column) -> Column:
    """Unit length; NULL where it is too short to be a rotation."""
    def scaled(v: Column) -> Column:
        n = F.sqrt(sum(v[c] * v[c] for c in "xyzw"))
        return F.when(n > 1e-12, quaternion(*(v[c] / n for c in "xyzw")))

    return let(q, scaled)


def from_euler(roll: Column, pitch: Column, yaw: Column) -> Column:
    a, b, c = (v * (RADIANS / 2) for v in (roll, pitch, yaw))
    sa, ca, sb, cb, sc, cc = F.sin(a), F.cos(a), F.sin(b), F.cos(b), F.sin(c), F.cos(c)
    return quaternion(sa * cb * cc - ca * sb * sc, ca * sb * cc + sa * cb * sc, ca * cb * sc - sa * sb * cc, ca * cb * cc + sa * sb * sc)


def multiply(a: Column, b: Column) -> Column:
    """First ``b``, then ``a``."""
    return quaternion(
        a["w"] * b["x"] + a["x"] * b["w"] + a["y"] * b["z"] - a["z"] * b["y"],
        a["w"] * b["y"] - a["x"] * b["z"] + a["y"] * b["w"] + a["z"] * b["x"],
        a["w"] * b["z"] + a["x"] * b["y"] - a["y"] * b["x"] + a["z"] * b["w"],
        a["w"] * b["w"] - a["x"] * b["x"] - a["y"] * b["y"] - a["z"] * b["z"],
    )


def inverse(q: Column) -> Column:
    return quaternion(-q["x"], -q["y"], -q["z"], q["w"])


def rotate(q: Column, v: Column) -> Column:
    tx = 2 * (q["y"] * v["z"] - q["z"] * v["y"])
    ty = 2 * (q["z"] * v["x"] - q["x"] * v["z"])
    tz = 2 * (q["x"] * v["y"] - q["y"] * v["x"])
    return vector(
        v["x"] + q["w"] * tx + q["y"] * tz - q["z"] * ty,
        v["y"] + q["w"] * ty + q["z"] * tx - q["x"] * tz,
        v["z"] + q["w"] * tz + q["x"] * ty - q["y"] * tx,
    )


def angle_deg(a: Column, b: Column) -> Column:
    """The angle between two rotations, by the arc tangent, which is safe at 0 and 180 degrees."""
    return let(multiply(inverse(a), b), lambda d: 2 * DEGREES * F.atan2(F.sqrt(d["x"] * d["x"] + d["y"] * d["y"] + d["z"] * d["z"]), F.abs(d["w"])))


def to_matrix(q: Column) -> list[list[Column]]:
    x, y, z, w = (q[c] for c in "xyzw")
    return [
        [1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)],
        [2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)],
        [2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)],
    ]


def to_euler(q: Column) -> tuple[Column, Column, Column]:
    """(roll, pitch, yaw) in degrees; near pitch ±90 the yaw is 0 and the roll takes the rest."""
    m = to_matrix(q)
    size = F.sqrt(m[0][0] * m[0][0] + m[1][0] * m[1][0])
    near = size < 1e-8
    roll = F.when(near, F.atan2(-m[1][2], m[1][1])).otherwise(F.atan2(m[2][1], m[2][2]))
    yaw = F.when(near, F.lit(0.0)).otherwise(F.atan2(m[1][0], m[0][0]))
    return roll * DEGREES, F.atan2(-m[2][0], size) * DEGREES, yaw * DEGREES


def slerp(a: Column, b: Column, u: Column) -> Column:
    """Between ``a`` (u = 0) and ``b`` (u = 1) along the shorter arc; straight where they nearly agree."""
    def weights(v: Column) -> Column:
        d = F.least(F.abs(v["dot"]), F.lit(1.0))
        theta, near = F.acos(d), d > 0.9995
        wa = F.when(near, 1 - v["u"]).otherwise(F.sin((1 - v["u"]) * theta) / F.sin(theta))
        wb = F.when(near, v["u"]).otherwise(F.sin(v["u"] * theta) / F.sin(theta))
        return F.struct(wa.alias("a"), (wb * F.when(v["dot"] < 0, -1.0).otherwise(1.0)).alias("b"))

    w = let(F.struct(sum(a[c] * b[c] for c in "xyzw").alias("dot"), u.alias("u")), weights)
    return normalised(let(w, lambda v: quaternion(*(v["a"] * a[c] + v["b"] * b[c] for c in "xyzw"))))


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(sum((a[c] - b[c]) * (a[c] - b[c]) for c in "xyz"))
