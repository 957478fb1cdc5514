"""Poses as column expressions: structs ``p`` (vector x, y, z) and ``q`` (unit quaternion x, y, z, w), from a body to a frame."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from posegrain.functions import rotations as rot
from posegrain.functions.rotations import let


def pose(p: Column, q: Column) -> Column:
    return F.struct(p.alias("p"), q.alias("q"))


def from_columns(prefix: str = "") -> Column:
    """The pose in the columns x, y, z, qx, qy, qz, qw, each with ``prefix``."""
    return pose(rot.vector(*(F.col(f"{prefix}{a}") for a in "xyz")), rot.quaternion(*(F.col(f"{prefix}q{c}") for c in "xyzw")))


def difference(a: Column, b: Column) -> Column:
    """Vector ``a`` less ``b``."""
    return rot.vector(*(a[c] - b[c] for c in "xyz"))


def added(a: Column, b: Column) -> Column:
    return rot.vector(*(a[c] + b[c] for c in "xyz"))


def compose(a: Column, b: Column) -> Column:
    """First ``b``, then ``a``."""
    return let(F.struct(a.alias("a"), b.alias("b")), lambda v: pose(added(v["a"]["p"], rot.rotate(v["a"]["q"], v["b"]["p"])), rot.multiply(v["a"]["q"], v["b"]["q"])))


def invert(a: Column) -> Column:
    return let(a, lambda v: pose(rot.rotate(rot.inverse(v["q"]), rot.vector(*(-v["p"][c] for c in "xyz"))), rot.inverse(v["q"])))


def relative(a: Column, b: Column) -> Column:
    """``b`` as seen from ``a``: the inverse of ``a``, then ``b``."""
    return let(F.struct(a.alias("a"), b.alias("b")), lambda v: pose(rot.rotate(rot.inverse(v["a"]["q"]), difference(v["b"]["p"], v["a"]["p"])), rot.multiply(rot.inverse(v["a"]["q"]), v["b"]["q"])))


def length(v: Column) -> Column:
    return F.sqrt(sum(v[c] * v[c] for c in "xyz"))


def turn_deg(q: Column) -> Column:
    """How far a rotation turns."""
    from posegrain.functions.angles import DEGREES

    return 2 * DEGREES * F.atan2(F.sqrt(q["x"] * q["x"] + q["y"] * q["y"] + q["z"] * q["z"]), F.abs(q["w"]))


def relative_error(true_a: Column, true_b: Column, found_a: Column, found_b: Column) -> Column:
    """The error of a found movement from a to b against the true one, a pose."""
    return relative(relative(true_a, true_b), relative(found_a, found_b))


def entries(q: Column, *which: str) -> list[Column]:
    """Entries of the rotation matrix such as ``r12``, which do not depend on the quaternion's sign, rounded to five places."""
    m = rot.to_matrix(q)
    return [F.round(m[int(w[1]) - 1][int(w[2]) - 1] + 1e-9, 5).alias(w) for w in which]


def at_time(time: Column) -> Column:
    """The pose at ``time`` between the samples ``lo`` and ``hi`` (structs t, x … qw) of an as-of join: straight and along the shorter arc."""
    from posegrain.operators import asof

    part = lambda s: rot.quaternion(*(F.col(f"{s}.q{c}") for c in "xyzw"))
    return pose(rot.vector(*(asof.linear(time, a) for a in "xyz")), rot.slerp(part("lo"), part("hi"), asof.share(time)))


def clamped_at_time(time: Column) -> Column:
    """``at_time``, with the first and last pose outside the samples."""
    whole = lambda s: pose(rot.vector(*(F.col(f"{s}.{a}") for a in "xyz")), rot.quaternion(*(F.col(f"{s}.q{c}") for c in "xyzw")))
    last = F.when(F.col("hi").isNull(), whole("lo")).otherwise(whole("hi"))
    return F.when(F.col("hi").isNull() | (F.col("hi.t") < time), last).when(time <= F.col("lo.t"), whole("lo")).otherwise(at_time(time))
