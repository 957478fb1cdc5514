"""Views into a panorama and the cameras that make them, as column expressions.

A view looks along z, with x to the right and y down; positive yaw looks right, positive pitch up.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from posegrain.functions import poses
from posegrain.functions import rotations as rot
from posegrain.functions.angles import DEGREES, RADIANS, clip, wrap
from posegrain.functions.boards import focal_px

# The turn from a body's axes to the panorama's, as a quaternion x, y, z, w (the sign of its matrix cancels out), and the limits of a view.
BODY_TO_PANORAMA = (-0.5, 0.5, -0.5, 0.5)
MOST_PITCH, LEAST_FOV, MOST_FOV, FOV_MARGIN = 85.0, 70.0, 100.0, 1.8
# Names by which cameras are told, in the order tried.
DJI_SUFFIX, INSTA_SUFFIX, INSTA_WORDS, DJI_WORDS = (".osv",), (".insv", ".lrv"), ("insta",), ("dji", "osmo")


def view_rotation(yaw: Column, pitch: Column, roll: Column) -> Column:
    """From a view's axes to the panorama's: roll about z, then pitch about x, then yaw about y."""
    a, b, c = (v * (RADIANS / 2) for v in (yaw, pitch, roll))
    zero = F.lit(0.0)
    about_y, about_x, about_z = rot.quaternion(zero, F.sin(a), zero, F.cos(a)), rot.quaternion(F.sin(b), zero, zero, F.cos(b)), rot.quaternion(zero, zero, F.sin(c), F.cos(c))
    return rot.multiply(rot.multiply(about_y, about_x), about_z)


def view_angles(q: Column) -> Column:
    """(yaw, pitch, roll) of a view's rotation, wrapped, the pitch held within its limit."""
    def angles(v: Column) -> Column:
        m = rot.to_matrix(v)
        pitch = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), -m[1][2]))) * DEGREES
        return F.struct(wrap(F.atan2(m[0][2], m[2][2]) * DEGREES).alias("yaw"), clip(pitch, -MOST_PITCH, MOST_PITCH).alias("pitch"), wrap(F.atan2(m[1][0], m[1][1]) * DEGREES).alias("roll"))

    return rot.let(q, angles)


def propagated_view(yaw: Column, pitch: Column, roll: Column, before: Column, now: Column) -> Column:
    """Where a view must look to keep looking at the same part of the world after its body turned from ``before`` to ``now``."""
    b = rot.quaternion(*(F.lit(v) for v in BODY_TO_PANORAMA))
    turned = rot.let(rot.multiply(rot.inverse(now), before), lambda d: rot.multiply(rot.multiply(b, d), rot.inverse(b)))
    return view_angles(rot.let(turned, lambda d: rot.multiply(d, view_rotation(yaw, pitch, roll))))


def camera_in_board(board_to_view: Column, view: Column) -> Column:
    """The camera's pose in the board's frame, from the board's pose in a view (pose) and the view's rotation (quaternion)."""
    return poses.invert(poses.compose(poses.pose(rot.vector(F.lit(0.0), F.lit(0.0), F.lit(0.0)), view), board_to_view))


def recentred_view(yaw: Column, pitch: Column, fov: Column, size: Column, mean_x: Column, mean_y: Column, span: Column) -> Column:
    """(yaw, pitch, fov) of a view moved onto detections, from the mean of their centres and their larger extent in pixels."""
    focal = focal_px(size, fov)
    wide = 2 * F.atan2(span / 2, focal) * DEGREES * FOV_MARGIN
    return F.struct(wrap(yaw + F.atan2(mean_x - size / 2, focal) * DEGREES).alias("yaw"), clip(pitch - F.atan2(mean_y - size / 2, focal) * DEGREES, -MOST_PITCH, MOST_PITCH).alias("pitch"), clip(wide, LEAST_FOV, MOST_FOV).alias("fov"))


def _ends(name: Column, suffixes: tuple[str, ...]) -> Column:
    return F.array_contains(F.array(*[F.endswith(name, F.lit(s)) for s in suffixes]), True)


def _holds(text: Column, words: tuple[str, ...]) -> Column:
    return F.array_contains(F.array(*[F.contains(text, F.lit(w)) for w in words]), True)


def camera_class(name: Column, text: Column, widths: Column, heights: Column, override: Column | None = None) -> Column:
    """The class of a recording, by the first rule that holds: what was asked for, its suffix, words in its metadata or name,
    two square videos, one twice as wide as high. ``widths`` and ``heights``: arrays over its videos; NULLs hold no rule."""
    low = F.lower(F.coalesce(name, F.lit("")))
    both = F.concat_ws(" ", F.lower(F.coalesce(text, F.lit(""))), low)
    at = lambda c, i: F.get(c, F.lit(i))
    square = (F.size(widths) >= 2) & (at(widths, 0) == at(heights, 0)) & (at(widths, 1) == at(heights, 1))
    wide = (at(heights, 0) > 0) & (at(widths, 0) == 2 * at(heights, 0))
    asked = F.coalesce(override, F.lit("auto")) if override is not None else F.lit("auto")
    return (
        F.when(asked != "auto", asked).when(_ends(low, DJI_SUFFIX), "dji").when(_ends(low, INSTA_SUFFIX), "insta360").when(_holds(both, INSTA_WORDS), "insta360").when(_holds(both, DJI_WORDS), "dji")
        .when(F.coalesce(square, F.lit(False)), "dji").when(F.coalesce(wide, F.lit(False)), "panorama").otherwise("unknown")
    )


def camera_model(name: Column, width: Column, height: Column) -> Column:
    """The processing profile of an export, by name before size."""
    low = F.lower(name)
    return (
        F.when(F.contains(low, F.lit("insta360")) | F.contains(low, F.lit("_no_flowstate")) | (F.startswith(low, F.lit("vid_")) & (width >= 6000)), "insta360-x6")
        .when(F.contains(low, F.lit("osmo")) | F.startswith(low, F.lit("cam_")) | _ends(low, DJI_SUFFIX), "dji-osmo-360")
        .when((width >= 7000) & (width == 2 * height), "insta360-x6").when((width <= 4096) & (width == 2 * height), "dji-osmo-360").otherwise("generic")
    )


def decoder(requested: Column) -> Column:
    """What decodes: what was asked for, else the processor, for every known model."""
    return F.when(requested != "auto", requested).otherwise("cpu")


def projection(requested: Column, model: Column, width: Column) -> Column:
    """What projects: what was asked for; the processor for the narrow model, else the graphics card."""
    return F.when(requested != "auto", requested).when((model == "dji-osmo-360") & (width <= 4096), "cpu").otherwise("cuda")
