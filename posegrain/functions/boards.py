"""Boards, views and pinhole cameras as generated tables and expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def board_grid(spark: SparkSession, rows: int, cols: int, pitch: float, by_column: bool = False, tag: float | None = None) -> DataFrame:
    """(id, col, row, cx, cy, corners): tags on a regular grid, numbered row by row or column by column.

    ``corners``: left-top, right-top, right-bottom, left-bottom around the centre, for tags of side ``tag``.
    """
    d = spark.range(rows * cols).withColumnRenamed("id", "_i")
    wide = cols if not by_column else rows
    a, b = F.col("_i") % wide, F.floor(F.col("_i") / wide)
    d = d.select(F.col("_i").alias("id"), (b if by_column else a).alias("col"), (a if by_column else b).alias("row"))
    d = d.withColumn("cx", F.col("col") * pitch).withColumn("cy", F.col("row") * pitch)
    h = (tag or pitch * 0.6) / 2
    corner = lambda sx, sy: F.array(F.col("cx") + sx * h, F.col("cy") + sy * h, F.lit(0.0))
    return d.withColumn("corners", F.array(corner(-1, 1), corner(1, 1), corner(1, -1), corner(-1, -1)))


def view_set(spark: SparkSession, around: int) -> DataFrame:
    """(name, yaw, pitch): ``around`` views about the horizon, one up and one down."""
    step = 360.0 / around
    level = spark.range(around).select(F.format_string("h-%03d", (F.col("id") * step).cast("int")).alias("name"), (F.col("id") * step).alias("yaw"), F.lit(0.0).alias("pitch"))
    poles = spark.createDataFrame([("z-up", 0.0, 85.0), ("z-down", 0.0, -85.0)], "name string, yaw double, pitch double")
    return level.unionByName(poles)


def focal_px(size_px: Column, fov_deg: Column) -> Column:
    """Focal length of a pinhole view ``size_px`` wide."""
    return size_px / (2 * F.tan(fov_deg * (math.pi / 360)))


def panel_layout(spark: SparkSession, first_id: int, side: int, tag_mm: float, gap_mm: float, panel_mm: float) -> DataFrame:
    """(id, row, col, x_mm, y_mm): the centres of ``side`` x ``side`` tags printed on a square panel, from its middle, up being positive."""
    pitch = tag_mm + gap_mm
    margin = (panel_mm - (side * tag_mm + (side - 1) * gap_mm)) / 2
    d = spark.range(side * side).select((F.col("id") + first_id).alias("id"), F.floor(F.col("id") / side).alias("row"), (F.col("id") % side).alias("col"))
    off = lambda c: margin + F.col(c) * pitch + tag_mm / 2 - panel_mm / 2
    return d.select("id", "row", "col", off("col").alias("x_mm"), (-off("row")).alias("y_mm"))


def drawn(x: Column, y: Column, z: Column) -> tuple[Column, Column]:
    """Where a point lies on a drawing plane that shows depth. Its slants."""
    return (x - y) * 0.88, (x + y) * 0.22 - (z - 0.55)
