"""Copies of a row counted once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_first_copy(df: DataFrame, keys: list[str], rank: str, carry: list[str]) -> DataFrame:
    """One row per ``keys``: that of the smallest ``rank``, with the columns ``carry``.

    A partial minimum before the shuffle, so many copies of one row never meet in one task. Each carried
    column is an aggregate of its own, so those a query does not use are neither read nor shuffled. NULL keys are
    values like others; a NULL ``rank`` counts as no row; rows of one rank must be equal in ``carry``.
    """
    return df.groupBy(*keys).agg(F.min(rank).alias(rank), *[F.min_by(c, rank).alias(c) for c in carry])


def largest_detections(detections: DataFrame) -> DataFrame:
    """Of tags seen twice in one view the larger, the first on a tie: (frame, view, id, corners_px, area_px).

    ``detections`` is the nested log (``read_detections``): frame and views, each with its detections. The area is that of the four corners; a
    detection without four is none.
    """
    d = detections.select("frame", F.explode("views").alias("v")).select("frame", F.col("v.view.name").alias("view"), F.posexplode("v.detections").alias("at", "d"))
    d = d.select("frame", "view", "at", "d.id", "d.corners_px").filter(F.size("corners_px") == 4)
    x, y = (lambda i: F.get(F.get("corners_px", F.lit(i % 4)), F.lit(0))), (lambda i: F.get(F.get("corners_px", F.lit(i % 4)), F.lit(1)))
    area = F.abs(sum(x(i) * y(i + 1) - x(i + 1) * y(i) for i in range(4))) / 2
    d = d.withColumn("area_px", area)
    best = F.max_by(F.struct("corners_px", "area_px"), F.struct("area_px", -F.col("at"))).alias("b")
    return d.groupBy("frame", "view", "id").agg(best).select("frame", "view", "id", "b.corners_px", "b.area_px")
