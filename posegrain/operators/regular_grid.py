"""Irregular readings onto a regular grid by compact-kernel local polynomial regression.

Readings are shuffled once, to (source, block of time); those near a block's edge go to both blocks. There each one is sent to
the few grid times its kernel reaches, where the five moments of the weighted line fit are summed. No task ever holds
a source: one with a third of all rows spreads over its blocks. Which grid times a source covers follows from the first and
last time of its blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from posegrain.session import cut_lineage_in_place


def covered_steps(spans: DataFrame, step_s: float, pause_s: float | None) -> DataFrame:
    """(source, step): each grid step from a source's first row to its last, once; ``spans``: source, ``_from``, ``_to`` of stretches of at most ``pause_s``, in which no pause fits.

    Where two successive rows lie more than ``pause_s`` apart, the steps strictly between theirs are left
    out (None: kept). Only the stretches are put in order.
    """
    following = F.lead("_from").over(Window.partitionBy("source").orderBy("_from"))
    first, last, after = (F.floor(F.col(c) / step_s) for c in ("_from", "_to", "_next"))
    spans = spans.withColumn("_next", following)
    # One reading of the two on either side of a pause ends, the other begins a span; else the next stretch has the step both share.
    paused = F.col("_next").isNull() if pause_s is None else F.col("_next").isNull() | (F.col("_next") - F.col("_to") > pause_s)
    spans = spans.withColumns({"_a": first, "_b": F.when(paused & (after.isNull() | (after > last)), last).otherwise(after - 1)}).filter(F.col("_b") >= F.col("_a"))
    return spans.select("source", F.explode(F.sequence("_a", "_b")).alias("step"))


def regular_grid(
    readings: DataFrame, source: str, time: str, value: Column, usable: Column, step_s: float = 1.0, half_width_s: float = 2.5, pause_s: float | None = 600.0, min_support: float = 1.5, step_name: str = "step_no"
) -> DataFrame:
    """One row per source and grid step: the locally fitted value, its support, and how it came about.

    Columns: ``source``, ``step_no`` (long; the step covers ``[n, n+1) * step_s``, its value stands for the
    middle), ``value`` (double), ``n_inside`` (usable readings within the step), ``support`` (effective
    number of readings the fit rests on, Σw² form) and ``state``:

    * ``observed``: a usable reading lies within the step;
    * ``filled``: none does, but those within ``half_width_s`` have an effective number of ``min_support``
      or more and lie on both sides; the value is the fit;
    * ``missing``: neither; ``value`` is NULL.

    ``usable`` says which rows are readings; all rows with a time span the grid. NULL and NaN values are no
    readings and rows without a time take no part. NULL sources form one source. Ties in time and repeated
    rows all count. The kernel is (1-u²)³; a fit whose readings share one time falls back on their mean.
    """
    rows = readings.select(F.col(source), F.col(time).cast("double").alias("_t"), value.cast("double").alias("_y"), usable.alias("_ok"))
    # Step numbers are longs; times beyond them, infinite ones too, are none.
    rows = rows.filter(F.col("_t").isNotNull() & ~F.isnan("_t") & (F.abs("_t") < 9e18 * step_s))
    reads = F.coalesce(F.col("_ok"), F.lit(False)) & F.col("_y").isNotNull() & ~F.isnan("_y")
    reach, width = int(half_width_s // step_s), pause_s or 3600.0
    block = lambda step: F.floor(step * step_s / width)
    own = F.floor(F.col("_t") / step_s)
    to = F.when(reads, F.sequence(block(own - reach), block(own + reach))).otherwise(F.array(block(own)))
    rows = rows.select(F.col(source).alias("source"), "_t", F.when(reads, F.col("_y")).alias("_y"), reads.alias("_reads"), F.explode(to).alias("_block"))
    rows = rows.select(F.struct("source", "_block").alias("_g"), "_t", "_y", "_reads")
    rows = cut_lineage_in_place(rows.repartition("_g"))

    # A row whose own step is in the block stands for the block's cover; the time's own stretch may begin a little later than the step's.
    mine = rows.filter(block(own) == F.col("_g._block"))
    spans = mine.groupBy("_g", F.floor(F.col("_t") / width).alias("_part")).agg(F.min("_t").alias("_from"), F.max("_t").alias("_to")).select(F.col("_g.source").alias("source"), "_from", "_to")
    grid = covered_steps(spans, step_s, pause_s).select(F.struct("source", block(F.col("step")).alias("_block")).alias("_g"), "step")

    ahead = F.explode(F.array(*[F.lit(k) for k in range(-reach, reach + 1)])).alias("_k")
    near = rows.filter("_reads").select("_g", "_t", "_y", own.alias("_own"), ahead).withColumn("step", F.col("_own") + F.col("_k")).filter(block(F.col("step")) == F.col("_g._block"))
    d = F.col("_t") - (F.col("step") + 0.5) * step_s
    near = near.withColumn("_d", d).withColumn("_u", F.lit(1.0) - (F.col("_d") / half_width_s) * (F.col("_d") / half_width_s))
    near = near.withColumn("_w", F.when(F.col("_u") > 0, F.col("_u") * F.col("_u") * F.col("_u")).otherwise(0.0))
    W, D, Y = F.col("_w"), F.col("_d"), F.col("_y")
    weighs = F.col("_w") > 0
    sums = near.groupBy("_g", "step").agg(
        F.sum((F.col("_k") == 0).cast("long")).alias("inside"), F.sum((weighs & (D < 0)).cast("long")).alias("left"), F.sum((weighs & (D >= 0)).cast("long")).alias("right"),
        F.sum(W).alias("w"), F.sum(W * D).alias("wd"), F.sum(W * D * D).alias("wdd"), F.sum(W * Y).alias("wy"), F.sum(W * D * Y).alias("wdy"), F.sum(W * W).alias("ww"),
    )
    out = grid.join(sums, ["_g", "step"], "left")
    spread = F.col("w") * F.col("wdd") - F.col("wd") * F.col("wd")
    line = (F.col("wdd") * F.col("wy") - F.col("wd") * F.col("wdy")) / spread
    fit = F.when(spread > 1e-9 * F.col("w") * F.col("w") * (half_width_s**2), line).otherwise(F.col("wy") / F.col("w"))
    support = F.when(F.col("ww") > 0, F.col("w") * F.col("w") / F.col("ww")).otherwise(0.0)
    state = F.when(F.col("inside") > 0, "observed").when((support >= min_support) & (F.col("left") > 0) & (F.col("right") > 0), "filled").otherwise("missing")
    out = out.withColumn("state", state)
    return out.select(F.col("_g.source").alias(source), F.col("step").cast("long").alias(step_name), F.when(F.col("state") != "missing", fit).alias("value"), F.coalesce("inside", F.lit(0)).alias("n_inside"), support.alias("support"), "state")
