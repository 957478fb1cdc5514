"""Operators on trajectories: labels, losses, quarantine, resampling, motion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posegrain.functions.angles import clip, smoothstep, wrap
from posegrain.operators.aggregates import join_null_safe, percentiles
from posegrain.operators.asof import bracket, bracket_self
from posegrain.operators.ordered import gap_segments, islands, neighbours, scan


def moved(axes: list[str], other: str = "prev") -> Column:
    """Distance from the row in the struct column ``other``."""
    return F.sqrt(sum((F.col(a) - F.col(f"{other}.{a}")) * (F.col(a) - F.col(f"{other}.{a}")) for a in axes))


def path_lengths(df: DataFrame, keys: list[str], order: list[str], axes: list[str]) -> DataFrame:
    """(``keys``, n, path_m, drift_m, drift_percent): way from row to row, distance of the ends, and their ratio (0 where nothing moved)."""
    d = neighbours(df, keys, order, axes).withColumn("_d", moved(axes))
    place = F.struct(*order)
    g = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("_d"), F.lit(0.0)).alias("path_m"), *[F.min_by(a, place).alias(f"f_{a}") for a in axes], *[F.max_by(a, place).alias(f"l_{a}") for a in axes])
    g = g.withColumn("drift_m", F.sqrt(sum((F.col(f"l_{a}") - F.col(f"f_{a}")) * (F.col(f"l_{a}") - F.col(f"f_{a}")) for a in axes)))
    return g.select(*keys, "n", "path_m", "drift_m", F.when(F.col("path_m") > 0, 100 * F.col("drift_m") / F.col("path_m")).otherwise(0.0).alias("drift_percent"))


def nominal_step(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """(``keys``, n, median_dt): the exact median of the times between successive rows."""
    t = order[0]
    d = neighbours(df, keys, order, [t]).withColumn("_dt", F.col(t) - F.col(f"prev.{t}"))
    return percentiles(d, keys, "_dt", {"median_dt": 0.5})


def state_runs(df: DataFrame, keys: list[str], order: list[str], state: Column) -> DataFrame:
    """(``keys``, island, state, n_rows, start_s, end_s, next_start_s): runs of one state; the last has no next."""
    t = order[0]
    d = islands(df, keys, order, state)
    runs = d.groupBy(*keys, "island").agg(F.first("state", ignorenulls=True).alias("state"), F.count(F.lit(1)).alias("n_rows"), F.min(t).alias("start_s"), F.max(t).alias("end_s"))
    # The next run's start, by its number: an equi-join instead of a window over a source's runs.
    after = runs.select(*keys, (F.col("island") - 1).alias("island"), F.col("start_s").alias("next_start_s"))
    return join_null_safe(runs, after, [*keys, "island"], "left")


def loss_events(df: DataFrame, keys: list[str], order: list[str], valid: Column) -> DataFrame:
    """(``keys``, start_s, recovered_s, duration_s): from a loss's first row to the next valid one; a loss never ended is left out."""
    runs = state_runs(df, keys, order, valid)
    return runs.filter(~F.col("state") & F.col("next_start_s").isNotNull()).select(*keys, "start_s", F.col("next_start_s").alias("recovered_s"), (F.col("next_start_s") - F.col("start_s")).alias("duration_s"))


def visual_audit(df: DataFrame, keys: list[str], order: list[str], valid: Column) -> DataFrame:
    """Per source: rows, valid ratio, number of losses and the longest, one before the first valid row apart.

    A loss lasts from its first to its last row plus the median step, also where it never ends.
    """
    runs = state_runs(df, keys, order, valid)
    dt = nominal_step(df, keys, order).drop("n")
    runs = join_null_safe(runs, dt, keys, "left").withColumn("_long", F.col("end_s") - F.col("start_s") + F.coalesce(F.col("median_dt"), F.lit(0.0)))
    lost, after_lock = ~F.col("state"), ~F.col("state") & (F.col("island") > 1)
    return runs.groupBy(*keys).agg(
        F.sum("n_rows").alias("n_rows"),
        (F.sum(F.when(F.col("state"), F.col("n_rows")).otherwise(0)) / F.sum("n_rows")).alias("valid_ratio"),
        F.sum(lost.cast("long")).alias("n_losses"),
        F.coalesce(F.max(F.when(lost, F.col("_long"))), F.lit(0.0)).alias("longest_loss_s"),
        F.sum(after_lock.cast("long")).alias("n_losses_after_lock"),
        F.coalesce(F.max(F.when(after_lock, F.col("_long"))), F.lit(0.0)).alias("longest_after_lock_s"),
    )


def swap_quarantine(df: DataFrame, keys: list[str], order: list[str], axes: list[str], speed: float = 10.0, step_s: float = 0.1, longest_s: float = 10.0) -> DataFrame:
    """Adds ``quarantined``: rows between the first and second, third and fourth … impossible jump of a source.

    A jump: more than ``speed`` over a step of at most ``step_s`` between valid rows. A pair more than ``longest_s`` apart, or
    with a single row between, quarantines nothing; a jump without partner neither.
    """
    t = order[0]

    def leap(before: Column, row: Column) -> Column:
        dt = row[t] - before[t]
        way = F.sqrt(sum((row[a] - before[a]) * (row[a] - before[a]) for a in axes))
        return F.coalesce((dt > 0) & (dt <= step_s) & (way > speed * dt), F.lit(False))

    # Each jump begins a stretch: rows of stretch k + 1 come after k jumps.
    d = scan(df, keys, order, [t, *axes], leap, "_k", prev=True).withColumn("_k", F.col("_k") - 1)
    d = d.withColumn("_jump", F.col("prev").isNotNull() & leap(F.col("prev"), F.struct(t, *axes))).drop("prev")
    # Jump numbers 2i+1 and 2i+2 are a pair: rows with an odd number lie between them.
    d = d.withColumn("_pair", F.floor((F.col("_k") - 1) / 2))
    at = F.when(F.col("_jump"), F.col(t))
    ends = d.filter("_k > 0").groupBy(*keys, "_pair").agg(F.min(at).alias("_from"), F.max(at).alias("_to"), F.count(at).alias("_n"), F.sum((F.col("_k") % 2).cast("long")).alias("_rows"))
    d = join_null_safe(d, ends, [*keys, "_pair"], "left")
    inside = (F.col("_k") % 2 == 1) & (F.col("_n") == 2) & (F.col("_rows") >= 2) & (F.col("_to") - F.col("_from") <= longest_s)
    return d.withColumn("quarantined", F.coalesce(inside, F.lit(False))).drop("_jump", "_k", "_pair", "_from", "_to", "_n", "_rows")


def resample(queries: DataFrame, samples: DataFrame, keys: list[str], query_time: str, sample_time: str, axes: list[str], enter_s: float = 0.25, gap_s: float = 0.65, predict_s: float = 0.5, max_rate: float = 0.8, angles: tuple[str, ...] = (), max_turn: float = 90.0) -> DataFrame:
    """Adds ``state`` and ``<axis>_at`` for each query time.

    ENTERING: up to ``enter_s`` before the first sample, whose value it has. TRACKED: between samples at most
    ``gap_s`` apart, smoothstep between them. PREDICTED: up to ``predict_s`` after the last sample before,
    carried on at its rate of change, held within ``max_rate``. SEARCHING: otherwise, without a value. A
    query at the last sample is PREDICTED. ``angles`` (degrees) go the shorter way round, at ``max_turn`` a second at most, and come out wrapped.
    """
    axes = [*axes, *angles]
    step = lambda a, b, x: wrap(b - a) if x in angles else b - a
    s = neighbours(samples, keys, [sample_time, *axes], [sample_time, *axes])
    dt = F.col(sample_time) - F.col(f"prev.{sample_time}")
    for a in axes:
        s = s.withColumn(f"_r_{a}", F.when(dt > 0, clip(step(F.col(f"prev.{a}"), F.col(a), a) / dt, *((-max_turn, max_turn) if a in angles else (-max_rate, max_rate)))).otherwise(0.0))
    rates = [f"_r_{a}" for a in axes]
    found = bracket(queries, s.select(*keys, sample_time, *axes, *rates), keys, query_time, sample_time, [*axes, *rates], side="right")
    q = F.col(query_time)
    before = F.col("lo.t") > q
    tracked = (F.col("lo.t") <= q) & F.col("hi").isNotNull() & (F.col("hi.t") - F.col("lo.t") <= gap_s)
    age = q - F.col("lo.t")
    state = F.when(F.col("lo").isNull(), "SEARCHING").when(before, F.when(F.col("lo.t") - q <= enter_s, "ENTERING").otherwise("SEARCHING"))
    state = state.when(tracked, "TRACKED").when(age <= predict_s, "PREDICTED").otherwise("SEARCHING")
    found = found.withColumn("state", state)
    u = smoothstep(F.when(F.col("hi.t") > F.col("lo.t"), age / (F.col("hi.t") - F.col("lo.t"))).otherwise(0.0))
    for a in axes:
        value = F.when(F.col("state") == "ENTERING", F.col(f"lo.{a}")).when(F.col("state") == "TRACKED", F.col(f"lo.{a}") + u * step(F.col(f"lo.{a}"), F.col(f"hi.{a}"), a))
        value = value.when(F.col("state") == "PREDICTED", F.col(f"lo.{a}") + age * F.col(f"lo._r_{a}"))
        found = found.withColumn(f"{a}_at", wrap(value) if a in angles else value)
    return found.drop("lo", "hi")


def visible(frames: DataFrame, keys: list[str], order: list[str], observed: Column, limit: float) -> DataFrame:
    """Adds ``visible``: whether a row's time is within ``limit`` of an observed row's, before or after."""
    t = order[0]
    d = bracket_self(frames, keys, t, F.col(t), observed, [])
    near = F.least(F.abs(F.col(t) - F.col("lo.t")), F.abs(F.col("hi.t") - F.col(t)))
    return d.withColumn("visible", F.coalesce(near <= limit, F.lit(False))).drop("lo", "hi")


def segment_table(df: DataFrame, keys: list[str], order: list[str], gap: float) -> DataFrame:
    """(``keys``, segment, n_rows, start_s, end_s)."""
    return gap_segments(df, keys, order, gap).groupBy(*keys, "segment").agg(F.count(F.lit(1)).alias("n_rows"), F.min(order[0]).alias("start_s"), F.max(order[0]).alias("end_s"))
