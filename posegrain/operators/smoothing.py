"""Recursive filters and smoothers per segment."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from posegrain.operators.aggregates import join_null_safe
from posegrain.operators.ordered import CHUNK, HALO, chunked, per_group, sequential, time_block
from posegrain.session import cut_lineage, written


def ema(df: DataFrame, keys: list[str], order: list[str], value: str, keep: float, name: str, gap: float = 0.65) -> DataFrame:
    """Exponential mean: ``keep`` of the last one and the rest of the new value; starts anew after a gap or a NULL.

    What it gives is affine in what a block of time begins with: each block is run once from nothing, the blocks' ends are
    put together in order, and rows take their share of their block's beginning. A source spreads over its blocks.
    """
    time = order[0]

    def run(t: np.ndarray, v: np.ndarray) -> list[np.ndarray]:
        """Mean from nothing, share of the beginning in it, whether the block begins with a value."""
        own, share, at, left, before = [], [], 0.0, 1.0, None
        for a, x in zip(t.tolist(), v.tolist()):
            if x != x:
                own.append(x), share.append(0.0)
                at, left, before = None, 0.0, None
                continue
            if at is None or (before is not None and a - before > gap):
                at, left = x, 0.0
            else:
                at, left = keep * at + (1 - keep) * x, keep * left
            before = a
            own.append(at), share.append(left)
        return [np.array(own), np.array(share)]

    d = df.withColumn("_block", time_block(time))
    d = cut_lineage(per_group(d, [*keys, "_block"], order, [time, value], run, ["_own", "_share"]))
    place = F.struct(*order)
    ends = d.groupBy(*keys, "_block").agg(*[F.min_by(c, place).alias(f"_f{c}") for c in (time, value)], *[F.max_by(c, place).alias(f"_l{c}") for c in (time, "_own", "_share")])
    ends = ends.withColumn(f"_f{value}", F.nanvl(F.col(f"_f{value}").cast("double"), F.lit(None)))

    def step(state, row):
        # To begin with the first value itself is to begin anew.
        anew = state is None or row[f"_f{time}"] - state[0] > gap
        begin = row[f"_f{value}"] if anew else state[1]
        if row["_l_own"] is None:
            return None, (begin,)
        return (row[f"_l{time}"], row["_l_own"] + row["_l_share"] * (begin if begin is not None else 0.0)), (begin,)

    ends = sequential(ends, keys, ["_block"], lambda: None, step, "_begin double").select(*keys, "_block", "_begin")
    d = join_null_safe(d, ends, [*keys, "_block"], "left")
    return d.withColumn(name, F.when(F.col("_share") == 0, F.col("_own")).otherwise(F.col("_own") + F.col("_share") * F.col("_begin"))).drop("_own", "_share", "_begin", "_block")


def _gate(t: np.ndarray, axes: list[np.ndarray], max_speed: float, start: tuple | None) -> tuple[np.ndarray, tuple | None]:
    """Which positions are accepted from the last accepted one ``start`` (t, position) on, and the last one then."""
    out, at = np.zeros(len(t), bool), start
    for i, (a, *p) in enumerate(zip(t.tolist(), *[x.tolist() for x in axes])):
        if any(v != v for v in p):
            continue
        if at is not None:
            way = sum((u - v) * (u - v) for u, v in zip(p, at[1:])) ** 0.5
            if way > max_speed * (a - at[0]) and way > 0:
                continue
        out[i], at = True, (a, *p)
    return out, at


def jump_gate(df: DataFrame, keys: list[str], order: list[str], axes: list[str], max_speed: float, name: str = "accepted") -> DataFrame:
    """Whether each position is reached from the last accepted one at ``max_speed`` or less; the first always is.

    A rejected position does not move the reference. NULL positions are not accepted; no time passed counts as too fast unless nothing moved.
    Blocks of time run side by side, first each from nothing, then from the last accepted position of the block before, and those
    whose beginning changed by that again, until none does: mostly at once, as a block soon accepts the same rows.
    """
    time = order[0]
    refs = ["_rt", *[f"_r{i}" for i in range(len(axes))]]
    by = [*keys, "_block"]
    d = written(df.withColumn("_block", time_block(time)))
    narrow = d.select(*by, *order, *axes)

    def begin(v: tuple[np.ndarray, ...]) -> tuple | None:
        return None if v[0][0] != v[0][0] else tuple(float(x[0]) for x in v)

    def ends(rows: DataFrame) -> DataFrame:
        """The last accepted position of each block; ``rows`` with what it begins with."""

        def run(t: np.ndarray, *v: np.ndarray) -> list[np.ndarray]:
            last = _gate(t, list(v[: len(axes)]), max_speed, begin(v[len(axes) :]))[1]
            return [np.full(len(t), np.nan if last is None else x) for x in (last or (np.nan,) * len(refs))]

        got = per_group(rows, by, order, [time, *axes, *refs], run, [f"_e{r}" for r in refs])
        return written(got.groupBy(*by).agg(*[F.max(f"_e{r}").alias(f"_e{r}") for r in refs], *[F.max(r).alias(r) for r in refs]))

    state = ends(narrow.withColumns({r: F.lit(None).cast("double") for r in refs}))
    while True:
        v = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        known = F.when(F.col("_e_rt").isNotNull(), F.struct(*[f"_e{r}" for r in refs]))
        due = state.withColumn("_b", F.last(known, ignorenulls=True).over(v))
        changed = due.filter(~F.struct(*refs).eqNullSafe(F.struct(*[F.col(f"_b._e{r}").alias(r) for r in refs]))).select(*by, *[F.col(f"_b._e{r}").alias(r) for r in refs])
        changed = written(changed)
        if changed.isEmpty():
            break
        again = ends(join_null_safe(narrow, changed, by))
        kept = join_null_safe(state, changed.select(*by), by, "left_anti")
        state = written(kept.unionByName(again))

    def accepted(t: np.ndarray, *v: np.ndarray) -> list[np.ndarray]:
        return [_gate(t, list(v[: len(axes)]), max_speed, begin(v[len(axes) :]))[0].astype(float)]

    d = per_group(join_null_safe(d, state.select(*by, *refs), by, "left"), by, order, [time, *axes, *refs], accepted, ["_ok"])
    return d.withColumn(name, F.col("_ok") == 1).drop("_ok", "_block", *refs)


def smooth_constant_velocity(t: np.ndarray, z: np.ndarray, sigma_m: float, sigma_a: float, rate0: float, model: str = "continuous") -> tuple[np.ndarray, np.ndarray]:
    """Kalman filter and Rauch-Tung-Striebel smoother of one axis with irregular steps; NaN is no measurement.

    The model of constant velocity couples an axis with its own rate only, so axes are independent and each
    step is 2x2 in closed form. Returns smoothed values and rates. ``model``: how the acceleration's noise q enters over a
    step: ``continuous`` as q (dt³/3, dt²/2, dt), ``discrete``, one acceleration a step, as q (dt⁴/4, dt³/2, dt²).
    """
    n = len(t)
    known = np.flatnonzero(~np.isnan(z))
    if not len(known):
        return np.full(n, np.nan), np.full(n, np.nan)
    ts, zs, r, q = t.tolist(), z.tolist(), sigma_m**2, sigma_a**2
    x, v, a, b, c = zs[known[0]], 0.0, r, 0.0, rate0**2
    filtered, predicted, dt = [], [], 0.0
    for i in range(n):
        if i:
            dt = ts[i] - ts[i - 1]
            x += v * dt
            qa, qb, qc = (dt**4 / 4, dt**3 / 2, dt * dt) if model == "discrete" else (dt**3 / 3, dt * dt / 2, dt)
            a, b, c = a + 2 * dt * b + dt * dt * c + q * qa, b + dt * c + q * qb, c + q * qc
        predicted.append((x, v, a, b, c, dt))
        if zs[i] == zs[i]:
            k, g = a / (a + r), b / (a + r)
            off = zs[i] - x
            x, v = x + k * off, v + g * off
            a, b, c = (1 - k) * a, (1 - k) * b, c - g * b
        filtered.append((x, v, a, b, c))
    out, rate = [x] * n, [v] * n
    for i in range(n - 2, -1, -1):
        fx, fv, a, b, c = filtered[i]
        px, pv, pa_, pb, pc, dt = predicted[i + 1]
        det = pa_ * pc - pb * pb
        dx, dv = out[i + 1] - px, rate[i + 1] - pv
        if det > 0:
            u, w = a + dt * b, b + dt * c
            out[i] = fx + ((u * pc - b * pb) * dx + (b * pa_ - u * pb) * dv) / det
            rate[i] = fv + ((w * pc - c * pb) * dx + (c * pa_ - w * pb) * dv) / det
        else:
            out[i], rate[i] = fx, fv
    return np.array(out), np.array(rate)


def _per_chunk(df: DataFrame, keys: list[str], order: list[str], inputs: list[str], function, outputs: list[str], index: str, rows: int, halo: int) -> DataFrame:
    d = per_group(chunked(df, index, rows, halo), [*keys, "_chunk"], order, inputs, function, outputs)
    return d.filter("_own").drop("_own", "_chunk")


def kalman_rts(df: DataFrame, keys: list[str], order: list[str], axes: dict[str, tuple[float, float, float]], index: str, model: str = "continuous", rows: int = CHUNK, halo: int = HALO) -> DataFrame:
    """Adds ``<axis>_smooth`` and ``<axis>_rate`` per group of ``keys``, which should hold a segment.

    ``axes``: measurement noise, acceleration noise and first rate's spread of each. ``index``: the row's place in its
    group (from 0). Groups longer than ``rows`` are smoothed in chunks with ``halo`` more rows on either side: the filter
    forgets what lies hundreds of measurements away to the last digit (tested to 1e-9).
    """

    def run(t: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
        return [out for v, rule in zip(values, axes.values()) for out in smooth_constant_velocity(t, v, *rule, model)]

    return _per_chunk(df, keys, order, [order[0], *axes], run, [f"{a}_{what}" for a in axes for what in ("smooth", "rate")], index, rows, halo)


def savgol(y: np.ndarray, width: int = 9, degree: int = 2) -> np.ndarray:
    """Local polynomial smoothing with odd windows; the ends take their values from the first and last window's polynomial."""
    n = len(y)
    width = min(width, n if n % 2 else n - 1)
    if width <= degree:
        return y.copy()
    h = width // 2
    grid = np.arange(-h, h + 1)
    basis = np.vander(grid, degree + 1, increasing=True)
    fit = np.linalg.pinv(basis)
    out = np.convolve(y, fit[0][::-1], mode="same")
    at = np.vander(grid.astype(float), degree + 1, increasing=True)
    out[:h] = (at @ (fit @ y[:width]))[:h]
    out[n - h :] = (at @ (fit @ y[-width:]))[-h:]
    return out


def despike_and_smooth(y: np.ndarray, limit: float = 0.12) -> np.ndarray:
    """Readings farther than ``limit`` from the median of five (zeros beyond the ends) take it; then ``savgol``."""
    if len(y) < 3:
        return y.copy()
    padded = np.concatenate([np.zeros(2), y, np.zeros(2)])
    med = np.median(np.lib.stride_tricks.sliding_window_view(padded, 5), axis=1)
    return savgol(np.where(np.abs(y - med) > limit, med, y))


def despiked(df: DataFrame, keys: list[str], order: list[str], axes: list[str], index: str, limit: float = 0.12, rows: int = CHUNK) -> DataFrame:
    """Adds ``<axis>_smooth`` per group of ``keys``, which should hold a segment; rows with NULL must be left out before.

    ``index``: the row's place in its group (from 0). A value depends on rows up to ten places away, so chunks with a halo give what whole groups give.
    """
    return _per_chunk(df, keys, order, axes, lambda *v: [despike_and_smooth(y, limit) for y in v], [f"{a}_smooth" for a in axes], index, rows, 16)
