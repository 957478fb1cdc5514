"""Time offset between two series by correlating how they move over a grid of shifts.

Offsets are whole steps. All of a pass are tried on one block of time of a source at once, with the rows of the
other side that shifts reach; a block gives six sums per offset and channel, so the work spreads over sources and blocks.
Channels are linear and angular speeds. The other side is either a series of the same channels (``signature``), or
poses from which its movement between two shifted times is taken (``paired``).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posegrain.functions import rotations as rot
from posegrain.operators.aggregates import join_null_safe
from posegrain.operators.ordered import neighbours
from posegrain.session import written, ship_package

BLOCK_S = 600.0
TRIED = 1 << 15  # pairs tried at once
QUATERNION = ["qx", "qy", "qz", "qw"]
SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")


def _between(df: DataFrame, keys: list[str], axes: list[str], a: str, b: str, dt) -> list:
    """Speeds from the row ``a`` to the row ``b`` (column prefixes): linear, and with an orientation angular in degrees."""
    out = [(F.sqrt(sum((F.col(b + c) - F.col(a + c)) * (F.col(b + c) - F.col(a + c)) for c in axes)) / dt).alias("speed")]
    if set(QUATERNION) <= set(df.columns):
        q = lambda s: rot.quaternion(*(F.col(s + c) for c in QUATERNION))
        out.append((rot.angle_deg(q(a), q(b)) / dt).alias("turn_rate"))
    return out


def speeds(df: DataFrame, keys: list[str], time: str, axes: list[str]) -> DataFrame:
    """(``keys``, t, speed, and with qx … qw turn_rate): speed from the row before, at the middle of the step; none for a first row or no time passed."""
    values = [time, *axes, *[c for c in QUATERNION if c in df.columns]]
    d = neighbours(df, keys, values[: 1 + len(axes)], values)
    dt = F.col(time) - F.col(f"prev.{time}")
    return d.filter(dt > 0).select(*keys, (F.col(time) - dt / 2).alias("t"), *_between(df, keys, axes, "prev.", "", dt))


def steps_between(df: DataFrame, keys: list[str], time: str, axes: list[str]) -> DataFrame:
    """(``keys``, t, t2, speed, turn_rate): each row with the row after it, for paired searches."""
    values = [time, *axes, *QUATERNION]
    d = neighbours(df, keys, values[: 1 + len(axes)], values)
    dt = F.col(f"next.{time}") - F.col(time)
    return d.filter(dt > 0).select(*keys, F.col(time).alias("t"), F.col(f"next.{time}").alias("t2"), *_between(df, keys, axes, "", "next.", dt))


def signature(df: DataFrame, keys: list[str], time: str, axes: list[str], baseline_s: float = 0.2, tolerance: float | None = None) -> DataFrame:
    """(``keys``, t, t2, middle, speed, turn_rate): speeds to the row nearest ``baseline_s`` later."""
    from posegrain.operators.asof import partner_at

    values = [*axes, *[c for c in QUATERNION if c in df.columns]]
    d = partner_at(df.select(*keys, time, *values), keys, time, values, baseline_s, max(0.03, 0.25 * baseline_s) if tolerance is None else tolerance).filter(F.col("other").isNotNull())
    dt = F.col("other.t") - F.col(time)
    return d.select(*keys, F.col(time).alias("t"), F.col("other.t").alias("t2"), ((F.col(time) + F.col("other.t")) / 2).alias("middle"), *_between(df, keys, axes, "", "other.", dt))


def _slerp(a: np.ndarray, b: np.ndarray, u: np.ndarray) -> np.ndarray:
    dot = np.einsum("...i,...i->...", a, b)
    theta = np.arccos(np.clip(np.abs(dot), 0, 1))
    small = np.abs(dot) > 0.9995
    with np.errstate(divide="ignore", invalid="ignore"):
        wa = np.where(small, 1 - u, np.sin((1 - u) * theta) / np.sin(theta))
        wb = np.where(small, u, np.sin(u * theta) / np.sin(theta)) * np.where(dot < 0, -1, 1)
    q = wa[..., None] * a + wb[..., None] * b
    return q / np.linalg.norm(q, axis=-1, keepdims=True)


def _bracketed(s: np.ndarray, q: np.ndarray, max_gap: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Samples before and after each query, its share of the way, and whether it lies inside a gap of at most ``max_gap``."""
    hi = np.clip(np.searchsorted(s, q), 1, len(s) - 1)
    lo = hi - 1
    span = s[hi] - s[lo]
    with np.errstate(divide="ignore", invalid="ignore"):
        u = np.where(span > 0, (q - s[lo]) / span, 0.0)
    return lo, hi, u, (s[lo] <= q) & (q <= s[hi]) & (span <= max_gap)


def offset_scores(
    left: DataFrame, right: DataFrame, keys: list[str], around: DataFrame, radius: float, step: float | None, max_gap: float | None, least: int = 20,
    channels: tuple[str, ...] = ("speed",), need_all: bool = False, paired: bool = False, whole: bool = False, flat: float = 1e-9,
) -> DataFrame:
    """(``keys``, step, offset_s, n, score, ``<channel>_score``); right time = left time + offset.

    Offsets lie up to ``radius`` to either side of ``around`` (``keys``, base, and step where ``step`` is None), in whole steps.
    The right side is interpolated where its samples are at most ``max_gap`` apart (None: anywhere between the first and last). A channel with fewer
    than ``least`` pairs or a constant side has no score; ``score`` is the mean of those that have one, or with ``need_all`` of all
    or none. ``whole``: an offset that takes any left row out of the right side's cover has no score.
    """
    extra = ["t2"] if paired else []
    values = ["x", "y", "z", *QUATERNION] if paired else list(channels)
    around = around.select(*keys, "base", (F.lit(step) if step is not None else F.col("step")).cast("double").alias("_step"))
    means = left.groupBy(*keys).agg(*[F.avg(c).alias(f"_m_{c}") for c in channels], (F.max(F.col("t2") - F.col("t")) if paired else F.lit(0.0)).alias("_span"), F.count(F.lit(1)).alias("_rows"))
    if max_gap is None:
        gaps = neighbours(right.select(*keys, "t"), keys, ["t"], ["t"]).groupBy(*keys).agg(F.max(F.col("t") - F.col("prev.t")).alias("_gap"))
        around = join_null_safe(around, gaps, keys)
    else:
        around = around.withColumn("_gap", F.lit(float(max_gap)))
    around = written(join_null_safe(around, means, keys))
    a = join_null_safe(left.filter("t IS NOT NULL").select(*keys, "t", *extra, *channels), around, keys).withColumn("_block", F.floor(F.col("t") / BLOCK_S))
    most = F.round(radius / F.col("_step")) * F.col("_step")
    b = join_null_safe(right.filter("t IS NOT NULL").select(*keys, F.col("t").cast("double").alias("t"), *values), around, keys)
    first = F.floor((F.col("t") - F.col("base") - most - F.col("_gap") - F.col("_span") - 1e-6) / BLOCK_S)
    last = F.floor((F.col("t") - F.col("base") + most + F.col("_gap") + 1e-6) / BLOCK_S)
    b = b.withColumn("_block", F.explode(F.sequence(first, last))).select(*keys, "_block", "t", *values)
    names = [f"{s}_{c}" for c in channels for s in SUMS]
    types = ", ".join(f"`{k}` {left.schema[k].dataType.simpleString()}" for k in keys)

    def sums(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        if x.empty:
            return pd.DataFrame(columns=[*keys, "step", "offset_s", *names])
        base, size = float(x["base"].iloc[0]), float(x["_step"].iloc[0])
        n = round(radius / size)
        steps = np.arange(-n, n + 1)
        offsets, total = base + steps * size, np.zeros((len(steps), len(names)))
        if len(y) >= 2:
            y = y.sort_values(["t", *values])
            s, own = y["t"].to_numpy(), {c: y[c].to_numpy(float) for c in values}
            where, turn = (np.stack([own[c] for c in "xyz"], 1), np.stack([own[c] for c in QUATERNION], 1)) if paired else (None, None)
            gap, mean = float(x["_gap"].iloc[0]) + 1e-12, [float(x[f"_m_{c}"].iloc[0]) for c in channels]
            wide = max(1, TRIED // min(len(x), TRIED))
            for at in range(0, len(x), TRIED):
                part = x.iloc[at : at + TRIED]
                t = part["t"].to_numpy(float)
                for i in range(0, len(steps), wide):
                    off = offsets[i : i + wide, None]
                    lo, hi, u, ok = _bracketed(s, t + off, gap)
                    if paired:
                        t2 = part["t2"].to_numpy(float)
                        lo2, hi2, u2, ok2 = _bracketed(s, t2 + off, gap)
                        ok = ok & ok2
                        way = np.linalg.norm((where[lo2] + u2[..., None] * (where[hi2] - where[lo2])) - (where[lo] + u[..., None] * (where[hi] - where[lo])), axis=-1)
                        dot = np.abs(np.einsum("...i,...i->...", _slerp(turn[lo], turn[hi], u), _slerp(turn[lo2], turn[hi2], u2)))
                        got = {"speed": way / (t2 - t), "turn_rate": np.degrees(2 * np.arccos(np.clip(dot, 0, 1))) / (t2 - t)}
                    else:
                        got = {c: own[c][lo] + u * (own[c][hi] - own[c][lo]) for c in channels}
                    for k, c in enumerate(channels):
                        p, w = part[c].to_numpy(float) - mean[k], got[c] - mean[k]
                        both = ok & ~np.isnan(w) & ~np.isnan(p)
                        p, w = np.where(both, p, 0.0), np.where(both, w, 0.0)
                        total[i : i + wide, 6 * k : 6 * k + 6] += np.stack([both.sum(1), p.sum(1), w.sum(1), (p * p).sum(1), (w * w).sum(1), (p * w).sum(1)], 1)
        return pd.DataFrame({**{k: [x[k].iloc[0]] * len(steps) for k in keys}, "step": steps, "offset_s": offsets, **{m: total[:, i] for i, m in enumerate(names)}})

    ship_package(left.sparkSession)
    by = [*keys, "_block"]
    found = a.groupBy(*by).cogroup(b.groupBy(*by)).applyInPandas(sums, f"{types}, step int, offset_s double, {', '.join(f'{n} double' for n in names)}")
    found = found.groupBy(*keys, "step").agg(F.max("offset_s").alias("offset_s"), *[F.sum(n).alias(n) for n in names])
    if whole:
        found = join_null_safe(found, around.select(*keys, "_rows"), keys)
    scores = []
    for c in channels:
        col = lambda s, c=c: F.col(f"{s}_{c}")
        spread = lambda d, col=col: F.sqrt(F.greatest(F.lit(0.0), F.try_divide(col(f"s{d}{d}"), col("n")) - F.pow(F.try_divide(col(f"s{d}"), col("n")), F.lit(2.0))))
        both = F.try_divide(col("sxy"), col("n")) - F.try_divide(col("sx"), col("n")) * F.try_divide(col("sy"), col("n"))
        enough = (col("n") >= least) & (spread("x") > flat) & (spread("y") > flat)
        if whole:
            enough &= col("n") == F.col("_rows")
        scores.append(F.when(enough, F.try_divide(both, spread("x") * spread("y"))).alias(f"{c}_score"))
    found = found.select(*keys, "step", "offset_s", F.col(f"n_{channels[0]}").cast("long").alias("n"), *scores)
    each = [F.col(f"{c}_score") for c in channels]
    some = F.filter(F.array(*each), lambda v: v.isNotNull())
    mean = F.try_divide(F.aggregate(some, F.lit(0.0), lambda p, v: p + v), F.size(some))
    return found.withColumn("score", F.when(F.size(some) == len(channels), mean) if need_all else mean)


def best_offset(scores: DataFrame, keys: list[str]) -> DataFrame:
    """The offset of the highest score, the smallest on a tie; sources without a score have no row."""
    cols = [c for c in scores.columns if c not in keys]
    best = F.max_by(F.struct(*cols), F.struct(F.col("score"), -F.col("step"))).alias("b")
    return scores.filter(F.col("score").isNotNull()).groupBy(*keys).agg(best).select(*keys, *[f"b.{c}" for c in cols])


def find_offset(
    left: DataFrame, right: DataFrame, keys: list[str], radius: float = 1.0, coarse: float = 0.05, fine: float = 0.005, max_gap: float = 0.5, least: int = 20, edge: float | None = 0.1, **how,
) -> DataFrame:
    """Coarse pass, then a fine one around its best: (``keys``, offset_s, score, ``<channel>_score``, n, uncertainty_s).

    Sources whose coarse best lies within ``edge`` of the radius are searched again, once, at twice the radius and two seconds at least.
    ``uncertainty_s``: half the span of the fine offsets that score within 0.02 of the best. ``how``: channels and rules of ``offset_scores``.
    """
    left, right = written(left), written(right)
    sources = left.select(*keys).distinct().withColumn("base", F.lit(0.0))
    rough = written(best_offset(offset_scores(left, right, keys, sources, radius, coarse, max_gap, least, **how), keys))
    if edge is not None:
        at_edge = F.abs("offset_s") >= radius - edge - 1e-9
        again = rough.filter(at_edge).select(*keys, F.lit(0.0).alias("base"))
        again = best_offset(offset_scores(left, right, keys, again, max(2.0, 2 * radius), coarse, max_gap, least, **how), keys)
        rough = written(rough.filter(~at_edge).unionByName(again))
    scores = written(offset_scores(left, right, keys, rough.select(*keys, F.col("offset_s").alias("base")), coarse * 2, fine, max_gap, least, **how))
    best = best_offset(scores, keys).drop("step")
    close = join_null_safe(scores.select(*keys, F.col("offset_s").alias("_o"), F.col("score").alias("_s")), best, keys).filter(F.col("_s") >= F.col("score") - 0.02)
    rest = [c for c in best.columns if c not in keys]
    return close.groupBy(*keys).agg(*[F.max(c).alias(c) for c in rest], ((F.max("_o") - F.min("_o")) / 2).alias("uncertainty_s"))


BOTH = ("speed", "turn_rate")


def find_offset_to_truth(visual: DataFrame, truth: DataFrame, keys: list[str], radius: float = 1.0, baseline_s: float = 0.2, max_gap: float = 0.05, least: int = 100) -> DataFrame:
    """Of poses (t, x … qw) against a truth: movement over ``baseline_s`` against the truth's between the same shifted times, at 10 ms, then
    1 ms; both channels must agree, or a stabilised picture with good positions and no turns would pass."""
    left = signature(visual, keys, "t", ["x", "y", "z"], baseline_s, max(0.03, 0.2 * baseline_s))
    return find_offset(left, truth, keys, radius, 0.01, 0.001, max_gap, least, channels=BOTH, need_all=True, paired=True)


def pair_offset_scores(left: DataFrame, right: DataFrame, keys: list[str], radius: float = 3.0, max_gap: float = 0.1) -> DataFrame:
    """The curve of the coarse search between two rigs."""
    a, b = (written(signature(d, keys, "t", ["x", "y", "z"]).select(*keys, F.col("middle").alias("t"), *BOTH)) for d in (left, right))
    return offset_scores(a, b, keys, a.select(*keys).distinct().withColumn("base", F.lit(0.0)), radius, 0.01, max_gap, 20, channels=BOTH)


def find_pair_offset(left: DataFrame, right: DataFrame, keys: list[str], radius: float = 3.0, max_gap: float = 0.1) -> DataFrame:
    """Between two rigs, ``right = left + offset``: their movements over 0.2 s at the middle of it, the mean of the channels that have a score."""
    a, b = (signature(d, keys, "t", ["x", "y", "z"]).select(*keys, F.col("middle").alias("t"), *BOTH) for d in (left, right))
    return find_offset(a, b, keys, radius, 0.01, 0.001, max_gap, 20, edge=None, channels=BOTH)


def find_generic_offset(estimate: DataFrame, truth: DataFrame, keys: list[str], radius: float = 1.0) -> DataFrame:
    """Of any two tracks: movement from row to row against the truth's between the same shifted times, in steps of the median step or 2 ms;
    an offset that leaves the truth's cover does not count. (``keys``, offset_s, score, ``<channel>_score``, n)."""
    from posegrain.operators.aggregates import percentiles

    left = written(steps_between(estimate, keys, "t", ["x", "y", "z"]))
    step = percentiles(left.withColumn("_dt", F.col("t2") - F.col("t")), keys, "_dt", {"m": 0.5})
    around = step.select(*keys, F.lit(0.0).alias("base"), F.greatest(F.col("m"), F.lit(0.002)).alias("step"))
    scores = offset_scores(left, written(truth), keys, around, radius, None, None, 2, channels=BOTH, paired=True, whole=True, flat=1e-8)
    return best_offset(scores, keys).drop("step")
