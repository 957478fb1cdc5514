"""Implausible readings: spikes, stuck values and impossible values, relative to each source's own course.

Three tests, kept apart:

* range: values outside the physical range of their field;
* constant runs: six or more successive equal readings;
* spikes: the readings of a source's day make a matrix of profiles, rows of ``WIDTH`` successive readings, fewer where
  the day is short. Robust principal components by alternating projections split it into a low-rank part, the usual
  course, and a sparse part. What the sparse part takes is looked at with its surroundings: they are left out of
  a second projection, and a reading is a spike where its sparse part there is far beyond the usual variation, and an
  exact check against the nearest readings outside says that the series comes back within a few rows.

Most sources here last minutes, so a day is mostly a whole source; its profiles are stretches of it, as whole days
side by side would be one row. Readings are shuffled once, to (source, field, day), with those of the hour before and
after as context, so a source of any length spreads over its days, and what comes out does not depend on how rows are partitioned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posegrain.operators.pieces import whole_groups
from posegrain.session import map_rows

WIDTH, RANK, ROUNDS = 32, 2, 8
DAY_S = 86_400.0
FEW = 64  # readings below which the few that spikes could have spoilt are left out of the first scale
AROUND_S = 3_600.0  # what of the days beside it a day is judged with
PIECE_ROWS, STRIP = 200_000, 128  # days of more readings are judged in pieces, with some on either side


@dataclass(frozen=True)
class Field:
    """A measured field: its physical range, the smallest scale its variation can have, and whether it is an angle in degrees."""

    low: float
    high: float
    floor: float
    angle: bool = False


@dataclass(frozen=True)
class Rule:
    """``times``: multiples of the usual variation; ``rows``: the longest spike; ``stuck``: the shortest constant run."""

    times: float = 10.0
    candidate: float = 4.0
    rows: int = 5
    stuck: int = 6


def _turn(d: np.ndarray, angle: bool) -> np.ndarray:
    return (d + 180.0) % 360.0 - 180.0 if angle else d


def constant_runs(x: np.ndarray, least: int) -> np.ndarray:
    """Mask of readings in runs of ``least`` or more equal ones."""
    start = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
    length = np.diff(np.append(start, len(x)))
    return np.repeat(length >= least, length)


def usual_course(x: np.ndarray, scale: float, cut: float, left_out: np.ndarray | None = None) -> np.ndarray:
    """The low-rank part of the profile matrix of ``x``, at each reading.

    Non-convex robust principal components: entries farther than a falling threshold from the low-rank
    part count as sparse and are replaced by it before the next projection. Readings ``left_out`` count as sparse throughout.
    """
    n = len(x)
    width = WIDTH if n >= WIDTH else max(4, n // 2)
    step = width if n >= 8 * width else max(1, width // 4)
    first = np.arange(0, n - width + 1, step)
    if first[-1] != n - width:
        first = np.append(first, n - width)
    at = first[:, None] + np.arange(width)
    m = x[at]
    m = m - np.median(m, axis=1, keepdims=True)
    # A running median of nine starts the sparse part: it is blind to spikes of up to four readings.
    p = np.pad(x, 4, mode="edge")
    med = np.median(np.lib.stride_tricks.sliding_window_view(p, 9), axis=1)
    rough = x - med
    base = m - rough[at]
    # What it finds stays in the sparse part, else a large spike could become a component of its own.
    held = np.abs(rough[at]) > cut * 2
    if left_out is not None:
        held |= left_out[at]
    s = np.where(held, m - base, 0.0)
    bias = np.ones(width) / np.sqrt(width)
    line = np.linspace(-1, 1, width)
    line /= np.linalg.norm(line)
    rank = RANK if n >= WIDTH else 0
    low = base
    worst = np.abs(m - base).max() + cut
    for k in range(ROUNDS):
        y = m - s
        # The constant and the straight line belong to every course; the further components are the data's.
        y0 = y - (y @ bias)[:, None] * bias - (y @ line)[:, None] * line
        low = y - y0
        if rank:
            _, v = np.linalg.eigh(y0.T @ y0)
            v = v[:, -rank:]
            low = low + (y0 @ v) @ v.T
        left = m - low
        limit = cut + worst * 0.5 ** (2 * k + 4)
        s = np.where(held | (np.abs(left) > limit), left, 0.0)
    out = np.full(n, np.inf)
    left = m - low
    flat, val = at.ravel(), left.ravel()
    order = np.argsort(-np.abs(val), kind="stable")  # where profiles overlap the smallest residual holds
    out[flat[order]] = val[order]
    return x - out


def sparse_part(x: np.ndarray, scale: float, cut: float, left_out: np.ndarray | None = None) -> np.ndarray:
    """How far each reading is from the usual course."""
    return np.abs(x - usual_course(x, scale, cut, left_out))


def _off_line(t: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """How far each reading is from the line between those ``k`` before and after, and the product of the times to them."""
    left, right = t[k:-k] - t[: -2 * k], t[2 * k :] - t[k:-k]
    return np.abs(x[k:-k] - x[: -2 * k] - left / np.maximum(left + right, 1e-6) * (x[2 * k :] - x[: -2 * k])), left * right


def _scale(t: np.ndarray, x: np.ndarray, floor: float, spoilt: int = 0) -> tuple[float, float]:
    """Usual deviation of a reading from the line between its neighbours, and how bent the course is:
    what the deviation grows by with the product of the times to farther neighbours.

    The ``spoilt`` largest deviations are left out. Of few readings the largest deviation counts too.
    """
    off = np.sort(_off_line(t, x, 1)[0])
    off = off[: max(1, len(off) - spoilt)]
    scale = max(1.4826 * float(np.median(off)), floor)
    if len(x) < 16:
        return max(scale, float(off[-1]) / 3), 0.0
    far, area = _off_line(t, x, 3)
    far = np.sort(far)[: max(1, len(far) - 2 * spoilt)]
    return scale, max(0.0, 1.4826 * float(np.median(far)) - 1.2 * scale) / max(float(np.median(area)), 1e-3)


def spikes(t: np.ndarray, x: np.ndarray, field: Field, rule: Rule) -> np.ndarray:
    """Mask of spikes in one ordered series of plausible readings; none in fewer than five, which have no usual variation."""
    n = len(x)
    out = np.zeros(n, bool)
    if n < 5:
        return out
    if field.angle:
        x = np.concatenate([x[:1], x[0] + np.cumsum(_turn(np.diff(x), True))])
    # A spike of a few rows spoils its own deviations and its neighbours'; of few readings these may be most.
    scale, bend = _scale(t, x, field.floor, 0 if n >= FEW else min(rule.rows, n // 5) + 2)
    sparse = sparse_part(x, scale, rule.candidate * scale)
    limit = rule.candidate * max(scale, 1.4826 * float(np.median(sparse)))
    # Candidates that lie too dense to tell apart are looked at again with higher limits.
    while (sparse > limit).any():
        candidate = sparse > limit
        # The low-rank part may have taken in some of a spike, so the second projection is made without its surroundings.
        for width in (7, 5, 3, 1):
            around = np.convolve(candidate, np.ones(width), "same")[:n] > 0.5 if n > width else candidate.copy()
            around[[0, -1]] &= candidate[[0, -1]]  # where the series begins and ends is no surrounding
            if n - around.sum() >= 4:
                break
        rest = ~candidate
        if n < FEW and rest.sum() >= 4:
            scale, bend = _scale(t[rest], x[rest], field.floor)
        found = _confirmed(t, x, around, scale, bend, rule)
        if found.any():
            out |= found & (sparse_part(x, scale, rule.candidate * scale, around) > rule.candidate * scale)
        limit *= 4
    return out


def _confirmed(t: np.ndarray, x: np.ndarray, candidate: np.ndarray, scale: float, bend: float, rule: Rule) -> np.ndarray:
    """The exact check: mask of those that leave the course and come back."""
    n, out = len(x), np.zeros(len(x), bool)
    # From its ends inwards each run of candidates gives back what goes on from the readings beside it.
    while candidate.any():
        good = np.flatnonzero(~candidate)
        if len(good) < min(4, n - 1):
            return out
        at = np.searchsorted(good, np.arange(n))
        b, a = np.clip(at - 1, 0, len(good) - 1), np.clip(at, 0, len(good) - 1)
        before, after = good[b], good[a]
        left, right = np.maximum(t - t[before], 0), np.maximum(t[after] - t, 0)
        course = x[before] + np.clip(left / np.maximum(t[after] - t[before], 1e-6), 0, 1) * (x[after] - x[before])
        b2, a2 = good[np.maximum(b - 1, 0)], good[np.minimum(a + 1, len(good) - 1)]
        fore, rear = (x[before] - x[b2]) / np.maximum(t[before] - t[b2], 0.02), (x[a2] - x[after]) / np.maximum(t[a2] - t[after], 0.02)
        on, back = x[before] + fore * left, x[after] - rear * right
        # After a lasting change of level, or movement during a gap, a reading is like one neighbour alone.
        alone = np.minimum(np.abs(x - x[before]), np.abs(x - x[after]))
        size = np.minimum(np.abs(x - course), alone) / (scale + bend * left * right)
        first, last = np.append(False, ~candidate[:-1]), np.append(~candidate[1:], False)
        after_before = np.minimum(np.abs(x - on) / (scale + bend * left * left + 0.1 * np.abs(fore) * left), np.abs(x - x[before]) / (scale + bend * left * left))
        before_after = np.minimum(np.abs(x - back) / (scale + bend * right * right + 0.1 * np.abs(rear) * right), np.abs(x - x[after]) / (scale + bend * right * right))
        near = np.minimum(np.where(first, after_before, np.inf), np.where(last, before_after, np.inf))
        new = candidate & (near > rule.times) & ~((size <= rule.times) & (first | last))
        if (new == candidate).all():
            candidate &= size > rule.times
            break
        candidate = new
    start = np.flatnonzero(np.diff(np.append(False, candidate).astype(np.int8)) == 1)
    stop = np.flatnonzero(np.diff(np.append(candidate, False).astype(np.int8)) == -1) + 1
    for i, j in zip(start, stop):
        if j - i <= rule.rows and i > 0 and j < n:
            out[i:j] = True
    return out


def judge(t: np.ndarray, x: np.ndarray, field: Field, rule: Rule) -> np.ndarray:
    """0: plausible, 1: impossible, 2: stuck, 3: spike; for one source's ordered readings of a field."""
    kind = np.zeros(len(x), np.int8)
    kind[constant_runs(x, rule.stuck)] = 2
    kind[(x < field.low) | (x > field.high)] = 1
    rest = np.flatnonzero(kind == 0)
    kind[rest[spikes(t[rest], x[rest], field, rule)]] = 3
    return kind


def judge_day(t: np.ndarray, x: np.ndarray, field: Field, rule: Rule) -> np.ndarray:
    """``judge`` over readings of any number: pieces cut at fixed places, each seen with ``STRIP`` readings more on either side."""
    kind = np.zeros(len(x), np.int8)
    for a in range(0, len(x), PIECE_ROWS):
        low, high = max(0, a - STRIP), min(len(x), a + PIECE_ROWS + STRIP)
        kind[a : a + PIECE_ROWS] = judge(t[low:high], x[low:high], field, rule)[a - low : a - low + PIECE_ROWS]
    return kind


NAMES = np.array(["", "impossible", "stuck", "spike"])


def implausible_readings(df: DataFrame, source: str, order: list[str], id_col: str, fields: dict[str, Field], rule: Rule = Rule()) -> DataFrame:
    """Flagged readings: ``id_col``, ``field_name``, ``reason`` (impossible, stuck or spike).

    ``order``: the time in seconds, then ties' order. Rows without a time take no part; NULL and NaN
    readings are left out before "successive" is counted. NULL sources form one source. A source with
    fewer than five readings has no spikes, but its impossible values are flagged. An excursion that never comes
    back, as at a source's last reading, is a change of level and no spike. Across midnight, runs and spikes are seen as
    far as their readings lie within an hour of it. The usual variation is that of the day.
    """
    time = order[0]
    id_type = df.schema[id_col].dataType.simpleString()
    rows = df.filter(F.col(time).isNotNull() & ~F.isnan(F.col(time).cast("double")))
    t = F.col(time).cast("double")
    # Days end halfway, as sources begin at 0: few rows then lie near an end of one.
    day = lambda shift: F.floor((t + DAY_S / 2 + shift) / DAY_S)
    rows = rows.select(F.col(source).alias("_source"), t.alias("_t"), *[F.col(c).alias(f"_o{k}") for k, c in enumerate(order) if k], F.col(id_col).alias("_id"), day(0.0).alias("_own"), F.explode(F.sequence(day(-AROUND_S), day(AROUND_S))).alias("_day"), *[F.col(f).alias(f"_f{i}") for i, f in enumerate(fields)])
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f"_f{i}").cast("double").alias("x")) for i, f in enumerate(fields)])).alias("e")
    ties = [f"_o{k}" for k in range(1, len(order))]
    rows = rows.select("_source", "_t", *ties, "_id", (F.col("_own") == F.col("_day")).alias("_own"), "_day", each)
    rows = rows.select("_source", F.col("e.field_name").alias("field_name"), "_day", "_t", *ties, "_id", "_own", F.col("e.x").alias("x")).filter(F.col("x").isNotNull() & ~F.isnan("x"))
    keys = ["_source", "field_name", "_day"]
    # The number is stated, as few bytes are much work here and would else be put together.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    series = rows.repartition(tasks, *keys).sortWithinPartitions(*keys, "_t", *ties, "_id").select(*keys, "_t", "_id", "_own", "x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, keys):
            t, x, own = table["_t"].to_numpy(), table["x"].to_numpy(), table["_own"].to_numpy(zero_copy_only=False)
            names, kind = table["field_name"], np.zeros(len(t), np.int8)
            for a, b in zip(starts[:-1], starts[1:]):
                if own[a:b].any():
                    kind[a:b] = judge_day(t[a:b], x[a:b], fields[names[int(a)].as_py()], rule)
            hit = np.flatnonzero((kind > 0) & own)
            at = pa.array(hit)
            yield pa.RecordBatch.from_arrays([table["_id"].combine_chunks().take(at), names.combine_chunks().take(at), pa.array(NAMES[kind[hit]], pa.string())], [id_col, "field_name", "reason"])

    return map_rows(series, run, f"`{id_col}` {id_type}, field_name string, reason string")
