"""The stateful operators over streams: the jump gate and running tag counts, equal to their batch forms."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from posegrain.session import ship_package


def stream_jump_gate(poses: DataFrame, key: str, time: str, axes: list[str], max_speed: float) -> DataFrame:
    """Each pose with ``accepted``. State per source: the last accepted time and position, four numbers.

    Rows of a source must arrive in order across batches; within a batch they are sorted. Output mode append.
    """
    ship_package(poses.sparkSession)
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in poses.schema.fields)
    state_type = "t double, " + ", ".join(f"a{i} double" for i in range(len(axes)))

    def gate(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get if state.exists else None
        rows = pd.concat(list(frames)).sort_values(time, kind="stable")
        accepted = []
        for r in rows[[time, *axes]].itertuples(index=False):
            p = r[1:]
            ok = all(v is not None and v == v for v in p)
            if ok and last is not None:
                moved = sum((a - b) ** 2 for a, b in zip(p, last[1:])) ** 0.5
                ok = not (moved > max_speed * (r[0] - last[0]) and moved > 0)
            if ok:
                last = tuple(float(v) for v in r)
            accepted.append(ok)
        if last is not None:
            state.update(tuple(last))
        yield rows.assign(accepted=accepted)

    return poses.groupBy(key).applyInPandasWithState(gate, f"{types}, accepted boolean", state_type, "append", GroupStateTimeout.NoTimeout)


def stream_tag_counts(poses: DataFrame, key: str, ids: str) -> DataFrame:
    """Running number of frames each tag was seen in; a tag named twice in a frame counts once. Output mode complete or update."""
    d = poses.filter(F.col(ids).isNotNull() & (F.trim(ids) != "")).select(key, F.explode(F.array_distinct(F.split(F.trim(ids), r"\s+"))).alias("id"))
    return d.groupBy(key, "id").agg(F.count(F.lit(1)).alias("n_frames"))


def stream_valid_ratio(poses: DataFrame, key: str, at: str, valid, delay: str = "5 minutes", window: str = "1 minute") -> DataFrame:
    """Valid share per source and window of arrival; rows later than ``delay`` are dropped by the watermark."""
    d = poses.withWatermark(at, delay)
    return d.groupBy(F.window(at, window), key).agg(F.count(F.lit(1)).alias("n"), F.avg(valid.cast("int")).alias("valid_ratio"))
