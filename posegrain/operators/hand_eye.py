"""Hand-eye calibration per group from a bounded number of evenly spaced pose pairs."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from posegrain.operators.alignment import hand_eye, quaternion_of
from posegrain.operators.ordered import evenly_spaced
from posegrain.session import ship_package

MOST = 240


def _matrices(t: np.ndarray, q: np.ndarray) -> np.ndarray:
    x, y, z, w = (q / np.linalg.norm(q, axis=1, keepdims=True)).T
    m = np.tile(np.eye(4), (len(q), 1, 1))
    m[:, 0, :3] = np.stack([1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)], 1)
    m[:, 1, :3] = np.stack([2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)], 1)
    m[:, 2, :3] = np.stack([2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)], 1)
    m[:, :3, 3] = t
    return m


def hand_eye_by_group(pairs: DataFrame, keys: list[str], order: list[str], least: int = 20) -> DataFrame:
    """(``keys``, n, tx … qw, ztx … zqw): the fixed transforms between the two tracked bodies and between the two frames of each group.

    ``pairs``: x, y, z, qx … qw and the same as ``m_*``, with pose X ≈ Z m. At most ``MOST`` rows per group, evenly spaced by rank, go into
    the solve, which bounds its group; fewer than ``least`` give no row.
    """
    ship_package(pairs.sparkSession)
    d = evenly_spaced(pairs, keys, order, MOST)
    types = ", ".join(f"`{k}` {pairs.schema[k].dataType.simpleString()}" for k in keys)
    part = ["tx", "ty", "tz", "qx", "qy", "qz", "qw"]
    names = [*part, *[f"z{c}" for c in part]]

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        if len(pdf) < least:
            return pd.DataFrame(columns=[*keys, "n", *names])
        pdf = pdf.sort_values(order)
        a = _matrices(pdf[["x", "y", "z"]].to_numpy(), pdf[["qx", "qy", "qz", "qw"]].to_numpy())
        b = _matrices(pdf[["m_x", "m_y", "m_z"]].to_numpy(), pdf[["m_qx", "m_qy", "m_qz", "m_qw"]].to_numpy())
        x, z = hand_eye(a, b)
        return pd.DataFrame([[*(pdf[k].iloc[0] for k in keys), len(pdf), *x[:3, 3], *quaternion_of(x[:3, :3]), *z[:3, 3], *quaternion_of(z[:3, :3])]], columns=[*keys, "n", *names])

    return d.groupBy(*keys).applyInPandas(solve, f"{types}, n long, {', '.join(f'{n} double' for n in names)}")
