import inspect

import numpy as np

from posegrain.operators import alignment
from posegrain.operators import hand_eye as H
from posegrain.plans import reference as R


def test_inliers_are_refitted_five_times(spark, monkeypatch):
    """Values whose limit still shrinks in the fourth and fifth round."""
    x = 0.01 * 1.05 ** np.arange(160)
    keep, kept = np.ones(len(x), bool), []
    for _ in range(5):
        m = np.median(x[keep])
        keep = x <= m + max(4 * 1.4826 * np.median(np.abs(x[keep] - m)), 0.002)
        kept.append(keep.sum())
    assert kept[2] > kept[4]
    d = spark.createDataFrame([("s", k, float(v)) for k, v in enumerate(x)], "session_id string, frame long, rmse double")
    monkeypatch.setattr(R, "poses", lambda *_: d)
    assert R.agg_robust_inliers(spark, "").first().n_inliers == kept[4]


def test_hand_eye_runs_all_its_rounds():
    """The solve of a group leaves the number of rounds to the operator."""
    assert "rounds" not in inspect.getsource(H.hand_eye_by_group)
    assert inspect.signature(alignment.hand_eye).parameters["rounds"].default >= 20
