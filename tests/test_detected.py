"""How a tag is written does not matter."""

from posegrain.plans import reference as R


def test_how_a_tag_is_written(spark, monkeypatch):
    fields = ["3 4", "[3,4]", '"tag 3"; "bay ""B"" 4"', "'3'|'4'", "3  x4 -5 6.5 4", '"panel D, 3",,4', "", None, "none"]
    d = spark.createDataFrame([("s", k, float(k), f) for k, f in enumerate(fields)], "session_id string, frame long, t double, ids string")
    monkeypatch.setattr(R, "poses", lambda *_: d)
    found = sorted((r.frame, r.id) for r in R.detected(spark, "").collect())
    assert found == [(k, i) for k in range(6) for i in (3, 4)]
