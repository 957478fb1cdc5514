import pytest
from pyspark.sql import functions as F

from posegrain.functions.status import canonical_status

CASES = {
    "valid": "valid", " Valid\n": "valid", "VALID": "valid", '"valid"': "valid", "status=valid": "valid", "[valid] retry 2": "valid", "valid (11 inliers)": "valid", "valid;h-030": "valid", "vaild": "valid", "vlid": "valid", "vallid": "valid",
    "insufficient tags": "insufficient_tags", "insufficientTags": "insufficient_tags", "insufficien_ttags": "insufficient_tags", "insufficient_tags (2/4)": "insufficient_tags",
    "jump_rejected@13.9m/s": "jump_rejected", "jump_rejected: 3.90 m": "jump_rejected", "jum_prejected": "jump_rejected",
    "invalid": "invalid", "void": "void", "": None, "  ": None, "\t": None, None: None, "??": None,
}


def test_spellings(spark):
    d = spark.createDataFrame([(k,) for k in CASES], "s string").select("s", canonical_status(F.col("s")).alias("c"))
    assert {r.s: r.c for r in d.collect()} == CASES


@pytest.mark.parametrize("n", [10_000])
def test_long_text(spark, n):
    assert spark.createDataFrame([("valid " + "x" * n,)], "s string").select(canonical_status(F.col("s")).alias("c")).first().c == "valid"
