import numpy as np
from pyspark.sql import functions as F

from posegrain.operators.smoothing import jump_gate
from posegrain.streaming import gates


def test_streams_equal_batches(spark, tmp_path):
    rng = np.random.default_rng(0)
    rows = []
    for s in ("a", "b"):
        x = np.cumsum(rng.normal(0, 0.05, 60)) + (rng.random(60) < 0.1) * 5
        rows += [(s, float(i) * 0.2, float(v), "1 2" if i % 2 else "2 2 3") for i, v in enumerate(x)]
    schema = "s string, t double, x double, ids string"
    d = spark.createDataFrame(rows, schema)
    source = str(tmp_path / "in")
    d.filter("t < 6").coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(schema).parquet(source)
    q = gates.stream_jump_gate(stream, "s", "t", ["x"], 2.0).writeStream.format("memory").queryName("gated").outputMode("append").option("checkpointLocation", str(tmp_path / "c1")).start()
    n = gates.stream_tag_counts(stream, "s", "ids").writeStream.format("memory").queryName("tags").outputMode("complete").option("checkpointLocation", str(tmp_path / "c2")).start()
    try:
        q.processAllAvailable()
        d.filter("t >= 6").coalesce(1).write.mode("append").parquet(source)
        q.processAllAvailable()
        n.processAllAvailable()
        got = {(r.s, r.t): r.accepted for r in spark.sql("SELECT * FROM gated").collect()}
        want = {(r.s, r.t): r.accepted for r in jump_gate(d, ["s"], ["t"], ["x"], 2.0).collect()}
        assert got == want and len(got) == 120 and not all(got.values())
        assert {(r.s, r.id): r.n_frames for r in spark.sql("SELECT * FROM tags").collect()} == {(s, i): c for s in ("a", "b") for i, c in (("1", 30), ("2", 60), ("3", 30))}
    finally:
        q.stop()
        n.stop()


def test_late_rows_are_dropped_by_the_watermark(spark, tmp_path):
    d = spark.createDataFrame([("a", "2025-01-01 00:00:30", True), ("a", "2025-01-01 00:00:40", False)], "s string, at string, ok boolean").withColumn("at", F.to_timestamp("at"))
    source = str(tmp_path / "in")
    d.write.parquet(source)
    out = gates.stream_valid_ratio(spark.readStream.schema(d.schema).parquet(source), "s", "at", F.col("ok"))
    q = out.writeStream.format("memory").queryName("ratio").outputMode("update").option("checkpointLocation", str(tmp_path / "c")).start()
    try:
        q.processAllAvailable()
        assert spark.sql("SELECT valid_ratio, n FROM ratio").first() == (0.5, 2)
    finally:
        q.stop()
