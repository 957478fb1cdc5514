import numpy as np
from pyspark.sql import functions as F

from posegrain.llm import quantiles as Q

SHARES = {"p1": 0.01, "p50": 0.5, "p90": 0.9, "p100": 1.0}


def rank_error(x, value, share, tol):
    """How many ranks the value is away from what was asked; values within the cell's tolerance count as equal."""
    want = max(1, int(np.ceil(share * len(x))))
    low, high = (x < value - tol).sum() + 1, (x <= value + tol).sum()
    return max(0, low - want, want - high)


def test_rank_error_is_bounded_and_survives_merging(spark):
    rng = np.random.default_rng(0)
    parts = [(g, p, float(v)) for g in ("a", "b") for p in range(6) for v in np.round(rng.lognormal(p / 3, 1.5, 3000) * rng.choice([-1, 1], 3000, p=[0.1, 0.9]), 4)]
    d = spark.createDataFrame(parts, "g string, p int, x double").repartition(5)
    error = 0.02
    small = Q.digest(d, ["g", "p"], Q.measure_cell(F.col("x")), error)
    k = Q.BITS / error
    assert small.groupBy("g", "p").count().agg(F.max("count")).first()[0] <= 3 * k
    for digests, keys in ((Q.merge_digests(small, ["g"], error), ["g"]), (small, ["g", "p"]), (Q.merge_digests(Q.merge_digests(small, ["g", "p"], error), ["g"], error), ["g"])):
        for r in Q.percentiles(digests, keys, SHARES).collect():
            x = np.array([v for g, p, v in parts if g == r.g and (keys == ["g"] or p == r.p)])
            assert r.n == len(x)
            for name, share in SHARES.items():
                value = float(Q.measure_value(np.array([r[name]]))[0])
                assert rank_error(x, value, share, 0.0015 * abs(value)) <= error * len(x) + 1


def test_counts_are_exact_where_few(spark):
    x = [0, 1, 1, 2, 5, 70_000, None]
    d = spark.createDataFrame([(v,) for v in x], "x int")
    r = Q.percentiles(Q.digest(d.withColumn("g", F.lit(1)), ["g"], Q.count_cell(F.col("x"))), ["g"], {"m": 0.5, "top": 1.0}).first()
    assert (r.n, r.m, r.top) == (6, 1, 65_535)


def test_values_survive_the_cells(spark):
    v = [0.0, 1e-12, 0.3, -0.3, 7.25, 1e6, -1e12]
    d = spark.createDataFrame([(i, x) for i, x in enumerate(v)], "i int, x double").withColumn("c", Q.measure_cell(F.col("x")))
    got = [r.y for r in d.select("i", Q.measured(F.col("c")).alias("y")).orderBy("i").collect()]
    for a, b in zip(v, got):
        assert abs(a - b) <= 0.0007 * abs(a) + 1e-9 or abs(a) > 2**32
    cells = [r.c for r in d.orderBy("x").collect()]
    assert cells == sorted(cells)


def test_null_groups_and_empty(spark):
    d = spark.createDataFrame([(None, 1.0), (None, 1.0), ("a", None)], "g string, x double")
    got = Q.percentiles(Q.digest(d, ["g"], Q.measure_cell(F.col("x"))), ["g"], {"m": 0.5}).collect()
    assert [(r.g, r.n) for r in got] == [(None, 2)]
    assert Q.percentiles(Q.digest(d.limit(0), ["g"], Q.measure_cell(F.col("x"))), ["g"], {"m": 0.5}).count() == 0


def test_chunks_end_with_groups(spark, monkeypatch):
    monkeypatch.setattr(Q, "CHUNK_ROWS", 7)
    d = spark.range(1000).select((F.col("id") % 40).alias("g"), F.col("id").cast("double").alias("x"))
    got = Q.percentiles(Q.digest(d, ["g"], Q.measure_cell(F.col("x")), 0.5), ["g"], {"m": 0.5}).collect()
    assert len(got) == 40 and {r.n for r in got} == {25}
