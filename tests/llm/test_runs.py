import numpy as np
import pytest
from pyspark.sql import functions as F

from posegrain.llm import runs


def brute(rows, step):
    out = []
    for s in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == s and r[1] is not None), key=lambda r: (r[1], r[2]))
        at = None
        for r in [*own, None]:
            if at and r and r[3] and r[3] == at[0][3] and round(r[1] - at[-1][1], 6) <= step:
                at.append(r)
                continue
            if at and len(at) >= 2:
                out.append((s, at[0][3], at[0][2], at[-1][2], len(at)))
            at = [r] if r and r[3] else None
    return sorted(out, key=str)


@pytest.mark.parametrize("piece", [3, 17, 200_000])
@pytest.mark.parametrize("seed", [0, 1])
def test_runs_over_pieces(spark, monkeypatch, piece, seed):
    monkeypatch.setattr(runs, "PIECE_ROWS", piece)
    rng = np.random.default_rng(seed)
    rows, i = [], 0
    for s, n in (("hot", 400), ("a", 30), (None, 20), ("b", 1)):
        t = np.cumsum(rng.choice([0.0, 0.5, 2.0, 3.0], n, p=[0.05, 0.8, 0.1, 0.05]))
        e = np.repeat(rng.choice(["v", "j", "", None], n), rng.integers(1, 9, n))[:n]
        for a, b in zip(t, e):
            rows.append((s, float(a), i, None if b is None else str(b)))
            i += 1
    rows += [("a", None, -1, "v"), ("a", None, -2, "v")]
    d = spark.createDataFrame(rows, "s string, t double, i long, e string").repartition(3)
    got = runs.event_runs(d, "s", ["t"], "e", "i")
    assert sorted(((r.s, r.event, r.first_i, r.last_i, r.n_rows) for r in got.collect()), key=str) == brute(rows, 2.0)


def test_empty_and_clashing_columns(spark):
    d = spark.createDataFrame([("s", 1.0, 1, "x", 5, 6), ("s", 2.0, 2, "x", 5, 6)], "s string, t double, i long, e string, n_rows int, event int")
    assert runs.event_runs(d, "s", ["t"], "e", "i").first().n_rows == 2
    assert runs.event_runs(d.limit(0), "s", ["t"], "e", "i").count() == 0
    long = d.withColumn("e", F.repeat(F.lit("y"), 100_000))
    assert runs.event_runs(long, "s", ["t"], "e", "i").first().duration_s == 1.0
    assert runs.event_runs(d.withColumn("e", F.lit(None).cast("string")), "s", ["t"], "e", "i").count() == 0


def test_more_kinds_than_symbols():
    codes = np.array([0, 0, runs.KINDS, runs.KINDS, 0, 5, 2 * runs.KINDS + 5, -1, 5])
    first, last = runs.spans(codes, np.zeros(len(codes), bool))
    assert list(zip(first.tolist(), last.tolist()))[:5] == [(0, 1), (2, 3), (4, 4), (5, 5), (6, 6)]
    text, _ = runs.symbols(np.arange(runs.KINDS), np.zeros(runs.KINDS, bool))
    assert len(set(text)) == runs.KINDS
