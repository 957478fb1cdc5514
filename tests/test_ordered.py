import numpy as np
from pyspark.sql import functions as F

from posegrain.operators import asof, ordered
from posegrain.operators import trajectory as tr


def frame(spark, seed=0, n=300):
    rng = np.random.default_rng(seed)
    rows = []
    for s in ("a", "b", None):
        t = np.round(np.cumsum(rng.choice([0.0, 0.2, 1.0, 400.0], n, p=[0.1, 0.6, 0.25, 0.05])), 6)
        rows += [(s, float(v), i, float(rng.normal())) for i, v in enumerate(t)]
    return spark.createDataFrame(rows, "s string, t double, i long, x double").repartition(4), rows


def test_neighbours_and_sums_cross_blocks(spark):
    d, rows = frame(spark)
    n = {(r.s, r.i): r for r in ordered.neighbours(d, ["s"], ["t", "i"], ["i", "x"]).collect()}
    c = {(r.s, r.i): r for r in ordered.running_sum(d, ["s"], ["t", "i"], F.lit(1).cast("long"), "k", total="n").collect()}
    assert len(n) == len(rows) == len(c)
    for s, _, i, _ in rows:
        assert (n[s, i].prev.i if n[s, i].prev else None) == (i - 1 if i else None)
        assert (n[s, i].next.i if n[s, i].next else None) == (i + 1 if i < 299 else None)
        assert c[s, i].k == i + 1 and c[s, i].n == 300
    assert ordered.neighbours(d.limit(0), ["s"], ["t", "i"], ["x"]).count() == 0


def test_segments(spark):
    d, rows = frame(spark, 1)
    got = {(r.s, r.i): r.segment for r in ordered.gap_segments(d, ["s"], ["t", "i"], 0.65).collect()}
    for s in ("a", "b", None):
        k, last = 0, None
        for _, t, i, _ in [r for r in rows if r[0] == s]:
            k += last is None or t - last > 0.65
            assert got[s, i] == k
            last = t


def test_unwrap_matches_numpy(spark):
    rng = np.random.default_rng(3)
    a = (np.cumsum(rng.normal(0, 40, 400)) + 180) % 360 - 180
    d = spark.createDataFrame([("k", float(i * 3), i, float(v)) for i, v in enumerate(a)], "s string, t double, i long, a double")
    got = np.array([r.u for r in ordered.unwrapped(d, ["s"], ["t", "i"], "a", "u").orderBy("i").collect()])
    assert np.allclose(got, np.unwrap(a, period=360))


def test_bracket_matches_sorted_search(spark):
    rng = np.random.default_rng(5)
    q, s, rows_q, rows_s = [], [], [], []
    for k in range(6):
        st = np.sort(rng.integers(0, 2500, [0, 1, 2, 5, 40, 80][k])).astype(float)
        qt = rng.integers(-50, 2600, 60).astype(float)
        s.append(st)
        q.append(qt)
        rows_s += [(k, float(t), float(i)) for i, t in enumerate(st)]
        rows_q += [(k, float(t), i) for i, t in enumerate(qt)]
    dq, ds = spark.createDataFrame(rows_q, "k int, t double, i int"), spark.createDataFrame(rows_s, "k int, t double, v double")
    for side in ("left", "right"):
        got = {(r.k, r.i): r for r in asof.bracket(dq, ds, ["k"], "t", "t", ["v"], side=side).collect()}
        assert len(got) == len(rows_q)
        for k, t, i in rows_q:
            r, st = got[k, i], s[k]
            if not len(st):
                assert r.lo is None and r.hi is None
                continue
            at = max(int(np.searchsorted(st, t, side)), 1)
            lo, hi = at - 1, at
            assert r.lo.v == lo
            assert (r.hi.v if r.hi else None) == (hi if hi < len(st) else None)
    t = F.col("t")
    got = asof.bracket(dq, ds, ["k"], "t", "t", ["v"]).select("k", "i", "t", asof.nearest(t)["t"].alias("n"), F.when(asof.covered(t, 60), asof.linear(t, "t")).alias("x"), asof.clamped(t, "t").alias("c"))
    for r in got.collect():
        if len(s[r.k]):
            assert abs(r.n - r.t) == np.abs(s[r.k] - r.t).min()
            assert abs(r.c - np.clip(r.t, s[r.k][0], s[r.k][-1])) < 1e-9
            if r.x is not None:
                assert abs(r.x - r.t) < 1e-9


def test_swap_quarantine(spark):
    x = np.zeros(60)
    x[20:30] = 9.0
    x[50:] = -9.0
    d = spark.createDataFrame([("s", i * 0.05, i, float(v)) for i, v in enumerate(x)], "s string, t double, i long, x double")
    got = tr.swap_quarantine(d, ["s"], ["t", "i"], ["x"])
    assert sorted(r.i for r in got.filter("quarantined").collect()) == list(range(20, 30))


def test_loss_events(spark):
    ok = [0, 0, 1, 1, 0, 1, 0, 0]
    d = spark.createDataFrame([("s", float(i), i, bool(v)) for i, v in enumerate(ok)], "s string, t double, i long, ok boolean")
    got = sorted((r.start_s, r.recovered_s) for r in tr.loss_events(d, ["s"], ["t", "i"], F.col("ok")).collect())
    assert got == [(0.0, 2.0), (4.0, 5.0)]
    a = tr.visual_audit(d, ["s"], ["t", "i"], F.col("ok")).first()
    assert (a.n_losses, a.longest_loss_s, a.n_losses_after_lock, a.longest_after_lock_s) == (3, 2.0, 2, 2.0)


def test_sequential_jump_gate(spark):
    from posegrain.operators.smoothing import ema, jump_gate

    x = [0.0, 0.1, 5.0, 5.1, 0.2, None, 0.3]
    d = spark.createDataFrame([("s", float(i), i, v) for i, v in enumerate(x)], "s string, t double, i long, x double")
    assert [r.accepted for r in jump_gate(d, ["s"], ["t", "i"], ["x"], 1.0).orderBy("i").collect()] == [True, True, False, False, True, False, True]
    got = [r.m for r in ema(d.filter("x IS NOT NULL"), ["s"], ["t", "i"], "x", 0.5, "m", gap=1.5).orderBy("i").collect()]
    assert np.allclose(got, [0, 0.05, 2.525, 3.8125, 2.00625, 0.3])


def test_per_group_slices(spark, monkeypatch):
    d = spark.createDataFrame([(g, float(i), None if i == 2 else float(i * i)) for g in range(25) for i in range(g)], "g int, t double, x double").repartition(3)
    got = {(r.g, r.t): r.c for r in ordered.per_group(d, ["g"], ["t"], ["t", "x"], lambda t, x: [np.cumsum(t) + 0 * x], ["c"]).collect()}
    assert len(got) == sum(range(25))
    assert all(v is None if t == 2 else v == sum(range(int(t) + 1)) for (g, t), v in got.items())
    assert ordered.per_group(d.limit(0), ["g"], ["t"], ["x"], lambda x: [x], ["c"]).count() == 0


def test_whole_groups_hold_back_the_last():
    import pyarrow as pa

    from posegrain.operators.pieces import whole_groups

    key = np.repeat(np.arange(12), np.arange(12) + 1)
    batches = [pa.RecordBatch.from_arrays([pa.array(key[a : a + 5])], ["k"]) for a in range(0, len(key), 5)]
    seen = []
    for table, starts in whole_groups(iter(batches), ["k"], 9):
        seen += [table["k"][int(a)].as_py() for a in starts[:-1]]
        assert starts[-1] == table.num_rows
    assert seen == list(range(12))


def long_source(spark, n=6000, seed=4):
    """One source over many blocks, with gaps, resets and rejected jumps."""
    rng = np.random.default_rng(seed)
    t = np.cumsum(rng.choice([0.2, 0.3, 0.9, 700.0], n, p=[0.6, 0.37, 0.029, 0.001]))
    x = np.cumsum(rng.normal(0, 0.05, n)) + rng.choice([0, 5.0], n, p=[0.98, 0.02])
    rows = [("hot", float(a), i, None if rng.random() < 0.01 else float(b), float(w)) for i, (a, b, w) in enumerate(zip(t, x, (np.cumsum(rng.normal(0, 40, n)) + 180) % 360 - 180))]
    return rows, spark.createDataFrame(rows, "s string, t double, i long, x double, w double").repartition(5)


def test_split_sources_give_what_one_pass_gives(spark):
    from posegrain.operators.smoothing import ema, jump_gate

    rows, d = long_source(spark)
    mean, want, at, ref, ok = None, {}, None, None, {}
    for _, t, i, x, _w in rows:
        if x is None:
            mean, want[i], ok[i] = None, None, False
            continue
        mean = x if mean is None or t - at > 0.65 else 0.6 * mean + 0.4 * x
        at, want[i] = t, mean
        ok[i] = ref is None or not (abs(x - ref[1]) > 0.3 * (t - ref[0]) and x != ref[1])
        ref = (t, x) if ok[i] else ref
    for r in ema(d, ["s"], ["t", "i"], "x", 0.6, "m").collect():
        assert (r.m is None and want[r.i] is None) or abs(r.m - want[r.i]) < 1e-9, r
    assert {r.i: r.ok for r in jump_gate(d, ["s"], ["t", "i"], ["x"], 0.3, "ok").collect()} == ok


def test_chunks_give_what_whole_segments_give(spark):
    from posegrain.operators import smoothing as sm

    rng = np.random.default_rng(8)
    n = 1500
    t = np.cumsum(rng.uniform(0.05, 0.4, n))
    x = np.sin(t / 5) + rng.normal(0, 0.02, n)
    d = spark.createDataFrame([("s", float(a), i, float(b)) for i, (a, b) in enumerate(zip(t, x))], "s string, t double, i long, x double").repartition(3)
    whole, _ = sm.smooth_constant_velocity(t, x, 0.04, 0.8, 0.5)
    got = {r.i: r.x_smooth for r in sm.kalman_rts(d, ["s"], ["t", "i"], {"x": (0.04, 0.8, 0.5)}, "i", rows=200, halo=64).collect()}
    assert max(abs(got[k] - whole[k]) for k in range(n)) < 1e-9 and len(got) == n
    got = {r.i: r.x_smooth for r in sm.despiked(d, ["s"], ["t", "i"], ["x"], "i", rows=100).collect()}
    assert np.allclose([got[k] for k in range(n)], sm.despike_and_smooth(x))
    import posegrain.operators.ordered as o

    old, o.CHUNK = o.CHUNK, 128
    try:
        got = {r.i: r.m for r in o.centred_median(d, ["s"], ["t", "i"], "x", 2, "m", "i").collect()}
    finally:
        o.CHUNK = old
    assert np.allclose([got[k] for k in range(n)], [np.median(x[max(0, k - 2) : k + 3]) for k in range(n)])


def test_unwrapped_segments_over_blocks(spark):
    rows, d = long_source(spark, 3000, 6)
    got = {r.i: (r.segment, r.u, r.k) for r in ordered.unwrapped_segments(d, ["s"], ["t", "i"], 0.65, {"w": "u"}, "k").collect()}
    segment, at, last, out, k = 0, None, None, None, 0
    for _, t, i, _x, w in rows:
        if at is None or t - at > 0.65:
            segment, out, k = segment + 1, w, 0
        else:
            out, k = out + (w - last + 180) % 360 - 180, k + 1
        at, last = t, w
        assert got[i][0] == segment and abs(got[i][1] - out) < 1e-6 and got[i][2] == k


def exchanges(d):
    return d._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_plans_stay_small(spark, data):
    """Shuffles and scans of the plans as compiled; blocks are checkpointed with their layout, so rows go on without a shuffle."""
    from posegrain.plans import reference as R

    for name, most in (("ord_segments", 6), ("ord_unwrapped", 6), ("ord_kalman", 6), ("join_interpolated", 6), ("ord_visual_audit", 20), ("sync_time_offset", 20)):
        d = R.QUERIES[name](spark, data)
        plan = d._jdf.queryExecution().executedPlan().toString()
        assert exchanges(d) <= most and plan.count("Scan parquet") <= 4, (name, exchanges(d), plan.count("Scan parquet"))
