import numpy as np
import pytest
from pyspark.sql import functions as F

from posegrain.llm import packing as P


def check(rows, capacity, sizes):
    used, pieces = {}, {}
    for r in rows:
        used[r.container_id] = used.get(r.container_id, 0) + r.n_tokens
        pieces.setdefault(r.doc_id, []).append((r.piece_no, r.first_token, r.n_tokens))
    assert max(used.values()) <= capacity
    assert set(pieces) == {d for d, n in sizes.items() if n}
    for d, p in pieces.items():
        p.sort()
        assert [x[0] for x in p] == list(range(1, len(p) + 1)) and sum(x[2] for x in p) == sizes[d]
        assert len(p) == 1 or sizes[d] > capacity
        assert all(a[1] + a[2] == b[1] for a, b in zip(p, p[1:]))
    return sum(used.values()) / (len(used) * capacity)


@pytest.mark.parametrize("stream_rows", [40, 20_000])
def test_pack(spark, stream_rows):
    rng = np.random.default_rng(0)
    texts = [(i, " word" * int(n)) for i, n in enumerate(rng.lognormal(4, 1, 400))] + [(400, None), (401, ""), (402, "x " * 40_000)]
    d = spark.createDataFrame(texts, "doc_id long, text string").withColumn("n_tokens", F.lit("clash")).repartition(3)
    sizes = {r.doc_id: r.n_tokens for r in P.token_counts(d, "doc_id", "text").collect()}
    assert sizes[400] == sizes[401] == 0
    got = P.pack(d, {"small": 128, "large": 4096}, stream_rows=stream_rows).collect()
    for kind, capacity in (("small", 128), ("large", 4096)):
        filled = check([r for r in got if r.container_kind == kind], capacity, sizes)
        assert filled > (0.9 if kind == "small" else 0.85)
    again = P.pack(d.repartition(7), {"small": 128, "large": 4096}, stream_rows=stream_rows).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    assert P.pack(d.limit(0), {"small": 128}).count() == 0


def test_levels_follow_the_rule():
    rng = np.random.default_rng(1)
    fast, capacity = P.Levels(20), 20
    slow = {}
    for size in rng.integers(1, 15, 500).tolist():
        fast.place(size)
        best = None
        for h in range(capacity, -1, -1):
            if h + size > capacity or (h and not slow.get(h)):
                continue
            after = dict(slow)
            if h:
                after[h] -= 1
            if h + size < capacity:
                after[h + size] = after.get(h + size, 0) + 1
            score = sum(v * v for v in after.values())
            if best is None or score < best[0]:
                best = (score, after)
        slow = best[1]
        assert {h: n for h, n in slow.items() if n} == {h: int(n) for h, n in enumerate(fast.count) if n}
