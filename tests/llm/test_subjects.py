import numpy as np

from posegrain.llm import subjects as S

AREAS = ["law", "music", "travel", "general"]
TERMS = {
    "law": ["deed", "statute", "plaintiff", "injunction", "witness", "affidavit"], "music": ["cello", "oboe", "encore", "choir", "rehearsal", "soprano"],
    "travel": ["ferry", "visa", "hostel", "luggage", "itinerary", "boarding"], "general": ["office", "reply", "desk", "addressees", "delivered", "away"],
}
TERMS = {s: [w + e for w in ws for e in ("", "an", "et")] for s, ws in TERMS.items()}
FRAMES = ["please send me the {} by noon", "the {} is older than the {}", "we had questions about the {}", "nobody told them about the {}", "i would rather lose the {}"]


def corpus(n, seed=0):
    rng = np.random.default_rng(seed)
    docs, truth = [], {}
    for i in range(n):
        own = set(rng.choice(AREAS[:3], 1 + int(rng.random() < 0.2), replace=False)) if rng.random() < 0.85 else {"general"}
        lines = []
        for s in own:
            for _ in range(5):
                f = FRAMES[int(rng.integers(len(FRAMES)))]
                lines.append(f.format(*rng.choice(TERMS[s], f.count("{}"))))
        if rng.random() < 0.3:
            lines.append(f"it felt like a {rng.choice(TERMS[AREAS[int(rng.integers(3))]])} only longer")
        docs.append((i, "Subject: hello\n\n" + ". ".join(lines) + "."))
        truth[i] = own
    labels = [(i, s.upper() + " " if rng.random() < 0.2 else s) for i in range(0, n, 4) for s in truth[i]]
    wrong = rng.choice(len(labels), len(labels) // 20, replace=False)
    labels = [(d, AREAS[int(rng.integers(4))] if k in set(wrong) else s) for k, (d, s) in enumerate(labels)] + [(0, "nonsense"), (None, "law")]
    return docs, truth, labels


def test_held_out_accuracy(spark):
    docs, truth, labels = corpus(800)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {}
    rows = S.subject_areas(d, AREAS, spark.createDataFrame(labels, "doc_id long, subject string")).collect()
    for r in rows:
        got.setdefault(r.doc_id, set()).add(r.subject)
    assert set(got) == set(truth)
    held = [i for i in truth if i % 4]
    assert np.mean([got[i] == truth[i] for i in held]) > 0.95
    assert all(abs(sum(r.share for r in rows if r.doc_id == i) - 1) < 1e-9 for i in held[:50])


def test_odd_input(spark):
    docs, _, labels = corpus(200, 1)
    d = spark.createDataFrame([*docs, (900, None), (901, ""), (902, "Subject: x\n\n" + "deed " * 30_000)], "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, subject string")
    got = {}
    for r in S.subject_areas(d, AREAS, lab).collect():
        got.setdefault(r.doc_id, set()).add(r.subject)
    assert got[900] == got[901] == {"general"} and got[902] == {"law"}
    assert {r.subject for r in S.subject_areas(d, AREAS, lab.limit(0)).collect()} == {"general"}
    assert S.subject_areas(d.limit(0), AREAS, lab).count() == 0


def test_batches_and_partitions_do_not_matter(spark):
    docs, _, labels = corpus(600, 2)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, subject string")
    key, results = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before = spark.conf.get(key)
    try:
        for rows, parts in ((10_000, 1), (50, 4), (20, 7)):
            spark.conf.set(key, rows)
            results.append(sorted((r.doc_id, r.subject) for r in S.subject_areas(d.repartition(parts), AREAS, lab).collect()))
    finally:
        spark.conf.set(key, before)
    assert results[0] == results[1] == results[2]


def test_mixture_decides():
    """Two anchors of one subject and one of another give both; soft terms go where the anchors are, and alone give none."""
    c = np.array([[1, 0, 0], [0, 1, 0], [0.6, 0.4, 0]], np.float32)
    rows, terms = np.array([0, 0, 0, 0, 1, 1]), np.array([0, 0, 1, 2, 2, 2])
    mass = S.masses(rows, terms, c, np.where(terms < 2, 1.0, 0.1), 3)
    assert mass[0, 0] > 2.05 and 1.0 <= mass[0, 1] < 1.05 and mass[0, 2] == 0
    assert mass[1].max() < S.MASS and not mass[2].any()


def test_tally_keeps_counts(monkeypatch):
    monkeypatch.setattr(S, "HELD", 50)
    rng = np.random.default_rng(0)
    tally, got, want = S.Tally(0), {}, {}
    for _ in range(30):
        x = rng.integers(0, 200, 40).astype(np.uint64)
        for v in x.tolist():
            want[v] = want.get(v, 0) + 1
        for b in tally.add(x):
            for v, n in zip(b["term"].to_pylist(), b["n"].to_pylist()):
                got[v] = got.get(v, 0) + n
    for b in tally.flush():
        for v, n in zip(b["term"].to_pylist(), b["n"].to_pylist()):
            got[v] = got.get(v, 0) + n
    assert got == want
