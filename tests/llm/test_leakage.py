import base64

import numpy as np

from posegrain.llm import leakage as L

rng = np.random.default_rng(0)
NAMES = ["".join(rng.choice(list("bcdfgklmnprstv"), 1)[0] + rng.choice(list("aeiou"), 1)[0] for _ in range(3)) for _ in range(4000)]


def text(n):
    return " ".join(rng.choice(NAMES, n))


def test_found_in_any_form(spark):
    items = [(i, text(60)) for i in range(30)]
    w = [t.split() for _, t in items]
    docs, want = [], set()

    def add(body, item=None, head="Content-Type: text/plain\n"):
        docs.append((len(docs), f"Subject: x\n{head}\n{text(80)} {body} {text(300)}" if "base64" not in head else f"Subject: x\n{head}\n{base64.encodebytes((text(40) + ' ' + body + ' ' + text(40)).encode()).decode()}"))
        if item is not None:
            want.add((len(docs) - 1, item))

    add(items[0][1], 0)
    add(" ".join(w[1][10:34]).upper() + ".", 1)
    add("\n> ".join(" ".join(w[2][i : i + 6]) for i in range(0, 60, 6)), 2)
    add(items[3][1], 3, "Content-Type: text/plain\nContent-Transfer-Encoding: base64\n")
    add("<b>" + "</b>, <i>x</i>".join([" ".join(w[4][5:30])]) + "</b>", 4, "Content-Type: text/html\n")
    slips = list(w[5][20:44])
    slips[6] = slips[6][1] + slips[6][0] + slips[6][2:]
    del slips[14]
    add(" ".join(slips), 5)
    add(" ".join(w[6][10:21]))  # eleven words: no case
    other = list(w[7])
    for k in range(3, 60, 6):
        other[k] = NAMES[k]
    add(" ".join(other))  # the same phrasing about other names
    for _ in range(40):
        add("")
    docs += [(900, None), (901, ""), (902, "Subject: y\n\n" + text(40_000) + " " + items[8][1])]
    want.add((902, 8))
    d = spark.createDataFrame(docs + docs[:1], "doc_id long, text string").repartition(3)
    i = spark.createDataFrame([*items, (99, None), (98, "")], "item_id long, text string")
    assert {tuple(r) for r in L.leaked_items(d, i).collect()} == want
    assert L.leaked_items(d, i).count() == len(want)
    assert L.leaked_items(d.limit(0), i).count() == 0 and L.leaked_items(d, i.limit(0)).count() == 0


def test_short_items_must_be_whole(spark):
    items = [(1, "seven small words make one short item"), (2, "one two"), (3, "only three words"), (4, "Solitary!"), (5, "small words")]
    docs = [(4, text(9) + " one-two " + text(9)), (5, text(9) + " one, " + text(3) + " solitary"), (1, text(50) + " Seven small words, make one short item! " + text(50)), (2, text(30) + " seven small words " + text(30)), (3, text(300) + " only three words")]
    got = L.leaked_items(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.collect())) == [(1, 1), (1, 5), (2, 5), (3, 3), (4, 2), (5, 4)]


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(L, "BLOCK_ITEMS", 4)
    items = [(i, text(60)) for i in range(11)]
    d = spark.createDataFrame([(i, t) for i, t in items], "doc_id long, text string")
    got = L.leaked_items(d, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.collect())) == [(i, i) for i in range(11)]


def test_minhash_finds_what_exact_containment_finds():
    items = [(i, text(80)) for i in range(200)]
    index = L.ItemIndex(items, 20, 0.4)
    hashes = L.WordHashes()
    docs, want = [], set()
    for d in range(300):
        i = int(rng.integers(200))
        w = items[i][1].split()
        a = int(rng.integers(0, 60))
        docs.append((text(int(rng.integers(5, 400))) + " " + " ".join(w[a : a + 20]) + " " + text(int(rng.integers(0, 400)))).split())
        want.add((d, i))
    got = set(index.candidates([np.array([hashes[w] for w in d], dtype=np.uint64) for d in docs]))
    assert len(want & got) >= 0.995 * len(want)


def test_recall_with_slips():
    """Against the exact alignment alone, over all pairs of passages of twenty words with up to three slips."""
    items = [(i, text(60)) for i in range(150)]
    index, hashes = L.ItemIndex(items, 20, 0.4), L.WordHashes()
    for slips in (1, 2, 3):
        found = accepted = 0
        for trial in range(100):
            i = int(rng.integers(150))
            a = int(rng.integers(0, 40))
            w = items[i][1].split()[a : a + 20]
            for k in np.linspace(0, 19, slips + 2)[1:-1].round().astype(int):
                w[k] = "" if trial % 2 else w[k][1] + w[k][0] + w[k][2:]
            doc = (text(200) + " " + " ".join(w) + " " + text(100)).split()
            if L.longest_passage(index.words[i], index.seeds[i], doc, L.seed_places(doc)) >= 17:
                coded = np.array([hashes[x] for x in doc], dtype=np.uint64)
                accepted += 1
                found += (0, i) in index.candidates([coded]) and index.contained(coded, [i]) == [i]
        assert accepted > 50 and found >= 0.98 * accepted


def test_long_items(spark):
    w = text(6_000).split()
    docs = [(a, f"{text(100)} {' '.join(w[a : a + 25])} {text(100)}") for a in (0, 4_090, 4_200, 5_500, 5_975)] + [(-1, text(300))]
    got = L.leaked_items(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, text(70)), (7, " ".join(w)), (8, text(90))], "item_id long, text string"))
    assert sorted(map(tuple, got.collect())) == [(a, 7) for a in (0, 4_090, 4_200, 5_500, 5_975)]


def test_passages_cover_documents():
    lengths = np.array([0, 1, 7, 8, 9, 31, 32, 33, 100])
    starts, made_of, doc = L.passages(lengths, 32)
    assert set(doc) == set(range(1, 9))
    values = np.arange(lengths.sum())[::-1].astype(np.uint32)
    low = np.minimum.reduceat(values, starts)[made_of].min(axis=1)
    ends = np.cumsum(lengths)
    for d in range(1, 9):
        own = values[ends[d] - lengths[d] : ends[d]]
        assert low[doc == d].min() == own.min()
