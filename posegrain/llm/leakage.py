"""Evaluation texts leaking into training text: MinHash containment search, then exact shingle containment.

Items are cut into passages of ``least`` words and indexed by the minima of many hash functions over their
word shingles. Every document, decoded, is cut into overlapping passages. Passages fall into classes by
size; for each class the number of hash functions follows from its upper size, the size of an item's
passage and the containment that must be found, so that short items are found inside documents of any
length. Minima shared by a document's passage and an item's make the pair a candidate. It is verified by exact
containment: of the shingles of some ``least`` successive words of the item the document must hold the share
``containment``. What is left is aligned, as the words must also follow each other: single ones excepted that
are misspelt or missing.

Shingles have three words, not five: single words may be misspelt or missing, and three slips in a passage
of twenty words break up to fifteen of its sixteen five-word shingles, but only nine of its eighteen three-word ones.

The items are the query set: blocks of at most ``BLOCK_ITEMS`` of them are sent to the executors one after
the other, each against all documents. Texts are decoded once, for several blocks into a checkpoint; with one
block the corpus is read in one pass without any shuffle. Only found pairs leave the tasks.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posegrain.llm import mailtext
from posegrain.session import cut_lineage, map_rows

SHINGLE = 3
STRIDE = 8
SIZES = (16, 32)  # upper sizes of the classes of passages, in shingles
BLOCK_ITEMS = 5_000
AGREE = 3  # minima that must agree
STEP = 2  # shingles between the passages of an item
SPARSE = 64  # bits of a filter per value in it

_U64 = np.uint64
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=_U64)


def functions_for(size: int, query: int, containment: float, recall: float = 0.999) -> int:
    """How many hash functions find, with ``recall``, a passage of ``size`` shingles that holds ``containment``
    of a query's ``query`` shingles: their similarity j is at least c·q / (q + size - c·q), and ``AGREE`` of
    the minima must be the same."""
    shared = containment * query
    j = shared / (query + size - shared)
    for b in range(AGREE, 256):
        if 1 - sum(math.comb(b, k) * j**k * (1 - j) ** (b - k) for k in range(AGREE)) >= recall:
            return b
    return 256


class WordHashes(dict):
    """Hashes of words, kept while there are few."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def shingle_hashes(word_hashes: np.ndarray, words: int = SHINGLE) -> np.ndarray:
    n = len(word_hashes) - words + 1
    if n <= 0:
        return np.zeros(0, _U64)
    with np.errstate(over="ignore"):
        s = word_hashes[:n] * _MIX[0]
        for k in range(1, words):
            s = (s ^ (s >> _U64(29))) * _MIX[k % 3] + word_hashes[k : n + k]
        return s ^ (s >> _U64(32))


def _permute(s: np.ndarray, k: int) -> np.ndarray:
    """The k-th hash function of 32-bit shingle hashes; one-to-one."""
    with np.errstate(over="ignore"):
        x = (s ^ np.uint32((k + 1) * 0x9E3779B9 & 0xFFFFFFFF)) * np.uint32((0x85EBCA6B + 2 * k * 0x27D4EB2F) & 0xFFFFFFFF | 1)
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        return x


def folded(s: np.ndarray) -> np.ndarray:
    return (s >> _U64(32)).astype(np.uint32)


def passages(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How to cut documents of ``lengths`` shingles, laid end to end, into passages.

    Starts of blocks of ``STRIDE`` shingles; for each passage the blocks it is made of (a matrix, with a
    block repeated where a document is shorter); and its document.
    """
    per = size // STRIDE
    blocks = -(-lengths // STRIDE)
    first = np.append(0, np.cumsum(lengths))[:-1]
    block_doc = np.repeat(np.arange(len(lengths)), blocks)
    block_no = np.arange(len(block_doc)) - np.repeat(np.append(0, np.cumsum(blocks))[:-1], blocks)
    starts = first[block_doc] + block_no * STRIDE
    opens = (block_no == 0) | (block_no + per <= blocks[block_doc])
    at = np.flatnonzero(opens)
    last = np.cumsum(blocks)[block_doc[at]] - 1
    return starts, np.minimum(at[:, None] + np.arange(per), last[:, None]), block_doc[at]


class ItemIndex:
    """The passages of a block of items, by the minima of each hash function, and their shingles."""

    def __init__(self, items: list[tuple[object, str]], least: int, containment: float):
        self.ids = [i for i, _ in items]
        self.words = [mailtext.words(t) for _, t in items]
        self.least, self.containment = least, containment
        self.query = query = least - SHINGLE + 1
        self.counts = [functions_for(size, query, containment) for size in SIZES]
        hashes = WordHashes()
        coded = [np.array([hashes[w] for w in words], dtype=_U64) for words in self.words]
        shingles = [shingle_hashes(c) for c in coded]
        folds = [folded(s) for s in shingles]
        # For each function the minima of all items' passages, and whose they are; plain arrays, as every task gets them.
        self.minima: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        windows = sum(max(1, len(s) // STEP) for s in folds)
        self.bits = min(26, max(12, math.ceil(math.log2(SPARSE * windows + 1))))
        self.seen = np.zeros((max(self.counts), 1 << (self.bits - 3)), np.uint8)
        for k in range(max(self.counts)):
            value, item = [np.zeros(0, np.uint32)], [np.zeros(0, np.int32)]
            for i, s in enumerate(folds):
                if len(s):
                    v = _permute(s, k)
                    m = v.min(keepdims=True) if len(v) <= query else np.append(np.lib.stride_tricks.sliding_window_view(v, query)[::STEP].min(axis=1), v[-query:].min())
                    value.append(m)
                    item.append(np.full(len(m), i, np.int32))
            pair = np.unique((np.concatenate(value).astype(np.int64) << 20) | np.concatenate(item))
            values, first = np.unique(pair >> 20, return_index=True)
            self.minima.append((values.astype(np.uint32), np.append(first, len(pair)), (pair & ((1 << 20) - 1)).astype(np.int32)))
            low = values.astype(np.uint32) >> np.uint32(32 - self.bits)
            np.bitwise_or.at(self.seen[k], low >> np.uint32(3), np.left_shift(1, low & np.uint32(7)).astype(np.uint8))
        # Each item's shingles as numbers of distinct ones, for exact containment.
        self.known = np.unique(np.concatenate([*shingles, np.zeros(0, _U64)]))
        self.numbers = [np.searchsorted(self.known, s) for s in shingles]
        # And the items of each: a shingle's are holders[ends[k] : ends[k + 1]], one entry for every time an item has it.
        every = np.concatenate([*self.numbers, np.zeros(0, np.int64)]).astype(np.int64)
        order = np.argsort(every, kind="stable")
        self.least_held = containment * np.minimum(query, [len(n) for n in self.numbers]) - 1e-9
        self.holders = np.repeat(np.arange(len(items)), [len(n) for n in self.numbers])[order]
        self.ends = np.searchsorted(every[order], np.arange(len(self.known) + 1))
        # What is shorter than a passage is too small for the estimates; exact containment alone finds it. What is
        # shorter than a shingle is looked up as a whole.
        size = np.array([len(w) for w in self.words], dtype=int)
        self.short, self.long = np.flatnonzero((size >= SHINGLE) & (size < least)), size >= least
        self.tiny: dict[int, dict[int, list[int]]] = {}
        for i, c in enumerate(coded):
            if 0 < len(c) < SHINGLE:
                self.tiny.setdefault(len(c), defaultdict(list))[int(shingle_hashes(c, len(c))[0])].append(i)
        self.seeds = [[tuple(w[j : j + SHINGLE]) for j in range(len(w) - SHINGLE + 1)] for w in self.words]

    def candidates(self, docs: list[np.ndarray]) -> list[tuple[int, int]]:
        """(document, item) where a passage of either shares ``AGREE`` minima or more; documents as word hashes."""
        return [(d, i) for d, items in self.near(docs).items() for i in items.tolist()]

    def near(self, docs: list[np.ndarray]) -> dict[int, np.ndarray]:
        """``candidates`` by document."""
        shingles = [folded(shingle_hashes(d)) for d in docs]
        lengths = np.array([len(s) for s in shingles], dtype=np.int64)
        out: dict[int, np.ndarray] = {}
        for c, (size, b) in enumerate(zip(SIZES, self.counts)):
            low_end = SIZES[c - 1] if c else 0
            own = np.flatnonzero((lengths > low_end) & ((lengths <= size) | (c == len(SIZES) - 1)))
            if not len(own):
                continue
            values = np.concatenate([shingles[i] for i in own])
            starts, made_of, doc = passages(lengths[own], size)
            got_passage, got_item = [], []
            for k in range(b):
                m = np.minimum.reduceat(_permute(values, k), starts)[made_of].min(axis=1)
                low = m >> np.uint32(32 - self.bits)
                hit = np.flatnonzero(self.seen[k][low >> np.uint32(3)] >> (low & np.uint32(7)).astype(np.uint8) & 1)
                known, ends, items = self.minima[k]
                if not len(hit) or not len(known):
                    continue
                at = np.minimum(np.searchsorted(known, m[hit]), len(known) - 1)
                same = known[at] == m[hit]
                at, hit = at[same], hit[same]
                n = ends[at + 1] - ends[at]
                got_passage.append(np.repeat(hit, n))
                got_item.append(items[np.repeat(ends[at] - np.append(0, np.cumsum(n))[:-1], n) + np.arange(n.sum())])
            if got_passage:
                key = np.concatenate(got_passage) * len(self.ids) + np.concatenate(got_item)
                pair, votes = np.unique(key, return_counts=True)
                pair = pair[votes >= AGREE]
                both = np.unique(doc[pair // len(self.ids)] * len(self.ids) + pair % len(self.ids))
                at, first = np.unique(both // len(self.ids), return_index=True)
                out |= dict(zip(own[at].tolist(), np.split(both % len(self.ids), first[1:])))
        return out

    def contained(self, doc: np.ndarray, items: list[int] | np.ndarray) -> list[int]:
        """Those of ``items`` with a passage of which the document (word hashes) holds the shingles: exact containment.

        Of items shorter than a passage the share counts over all their shingles.
        """
        if not len(items) or not len(self.known):
            return []
        s = np.unique(shingle_hashes(doc))
        at = np.minimum(np.searchsorted(self.known, s), len(self.known) - 1)
        hit = at[self.known[at] == s]
        # A passage cannot hold more of its item's shingles than the document holds of all of them.
        n = self.ends[hit + 1] - self.ends[hit]
        entry = np.repeat(self.ends[hit] - np.append(0, np.cumsum(n))[:-1], n) + np.arange(n.sum())
        whole = np.bincount(self.holders[entry], minlength=len(self.ids))
        held = np.zeros(len(self.known), np.int32)
        held[hit] = 1
        out = []
        for i in (items := np.asarray(items))[whole[items] >= self.least_held[items]].tolist():
            own = np.append(0, np.cumsum(held[self.numbers[i]]))
            n = min(self.query, len(own) - 1)
            if (own[n:] - own[:-n]).max() >= self.containment * n - 1e-9:
                out.append(i)
        return out

    def tiny_held(self, doc: np.ndarray) -> list[int]:
        """Items of fewer words than a shingle that the document holds."""
        out = []
        for n, table in self.tiny.items():
            for h in np.intersect1d(shingle_hashes(doc, n), np.array(list(table), dtype=_U64)).tolist():
                out += table[h]
        return out


def _alike(a: str, b: str) -> bool:
    """One slip apart: a letter wrong, missing, extra or two swapped. Numbers are alike only if equal."""
    if a == b:
        return True
    if a.isdigit() or b.isdigit() or abs(len(a) - len(b)) > 1 or min(len(a), len(b)) < 3:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    x, y = a[i:], b[i:]
    return x[1:] == y or x == y[1:] or x[1:] == y[1:] or (x[:1] == y[1:2] and x[1:2] == y[:1] and x[2:] == y[2:])


def _bridged(item: list[str], doc: list[str]) -> bool:
    """Whether what lies between two shared stretches is single words misspelt or missing, and nothing else."""
    if len(doc) > len(item) + 1 or len(item) > 4:
        return False
    if not item:
        return len(doc) <= 1
    if "".join(item) == "".join(doc):
        return True
    # Align within the gap: each item word alike or missing, no two missing in a row, no foreign word but one.
    missing = j = row = 0
    for w in item:
        if j < len(doc) and _alike(w, doc[j]):
            j, row = j + 1, 0
        else:
            missing, row = missing + 1, row + 1
            if row > 1:
                return False
    return j == len(doc) and (missing <= 1 or len(item) > 2)


def seed_places(doc: list[str]) -> dict[tuple, list[int]]:
    places = defaultdict(list)
    for p in range(len(doc) - SHINGLE + 1):
        places[tuple(doc[p : p + SHINGLE])].append(p)
    return places


def longest_passage(item: list[str], seeds: list[tuple], doc: list[str], places: dict[tuple, list[int]]) -> int:
    """The most successive words of the item that the document holds, single slips allowed.

    Shared seeds on one diagonal make stretches; stretches that follow each other in both texts are joined
    where ``_bridged`` says so.
    """
    runs: list[list[int]] = []  # item start, document start, length
    open_: dict[int, list[int]] = {}
    for j, seed in enumerate(seeds):
        for p in places.get(seed, ()):
            r = open_.get(p - j)
            if r is not None and r[0] + r[2] == j + SHINGLE - 1:
                r[2] += 1
            else:
                r = open_[p - j] = [j, p, SHINGLE]
                runs.append(r)
    by_end: dict[int, list[int]] = defaultdict(list)
    order = sorted(range(len(runs)), key=lambda k: (runs[k][1], runs[k][0]))
    reach, best = {}, 0
    for k in order:
        j, p, n = runs[k]
        first = j
        for end in range(p - 7, p + 2):
            for e in by_end.get(end, ()):
                j0, p0, n0 = runs[e]
                if j0 < j and j0 + n0 <= j + 1 and j - (j0 + n0) <= 6:
                    shift = max(0, j0 + n0 - j, p0 + n0 - p)
                    if reach[e] < first and _bridged_chain(item[j0 + n0 : j + shift], doc[p0 + n0 : p + shift]):
                        first = reach[e]
        reach[k] = first
        by_end[p + n].append(k)
        best = max(best, j + n - first)
    return best


def _bridged_chain(item: list[str], doc: list[str]) -> bool:
    """``_bridged``, or two such bridges with shared words between them."""
    if _bridged(item, doc):
        return True
    for i, w in enumerate(item):
        for d in range(max(0, i - 1), min(len(doc), i + 2)):
            if doc[d] == w and _bridged(item[:i], doc[:d]) and _bridged(item[i + 1 :], doc[d + 1 :]):
                return True
    return False


def decoded(documents: DataFrame, doc_col: str, text_col: str) -> DataFrame:
    """(``doc_col``, ``words``): each text decoded, its words with blanks between them."""
    doc_type = documents.schema[doc_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([" ".join(_words(t)) for t in batch.column(1).to_pylist()], pa.string())], [doc_col, "words"])

    return map_rows(documents.select(doc_col, text_col).filter(F.col(text_col).isNotNull()), run, f"`{doc_col}` {doc_type}, words string")


def _words(mail: str) -> list[str]:
    subject, parts = mailtext.texts(mail)
    return mailtext.words("\n".join([subject, *parts]))


def _blocks(items: DataFrame, size: int) -> Iterator[list[tuple]]:
    held: list[tuple] = []
    for r in items.toLocalIterator():
        held.append((r.i, r.t))
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held


def leaked_items(documents: DataFrame, items: DataFrame, doc_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", least: int = 20, slack: int = 3, containment: float = 0.4) -> DataFrame:
    """Distinct (``doc_col``, ``item_col``): documents that hold an item, or ``least`` successive words of it.

    A passage counts from ``least - slack`` words between its first and last word found, as slips at its ends
    do not show. An item shorter than that must be held whole. NULL and empty texts hold nothing. NULL ids of items are left
    out. Repeated rows give one pair. Whole decoded texts are searched, of any length, and whole items.
    """
    texts = items.select(F.col(item_col).alias("i"), F.col(item_text).alias("t")).filter(F.col("t").isNotNull() & F.col("i").isNotNull())
    several = texts.count() > BLOCK_ITEMS
    doc_type, item_type = documents.schema[doc_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    sc = documents.sparkSession.sparkContext
    source = cut_lineage(decoded(documents, doc_col, text_col)) if several else documents.select(doc_col, text_col).filter(F.col(text_col).isNotNull())
    split = str.split if several else _words
    found = documents.select(doc_col).limit(0).crossJoin(items.select(item_col).limit(0))
    for block in _blocks(texts, BLOCK_ITEMS):
        shared = sc.broadcast(ItemIndex(block, least, containment))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index, hashes = shared.value, WordHashes()
            for batch in batches:
                words = [split(text) for text in batch.column(1).to_pylist()]
                coded = [np.array([hashes[w] for w in ws], dtype=_U64) for ws in words]
                near, none = index.near(coded), np.zeros(0, int)
                docs, got = [], []
                for d in range(len(words)) if len(index.short) or index.tiny else near:
                    found_ = near.get(d, none)
                    held = index.contained(coded[d], np.concatenate([found_[index.long[found_]], index.short]))
                    places = seed_places(words[d]) if held else {}
                    held = [i for i in held if longest_passage(index.words[i], index.seeds[i], words[d], places) >= min(least - slack, len(index.words[i]))]
                    held += index.tiny_held(coded[d])
                    docs += [d] * len(held)
                    got += [index.ids[i] for i in held]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(docs, pa.int64())), pa.array(got, pa.from_numpy_dtype(np.int64) if item_type in ("bigint", "int") else None)], [doc_col, item_col])

        part = map_rows(source, search, f"`{doc_col}` {doc_type}, `{item_col}` {'bigint' if item_type == 'int' else item_type}")
        if several:
            part = cut_lineage(part)
            shared.destroy()
            found = found.unionByName(part)
        else:
            found = part
    return found.distinct()
