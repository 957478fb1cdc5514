"""Subject areas of documents by seeded non-negative factorization of the document-term matrix.

1. Terms: words and pairs of words of the decoded texts, as 64-bit hashes; document frequencies are counted
   over all documents, first of words, then of pairs of words that are neither too rare nor too common. Shares of
   documents alone bound the vocabulary: no document has more terms than words and pairs, so at most
   (terms of an average document) / ``RARE`` words pass.
2. Seeds: a bounded sample of hand-labelled documents says how often a term occurs in documents of each
   subject. Each subject is one component of the factorization, anchored to its seeds.
3. Alternating multiplicative updates (Kullback-Leibler form) over all documents: mixtures given components
   within each batch, components given mixtures as sums over the corpus. One update is one distributed pass
   over the term numbers kept from the text; only components travel, whose size the vocabulary bounds.
4. Anchors: a term that a component claims nearly alone is set to zero in all others, where multiplicative updates
   keep it. Contexts (the two and three words before) of anchors that mostly disagree with the rest of their
   document are those of comparisons, and are learned from all documents too; what follows them is no entry.
5. The last update of the mixtures, over all entries that remain, decides: a document deals with the subjects
   whose part of its mixture, in entries, is ``MASS`` or more.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posegrain.llm import mailtext
from posegrain.session import cut_lineage, map_rows

RARE, PAIR_RARE, COMMON = 2e-4, 2e-4, 0.35  # shares of documents
LABELLED = 50_000  # most labelled documents taken as seeds, by the hash of their id
ROUNDS = 3
ANCHOR = 3.0  # what a labelled document counts against others in the updates
DRAW = 0.3  # documents' worth of the corpus' usual rates in each component
SURE = 0.95  # p(subject | term) from which a term is an anchor of its subject
COMMON_ENOUGH, PAIR_ENOUGH = 1e-3, 4e-3  # shares of documents a word, or a pair of words, must be in to be an anchor
SOFT, POWER, MASS, STEPS = 0.1, 8, 0.5, 8  # what other terms weigh against anchors, by how specific they are; what a subject needs; updates of a last mixture
SOFTEST = 0.8  # p(subject | term) under which a term is no entry of the last mixture: it would weigh less than 0.002
PASSING_LEAST, PASSING_SHARE = 6, 0.45
HELD = 1 << 20  # counts a task keeps before it hands them on

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def pair_hashes(h: np.ndarray) -> np.ndarray:
    """Hashes of each word with the one after it."""
    with np.errstate(over="ignore"):
        return (h[:-1] * _A) ^ (h[1:] * _B + _A)


def context_hashes(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each place the hashes of the two words up to it, and of the three; 0 where the document has fewer."""
    out = np.zeros((len(h), 2), np.uint64)
    with np.errstate(over="ignore"):
        out[1:, 0] = np.where(doc[1:] == doc[:-1], (h[:-1] * _B + h[1:]) * _A, 0)
        out[2:, 1] = np.where(doc[2:] == doc[:-2], ((h[:-2] * _A + h[1:-1]) * _B + h[2:]) * _A, 0)
    return (out >> np.uint64(1)).astype(np.int64)


def document_words(mail: str, hashes: WordHashes) -> np.ndarray:
    subject, parts = mailtext.texts(mail)
    return np.array([hashes[w] for w in mailtext.prose_words(subject, parts)], dtype=np.uint64)


def listed(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of all lists end to end, and each value's list."""
    n = pa.compute.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
    return lists.flatten().to_numpy(), np.repeat(np.arange(len(lists)), n)


def words_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    h, doc = listed(batch.column(1))
    return h.view(np.uint64), doc


def _distinct(doc: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, term); terms are numbers below 2**32 or hashes."""
    order = np.lexsort((term, doc))
    d, t = doc[order], term[order]
    new = np.append(True, (d[1:] != d[:-1]) | (t[1:] != t[:-1])) if len(d) else np.zeros(0, bool)
    return d[new], t[new]


class Tally:
    """Counts of hashes within a task: merged as they come, handed on when they are many."""

    def __init__(self, kind: int):
        self.kind, self.held, self.n = kind, [], 0

    def add(self, key: np.ndarray) -> Iterator[pa.RecordBatch]:
        values, count = np.unique(key, return_counts=True)
        self.held.append((values, count))
        self.n += len(values)
        if self.n > HELD:
            yield from self.flush(HELD // 2)

    def flush(self, most: int = 0) -> Iterator[pa.RecordBatch]:
        """Merge what is held; hand it on where more than ``most`` differ."""
        if not self.held:
            return
        values, at = np.unique(np.concatenate([v for v, _ in self.held]), return_inverse=True)
        count = np.bincount(at, weights=np.concatenate([c for _, c in self.held]), minlength=len(values)).astype(np.int64)
        self.held, self.n = [(values, count)], len(values)
        if len(values) > most:
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), self.kind, np.int8)), pa.array(values.view(np.int64)), pa.array(count)], ["kind", "term", "n"])
            self.held, self.n = [], 0


class Vocabulary:
    def __init__(self, words: np.ndarray, pairs: np.ndarray):
        self.words, self.pairs = np.sort(words), np.sort(pairs)

    def __len__(self) -> int:
        return len(self.words) + len(self.pairs)

    @staticmethod
    def _find(table: np.ndarray, h: np.ndarray) -> np.ndarray:
        if not len(table):
            return np.full(h.shape, -1)
        at = np.minimum(np.searchsorted(table, h), len(table) - 1)
        return np.where(table[at] == h, at, -1)

    def numbers(self, h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each place the number of its word, and of the pair it begins, or -1."""
        # Words repeat far more than they differ, so each distinct one is looked up once.
        kinds, at = np.unique(h, return_inverse=True)
        w = self._find(self.words, kinds)[at]
        p = np.full(len(h), -1)
        if len(h) > 1:
            # A pair can only be in the vocabulary if both its words are.
            may = np.flatnonzero((w[:-1] >= 0) & (w[1:] >= 0) & (doc[:-1] == doc[1:]))
            p[may] = self._find(self.pairs, pair_hashes(h)[may])
            p[p >= 0] += len(self.words)
        return w, p


def update_mixtures(rows: np.ndarray, cols: np.ndarray, components: np.ndarray, weight: np.ndarray, n: int, steps: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Mixtures of ``n`` documents given components (terms x subjects), and each entry's share per subject."""
    k = components.shape[1]
    own, a = components[cols], weight[cols][:, None]
    w = np.full((n, k), 1 / k, np.float32)
    starts = np.flatnonzero(np.append(True, rows[1:] != rows[:-1])) if len(rows) else np.zeros(0, int)
    q = own
    for _ in range(steps):
        q = w[rows] * own
        q /= np.maximum(q.sum(1, keepdims=True), 1e-12)
        if len(starts):
            w[rows[starts]] = np.add.reduceat(a * q, starts, axis=0) + 1e-3
        w /= w.sum(1, keepdims=True)
    return w, q


def surely(components: np.ndarray) -> np.ndarray:
    """p(subject | term), every subject as likely as another."""
    return components / np.maximum(components.sum(1, keepdims=True), 1e-12)


def specificity(p: np.ndarray) -> np.ndarray:
    return (((p.max(1) - 1 / p.shape[1]) / (1 - 1 / p.shape[1])) ** 2).astype(np.float32)


def masses(rows: np.ndarray, terms: np.ndarray, components: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """The mixtures of ``n`` documents, not normalised: how many entries of each document each component explains."""
    k = components.shape[1]
    out = np.zeros((n, k))
    if len(rows):
        order = np.argsort(rows, kind="stable")
        rows, terms, weight = rows[order], terms[order], weight[order]
        own, w = components[terms].astype(np.float64), np.full((n, k), 1.0 / k)
        starts = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
        for _ in range(STEPS):
            q = w[rows] * own
            q *= weight[:, None] / np.maximum(q.sum(1, keepdims=True), 1e-300)
            w[rows[starts]] = out[rows[starts]] = np.add.reduceat(q, starts, axis=0)
    return out


def occurrences(doc: np.ndarray, w: np.ndarray, p: np.ndarray, subject_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From the numbers of each place's word and pair, places where a phrase of sure terms of one subject begins: document, subject, place.

    ``subject_of``: for each term the subject it surely stands for, or -1. A pair speaks for both its words.
    """
    subject_of = np.append(subject_of, -1)  # number -1: none
    s, of_pair = subject_of[w], subject_of[p]
    behind = np.append(-1, of_pair[:-1])
    s = np.where(of_pair >= 0, of_pair, np.where(behind >= 0, behind, s))
    begins = (s >= 0) & np.append(True, (s[1:] != s[:-1]) | (doc[1:] != doc[:-1]))[: len(s)]
    at = np.flatnonzero(begins)
    return doc[at], s[at], at


def subject_areas(
    documents: DataFrame, subjects: list[str], labels: DataFrame, doc_col: str = "doc_id", text_col: str = "text", label_col: str = "subject", rest: str = "general", labelled: int = LABELLED
) -> DataFrame:
    """One row per document and subject: ``doc_col``, ``subject``, ``mass`` (entries its component explains), ``share``.

    A subject counts where the document's mixture gives it ``MASS`` entries, as one anchor outside comparisons does;
    documents with none get ``rest``, also those with NULL or empty text. ``share`` is the subject's part of the mixture of
    those that count. Results don't depend on how rows are partitioned or batched.
    Labels are compared without case and blanks; unknown ones are left out. Repeated rows of a document give
    repeated rows. Without labels nothing is learned and every document gets ``rest``. At most ``labelled``
    labelled documents are taken as seeds; everything else is counted over all documents.
    """
    spark = documents.sparkSession
    sc = spark.sparkContext
    doc_type = documents.schema[doc_col].dataType.simpleString()
    docs = documents.select(F.col(doc_col).alias("_doc"), F.col(text_col).alias("_text"))
    number = {s: i for i, s in enumerate(subjects)}
    k, other = len(subjects), number[rest]

    clean = labels.select(F.col(doc_col).alias("d"), F.lower(F.trim(label_col)).alias("s")).filter(F.col("s").isin(subjects) & F.col("d").isNotNull())
    seeds: dict[object, np.ndarray] = {}
    sample = clean.select("d").distinct().orderBy(F.xxhash64("d")).limit(labelled)
    for r in clean.join(sample, "d", "left_semi").groupBy("d", "s").count().collect():
        seeds.setdefault(r.d, np.zeros(k, np.float32))[number[r.s]] += r["count"]
    # Labellers disagree and err: a subject weighs as many of a document's labels as name it.
    seeds = {d: v / v.sum() for d, v in seeds.items()}
    seed_docs = sc.broadcast(seeds)

    def to_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each text is decoded once; from here on its words are hashes."""
        hashes = WordHashes()
        for batch in batches:
            found = [document_words(t, hashes) if t else np.zeros(0, np.uint64) for t in batch.column(1).to_pylist()]
            ends = np.append(0, np.cumsum([len(f) for f in found])).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*found, np.zeros(0, np.uint64)]).view(np.int64)))], ["_doc", "words"])

    texts = cut_lineage(map_rows(docs, to_words, f"_doc {doc_type}, words array<long>"))

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Document frequencies within a task: kind 0 words, 2 the documents themselves."""
        tally, rows = Tally(0), 0
        for batch in batches:
            h, doc = words_of(batch)
            yield from tally.add(_distinct(doc, h)[1])
            rows += batch.num_rows
        yield from tally.flush()
        yield pa.RecordBatch.from_arrays([pa.array([2], pa.int8()), pa.array([0], pa.int64()), pa.array([rows], pa.int64())], ["kind", "term", "n"])

    def counts(run) -> DataFrame:
        return map_rows(texts, run, "kind tinyint, term long, n long").groupBy("kind", "term").agg(F.sum("n").alias("n"))

    def hashes_of(d: DataFrame) -> np.ndarray:
        return np.sort(d.select("term").toArrow()["term"].to_numpy().view(np.uint64))

    counted = cut_lineage(counts(count_words))
    total = counted.filter("kind = 2").agg(F.sum("n")).first()[0] or 0
    lowest, pair_lowest, highest = max(3, math.ceil(RARE * total)), max(8, math.ceil(PAIR_RARE * total)), COMMON * max(total, 40)
    kept = hashes_of(counted.filter((F.col("kind") == 0) & F.col("n").between(lowest, highest)))
    shared_words = sc.broadcast(kept)

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Document frequencies of pairs whose words are both in the vocabulary."""
        tally, table = Tally(1), shared_words.value
        for batch in batches:
            h, doc = words_of(batch)
            if len(h) > 1:
                ok = Vocabulary._find(table, h) >= 0
                both = ok[:-1] & ok[1:] & (doc[:-1] == doc[1:])
                yield from tally.add(_distinct(doc[:-1][both], pair_hashes(h)[both])[1])
        yield from tally.flush()

    vocabulary = Vocabulary(kept, hashes_of(counts(count_pairs).filter(F.col("n") >= pair_lowest)))
    shared_vocabulary = sc.broadcast(vocabulary)
    v = len(vocabulary)

    def number_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Distinct term numbers of each document."""
        vocab = shared_vocabulary.value
        for batch in batches:
            h, doc = words_of(batch)
            w, p = vocab.numbers(h, doc)
            d, t = _distinct(np.concatenate([doc[w >= 0], doc[p >= 0]]), np.concatenate([w[w >= 0], p[p >= 0]]))
            ends = np.append(0, np.cumsum(np.bincount(d, minlength=batch.num_rows)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(t.astype(np.int32)))], ["_doc", "terms"])

    matrix = cut_lineage(map_rows(texts, number_terms, f"_doc {doc_type}, terms array<int>"))

    def entries(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        cols, rows = listed(batch.column(1))
        return rows, cols

    def seeded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How often each term occurs in labelled documents of each subject, and in all."""
        known = seed_docs.value
        found, seen, mass = np.zeros((v, k)), np.zeros(v), np.zeros(k)
        for batch in batches:
            rows, cols = entries(batch)
            seen += np.bincount(cols, minlength=v)
            own = [known.get(d) for d in batch.column(0).to_pylist()]
            at = np.array([i for i, x in enumerate(own) if x is not None], dtype=int)
            if len(at):
                w = np.zeros((batch.num_rows, k))
                w[at] = [own[i] for i in at]
                labelled_entry = np.isin(rows, at)
                np.add.at(found, cols[labelled_entry], w[rows[labelled_entry]])
                mass += w.sum(0)
        yield summed(np.vstack([np.hstack([found, seen[:, None]]), np.append(mass, 0)]))

    def summed(m: np.ndarray) -> pa.RecordBatch:
        i = np.flatnonzero(m.any(1))
        return pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), *[pa.array(m[i, j]) for j in range(m.shape[1])]], ["i", *[f"x{j}" for j in range(m.shape[1])]])

    def gathered(run, columns: int) -> np.ndarray:
        """Sums over all documents of what ``run`` gives per task; (vocabulary + 1) x ``columns`` numbers."""
        out = np.zeros((v + 1, columns))
        names = [f"x{j}" for j in range(columns)]
        got = map_rows(matrix, run, "i int, " + ", ".join(f"{n} double" for n in names)).groupBy("i").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
        if got.num_rows:
            out[got["i"].to_numpy()] = np.stack([got[n].to_numpy() for n in names], 1)
        return out

    first = gathered(seeded, k + 1)
    found, seen, mass = first[:-1, :-1], first[:-1, -1], first[-1, :-1]
    usual = seen / max(total, 1)
    # Rates per document, drawn towards the corpus where there are few seeds.
    components = ((found + DRAW * usual[:, None]) / (mass + DRAW)).astype(np.float32)
    for _ in range(ROUNDS if seeds and v else 0):
        shared = sc.broadcast((components, specificity(surely(components))))

        def update(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            c, weight = shared.value
            use = weight > 0.05
            known = seed_docs.value
            sums, mixed = np.zeros((v, k)), np.zeros(k)
            for batch in batches:
                rows, cols = entries(batch)
                keep = use[cols]
                w, _ = update_mixtures(rows[keep], cols[keep], c, weight, batch.num_rows)
                # The anchors: labelled documents keep to their labels and count more.
                heavy = np.ones(batch.num_rows, np.float32)
                for i, d in enumerate(batch.column(0).to_pylist()):
                    if d in known:
                        w[i] = 0.2 * w[i] + 0.8 * known[d]
                        heavy[i] = ANCHOR
                q = w[rows] * c[cols]
                q *= heavy[rows][:, None] / np.maximum(q.sum(1, keepdims=True), 1e-12)
                for s in range(k):
                    sums[:, s] += np.bincount(cols, weights=q[:, s], minlength=v)
                mixed += (w * heavy[:, None]).sum(0)
            yield summed(np.vstack([sums, mixed]))

        sums = gathered(update, k)
        components = ((sums[:-1] + DRAW * usual[:, None]) / (sums[-1] + DRAW)).astype(np.float32)
        shared.unpersist()

    p = np.round(surely(components).astype(np.float64), 6)
    enough = np.where(np.arange(v) < len(vocabulary.words), max(6, COMMON_ENOUGH * total), max(8, PAIR_ENOUGH * total))
    subject_of = np.where((p.max(1) >= SURE) & (seen >= enough) & bool(seeds), p.argmax(1), -1)
    anchored = subject_of >= 0
    p[anchored] = np.eye(k)[subject_of[anchored]]
    weights = np.where(anchored, 1.0, np.where((seen >= enough) & (p.max(1) >= SOFTEST), SOFT * specificity(p) ** POWER, 0.0) * bool(seeds))
    subject_of[subject_of == other] = -1
    shared_subjects, shared_components = sc.broadcast(subject_of), sc.broadcast((p.astype(np.float32), weights))

    def before(h: np.ndarray, doc: np.ndarray, at: np.ndarray, reach: int) -> np.ndarray:
        """The contexts that end one to ``reach`` places before each place, within the document."""
        if not len(at):
            return np.zeros((0, 2 * reach), np.int64)
        context = context_hashes(h, doc)
        return np.hstack([np.where(((at >= b) & (doc[np.maximum(at - b, 0)] == doc[at]))[:, None], context[np.maximum(at - b, 0)], 0) for b in range(1, reach + 1)])

    def agreement(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For the contexts right before each phrase: how often they are there, and how often its subject is elsewhere in the document too."""
        for batch in batches:
            h, of = words_of(batch)
            doc, s, at = occurrences(of, *shared_vocabulary.value.numbers(h, of), shared_subjects.value)
            near = before(h, of, at, 1)
            n = np.bincount(doc, minlength=batch.num_rows)
            _, at = np.unique(doc * k + s, return_inverse=True)
            again = np.bincount(at)[at] > 1 if len(at) else np.zeros(0, bool)
            use = (near != 0) & (n[doc] > 1)[:, None]
            again = np.broadcast_to(again[:, None], near.shape)
            context, at = np.unique(near[use], return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(context), pa.array(np.bincount(at, minlength=len(context))), pa.array(np.bincount(at, weights=again[use], minlength=len(context)).astype(np.int64))], ["context", "n", "same"])

    contexts = map_rows(texts, agreement, "context long, n long, same long").groupBy("context").agg(F.sum("n").alias("n"), F.sum("same").alias("same"))
    passing = contexts.filter((F.col("n") >= F.lit(max(PASSING_LEAST, math.ceil(RARE * total)))) & (F.col("same") < PASSING_SHARE * F.col("n"))).select("context").toArrow()
    # As of terms, at most (phrases of an average document) / RARE.
    shared_passing = sc.broadcast(np.sort(passing["context"].to_numpy()))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, vocab, subject = shared_passing.value, shared_vocabulary.value, shared_subjects.value
        c, weight = shared_components.value
        for batch in batches:
            h, of = words_of(batch)
            w, pair = vocab.numbers(h, of)
            _, _, at = occurrences(of, w, pair, subject)
            single, double = (np.append(weight, 0.0)[t] for t in (w, pair))
            # A pair speaks for both its words; a phrase of one subject's anchors is one entry, at its first place.
            term = np.where(double >= np.maximum(single, 1e-12), pair, w)
            strong = np.append(subject, -1)
            is_anchor = (strong[w] >= 0) | (strong[pair] >= 0) | np.append(False, strong[pair[:-1]] >= 0)[: len(w)]
            first = np.zeros(len(h), bool)
            first[at] = True
            term[at] = np.where(strong[pair[at]] >= 0, pair[at], w[at])
            use = np.flatnonzero((term >= 0) & (first | ~is_anchor))
            use = use[np.append(weight, 0.0)[term[use]] > 0]
            if len(table):
                use = use[~(Vocabulary._find(table, before(h, of, use, 5)) >= 0).any(1)]
            mass = masses(of[use], term[use], c, weight[term[use]], batch.num_rows)
            mass[:, other] = 0.0
            held = mass >= MASS
            held[~held.any(1), other] = True
            d, s = np.nonzero(held)
            mass = np.where(held, mass, 0.0)
            share = mass[d, s] / np.maximum(mass.sum(1)[d], 1e-12)
            share = np.where(s == other, 1.0, share)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(d)), pa.array([subjects[i] for i in s], pa.string()), pa.array(mass[d, s]), pa.array(share)], [doc_col, "subject", "mass", "share"])

    return map_rows(texts, decide, f"`{doc_col}` {doc_type}, subject string, mass double, share double")
