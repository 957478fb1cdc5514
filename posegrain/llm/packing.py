"""Filling containers of fixed capacity with documents: sum-of-squares packing.

Documents are measured in tokens of a public vocabulary. Each document goes to the fill level that makes
the sum of squared counts of partially filled containers smallest, an empty container being one of the
choices; the counts are kept in an array by level. A document is only split if it alone exceeds the
capacity: into full containers and a rest that is packed like a document.

Packing is sequential, so documents are dealt by a hash of their id into streams of about ``STREAM_ROWS``
documents, each packed on its own. Containers a stream leaves open are unpacked and packed once more, by the same
rule, together with those of ``JOINED`` streams, the largest pieces first.
"""

from __future__ import annotations

import base64
import functools
import os
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posegrain.session import cut_lineage, map_rows

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how the byte-level vocabularies split text before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
STREAM_ROWS = 20_000
JOINED = 32  # streams whose open containers are packed together
NEARLY_FULL = 0.99


@functools.lru_cache(maxsize=2)
def encoding(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(documents: DataFrame, doc_col: str, text_col: str, path: str = TOKENIZER) -> DataFrame:
    """(``doc_col``, ``n_tokens`` int); NULL and empty texts have 0."""
    doc_type = documents.schema[doc_col].dataType.simpleString()
    documents.sparkSession.sparkContext.addFile(path)
    name = os.path.basename(path)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(SparkFiles.get(name)).encode_ordinary
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(encode(t)) if t else 0 for t in batch.column(1).to_pylist()], pa.int32())], [doc_col, "n_tokens"])

    return map_rows(documents.select(doc_col, text_col), count, f"`{doc_col}` {doc_type}, n_tokens int")


class Levels:
    """Partially filled containers of one capacity, by how full they are: an array of counts by level and the levels in use."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.count = np.zeros(2 * capacity + 1, np.int64)
        self.used = np.zeros(0, np.int64)
        self.open: dict[int, list[int]] = defaultdict(list)
        self.made = 0

    def _change(self, level: int, by: int) -> None:
        self.count[level] += by
        n = self.count[level]
        if n == 0 or (n == 1 and by == 1):
            at = int(np.searchsorted(self.used, level))
            self.used = np.delete(self.used, at) if n == 0 else np.insert(self.used, at, level)

    def place(self, size: int) -> int:
        """The container an item of ``size`` goes to; 0 < size <= capacity."""
        room = self.capacity - size
        levels = self.used[: np.searchsorted(self.used, room, "right")]
        best = 0
        if len(levels):
            # A full container leaves the sum, so reaching the capacity, where no count is kept, adds nothing.
            change = 2 * (self.count[levels + size] - self.count[levels]) + 2
            if levels[-1] == room:
                change[-1] -= 1
            k = len(change) - 1 - int(np.argmin(change[::-1]))
            if change[k] <= 2 * self.count[size] + 1:
                best = int(levels[k])
        if best:
            container = self.open[best].pop()
            self._change(best, -1)
        else:
            container = self.made
            self.made += 1
        level = best + size
        if level < self.capacity:
            self._change(level, 1)
            self.open[level].append(container)
        return container

    def unfilled(self, least: float) -> set[int]:
        """Containers filled less than ``least``."""
        return {c for level, stack in self.open.items() if level < least * self.capacity for c in stack}


def pieces_of(size: int, capacity: int) -> list[tuple[int, int]]:
    """(first token, tokens) of each piece; one unless the item exceeds the capacity."""
    return [(a, min(capacity, size - a)) for a in range(0, size, capacity)]


def pack(documents: DataFrame, containers: dict[str, int], doc_col: str = "doc_id", text_col: str = "text", path: str = TOKENIZER, stream_rows: int = STREAM_ROWS) -> DataFrame:
    """Where each document goes, for each kind of container.

    Columns: ``container_kind``, ``container_id`` (string, unique within its kind), ``doc_col``, ``piece_no``
    (int, from 1; more than one only if the document exceeds the capacity), ``first_token`` and ``n_tokens``
    (long). Documents without tokens take no room and get no row. Repeated ids are packed each for itself.
    The same rows give the same containers however they are partitioned.
    """
    doc_type = documents.schema[doc_col].dataType.simpleString()
    sizes = cut_lineage(token_counts(documents, doc_col, text_col, path).filter("n_tokens > 0"))
    streams = max(1, round(sizes.count() / stream_rows))
    # Stated, as few bytes are much work here and would else be put together.
    tasks = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = f"container_kind string, container_id string, `{doc_col}` {doc_type}, piece_no int, first_token long, n_tokens long, stream int, is_open boolean"
    names = ["container_kind", "container_id", doc_col, "piece_no", "first_token", "n_tokens", "stream", "is_open"]

    def batch(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
        cols = list(zip(*rows)) if rows else [[]] * 8
        types = [pa.string(), pa.string(), id_type, pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One stream after the other, all kinds at once."""
        stream, levels, out, id_type = None, {}, {}, None

        def ended() -> Iterator[pa.RecordBatch]:
            for kind, rows in out.items():
                left = levels[kind].unfilled(NEARLY_FULL)
                yield batch([(kind, f"{stream}-{c}", d, no, a, n, stream, c in left) for c, d, no, a, n in rows], id_type)

        for b in batches:
            id_type = b.column(1).type
            for s, d, size in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if s != stream:
                    yield from ended()
                    stream, levels, out = s, {k: Levels(c) for k, c in containers.items()}, {k: [] for k in containers}
                for kind, capacity in containers.items():
                    for no, (a, n) in enumerate(pieces_of(size, capacity), 1):
                        out[kind].append((levels[kind].place(n), d, no, a, n))
        yield from ended()

    dealt = sizes.select(F.pmod(F.xxhash64(doc_col), F.lit(streams)).cast("int").alias("stream"), F.col(doc_col), "n_tokens")
    dealt = dealt.repartition(max(streams, tasks), "stream").sortWithinPartitions("stream", doc_col, "n_tokens")
    packed = cut_lineage(map_rows(dealt, first, schema))

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What was left open, largest pieces first, by the same rule."""
        key, level, out, id_type = None, None, [], None
        for b in batches:
            id_type = b.schema.field(doc_col).type
            r = b.to_pydict()
            for i in range(b.num_rows):
                k = (r["group"][i], r["container_kind"][i])
                if k != key:
                    yield batch(out, id_type)
                    key, level, out = k, Levels(containers[k[1]]), []
                out.append((k[1], f"g{k[0]}-{level.place(r['n_tokens'][i])}", r[doc_col][i], r["piece_no"][i], r["first_token"][i], r["n_tokens"][i], None, False))
        if id_type is not None:
            yield batch(out, id_type)

    left = packed.filter("is_open").withColumn("group", F.floor(F.col("stream") / JOINED)).repartition(max(tasks, len(containers) * (streams // JOINED + 1)), "group", "container_kind")
    left = left.sortWithinPartitions("group", "container_kind", F.desc("n_tokens"), doc_col, "first_token")
    result = packed.filter("NOT is_open").unionByName(map_rows(left, again, schema))
    return result.select(*names[:6])
