"""Ordered series cut into pieces of bounded size, and what the cuts leave over.

Rows are range-partitioned and sorted by (series, order), so a series of any length spreads over as many
partitions as it fills and no key is hot. A Python operator then sees one piece after the other. Only the
first and the last series of a piece can go on elsewhere; the operator hands these ends out as small
strips, and ``neighbours`` brings the two strips of each cut together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PIECE_ROWS = 200_000


def ordered(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Sorted partitions that follow each other; equal (keys, order) stay in one partition."""
    cols = [F.col(c) for c in [*keys, *order]]
    return df.repartitionByRange(*cols).sortWithinPartitions(*cols)


def pieces(batches: Iterator[pa.RecordBatch], rows: int = PIECE_ROWS) -> Iterator[tuple[int, int, pa.Table]]:
    """(partition, number in it, rows) of at most about ``rows`` rows each."""
    pid, seq, held, n = TaskContext.get().partitionId(), 0, [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= rows:
            yield pid, seq, pa.Table.from_batches(held).combine_chunks()
            seq, held, n = seq + 1, [], 0
    if held:
        yield pid, seq, pa.Table.from_batches(held).combine_chunks()


def key_starts(*columns: pa.ChunkedArray) -> np.ndarray:
    """Where a new key begins in sorted columns: positions, with the number of rows at the end."""
    n = len(columns[0])
    change = np.zeros(n, bool)
    change[0] = True
    for c in columns:
        codes = c.combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy() if isinstance(c, pa.ChunkedArray) else c.dictionary_encode(null_encoding="encode").indices.to_numpy()
        change[1:] |= codes[1:] != codes[:-1]
    return np.append(np.flatnonzero(change), n)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = PIECE_ROWS) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """(rows, group starts) of whole groups from batches sorted by ``keys``; about ``rows`` at a time, or one group if it is larger."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= rows:
            table = pa.Table.from_batches(held).combine_chunks()
            starts = key_starts(*[table[k] for k in keys])
            if len(starts) > 2:
                yield table.slice(0, starts[-2]).combine_chunks(), starts[:-1]
                held, n = table.slice(starts[-2]).to_batches(), int(starts[-1] - starts[-2])
    if n:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, key_starts(*[table[k] for k in keys])


def neighbours(strips: DataFrame, keys: list[str], carried: list[str]) -> DataFrame:
    """Each strip in a row with the one before it in its series: ``carried`` and the same as ``prev_*``.

    ``prev_at_end`` is NULL for a series' first strip, ``is_last`` true for its last. Strips are ordered by
    (pid, seq, at_end): a piece's head strip comes before its end strip. There are two strips per piece at
    most, so a series has one row here for some ``PIECE_ROWS`` / 2 of its rows.
    """
    w = Window.partitionBy(*keys).orderBy("pid", "seq", "at_end")
    before = [F.lag(c).over(w).alias(f"prev_{c}") for c in ["at_end", *carried]]
    return strips.select(*keys, "pid", "seq", "at_end", *carried, *before, F.lead("pid").over(w).isNull().alias("is_last"))
