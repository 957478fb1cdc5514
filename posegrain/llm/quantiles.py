"""Percentiles of very large numeric columns from mergeable quantile digests.

Values are quantized to a bounded ordered universe of 2**BITS cells. A digest keeps counts on the nodes of
the dyadic tree over it: leaves at first, and wherever a node, its sibling and their parent hold less than
``n / k`` together, one count at the parent. Digests of any parts are merged by adding equal nodes and
compressing again. With ``k = BITS / error`` any percentile read off a digest, merged or not, has a rank
within ``error * n`` of the exact one, deterministically.

Rows are counted per cell before the first shuffle, so no group arrives as more than 2**BITS rows, however
many values it has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posegrain.operators.pieces import key_starts
from posegrain.session import map_rows

BITS = 16
#: Cells per power of two of a measured value: neighbouring cells differ by 0.14 %, a value from its cell's middle by half that.
STEPS = 511
HALF = 1 << (BITS - 1)
CHUNK_ROWS = 500_000


def count_cell(value: Column) -> Column:
    """The cell of a whole number of 0 or more: itself, the last cell from 65,535 on. Exact below that; NULL has none."""
    return F.when(value.isNotNull(), F.least(F.greatest(value.cast("long"), F.lit(0)), F.lit((1 << BITS) - 1)).cast("int"))


def measure_cell(value: Column) -> Column:
    """The cell of a measured value of any sign, by its logarithm: from 2**-32 to 2**32 at a relative error of 0.07 %.

    Smaller ones count as 0, larger ones as 2**32.
    """
    size = F.least(F.greatest(F.round(F.log2(F.abs(value)) * STEPS + 32 * STEPS), F.lit(0)), F.lit(HALF - 1.0))
    return (HALF + F.when(value == 0, 0).otherwise(F.signum(value) * size)).cast("int")


def measure_value(cell: np.ndarray) -> np.ndarray:
    """The middle of measured cells."""
    d = cell.astype(np.int64) - HALF
    return np.sign(d) * np.exp2(np.abs(d) / STEPS - 32)


def compress(group: np.ndarray, node: np.ndarray, count: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Digests of many groups at once, from the leaves up.

    ``group``: numbers from 0; ``limit``: for each group, what a node, its sibling and their parent must hold
    less than to become one. Nodes are numbered as in a heap: the root 1, the children of v are 2v and 2v+1.
    """
    width = BITS + 1
    key, at = np.unique((group.astype(np.int64) << width) | node, return_inverse=True)
    total = np.bincount(at, weights=count, minlength=len(key)).astype(np.int64)
    done_key, done_count = [], []
    level_of = np.frexp((key & ((1 << width) - 1)).astype(float))[1] - 1
    carried_key, carried = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for level in range(BITS, 0, -1):
        here = level_of == level
        k, at = np.unique(np.concatenate([key[here], carried_key]), return_inverse=True)
        c = np.bincount(at, weights=np.concatenate([total[here], carried]), minlength=len(k)).astype(np.int64)
        g = k >> width
        up = (g << width) | ((k & ((1 << width) - 1)) >> 1)
        parent, at = np.unique(up, return_inverse=True)
        both = np.bincount(at, weights=c, minlength=len(parent)).astype(np.int64)
        above = level_of == level - 1
        pos = np.searchsorted(key[above], parent)
        own = np.zeros(len(parent), np.int64)
        if above.any():
            inside = pos < above.sum()
            hit = inside & (key[above][np.minimum(pos, above.sum() - 1)] == parent)
            own[hit] = total[above][pos[hit]]
        merge = both + own < limit[parent >> width]
        stay = ~merge[at]
        done_key.append(k[stay])
        done_count.append(c[stay])
        carried_key, carried = parent[merge], both[merge]
    here = level_of == 0
    k, at = np.unique(np.concatenate([key[here], carried_key]), return_inverse=True)
    done_key.append(k)
    done_count.append(np.bincount(at, weights=np.concatenate([total[here], carried]), minlength=len(k)).astype(np.int64))
    k, c = np.concatenate(done_key), np.concatenate(done_count)
    order = np.argsort(k)
    return k[order] >> width, k[order] & ((1 << width) - 1), c[order]


def read_percentiles(node: np.ndarray, count: np.ndarray, shares: list[float]) -> np.ndarray:
    """The cells at ``shares`` of one digest: nodes in order of their upper end, smaller ones first."""
    level = np.frexp(node.astype(float))[1] - 1
    width = BITS - level
    upper = ((node + 1) << width) - 1 - (1 << BITS)
    order = np.lexsort((width, upper))
    reached = np.cumsum(count[order])
    want = np.maximum(1, np.ceil(np.array(shares) * reached[-1]))
    return upper[order][np.searchsorted(reached, want)]


def _chunks(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by ``keys``; a group has 2**(BITS+1) rows at most."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        if held.num_rows >= CHUNK_ROWS:
            last = int(key_starts(*[held[k] for k in keys])[-2])
            if last:
                yield held.slice(0, last).combine_chunks()
                held = held.slice(last)
    if held is not None and held.num_rows:
        yield held.combine_chunks()


def _compressed(nodes: DataFrame, keys: list[str], error: float) -> DataFrame:
    """Compress the summed node counts of each group: ``keys``, ``node``, ``node_count``."""
    k = BITS / error
    types = ", ".join(f"`{c}` {nodes.schema[c].dataType.simpleString()}" for c in keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _chunks(batches, keys):
            starts = key_starts(*[table[c] for c in keys])
            group = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
            count = table["node_count"].to_numpy()
            n = np.bincount(group, weights=count)
            g, node, c = compress(group, table["node"].to_numpy().astype(np.int64), count, np.floor(n / k))
            first = pa.array(starts[:-1][g])
            yield pa.RecordBatch.from_arrays([*[table[c_].combine_chunks().take(first) for c_ in keys], pa.array(node.astype(np.int32)), pa.array(c)], [*keys, "node", "node_count"])

    return map_rows(nodes.sortWithinPartitions(*keys), run, f"{types}, node int, node_count long")


def digest(df: DataFrame, keys: list[str], cell: Column, error: float = 0.01) -> DataFrame:
    """A digest per group: rows of ``keys``, ``node``, ``node_count``. NULL cells are left out; NULL keys are groups."""
    leaves = df.select(*keys, cell.alias("_cell")).filter(F.col("_cell").isNotNull())
    counts = leaves.groupBy(*keys, "_cell").agg(F.count(F.lit(1)).alias("node_count"))
    nodes = counts.select(*keys, (F.col("_cell") + (1 << BITS)).alias("node"), "node_count").repartition(*keys)
    return _compressed(nodes, keys, error)


def merge_digests(digests: DataFrame, keys: list[str], error: float = 0.01) -> DataFrame:
    """Digests of coarser ``keys`` by adding nodes; the same ``error`` holds for the result."""
    added = digests.groupBy(*keys, "node").agg(F.sum("node_count").alias("node_count")).repartition(*keys)
    return _compressed(added, keys, error)


def percentiles(digests: DataFrame, keys: list[str], shares: dict[str, float]) -> DataFrame:
    """``keys``, ``n`` and one cell (int) per name in ``shares``. Groups without values have no row."""
    types = ", ".join(f"`{c}` {digests.schema[c].dataType.simpleString()}" for c in keys)
    names, wanted = list(shares), list(shares.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _chunks(batches, keys):
            starts = key_starts(*[table[c] for c in keys])
            node, count = table["node"].to_numpy().astype(np.int64), table["node_count"].to_numpy()
            cells = np.array([read_percentiles(node[a:b], count[a:b], wanted) for a, b in zip(starts[:-1], starts[1:])]).reshape(-1, len(wanted))
            first = pa.array(starts[:-1])
            yield pa.RecordBatch.from_arrays([*[table[c].combine_chunks().take(first) for c in keys], pa.array(np.add.reduceat(count, starts[:-1])), *[pa.array(cells[:, i].astype(np.int32)) for i in range(len(names))]], [*keys, "n", *names])

    spread = digests.repartition(*keys).sortWithinPartitions(*keys)
    return map_rows(spread, run, f"{types}, n long, {', '.join(f'`{n}` int' for n in names)}")


def measured(cell: Column) -> Column:
    """The value a measured cell stands for, in the JVM; of the outermost cells only a bound is known, they give an infinity."""
    d = (cell - HALF).cast("double")
    return F.when(d == 0, 0.0).when(F.abs(d) >= HALF - 1, F.signum(d) * float("inf")).otherwise(F.signum(d) * F.pow(F.lit(2.0), F.abs(d) / STEPS - 32))


def counted(cell: Column) -> Column:
    """The whole number a counted cell stands for; infinity for the last cell, which holds all from 65,535 on."""
    return F.when(cell >= (1 << BITS) - 1, float("inf")).otherwise(cell.cast("double"))
