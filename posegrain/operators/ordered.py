"""Operators over ordered rows of a source, without ever putting a whole source in one task.

A source is cut into blocks of time. Rows are shuffled to (source, block) once; windows run within it. What must cross
a block's edge is carried by one small row per block, its last, and only these are put in order per source. So
a source with a third of all rows is spread over its blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql.window import WindowSpec
from pyspark.sql import functions as F

from posegrain.operators.pieces import whole_groups
from posegrain.session import cut_lineage_in_place, map_rows

BLOCK_S = 600.0


def with_group(df: DataFrame, keys: list[str], block: Column) -> DataFrame:
    """Adds ``_g``, the struct of ``keys`` and block. As one column it is what windows, sums and the join of a
    block's carried row all partition by, so rows are shuffled once; and within a struct NULL equals NULL."""
    return df.withColumn("_g", F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], block.alias("block")))


def time_block(time: str) -> Column:
    return F.floor(F.col(time) / BLOCK_S)


def last_rows(d: DataFrame, keys: list[str], *columns: str) -> DataFrame:
    """One small row per block, its last, where ``_more`` is NULL: ``_g``, ``_k0`` …, ``_block`` and ``columns``."""
    return d.filter(F.col("_more").isNull()).select("_g", *[F.col(f"_g.k{i}").alias(f"_k{i}") for i in range(len(keys))], F.col("_g.block").alias("_block"), *columns)


def blocked(df: DataFrame, keys: list[str], order: list[str], block: Column | None = None) -> DataFrame:
    """Adds ``_g``; rows shuffled by it once, in order, and written to the checkpoint folder.

    The checkpoint keeps the partitioning, so windows over ``_g``, and what is taken from a block's last row, need
    neither a shuffle nor a second run of what came before.
    """
    d = with_group(df, keys, time_block(order[0]) if block is None else block)
    return cut_lineage_in_place(d.repartition("_g").sortWithinPartitions("_g", *order))


def _windows(order: list[str]) -> tuple[WindowSpec, WindowSpec]:
    w = Window.partitionBy("_g").orderBy(*order)
    return w, w.rowsBetween(Window.unboundedPreceding, 0)


def _at_source(keys: list[str]) -> tuple[WindowSpec, WindowSpec]:
    """Blocks of a source in order, and those before each."""
    v = Window.partitionBy(*[f"_k{i}" for i in range(len(keys))]).orderBy("_block")
    return v, v.rowsBetween(Window.unboundedPreceding, -1)


def neighbours(df: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """Adds ``prev`` and ``next``, structs of ``columns`` of the rows before and after within ``keys``; NULL at the ends.

    ``order`` begins with the time and orders rows fully. Empty tables stay empty.
    """
    w, up = _windows(order)
    d = blocked(df, keys, order).withColumn("_s", F.struct(*columns))
    d = d.withColumns({"_p": F.lag("_s").over(w), "_more": F.lead("_s").over(w), "_first": F.first("_s").over(up)})
    v, _ = _at_source(keys)
    ends = last_rows(d, keys, "_s", "_first").select("_g", F.lag("_s").over(v).alias("_pb"), F.lead("_first").over(v).alias("_nb"))
    d = d.join(ends, "_g", "left")
    return d.withColumns({"prev": F.coalesce("_p", "_pb"), "next": F.coalesce("_more", "_nb")}).drop("_g", "_s", "_p", "_more", "_pb", "_nb", "_first")


def running_sum(df: DataFrame, keys: list[str], order: list[str], value: Column, name: str, block: Column | None = None, total: str | None = None) -> DataFrame:
    """Adds the sum of ``value`` over the rows up to and including each, in two levels, and on wish the sum of all.

    ``block`` cuts the order into stretches and must not fall along it; without it they are ``BLOCK_S`` of time.
    """
    w, up = _windows(order)
    d = blocked(df.withColumn("_v", value), keys, order, block)
    d = d.withColumns({"_in": F.sum("_v").over(up), "_more": F.lead(F.lit(1)).over(w)})
    v, before = _at_source(keys)
    whole = [F.sum("_in").over(v.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias(total)] if total else []
    blocks = last_rows(d, keys, "_in").select("_g", F.sum("_in").over(before).alias("_before"), *whole)
    d = d.join(blocks, "_g", "left")
    return d.withColumn(name, F.col("_in") + F.coalesce(F.col("_before"), F.lit(0))).drop("_g", "_v", "_in", "_before", "_more")


Step = Callable[[Column, Column], Column]


def scan(df: DataFrame, keys: list[str], order: list[str], columns: list[str], begins: Step, name: str = "segment", sums: dict[str, Step] | None = None, prev: bool = False) -> DataFrame:
    """One pass over ordered rows: stretches, sums within them, and on wish the row before.

    ``begins(before, row)`` says of the structs (``columns``) of two successive rows whether a new stretch begins; it is
    not NULL. Adds ``name``, the stretch's number from 1, and for each of ``sums`` the running sum of
    ``f(before, row)`` over the stretch's rows but its first, 0 there. A block's state travels in one small row.
    """
    sums = sums or {}
    w, up = _windows(order)
    d = blocked(df, keys, order).withColumn("_s", F.struct(*columns))
    d = d.withColumns({"_p": F.lag("_s").over(w), "_more": F.lead(F.lit(1)).over(w), "_first": F.first("_s").over(up)})
    d = d.withColumn("_b", F.when(F.col("_p").isNotNull(), begins(F.col("_p"), F.col("_s"))))
    inner = F.col("_p").isNotNull() & ~F.col("_b")
    d = d.withColumns({"_n": F.sum(F.coalesce(F.col("_b").cast("long"), F.lit(0))).over(up), **{f"_c_{k}": F.sum(F.when(inner, f(F.col("_p"), F.col("_s"))).otherwise(0)).over(up) for k, f in sums.items()}})
    if sums:
        d = d.withColumns({f"_a_{k}": F.last(F.when(F.col("_b"), F.col(f"_c_{k}")), ignorenulls=True).over(up) for k in sums})
    v, before = _at_source(keys)
    upto = v.rowsBetween(Window.unboundedPreceding, 0)
    e = last_rows(d, keys, "_s", "_first", "_n", *[f"_{x}_{k}" for k in sums for x in "ca"]).withColumn("_pl", F.lag("_s").over(v))
    e = e.withColumn("_fb", F.when(F.col("_pl").isNull(), True).otherwise(begins(F.col("_pl"), F.col("_first"))))
    e = e.withColumn("_seg", F.coalesce(F.sum(F.col("_fb").cast("long") + F.col("_n")).over(before), F.lit(0)) + F.col("_fb").cast("long"))
    carried = []
    for k, f in sums.items():
        e = e.withColumn(f"_f_{k}", F.when(F.col("_fb"), 0).otherwise(f(F.col("_pl"), F.col("_first"))))
        e = e.withColumn("_whole", F.sum(F.col(f"_f_{k}") + F.col(f"_c_{k}")).over(upto))
        at = F.col("_whole") - F.col(f"_c_{k}")  # what had been summed at the block's first row
        e = e.withColumn("_begun", F.when(F.col("_n") > 0, at + F.col(f"_a_{k}")).when(F.col("_fb"), at))
        # What the stretch that reaches into a block had summed before it, with the step to the block's first row.
        e = e.withColumn(f"_in_{k}", F.when(F.col("_fb"), 0).otherwise(at - F.last("_begun", ignorenulls=True).over(before)))
        carried.append(f"_in_{k}")
    e = e.select("_g", "_seg", *carried, *(["_pl"] if prev else []))
    d = d.join(e, "_g", "left").withColumn(name, F.col("_seg") + F.col("_n"))
    d = d.withColumns({k: F.when(F.col("_n") > 0, F.col(f"_c_{k}") - F.col(f"_a_{k}")).otherwise(F.col(f"_in_{k}") + F.col(f"_c_{k}")) for k in sums}) if sums else d
    if prev:
        d = d.withColumn("prev", F.coalesce("_p", "_pl"))
    return d.drop("_g", "_s", "_p", "_more", "_first", "_b", "_n", "_seg", "_pl", *carried, *[f"_{x}_{k}" for k in sums for x in "ca"])


def _longer(time: str, gap: float) -> Step:
    return lambda before, row: row[time] - before[time] > gap


def gap_segments(df: DataFrame, keys: list[str], order: list[str], gap: float, index: str | None = None) -> DataFrame:
    """Adds ``segment`` (from 1): a new one begins where the step from the row before is longer than ``gap``.

    ``index`` names a column for the row's place in its segment, from 0.
    """
    return scan(df, keys, order, [order[0]], _longer(order[0], gap), sums={index: lambda before, row: F.lit(1).cast("long")} if index else None)


def islands(df: DataFrame, keys: list[str], order: list[str], state: Column) -> DataFrame:
    """Adds ``state`` and ``island`` (from 1): a new one begins where the state changes. NULL states equal each other."""
    return scan(df.withColumn("state", state), keys, order, ["state"], lambda before, row: ~row["state"].eqNullSafe(before["state"]), "island")


def _turns(angle: str) -> Step:
    """Whole turns that a step of an angle hides; a step of exactly +180 stays +180."""

    def turns(before: Column, row: Column) -> Column:
        step = row[angle] - before[angle]
        turned = F.pmod(step + 180.0, F.lit(360.0)) - 180.0
        turned = F.when((turned == -180.0) & (step > 0), 180.0).otherwise(turned)
        return F.coalesce(F.round((turned - step) / 360.0), F.lit(0.0))

    return turns


def unwrapped_segments(df: DataFrame, keys: list[str], order: list[str], gap: float, angles: dict[str, str], index: str | None = None) -> DataFrame:
    """``gap_segments`` and in the same pass, for each angle in degrees, a column without jumps of more than 180 within its segment."""
    sums = {f"_turns_{a}": _turns(a) for a in angles}
    if index:
        sums[index] = lambda before, row: F.lit(1).cast("long")
    d = scan(df, keys, order, [order[0], *angles], _longer(order[0], gap), sums=sums)
    return d.withColumns({name: F.col(a) + 360.0 * F.col(f"_turns_{a}") for a, name in angles.items()}).drop(*[f"_turns_{a}" for a in angles])


def first_per_time(df: DataFrame, keys: list[str], time: str, tie: str) -> DataFrame:
    """Of rows with one time the first by ``tie``; a minimum, so repeated times never meet in one task."""
    rest = [c for c in df.columns if c not in (*keys, time)]
    first = df.groupBy(*keys, time).agg(F.min(F.struct(F.col(tie).alias("_tie"), *[F.col(c) for c in rest])).alias("_r"))
    return first.select(*keys, time, *[F.col(f"_r.{c}").alias(c) for c in rest])


def unwrapped(df: DataFrame, keys: list[str], order: list[str], angle: str, name: str) -> DataFrame:
    """Adds the angle in degrees with jumps of more than 180 taken out, beginning anew in each ``keys``.

    A step of exactly +180 stays +180. ``keys`` should hold a segment, so that nothing is carried over gaps.
    """
    return unwrapped_segments(df, keys, order, float("inf"), {angle: name}).drop("segment")


def evenly_spaced(df: DataFrame, keys: list[str], order: list[str], most: int) -> DataFrame:
    """At most ``most`` rows of each source, evenly spaced by rank: those of ranks round(k (n - 1) / (most - 1)), halves to even. A sampling operator."""
    d = running_sum(df, keys, order, F.lit(1).cast("long"), "_i", total="_n")
    place, step = F.col("_i") - 1, (F.col("_n") - 1) / float(most - 1)
    near = F.floor(F.try_divide(place, step))
    hit = F.lit(False)
    for k in (-1, 0, 1, 2):
        hit |= F.coalesce(F.bround((near + k) * step, 0) == place, F.lit(False)) & (near + k >= 0) & (near + k < most)
    return d.filter((F.col("_n") <= most) | F.coalesce(hit, F.lit(False))).drop("_i", "_n")


CHUNK, HALO = 4_096, 256


def chunked(df: DataFrame, index: str, rows: int | None = None, halo: int = HALO) -> DataFrame:
    """Cuts groups into chunks of ``rows`` rows by their place ``index`` (from 0): adds ``_chunk`` and ``_own``.

    ``halo`` rows of the chunks beside it come along with each chunk, ``_own`` false. A function of rows at most ``halo``
    away gives for a chunk's own rows what it gives for the whole group.
    """
    rows = rows or CHUNK
    own, at = F.floor(F.col(index) / rows), F.col(index) % rows
    to = F.array(own, F.when((at < halo) & (own > 0), own - 1), F.when(at >= rows - halo, own + 1))
    d = df.withColumn("_own_chunk", own).withColumn("_chunk", F.explode(F.filter(to, lambda c: c.isNotNull())))
    return d.withColumn("_own", F.col("_chunk") == F.col("_own_chunk")).drop("_own_chunk")


def centred_median(df: DataFrame, keys: list[str], order: list[str], value: str, radius: int, name: str, index: str) -> DataFrame:
    """Adds the median of the row and ``radius`` rows on either side within ``keys``, fewer at the ends; NULLs are left out.

    ``index``: the row's place in ``keys`` (from 0), by which long groups are cut into chunks.
    """
    w = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(-radius, radius)
    d = chunked(df, index, halo=radius).withColumn("_near", F.array_sort(F.collect_list(value).over(w))).filter("_own")
    n = F.size("_near")
    middle = (F.get("_near", F.floor((n - 1) / 2).cast("int")) + F.get("_near", F.floor(n / 2).cast("int"))) / 2
    return d.withColumn(name, middle).drop("_near", "_own", "_chunk")


def _spread(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Each group in one sorted partition. The number is stated, as few bytes can be much work for Python and would else be put together."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys).sortWithinPartitions(*keys, *order)


def sequential(df: DataFrame, keys: list[str], order: list[str], start: Callable[[], object], step: Callable[[object, dict], tuple], outputs: str) -> DataFrame:
    """One pass over a source's rows in order with a state that depends on its own output: for the few rows that stand for blocks.

    Rows stream through batch by batch with the state carried, so memory does not grow with a source.
    ``start()`` gives a source's first state; ``step(state, row)`` gives (state, output values). Adds the
    columns ``outputs`` (a schema string).
    """
    names = [c.split()[0] for c in outputs.split(", ")]
    kinds = [{"double": pa.float64(), "boolean": pa.bool_(), "long": pa.int64()}[c.split()[1]] for c in outputs.split(", ")]
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, fresh = None, None, True
        for batch in batches:
            got: list[tuple] = []
            for row in batch.to_pylist():
                key = tuple(row[k] for k in keys)
                if fresh or key != at:
                    at, state, fresh = key, start(), False
                state, out = step(state, row)
                got.append(out)
            columns = [pa.array([g[i] for g in got], kinds[i]) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *names])

    return map_rows(_spread(df, keys, order), run, f"{types}, {outputs}")


def per_group(df: DataFrame, keys: list[str], order: list[str], inputs: list[str], function: Callable[..., list[np.ndarray]], outputs: list[str]) -> DataFrame:
    """Adds double columns ``outputs``: ``function`` of each group's ``inputs`` (double arrays, NULL as NaN) in order.

    Groups are slices of Arrow columns, so many small ones cost little; ``keys`` should hold what bounds a
    group, as a segment does. Results that are NaN come out NULL.
    """
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, keys):
            values = [table[c].cast(pa.float64()).to_numpy() for c in inputs]
            got = [function(*(v[a:b] for v in values)) for a, b in zip(starts[:-1], starts[1:])]
            added = [pa.array(np.concatenate([g[i] for g in got]), pa.float64(), from_pandas=True) for i in range(len(outputs))]
            for batch in pa.Table.from_arrays([*[c.combine_chunks() for c in table.columns], *added], [*table.column_names, *outputs]).to_batches():
                yield batch

    return map_rows(_spread(df, keys, order), run, f"{types}, " + ", ".join(f"`{o}` double" for o in outputs))
