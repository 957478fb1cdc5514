"""Repeated consecutive events: each run comes out once, with its count and duration.

Canonical events become Unicode code points, the rows of a sorted piece one string, and a backreference
regex matches the repetitions in it; match spans lead back to row numbers. A separator code point stands
where a run must end: between sources, at steps longer than ``max_step_s`` and for rows without an event.
Pieces are bounded (see ``posegrain.operators.pieces``): a source with a third of all rows is spread over
as many of them as it fills, and only the runs at a piece's ends are joined afterwards.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from posegrain.operators.pieces import PIECE_ROWS, key_starts, ordered, pieces
from posegrain.session import cut_lineage, map_rows

SEPARATOR = "\0"
REPEATED = re.compile(r"([^\0])\1*", re.S)
# Private-use code points first, then the supplementary private planes. Beyond ``KINDS`` kinds of events in a
# piece code points are used again; neighbours that share one are kept apart by a separator.
FIRST, SECOND = 0xE000, 0xF0000
KINDS = 6400 + 0x110000 - SECOND


def symbols(codes: np.ndarray, breaks: np.ndarray) -> tuple[str, np.ndarray]:
    """The string for rows with event numbers ``codes`` (-1: none), and the row of each of its characters.

    A separator precedes each row where ``breaks`` is true and stands in place of a row without an event.
    """
    kind = codes % KINDS
    points = np.where(codes < 0, 0, np.where(kind < 6400, kind + FIRST, kind - 6400 + SECOND)).astype("<u4")
    shared = np.append(False, (points[1:] == points[:-1]) & (codes[1:] != codes[:-1]))[: len(codes)]
    at = np.flatnonzero(breaks | shared)
    text = np.insert(points, at, 0).tobytes().decode("utf-32-le")
    return text, np.insert(np.arange(len(codes)), at, -1)


def spans(codes: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last row of each run, single rows included, as the regex finds them."""
    text, row = symbols(codes, breaks)
    found = np.array([m.span() for m in REPEATED.finditer(text)], dtype=np.int64).reshape(-1, 2)
    return row[found[:, 0]], row[found[:, 1] - 1]


def event_runs(df: DataFrame, source: str, order: list[str], event: str, id_col: str, max_step_s: float | None = 2.0, least: int = 2) -> DataFrame:
    """Longest runs of ``least`` or more successive equal events per source.

    Columns: ``source``, ``event``, ``first_<id_col>``, ``last_<id_col>``, ``n_rows``, ``start_s``,
    ``duration_s`` (last time less first). ``order`` is the time in seconds, then what orders ties. Rows
    without a time take no part; NULL and empty events belong to no run and end one; so does a step of more
    than ``max_step_s`` (compared to the microsecond; None: steps do not matter). NULL sources form one source; an empty table gives no
    rows. Other columns are not read.
    """
    source_type, id_type = df.schema[source].dataType.simpleString(), df.schema[id_col].dataType.simpleString()
    rows = df.filter(F.col(order[0]).isNotNull() & ~F.isnan(F.col(order[0]).cast("double")))
    rows = rows.select(F.col(source).alias("_source"), F.col(order[0]).cast("double").alias("_o0"), *[F.col(c).alias(f"_o{k}") for k, c in enumerate(order) if k], F.col(event).cast("string").alias("_event"), F.col(id_col).alias("_id"))
    rows = ordered(rows, ["_source"], [*[f"_o{k}" for k in range(len(order))], "_id"]).select("_source", "_o0", "_event", "_id")

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pid, seq, table in pieces(batches, PIECE_ROWS):
            n, t = table.num_rows, table["_o0"].to_numpy()
            starts = key_starts(table["_source"])[:-1]
            kinds = table["_event"].combine_chunks().dictionary_encode()
            codes = kinds.indices.fill_null(-1).to_numpy().astype(np.int64)
            for k, name in enumerate(kinds.dictionary.to_pylist()):
                if name == "":
                    codes[codes == k] = -1
            breaks = np.zeros(n, bool)
            breaks[starts] = True
            if max_step_s is not None:
                breaks[1:] |= np.round(np.diff(t), 6) > max_step_s
            first, last = spans(codes, breaks)
            # A piece's first and last run may go on in the next piece. Where its first or last row has no
            # event that row stands in, so that nothing is joined across it.
            ends = np.unique([0, n - 1])
            bare = ends[codes[ends] < 0]
            first, last = np.concatenate([first, bare]), np.concatenate([last, bare])
            opens, closes = first == 0, last == n - 1
            keep = opens | closes | (last - first + 1 >= least)
            first, last, opens, closes = first[keep], last[keep], opens[keep], closes[keep]
            a, b = pa.array(first), pa.array(last)
            m = len(first)
            yield pa.RecordBatch.from_arrays(
                [
                    table["_source"].combine_chunks().take(a), pc.take(kinds.dictionary, pa.array(np.where(codes[first] < 0, 0, codes[first]), mask=codes[first] < 0)), table["_id"].combine_chunks().take(a), table["_id"].combine_chunks().take(b),
                    pa.array(last - first + 1), pa.array(t[first]), pa.array(t[last]), pa.array(np.full(m, pid, np.int32)), pa.array(np.full(m, seq, np.int32)), pa.array(opens), pa.array(closes),
                ],
                ["_source", "_event", "first_id", "last_id", "n_rows", "start_s", "end_s", "pid", "seq", "opens", "closes"],
            )

    schema = f"_source {source_type}, _event string, first_id {id_type}, last_id {id_type}, n_rows long, start_s double, end_s double, pid int, seq int, opens boolean, closes boolean"
    found = cut_lineage(map_rows(rows, match, schema))

    # At most two runs per piece are open; a source's open runs are few however many rows it has.
    w = Window.partitionBy("_source").orderBy("pid", "seq", F.col("closes").cast("int"), "start_s")
    open_runs = found.filter(F.col("opens") | F.col("closes"))
    step = F.lit(True) if max_step_s is None else F.round(F.col("start_s") - F.lag("end_s").over(w), 6) <= max_step_s
    joined = F.coalesce(F.col("opens") & F.lag("closes").over(w) & (F.col("_event") == F.lag("_event").over(w)) & step, F.lit(False))
    chained = open_runs.withColumn("_new", (~joined).cast("long")).withColumn("_chain", F.sum("_new").over(w))
    merged = chained.groupBy("_source", "_chain").agg(
        F.min_by("_event", F.struct("pid", "seq", "start_s")).alias("_event"), F.min_by("first_id", F.struct("pid", "seq", "start_s")).alias("first_id"), F.max_by("last_id", F.struct("pid", "seq", "end_s")).alias("last_id"), F.sum("n_rows").alias("n_rows"), F.min("start_s").alias("start_s"), F.max("end_s").alias("end_s")
    )
    cols = ["_source", "_event", "first_id", "last_id", "n_rows", "start_s", "end_s"]
    runs = found.filter(~F.col("opens") & ~F.col("closes")).select(cols).unionByName(merged.select(cols))
    runs = runs.filter(F.col("_event").isNotNull() & (F.col("n_rows") >= least))
    return runs.select(F.col("_source").alias(source), F.col("_event").alias("event"), F.col("first_id").alias(f"first_{id_col}"), F.col("last_id").alias(f"last_{id_col}"), "n_rows", "start_s", (F.col("end_s") - F.col("start_s")).alias("duration_s"))
