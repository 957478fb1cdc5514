"""Several values packed in one field: one row per value, with its place.

A finite-state tokenizer walks the field once. Its states are *between values*, *in a bare value* and
*in quotes*; within quotes a doubled quote or a backslash escapes. Brackets outside quotes only change the
nesting depth. Delimiters outside quotes end a value at any depth, so nested lists come out flat with
their depth beside them. The table is read once; rows already in the plain form (unsigned integers, single
spaces) are split as whole Arrow columns, and where only uneven ones are asked for never reach Python.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posegrain.session import map_rows

DELIMITERS = " \t\r\n\f\v,;|/"
OPENING, CLOSING = "[({<", "])}>"


def is_plain(field: Column) -> Column:
    """Unsigned integers separated by single spaces. Only single characters are matched, so fields of any length are safe."""
    return (field != "") & ~field.rlike("[^0-9 ]") & ~field.contains("  ") & ~field.startswith(" ") & ~field.endswith(" ")


class FieldTokenizer:
    """Transitions over lexemes; a lexeme is the longest text within which the state cannot change."""

    def __init__(self, delimiters: str = DELIMITERS, quotes: str = "\"'", escape: str = "\\"):
        d, b = re.escape(delimiters + "   　"), re.escape(OPENING + CLOSING)
        quoted = "|".join(f"{q}(?:[^{q}{re.escape(escape)}]|{re.escape(escape)}.|{q}{q})*(?:{q}|{re.escape(escape)}?\\Z)" for q in quotes)
        self.quotes, self.delimiters, self.escape = quotes, delimiters, escape
        self.lexeme = re.compile(f"(?P<quoted>{quoted})|(?P<delimiter>[{d}]+)|(?P<open>[{re.escape(OPENING)}])|(?P<close>[{re.escape(CLOSING)}])|(?P<bare>[^{d}{b}]+)", re.S)
        self.unescape = re.compile(re.escape(escape) + "(.)", re.S)
        self.blank = delimiters.replace(",", "").replace(";", "").replace("|", "").replace("/", "") + "   　"

    def _unquote(self, text: str) -> str:
        q = text[0]
        body = text[1:-1] if len(text) > 1 and text[-1] == q else text[1:]
        if q in body:
            body = body.replace(q + q, q)
        if self.escape in body:
            body = self.unescape.sub(r"\1", body)
        return body.strip(self.blank)

    def values(self, field: str) -> Iterator[tuple[str, int]]:
        """(value, depth) in the order written; empty slots and empty quotes hold no value."""
        depth = 0
        for m in self.lexeme.finditer(field):
            kind, text = m.lastgroup, m.group()
            if kind == "bare":
                yield text, depth
            elif kind == "quoted":
                if value := self._unquote(text):
                    yield value, depth
            else:
                depth = max(0, depth + (kind == "open") - (kind == "close"))


def split_packed(df: DataFrame, id_col: str, field_col: str, only_uneven: bool = False, tokenizer: FieldTokenizer | None = None) -> DataFrame:
    """One row per value: ``id_col``, ``value_no`` (int, from 1), ``tag_value`` (string), ``depth`` (int).

    NULL, empty and blank fields and fields of delimiters only give no row. Repeated ids are kept apart by
    their rows: each row is numbered on its own. ``only_uneven`` leaves out rows already in the plain form.
    Other columns of ``df`` are not read. A quote that is never closed runs to the end of the field.
    """
    rows = df.select(F.col(id_col).alias("_id"), F.col(field_col).alias("_field")).filter(F.col("_field").isNotNull() & (F.col("_field") != ""))
    id_type = df.schema[id_col].dataType.simpleString()
    if only_uneven:
        rows = rows.filter(~is_plain(F.col("_field")))
    machine = tokenizer or FieldTokenizer()
    names = ["_id", "value_no", "tag_value", "depth"]

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, fields = batch.column(0), batch.column(1)
            if not only_uneven and tokenizer is None:
                plain = pc.match_substring_regex(fields, "^[0-9]+( [0-9]+)*$")
                lists = pc.split_pattern(fields.filter(plain), " ")
                n = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
                at, total = np.repeat(np.arange(len(n)), n), int(n.sum())
                no = np.arange(total) - np.repeat(np.append(0, np.cumsum(n))[:-1], n) + 1
                yield pa.RecordBatch.from_arrays([ids.filter(plain).take(pa.array(at)), pa.array(no.astype(np.int32)), lists.flatten(), pa.array(np.zeros(total, np.int32))], names)
                ids, fields = (c.filter(pc.invert(plain)) for c in (ids, fields))
            at, no, value, deep = [], [], [], []
            for i, field in enumerate(fields.to_pylist()):
                for k, (v, d) in enumerate(machine.values(field), 1):
                    at.append(i)
                    no.append(k)
                    value.append(v)
                    deep.append(d)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(at, pa.int64())), pa.array(no, pa.int32()), pa.array(value, pa.string()), pa.array(deep, pa.int32())], names)

    return map_rows(rows, tokenize, f"_id {id_type}, value_no int, tag_value string, depth int").withColumnRenamed("_id", id_col)
