"""As-of, nearest and interpolating joins on time.

``bracket`` is the one join behind all of them: for each query the samples before and after it. It is a
union, one shuffle and sort by (source, block of time) and running windows; samples across a block's edge come from
one row per block. There is no range join and no window over a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posegrain.operators.ordered import blocked, last_rows


def bracket(queries: DataFrame, samples: DataFrame, keys: list[str], query_time: str, sample_time: str, values: list[str], side: str = "left") -> DataFrame:
    """Adds ``lo`` and ``hi``, structs (t, ``values``): the samples around each query's time, both NULL without samples.

    As for a sorted search that is clipped to the inside: with ``side`` left, ``hi`` is the first sample at
    or after the query, with right the first after it; ``lo`` is the one before ``hi``. Before the first
    sample both are the first two; after the last, ``hi`` is NULL and ``lo`` the last. Samples with one time
    count in the order of their values. Rows of ``queries`` all stay that have a time, in any number; their columns keep their names.
    """
    s = samples.select(*keys, F.col(sample_time).cast("double").alias("_t"), *[F.col(v).alias(v) for v in values])
    s = s.select(*keys, "_t", F.struct(F.col("_t").alias("t"), *values).alias("_s"), F.lit(None).cast(queries.select(F.struct(*queries.columns)).schema[0].dataType).alias("_q"))
    q = queries.select(*keys, F.col(query_time).cast("double").alias("_t"), F.lit(None).cast(s.schema["_s"].dataType).alias("_s"), F.struct(*queries.columns).alias("_q"))
    return _around(q.unionByName(s), keys, side)


def bracket_self(df: DataFrame, keys: list[str], time: str, at: Column, is_sample: Column, values: list[str], side: str = "left") -> DataFrame:
    """``bracket`` of a table with itself, which is read once: each row asks at ``at``; those with ``is_sample`` are the samples."""
    whole, t = F.struct(*df.columns), F.col(time).cast("double")
    sample = F.struct(t.alias("t"), *values)
    types = df.select(sample.alias("s"), whole.alias("q")).schema
    none = lambda c: F.lit(None).cast(types[c].dataType)
    query = F.struct(at.cast("double").alias("_t"), none("s").alias("_s"), whole.alias("_q"))
    other = F.struct(t.alias("_t"), sample.alias("_s"), none("q").alias("_q"))
    both = df.withColumn("_e", F.explode(F.when(F.coalesce(is_sample, F.lit(False)), F.array(query, other)).otherwise(F.array(query))))
    return _around(both.select(*keys, "_e.*"), keys, side)


def _around(both: DataFrame, keys: list[str], side: str) -> DataFrame:
    """``both``: keys, ``_t`` and either a sample ``_s`` or a query ``_q``. One shuffle of the rows, one of a small row per block."""
    # With side left a query sorts before a sample of its time, with side right after it.
    kind = F.when(F.col("_s").isNotNull(), 1).otherwise(0 if side == "left" else 2)
    order = ["_t", "_kind", "_s"]
    d = blocked(both.filter(F.col("_t").isNotNull()).withColumn("_kind", kind), keys, order).drop(*keys)
    over = "OVER (PARTITION BY _g ORDER BY _t, _kind, _s"
    up = f"{over} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    d = d.withColumns({
        "_l": F.expr(f"last_value(_s) IGNORE NULLS {up}"), "_r": F.expr(f"lead(_s) IGNORE NULLS {over})"),
        "_first": F.expr(f"first_value(_s) IGNORE NULLS {up}"), "_second": F.expr(f"nth_value(_s, 2) IGNORE NULLS {up}"), "_more": F.expr(f"lead(1) {over})"),
    })
    source = f"OVER ({'PARTITION BY ' if keys else ''}{', '.join(f'_k{i}' for i in range(len(keys)))} ORDER BY _block"
    ends = last_rows(d, keys, "_l", "_first", "_second").withColumnRenamed("_l", "_last")
    ends = ends.withColumn("_pair", F.expr(f"CASE WHEN _first IS NOT NULL THEN struct(_first AS own, coalesce(_second, lead(_first) IGNORE NULLS {source})) AS after) END"))
    ends = ends.select("_g", F.expr(f"last_value(_last) IGNORE NULLS {source} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)").alias("_lb"), F.expr(f"lead(_pair) IGNORE NULLS {source})").alias("_rb"), F.col("_pair.after").alias("_after"))
    found = d.filter(F.col("_q").isNotNull()).select("_g", "_q", "_l", "_r").join(ends, "_g", "left")
    left, right = F.coalesce("_l", "_lb"), F.coalesce(F.col("_r"), F.col("_rb.own"))
    # Before the first sample: that and the one after it.
    low = F.when(left.isNotNull(), left).otherwise(right)
    high = F.when(left.isNotNull(), right).when(F.col("_r").isNotNull(), F.col("_after")).otherwise(F.col("_rb.after"))
    return found.select("_q.*", low.alias("lo"), high.alias("hi"))


def covered(time: Column, max_gap: float | None) -> Column:
    """Whether a query lies between its two samples and these are at most ``max_gap`` apart."""
    inside = (F.col("lo.t") <= time) & (time <= F.col("hi.t"))
    if max_gap is not None:
        inside &= F.col("hi.t") - F.col("lo.t") <= max_gap
    return F.coalesce(inside, F.lit(False))


def share(time: Column) -> Column:
    """How far a query is on its way from ``lo`` to ``hi``; 0 where they have one time."""
    span = F.col("hi.t") - F.col("lo.t")
    return F.when(span > 0, (time - F.col("lo.t")) / span).otherwise(0.0)


def linear(time: Column, value: str) -> Column:
    return F.col(f"lo.{value}") + share(time) * (F.col(f"hi.{value}") - F.col(f"lo.{value}"))


def clamped(time: Column, value: str) -> Column:
    """Linear, with the first and last value outside the samples."""
    return F.when(F.col("hi").isNull() | (F.col("hi.t") < time), F.coalesce(F.col(f"hi.{value}"), F.col(f"lo.{value}"))).when(time <= F.col("lo.t"), F.col(f"lo.{value}")).otherwise(linear(time, value))


def nearest(time: Column, later_on_tie: bool = False) -> Column:
    """The nearer of the two samples (a struct); on a tie the earlier, or the later."""
    a, b = F.abs(time - F.col("lo.t")), F.abs(F.col("hi.t") - time)
    first = a < b if later_on_tie else a <= b
    return F.when(F.col("hi").isNull() | first, F.col("lo")).otherwise(F.col("hi"))


def partner_at(df: DataFrame, keys: list[str], time: str, values: list[str], delta: float, tolerance: float) -> DataFrame:
    """For each row the row nearest to ``delta`` later: adds ``other`` (struct t, values), NULL if none is within ``tolerance``.

    The partner lies after the row; on a tie it is the earlier.
    """
    found = bracket_self(df, keys, time, F.col(time) + delta, F.lit(True), values)
    other, at = nearest(F.col(time) + delta), F.col(time) + delta
    ok = (F.abs(other["t"] - at) <= tolerance) & (other["t"] > F.col(time))
    return found.withColumn("other", F.when(ok, other)).drop("lo", "hi")


def overlapping(df: DataFrame, keys: list[str], start: str, end: str, id_col: str) -> DataFrame:
    """Pairs of intervals within ``keys`` that overlap, each once: ``keys``, ``first_<id>``, ``second_<id>``, ``overlap_s``.

    Intervals are sent to the stretches of time they cover, as long as the longest tenth of them, and meet there; a pair counts where
    the later one begins. So only intervals near each other in time are compared, by an equi-join. The first starts first, by id on a tie.
    """
    d = df.select(*keys, F.col(start).cast("double").alias("a"), F.col(end).cast("double").alias("b"), F.col(id_col).alias("id")).filter(F.col("b") > F.col("a"))
    width = d.agg(F.expr("percentile_approx(b - a, 0.9, 1000)")).first()[0] or 1.0
    at = lambda c: F.floor(F.col(c) / width)
    first = d.withColumn("_at", F.explode(F.sequence(at("a"), at("b"))))
    second = d.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("a").alias("a2"), F.col("b").alias("b2"), F.col("id").alias("id2"), at("a").alias("_at2"))
    on = (F.col("_at") == F.col("_at2")) & (F.struct("a", "id") < F.struct(F.col("a2").alias("a"), F.col("id2").alias("id"))) & (F.least("b", "b2") > F.col("a2"))
    for k in keys:
        on &= F.col(k) == F.col(f"_{k}")
    return first.join(second, on).select(*keys, F.col("id").alias(f"first_{id_col}"), F.col("id2").alias(f"second_{id_col}"), (F.least("b", "b2") - F.col("a2")).alias("overlap_s"))
