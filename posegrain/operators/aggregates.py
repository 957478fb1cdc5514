"""Exact statistics per group that no hot group can hurt."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posegrain.operators.ordered import running_sum

STEPS = 64  # stretches per power of two of a value
DRAWN = 1 << 17  # blocks drawn at once


def _stretch(value: Column) -> Column:
    """A coarse, monotone number of the value, so that ranks are summed in bounded stretches."""
    size = F.when(value == 0, -1e6).otherwise(F.floor(F.log2(F.abs(value)) * STEPS))
    return F.when(value < 0, -(size + 1e6)).otherwise(size + 1e6).cast("long")


def percentiles(df: DataFrame, keys: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """Exact percentiles with the linear rule (rank p·(n-1), between the two values there); also ``n``.

    Equal values are counted before the shuffle; ranks are running sums over stretches of values, so a group
    of any size spreads over its stretches. NULL and NaN are left out; groups without values have no row.
    """
    counted = df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).groupBy(*keys, F.col(value).cast("double").alias("_x")).agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_sum(counted, keys, ["_x"], F.col("_n"), "_upto", block=_stretch(F.col("_x")), total="_total")
    at, ends = [], []
    for name, p in shares.items():
        pos = F.lit(float(p)) * (F.col("_total") - 1)
        for end, i in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            here = (F.col("_upto") - F.col("_n") <= i) & (i < F.col("_upto"))
            at.append(F.max(F.when(here, F.col("_x"))).alias(f"_{name}_{end}"))
        part = F.lit(float(p)) * (F.col("n") - 1)
        ends.append((F.col(f"_{name}_lo") + (part - F.floor(part)) * (F.col(f"_{name}_hi") - F.col(f"_{name}_lo"))).alias(name))
    return ranked.groupBy(*keys).agg(F.max("_total").alias("n"), *at).select(*keys, "n", *ends)


def error_stats(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``n``, mean, rmse, median, p95 and max per group. NULL and NaN are left out; empty groups have no row."""
    rows = df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    plain = rows.groupBy(*keys).agg(F.avg(value).alias("mean"), F.sqrt(F.avg(F.col(value) * F.col(value))).alias("rmse"), F.max(value).alias("max"))
    exact = percentiles(rows, keys, value, {"median": 0.5, "p95": 0.95})
    return join_null_safe(exact, plain, keys)


def join_null_safe(a: DataFrame, b: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where NULL equals NULL; the keys come out once."""
    renamed = b.select(*[F.col(k).alias(f"__key{i}") for i, k in enumerate(keys)], *[c for c in b.columns if c not in keys])
    on = None
    for i, k in enumerate(keys):
        same = F.col(k).eqNullSafe(F.col(f"__key{i}"))
        on = same if on is None else on & same
    return a.join(renamed, on, how).drop(*[f"__key{i}" for i in range(len(keys))])


def correlation(a: Column, b: Column, least: int = 2, flat: float = 1e-9) -> Column:
    """Pearson correlation as an aggregate; NULL for fewer than ``least`` pairs or a constant side."""
    both = a.isNotNull() & b.isNotNull()
    x, y = F.when(both, a), F.when(both, b)
    sx, sy = F.stddev_pop(x), F.stddev_pop(y)
    return F.when((F.count(x) >= least) & (sx > flat) & (sy > flat), F.try_divide(F.covar_pop(x, y), sx * sy))


def block_bootstrap(df: DataFrame, keys: list[str], time: str, value: str, block_s: float = 1.0, draws: int = 1000, seed: int = 42, share: float = 0.95, chunk: int = 1 << 16) -> DataFrame:
    """Confidence interval of the root mean square by drawing blocks of time with replacement.

    Only (sum of squares, count) per block leave the rows. A group's blocks are drawn in chunks of ``chunk`` blocks: how many of a draw's
    blocks fall into each chunk is drawn first (a multinomial, for a table of chunks), then each chunk draws its own and gives two sums a draw; so
    a group of any length spreads over its chunks. Columns: ``keys``, ``n_blocks``, ``rmse``, ``low``, ``high``; fewer
    than two blocks give NULL bounds. The same seed gives the same draws.
    """
    import pandas as pd

    from posegrain.session import cut_lineage, ship_package

    ship_package(df.sparkSession)
    rows = df.filter(F.col(value).isNotNull())
    start = rows.groupBy(*keys).agg(F.min(time).alias("_t0"))
    blocks = join_null_safe(rows, start, keys).groupBy(*keys, F.floor((F.col(time) - F.col("_t0")) / block_s).alias("_b")).agg(F.sum(F.col(value) * F.col(value)).alias("_ss"), F.count(value).alias("_c"))
    blocks = running_sum(blocks, keys, ["_b"], F.lit(1).cast("long"), "_i", block=F.floor(F.col("_b") / chunk), total="_m")
    blocks = cut_lineage(blocks.withColumn("_k", F.floor((F.col("_i") - 1) / chunk)))
    types = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    tail = 100 * (1 - share) / 2
    whole = blocks.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_blocks"), F.sqrt(F.sum("_ss") / F.sum("_c")).alias("rmse"))
    chunks = blocks.groupBy(*keys, "_k").agg(F.count(F.lit(1)).alias("_n")).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_k", "_n"))).alias("_chunks"))

    def deal(batches):
        """How many blocks of each draw come from each chunk."""
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                n = np.array([c["_n"] for c in row["_chunks"]])
                counts = np.random.default_rng([seed, len(n)]).multinomial(n.sum(), n / n.sum(), draws) if len(n) > 1 else np.full((draws, 1), n.sum())
                out += [[*(row[k] for k in keys), c["_k"], counts[:, i].tolist()] for i, c in enumerate(row["_chunks"])]
            yield pd.DataFrame(out, columns=[*keys, "_k", "_counts"])

    dealt = chunks.mapInPandas(deal, f"{types}, _k long, _counts array<long>")

    def draw(pdf: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty:
            return pd.DataFrame(columns=[*keys, "_s", "_n"])
        pdf = pdf.sort_values("_b")
        ss, c, k = pdf["_ss"].to_numpy(), pdf["_c"].to_numpy(), int(pdf["_k"].iloc[0])
        want = np.array(counts["_counts"].iloc[0])
        rng = np.random.default_rng(seed if k == 0 else [seed, k])
        sums, total, i = np.zeros(draws), np.zeros(draws), 0
        while i < draws:
            # As many draws at once as have about DRAWN blocks.
            j = i + max(1, int(np.searchsorted(np.cumsum(want[i:]), DRAWN, "right")))
            picks = rng.integers(0, len(ss), want[i:j].sum())
            at = np.repeat(np.arange(j - i), want[i:j])
            sums[i:j], total[i:j] = np.bincount(at, ss[picks], j - i), np.bincount(at, c[picks], j - i)
            i = j
        return pd.DataFrame({**{key: [pdf[key].iloc[0]] for key in keys}, "_s": [sums], "_n": [total]})

    parts = blocks.groupBy(*keys, "_k").cogroup(dealt.groupBy(*keys, "_k")).applyInPandas(draw, f"{types}, _s array<double>, _n array<double>")
    each = parts.select(*keys, F.posexplode(F.arrays_zip("_s", "_n")).alias("_d", "_v")).groupBy(*keys, "_d").agg(F.sqrt(F.sum("_v._s") / F.sum("_v._n")).alias("_r"))
    bounds = each.groupBy(*keys).agg(F.percentile("_r", tail / 100).alias("low"), F.percentile("_r", 1 - tail / 100).alias("high"))
    d = join_null_safe(whole, bounds, keys)
    many = F.col("n_blocks") >= 2
    return d.select(*keys, "n_blocks", "rmse", F.when(many, F.col("low")).alias("low"), F.when(many, F.col("high")).alias("high"))
