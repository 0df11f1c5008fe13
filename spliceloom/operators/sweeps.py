"""Ordered scans along a coordinate that never sort one key in one task.

A chromosome strand may hold a third of all rows, so nothing here opens a
window over it. Rows are first reduced to one per coordinate, the coordinate
axis is cut into cells of `width` positions, each cell is scanned on its own,
and only the per-cell totals (axis length / width rows) are scanned per key.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spliceloom.session import durable

CELL = 1 << 16
CELL_VALUES = 20_000  # distinct values that a cell of a sketched axis holds
MOST_CELLS = 10_000

_FOLD = {
    "sum": (F.sum, lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))),
    "max": (F.max, lambda a, b: F.greatest(a, b)),
    "min": (F.min, lambda a, b: F.least(a, b)),
}


def running(df: DataFrame, keys: list[str], order: str, cell: Column | None = None, width: int = CELL,
            **folds: tuple[str, str]) -> DataFrame:
    """Add running folds of columns in `order` within `keys`.

    Each fold ``name=("sum"|"max"|"min", column)`` adds `name` (this row
    included) and `name_before` (rows before only). `order` must be unique
    within `keys`. `cell` must be non-decreasing in `order`; by default it is
    ``floor(order / width)``.
    """
    cell = F.floor(F.col(order) / F.lit(width)) if cell is None else cell
    rows = df.withColumn("_cell", cell.cast("long"))
    by = [*keys, "_cell"]
    totals = rows.groupBy(*by).agg(*[_FOLD[k][0](c).alias(f"_t_{n}") for n, (k, c) in folds.items()])
    earlier = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*by, *[_FOLD[k][0](f"_t_{n}").over(earlier).alias(f"_c_{n}")
                                 for n, (k, _) in folds.items()])
    local = Window.partitionBy(*by).orderBy(order)
    upto = local.rowsBetween(Window.unboundedPreceding, 0)
    before = local.rowsBetween(Window.unboundedPreceding, -1)
    out = rows.join(carry, by)
    for name, (kind, column) in folds.items():
        agg, both = _FOLD[kind]
        out = (out.withColumn(name, both(F.col(f"_c_{name}"), agg(column).over(upto)))
                  .withColumn(f"{name}_before", both(F.col(f"_c_{name}"), agg(column).over(before))))
    return out.drop("_cell", *[f"_c_{n}" for n in folds])


def islands(df: DataFrame, keys: list[str], start: str = "start", end: str = "end", gap: int = 0,
            join_touching: bool = False, width: int = CELL) -> DataFrame:
    """Group intervals into islands; one row per distinct (keys, start).

    A new island opens at ``start >= reach + gap``, or at ``start > reach +
    gap`` when `join_touching`, where reach is the largest earlier end.
    Adds `reach_end` (largest end at this start) and `island_start`.

    Opens are found per cell first. The starts that stay open are those beyond
    the reach of earlier cells, so the last open start before a cell follows
    from per-cell maxima alone and one join brings it back to the rows.
    """
    by = [*keys, "_cell"]
    beyond = lambda s, r: r.isNull() | ((s > r + gap) if join_touching else (s >= r + gap))
    points = df.groupBy(*keys, start).agg(F.max(end).alias("reach_end")).withColumn(
        "_cell", F.floor(F.col(start) / F.lit(width)).cast("long"))
    local = Window.partitionBy(*by).orderBy(start)
    rows = points.withColumn("_r", F.max("reach_end").over(local.rowsBetween(Window.unboundedPreceding, -1)))
    rows = rows.withColumn("_open", F.when(beyond(F.col(start), F.col("_r")), F.col(start))).drop("_r")
    earlier = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    carry = (rows.groupBy(*by).agg(F.max("reach_end").alias("_e"), F.max("_open").alias("_o"))
             .withColumn("_reach", F.max("_e").over(earlier))
             .withColumn("_last", F.max(F.when(beyond(F.col("_o"), F.col("_reach")), F.col("_o"))).over(earlier))
             .select(*by, "_reach", "_last"))
    kept = F.when(beyond(F.col("_open"), F.col("_reach")), F.col("_open"))
    out = rows.join(carry, by)
    return (out.withColumn("island_start", F.coalesce(F.max(kept).over(local.rowsBetween(Window.unboundedPreceding, 0)), F.col("_last")))
               .drop("_cell", "_open", "_reach", "_last"))


def numbered_islands(df: DataFrame, keys: list[str], start: str = "start", end: str = "end", gap: int = 0,
                     join_touching: bool = False, width: int = CELL) -> DataFrame:
    """Islands with `island_no`, 1-based along the keys."""
    isl = durable(islands(df, keys, start, end, gap, join_touching, width))
    first = isl.select(*keys, "island_start").distinct().withColumn("_one", F.lit(1).cast("long"))
    no = running(first, keys, "island_start", width=width, island_no=("sum", "_one")).select(*keys, "island_start", "island_no")
    return isl.join(no, [*keys, "island_start"])


def merged(df: DataFrame, keys: list[str], start: str = "start", end: str = "end", gap: int = 0,
           join_touching: bool = True, width: int = CELL) -> DataFrame:
    """One row per island: keys, start, end."""
    isl = islands(df, keys, start, end, gap, join_touching, width)
    return (isl.groupBy(*keys, "island_start").agg(F.max("reach_end").alias("_e"))
               .select(*keys, F.col("island_start").alias(start), F.col("_e").alias(end)))


def novel_loci(df: DataFrame) -> DataFrame:
    """Name running clusters of reads per chrom and strand `chrom:strand:Novel_n`."""
    isl = numbered_islands(df, ["chrom", "strand"]).select("chrom", "strand", "start", "island_no")
    rows = df.join(isl, ["chrom", "strand", "start"])
    return (rows.withColumn("locus", F.concat_ws(":", "chrom", "strand", F.concat(F.lit("Novel_"), F.col("island_no"))))
                .drop("island_no"))


def two_way_clusters(df: DataFrame, keys: list[str], start: str, end: str, gap: int) -> DataFrame:
    """Cluster by start gaps <= gap, then by end gaps <= gap inside each start cluster."""
    first = durable(with_point_island(df, keys, start, gap, "start_cluster"))
    return with_point_island(first, [*keys, "start_cluster"], end, gap, "end_cluster")


def with_point_island(df: DataFrame, keys: list[str], pos: str, gap: int, name: str) -> DataFrame:
    """Chain points whose neighbouring distance is <= gap; `name` is the first position of the chain."""
    pts = df.select(*keys, pos).distinct().withColumn("_pe", F.col(pos))
    isl = islands(pts, keys, pos, "_pe", gap, True).select(*keys, pos, F.col("island_start").alias(name))
    return df.join(isl, [*keys, pos])


def bh_adjusted(df: DataFrame, p: str = "p", keys: list[str] | None = None, out: str = "p_adj") -> DataFrame:
    """Benjamini-Hochberg adjusted p values, scanned over cells of the p axis.

    Equal p values are counted once with their number. The cells are cut at approximate quantiles of the distinct values, as many as hold about CELL_VALUES of
    them, so they are even whatever the distribution; NaN and null have no adjusted value.
    """
    by = keys or ["_all"]
    rows = df if keys else df.withColumn("_all", F.lit(0))
    counts = durable(rows.filter(F.col(p).isNotNull() & ~F.isnan(p)).groupBy(*by, p).agg(F.count(F.lit(1)).alias("_n")))
    cell = quantile_cells(counts, p)
    up = running(counts, by, p, cell=cell, _rank=("sum", "_n")).drop("_rank_before")
    total = counts.groupBy(*by).agg(F.sum("_n").alias("_m"))
    up = up.join(total if keys else F.broadcast(total), by)  # without keys the total is one row
    raw = up.withColumn("_raw", F.col(p) * F.col("_m") / F.col("_rank")).withColumn("_neg", -F.col(p))
    down = running(raw.withColumn("_c", cell), by, "_neg", cell=-F.col("_c"), _adj=("min", "_raw"))
    adj = down.select(*by, p, F.least(F.col("_adj"), F.lit(1.0)).alias(out))
    return rows.join(adj, [*by, p], "left").drop("_all")


def quantile_cells(rows: DataFrame, value: str, each: int | None = None) -> Column:
    """Cell number of a value, non-decreasing in it, with about ``each`` rows a cell: the cuts are a sketch of the quantiles, at most MOST_CELLS numbers."""
    n = max(1, min(MOST_CELLS, -(-rows.count() // (each or CELL_VALUES))))
    cuts = [] if n == 1 else rows.agg(F.percentile_approx(value, [i / n for i in range(1, n)], 20 * n)).first()[0]
    edges = np.unique(np.array(cuts or [], float))

    @F.pandas_udf("long")
    def of(x: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, x.to_numpy(float), side="right"))

    return of(F.col(value).cast("double"))


def average_ranks(df: DataFrame, keys: list[str], value: str, width: float = 1.0) -> DataFrame:
    """Distinct (keys, value) with `ties`, `rank` (mean rank of the tie) in ascending order."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("ties"))
    scan = running(counts, keys, value, cell=F.floor(F.col(value) / F.lit(width)), _upto=("sum", "ties"))
    return (scan.withColumn("rank", F.col("_upto_before") + (F.col("ties") + 1) / F.lit(2.0))
                .drop("_upto", "_upto_before"))


def exact_quantiles(df: DataFrame, keys: list[str], value: str, width: float = 1.0, **probs: float) -> DataFrame:
    """Exact quantiles (linear interpolation) per key from counted distinct values, one column per ``name=p``."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    scan = running(counts, keys, value, cell=F.floor(F.col(value) / F.lit(width)), _upto=("sum", "_n"))
    rows = scan.join(counts.groupBy(*keys).agg(F.sum("_n").alias("_m")), keys)
    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_upto_before") < rank) & (F.col("_upto") >= rank), F.col(value)))
    aggs, out = [F.max("_m").alias("_m")], []
    for name, p in probs.items():
        h = (F.col("_m") - 1) * F.lit(p)
        aggs += [at(F.floor(h) + 1).alias(f"_lo_{name}"), at(F.ceil(h) + 1).alias(f"_hi_{name}")]
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        out.append((lo + (hi - lo) * (h - F.floor(h))).alias(name))
    return rows.groupBy(*keys).agg(*aggs).select(*keys, *out)


def exact_median(df: DataFrame, keys: list[str], value: str, out: str = "median", width: float = 1.0) -> DataFrame:
    return exact_quantiles(df, keys, value, width, **{out: 0.5})
