"""Interval joins as equi-joins on coordinate tiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spliceloom.operators.sweeps import running

TILE = 1 << 14
WIDEN = 256
LONG_TILES = 64


def _div(c: Column, w: int) -> Column:
    return F.floor(c / F.lit(w)).cast("long")


def _cells(s: Column, last: Column, tile: int, fine: int, short: list[int], long: list[int]) -> Column:
    """Cell keys of an interval: 4 * tile number + pair class."""
    def grid(width: int, cls: int) -> Column:
        return F.transform(F.sequence(_div(s, width), _div(last, width)), lambda b: b * 4 + cls)
    coarse = tile * WIDEN
    short_cells = F.concat(*[grid(tile if c == fine else coarse, c) for c in short])
    long_cells = F.concat(*[grid(coarse, c) for c in long])
    return F.when(last - s <= tile * LONG_TILES, short_cells).otherwise(long_cells)


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], ls: str = "start", le: str = "end",
                 rs: str = "r_start", re: str = "r_end", touching: bool = False, tile: int = TILE,
                 hot_rows: int | None = None) -> DataFrame:
    """Inner join of rows whose intervals overlap, within equal `keys`.

    Apart from `keys` the two sides must have different column names. Short
    intervals meet on a fine grid; an interval longer than 64 tiles meets
    others only on a coarse grid, so its number of cells stays small. A pair is
    kept in the cell of its later start only, so no distinct is needed.

    AQE splits skewed cells of this sort-merge join at run time. `hot_rows`
    additionally splits each cell with more left rows than that: its left rows
    are spread by a hash of the row and its right rows are repeated per part,
    so the result stays whole. Count identical copies before calling.
    """
    shift = 0 if touching else 1
    last = lambda s, e: F.greatest(F.col(e) - shift, F.col(s))
    a = left.withColumn("_cell", F.explode(_cells(F.col(ls), last(ls, le), tile, 0, [0, 2], [1, 3])))
    b = right.withColumn("_cell", F.explode(_cells(F.col(rs), last(rs, re), tile, 0, [0, 1], [2, 3])))
    on = [*keys, "_cell"]
    if hot_rows:
        hot = (a.groupBy(*on).count().filter(F.col("count") > hot_rows)
                .select(*on, F.ceil(F.col("count") / hot_rows).alias("_parts")))
        a = (a.join(hot, on, "left")
              .withColumn("_part", F.pmod(F.xxhash64(*left.columns), F.coalesce("_parts", F.lit(1)))).drop("_parts"))
        b = (b.join(hot, on, "left")
              .withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"),
                                                        F.coalesce("_parts", F.lit(1)).cast("long") - 1))).drop("_parts"))
        on = [*on, "_part"]
    if touching:
        meets = (F.col(ls) <= F.col(re)) & (F.col(rs) <= F.col(le))
    else:
        meets = (F.col(ls) < F.col(re)) & (F.col(rs) < F.col(le))
    width = F.when(F.pmod("_cell", F.lit(4)) == 0, F.lit(tile)).otherwise(F.lit(tile * WIDEN))
    owner = F.floor(F.greatest(F.col(ls), F.col(rs)) / width) == F.floor(F.col("_cell") / 4)
    return a.join(b, on).filter(meets & owner).drop("_cell", "_part")


def overlap_anti(left: DataFrame, right: DataFrame, keys: list[str], ls: str = "start", le: str = "end",
                 rs: str = "r_start", re: str = "r_end") -> DataFrame:
    """Left rows that overlap nothing on the right (right is merged first, so it is small and disjoint)."""
    spans = left.select(*keys, ls, le).distinct()
    hit = overlap_join(spans, right.select(*keys, rs, re).distinct(), keys, ls, le, rs, re)
    return left.join(hit.select(*keys, ls, le).distinct(), [*keys, ls, le], "left_anti")


def overlap_left(left: DataFrame, right: DataFrame, keys: list[str], ls: str = "start", le: str = "end",
                 rs: str = "r_start", re: str = "r_end") -> DataFrame:
    """Left outer overlap join: unmatched left rows keep nulls on the right."""
    hits = overlap_join(left, right, keys, ls, le, rs, re)
    return hits.unionByName(overlap_anti(left, right, keys, ls, le, rs, re), allowMissingColumns=True)


def overlap_size(left: DataFrame, right: DataFrame, keys: list[str], ls: str = "start", le: str = "end",
                 rs: str = "r_start", re: str = "r_end") -> DataFrame:
    """Overlap pairs with `bp` and the share of either side."""
    bp = F.least(le, re) - F.greatest(ls, rs)
    return (overlap_join(left, right, keys, ls, le, rs, re).withColumn("bp", bp)
            .withColumn("left_share", bp / (F.col(le) - F.col(ls)))
            .withColumn("right_share", bp / (F.col(re) - F.col(rs))))


def within_distance(left: DataFrame, right: DataFrame, keys: list[str], pos: str, r_pos: str, before: int,
                    after: int) -> DataFrame:
    """Pairs with ``-before <= pos - r_pos <= after`` as an equi-join on cells of that span."""
    span = before + after + 1
    a = left.withColumn("_d", _div(F.col(pos), span))
    b = right.withColumn("_d", F.explode(F.sequence(_div(F.col(r_pos) - before, span),
                                                    _div(F.col(r_pos) + after, span))))
    gap = F.col(pos) - F.col(r_pos)
    return a.join(b, [*keys, "_d"]).filter((gap >= -before) & (gap <= after)).drop("_d")


def nearest(points: DataFrame, features: DataFrame, keys: list[str], strand: str = "strand") -> DataFrame:
    """Nearest features of each distinct interval, all ties kept, signed distance.

    `points` has keys, start, end; `features` has keys, f_start, f_end. An
    overlap has distance 0; otherwise the distance counts bases plus one
    (neighbours that touch are 1 apart) and is negative upstream by `strand`.
    Both scans run cell by cell over distinct coordinates.
    """
    pts = points.select(*keys, "start", "end").distinct()
    fts = features.select(*keys, "f_start", "f_end").distinct()
    inside = overlap_join(pts, fts, keys, rs="f_start", re="f_end").withColumn("distance", F.lit(0).cast("long"))
    rest = pts.join(inside.select(*keys, "start", "end").distinct(), [*keys, "start", "end"], "left_anti")
    none = F.lit(None).cast("long")
    left_axis = (fts.select(*keys, F.col("f_end").alias("_at"), F.col("f_end").alias("_v"))
                 .unionByName(rest.select(*keys, F.col("start").alias("_at"), none.alias("_v")))
                 .groupBy(*keys, "_at").agg(F.max("_v").alias("_v")))
    right_axis = (fts.select(*keys, (-F.col("f_start")).alias("_at"), F.col("f_start").alias("_v"))
                  .unionByName(rest.select(*keys, (-F.col("end")).alias("_at"), none.alias("_v")))
                  .groupBy(*keys, "_at").agg(F.min("_v").alias("_v")))
    up = running(left_axis, keys, "_at", _near=("max", "_v")).select(
        *keys, F.col("_at").alias("start"), F.col("_near").alias("_left"))
    dn = running(right_axis, keys, "_at", _near=("min", "_v")).select(
        *keys, (-F.col("_at")).alias("end"), F.col("_near").alias("_right"))
    both = rest.join(up, [*keys, "start"], "left").join(dn, [*keys, "end"], "left")
    dl = F.col("start") - F.col("_left") + 1
    dr = F.col("_right") - F.col("end") + 1
    best = both.withColumn("_best", F.least(dl, dr)).filter(F.col("_best").isNotNull())
    sign = F.when(F.col(strand) == "-", -1).otherwise(1)
    lhs = (best.filter(dl == F.col("_best")).withColumn("f_end", F.col("_left")).join(fts, [*keys, "f_end"])
           .withColumn("distance", (-F.col("_best") * sign).cast("long")))
    rhs = (best.filter(dr == F.col("_best")).withColumn("f_start", F.col("_right")).join(fts, [*keys, "f_start"])
           .withColumn("distance", (F.col("_best") * sign).cast("long")))
    cols = [*keys, "start", "end", "f_start", "f_end", "distance"]
    return inside.select(*cols).unionByName(lhs.select(*cols)).unionByName(rhs.select(*cols))


def neighbour(sites: DataFrame, keys: list[str], pos: str) -> DataFrame:
    """Nearest other site in one list; the left one wins a tie, single-site keys drop out.

    Returns one row per distinct position: `n` rows there, `near` position and
    `distance` (0 when several rows share the position).
    """
    pts = sites.groupBy(*keys, pos).agg(F.count(F.lit(1)).alias("n"))
    up = running(pts, keys, pos, _p=("max", pos)).withColumnRenamed("_p_before", "_prev").drop("_p")
    dn = running(up.withColumn("_neg", -F.col(pos)), keys, "_neg", _q=("max", "_neg"))
    dn = dn.withColumn("_next", -F.col("_q_before"))
    dl, dr = F.col(pos) - F.col("_prev"), F.col("_next") - F.col(pos)
    near = (F.when(F.col("n") > 1, F.col(pos)).when(dr.isNull() | (dl <= dr), F.col("_prev")).otherwise(F.col("_next")))
    return (dn.withColumn("near", near).filter(F.col("near").isNotNull())
              .select(*keys, pos, "n", "near", F.abs(F.col(pos) - F.col("near")).alias("distance")))
