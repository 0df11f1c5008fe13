"""Mixing sources to target weights by a splitting tree over blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from spliceloom.session import durable

from .common import fresh, sized

BLOCKS = 256   # per source, by the top eight bits of the hash: the resolution of a quota before documents of the last block are counted
FINE = 65_536  # parts of the last block, by the next sixteen bits


def targets(totals: DataFrame, weights: list[float], share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Target words of each source (one row per source: ``source``, ``source_size``), by filling up to a level.

    Sources by code point, null last, take the weights in turn and share ``share`` times all sizes. A target stops at ``most``
    times its source; the excess is shared again by weight until none is above. In one step: sources sorted by
    ``most * size / weight`` fill first, and the level of the others follows from running sums.
    """
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    t = totals.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights)).cast("int")))
    t = t.withColumn("cap", F.col("source_size") * F.lit(most)).withColumn("fill", F.col("cap") / F.col("weight"))
    order = W.orderBy("fill", F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    left = F.sum("source_size").over(W.partitionBy()) * F.lit(share) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(order.rowsBetween(W.currentRow, W.unboundedFollowing))
    t = t.withColumn("level", left / weight_left)
    # the first source in this order that does not fill sets the level of all after it
    open_ = F.when(F.col("level") < F.col("fill"), F.struct(F.col("fill"), F.row_number().over(order).alias("at"), F.col("level")))
    t = t.withColumn("open", open_)
    level = F.min("open").over(W.partitionBy())["level"]
    target = F.when(level.isNull() | (F.col("fill") <= level), F.col("cap")).otherwise(level * F.col("weight"))
    return t.select("source", F.col("source_size").cast("long").alias("source_size"), target.cast("double").alias("target"))


def permuted(keys: list[Column], seed: int) -> Column:
    """Place of a row in the fixed random order, as a hash."""
    return F.xxhash64(F.lit(seed), *keys)


def mix(docs: DataFrame, size: str, source: str, key: list[str], weights: list[float], share: float = 1.5, most: int = 2,
        n_shards: int = 8, seed: int = 11) -> tuple[DataFrame, DataFrame]:
    """How often each document enters the mix, and the shard of each of its copies.

    A hash of ``key`` puts the documents of a source in a fixed random order and cuts it into BLOCKS blocks by the top of
    the hash. Whole rounds of a source come first; of the last round the quota is the blocks, in order, whose words fit the
    target, plus the leading documents of the next block up to the one that ends nearest the target. The blocks of all
    sources and rounds then go down a binary splitting tree: at each node a random half (exactly, by rank of a hash) of
    the blocks goes left, so the per-source counts of the children are multivariate hypergeometric draws and the quotas of all
    shards add up to those of the sources. Blocks of a shard are disjoint; ``shuffle_key`` orders a shard locally.

    Returns (documents, copies). The first has every input row and column plus ``source_size``, ``target`` and ``shards`` (array of int: the shard of each
    copy that the tree placed, empty if none); the second has one row per placed copy plus ``copy`` int, ``shard`` int and ``shuffle_key`` long, which
    orders a shard locally. Sizes that are null count 0; a null source is a source of its own; rows with the same key stand or fall together; an empty table
    gives empty results. Clashing input columns are kept, new ones then get a leading underscore. Only block totals meet in one task: BLOCKS * ``most``
    narrow rows for each source, and in the cut block FINE totals and the keys of one FINE part of it. Documents of a hot source are spread by block.
    """
    blk, ord_, ssize, tgt, placed_, copy, shard, shuf = fresh(docs, "_block", "_order", "source_size", "target", "shards", "copy", "shard", "shuffle_key")
    rows = docs.withColumn(ord_, permuted([F.col(k) for k in key], seed))
    rows = rows.withColumn(blk, F.shiftrightunsigned(F.col(ord_), 56).cast("int"))
    n_of = F.coalesce(F.col(size), F.lit(0)).cast("long")
    blocks = durable(rows.groupBy(F.col(source).alias("source"), F.col(blk).alias("block")).agg(F.sum(n_of).alias("words")))
    totals = targets(blocks.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, float(most))
    inside = W.partitionBy("source").orderBy("block")  # at most BLOCKS rows
    totals = totals.withColumnRenamed("source", "_of")
    b = blocks.join(totals, F.col("source").eqNullSafe(F.col("_of"))).drop("_of")
    rounds = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most))).otherwise(0)
    b = b.withColumn("rounds", rounds.cast("int")).withColumn("rest", F.col("target") - F.col("rounds") * F.col("source_size"))
    b = b.withColumn("before", F.sum("words").over(inside) - F.col("words"))
    quota = durable(b.select("source", "block", "source_size", "target", "rounds", (F.col("before") + F.col("words") <= F.col("rest")).alias("whole"),
                             ((F.col("before") < F.col("rest")) & (F.col("before") + F.col("words") > F.col("rest"))).alias("cut"),
                             (F.col("rest") - F.col("before")).alias("room")))
    n_quota = quota.count()
    edge = cut_edges(rows.select(F.col(source).alias("source"), F.col(blk).alias("block"), F.col(ord_).alias("ord"), n_of.alias("n")), quota, n_quota)
    # the splitting tree over (source, block, round); a cut block goes down as one block
    node = quota.select("source", "block", F.explode(F.sequence(F.lit(1), F.lit(most))).alias("round"), "rounds", "whole", "cut")
    node = node.filter((F.col("round") <= F.col("rounds")) | ((F.col("round") == F.col("rounds") + 1) & (F.col("whole") | F.col("cut"))))
    node = node.select("source", "block", "round", F.lit(0).alias("lo"), F.lit(n_shards).alias("hi"))
    width = n_shards
    while width > 1:
        width = (width + 1) // 2
        here = W.partitionBy("lo", "hi")
        node = node.withColumn("mid", F.floor((F.col("lo") + F.col("hi")) / 2).cast("int"))
        rank = F.row_number().over(here.orderBy(F.xxhash64(F.lit(seed), "lo", "hi", "source", "block", "round"), "source", "block", "round"))
        left = F.count(F.lit(1)).over(here) * (F.col("mid") - F.col("lo")) / (F.col("hi") - F.col("lo"))
        node = node.withColumn("left", (F.col("hi") - F.col("lo") > 1) & (rank <= F.round(left)))
        node = node.select("source", "block", "round", F.when(F.col("left"), F.col("lo")).when(F.col("hi") - F.col("lo") > 1, F.col("mid")).otherwise(F.col("lo")).alias("lo"),
                           F.when(F.col("left"), F.col("mid")).otherwise(F.col("hi")).alias("hi"))
    placed = node.groupBy(F.col("source").alias("_s"), F.col("block").alias("_b")).agg(F.map_from_entries(F.collect_list(F.struct("round", "lo"))).alias("shards"))  # at most `most` entries
    p = quota.join(placed, F.col("source").eqNullSafe(F.col("_s")) & (F.col("block") == F.col("_b")), "left").drop("_s", "_b")
    p = p.join(edge.select(F.col("source").alias("_s"), F.col("edge")), F.col("cut") & F.col("source").eqNullSafe(F.col("_s")), "left")
    plan = p.select(F.col("source").alias("_s"), F.col("block").alias("_b"), F.col("source_size").alias("_ss"), F.col("target").alias("_t"), "rounds", "cut", "edge", F.coalesce("shards", F.map_from_arrays(F.array().cast("array<int>"), F.array().cast("array<int>"))).alias("shards"))
    joined = rows.join(sized(plan, n_quota, 100_000), rows[source].eqNullSafe(F.col("_s")) & (rows[blk] == F.col("_b")), "left")
    # what the tree placed; of a cut block's last round only the documents up to the edge
    here = F.filter(F.array_sort(F.map_entries("shards")), lambda e: (e["key"] <= F.col("rounds")) | ~F.col("cut") | F.coalesce(F.col(ord_) <= F.col("edge"), F.lit(False)))
    every = joined.withColumn("_here", here)
    documents = every.select(*docs.columns, F.col("_ss").alias(ssize), F.col("_t").alias(tgt), F.transform("_here", lambda e: e["value"]).alias(placed_))
    taken = every.select(*docs.columns, ord_, F.explode("_here").alias("_e"))
    copies = taken.select(*docs.columns, F.col("_e.key").alias(copy), F.col("_e.value").alias(shard), F.xxhash64(F.lit(seed + 1), F.col(ord_), F.col("_e.key")).alias(shuf))
    return documents, copies


def cut_edges(rows: DataFrame, quota: DataFrame, n_quota: int) -> DataFrame:
    """(source, edge): the last place in the random order that the cut block of a source still gives to the mix; null if none.

    A document belongs to it if its middle lies before the end of the room. Only places and sizes are read: first the totals of FINE parts of the
    block, then the places of the part in which the room ends.
    """
    cut = quota.filter("cut").select(F.col("source").alias("_s"), F.col("block").alias("_b"), "room")
    part = F.pmod(F.shiftrightunsigned(F.col("ord"), 40), F.lit(FINE)).cast("int").alias("part")
    within = rows.join(sized(cut, n_quota, 100_000), F.col("source").eqNullSafe(F.col("_s")) & (F.col("block") == F.col("_b"))).select("source", "room", "ord", "n", part)  # one row a source
    parts = within.groupBy("source", "part").agg(F.sum("n").alias("words"), F.max("room").alias("room"), F.max("ord").alias("last"))
    up = W.partitionBy("source").orderBy("part")
    parts = durable(parts.withColumn("before", F.sum("words").over(up) - F.col("words")))
    full = parts.filter("before + words <= room").groupBy("source").agg(F.max("last").alias("full"))
    split = parts.filter("before <= room AND before + words > room").select(F.col("source").alias("_s"), F.col("part").alias("_p"), F.col("before"))
    near = within.join(sized(split, n_quota, 100_000), F.col("source").eqNullSafe(F.col("_s")) & (F.col("part") == F.col("_p")))  # one row a source
    near = near.groupBy("source", "ord").agg(F.sum("n").alias("n"), F.max("room").alias("room"), F.max("before").alias("before"))
    upto = F.sum("n").over(W.partitionBy("source").orderBy("ord")) - F.col("n")
    inner = near.withColumn("mid", F.col("before") + upto + F.col("n") / 2).filter("mid <= room").groupBy("source").agg(F.max("ord").alias("inner"))
    both = full.withColumnRenamed("source", "_s").join(inner, F.col("source").eqNullSafe(F.col("_s")), "full").select(F.coalesce("source", "_s").alias("source"), F.greatest("full", "inner").alias("edge"))
    return both
