"""Sharding by global byte-size prefix sums."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from spliceloom.session import written

from .common import fresh


def contiguous_shards(rows: DataFrame, n_shards: int, size: str = "size", order: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Cut rows, in ascending ``order`` (nulls first), into contiguous shards of near-equal total ``size``.

    Rows are dealt to ordered partitions by sampled ranges, each partition is scanned once for its
    running sums, and the partition totals (one row each) give every partition its offset. A row goes to
    the shard in which the middle of its byte interval lies, so a shard's size differs from the target by
    less than the largest row. Returns all columns plus ``shard`` int and ``slot`` long, the row's place
    in its shard without gaps; a clashing input column of that name is kept and the new one gets a leading
    underscore. Ties and repeated rows are put in a fixed random order, which also lets one value of the
    order columns spread over many partitions. A null size counts as 0; an empty table gives no rows.

    The ordered rows are written once to the shared folder, so that both passes see the same partitions
    whatever executor is lost.
    """
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    part, before, at, shard, slot = fresh(rows, "_part", "_before", "_at", "shard", "slot")
    tie = fresh(rows, "_tie")[0]
    placed = rows.withColumn(tie, F.rand(17)).repartitionByRange(n, *order, tie).sortWithinPartitions(*order, tie).drop(tie)
    schema = T.StructType([*rows.schema.fields, T.StructField(before, T.LongType()), T.StructField(at, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = count = 0
        for b in batches:
            sizes = b.column(size).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(sizes) + total
            place = np.arange(count, count + len(sizes), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ends - sizes), pa.array(place)], names=[*b.schema.names, before, at])
            if len(sizes):
                total, count = int(ends[-1]), count + len(sizes)

    kept = written(placed.mapInArrow(run, schema).withColumn(part, F.spark_partition_id()), "shards")
    of = F.coalesce(F.col(size), F.lit(0)).cast("long")
    totals = kept.groupBy(part).agg(F.sum(of).alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
    upto = W.orderBy(part).rowsBetween(W.unboundedPreceding, -1)  # one row per partition
    offsets = totals.select(F.col(part).alias("_p"), F.coalesce(F.sum("_bytes").over(upto), F.lit(0)).alias("_ob"), F.coalesce(F.sum("_rows").over(upto), F.lit(0)).alias("_or"),
                            F.sum("_bytes").over(W.partitionBy()).alias("_all"))
    middle = 2 * (F.col(before) + F.col("_ob")) + of
    out = kept.join(F.broadcast(offsets), F.col(part) == F.col("_p")).withColumn(at, F.col(at) + F.col("_or"))
    out = out.withColumn(shard, F.when(F.col("_all") == 0, F.lit(0)).otherwise(
        F.least(F.lit(n_shards - 1), F.floor(middle.cast("decimal(38,0)") * n_shards / (2 * F.col("_all"))))).cast("int"))
    firsts = out.groupBy(F.col(shard).alias("_s")).agg(F.min(at).alias("_first"))  # n_shards rows
    out = out.join(F.broadcast(firsts), F.col(shard) == F.col("_s")).withColumn(slot, F.col(at) - F.col("_first"))
    return out.select(*rows.columns, shard, slot)
