"""Column expressions and helpers that several corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spliceloom.session import written

BROADCAST_ROWS = 1_000_000  # narrow rows (two or three numbers each) that may be broadcast


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` in order; null text has none. Plain replacements and a one-character split are byte work."""
    flat = F.coalesce(text, F.lit(""))
    for c in "\t\n\x0b\f\r":
        flat = F.replace(flat, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(flat, " "), "")


def spread(df: DataFrame) -> DataFrame:
    """Deal rows evenly before heavy row-local work, when the scan gives few tasks."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n)


def sized(df: DataFrame, rows: int, most: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only for a counted side of at most ``most`` narrow rows; else a shuffle join."""
    return F.broadcast(df) if rows <= most else df


def dealt(df: DataFrame) -> DataFrame:
    """Join this side by a shuffle: Spark sizes what a task makes out of a row, or a compressed file holds, too low, and would send it through the driver."""
    return df.hint("merge")


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """The rows with a row id each, written to the shared folder, so that every reading sees the same ids."""
    return written(docs.withColumn(name, F.monotonically_increasing_id()), "numbered")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names, from the wanted ones, that clash with no column of ``df`` in any letter case."""
    have = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in have:
            name = "_" + name
        have.add(name.lower())
        out.append(name)
    return out
