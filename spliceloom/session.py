"""Session settings, the shared work folder and durable cut points."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def tune(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply the settings every job here expects; sizes stay with the cluster."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Only a local session without the setting (a test) gets a folder of its own,
    under the warehouse; a cluster without it is an error, since plans that need
    a cut would otherwise grow without bound.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = os.path.join(spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:"), "_checkpoints")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint that survives executor loss."""
    sc = df.sparkSession.sparkContext
    folder = shared_dir(df.sparkSession)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


made: list[str] = []  # folders of `written` in this process


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage with a Parquet table in the shared folder; columns stay prunable."""
    path = work_dir(df.sparkSession, name)
    made.append(path)
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def compact(df: DataFrame, name: str) -> DataFrame:
    """`durable` for wide rows: a checkpoint holds them uncompressed, a table takes a fraction of the disk."""
    return written(df, name)


def stored(files: list[str], columns: list[str], rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """Inside a task: the rows of a table of `written`, file by file in the order of their names (the numbers of the tasks that wrote them)."""
    for file in sorted(files):
        system, path = pa.fs.FileSystem.from_uri(file)
        with system.open_input_file(path) as f:
            yield from pa.parquet.ParquetFile(f).iter_batches(rows, columns=columns)


def release(spark: SparkSession, folders: list[str], reader: DataFrame | None = None) -> None:
    """Delete folders of `written` whose readers are done; those that ``reader`` still reads stay."""
    files = reader.inputFiles() if reader is not None and folders else []
    for folder in folders:
        if folder in made and not any(f"/{folder.rsplit('/', 1)[1]}/" in f for f in files):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
            made.remove(folder)


def bucketed(df: DataFrame, name: str, *keys: str) -> DataFrame:
    """Cut lineage with a table bucketed by ``keys`` in the shared folder: joins and groups by them read it without an exchange."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table, path = f"{name}_{uuid.uuid4().hex}", work_dir(spark, name)
    df.repartition(n, *keys).write.bucketBy(n, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    return spark.table(table)
