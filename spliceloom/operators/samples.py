"""Sample sheets as small tables: strain merge, condition files, selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_strains(samples: DataFrame, keys: list[str], sample: str = "sample", files: str = "files") -> DataFrame:
    """Join replicate i of all samples of a strain; only as many replicates as every sample has.

    `files` is a text with `;` between replicates; the result has one such text per strain with `,` between samples.
    """
    rows = samples.filter(F.col(files).isNotNull()).withColumn("_f", F.split(files, ";"))
    least = rows.groupBy(*keys).agg(F.min(F.size("_f")).alias("_k"))
    long = rows.select(*keys, sample, F.posexplode("_f").alias("rep", "file")).join(least, keys).filter(F.col("rep") < F.col("_k"))
    per = long.groupBy(*keys, "rep").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct(F.col(sample).alias("k"), F.col("file").alias("v")))), lambda x: x["v"]), ",").alias("joined"))
    return per.groupBy(*keys).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("rep", "joined"))), lambda x: x["joined"]), ";").alias(files))


def condition_files(samples: DataFrame) -> DataFrame:
    """Numbered alignment rows per condition. samples: sample, condition, files (`;` list), paired, read_length."""
    return samples.select("condition", "sample", "paired", "read_length", F.posexplode(F.split("files", ";")).alias("rep", "file")).select(
        "condition", F.concat(F.col("sample"), F.lit("_repeat"), F.col("rep")).alias("name"), "file", "paired", "read_length")


def of_conditions(samples: DataFrame, conditions: DataFrame | list[str]) -> DataFrame:
    """Samples of the given conditions (a list, or a table with project and condition)."""
    if isinstance(conditions, list):
        return samples.filter(F.col("condition").isin(conditions))
    return samples.join(conditions.select("project", "condition").distinct(), ["project", "condition"], "left_semi")
