"""A training-data pipeline over the documents table, stage by stage."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spliceloom.llm.common import fresh, table, words
from spliceloom.llm.decontaminate import without_contaminated
from spliceloom.llm.mixing import mix
from spliceloom.llm.neardup import without_near_duplicates
from spliceloom.llm.quality import accepted
from spliceloom.llm.sharding import contiguous_shards
from spliceloom.session import made, release, work_dir

WEIGHTS = [3, 1, 2]
SHARDS = 8
SIMILARITY = 80  # per cent

ORACLE_SQL = None  # hashes and random draws; the tests hold every stage against brute force

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_left: list[str] = []  # working tables of the stage before


def tidy(stage: Stage) -> Stage:
    """Delete the working tables of the stage before: its result is written when the next one starts. Tables that ``docs`` still reads stay, and so do those of the last stage."""
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, _left, docs)
        first = len(made)
        out = stage(spark, docs, sf_dir)
        _left[:] = made[first:] if stage.__name__ != STAGES[-1][1].__name__ else []
        return out

    return run


@tidy
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules accept, judged row by row.

    Null and empty texts have no words and go; repeated rows stay or go together; a text of any length is judged whole; an unknown language gets
    the base rule only. Other columns pass through whatever their names; an empty table stays empty.
    """
    return accepted(docs)


@tidy
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the smallest doc_id, nulls last, then the first row.

    Texts without a word (null, empty) are no copies of each other and all stay; repeated rows are copies, so one stays; null or repeated ids neither save
    a copy nor take another row along. Columns pass through; an empty table stays empty.
    """
    return without_near_duplicates(docs, SIMILARITY)


@tidy
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, judged row by row.

    Null and empty texts hold nothing and stay; repeated rows go together; a long text is searched whole. Items without a word match nothing. Columns pass
    through; an empty table on either side is fine.
    """
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


@tidy
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each copy that it takes, written shard by shard in its local random order.

    Texts without a word have size 0 and come with their block; a null source is a source; rows of one doc_id stand or fall together. Columns pass through;
    an empty table stays empty.
    """
    size, shard, place = fresh(docs, "_words", "shard", "shuffle_key")
    _, copies = mix(docs.withColumn(size, F.size(words(F.col("text"))).cast("long")), size, "source", ["doc_id"], WEIGHTS, n_shards=SHARDS)
    return copies.repartitionByRange(shard, place).sortWithinPartitions(shard, place).select(*docs.columns)


@tidy
def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows in contiguous shards of near-equal bytes, in order of doc_id, with ``shard`` and ``slot``.

    A null text counts one byte; null ids come first; ties and repeated rows stand in a fixed random order. Input columns named shard or slot stay and the
    new ones get an underscore; an empty table stays empty.
    """
    size = fresh(docs, "size")[0]
    return contiguous_shards(docs.withColumn(size, (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")), SHARDS, size)


STAGES = [("quality rules", quality), ("MinHash near-dedup", near_dedup), ("benchmark decontamination", decontamination), ("mixing sources to target weights", mixing), ("sharding", sharding)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents, each written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = work_dir(spark, f"stage-{i}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
