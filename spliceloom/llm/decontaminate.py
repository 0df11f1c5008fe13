"""Benchmark decontamination by size-partitioned MinHash containment search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spliceloom.session import durable

from .common import BROADCAST_ROWS, fresh, numbered, sized, words

WIDTH = 5
THRESHOLD_PERCENT = 80  # of an item's shingles that a document must hold


def word_hashes(text: Column) -> Column:
    return F.transform(words(F.lower(text)), lambda x: F.xxhash64(x))


def shingle_hashes(h: Column) -> Column:
    """Distinct hashes of the five-word windows; a text of one to four words is one shingle as a whole."""
    return F.when(F.size(h) == 0, F.array().cast("array<bigint>")).when(F.size(h) < WIDTH, F.array(F.xxhash64(h))).otherwise(F.array_distinct(F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(h) - WIDTH, F.lit(0))), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(WIDTH)]))))


def padded(w: Column) -> Column:
    return F.concat(F.lit(" "), F.array_join(w, " "), F.lit(" "))


def shingles(w: Column) -> Column:
    """The same windows as padded strings, for exact tests."""
    return F.when(F.size(w) == 0, F.array().cast("array<string>")).when(F.size(w) < WIDTH, F.array(padded(w))).otherwise(F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(w) - WIDTH + 1, F.lit(1))), lambda i: padded(F.slice(w, i, F.lit(WIDTH))))))


def item_sketches(items: DataFrame, percent: int) -> DataFrame:
    """(item_id, shingles, need, size_class, sketch) of every item that has a word.

    A document that holds at least ``need`` of an item's q shingles misses at most q - need, so among the
    q - need + 1 smallest hashes of the item (its bottom-k MinHash) at least one is in the document: the sketch
    depth follows the size of the item, and the search loses nothing. Items with equal sets share one row.
    """
    i = items.select("item_id", words(F.lower(F.col("text"))).alias("w")).filter(F.size("w") > 0).withColumn("wh", F.transform("w", lambda x: F.xxhash64(x)))
    i = i.select("item_id", F.sort_array(shingles(F.col("w"))).alias("shingles"), F.sort_array(shingle_hashes(F.col("wh"))).alias("h"))
    i = i.groupBy("shingles", "h").agg(F.collect_set("item_id").alias("item_ids"))  # copies of one item, as many as the test set has
    i = i.withColumn("q", F.size("shingles")).withColumn("need", F.ceil(F.col("q") * percent / 100).cast("int"))
    return i.select(F.xxhash64("shingles").alias("item"), "item_ids", "shingles", "q", "need", F.floor(F.log2("q")).cast("int").alias("size_class"), F.slice("h", F.lit(1), F.col("q") - F.col("need") + 1).alias("sketch"))


def contaminated(docs: DataFrame, items: DataFrame, percent: int = THRESHOLD_PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pairs (key, item_id, n_item_shingles, n_shared, containment) where a document holds at least ``percent`` of an item's shingles.

    Words are lower-cased runs of non-separators; shingles are five words, and a text of fewer words is one shingle as a whole.
    Items are partitioned by size (powers of two). Each partition has its own least need and its own largest sketch hash; a document
    sends only hashes below the largest cut among the partitions it is long enough for. Candidates share a sketch hash; each is then
    tested exactly, shingle by shingle as strings, against the whole document. Null or empty texts and items match nothing; rows that
    repeat a key give one pair per item; a null key is carried as null; only the two named columns are read.
    """
    it = durable(item_sketches(items, percent))
    cuts = it.groupBy("size_class").agg(F.min("need").alias("need"), F.max(F.array_max("sketch")).alias("cut")).collect()  # at most 32 rows
    d = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    d = d.withColumn("_text_key", F.xxhash64("_text"))
    if not cuts:
        return d.limit(0).select(F.col("_key").alias(key), F.lit(None).cast(items.schema["item_id"].dataType).alias("item_id"), F.lit(0).alias("n_item_shingles"), F.lit(0).alias("n_shared"), F.lit(0.0).alias("containment"))
    sketch = durable(it.select("item", F.explode("sketch").alias("hash")))
    h = d.filter(F.col("_text").isNotNull()).withColumn("_h", word_hashes(F.col("_text"))).select("_key", "_text_key", "_h").withColumn("_s", shingle_hashes(F.col("_h")))
    cut = F.greatest(*[F.when(F.size("_s") >= r["need"], F.lit(r["cut"])) for r in cuts], F.lit(None).cast("bigint"))
    sent = h.withColumn("_cut", cut).select("_key", "_text_key", F.filter("_s", lambda x: x <= F.col("_cut")).alias("_s"))
    # the outer form keeps the optimiser from testing the size of the array first, which would compute it twice
    sent = sent.select("_key", "_text_key", F.explode_outer("_s").alias("hash"))
    found = durable(sent.join(sized(sketch, sketch.count()), "hash").select("_key", "_text_key", "item").distinct())
    n = found.count()
    pairs = found.join(sized(it.select("item", "item_ids", "shingles", "q", "need"), it.count(), BROADCAST_ROWS // 50), "item")
    texts = d.select(F.col("_key").alias("_k"), F.col("_text_key").alias("_t"), padded(words(F.lower(F.col("_text")))).alias("_whole"))
    ids = found.select(F.col("_key").alias("_k2"), F.col("_text_key").alias("_t2")).distinct()
    texts = texts.join(sized(ids, n), F.col("_k").eqNullSafe(F.col("_k2")) & (F.col("_t") == F.col("_t2")), "left_semi")
    pairs = pairs.join(texts, F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_text_key") == F.col("_t")))
    short = F.size(F.split(F.get("shingles", F.lit(0)), " ")) < WIDTH + 2
    shared = F.when(short, F.when(F.col("_whole") == F.get("shingles", F.lit(0)), 1).otherwise(0)).otherwise(F.size(F.filter("shingles", lambda s: F.contains(F.col("_whole"), s))))
    out = pairs.withColumn("n_shared", shared).filter(F.col("n_shared") >= F.col("need"))
    out = out.select(F.col("_key").alias(key), F.explode("item_ids").alias("item_id"), F.col("q").alias("n_item_shingles"), "n_shared", (F.col("n_shared") / F.col("q")).alias("containment"))
    return out.groupBy(key, "item_id", "n_item_shingles").agg(F.max("n_shared").alias("n_shared"), F.max("containment").alias("containment")).select(key, "item_id", "n_item_shingles", "n_shared", "containment")


def without_contaminated(docs: DataFrame, items: DataFrame, percent: int = THRESHOLD_PERCENT, text: str = "text") -> DataFrame:
    """The rows in no pair of ``contaminated``, with all their columns; rows are told apart by a row id, whatever their keys."""
    row, k = fresh(docs, "_row", "_bad")
    rows = numbered(docs, row)
    bad = durable(contaminated(rows, items, percent, row, text).select(F.col(row).alias(k)).distinct())
    return rows.join(sized(bad, bad.count()), F.col(row) == F.col(k), "left_anti").drop(row)
