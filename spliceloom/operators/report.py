"""Tables behind the report figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spliceloom.operators.sweeps import exact_quantiles
from spliceloom.operators.transcripts import rank_in


def histogram(df: DataFrame, keys: list[str], value: str, width: float) -> DataFrame:
    """Counts and density by bin of `width`."""
    cell = df.groupBy(*keys, F.floor(F.col(value) / F.lit(width)).cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    if keys:
        total = cell.groupBy(*keys).agg(F.sum("n").alias("_all"))
        out = cell.join(total, keys)
    else:
        total = cell.agg(F.sum("n").alias("_all")).withColumn("_one", F.lit(1))
        out = cell.withColumn("_one", F.lit(1)).join(F.broadcast(total), "_one").drop("_one")  # one row
    return out.withColumn("density", F.col("n") / (F.col("_all") * F.lit(width))).drop("_all")


def box_summary(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Quartiles, and whiskers at the last values inside 1.5 interquartile ranges."""
    q = exact_quantiles(df, keys, value, q1=0.25, median=0.5, q3=0.75)
    iqr = F.col("q3") - F.col("q1")
    lo, hi = F.col("q1") - iqr * 1.5, F.col("q3") + iqr * 1.5
    return df.join(q, keys).groupBy(*keys, "q1", "median", "q3").agg(
        F.min(F.when(F.col(value) >= lo, F.col(value))).alias("low"), F.max(F.when(F.col(value) <= hi, F.col(value))).alias("high"),
        F.count(F.lit(1)).alias("n"))


def motif_counts(motifs: DataFrame, keys: list[str] = ()) -> DataFrame:
    return motifs.groupBy(*keys, "motif").agg(F.count(F.lit(1)).alias("n"))


def motif_shares(counts: DataFrame, keys: list[str], top: int = 3) -> DataFrame:
    """Shares of the leading motifs and the rest as Other. Ties go to the larger motif text.

    Motifs are a bounded alphabet, so the ranked table is small.
    """
    ranked = rank_in(counts, keys, [F.col("n").desc(), F.col("motif").desc()], 1 << 30)
    label = F.when(F.col("rank") <= top, F.col("motif")).otherwise("Other")
    total = counts.groupBy(*keys).agg(F.sum("n").alias("_all"))
    return ranked.groupBy(*keys, label.alias("motif")).agg(F.sum("n").alias("n")).join(total, keys).withColumn(
        "share", F.col("n") / F.col("_all")).drop("_all")


def event_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("as_type", "annotation").agg(F.count(F.lit(1)).alias("n"))


def set_overlap(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Sizes of both-only-only parts of two key sets."""
    left = a.select(*keys).distinct().withColumn("in_a", F.lit(True))
    right = b.select(*keys).distinct().withColumn("in_b", F.lit(True))
    j = left.join(right, keys, "full").select(F.coalesce("in_a", F.lit(False)).alias("in_a"), F.coalesce("in_b", F.lit(False)).alias("in_b"))
    return j.groupBy("in_a", "in_b").agg(F.count(F.lit(1)).alias("n"))


def event_list(events: DataFrame, unique: bool = True) -> DataFrame:
    """`chrom:event:strand` keys of events outside novel loci."""
    rows = events.filter(~F.col("event_id").contains("Novel")).select(F.concat_ws(":", "chrom", "event_id", "strand").alias("event"))
    return rows.distinct() if unique else rows


def apa_list(lists: DataFrame) -> DataFrame:
    """`chrom:strand:gene:sites` keys of genes with more than one site."""
    return lists.filter(F.size(F.split("pas", ",")) > 1).select(F.concat_ws(":", "chrom", "strand", "gene", "pas").alias("event"))


def result_index(results: dict[str, DataFrame], key: str = "gene") -> DataFrame:
    """Which analyses have a result for a gene: one flag column per analysis."""
    out = None
    for name, df in results.items():
        one = df.select(key).distinct().withColumn(f"has_{name}", F.lit(True))
        out = one if out is None else out.join(one, key, "full")
    return out.fillna(False)


def gene_regions(models: DataFrame, isoforms: DataFrame) -> DataFrame:
    """Span of a gene over its models and isoforms. Both: gene, chrom, start, end."""
    cols = ["gene", "chrom", "start", "end"]
    return models.select(*cols).unionByName(isoforms.select(*cols)).groupBy("gene", "chrom").agg(
        F.min("start").alias("g_start"), F.max("end").alias("g_end"))


def highlight_spans(events: DataFrame, members: DataFrame, isoforms: DataFrame) -> DataFrame:
    """Per gene and event type: region of the isoforms involved and span of the events."""
    iso = members.select("as_type", "gene", "iso").distinct().join(isoforms.select("gene", "iso", "start", "end"), ["gene", "iso"])
    region = iso.groupBy("as_type", "gene").agg(F.min("start").alias("region_start"), F.max("end").alias("region_end"),
                                               F.count(F.lit(1)).alias("n_iso"))
    marks = events.groupBy("as_type", "gene").agg(F.min("lo").alias("first_mark"), F.max("hi").alias("last_mark"),
                                                 F.count(F.lit(1)).alias("n_events"))
    return region.join(marks, ["as_type", "gene"])


def score_list(scores: DataFrame, annotation: str) -> DataFrame:
    """Isoforms of one annotation class by descending frequency."""
    return scores.filter(F.col("annotation") == annotation).orderBy(F.col("freq").desc(), "iso")


def accuracy_histogram(df: DataFrame) -> DataFrame:
    """1 % bins of coverage x identity / 100 between 50 and 101."""
    acc = F.col("coverage") * F.col("identity") / 100
    return df.filter((acc >= 50) & (acc < 101)).groupBy(F.floor(acc).cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def split_list(df: DataFrame, column: str, out: str, kind: str = "double", sep: str = ",") -> DataFrame:
    """One row per value of a delimited text."""
    return df.withColumn(out, F.explode(F.transform(F.split(column, sep), lambda x: x.cast(kind)))).drop(column)


def tail_report(rows: DataFrame) -> DataFrame:
    """Site rows of `chrom_pos;...` texts with their counts and comma lists of lengths: chrom, site, apa label, count, length."""
    parts = F.arrays_zip(F.split("sites", ";").alias("s"), F.split("counts", ";").alias("c"), F.split("lengths", ";").alias("l"))
    one = rows.select("gene", F.posexplode(parts).alias("k", "x"))
    pos: Column = F.regexp_extract("x.s", r"_(\d+)$", 1).cast("long")
    return one.select("gene", F.regexp_replace("x.s", r"_\d+$", "").alias("chrom"), pos.alias("site"), (pos + 1).alias("site_end"),
                      F.concat(F.lit("APA"), F.col("k") + 1).alias("apa"), F.col("x.c").cast("double").alias("count"),
                      F.explode(F.transform(F.split("x.l", ","), lambda v: v.cast("double"))).alias("length"))
