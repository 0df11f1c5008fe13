"""The isoform feature table: support, structure, coding, junction coverage and indel features of each isoform."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spliceloom.functions import blocks as B
from spliceloom.functions.coding import coding_features, coding_probability
from spliceloom.functions.sequence import gc
from spliceloom.operators import assign as A
from spliceloom.operators.transcripts import distinct_exons, intron_rows
from spliceloom.sources.sequences import splice_motifs, spliced

# The columns of the feature file, in order.
COLUMNS = ["isoLength", "flCount", "ratioIsoToGene", "exonNum", "annotation", "GC", "orfLength", "orfIntegrity", "pepLength", "FickettScore", "pI", "codingP", "codingLabel",
           "canJuncRatio", "sdJuncCov", "withNovelJunc", "minNovelJuncRPKM", "bite", "minJuncRPKM", "nIndelsAroundJunc", "ratioMinJuncCovToAllCov", "nJuncsWithIndels", "indelNearJunc"]

CodingModel = tuple[np.ndarray, np.ndarray, float, float, float, float]  # vectors, weights, gamma, rho and the two sigmoid values


def support_part(isoforms: DataFrame) -> DataFrame:
    """iso, annotation and what follows from exons and reads; a gene's reads are counted once."""
    total = isoforms.groupBy("gene").agg(F.sum("reads").alias("_r"))
    return isoforms.join(total, "gene").select("iso", "annotation", B.length(F.col("exons")).alias("isoLength"), F.col("reads").alias("flCount"),
                                               (F.col("reads") / F.col("_r")).alias("ratioIsoToGene"), F.size("exons").cast("long").alias("exonNum"))


def sequence_part(genome: DataFrame, placed: DataFrame, model: CodingModel) -> DataFrame:
    """Features of the spliced text: one pass over the text of each isoform."""
    text = spliced(genome, placed).withColumnRenamed("iso", "id")
    c = coding_probability(coding_features(text, extra={"GC": gc}), *model)
    return c.select(F.col("id").alias("iso"), "GC", F.col("orf_length").cast("long").alias("orfLength"), F.col("integrity").cast("long").alias("orfIntegrity"), F.col("pep_len").cast("long").alias("pepLength"),
                    F.col("fickett").alias("FickettScore"), F.col("pi").alias("pI"), F.col("coding_probability").alias("codingP"), F.col("coding_label").alias("codingLabel"))


def isoform_features(isoforms: DataFrame, genome: DataFrame, junctions: DataFrame, alignments: DataFrame, model: CodingModel, placed: DataFrame | None = None, reach: int = 10) -> DataFrame:
    """(iso, COLUMNS): numbers rounded to three places, missing ones 0.

    isoforms: gene, iso, chrom, strand, exons, reads, annotation ('annotated' or 'novel'); genome: chunk table; junctions: chrom, js, je, cnt;
    alignments: chrom, junctions, indels; ``placed`` gives chrom, strand and exons on the genome where they differ from those of the isoforms. Annotated isoforms are the
    known structures. Every part is keyed by iso, so the joins need no exchange beyond those of the parts; pass a table bucketed by iso
    (`session.bucketed`) to spare also the first.
    """
    placed = isoforms if placed is None else placed
    known = isoforms.filter("annotation = 'annotated'")
    known_junctions = intron_rows(known).select("chrom", "a", "b").distinct()
    introns = intron_rows(placed)
    canonical = A.canonical_ratio(splice_motifs(genome, introns))
    near = A.indels_near_junctions(alignments, reach)
    total = isoforms.agg(F.count(F.lit(1)).alias("reads_total"))
    cover = A.junction_features(isoforms, junctions, known_junctions, near, total)
    bite = A.biting_isoforms(isoforms.filter("annotation = 'novel'"), known_junctions, distinct_exons(known)).withColumn("bite", F.lit(1).cast("long"))
    names = {"sd_cov": "sdJuncCov", "with_novel": "withNovelJunc", "min_novel_rpkm": "minNovelJuncRPKM", "min_rpkm": "minJuncRPKM", "n_indels": "nIndelsAroundJunc",
             "min_to_all": "ratioMinJuncCovToAllCov", "n_junc_indels": "nJuncsWithIndels", "canonical_ratio": "canJuncRatio"}
    out = support_part(isoforms)
    for part in (sequence_part(genome, placed, model), canonical, cover.withColumn("with_novel", F.col("with_novel").cast("long")), bite):
        out = out.join(part.withColumnsRenamed(names), "iso", "left")
    out = out.withColumn("indelNearJunc", (F.coalesce("nIndelsAroundJunc", F.lit(0)) > 0).cast("long")).fillna({"codingLabel": "noncoding", "orfIntegrity": -1})
    kind = dict(out.dtypes)
    number = lambda c: F.round(F.coalesce(c, F.lit(0.0)), 3).alias(c) if kind[c] == "double" else F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select("iso", *[F.col(c) if kind[c] == "string" else number(c) for c in COLUMNS])
