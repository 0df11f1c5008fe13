"""Text line layouts and writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spliceloom.functions import blocks as B


def _line(df: DataFrame, *parts: Column | str) -> DataFrame:
    return df.select(F.concat_ws("\t", *parts).alias("value"))


def bed12_line(extras: list[str] = ()) -> Column:
    """BED12 line of columns chrom, name, score, strand, exons (+ optional thick bounds as the span)."""
    x = F.col("exons")
    lo, hi = x[0]["s"], F.element_at(x, -1)["e"]
    return F.concat_ws("\t", "chrom", lo, hi, "name", "score", "strand", lo, hi, F.lit("0,0,0"), F.size(x),
                       B.sizes_text(x), B.starts_text(x), *extras)


def bed12_lines(df: DataFrame, extras: list[str] = ()) -> DataFrame:
    return df.select(bed12_line(extras).alias("value"))


def bed12_from_introns(df: DataFrame, introns: str = "introns") -> DataFrame:
    """Rebuild exons from the span and an intron list."""
    return df.withColumn("exons", B.from_introns(F.col("start"), F.col("end"), F.col(introns)))


def genepred_bed_lines(gp: DataFrame, width: int, with_gene: bool = False) -> DataFrame:
    """Gene models as BED3, 6, 9 or 12 lines, optionally followed by the gene."""
    x = F.col("exons")
    parts = [F.col("chrom"), F.col("start"), F.col("end"), F.col("trans"), F.lit("0"), F.col("strand"),
             F.col("cds_start"), F.col("cds_end"), F.lit("0,0,0"), F.size(x), B.sizes_text(x), B.starts_text(x)][:width]
    return _line(gp, *parts, *([F.col("gene")] if with_gene else []))


def genepred_lines(df: DataFrame) -> DataFrame:
    """BED rows (chrom, start, end, name, strand, optional thick bounds and exons) as genePred lines with exon frames."""
    if "exons" not in df.columns:
        df = df.withColumn("exons", F.array(B.block(F.col("start"), F.col("end"))))
    if "thick_start" not in df.columns:
        df = df.withColumn("thick_start", F.col("end")).withColumn("thick_end", F.col("end"))
    x, cs, ce = F.col("exons"), F.col("thick_start"), F.col("thick_end")
    join = lambda f: F.concat(F.array_join(F.transform(x, f), ","), F.lit(","))
    gene = F.col("gene") if "gene" in df.columns else F.col("name")
    frames = F.concat(F.array_join(B.frames(x, cs, ce, F.col("strand")), ","), F.lit(","))
    return _line(df, "name", "chrom", "strand", "start", "end", cs, ce, F.size(x),
                 join(lambda b: b["s"].cast("string")), join(lambda b: b["e"].cast("string")), F.lit("0"), gene,
                 F.lit("unk"), F.lit("unk"), frames)


def one_block(bed: DataFrame) -> DataFrame:
    """BED6 rows as one-block transcripts."""
    return bed.withColumn("exons", F.array(B.block(F.col("start"), F.col("end"))))


def gene_models_of(gp: DataFrame, gene, new_gene: str | None = None) -> DataFrame:
    """Models of one gene, with the gene id rewritten inside transcript and gene names when asked."""
    kept = gp.filter(F.col("gene") == gene)
    if new_gene is None:
        return kept
    return (kept.withColumn("trans", F.replace(F.col("trans").cast("string"), F.col("gene").cast("string"), F.lit(new_gene)))
                .withColumn("gene", F.lit(new_gene)))


def abundance(groups: DataFrame, constants: dict[str, str]) -> DataFrame:
    """Read-to-isoform long table with constant columns."""
    return groups.select("read", "iso", *[F.lit(v).alias(k) for k, v in constants.items()])


def event_lines(events: DataFrame, members: DataFrame, keys: list[str], per_line: int = 1000) -> DataFrame:
    """Events with comma lists of their members on both sides.

    A list longer than `per_line` goes over several numbered parts, split by a
    hash of the member, so no group has to be gathered whole; every usual event
    has exactly part 0.
    """
    sized = members.join(events.select(*keys, (F.greatest("n_inc", "n_exc") / per_line).alias("_f")), keys)
    parts = sized.withColumn("part", F.pmod(F.xxhash64("iso"), F.ceil(F.greatest("_f", F.lit(1.0)))))
    side = lambda s: F.array_join(F.array_sort(F.collect_list(F.when(F.col("side") == s, F.col("iso").cast("string")))), ",")
    lists = parts.groupBy(*keys, "part").agg(side("inc").alias("inc_isos"), side("exc").alias("exc_isos"))
    return events.join(lists, keys)


def write_lines(df: DataFrame, path: str) -> None:
    df.select("value").write.mode("overwrite").text(path)


def write_headed(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("sep", "\t").csv(path)
