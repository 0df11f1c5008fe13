"""Tab-separated text tables: readers over paths and the same parsers over line tables.

Every parser takes a DataFrame with a `value` line column, so a file read and a
table of lines go through one code path. Records are never collected; rows that
repeat a key are kept unless `last_wins` is asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spliceloom.functions import blocks as B

BED6 = [("chrom", "string"), ("start", "long"), ("end", "long"), ("name", "string"), ("score", "double"), ("strand", "string")]
BED12 = [*BED6, ("thick_start", "long"), ("thick_end", "long"), ("rgb", "string"), ("block_count", "long"),
         ("block_sizes", "string"), ("block_starts", "string")]
GENEPRED = [("trans", "string"), ("chrom", "string"), ("strand", "string"), ("start", "long"), ("end", "long"),
            ("cds_start", "long"), ("cds_end", "long"), ("exon_count", "long"), ("exon_starts", "string"),
            ("exon_ends", "string"), ("score", "double"), ("gene", "string"), ("cds_start_stat", "string"),
            ("cds_end_stat", "string"), ("frames", "string")]
SAM = [("name", "string"), ("flag", "int"), ("chrom", "string"), ("pos", "long"), ("mapq", "int"), ("cigar", "string"),
       ("mate_chrom", "string"), ("mate_pos", "long"), ("tlen", "long"), ("seq", "string"), ("qual", "string")]
# Feature columns used for learning, in matrix order.
FEATURES = ["isoLength", "flCount", "ratioIsoToGene", "exonNum", "GC", "orfLength", "orfIntegrity", "pepLength", "FickettScore", "pI",
            "codingP", "canJuncRatio", "sdJuncCov", "minJuncRPKM", "nIndelsAroundJunc", "ratioMinJuncCovToAllCov",
            "nJuncsWithIndels", "indelNearJunc"]
CONDITION_COLUMNS = ["project", "sampleName", "condition", "repeat", "bamFile", "paired", "readsLength"]


def lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path)


def columns(df: DataFrame, fields: list[tuple[str, str]], extras: list[str] = (), skip: str = "^(#|track |browser )",
            first: int = 0) -> DataFrame:
    """Cut lines at tabs into typed columns; `extras` name further text columns."""
    part = F.split("value", "\t")
    kept = df.filter(~F.col("value").rlike(skip) & (F.length("value") > 0)).select(part.alias("f"))
    typed = [F.get("f", F.lit(first + i)).try_cast(t).alias(n) for i, (n, t) in enumerate(fields)]
    more = [F.get("f", F.lit(first + len(fields) + i)).alias(n) for i, n in enumerate(extras)]
    return kept.select(*typed, *more)


def last_wins(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key: the row with the largest order value."""
    rest = [c for c in df.columns if c not in (key, order)]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(key, "_r.*")


def bed6(df: DataFrame, extras: list[str] = ()) -> DataFrame:
    return columns(df, BED6, extras)


def with_exons(df: DataFrame) -> DataFrame:
    """Turn the three BED12 block columns into an `exons` array."""
    return (df.withColumn("exons", B.from_text(F.col("start"), F.col("block_sizes"), F.col("block_starts")))
              .drop("block_count", "block_sizes", "block_starts"))


def bed12(df: DataFrame, extras: list[str] = ()) -> DataFrame:
    return with_exons(columns(df, BED12, extras))


def genepred(df: DataFrame, bin_column: bool = False) -> DataFrame:
    rows = columns(df, GENEPRED, first=1 if bin_column else 0)
    return (rows.withColumn("exons", B.from_edges(F.col("exon_starts"), F.col("exon_ends")))
                .withColumn("frames", F.transform(F.filter(F.split("frames", ","), lambda x: x != ""), lambda x: x.cast("int")))
                .drop("exon_count", "exon_starts", "exon_ends"))


def junctions(bed12_rows: DataFrame) -> DataFrame:
    """Two-block BED12 rows as junctions with donor, acceptor and read count."""
    x = F.col("exons")
    js, je = x[0]["e"], x[1]["s"]
    plus = F.col("strand") == "+"
    return (bed12_rows.filter(F.size(x) == 2).select(
        "chrom", "strand", "name", js.alias("js"), je.alias("je"), F.when(plus, js).otherwise(je).alias("donor"),
        F.when(plus, je).otherwise(js).alias("acceptor"), F.col("score").cast("long").alias("cnt")))


def groups(df: DataFrame, key: int = 0, value: int = 1, inner: str = ",") -> DataFrame:
    """`isoform <tab> read,read` lines as (iso, read) rows."""
    part = F.split("value", "\t")
    return (df.filter(F.length("value") > 0)
              .select(F.get(part, F.lit(key)).alias("iso"), F.explode(F.split(F.get(part, F.lit(value)), inner)).alias("read")))


def mapping(df: DataFrame, order: str, key: int = 0, value: int = 1, key_sep: str | None = None,
            value_sep: str | None = None) -> DataFrame:
    """Key-to-value lines; several keys or values may share a cell, the last line of a key wins."""
    part = F.split("value", "\t")
    rows = df.select(F.col(order), F.get(part, F.lit(key)).alias("k"), F.get(part, F.lit(value)).alias("v"))
    if key_sep:
        rows = rows.withColumn("k", F.explode(F.split("k", key_sep)))
    rows = last_wins(rows, "k", order)
    return rows.withColumn("v", F.explode(F.split("v", value_sep))) if value_sep else rows


def sam(df: DataFrame) -> DataFrame:
    """SAM body lines; `tags` maps tag names to values (the first of a name), `mapped` is false where flag bit 4 is set, `line` keeps the text."""
    # one element is exploded, so that filters on the columns stay behind the split: pushed below it, each would build and split the line again
    cut = df.select(F.explode(F.array(F.struct("value", F.split("value", "\t").alias("f")))).alias("_l")).select("_l.*")
    part, body = F.col("f"), cut.filter(~F.col("value").startswith("@"))
    named = F.transform(F.slice(part, len(SAM) + 1, F.greatest(F.size(part) - len(SAM), F.lit(0))), lambda t: F.struct(F.substring(t, 1, 2).alias("key"), F.substr(t, F.lit(6)).alias("value")))
    first = F.filter("_named", lambda t, i: F.array_position(F.transform("_named", lambda x: x["key"]), t["key"]) == i + 1)
    rows = body.select(*[F.get(part, F.lit(i)).try_cast(t).alias(n) for i, (n, t) in enumerate(SAM)], named.alias("_named"), F.col("value").alias("line"))
    return rows.withColumn("tags", F.map_from_entries(first)).withColumn("mapped", F.col("flag").bitwiseAND(4) == 0).drop("_named")


def sam_blocks(rows: DataFrame, tags: list[str] = (), xs: bool = False) -> DataFrame:
    """Mapped lines of `sam` as blocks: name, chrom, start, end, mapq, strand (the XS tag where asked for and + or -), exons, and a text column for each tag, NA if absent.

    The unmapped lines are the other branch of the same scan: ``rows.filter("not mapped")``.
    """
    from spliceloom.functions.alignment import cigar_blocks, strand_of
    exons = cigar_blocks(F.col("pos") - 1, F.col("cigar"))
    strand = strand_of(F.col("flag"), F.col("tags")["XS"] if xs else None)
    out = rows.filter("mapped").select("name", "chrom", "mapq", strand.alias("strand"), exons.alias("exons"), *[F.coalesce(F.col("tags")[t], F.lit("NA")).alias(t) for t in tags])
    return out.select("name", "chrom", F.col("exons")[0]["s"].alias("start"), F.element_at("exons", -1)["e"].alias("end"), "mapq", "strand", "exons", *tags)


def allele_reads(rows: DataFrame) -> DataFrame:
    """(name, allele): lines of `sam` whose read group is REF or ALT and which have one hit (NH is 1)."""
    one = rows.select("name", F.explode(F.array("tags")).alias("tags"))  # the tags are made once, not again for each use
    return one.filter(F.col("tags")["RG"].isin("REF", "ALT") & (F.col("tags")["NH"] == "1")).select("name", F.col("tags")["RG"].alias("allele"))


def hard_clip_consistent(rows: DataFrame) -> DataFrame:
    """Lines of `sam` whose CIGAR, without hard clips, is as long as their sequence."""
    from spliceloom.functions.alignment import unclipped_length
    return rows.filter(unclipped_length(F.col("cigar")) == F.length("seq"))


def vcf_snps(df: DataFrame) -> DataFrame:
    """Single-base biallelic variants with the AF and TYPE values of INFO."""
    part = F.split("value", "\t")
    info = F.get(part, F.lit(7))
    take = lambda k: F.regexp_extract(info, f"(?:^|;){k}=([^;]+)", 1)
    return (df.filter(~F.col("value").startswith("#"))
              .select(F.get(part, F.lit(0)).alias("chrom"), F.get(part, F.lit(1)).cast("long").alias("pos"),
                      F.get(part, F.lit(3)).alias("ref"), F.get(part, F.lit(4)).alias("alt"),
                      take("AF").alias("af"), take("TYPE").alias("type"))
              .filter((F.length("ref") == 1) & (F.length("alt") == 1)))


def heterozygous(snps: DataFrame) -> DataFrame:
    """SNPs with allele frequency 0.5 and the single type snp."""
    return snps.filter((F.col("af").try_cast("double") == 0.5) & (F.col("type") == "snp"))


def vcf_strings(snps: DataFrame, locus: str = "locus") -> DataFrame:
    """REF text and ALT text of each locus, bases in position order."""
    bases = F.array_sort(F.collect_list(F.struct("pos", "ref", "alt")))
    return snps.groupBy(locus).agg(bases.alias("_b")).select(
        locus, F.array_join(F.transform("_b", lambda b: b["ref"]), "").alias("ref_text"),
        F.array_join(F.transform("_b", lambda b: b["alt"]), "").alias("alt_text"))


def headed(spark: SparkSession, path: str | list[str], schema: str | None = None, sep: str = "\t", infer: bool = False) -> DataFrame:
    """A headed table with columns by name; text unless a schema is given or inferred (one more pass)."""
    reader = spark.read.option("header", True).option("sep", sep).option("inferSchema", infer)
    return (reader.schema(schema) if schema else reader).csv(path)


def polya_lengths(df: DataFrame) -> DataFrame:
    """PASS rows of tail estimates, one length per read (largest source order wins when given)."""
    ok = df.filter(F.col("qc_tag") == "PASS")
    order = ["source_order"] if "source_order" in df.columns else []
    return ok.groupBy("readname").agg(F.max(F.struct(*order, "polya_length"))["polya_length"].alias("polya_length"))


def haplotype_long(wide: DataFrame, index: str) -> DataFrame:
    """Haplotype x isoform count matrix as (haplo, iso, n) rows."""
    isos = [F.col(f"`{c}`").alias(c) for c in wide.columns if c != index]
    return wide.unpivot(index, isos, "iso", "n").withColumnRenamed(index, "haplo")


def condition_sheet(df: DataFrame, fallback: DataFrame | None = None) -> DataFrame:
    """The sheet when it has exactly the seven known columns, else the given sample list."""
    if sorted(df.columns) == sorted(CONDITION_COLUMNS):
        return df.select(*CONDITION_COLUMNS)
    if fallback is None:
        raise ValueError("condition sheet lacks the columns " + ", ".join(CONDITION_COLUMNS))
    return fallback


def differential_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """Union of per-type differential tables with their event type."""
    out = None
    for kind, df in tables.items():
        one = df.withColumn("as_type", F.lit(kind))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def term_members(gene2go: DataFrame) -> DataFrame:
    return gene2go.select("term", "gene")


def read_bed6(spark, path, extras=()):
    return bed6(lines(spark, path), list(extras))


def read_bed12(spark, path, extras=()):
    return bed12(lines(spark, path), list(extras))


def read_genepred(spark, path, bin_column=False):
    return genepred(lines(spark, path), bin_column)


def read_junctions(spark, path):
    return junctions(read_bed12(spark, path))


def read_groups(spark, path):
    return groups(lines(spark, path))


def read_sam(spark, path):
    return sam(lines(spark, path))


def read_vcf(spark, path):
    return vcf_snps(lines(spark, path))


def read_chrom_sizes(spark, path):
    return columns(lines(spark, path), [("chrom", "string"), ("length", "long")])


def pick(df: DataFrame, wanted: list[str | int | tuple[int, int]], sep: str | None = None, out: str = "picked",
         equals: str | None = None) -> DataFrame:
    """Columns by name, 1-based index or index range, optionally joined (a null is an empty cell) and compared with a text."""
    names: list[str] = []
    for w in wanted:
        if isinstance(w, tuple):
            names += df.columns[w[0] - 1:w[1]]
        else:
            names.append(df.columns[w - 1] if isinstance(w, int) else w)
    joined: Column = F.concat_ws(sep or "\t", *[F.coalesce(F.col(f"`{n}`").cast("string"), F.lit("")) for n in names])
    kept = df if equals is None else df.filter(joined == equals)
    return kept.select(joined.alias(out)) if sep else kept.select(*[F.col(f"`{n}`") for n in names])


def in_file_order(df: DataFrame) -> DataFrame:
    """Add `source_order`: place of a row by file, block of the file and line. Call it on a fresh scan."""
    return df.withColumn("source_order", F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()))


def read_polya(spark, paths):
    """Tail estimates by header name (readname, polya_length, qc_tag; others are ignored); the last row of a read wins."""
    rows = in_file_order(headed(spark, paths, infer=False))
    return polya_lengths(rows.select("readname", F.col("polya_length").try_cast("double").alias("polya_length"), "qc_tag", "source_order"))


def read_quant(spark, path):
    """Quantification table by header name; every column but Name is a number."""
    df = headed(spark, path, infer=False)
    return df.select(*[F.col(c) if c == "Name" else F.col(f"`{c}`").try_cast("double").alias(c) for c in df.columns])


def read_features(spark, path):
    """A user's own feature file in place of computed features; every column but the isoform is a number where it can be."""
    df = headed(spark, path, infer=False)
    typed = [F.col(f"`{c}`").try_cast("double").alias(c) if c in FEATURES else F.col(f"`{c}`") for c in df.columns]
    return df.select(*typed).withColumnRenamed("isoform", "iso")


def read_haplotypes(spark, path):
    """Count matrices as (haplo, iso, n): line 1 of each file is skipped whatever it holds, line 2 is that file's header, column 1 the index.

    Lines are told apart by file and place, not by their text, and each file's columns go by its own header.
    """
    text = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n")).alias("at"), "value")
    first = text.groupBy("file").agg(F.min("at").alias("_first"))
    header = text.join(first, "file").filter(F.col("at") > F.col("_first")).groupBy("file").agg(F.min(F.struct("at", "value")).alias("_h"))  # one row a file
    rows = text.join(header, "file").filter((F.col("at") > F.col("_h.at")) & (F.length("value") > 0))
    part, names = F.split("value", "\t"), F.split("_h.value", "\t")
    cells = rows.select(part[0].alias("haplo"), F.posexplode(names).alias("i", "iso"), part.alias("_p")).filter("i > 0")
    return cells.select("haplo", "iso", F.get("_p", F.col("i")).try_cast("double").alias("n"))
