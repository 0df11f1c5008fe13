"""Readers and writers on text that is made from the tables: alignment lines with tags, sequence records, headed tables."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from spliceloom.functions import alignment as AL
from spliceloom.functions import blocks as B
from spliceloom.plans import proxy as P
from spliceloom.plans.registry import query, view
from spliceloom.session import work_dir
from spliceloom.sources import sequences as SQ
from spliceloom.sources import sinks as K
from spliceloom.sources import text as S

# every eleventh alignment is unmapped, every fourth sequence is a letter too long for its CIGAR; tags are absent for some
view("sam_v", """
SELECT name::VARCHAR AS name, name AS id, flag, name % 11 <> 0 AS mapped, chrom, name % 3 AS mapq, CASE WHEN name % 5 = 0 THEN '+' WHEN name % 5 = 1 THEN '.' END AS xs,
  CASE WHEN name % 7 > 0 THEN ['REF', 'ALT', 'OTHER'][1 + name % 3] END AS rg, CASE WHEN name % 13 > 0 THEN 1 + name % 2 END AS nh FROM aln_v""")


def sam_rows(spark, sf):
    a, k = P.alignments(spark, sf), F.col("name")
    size = AL.unclipped_length(F.col("cigar")) + (k % 4 == 0).cast("int")
    rg = F.get(F.array(F.lit("REF"), F.lit("ALT"), F.lit("OTHER")), (k % 3).cast("int"))
    tags = [F.when(k % 5 == 0, "XS:A:+").when(k % 5 == 1, "XS:A:."), F.when(k % 7 > 0, F.concat(F.lit("RG:Z:"), rg)), F.when(k % 13 > 0, F.concat(F.lit("NH:i:"), 1 + k % 2)),
            F.concat(F.lit("MD:Z:"), "md"), F.lit("RG:Z:late")]
    value = F.concat_ws("\t", "name", F.col("flag") + F.when(k % 11 == 0, 4).otherwise(0), "chrom", "pos", k % 3, "cigar", F.lit("*"), F.lit("0"), F.lit("0"),
                        F.repeat(F.lit("A"), size.cast("int")), F.lit("*"), *tags)
    return S.sam(a.select(value.alias("value")).unionByName(spark.createDataFrame([("@HD\tVN:1.6",)], "value string")))


@query("sam_blocks", """
SELECT s.name, s.chrom, lo AS start, hi AS "end", mapq, CASE WHEN xs = '+' THEN '+' WHEN flag & 16 = 16 THEN '-' ELSE '+' END AS strand, exon_chain, coalesce(rg, 'late') AS "RG", coalesce(nh::VARCHAR, 'NA') AS "NH"
FROM sam_v s JOIN iso_v i ON i.iso = s.id WHERE mapped""")
def sam_blocks(spark, sf):
    out = S.sam_blocks(sam_rows(spark, sf), ["RG", "NH"], xs=True)
    return out.select("name", "chrom", "start", "end", F.col("mapq").cast("long").alias("mapq"), "strand", B.chain(F.col("exons")).alias("exon_chain"), "RG", "NH")


@query("unmapped_alignments", "SELECT name FROM sam_v WHERE NOT mapped")
def unmapped_alignments(spark, sf):
    return sam_rows(spark, sf).filter("not mapped").select("name")


@query("confident_alignments", "SELECT name FROM sam_v WHERE mapped AND mapq >= 1")
def confident_alignments(spark, sf):
    return sam_rows(spark, sf).filter("mapped AND mapq >= 1").select("name")


@query("hard_clip_consistent", "SELECT name FROM sam_v WHERE id % 4 <> 0")
def hard_clip_consistent(spark, sf):
    return S.hard_clip_consistent(sam_rows(spark, sf)).select("name")


@query("tagged_allele_reads", "SELECT name, rg AS allele FROM sam_v WHERE rg IN ('REF', 'ALT') AND nh = 1")
def tagged_allele_reads(spark, sf):
    return S.allele_reads(sam_rows(spark, sf))


def texts(spark, sf):
    return P.sequences(spark, sf).filter("seq IS NOT NULL")


@query("fasta_records", "SELECT id::VARCHAR AS id, seq FROM seq_v WHERE seq IS NOT NULL")
def fasta_records(spark, sf):
    """Records of sixty letters a line, with a comment behind the name."""
    path = work_dir(spark, "fasta")
    seq = F.regexp_replace("seq", "(.{60})", "$1\n")
    K.write_lines(texts(spark, sf).select(F.concat(F.lit(">"), "id", F.lit(" from a table\n"), seq).alias("value")), path)
    return SQ.fasta_records(spark, path)


@query("fastq_records", "SELECT id::VARCHAR AS id, seq, translate(seq, 'ACGTN', 'IIHH#') AS qual FROM seq_v WHERE seq IS NOT NULL")
def fastq_records(spark, sf):
    path = work_dir(spark, "fastq")
    K.write_lines(texts(spark, sf).select(F.concat(F.lit("@"), "id", F.lit("\n"), "seq", F.lit("\n+\n"), F.translate("seq", "ACGTN", "IIHH#")).alias("value")), path)
    return SQ.fastq_records(SQ.numbered_lines(spark, path))


def headed_copy(spark, df, name):
    """The table written with a header and tabs; the path."""
    path = work_dir(spark, name)
    K.write_headed(df, path)
    return path


@query("headed_table", "SELECT gene::VARCHAR AS gene, chrom, strand, min(lo)::VARCHAR AS start, max(hi)::VARCHAR AS \"end\" FROM iso_v GROUP BY gene, chrom, strand")
def headed_table(spark, sf):
    g = P.isoforms(spark, sf).groupBy("gene", "chrom", "strand").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return S.headed(spark, headed_copy(spark, g, "headed"))


@query("transcript_quantities", """
SELECT 'T' || p_partkey AS "Name", p_size::DOUBLE AS "Length", p_retailprice AS "TPM", CASE WHEN p_size % 9 > 0 THEN (p_size * 3)::DOUBLE END AS "NumReads" FROM part""")
def transcript_quantities(spark, sf):
    p = P.table(spark, sf, "part").select(F.concat(F.lit("T"), "p_partkey").alias("Name"), F.col("p_size").alias("Length"), F.col("p_retailprice").alias("TPM"),
                                          F.when(F.col("p_size") % 9 > 0, F.col("p_size") * 3).alias("NumReads"))
    return S.read_quant(spark, headed_copy(spark, p, "quant"))


@query("feature_file", """
SELECT iso::VARCHAR AS iso, len::DOUBLE AS "isoLength", CASE WHEN n_ex > 1 THEN n_ex::DOUBLE END AS "exonNum", CASE WHEN status = 'F' THEN 'annotated' ELSE 'novel' END AS annotation FROM iso_v""")
def feature_file(spark, sf):
    i = P.isoforms(spark, sf).select(F.col("iso").alias("isoform"), B.length(F.col("exons")).alias("isoLength"), F.when(F.size("exons") > 1, F.size("exons").cast("string")).otherwise("none").alias("exonNum"),
                                     F.when(F.col("status") == "F", "annotated").otherwise("novel").alias("annotation"))
    return S.read_features(spark, headed_copy(spark, i, "features"))


SHEET = """SELECT o_orderstatus AS project, 's' || o_custkey AS "sampleName", o_orderpriority AS condition, (o_orderkey % 3)::VARCHAR AS repeat, 'b' || o_orderkey AS "bamFile", 'paired' AS paired, '150' AS "readsLength" FROM orders"""


@query("condition_sheet", f"{SHEET} WHERE o_orderkey % 2 = 0 UNION ALL SELECT 'listed', c_name, c_mktsegment, '1', '', 'single', '100' FROM customer")
def condition_sheet(spark, sf):
    """One sheet with the seven columns in another order, which is taken, and one without `repeat`, which gives way to the sample list."""
    o = P.table(spark, sf, "orders").filter("o_orderkey % 2 = 0").select(
        F.col("o_orderpriority").alias("condition"), F.col("o_orderstatus").alias("project"), F.concat(F.lit("s"), "o_custkey").alias("sampleName"), (F.col("o_orderkey") % 3).alias("repeat"),
        F.concat(F.lit("b"), "o_orderkey").alias("bamFile"), F.lit("paired").alias("paired"), F.lit(150).alias("readsLength"))
    sample = P.table(spark, sf, "customer").select(F.lit("listed").alias("project"), F.col("c_name").alias("sampleName"), F.col("c_mktsegment").alias("condition"), F.lit("1").alias("repeat"),
                                                   F.lit("").alias("bamFile"), F.lit("single").alias("paired"), F.lit("100").alias("readsLength"))
    whole = S.headed(spark, headed_copy(spark, o, "sheet"))
    return S.condition_sheet(whole).unionByName(S.condition_sheet(whole.drop("repeat"), sample))


@query("haplotype_files", """
SELECT o_custkey::VARCHAR AS haplo, f AS iso, (count(*) FILTER (l_returnflag = f))::DOUBLE AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey, (SELECT DISTINCT l_returnflag AS f FROM lineitem) GROUP BY ALL""")
def haplotype_files(spark, sf):
    """Files of two column orders, each with its own first line and header; the first lines look like rows."""
    li = P.table(spark, sf, "lineitem").join(P.table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    wide = li.groupBy("o_custkey").pivot("l_returnflag").count().fillna(0)
    flags, paths = sorted(c for c in wide.columns if c != "o_custkey"), []

    def with_header(order):
        def run(batches):
            yield pa.RecordBatch.from_arrays([pa.array(["7\t1\t2\t3", "\t".join(["haplotype", *order])])], names=["value"])
            for b in batches:
                yield pa.RecordBatch.from_arrays([b.column(0)], names=["value"])
        return run

    for part, order in enumerate((flags, flags[::-1])):
        paths.append(work_dir(spark, "haplotypes"))
        body = wide.filter(f"o_custkey % 2 = {part}").select(F.concat_ws("\t", "o_custkey", *order).alias("value"))
        K.write_lines(body.mapInArrow(with_header(order), "value string"), paths[-1])
    return S.read_haplotypes(spark, paths)
