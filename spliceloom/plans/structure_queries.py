"""Readers, line layouts and block-list functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from spliceloom.functions import blocks as B
from spliceloom.operators import transcripts as TR
from spliceloom.plans import proxy as P
from spliceloom.plans.registry import query, view
from spliceloom.session import written
from spliceloom.sources import sinks as K
from spliceloom.sources import text as S

view("bedline_v", """
SELECT iso, chrom || chr(9) || min(s) || chr(9) || max(e) || chr(9) || iso || chr(9) || any_value(reads) || chr(9) || strand || chr(9) || min(s) || chr(9) || max(e)
  || chr(9) || '0,0,0' || chr(9) || count(*) || chr(9) || string_agg((e - s)::VARCHAR, ',' ORDER BY s) || chr(9)
  || string_agg((s - lo)::VARCHAR, ',' ORDER BY s) || chr(9) || gene AS value
FROM (SELECT exr_v.*, min(s) OVER (PARTITION BY iso) AS lo FROM exr_v) GROUP BY iso, chrom, strand, gene""")


def bed_lines(spark, sf):
    iso = P.isoforms(spark, sf).withColumn("name", F.col("iso")).withColumn("score", F.col("reads"))
    return K.bed12_lines(iso, ["gene"])


@query("bed12_lines", "SELECT value FROM bedline_v")
def bed12_lines(spark, sf):
    return bed_lines(spark, sf)


@query("bed12_scan", "SELECT chrom, lo AS start, hi AS \"end\", iso::VARCHAR AS name, reads::DOUBLE AS score, strand, gene::VARCHAR AS gene, exon_chain FROM iso_v")
def bed12_scan(spark, sf):
    rows = S.bed12(bed_lines(spark, sf), ["gene"])
    return rows.select("chrom", "start", "end", "name", "score", "strand", "gene", B.chain(F.col("exons")).alias("exon_chain"))


@query("bed6_scan", """SELECT chrom, s AS start, e AS "end", iso || '.' || k AS name, reads::DOUBLE AS score, strand, gene::VARCHAR AS gene FROM exr_v""")
def bed6_scan(spark, sf):
    ex = TR.exon_rows(P.isoforms(spark, sf), ["reads"])
    lines = ex.select(F.concat_ws("\t", "chrom", "s", "e", F.concat_ws(".", "iso", "k"), "reads", "strand", "gene").alias("value"))
    return S.bed6(lines, ["gene"])


@query("bed6_last_row_wins", """
SELECT gene::VARCHAR AS name, arg_max(s, iso * 100 + k) AS start, arg_max(e, iso * 100 + k) AS "end" FROM ex_v GROUP BY gene""")
def bed6_last_row_wins(spark, sf):
    ex = TR.exon_rows(P.isoforms(spark, sf)).select(F.col("gene").cast("string").alias("name"), F.col("s").alias("start"), F.col("e").alias("end"),
                                                    (F.col("iso") * 100 + F.col("k")).alias("at"))
    return S.last_wins(ex, "name", "at")


def gp_rows(spark, sf):
    return P.models(spark, sf).select(
        "chrom", "start", "end", F.col("trans").cast("string").alias("name"), "strand", F.col("cds_start").alias("thick_start"),
        F.col("cds_end").alias("thick_end"), "exons", F.col("gene").cast("string").alias("gene"))


view("frame_v", """
SELECT trans, s, k, CASE WHEN n > 0 THEN CAST(coalesce(sum(n) OVER (PARTITION BY trans ORDER BY CASE WHEN strand = '+' THEN s ELSE -s END
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) % 3 AS BIGINT) ELSE -1 END AS frame
FROM (SELECT trans, strand, s, k, greatest(least(e, ce) - greatest(s, cs), 0) AS n FROM mex_v)""")
view("gpline_v", """
SELECT trans || chr(9) || chrom || chr(9) || strand || chr(9) || lo || chr(9) || hi || chr(9) || cs || chr(9) || ce || chr(9) || n_ex || chr(9)
  || string_agg(m.s || ',', '' ORDER BY m.s) || chr(9) || string_agg(m.e || ',', '' ORDER BY m.s) || chr(9) || '0' || chr(9) || gene || chr(9) || 'unk' || chr(9) || 'unk'
  || chr(9) || string_agg(frame, ',' ORDER BY m.s) || ',' AS value
FROM mex_v m JOIN frame_v f USING (trans, k) GROUP BY trans, chrom, strand, lo, hi, cs, ce, n_ex, gene""")


@query("genepred_lines", "SELECT value FROM gpline_v")
def genepred_lines(spark, sf):
    return K.genepred_lines(gp_rows(spark, sf))


@query("genepred_scan", """
SELECT m.trans::VARCHAR AS trans, chrom, strand, cs AS cds_start, ce AS cds_end, gene::VARCHAR AS gene, string_agg(m.s || '-' || m.e, ';' ORDER BY m.s) AS exon_chain,
  string_agg(frame, ',' ORDER BY m.s) AS frames FROM mex_v m JOIN frame_v f USING (trans, k) GROUP BY ALL""")
def genepred_scan(spark, sf):
    gp = S.genepred(K.genepred_lines(gp_rows(spark, sf)))
    return gp.select("trans", "chrom", "strand", "cds_start", "cds_end", "gene", B.chain(F.col("exons")).alias("exon_chain"),
                     F.array_join("frames", ",").alias("frames"))


@query("genepred_scan_with_bin", "SELECT trans::VARCHAR AS trans, lo AS start, hi AS \"end\" FROM mod_v")
def genepred_scan_with_bin(spark, sf):
    lines = K.genepred_lines(gp_rows(spark, sf)).select(F.concat(F.lit("585\t"), "value").alias("value"))
    return S.genepred(lines, True).select("trans", "start", "end")


@query("exon_frames", "SELECT trans, k, frame FROM frame_v")
def exon_frames(spark, sf):
    m = P.models(spark, sf)
    fr = B.frames(F.col("exons"), F.col("cds_start"), F.col("cds_end"), F.col("strand"))
    return m.select("trans", F.posexplode(fr).alias("k", "frame")).select("trans", F.col("k").cast("long").alias("k"), F.col("frame").cast("long").alias("frame"))


@query("bed6_to_genepred", """
SELECT iso || '.' || k || chr(9) || chrom || chr(9) || strand || chr(9) || s || chr(9) || e || chr(9) || e || chr(9) || e || chr(9) || '1' || chr(9) || s || ',' || chr(9) || e || ','
  || chr(9) || '0' || chr(9) || iso || '.' || k || chr(9) || 'unk' || chr(9) || 'unk' || chr(9) || '-1,' AS value FROM ex_v""")
def bed6_to_genepred(spark, sf):
    ex = TR.exon_rows(P.isoforms(spark, sf))
    return K.genepred_lines(ex.select("chrom", F.col("s").alias("start"), F.col("e").alias("end"), F.concat_ws(".", "iso", "k").alias("name"), "strand"))


for _w, _expr in ((3, "chrom || chr(9) || lo || chr(9) || hi"),
                  (6, "chrom || chr(9) || lo || chr(9) || hi || chr(9) || trans || chr(9) || '0' || chr(9) || strand"),
                  (9, "chrom || chr(9) || lo || chr(9) || hi || chr(9) || trans || chr(9) || '0' || chr(9) || strand || chr(9) || cs || chr(9) || ce || chr(9) || '0,0,0'")):
    query(f"genepred_to_bed{_w}", f"SELECT {_expr} || chr(9) || gene AS value FROM mod_v")(
        lambda spark, sf, w=_w: K.genepred_bed_lines(P.models(spark, sf), w, True))


@query("genepred_to_bed12", """
SELECT chrom || chr(9) || lo || chr(9) || hi || chr(9) || trans || chr(9) || '0' || chr(9) || strand || chr(9) || cs || chr(9) || ce || chr(9) || '0,0,0' || chr(9) || n_ex || chr(9)
  || string_agg((e - s)::VARCHAR, ',' ORDER BY s) || chr(9) || string_agg((s - lo)::VARCHAR, ',' ORDER BY s) || chr(9) || gene AS value
FROM mex_v GROUP BY chrom, lo, hi, trans, strand, cs, ce, n_ex, gene""")
def genepred_to_bed12(spark, sf):
    return K.genepred_bed_lines(P.models(spark, sf), 12, True)


@query("bed6_to_bed12", "SELECT iso, k, 1::BIGINT AS blocks, s || '-' || e AS exon_chain FROM ex_v")
def bed6_to_bed12(spark, sf):
    ex = TR.exon_rows(P.isoforms(spark, sf)).select("iso", F.col("k").cast("long").alias("k"), F.col("s").alias("start"), F.col("e").alias("end"))
    return K.one_block(ex).select("iso", "k", F.size("exons").cast("long").alias("blocks"), B.chain(F.col("exons")).alias("exon_chain"))


@query("bed12_from_intron_chain", "SELECT iso, exon_chain FROM iso_v")
def bed12_from_intron_chain(spark, sf):
    iso = P.isoforms(spark, sf).select("iso", "start", "end", B.introns(F.col("exons")).alias("introns"))
    return K.bed12_from_introns(iso).select("iso", B.chain(F.col("exons")).alias("exon_chain"))


@query("genepred_gene_rename", """
SELECT replace('T' || gene || '.' || trans, 'T' || gene, 'NEW') AS trans, 'NEW' AS gene, lo AS start FROM mod_v WHERE gene = (SELECT min(gene) FROM mod_v)""")
def genepred_gene_rename(spark, sf):
    m = P.models(spark, sf)
    first = m.agg(F.min("gene").alias("gene"))
    one = m.join(F.broadcast(first), "gene", "left_semi")  # one row
    named = one.select(F.concat(F.lit("T"), "gene", F.lit("."), "trans").alias("trans"), F.concat(F.lit("T"), "gene").alias("gene"), "start")
    return K.gene_models_of(named, F.col("gene"), "NEW").select("trans", "gene", "start")


@query("junction_scan", """
SELECT chrom, strand, js, je, CASE WHEN strand = '+' THEN js ELSE je END AS donor, CASE WHEN strand = '+' THEN je ELSE js END AS acceptor, cnt FROM junc_v""")
def junction_scan(spark, sf):
    j = P.junction_table(spark, sf)
    bed = j.select("chrom", "strand", F.concat_ws("-", "js", "je").alias("name"), F.col("cnt").alias("score"), F.array(
        B.block(F.col("start"), F.col("js")), B.block(F.col("je"), F.col("end"))).alias("exons"))
    return S.junctions(S.bed12(K.bed12_lines(bed))).drop("name")


@query("isoform_read_groups", "SELECT l_orderkey::VARCHAR AS iso, l_linenumber::VARCHAR AS read FROM lineitem")
def isoform_read_groups(spark, sf):
    return S.groups(group_lines(spark, sf))


def group_lines(spark, sf):
    li = P.table(spark, sf, "lineitem")
    reads = F.array_join(F.collect_list(F.col("l_linenumber").cast("string")), ",")
    return li.groupBy("l_orderkey").agg(reads.alias("_r")).select(F.concat_ws("\t", "l_orderkey", "_r").alias("value"))


@query("read_abundance", "SELECT l_linenumber::VARCHAR AS read, l_orderkey::VARCHAR AS iso, '+' AS strand, '1' AS weight FROM lineitem")
def read_abundance(spark, sf):
    return K.abundance(S.groups(group_lines(spark, sf)), {"strand": "+", "weight": "1"})


@query("key_value_mapping", """
SELECT k, v FROM (SELECT c_mktsegment AS k, arg_max(c_name, c_custkey) AS name FROM customer GROUP BY 1) t, unnest(string_split(name, '#')) AS u(v)""")
def key_value_mapping(spark, sf):
    c = P.table(spark, sf, "customer")
    return S.mapping(c.select("c_custkey", F.concat_ws("\t", "c_mktsegment", "c_name").alias("value")), "c_custkey", value_sep="#")


@query("haplotype_matrix", """
SELECT o_custkey AS haplo, f AS iso, count(*) FILTER (l_returnflag = f) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey,
  (SELECT DISTINCT l_returnflag AS f FROM lineitem) GROUP BY ALL""")
def haplotype_matrix(spark, sf):
    li = P.table(spark, sf, "lineitem").join(P.table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    wide = li.groupBy("o_custkey").pivot("l_returnflag").count().fillna(0)  # a column for every flag there is
    return S.haplotype_long(wide, "o_custkey")


@query("tail_lengths", """
SELECT l_orderkey AS readname, max({'a': l_linenumber, 'b': l_extendedprice}).b AS polya_length FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1""")
def tail_lengths(spark, sf):
    li = P.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("readname"), F.col("l_extendedprice").alias("polya_length"),
        F.when(F.col("l_linestatus") == "F", "PASS").otherwise("SUFFCLIP").alias("qc_tag"), F.col("l_linenumber").alias("source_order"))
    return S.polya_lengths(li)


view("vcf_v", """
SELECT 'chr' || (p_partkey % 5) AS chrom, p_partkey AS pos, substr('ACGT', CAST(p_size % 4 + 1 AS BIGINT), 1) AS ref, substr('ACGT', CAST((p_size + 1 + p_partkey % 3) % 4 + 1 AS BIGINT), 1) AS alt,
  CASE WHEN p_size % 2 = 0 THEN '0.5' ELSE '1' END AS af, CASE WHEN p_size % 3 = 0 THEN 'snp,ins' ELSE 'snp' END AS type, p_size FROM part""")


def vcf_lines(spark, sf):
    p = P.table(spark, sf, "part")
    base = lambda n: F.substring(F.lit("ACGT"), (n % 4 + 1).cast("int"), F.lit(1))
    info = F.concat(F.lit("DP=9;AF="), F.when(F.col("p_size") % 2 == 0, "0.5").otherwise("1"), F.lit(";TYPE="),
                    F.when(F.col("p_size") % 3 == 0, "snp,ins").otherwise("snp"))
    return p.select(F.concat_ws("\t", F.concat(F.lit("chr"), F.col("p_partkey") % 5), "p_partkey", F.lit("."), base(F.col("p_size")),
                                base(F.col("p_size") + 1 + F.col("p_partkey") % 3), F.lit("50"), F.lit("."), info).alias("value"))


@query("vcf_snps", "SELECT chrom, pos, ref, alt, af, type FROM vcf_v")
def vcf_snps(spark, sf):
    return S.vcf_snps(vcf_lines(spark, sf))


@query("vcf_heterozygous", "SELECT chrom, pos, ref, alt FROM vcf_v WHERE af = '0.5' AND type = 'snp'")
def vcf_heterozygous(spark, sf):
    return S.heterozygous(S.vcf_snps(vcf_lines(spark, sf))).select("chrom", "pos", "ref", "alt")


@query("vcf_locus_strings", "SELECT chrom || ':' || (pos // 100) AS locus, string_agg(ref, '' ORDER BY pos) AS ref_text, string_agg(alt, '' ORDER BY pos) AS alt_text FROM vcf_v GROUP BY 1")
def vcf_locus_strings(spark, sf):
    snps = S.vcf_snps(vcf_lines(spark, sf))
    # a locus is a stretch of 100 bases, so a locus holds at most 100 SNPs
    return S.vcf_strings(snps.withColumn("locus", F.concat_ws(":", "chrom", F.floor(F.col("pos") / 100).cast("long"))))


@query("differential_table_union", """
SELECT 'IR' AS as_type, p_partkey AS id, p_retailprice AS fdr, NULL AS extra FROM part UNION ALL SELECT 'SE', s_suppkey, s_acctbal, s_name FROM supplier""")
def differential_table_union(spark, sf):
    a = P.table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_retailprice").alias("fdr"))
    b = P.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("fdr"), F.col("s_name").alias("extra"))
    return S.differential_tables({"IR": a, "SE": b})


@query("gene_terms", "SELECT p_brand AS term, p_partkey AS gene FROM part")
def gene_terms(spark, sf):
    return S.term_members(P.table(spark, sf, "part").select(F.col("p_partkey").alias("gene"), F.col("p_brand").alias("term")))


@query("column_pick", "SELECT l_returnflag || ':' || l_linestatus AS picked FROM lineitem WHERE l_returnflag || ':' || l_linestatus = 'N:O'")
def column_pick(spark, sf):
    li = P.table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_orderkey")
    return S.pick(li, [(1, 2)], ":", equals="N:O")


# block-list functions over all isoforms or models

@query("exon_lists", "SELECT iso, exon_chain, n_ex FROM iso_v")
def exon_lists(spark, sf):
    return P.isoforms(spark, sf).select("iso", B.chain(F.col("exons")).alias("exon_chain"), F.size("exons").cast("long").alias("n_ex"))


@query("intron_lists", "SELECT iso, chain FROM iso_v")
def intron_lists(spark, sf):
    return P.isoforms(spark, sf).select("iso", B.chain(B.introns(F.col("exons"))).alias("chain"))


@query("block_lengths", "SELECT iso, CAST(len AS BIGINT) AS exon_len, CAST(hi - lo - len AS BIGINT) AS intron_len, hi - lo AS span FROM iso_v")
def block_lengths(spark, sf):
    x = F.col("exons")
    return P.isoforms(spark, sf).select("iso", B.length(x).alias("exon_len"), B.length(B.introns(x)).alias("intron_len"), (F.col("end") - F.col("start")).alias("span"))


@query("cds_and_utr_lengths", """
SELECT trans, CAST(sum(greatest(least(e, ce) - greatest(s, cs), 0)) AS BIGINT) AS cds,
  CAST(sum(CASE WHEN strand = '+' THEN greatest(least(e, cs) - s, 0) ELSE greatest(e - greatest(s, ce), 0) END) AS BIGINT) AS utr5,
  CAST(sum(CASE WHEN strand = '+' THEN greatest(e - greatest(s, ce), 0) ELSE greatest(least(e, cs) - s, 0) END) AS BIGINT) AS utr3 FROM mex_v GROUP BY trans""")
def cds_and_utr_lengths(spark, sf):
    x, a, b, st = F.col("exons"), F.col("cds_start"), F.col("cds_end"), F.col("strand")
    return P.models(spark, sf).select("trans", B.cds_length(x, a, b).alias("cds"), B.utr_length(x, a, b, st, 5).alias("utr5"), B.utr_length(x, a, b, st, 3).alias("utr3"))


@query("cds_blocks", """
SELECT trans, string_agg(greatest(s, cs) || '-' || least(e, ce), ';' ORDER BY s) FILTER (least(e, ce) > greatest(s, cs)) AS cds,
  coalesce(string_agg(s || '-' || least(e, cs), ';' ORDER BY s) FILTER (s < cs), '') AS left_utr,
  coalesce(string_agg(greatest(s, ce) || '-' || e, ';' ORDER BY s) FILTER (e > ce), '') AS right_utr FROM mex_v GROUP BY trans""")
def cds_blocks(spark, sf):
    x, a, b = F.col("exons"), F.col("cds_start"), F.col("cds_end")
    return P.models(spark, sf).select("trans", B.chain(B.clip(x, a, b)).alias("cds"), B.chain(B.left_utr(x, a)).alias("left_utr"), B.chain(B.right_utr(x, b)).alias("right_utr"))


@query("both_utr_blocks", """
SELECT trans, string_agg(s || '-' || e, ';' ORDER BY s) AS utr FROM (SELECT trans, s, least(e, cs) AS e FROM mex_v WHERE s < cs
  UNION ALL SELECT trans, greatest(s, ce), e FROM mex_v WHERE e > ce) GROUP BY trans""")
def both_utr_blocks(spark, sf):
    return P.models(spark, sf).select("trans", B.chain(B.both_utrs(F.col("exons"), F.col("cds_start"), F.col("cds_end"))).alias("utr"))


view("pair_v", """
SELECT a.trans, a.gene, b.iso FROM (SELECT m.gene, min(m.trans) AS trans FROM mod_v m JOIN iso_v i ON i.iso = m.trans GROUP BY m.gene, i.exon_chain) a JOIN iso_v b ON a.gene = b.gene AND b.status = 'O'""")


def distinct_models(spark, sf):
    """Every annotated structure of a gene: transcripts of one exon chain are one row, named by the first, so copies do not multiply the pairs."""
    rows = F.min(F.struct("trans", "strand", "cds_start", "cds_end"))
    return P.models(spark, sf).groupBy("gene", "exons").agg(rows.alias("_m")).select("gene", "exons", "_m.*")


def gene_pairs(spark, sf):
    """O isoforms against every annotated structure of their gene."""
    m = distinct_models(spark, sf).select("gene", "trans", "strand", F.col("exons").alias("old_exons"))
    i = P.isoforms(spark, sf).filter(F.col("status") == "O").select("gene", "iso", F.col("exons").alias("new_exons"))
    return i.join(m, "gene")


@query("block_intersections", """
SELECT p.trans, p.iso, coalesce(string_agg(greatest(x.s, y.s) || '-' || least(x.e, y.e), ';' ORDER BY greatest(x.s, y.s), least(x.e, y.e)), '') AS blocks,
  CAST(coalesce(sum(least(x.e, y.e) - greatest(x.s, y.s)), 0) AS BIGINT) AS bp
FROM pair_v p LEFT JOIN (ex_v x JOIN ex_v y ON x.gene = y.gene AND x.s <= y.e AND y.s <= x.e) ON x.iso = p.trans AND y.iso = p.iso GROUP BY ALL""")
def block_intersections(spark, sf):
    both = B.intersect(F.col("old_exons"), F.col("new_exons"))
    return gene_pairs(spark, sf).select("trans", "iso", both.alias("x")).select("trans", "iso", B.chain(F.col("x")).alias("blocks"), B.length(F.col("x")).alias("bp"))


@query("merged_blocks", "SELECT iso, exon_chain FROM iso_v")
def merged_blocks(spark, sf):
    per = P.slots(spark, sf).groupBy("iso").agg(F.collect_list(B.block(F.col("s"), F.col("e"))).alias("parts"))
    return per.select("iso", B.chain(B.merge(F.col("parts"))).alias("exon_chain"))


@query("union_of_transcripts", """
WITH u AS (SELECT DISTINCT p.trans, p.iso, x.s, x.e FROM pair_v p JOIN ex_v x ON x.iso = p.trans OR x.iso = p.iso),
g AS (SELECT *, max(e) OVER (PARTITION BY trans, iso ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM u),
h AS (SELECT *, sum(CASE WHEN p IS NULL OR s > p THEN 1 ELSE 0 END) OVER (PARTITION BY trans, iso ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS i FROM g)
SELECT trans, iso, string_agg(s || '-' || e, ';' ORDER BY s) AS blocks FROM (SELECT trans, iso, i, min(s) AS s, max(e) AS e FROM h GROUP BY ALL) GROUP BY ALL""")
def union_of_transcripts(spark, sf):
    return gene_pairs(spark, sf).select("trans", "iso", B.chain(B.union(F.col("old_exons"), F.col("new_exons"))).alias("blocks"))


@query("subtracted_blocks", """
WITH cut AS (SELECT p.trans, p.iso, s AS pt FROM pair_v p JOIN ex_v ON ex_v.iso IN (p.trans, p.iso) UNION SELECT p.trans, p.iso, e FROM pair_v p JOIN ex_v ON ex_v.iso IN (p.trans, p.iso)),
seg AS (SELECT trans, iso, pt AS s, lead(pt) OVER (PARTITION BY trans, iso ORDER BY pt) AS e FROM cut),
keep AS (SELECT g.trans, g.iso, g.s, g.e FROM seg g WHERE g.e IS NOT NULL AND EXISTS (SELECT 1 FROM ex_v x WHERE x.iso = g.trans AND x.s <= g.s AND g.e <= x.e)
  AND NOT EXISTS (SELECT 1 FROM ex_v x WHERE x.iso = g.iso AND x.s <= g.s AND g.e <= x.e)),
joined AS (SELECT *, sum(n) OVER (PARTITION BY trans, iso ORDER BY s) AS i FROM (SELECT *, CASE WHEN lag(e) OVER (PARTITION BY trans, iso ORDER BY s) = s THEN 0 ELSE 1 END AS n FROM keep)),
runs AS (SELECT trans, iso, min(s) AS s, max(e) AS e FROM joined GROUP BY trans, iso, i)
SELECT p.trans, p.iso, coalesce(string_agg(s || '-' || e, ';' ORDER BY s), '') AS blocks FROM pair_v p LEFT JOIN runs USING (trans, iso) GROUP BY ALL""")
def subtracted_blocks(spark, sf):
    return gene_pairs(spark, sf).select("trans", "iso", B.chain(B.subtract(F.col("old_exons"), F.col("new_exons"))).alias("blocks"))


@query("structure_containment", """
WITH c AS (SELECT i.iso, i.chain, i.n_ex, i.lo, i.hi FROM iso_v i)
SELECT p.trans, p.iso, coalesce(a.n_ex > 1 AND b.n_ex > 1 AND contains(';' || a.chain || ';', ';' || b.chain || ';')
  AND (starts_with(a.chain || ';', b.chain || ';') OR b.lo >= (SELECT max(s) FROM ex_v x WHERE x.iso = p.trans AND x.e = (SELECT min(e) FROM ex_v z WHERE z.iso = p.iso)))
  AND (ends_with(';' || a.chain, ';' || b.chain) OR b.hi <= (SELECT min(e) FROM ex_v x WHERE x.iso = p.trans AND x.s = (SELECT max(s) FROM ex_v z WHERE z.iso = p.iso))), false) AS inside
FROM pair_v p JOIN c a ON a.iso = p.trans JOIN c b ON b.iso = p.iso""")
def structure_containment(spark, sf):
    return gene_pairs(spark, sf).select("trans", "iso", B.contains(F.col("old_exons"), F.col("new_exons")).alias("inside"))


@query("touching_spans", "SELECT p.trans, p.iso, greatest(a.lo, b.lo) <= least(a.hi, b.hi) AS touches FROM pair_v p JOIN iso_v a ON a.iso = p.trans JOIN iso_v b ON b.iso = p.iso")
def touching_spans(spark, sf):
    o, n = F.col("old_exons"), F.col("new_exons")
    return gene_pairs(spark, sf).select("trans", "iso", B.touches(o[0]["s"], F.element_at(o, -1)["e"], n[0]["s"], F.element_at(n, -1)["e"]).alias("touches"))


@query("relative_blocks", "SELECT iso, string_agg((s - lo)::VARCHAR, ',' ORDER BY s) AS starts, string_agg((e - s)::VARCHAR, ',' ORDER BY s) AS sizes FROM (SELECT iso, s, e, min(s) OVER (PARTITION BY iso) AS lo FROM ex_v) GROUP BY iso")
def relative_blocks(spark, sf):
    return P.isoforms(spark, sf).select("iso", B.starts_text(F.col("exons")).alias("starts"), B.sizes_text(F.col("exons")).alias("sizes"))


SLICE = """
SELECT iso, coalesce(string_agg((s + greatest({lo} - done, 0)) || '-' || (s + least({hi} - done, e - s)), ';' ORDER BY s)
  FILTER (greatest({lo} - done, 0) < least({hi} - done, e - s)), '') AS blocks
FROM (SELECT iso, s, e, sum(e - s) OVER (PARTITION BY iso ORDER BY s) - (e - s) AS done, sum(e - s) OVER (PARTITION BY iso) AS total FROM ex_v) GROUP BY iso"""


@query("relative_slice_forward", SLICE.format(lo="150", hi="450"))
def relative_slice_forward(spark, sf):
    return P.isoforms(spark, sf).select("iso", B.chain(B.slice_by_length(F.col("exons"), F.lit(150), F.lit(450))).alias("blocks"))


@query("relative_slice_reverse", SLICE.format(lo="(total - 450)", hi="(total - 150)"))
def relative_slice_reverse(spark, sf):
    return P.isoforms(spark, sf).select("iso", B.chain(B.slice_by_length(F.col("exons"), F.lit(150), F.lit(450), True)).alias("blocks"))


SITE_CASE = """CASE WHEN site <= lo OR site > hi THEN 'Intergenic' WHEN site - 1 = lo THEN CASE WHEN strand = '+' THEN 'TSS' ELSE 'TTS' END
  WHEN site = hi THEN CASE WHEN strand = '+' THEN 'TTS' ELSE 'TSS' END
  WHEN xs IS NOT NULL THEN (CASE WHEN site <= cs OR ce < site THEN 'UTR' ELSE 'CDS' END) || (CASE WHEN site - 1 = xs AND site - 1 <> cs THEN '_Left' ELSE '' END)
    || (CASE WHEN site - 1 = cs THEN '_Start' ELSE '' END) || (CASE WHEN site = xe AND site <> ce THEN '_Right' ELSE '' END) || (CASE WHEN site = ce THEN '_End' ELSE '' END)
  ELSE (CASE WHEN site > cs AND site < ce THEN 'CDS_Intron' ELSE 'UTR_Intron' END) || (CASE WHEN site - 1 = pe THEN '_Left' ELSE '' END) || (CASE WHEN site = ns THEN '_Right' ELSE '' END) END"""
view("site_v", f"""
SELECT trans, iso, site, which, {SITE_CASE} AS type, CASE WHEN site <= lo THEN 0 WHEN site > hi THEN n_ex - 1 WHEN site - 1 = lo THEN 0 WHEN site = hi THEN n_ex - 1
  WHEN xs IS NOT NULL THEN xk ELSE pk END AS idx
FROM (SELECT p.trans, p.iso, q.which, q.site, m.lo, m.hi, m.cs, m.ce, m.strand, m.n_ex, x.s AS xs, x.e AS xe, x.k AS xk, y.e AS pe, y.next_s AS ns, y.k AS pk
  FROM pair_v p JOIN mod_v m ON m.trans = p.trans JOIN (SELECT iso, lo + 1 AS site, 'first' AS which FROM iso_v UNION ALL SELECT iso, hi, 'last' FROM iso_v) q ON q.iso = p.iso
  LEFT JOIN ex_v x ON x.iso = p.trans AND x.s < q.site AND q.site <= x.e LEFT JOIN ex_v y ON y.iso = p.trans AND y.e < q.site AND q.site <= y.next_s)""")


def sited(spark, sf):
    i = P.isoforms(spark, sf).filter(F.col("status") == "O").select("gene", "iso", "start", "end")
    p = i.join(distinct_models(spark, sf), "gene")
    cls = lambda s: B.site_class(s, F.col("cds_start"), F.col("cds_end"), F.col("exons"), F.col("strand"))
    return p.withColumn("a", cls(F.col("start") + 1)).withColumn("b", cls(F.col("end")))


@query("site_classes", "SELECT trans, iso, which, type, CAST(idx AS BIGINT) AS idx FROM site_v")
def site_classes(spark, sf):
    p = sited(spark, sf)
    two = F.explode(F.array(F.struct(F.lit("first").alias("which"), F.col("a").alias("c")), F.struct(F.lit("last").alias("which"), F.col("b").alias("c"))))
    return p.select("trans", "iso", two.alias("w")).select("trans", "iso", "w.which", "w.c.type", F.col("w.c.index").cast("long").alias("idx"))


view("region_v", """
SELECT *, ta || '-Adjacent-' || tb AS adj, ta || '-Span-' || tb AS span, ta || '-In-' || tb AS inn,
  ends_with(ta, '_Left') AND ends_with(tb, '_Right') AND split_part(ta, '_', 1) = split_part(tb, '_', 1) AS whole FROM (
  SELECT a.trans, a.iso, a.type AS ta, b.type AS tb, a.idx AS ia, b.idx AS ib, i.lo AS rs, i.hi AS re, m.lo, m.hi
  FROM site_v a JOIN site_v b ON a.trans = b.trans AND a.iso = b.iso AND a.which = 'first' AND b.which = 'last' JOIN iso_v i ON i.iso = a.iso JOIN mod_v m ON m.trans = a.trans)""")


@query("region_classes", """
SELECT trans, iso, CASE
  WHEN ta IN ('TSS', 'TTS') THEN CASE WHEN ia = ib THEN adj ELSE span END
  WHEN regexp_matches(ta, '^UTR(_(Left|Right))?$|^CDS(_(Left|Right|Start|End))?$') THEN CASE WHEN ia <> ib THEN span
    WHEN regexp_matches(tb, '^UTR(_(Left|Right))?$|^CDS(_(Left|Right|Start|End))?$') THEN CASE WHEN whole THEN split_part(ta, '_', 1) ELSE inn END ELSE adj END
  WHEN regexp_matches(ta, '^(UTR|CDS)_Intron') THEN CASE WHEN regexp_matches(tb, '^(UTR|CDS)_Intron') THEN CASE WHEN ia <> ib THEN span WHEN whole THEN split_part(ta, '_', 1) || '_Intron' ELSE inn END
    WHEN ia = ib - 1 THEN adj ELSE span END
  WHEN tb = 'Intergenic' THEN CASE WHEN re < lo OR rs > hi THEN 'Intergenic' ELSE 'Intergenic-Span-Intergenic' END
  WHEN ia = ib THEN adj ELSE span END AS label FROM region_v""")
def region_classes(spark, sf):
    return sited(spark, sf).select("trans", "iso", B.region_class(F.col("start"), F.col("end"), F.col("a"), F.col("b"), F.col("exons")).alias("label"))


@query("embedded_in_intron", """
SELECT p.trans, p.iso, EXISTS (SELECT 1 FROM intr_v x WHERE x.iso = p.trans AND x.a <= i.lo AND i.hi <= x.b) AS embedded FROM pair_v p JOIN iso_v i ON i.iso = p.iso""")
def embedded_in_intron(spark, sf):
    n = F.col("new_exons")
    return gene_pairs(spark, sf).select("trans", "iso", B.in_intron(F.col("old_exons"), n[0]["s"], F.element_at(n, -1)["e"]).alias("embedded"))


@query("explained_by_transcript", """
SELECT p.trans, p.iso, (EXISTS (SELECT 1 FROM ex_v x WHERE x.iso = p.trans AND x.s - 10 <= i.lo AND i.lo <= x.e) OR i.lo > m.hi)
  AND (EXISTS (SELECT 1 FROM ex_v x WHERE x.iso = p.trans AND x.s <= i.hi AND i.hi <= x.e + 10) OR i.hi > m.hi + 10) AS explained
FROM pair_v p JOIN iso_v i ON i.iso = p.iso JOIN mod_v m ON m.trans = p.trans""")
def explained_by_transcript(spark, sf):
    n = F.col("new_exons")
    return gene_pairs(spark, sf).select("trans", "iso", B.explained(F.col("old_exons"), n[0]["s"], F.element_at(n, -1)["e"], 10).alias("explained"))


@query("transcript_flags", """
SELECT i.iso, coalesce(bool_or(v.b - v.a = 800), false) AS has_800, i.lo < i.hi AS standard, i.status = 'F' AS complete FROM iso_v i LEFT JOIN intr_v v ON v.iso = i.iso GROUP BY ALL""")
def transcript_flags(spark, sf):
    x = F.col("exons")
    any800 = F.exists(B.introns(x), lambda i: B.has_intron(x, i["s"], i["s"] + 800))
    return P.isoforms(spark, sf).select("iso", any800.alias("has_800"), (F.col("start") < F.col("end")).alias("standard"), (F.col("status") == "F").alias("complete"))


@query("cds_exon_indexes", """
SELECT trans, min(k) FILTER (s <= cs AND cs <= e) AS first_exon, max(k) FILTER (s <= ce AND ce <= e) AS last_exon FROM mex_v GROUP BY trans""")
def cds_exon_indexes(spark, sf):
    x = F.col("exons")
    return P.models(spark, sf).select("trans", B.cds_start_exon(x, F.col("cds_start")).cast("long").alias("first_exon"), B.cds_end_exon(x, F.col("cds_end")).cast("long").alias("last_exon"))


@query("sewn_blocks", """
WITH cutp AS (SELECT iso, s, e FROM (SELECT iso, s, (s + e) // 2 AS e FROM ex_v UNION ALL SELECT iso, (s + e) // 2, e FROM ex_v))
SELECT iso, string_agg(s || '-' || e, ';' ORDER BY s) AS blocks FROM ex_v GROUP BY iso""")
def sewn_blocks(spark, sf):
    mid = lambda b: F.floor((b["s"] + b["e"]) / 2)
    halves = F.flatten(F.transform("exons", lambda b: F.array(B.block(b["s"], mid(b)), B.block(mid(b), b["e"]))))
    return P.isoforms(spark, sf).select("iso", halves.alias("h")).select("iso", B.chain(B.sew(F.col("h"))).alias("blocks"))


@query("changed_exons", """
WITH o AS (SELECT p.trans, p.iso, m.strand, p.gene FROM pair_v p JOIN mod_v m USING (trans)),
ends AS (SELECT iso, min(s) AS lo, max(e) AS hi, min(e) AS first_e, max(s) AS last_s, max(n) AS n FROM ex_v GROUP BY iso),
nx AS (SELECT o.trans, o.iso, o.strand, x.s, x.e, x.k, x.n FROM o JOIN ex_v x ON x.iso = o.iso)
SELECT trans, iso, 'new' AS kind, s, e FROM nx WHERE NOT EXISTS (SELECT 1 FROM ex_v y WHERE y.iso = nx.trans AND y.s <= nx.e AND nx.s <= y.e)
UNION ALL SELECT trans, nx.iso, 'first', nx.s, nx.e FROM nx JOIN ex_v y ON y.iso = trans AND y.k = 0 AND y.n > 1 AND nx.s < y.e AND y.s < nx.e AND nx.e < y.next_s AND nx.e <> y.e
UNION ALL SELECT trans, nx.iso, 'last', nx.s, nx.e FROM nx JOIN ex_v y ON y.iso = trans AND y.k = y.n - 1 AND y.n > 1 AND y.prev_e < nx.s AND nx.s < y.e AND nx.s <> y.s AND nx.e > y.s
UNION ALL SELECT DISTINCT trans, nx.iso, 'inner', nx.s, nx.e FROM nx JOIN ex_v y ON y.iso = trans AND y.k > 0 AND y.k < y.n - 1 AND y.prev_e < nx.s AND nx.s < y.e AND y.s < nx.e
  AND nx.e < y.next_s AND NOT (y.s = nx.s AND y.e = nx.e) AND NOT (nx.k = 0 AND nx.s > y.s) AND NOT (nx.k = nx.n - 1 AND nx.e < y.e)
UNION ALL SELECT o.trans, o.iso, CASE WHEN strand = '+' THEN 'extension5' ELSE 'extension3' END, b.lo, a.lo FROM o JOIN ends a ON a.iso = o.trans JOIN ends b ON b.iso = o.iso WHERE b.lo < a.lo AND a.lo < b.first_e
UNION ALL SELECT o.trans, o.iso, CASE WHEN strand = '+' THEN 'extension3' ELSE 'extension5' END, a.hi, b.hi FROM o JOIN ends a ON a.iso = o.trans JOIN ends b ON b.iso = o.iso WHERE b.hi > a.hi AND a.hi > b.last_s""")
def changed_exons(spark, sf):
    return TR.compare_exons(gene_pairs(spark, sf)).select("trans", "iso", "kind", "s", "e")


@query("transcript_sites", """
SELECT 'tss' AS kind, trans, CASE WHEN strand = '+' THEN lo ELSE hi - 1 END AS start FROM mod_v UNION ALL SELECT 'tts', trans, CASE WHEN strand = '+' THEN hi - 1 ELSE lo END FROM mod_v""")
def transcript_sites(spark, sf):
    m = P.models(spark, sf)
    return TR.features(m, "tss").select(F.lit("tss").alias("kind"), "trans", "start").unionByName(TR.features(m, "tts").select(F.lit("tts").alias("kind"), "trans", "start"))


FEATURE = """SELECT '{kind}' AS kind, trans, s AS start, e AS "end", CAST(CASE WHEN strand = '+' THEN row_number() OVER (PARTITION BY trans ORDER BY s)
  ELSE row_number() OVER (PARTITION BY trans ORDER BY s DESC) END AS BIGINT) AS "index" FROM ({src})"""


@query("transcript_features", " UNION ALL ".join([
    FEATURE.format(kind="exon", src="SELECT trans, strand, s, e FROM mex_v"),
    FEATURE.format(kind="intron", src="SELECT trans, strand, e AS s, next_s AS e FROM mex_v WHERE next_s IS NOT NULL"),
    FEATURE.format(kind="cds", src="SELECT trans, strand, greatest(s, cs) AS s, least(e, ce) AS e FROM mex_v WHERE greatest(s, cs) < least(e, ce)")]))
def transcript_features(spark, sf):
    m = P.models(spark, sf)
    out = None
    for kind in ("exon", "intron", "cds"):
        one = TR.features(m, kind).select(F.lit(kind).alias("kind"), "trans", "start", "end", "index")
        out = one if out is None else out.unionByName(one)
    return out


@query("utr_features", """
SELECT prime, trans, s AS start, e AS "end" FROM (SELECT CASE WHEN strand = '+' THEN 5 ELSE 3 END AS prime, trans, s, least(e, cs) AS e FROM mex_v WHERE s < cs
  UNION ALL SELECT CASE WHEN strand = '+' THEN 3 ELSE 5 END, trans, greatest(s, ce), e FROM mex_v WHERE e > ce)""")
def utr_features(spark, sf):
    m = written(P.models(spark, sf), "models")  # read once for either prime
    part = lambda p: TR.features(m, "utr", p).select(F.lit(p).alias("prime"), "trans", "start", "end")
    return part(5).unionByName(part(3))


@query("feature_chains", """
SELECT 'exon' AS kind, trans, string_agg(s || '-' || e, ';' ORDER BY s) AS blocks FROM mex_v GROUP BY trans UNION ALL
SELECT 'intron', trans, string_agg(e || '-' || next_s, ';' ORDER BY s) FROM mex_v WHERE next_s IS NOT NULL GROUP BY trans UNION ALL
SELECT 'cds', trans, string_agg(greatest(s, cs) || '-' || least(e, ce), ';' ORDER BY s) FROM mex_v WHERE greatest(s, cs) < least(e, ce) GROUP BY trans""")
def feature_chains(spark, sf):
    m = P.models(spark, sf)
    out = None
    for kind in ("exon", "intron", "cds"):
        one = TR.feature_chains(m, kind).select(F.lit(kind).alias("kind"), "trans", B.chain(F.col("blocks")).alias("blocks"))
        out = one if out is None else out.unionByName(one)
    return out


def chrom_sizes(spark, sf):
    return P.isoforms(spark, sf).groupBy("chrom").agg((F.max("end") + 300).alias("length"))


view("size_v", "SELECT chrom, max(hi) + 300 AS length FROM iso_v GROUP BY chrom")


@query("chromosome_sizes", "SELECT chrom, length FROM size_v")
def chromosome_sizes(spark, sf):
    lines = chrom_sizes(spark, sf).select(F.concat_ws("\t", "chrom", "length").alias("value"))
    return S.columns(lines, [("chrom", "string"), ("length", "long")])


@query("flanking_regions", """
SELECT side, trans, greatest(s, 0) AS f_start, least(s + 1000, length) AS f_end FROM (
  SELECT chrom, 'up' AS side, trans, CASE WHEN strand = '+' THEN lo - 1000 ELSE hi END AS s FROM mod_v UNION ALL
  SELECT chrom, 'down', trans, CASE WHEN strand = '+' THEN hi ELSE lo - 1000 END FROM mod_v) JOIN size_v USING (chrom)""")
def flanking_regions(spark, sf):
    m, ln = P.models(spark, sf), chrom_sizes(spark, sf)
    part = lambda up: TR.flanks(m, ln, 1000, up).select(F.lit("up" if up else "down").alias("side"), "trans", "f_start", "f_end")
    return part(True).unionByName(part(False))


@query("three_prime_sites", """
SELECT DISTINCT chrom, strand, CASE WHEN strand = '+' THEN hi ELSE lo + 1 END AS "end" FROM iso_v""")
def three_prime_sites(spark, sf):
    return TR.three_prime_sites(P.isoforms(spark, sf)).select("chrom", "strand", "end")


@query("genome_tiles", "SELECT chrom, u AS start, least(u + 5000, length) AS \"end\" FROM size_v, unnest(range(0, length, 5000)) t(u)")
def genome_tiles(spark, sf):
    return TR.tiles(chrom_sizes(spark, sf), 5000)


@query("genome_parts", "SELECT chrom, u AS start, least(u + z, length) AS \"end\" FROM (SELECT *, (length + 6) // 7 AS z FROM size_v), unnest(range(0, length, z)) t(u)")
def genome_parts(spark, sf):
    return TR.n_tiles(chrom_sizes(spark, sf), 7)


view("mainpa_v", """
SELECT gene, arg_max(pos, n * 1000000000 - pos) AS peak FROM (SELECT gene, CASE WHEN strand = '+' THEN hi ELSE lo END AS pos, count(*) AS n FROM iso_v GROUP BY ALL) GROUP BY gene""")


@query("revised_three_prime_ends", """
SELECT x.iso, string_agg((CASE WHEN strand = '-' AND k = 0 AND peak <= e THEN peak - 1 ELSE s END) || '-' || (CASE WHEN strand = '+' AND k = n - 1 AND peak > s THEN peak ELSE e END), ';' ORDER BY s) AS exon_chain
FROM ex_v x JOIN mainpa_v USING (gene) GROUP BY x.iso""")
def revised_three_prime_ends(spark, sf):
    iso = P.isoforms(spark, sf)
    pos = F.when(F.col("strand") == "+", F.col("end")).otherwise(F.col("start"))
    n = iso.groupBy("gene", pos.alias("pos")).agg(F.count(F.lit(1)).alias("n"))
    peak = n.groupBy("gene").agg(F.min(F.struct((-F.col("n")).alias("neg"), F.col("pos").alias("pos")))["pos"].alias("peak"))
    peaks = iso.select("gene", "iso").join(peak, "gene").select("iso", "peak")
    return TR.revise_ends(iso, peaks).select("iso", B.chain(F.col("exons")).alias("exon_chain"))


@query("event_id_parts", """
SELECT event_id, split_part(event_id, ':', 1) AS gene, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r FROM se_v""")
def event_id_parts(spark, sf):
    from spliceloom.operators.events import skipped_exons
    parts = F.split(F.split("event_id", ":")[1], "@")
    return skipped_exons(P.isoforms(spark, sf)).select("event_id", F.split("event_id", ":")[0].alias("gene"), parts[0].cast("long").alias("l"), parts[2].cast("long").alias("r"))


@query("exon_rows_from_blocks", "SELECT iso, s, e, CAST(k AS BIGINT) AS k FROM ex_v")
def exon_rows_from_blocks(spark, sf):
    return TR.exon_rows(P.isoforms(spark, sf)).select("iso", "s", "e", F.col("k").cast("long").alias("k"))
