"""Filters, id lists, interval joins and assignments."""

from __future__ import annotations

from pyspark.sql import functions as F

from spliceloom.functions import alignment as AL
from spliceloom.functions import blocks as B
from spliceloom.operators import assign as A
from spliceloom.operators import overlap as O
from spliceloom.operators import polya as PA
from spliceloom.operators import transcripts as TR
from spliceloom.plans import proxy as P
from spliceloom.plans.registry import query, view
from spliceloom.plans.structure_queries import chrom_sizes
from spliceloom.session import written


def part(spark, sf, status):
    return P.isoforms(spark, sf).filter(F.col("status") == status)


@query("rows_in_key_list", "SELECT l_orderkey AS k, min(l_suppkey) AS s FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT') GROUP BY 1")
def rows_in_key_list(spark, sf):
    keys = P.table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("k"))
    rows = P.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.min("l_suppkey").alias("s"))
    return A.by_keys(rows, keys, ["k"], True, True)


@query("rows_outside_key_list", """
SELECT l_orderkey AS k, l_linenumber AS n, l_partkey AS p FROM lineitem WHERE (l_orderkey, l_partkey) NOT IN (SELECT l_orderkey, l_partkey FROM lineitem WHERE l_returnflag = 'R')""")
def rows_outside_key_list(spark, sf):
    li = P.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p"), "l_returnflag")
    return A.by_keys(li.drop("l_returnflag"), li.filter("l_returnflag = 'R'"), ["k", "p"], False)


@query("junctions_by_support", "SELECT chrom, strand, js, je, cnt FROM junc_v WHERE cnt > 10")
def junctions_by_support(spark, sf):
    return P.junction_table(spark, sf).filter("cnt > 10").select("chrom", "strand", "js", "je", "cnt")


view("known_v", "SELECT DISTINCT chrom, a, b FROM intr_v WHERE status = 'F'")


@query("filtered_long_reads", """
WITH seen AS (SELECT chrom, a, b, count(*) AS seen FROM intr_v GROUP BY ALL),
sup AS (SELECT chrom, chain, count(*) AS n FROM iso_v WHERE n_ex > 1 GROUP BY ALL),
good AS (SELECT iso, count(*) FILTER (k.chrom IS NOT NULL OR seen >= 3) AS good, count(*) AS n, sum(i.b - i.a) AS total
  FROM intr_v i JOIN seen s USING (chrom, a, b) LEFT JOIN known_v k USING (chrom, a, b) GROUP BY iso)
SELECT iso FROM iso_v WHERE n_ex = 1 UNION ALL
SELECT i.iso FROM iso_v i JOIN good g USING (iso) JOIN sup USING (chrom, chain) WHERE total <= 4000 AND sup.n >= 2 AND (g.n >= 4 OR g.good * 3 >= g.n)""")
def filtered_long_reads(spark, sf):
    known = TR.intron_rows(part(spark, sf, "F")).select("chrom", "a", "b").distinct()
    return A.filter_reads(P.isoforms(spark, sf), known, max_intron=4000).select("iso")


@query("primary_alignments", "SELECT name FROM aln_v WHERE flag IN (0, 16)")
def primary_alignments(spark, sf):
    return P.alignments(spark, sf).filter(F.col("flag").isin(0, 16)).select("name")


@query("gene_junction_coverage_filter", """
WITH g AS (SELECT gene, chrom, strand, min(lo) AS lo, max(hi) AS hi FROM iso_v GROUP BY ALL),
p AS (SELECT DISTINCT g.gene, j.js, j.je, j.cnt FROM junc_v j JOIN g ON g.chrom = j.chrom AND g.strand = j.strand AND j.js < g.hi AND g.lo < j.je),
l AS (SELECT gene, greatest(quantile_cont(cnt, 0.5), avg(cnt)) AS level FROM p GROUP BY gene)
SELECT gene, js, je, cnt FROM p JOIN l USING (gene) WHERE cnt >= level * 0.5""")
def gene_junction_coverage_filter(spark, sf):
    j = P.junction_table(spark, sf).select("chrom", "strand", F.col("js").alias("start"), F.col("je").alias("end"), "cnt")
    g = P.isoforms(spark, sf).groupBy("gene", "chrom", "strand").agg(F.min("start").alias("g_start"), F.max("end").alias("g_end"))
    return A.covered_junctions(j, g, 0.5).select("gene", F.col("start").alias("js"), F.col("end").alias("je"), "cnt")


@query("valid_chains", "SELECT iso, bool_and(e - 250 > s) AS valid FROM ex_v GROUP BY iso")
def valid_chains(spark, sf):
    cut = F.transform("exons", lambda x: B.block(x["s"], x["e"] - 250))
    return P.isoforms(spark, sf).select("iso", B.valid(cut).alias("valid"))


@query("significant_rows", "SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount <= 0.05")
def significant_rows(spark, sf):
    from spliceloom.operators.significance import significant
    return significant(P.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount"), 0.05, "l_discount")


@query("target_genes", "SELECT iso FROM iso_v WHERE gene IN (SELECT o_custkey // 2 FROM orders WHERE o_totalprice > 400000)")
def target_genes(spark, sf):
    genes = P.table(spark, sf, "orders").filter("o_totalprice > 400000").select(F.floor(F.col("o_custkey") / 2).cast("long").alias("gene"))
    return A.by_keys(P.isoforms(spark, sf), genes, ["gene"]).select("iso")


@query("alignments_by_name", "SELECT name, chrom, pos FROM aln_v WHERE name IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '2-HIGH')")
def alignments_by_name(spark, sf):
    keys = P.table(spark, sf, "orders").filter("o_orderpriority = '2-HIGH'").select(F.col("o_orderkey").alias("name"))
    return A.by_keys(P.alignments(spark, sf), keys, ["name"]).select("name", "chrom", "pos").orderBy("chrom", "pos")


@query("allele_reads", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag IN ('A', 'R') AND l_linestatus = 'F'")
def allele_reads(spark, sf):
    return P.table(spark, sf, "lineitem").filter(F.col("l_returnflag").isin("A", "R") & (F.col("l_linestatus") == "F")).select("l_orderkey", "l_linenumber")


@query("rescued_isoforms", """
SELECT iso FROM iso_v WHERE status = 'O' AND reads >= 7 AND n_ex >= 5 UNION SELECT iso FROM iso_v WHERE status = 'F'""")
def rescued_isoforms(spark, sf):
    from spliceloom.operators.learning import rescued
    iso = P.isoforms(spark, sf)
    f = iso.select("iso", F.when(F.col("status") == "O", "novel").otherwise("annotated").alias("annotation"), F.col("reads").alias("flCount"), F.size("exons").alias("ratioIsoToGene"))
    return rescued(f, iso.filter("status = 'F'"), 7, 5)


@query("sequences_by_name", "SELECT DISTINCT p_name AS name FROM part WHERE p_name LIKE '%1'")
def sequences_by_name(spark, sf):
    return P.table(spark, sf, "part").select(F.col("p_name").alias("name")).filter(F.col("name").rlike("1$")).dropDuplicates(["name"])


@query("distinct_exons", "SELECT DISTINCT chrom, strand, s, e FROM ex_v")
def distinct_exons(spark, sf):
    return TR.distinct_exons(P.isoforms(spark, sf))


def spans(spark, sf, status, prefix=""):
    return part(spark, sf, status).select("chrom", "strand", F.col("iso").alias(f"{prefix}iso"), F.col("start").alias(f"{prefix}start"), F.col("end").alias(f"{prefix}end"))


PAIR = """FROM iso_v a JOIN iso_v b ON a.chrom = b.chrom {s} AND a.lo < b.hi AND b.lo < a.hi WHERE a.status = 'P' AND b.status = 'F'"""


@query("overlap_pairs", f"SELECT a.iso, b.iso AS r_iso {PAIR.format(s='AND a.strand = b.strand')}")
def overlap_pairs(spark, sf):
    return O.overlap_join(spans(spark, sf, "P"), spans(spark, sf, "F", "r_"), ["chrom", "strand"]).select("iso", "r_iso")


@query("overlap_pairs_split_hot_cells", f"SELECT a.iso, b.iso AS r_iso {PAIR.format(s='AND a.strand = b.strand')}")
def overlap_pairs_split_hot_cells(spark, sf):
    return O.overlap_join(spans(spark, sf, "P"), spans(spark, sf, "F", "r_"), ["chrom", "strand"], hot_rows=20, tile=2048).select("iso", "r_iso")


@query("overlap_pairs_any_strand", f"SELECT a.iso, b.iso AS r_iso {PAIR.format(s='')}")
def overlap_pairs_any_strand(spark, sf):
    return O.overlap_join(spans(spark, sf, "P"), spans(spark, sf, "F", "r_").drop("strand"), ["chrom"]).select("iso", "r_iso")


def exon_side(spark, sf, status, prefix=""):
    return TR.exon_rows(part(spark, sf, status)).select("chrom", "strand", F.col("s").alias(f"{prefix}start"), F.col("e").alias(f"{prefix}end")).distinct()


EXA = "(SELECT DISTINCT chrom, strand, s, e FROM ex_v WHERE status = 'O') a"
EXB = "(SELECT DISTINCT chrom, strand, s, e FROM ex_v WHERE status = 'F') b"


@query("exons_without_overlap", f"SELECT a.* FROM {EXA} WHERE NOT EXISTS (SELECT 1 FROM {EXB} WHERE a.chrom = b.chrom AND a.strand = b.strand AND a.s < b.e AND b.s < a.e)")
def exons_without_overlap(spark, sf):
    return O.overlap_anti(exon_side(spark, sf, "O"), exon_side(spark, sf, "F", "r_"), ["chrom", "strand"]).select(
        "chrom", "strand", F.col("start").alias("s"), F.col("end").alias("e"))


@query("exons_left_overlap", f"""SELECT a.chrom, a.strand, a.s, a.e, b.s AS r_start, b.e AS r_end FROM {EXA} LEFT JOIN {EXB}
ON a.chrom = b.chrom AND a.strand = b.strand AND a.s < b.e AND b.s < a.e""")
def exons_left_overlap(spark, sf):
    return O.overlap_left(exon_side(spark, sf, "O"), exon_side(spark, sf, "F", "r_"), ["chrom", "strand"]).select(
        "chrom", "strand", F.col("start").alias("s"), F.col("end").alias("e"), "r_start", "r_end")


@query("junction_self_overlap", """
SELECT a.chrom, a.strand, a.js, a.je, count(*) AS n FROM junc_v a JOIN junc_v b ON a.chrom = b.chrom AND a.strand = b.strand AND a.js < b.je AND b.js < a.je GROUP BY ALL""")
def junction_self_overlap(spark, sf):
    j = P.junction_table(spark, sf).select("chrom", "strand", "js", "je")
    other = j.select("chrom", "strand", F.col("js").alias("ojs"), F.col("je").alias("oje"))
    return O.overlap_join(j, other, ["chrom", "strand"], "js", "je", "ojs", "oje").groupBy("chrom", "strand", "js", "je").agg(F.count(F.lit(1)).alias("n"))


@query("overlap_sizes", f"""
SELECT a.chrom, a.strand, a.s, a.e, b.s AS r_start, b.e AS r_end, least(a.e, b.e) - greatest(a.s, b.s) AS bp,
  round((least(a.e, b.e) - greatest(a.s, b.s))::DOUBLE / (a.e - a.s), 6) AS left_share, round((least(a.e, b.e) - greatest(a.s, b.s))::DOUBLE / (b.e - b.s), 6) AS right_share
FROM {EXA} JOIN {EXB} ON a.chrom = b.chrom AND a.strand = b.strand AND a.s < b.e AND b.s < a.e""")
def overlap_sizes(spark, sf):
    r = O.overlap_size(exon_side(spark, sf, "O"), exon_side(spark, sf, "F", "r_"), ["chrom", "strand"])
    return r.select("chrom", "strand", F.col("start").alias("s"), F.col("end").alias("e"), "r_start", "r_end", "bp",
                    F.round("left_share", 6).alias("left_share"), F.round("right_share", 6).alias("right_share"))


@query("nearest_model_end", """
WITH a AS (SELECT DISTINCT chrom, strand, CASE WHEN strand = '+' THEN hi - 1 ELSE lo END AS s FROM iso_v WHERE status = 'O'),
b AS (SELECT DISTINCT chrom, strand, CASE WHEN strand = '+' THEN hi - 1 ELSE lo END AS t FROM iso_v WHERE status = 'F'),
d AS (SELECT a.chrom, a.strand, s, t, CASE WHEN t = s THEN 0 ELSE abs(t - s) END AS dist, min(abs(t - s)) OVER (PARTITION BY a.chrom, a.strand, s) AS best
  FROM a JOIN b ON a.chrom = b.chrom AND a.strand = b.strand)
SELECT chrom, strand, s AS start, t AS f_start, (CASE WHEN t < s THEN -1 ELSE 1 END) * (CASE WHEN strand = '-' THEN -1 ELSE 1 END) * dist AS distance FROM d WHERE dist = best""")
def nearest_model_end(spark, sf):
    def ends(status, s, e):
        r = part(spark, sf, status)
        at = F.when(F.col("strand") == "+", F.col("end") - 1).otherwise(F.col("start"))
        return r.select("chrom", "strand", at.alias(s), (at + 1).alias(e)).distinct()
    return O.nearest(ends("O", "start", "end"), ends("F", "f_start", "f_end"), ["chrom", "strand"]).select("chrom", "strand", "start", "f_start", "distance")


@query("nearest_neighbour", """
WITH p AS (SELECT chrom, strand, CASE WHEN strand = '+' THEN hi ELSE lo END AS pos, count(*) AS n FROM iso_v GROUP BY ALL),
q AS (SELECT *, pos - lag(pos) OVER w AS dl, lead(pos) OVER w - pos AS dr FROM p WINDOW w AS (PARTITION BY chrom, strand ORDER BY pos))
SELECT chrom, strand, pos, n, CASE WHEN n > 1 THEN 0 WHEN dr IS NULL OR dl <= dr THEN dl ELSE dr END AS distance FROM q WHERE n > 1 OR dl IS NOT NULL OR dr IS NOT NULL""")
def nearest_neighbour(spark, sf):
    pos = F.when(F.col("strand") == "+", F.col("end")).otherwise(F.col("start"))
    sites = P.isoforms(spark, sf).select("chrom", "strand", pos.alias("pos"))
    return O.neighbour(sites, ["chrom", "strand"], "pos").select("chrom", "strand", "pos", "n", "distance")


@query("introns_in_junction_set", """
SELECT i.iso, i.n_ex - 1 AS introns, count(j.js) AS supported FROM iso_v i LEFT JOIN intr_v v ON v.iso = i.iso
LEFT JOIN junc_v j ON j.chrom = v.chrom AND j.strand = v.strand AND j.js = v.a AND j.je = v.b GROUP BY i.iso, i.n_ex""")
def introns_in_junction_set(spark, sf):
    return A.intron_support(P.isoforms(spark, sf), P.junction_table(spark, sf)).select("iso", F.col("introns").cast("long").alias("introns"), "supported")


view("asp_v", """
SELECT r.chrom, r.strand, r.iso, r.n_ex - 1 AS n_in, t.iso AS t_name, t.gene AS t_gene, t.n_ex AS t_ex, bp / r.len AS read_cov, bp / t.len AS trans_cov, bp,
  shared, r.n_ex > 1 AND (starts_with(t.chain || ';', r.chain || ';') OR ends_with(';' || t.chain, ';' || r.chain)) AS flank,
  (t.lo < r.hi AND r.hi <= t.fe) OR (t.ls <= r.lo AND r.lo < t.hi) AS in_end
FROM (SELECT * FROM iso_v WHERE status <> 'F') r
JOIN (SELECT i.*, fe, ls FROM iso_v i JOIN (SELECT iso, min(e) AS fe, max(s) AS ls FROM ex_v GROUP BY iso) USING (iso) WHERE status = 'F') t
  ON r.chrom = t.chrom AND r.lo < t.hi AND t.lo < r.hi
JOIN LATERAL (SELECT coalesce(sum(least(x.e, y.e) - greatest(x.s, y.s)), 0) AS bp FROM ex_v x JOIN ex_v y ON x.s < y.e AND y.s < x.e WHERE x.iso = r.iso AND y.iso = t.iso) ON true
JOIN LATERAL (SELECT count(DISTINCT x.a) AS shared FROM intr_v x JOIN intr_v y ON abs(x.a - y.a) <= 10 AND abs(x.b - y.b) <= 10 WHERE x.iso = r.iso AND y.iso = t.iso) ON true""")
view("asc_v", """
SELECT *, CASE WHEN n_in > 0 THEN flank OR shared >= 1 OR read_cov >= 0.9 ELSE NOT (t_ex > 1 AND NOT in_end AND read_cov < 0.9) END AS exonic FROM asp_v""")


def long_reads(spark, sf):
    return P.isoforms(spark, sf).filter(F.col("status") != "F")


@query("read_assignment_pairs", "SELECT iso, t_name, exonic FROM asc_v QUALIFY exonic = max(exonic) OVER (PARTITION BY iso)")
def read_assignment_pairs(spark, sf):
    return A.assigned_transcripts(long_reads(spark, sf), P.t_models(spark, sf)).select("iso", "t_name", "exonic")


@query("read_assignment", """
SELECT r.iso, coalesce(class, 'IG') AS class, coalesce(n_trans, 0) AS n_trans, coalesce(n_genes, 0) AS n_genes FROM iso_v r LEFT JOIN (
  SELECT iso, CASE WHEN exonic THEN 'E' ELSE 'I' END AS class, count(*) AS n_trans, count(DISTINCT t_gene) AS n_genes
  FROM (SELECT * FROM asc_v QUALIFY exonic = max(exonic) OVER (PARTITION BY iso)) GROUP BY iso, exonic) a USING (iso) WHERE r.status <> 'F'""")
def read_assignment(spark, sf):
    return A.assign_reads(long_reads(spark, sf), P.t_models(spark, sf)).select("iso", "class", F.col("n_trans").cast("long").alias("n_trans"), F.col("n_genes").cast("long").alias("n_genes"))


@query("read_loci", """
WITH c AS (SELECT iso, exonic, count(DISTINCT t_gene) AS g, min(t_gene) AS one FROM (SELECT * FROM asc_v QUALIFY exonic = max(exonic) OVER (PARTITION BY iso)) GROUP BY ALL),
r AS (SELECT i.*, coalesce(exonic AND g = 1, false) AS sure, one FROM iso_v i LEFT JOIN c USING (iso) WHERE status <> 'F'),
m AS (SELECT *, max(hi) OVER (PARTITION BY chrom, strand ORDER BY lo, iso ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM r WHERE NOT sure)
SELECT iso, one::VARCHAR AS locus FROM r WHERE sure UNION ALL
SELECT iso, chrom || ':' || strand || ':' || sum(CASE WHEN p IS NULL OR lo >= p THEN 1 ELSE 0 END) OVER (PARTITION BY chrom, strand ORDER BY lo, iso ROWS UNBOUNDED PRECEDING) FROM m""")
def read_loci(spark, sf):
    iso = written(P.isoforms(spark, sf), "isoforms")
    return A.unambiguous(A.assign_reads(iso.filter(F.col("status") != "F"), P.t_models(spark, sf, iso))).select("iso", "locus")


@query("junction_assignment", """
WITH p AS (SELECT j.*, m.gene, max(CASE WHEN EXISTS (SELECT 1 FROM ex_v x WHERE x.iso = m.trans AND ((x.next_s IS NOT NULL AND x.e = j.js) OR (x.prev_e IS NOT NULL AND x.s = j.je)))
    OR (EXISTS (SELECT 1 FROM ex_v x WHERE x.iso = m.trans AND j.js_start < x.e AND j.js > x.s) AND EXISTS (SELECT 1 FROM ex_v x WHERE x.iso = m.trans AND j.je < x.e AND j.je_end > x.s)) THEN 1 ELSE 0 END) AS exonic
  FROM junc_v j JOIN mod_v m ON m.chrom = j.chrom AND m.strand = j.strand AND j.js_start < m.hi AND m.lo < j.je_end GROUP BY ALL)
SELECT chrom, strand, js, je, CASE WHEN exonic = 1 THEN 'E' ELSE 'I' END AS class, gene AS t_gene FROM p QUALIFY exonic = max(exonic) OVER (PARTITION BY chrom, strand, js, je)
UNION ALL SELECT chrom, strand, js, je, 'IG', NULL FROM junc_v j WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.chrom = j.chrom AND p.strand = j.strand AND p.js = j.js AND p.je = j.je)""")
def junction_assignment(spark, sf):
    return A.assign_junctions(P.junction_table(spark, sf), P.t_models(spark, sf)).select("chrom", "strand", "js", "je", "class", "t_gene")


view("site_gene_v", """
SELECT DISTINCT r.iso, m.gene AS t_gene FROM (SELECT chrom, strand, iso, 'a' AS edge, a AS at FROM intr_v WHERE status <> 'F' UNION ALL SELECT chrom, strand, iso, 'b', b FROM intr_v WHERE status <> 'F') r
JOIN (SELECT DISTINCT chrom, strand, gene, 'a' AS edge, a AS at FROM intr_v WHERE status = 'F' UNION SELECT DISTINCT chrom, strand, gene, 'b', b FROM intr_v WHERE status = 'F') m
  ON r.chrom = m.chrom AND r.strand = m.strand AND r.edge = m.edge AND r."at" = m."at"
UNION SELECT r.iso, t.gene FROM iso_v r JOIN iso_v t ON t.status = 'F' AND r.status <> 'F' AND r.n_ex = 1 AND r.chrom = t.chrom AND r.strand = t.strand AND r.lo < t.hi AND t.lo < r.hi
  AND (least(r.hi, t.hi) - greatest(r.lo, t.lo))::DOUBLE / (r.hi - r.lo) >= 0.5""".replace(" AS at", ' AS "at"'))


@query("shared_site_genes", "SELECT iso, t_gene FROM site_gene_v")
def shared_site_genes(spark, sf):
    return A.shared_site_genes(long_reads(spark, sf), P.t_models(spark, sf))


@query("reads_without_gene", "SELECT iso FROM iso_v WHERE status <> 'F' AND iso NOT IN (SELECT iso FROM site_gene_v)")
def reads_without_gene(spark, sf):
    r = long_reads(spark, sf)
    return A.without_gene(r, A.shared_site_genes(r, P.t_models(spark, sf))).select("iso")


@query("known_and_novel_isoforms", """
SELECT iso, CASE WHEN n_ex > 1 AND (chrom, chain) IN (SELECT chrom, chain FROM iso_v WHERE status = 'F' AND n_ex > 1) THEN 'annotated'
  WHEN n_ex = 1 AND EXISTS (SELECT 1 FROM iso_v t WHERE t.status = 'F' AND t.n_ex = 1 AND t.chrom = i.chrom AND i.lo < t.hi AND t.lo < i.hi
    AND (least(i.hi, t.hi) - greatest(i.lo, t.lo))::DOUBLE / (t.hi - t.lo) >= 0.5) THEN 'annotated' ELSE 'novel' END AS annotation FROM iso_v i WHERE status <> 'F'""")
def known_and_novel_isoforms(spark, sf):
    return A.known_isoforms(long_reads(spark, sf), P.t_models(spark, sf)).select("iso", "annotation")


def pa_of(spark, sf, status):
    r = part(spark, sf, status)
    return r.select("chrom", "strand", "gene", F.when(F.col("strand") == "+", F.col("end")).otherwise(F.col("start")).alias("pa")).distinct()


view("pa_v", "SELECT DISTINCT chrom, strand, gene, status, CASE WHEN strand = '+' THEN hi ELSE lo END AS pa FROM iso_v")


@query("polya_sites_against_reference", """
WITH s AS (SELECT p.chrom, p.strand, p.gene, p.pa, EXISTS (SELECT 1 FROM pa_v r WHERE r.status = 'F' AND r.gene = p.gene AND abs(r.pa - p.pa) <= 30) AS known FROM pa_v p WHERE status = 'O')
SELECT gene, pa, CASE WHEN known THEN 'Known' ELSE 'Novel' END AS annotation, bool_or(NOT known) OVER (PARTITION BY gene) AS gene_novel FROM s""")
def polya_sites_against_reference(spark, sf):
    return PA.compare_sites(pa_of(spark, sf, "O"), pa_of(spark, sf, "F")).select("gene", "pa", "annotation", "gene_novel")


@query("confident_polya_positions", """
SELECT DISTINCT p.chrom, p.pa AS pos FROM pa_v p WHERE status = 'O' AND EXISTS (SELECT 1 FROM pa_v r WHERE r.status = 'F' AND r.chrom = p.chrom AND p.pa >= r.pa - 21 AND p.pa < r.pa + 20)""")
def confident_polya_positions(spark, sf):
    p = pa_of(spark, sf, "O").select("chrom", F.col("pa").alias("pos")).distinct()
    return PA.confident(p, pa_of(spark, sf, "F").select("chrom", F.col("pa").alias("site")), 21, 19)


@query("full_allele_table", """
SELECT coalesce(a.gene, b.gene) AS gene, coalesce(a.n, 0) AS ref_n, coalesce(b.n, 0) AS alt_n FROM (SELECT gene, count(*) AS n FROM iso_v WHERE status = 'P' GROUP BY gene) a
FULL JOIN (SELECT gene, count(*) AS n FROM iso_v WHERE priority = '1-URGENT' GROUP BY gene) b ON a.gene = b.gene""")
def full_allele_table(spark, sf):
    from spliceloom.operators.significance import allele_table
    iso = P.isoforms(spark, sf)
    n = lambda d: d.groupBy("gene").agg(F.count(F.lit(1)).alias("n"))
    return allele_table(n(iso.filter("status = 'P'")), n(iso.filter("priority = '1-URGENT'")))


@query("best_allele_match", """
SELECT locus, haplo, min(allele) AS allele, round(any_value(ratio), 6) AS ratio FROM (SELECT *, max(ratio) OVER (PARTITION BY locus, haplo) AS best FROM (
  SELECT c_nationkey AS locus, haplo, allele, 1 - levenshtein(haplo, txt)::DOUBLE / greatest(length(haplo), length(txt)) AS ratio
  FROM (SELECT DISTINCT c_nationkey, c_name AS haplo FROM customer) JOIN (SELECT n_nationkey, 'alt' AS allele, 'Customer#000000' || n_name AS txt FROM nation
    UNION ALL SELECT n_nationkey, 'ref', 'Customer#' || n_nationkey FROM nation) ON n_nationkey = c_nationkey)) WHERE ratio = best GROUP BY locus, haplo""")
def best_allele_match(spark, sf):
    from spliceloom.operators.significance import best_allele
    h = P.table(spark, sf, "customer").select(F.col("c_nationkey").alias("locus"), F.col("c_name").alias("haplo")).distinct()
    n = P.table(spark, sf, "nation")
    a = n.select(F.col("n_nationkey").alias("locus"), F.lit("alt").alias("allele"), F.concat(F.lit("Customer#000000"), "n_name").alias("text")).unionByName(
        n.select(F.col("n_nationkey").alias("locus"), F.lit("ref").alias("allele"), F.concat(F.lit("Customer#"), "n_nationkey").alias("text")))
    return best_allele(h, a).withColumn("ratio", F.round("ratio", 6))


@query("isoform_chain_pairs", """
WITH c AS (SELECT m.event_id, m.gene, side, CASE WHEN n_ex > 2 THEN chain ELSE 'monoExon' END AS chain, count(*) AS n, CAST(sum(i.reads) AS BIGINT) AS r
  FROM (SELECT as_type || ' ' || event_id AS event_id, gene, side, iso FROM member_v) m JOIN iso_v i USING (iso) WHERE i.reads >= 2 GROUP BY ALL)
SELECT a.event_id, a.gene, a.chain AS inc_chain, a.n AS inc_n, a.r AS inc_r, b.chain AS exc_chain, b.n AS exc_n, b.r AS exc_r FROM c a JOIN c b USING (event_id) WHERE a.side = 'inc' AND b.side = 'exc'""")
def isoform_chain_pairs(spark, sf):
    return _event_named(_chain_pairs(spark, sf))


def _chain_pairs(spark, sf):
    from spliceloom.operators.events import EVENT, Shared, member_rows
    from spliceloom.operators.significance import chain_pairs
    base = Shared(P.isoforms(spark, sf))
    return chain_pairs(member_rows(base).select(*EVENT, "side", "iso"), base.isoforms, 2)


def _event_named(df):
    """The event id in place of the event's columns, with the type in front: ids of two types may be alike."""
    from spliceloom.operators.events import EVENT, event_text
    rest = [c for c in df.columns if c not in EVENT]
    return df.select(F.concat_ws(" ", "as_type", event_text()).alias("event_id"), "gene", *rest)


@query("one_chain_pair_per_event", """
WITH c AS (SELECT m.event_id, m.gene, side, CASE WHEN n_ex > 2 THEN chain ELSE 'monoExon' END AS chain
  FROM (SELECT as_type || ' ' || event_id AS event_id, gene, side, iso FROM member_v) m JOIN iso_v i USING (iso) WHERE i.reads >= 2)
SELECT event_id, gene, max(chain) FILTER (side = 'inc') AS inc_chain, max(chain) FILTER (side = 'exc') AS exc_chain FROM c GROUP BY ALL
HAVING count(*) FILTER (side = 'inc') > 0 AND count(*) FILTER (side = 'exc') > 0""")
def one_chain_pair_per_event(spark, sf):
    from spliceloom.operators.significance import one_pair
    return _event_named(one_pair(_chain_pairs(spark, sf))).select("event_id", "gene", "inc_chain", "exc_chain")


@query("alignment_tags_joined", "SELECT name, o_orderpriority AS tag FROM aln_v LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') ON o_orderkey = name")
def alignment_tags_joined(spark, sf):
    tags = P.table(spark, sf, "orders").filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("name"), F.col("o_orderpriority").alias("tag"))
    return P.alignments(spark, sf).join(tags, "name", "left").select("name", "tag")


@query("shared_intron_counts", """
SELECT p.trans, p.iso, (SELECT count(DISTINCT x.a) FROM intr_v x JOIN intr_v y ON abs(x.a - y.a) <= 20 AND abs(x.b - y.b) <= 20 WHERE x.iso = p.iso AND y.iso = p.trans) AS shared FROM pair_v p""")
def shared_intron_counts(spark, sf):
    from spliceloom.plans.structure_queries import gene_pairs
    return gene_pairs(spark, sf).select("trans", "iso", B.shared_introns(B.introns(F.col("new_exons")), B.introns(F.col("old_exons")), 20).cast("long").alias("shared"))


# alignments

@query("cigar_lengths", """
SELECT name, CAST(list_sum(list_transform(regexp_extract_all(cigar, '([0-9]+)[MISH=X]', 1), lambda x: x::BIGINT)) AS BIGINT) AS read_len,
  CAST(list_sum(list_transform(regexp_extract_all(cigar, '([0-9]+)[MIS=X]', 1), lambda x: x::BIGINT)) AS BIGINT) AS unclipped,
  CAST(list_sum(list_transform(regexp_extract_all(cigar, '([0-9]+)[MI=X]', 1), lambda x: x::BIGINT)) AS BIGINT) AS aligned,
  CAST(list_sum(list_transform(regexp_extract_all(cigar, '([0-9]+)[ID]', 1), lambda x: x::BIGINT)) AS BIGINT) AS indel FROM aln_v""")
def cigar_lengths(spark, sf):
    c = F.col("cigar")
    return P.alignments(spark, sf).select("name", AL.read_length(c).alias("read_len"), AL.unclipped_length(c).alias("unclipped"),
                                          AL.aligned_length(c).alias("aligned"), AL.indel_length(c).alias("indel"))


@query("clipped_block_edges", "SELECT iso AS name, lo - reads AS first_s, hi + 5 AS last_e FROM iso_v")
def clipped_block_edges(spark, sf):
    b = AL.blocks_with_clips(F.col("pos") - 1, F.col("cigar"))
    return P.alignments(spark, sf).select("name", b.alias("b")).select("name", F.col("b")[0]["s"].alias("first_s"), F.element_at("b", -1)["e"].alias("last_e"))


@query("junction_anchor_rows", 'SELECT iso AS name, s AS "left", e AS s, next_s AS e, lead(e) OVER (PARTITION BY iso ORDER BY s) AS "right" FROM ex_v QUALIFY next_s IS NOT NULL')
def junction_anchor_rows(spark, sf):
    return P.alignments(spark, sf).select("name", F.explode(AL.junction_anchors(F.col("pos") - 1, F.col("cigar"))).alias("x")).select("name", "x.*")


@query("junctions_from_alignments", """
SELECT chrom, strand, e AS a, next_s AS b, count(*) AS cnt FROM (SELECT *, lead(e) OVER (PARTITION BY iso ORDER BY s) AS ne FROM ex_v)
WHERE next_s IS NOT NULL AND e - s >= 200 AND ne - next_s >= 200 AND next_s - e BETWEEN 500 AND 2000 GROUP BY ALL""")
def junctions_from_alignments(spark, sf):
    a = P.alignments(spark, sf).withColumn("anchors", AL.junction_anchors(F.col("pos") - 1, F.col("cigar")))
    return A.extracted_junctions(a, 200, 500, 2000).select("chrom", "strand", "a", "b", "cnt")


@query("coverage_and_identity", """
SELECT name, round(al::DOUBLE / rl * 100, 6) AS coverage, round(ml::DOUBLE / al * 100, 6) AS identity, mm AS mismatches, nb AS n_bases FROM (
SELECT name, list_sum(list_transform(regexp_extract_all(cigar, '([0-9]+)[MISH=X]', 1), lambda x: x::BIGINT)) AS rl,
  list_sum(list_transform(regexp_extract_all(cigar, '([0-9]+)[MI=X]', 1), lambda x: x::BIGINT)) AS al,
  list_sum(list_transform(regexp_extract_all(md, '([0-9]+)', 1), lambda x: x::BIGINT)) AS ml,
  length(regexp_replace(regexp_replace(md, '\\^[ACGTN]+', '', 'g'), '[0-9]', '', 'g')) AS mm,
  length(regexp_replace(md, '[^N]', '', 'g')) AS nb FROM aln_v)""")
def coverage_and_identity(spark, sf):
    c, m = F.col("cigar"), F.col("md")
    return P.alignments(spark, sf).select("name", AL.coverage_percent(c).alias("coverage"), AL.identity_percent(c, m).alias("identity"),
                                          AL.mismatch_length(m).cast("long").alias("mismatches"), AL.n_base_count(m).cast("long").alias("n_bases"))


@query("flag_letters", """
SELECT event_id, CASE WHEN f & 1 = 1 THEN 'p' ELSE '' END || CASE WHEN f & 3 = 3 THEN 'P' ELSE '' END || CASE WHEN f & 4 = 4 THEN 'u' ELSE '' END || CASE WHEN f & 8 = 8 THEN 'U' ELSE '' END
  || CASE WHEN f & 16 = 16 THEN 'r' ELSE '' END || CASE WHEN f & 32 = 32 THEN 'R' ELSE '' END || CASE WHEN f & 64 = 64 THEN '1' ELSE '' END || CASE WHEN f & 128 = 128 THEN '2' ELSE '' END
  || CASE WHEN f & 256 = 256 THEN 's' ELSE '' END || CASE WHEN f & 512 = 512 THEN 'f' ELSE '' END || CASE WHEN f & 1024 = 1024 THEN 'd' ELSE '' END AS letters,
  xor(f, 16) AS flipped FROM (SELECT event_id, event_id % 2048 AS f FROM events)""")
def flag_letters(spark, sf):
    e = P.table(spark, sf, "events").select("event_id", (F.col("event_id") % 2048).alias("f"))
    return e.select("event_id", AL.flag_letters(F.col("f")).alias("letters"), AL.reverse_strand(F.col("f")).alias("flipped"))


RF, FF = "(f & 16 = 16)", "(f & 4 = 0 AND f & 16 = 0)"
ONE = f"((f & 64 = 64 AND {RF} AND f & 32 = 0) OR (f & 128 = 128 AND {FF} AND (f & 32 = 32 OR f & 8 = 8)))"
TWO = f"((f & 64 = 64 AND {FF} AND (f & 32 = 32 OR f & 8 = 8)) OR (f & 128 = 128 AND {RF} AND f & 32 = 0))"


@query("coding_strands", f"""
SELECT event_id, CASE WHEN f & 192 = 0 THEN CASE WHEN {RF} THEN '+' WHEN {FF} THEN '-' ELSE '' END WHEN {ONE} THEN '+' WHEN {TWO} THEN '-' ELSE '' END AS first_strand,
  CASE WHEN f & 192 = 0 THEN CASE WHEN {FF} THEN '+' WHEN {RF} THEN '-' ELSE '' END WHEN {ONE} THEN '-' WHEN {TWO} THEN '+' ELSE '' END AS second_strand,
  CASE WHEN f & 125 = 81 OR f & 253 = 161 THEN '+' WHEN f & 125 = 97 OR f & 253 = 145 THEN '-' ELSE '' END AS pair FROM (SELECT event_id, event_id % 2048 AS f FROM events)""")
def coding_strands(spark, sf):
    e = P.table(spark, sf, "events").select("event_id", (F.col("event_id") % 2048).alias("f"))
    f = F.col("f")
    return e.select("event_id", AL.coding_strand("fr-firststrand", f).alias("first_strand"), AL.coding_strand("fr-secondstrand", f).alias("second_strand"),
                    AL.pair_orientation(f).alias("pair"))


@query("alternative_hit_tags", """
SELECT l_orderkey, l_linenumber, l_suppkey AS x0, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_partkey END AS x1, least(l_suppkey, l_partkey, 50) AS min_nm FROM lineitem""")
def alternative_hit_tags(spark, sf):
    li = P.table(spark, sf, "lineitem")
    line = F.concat(F.lit("r\t0\tX0:i:"), "l_suppkey", F.when(F.col("l_returnflag") == "R", "").otherwise(F.concat(F.lit("\tX1:i:"), "l_partkey")),
                    F.lit("\tXA:Z:chr1,+5,10M,"), "l_suppkey", F.lit(";chr2,-9,10M,"), "l_partkey", F.lit(";chr3,+1,10M,50;"))
    r = li.select("l_orderkey", "l_linenumber", line.alias("line"))
    return r.select("l_orderkey", "l_linenumber", AL.best_hits(F.col("line")).alias("x0"), AL.sub_hits(F.col("line")).alias("x1"), AL.min_alternative_nm(F.col("line")).alias("min_nm"))


@query("region_depth_steps", """
WITH g AS (SELECT gene, chrom, min(lo) AS lo, max(hi) AS hi FROM iso_v WHERE status = 'F' GROUP BY ALL),
d AS (SELECT g.gene, greatest(x.s, g.lo) AS s, least(x.e, g.hi) AS e FROM ex_v x JOIN g ON g.chrom = x.chrom AND x.s < g.hi AND g.lo < x.e),
p AS (SELECT gene, pos, sum(v) AS v FROM (SELECT gene, s AS pos, 1 AS v FROM d UNION ALL SELECT gene, e, -1 FROM d) GROUP BY ALL HAVING sum(v) <> 0)
SELECT gene, pos, CAST(sum(v) OVER (PARTITION BY gene ORDER BY pos) AS BIGINT) AS depth FROM p""")
def region_depth_steps(spark, sf):
    g = part(spark, sf, "F").groupBy("gene", "chrom").agg(F.min("start").alias("g_start"), F.max("end").alias("g_end"))
    return A.region_depth(P.isoforms(spark, sf), g)


@query("gene_regions", "SELECT gene, chrom, min(lo) AS g_start, max(hi) AS g_end FROM iso_v WHERE status IN ('F', 'O') GROUP BY ALL")
def gene_regions(spark, sf):
    from spliceloom.operators.report import gene_regions as regions
    return regions(part(spark, sf, "F"), part(spark, sf, "O"))


@query("junction_consensus_moves", """
WITH s AS (SELECT chrom, strand, a, b, count(*) FILTER (status <> 'F') AS l, count(*) FILTER (status = 'F') AS r FROM intr_v WHERE status <> 'O' GROUP BY ALL),
t AS (SELECT coalesce(s.chrom, j.chrom) AS chrom, coalesce(s.strand, j.strand) AS strand, coalesce(a, js) AS a, coalesce(b, je) AS b, nullif(l, 0) AS l, nullif(r, 0) AS r, cnt AS j
  FROM s FULL JOIN (SELECT * FROM junc_v WHERE cnt > 3) j ON s.chrom = j.chrom AND s.strand = j.strand AND a = js AND b = je),
c1 AS (SELECT *, sum(CASE WHEN g <= 30 THEN 0 ELSE 1 END) OVER (PARTITION BY chrom, strand ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS i FROM (SELECT *, a - lag(a) OVER (PARTITION BY chrom, strand ORDER BY a, b) AS g FROM t)),
c2 AS (SELECT * EXCLUDE (g), sum(CASE WHEN g <= 30 THEN 0 ELSE 1 END) OVER (PARTITION BY chrom, strand, i ORDER BY b, a ROWS UNBOUNDED PRECEDING) AS k FROM (SELECT * EXCLUDE (g), b - lag(b) OVER (PARTITION BY chrom, strand, i ORDER BY b, a) AS g FROM c1)),
m AS (SELECT *, max(j) OVER w AS mj, max(l) OVER w AS ml FROM c2 WINDOW w AS (PARTITION BY chrom, strand, i, k)),
x AS (SELECT chrom, strand, i, k, count(*) FILTER (j = mj) AS nj, min({'a': a, 'b': b}) FILTER (j = mj) AS bj, count(*) FILTER (l = ml) AS nl, min({'a': a, 'b': b}) FILTER (l = ml) AS bl,
  count(r) AS nr, min({'a': a, 'b': b}) FILTER (r IS NOT NULL) AS br FROM m GROUP BY ALL),
y AS (SELECT m.*, CASE WHEN nj = 1 THEN bj WHEN nl = 1 THEN bl WHEN nl > 1 AND nr = 1 THEN br END AS w FROM m JOIN x USING (chrom, strand, i, k))
SELECT chrom, strand, a, b, w.a AS to_a, w.b AS to_b FROM y WHERE w IS NOT NULL AND j IS NULL AND r IS NULL AND (a <> w.a OR b <> w.b)""")
def junction_consensus_moves(spark, sf):
    return A.consensus_junctions(support(spark, sf), 30)


def support(spark, sf, iso=None):
    iso = written(P.isoforms(spark, sf), "isoforms") if iso is None else iso
    return A.junction_support(iso.filter("status = 'P'"), P.junction_table(spark, sf, iso).filter("cnt > 3"), P.t_models(spark, sf, iso))


@query("junction_support_scores", """
SELECT coalesce(s.chrom, j.chrom) AS chrom, coalesce(s.strand, j.strand) AS strand, coalesce(a, js) AS a, coalesce(b, je) AS b, nullif(l, 0) AS l_score, cnt AS j_score, nullif(r, 0) AS r_score FROM
(SELECT chrom, strand, a, b, count(*) FILTER (status = 'P') AS l, count(*) FILTER (status = 'F') AS r FROM intr_v WHERE status <> 'O' GROUP BY ALL) s
FULL JOIN (SELECT * FROM junc_v WHERE cnt > 3) j ON s.chrom = j.chrom AND s.strand = j.strand AND a = js AND b = je""")
def junction_support_scores(spark, sf):
    return support(spark, sf)


@query("reads_with_moved_junctions")
def reads_with_moved_junctions(spark, sf):
    iso = written(P.isoforms(spark, sf), "isoforms")
    return A.move_junctions(iso, A.consensus_junctions(support(spark, sf, iso), 30)).select("iso", B.chain(F.col("exons")).alias("exon_chain"))


@query("corrected_isoforms")
def corrected_isoforms(spark, sf):
    j = P.junction_table(spark, sf)
    motif = F.when(F.col("cnt") > 1, "GT-AG").otherwise("AA-TT")
    out = A.correct_junctions(P.isoforms(spark, sf).filter("status = 'P'"), j, j.withColumn("motif", motif))
    return out.select("iso", "outcome", F.col("edits").cast("long").alias("edits"), B.chain(F.col("new_exons")).alias("exon_chain"))


view("dn_v", """
SELECT chrom, strand, CASE WHEN strand = '+' THEN js ELSE -je END AS dn, CASE WHEN strand = '+' THEN je ELSE -js END AS ac, cnt FROM junc_v""")
# exons on an axis that runs along the transcript
view("way_v", """
SELECT CASE WHEN status = 'F' THEN 'annotation' ELSE 'reads' END AS source, CASE WHEN status = 'F' THEN gene ELSE iso END::VARCHAR AS name, iso, chrom, strand,
  CASE WHEN strand = '+' THEN s ELSE -e END AS s, CASE WHEN strand = '+' THEN e ELSE -s END AS e FROM ex_v WHERE status IN ('F', 'P')""")
view("srs_v", """
SELECT p.chrom, p.strand, p.dn, p.ac, p.cnt, p.source, p.name, string_agg(x.s || '_' || x.e, ';' ORDER BY x.s) AS body
FROM (SELECT DISTINCT d.iso, d.source, d.name, d.chrom, d.strand, o.dn, o.ac, o.cnt, i.ac AS ac_in FROM way_v d
  JOIN dn_v o ON o.chrom = d.chrom AND o.strand = d.strand AND o.dn = d.e JOIN dn_v i ON i.chrom = d.chrom AND i.strand = d.strand AND i.dn = d.e AND i.ac < o.ac
  JOIN way_v xo ON xo.iso = d.iso AND xo.s = o.ac JOIN way_v xi ON xi.iso = d.iso AND xi.s = i.ac
  WHERE (d.chrom, d.strand, (SELECT max(y.e) FROM way_v y WHERE y.iso = d.iso AND y.e < o.ac)) IN (SELECT chrom, strand, dn FROM dn_v)) p
JOIN way_v x ON x.iso = p.iso AND x.s >= p.ac_in AND x.e <= p.ac GROUP BY p.iso, p.ac_in, p.chrom, p.strand, p.dn, p.ac, p.cnt, p.source, p.name""")
view("sre_v", """
SELECT chrom, strand, dn, ac, body, min({'source': source, 'name': name}) AS b, any_value(cnt) AS skip_count FROM srs_v GROUP BY chrom, strand, dn, ac, body""")


view("skip_v", """
SELECT v.chrom, v.strand, least(abs(v.dn), abs(ac)) AS "left", greatest(abs(v.dn), abs(ac)) AS "right", array_to_string(list_transform(list_sort(list_transform(string_split(body, ';'), lambda p:
    CASE WHEN v.strand = '+' THEN [split_part(p, '_', 1)::BIGINT, split_part(p, '_', 2)::BIGINT] ELSE [-split_part(p, '_', 2)::BIGINT, -split_part(p, '_', 1)::BIGINT] END)),
    lambda q: q[1] || '-' || q[2]), ';') AS chain,
  b.source AS source, CASE WHEN b.source = 'annotation' THEN b.name ELSE 'Novel' END AS gene, skip_count, total, CAST(floor(skip_count::DOUBLE / total * 1000) AS BIGINT) AS psi
FROM sre_v v JOIN (SELECT chrom, strand, dn, CAST(sum(cnt) AS BIGINT) AS total FROM dn_v GROUP BY ALL) t USING (chrom, strand, dn)""")


@query("short_read_skips", "SELECT * FROM skip_v")
def short_read_skips(spark, sf, iso=None, junctions=None):
    from spliceloom.operators.events import short_read_skips as skips
    iso = written(P.isoforms(spark, sf), "isoforms") if iso is None else iso
    m = P.models(spark, sf, iso).select("chrom", "strand", F.col("gene").alias("name"), "exons")
    r = iso.filter("status = 'P'").select("chrom", "strand", F.col("iso").alias("name"), "exons")
    j = written(P.junction_table(spark, sf, iso), "junctions") if junctions is None else junctions
    return skips(j.withColumn("donor", F.when(F.col("strand") == "+", F.col("js")).otherwise(F.col("je"))).withColumn(
        "acceptor", F.when(F.col("strand") == "+", F.col("je")).otherwise(F.col("js"))), m, r)
