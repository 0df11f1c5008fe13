"""Aggregates, clusters, poly(A) sites and sample sheets."""

from __future__ import annotations

from pyspark.sql import functions as F

from spliceloom.functions import blocks as B
from spliceloom.operators import assign as A
from spliceloom.operators import polya as PA
from spliceloom.operators import report as R
from spliceloom.operators import samples as SA
from spliceloom.operators import sweeps as W
from spliceloom.operators import transcripts as TR
from spliceloom.plans import proxy as P
from spliceloom.plans.join_queries import part
from spliceloom.plans.event_queries import event_views
from spliceloom.plans.registry import query, view


@query("gene_bounds", "SELECT gene, chrom, strand, min(lo) AS gene_start, max(hi) AS gene_end, count(*) AS n_iso FROM iso_v GROUP BY ALL")
def gene_bounds(spark, sf):
    return TR.gene_bounds(P.isoforms(spark, sf))


@query("gene_thick_bounds", "SELECT gene, min(cs) AS thick_start, max(ce) AS thick_end FROM mod_v GROUP BY gene")
def gene_thick_bounds(spark, sf):
    return P.models(spark, sf).groupBy("gene").agg(F.min("cds_start").alias("thick_start"), F.max("cds_end").alias("thick_end"))


@query("distinct_intron_chains", "SELECT chrom, chain, min(iso) AS first_iso, count(*) AS n_iso FROM iso_v WHERE n_ex > 1 GROUP BY ALL")
def distinct_intron_chains(spark, sf):
    return TR.chain_groups(P.isoforms(spark, sf))


@query("distinct_junctions", "SELECT chrom, strand, a, b, min(iso) AS first_iso, count(*) AS n_iso FROM intr_v GROUP BY ALL")
def distinct_junctions(spark, sf):
    return TR.distinct_junctions(P.isoforms(spark, sf))


@query("distinct_junctions_any_strand", "SELECT chrom, a, b, min(iso) AS first_iso, count(*) AS n_iso FROM intr_v GROUP BY ALL")
def distinct_junctions_any_strand(spark, sf):
    return TR.distinct_junctions(P.isoforms(spark, sf), False)


@query("distinct_exons_any_strand", "SELECT DISTINCT chrom, s, e FROM ex_v")
def distinct_exons_any_strand(spark, sf):
    return TR.distinct_exons(P.isoforms(spark, sf), False)


@query("junction_isoforms", "SELECT DISTINCT chrom, strand, a, b, iso FROM intr_v")
def junction_isoforms(spark, sf):
    return TR.junction_isoforms(P.isoforms(spark, sf))


@query("distinct_feature_bases", """
SELECT 'exon' AS kind, CAST(sum(e - s) AS BIGINT) AS bases FROM (SELECT DISTINCT gene, s, e FROM ex_v) UNION ALL
SELECT 'intron', CAST(sum(b - a) AS BIGINT) FROM (SELECT DISTINCT gene, a, b FROM intr_v)""")
def distinct_feature_bases(spark, sf):
    return TR.gene_lengths(P.isoforms(spark, sf))


@query("collapsed_chains", """
SELECT c.chrom, c.chain, b.iso, b.gene, c.n AS n_members, c.sup AS iso_support, g.sup AS gene_support, round(c.sup::DOUBLE / g.sup, 6) AS ratio,
  CASE WHEN (c.chrom, c.chain) IN (SELECT chrom, chain FROM iso_v WHERE status = 'F' AND n_ex > 1) THEN 'annotated' ELSE 'novel' END AS annotation
FROM (SELECT chrom, chain, count(*) AS n, CAST(sum(reads) AS BIGINT) AS sup FROM iso_v WHERE n_ex > 1 GROUP BY ALL) c
JOIN (SELECT chrom, chain, iso, gene FROM iso_v WHERE n_ex > 1 QUALIFY row_number() OVER (PARTITION BY chrom, chain ORDER BY len DESC, iso) = 1) b USING (chrom, chain)
JOIN (SELECT gene, CAST(sum(reads) AS BIGINT) AS sup FROM iso_v GROUP BY gene) g ON g.gene = b.gene""")
def collapsed_chains(spark, sf):
    iso = P.isoforms(spark, sf)
    known = iso.filter("status = 'F' AND size(exons) > 1").select("chrom", B.chain(B.introns(F.col("exons"))).alias("chain"))
    return TR.collapse_chains(iso, known).select("chrom", "chain", "iso", "gene", "n_members", "iso_support", "gene_support", F.round("ratio", 6).alias("ratio"), "annotation")


@query("isoforms_merged_over_samples", """
WITH p AS (SELECT chrom, chain, priority, min(iso) AS f, count(*) AS n FROM iso_v WHERE n_ex > 1 GROUP BY ALL)
SELECT p.chrom, p.chain, string_agg(priority || '_' || f, '+' ORDER BY priority || '_' || f) AS name, CAST(sum(n) AS BIGINT) AS n_members, any_value(lo) AS start, any_value(hi) AS "end"
FROM p JOIN (SELECT chrom, chain, lo, hi FROM iso_v WHERE n_ex > 1 QUALIFY row_number() OVER (PARTITION BY chrom, chain ORDER BY hi - lo DESC, lo) = 1) w USING (chrom, chain) GROUP BY p.chrom, p.chain""")
def isoforms_merged_over_samples(spark, sf):
    return TR.merge_samples(P.isoforms(spark, sf).withColumn("sample", F.col("priority"))).select("chrom", "chain", "name", "n_members", "start", "end")


CL = """SELECT *, sum(CASE WHEN g <= {gap} THEN 0 ELSE 1 END) OVER (PARTITION BY {keys} ORDER BY {o} ROWS UNBOUNDED PRECEDING) AS {out} FROM
  (SELECT *, {p} - lag({p}) OVER (PARTITION BY {keys} ORDER BY {o}) AS g FROM {src})"""


@query("collapsed_alignments", f"""
WITH r AS (SELECT i.*, chain_len FROM iso_v i JOIN (SELECT iso, list_sum(list_transform(regexp_extract_all(cigar, '([0-9]+)[MI=X]', 1), lambda x: x::BIGINT)) AS chain_len,
    list_sum(list_transform(regexp_extract_all(cigar, '([0-9]+)[MISH=X]', 1), lambda x: x::BIGINT)) AS read_len FROM (SELECT name AS iso, cigar FROM aln_v)) USING (iso)
  WHERE round(chain_len::DOUBLE / read_len * 100, 6) >= 98),
u AS (SELECT chrom, strand, a, b, count(*) AS n FROM intr_v WHERE iso IN (SELECT iso FROM r) GROUP BY ALL),
c1 AS ({CL.format(gap=25, keys='chrom, strand', o='a, b', p='a', src='u', out='i')}),
c2 AS ({CL.format(gap=25, keys='chrom, strand, i', o='b, a', p='b', src='(SELECT * EXCLUDE (g) FROM c1)', out='k')}),
t AS (SELECT *, first(a) OVER w AS ta, first(b) OVER w AS tb FROM c2 WINDOW w AS (PARTITION BY chrom, strand, i, k ORDER BY n DESC, a, b)),
ch AS (SELECT v.iso, string_agg(ta || '-' || tb, ';' ORDER BY ta, tb) AS sc FROM intr_v v JOIN t USING (chrom, strand, a, b) WHERE v.iso IN (SELECT iso FROM r) GROUP BY v.iso),
e AS (SELECT r.chrom, r.strand, coalesce(sc, '') AS chain, lo, hi, CASE WHEN strand = '+' THEN hi ELSE lo END AS t3, CASE WHEN strand = '+' THEN lo ELSE hi END AS t5 FROM r LEFT JOIN ch USING (iso)),
e1 AS ({CL.format(gap=100, keys='chrom, strand, chain', o='t3', p='t3', src='e', out='i')}),
e2 AS ({CL.format(gap=50, keys='chrom, strand, chain, i', o='t5', p='t5', src='(SELECT * EXCLUDE (g) FROM e1)', out='k')})
SELECT chrom, strand, chain, count(*) AS reads, min(lo) AS start, max(hi) AS "end" FROM e2 GROUP BY chrom, strand, chain, i, k HAVING count(*) >= 2""")
def collapsed_alignments(spark, sf):
    from spliceloom.functions.alignment import coverage_percent
    a = P.alignments(spark, sf).select(F.col("name").alias("iso"), "chrom", "strand", "exons", coverage_percent(F.col("cigar")).alias("coverage"), F.lit(100.0).alias("identity"))
    return TR.collapse_alignments(a, fuzzy=25, five_gap=50, three_gap=100, min_coverage=0.98).select("chrom", "strand", "chain", "reads", "start", "end")


@query("polya_site_table", """
SELECT chrom, strand, gene, pa, CASE WHEN strand = '+' THEN max(edge) ELSE min(edge) END AS edge, count(*) AS n, round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY gene), 6) AS share
FROM (SELECT i.chrom, i.strand, i.gene, CASE WHEN i.strand = '+' THEN i.hi ELSE i.lo END AS pa, CASE WHEN i.strand = '+' THEN ls ELSE fe END AS edge
  FROM iso_v i JOIN (SELECT iso, max(s) AS ls, min(e) AS fe FROM ex_v GROUP BY iso) USING (iso)) GROUP BY chrom, strand, gene, pa""")
def polya_site_table(spark, sf):
    return PA.pa_sites(P.isoforms(spark, sf)).withColumn("share", F.round("share", 6))


@query("polya_site_lists", """
SELECT chrom, strand, gene, string_agg(pa::VARCHAR, ',' ORDER BY pa) AS pas, string_agg(edge::VARCHAR, ',' ORDER BY pa) AS edges, string_agg(n::VARCHAR, ',' ORDER BY pa) AS counts FROM (
  SELECT chrom, strand, gene, pa, CASE WHEN strand = '+' THEN max(edge) ELSE min(edge) END AS edge, count(*) AS n
  FROM (SELECT i.chrom, i.strand, i.gene, CASE WHEN i.strand = '+' THEN i.hi ELSE i.lo END AS pa, CASE WHEN i.strand = '+' THEN ls ELSE fe END AS edge
    FROM iso_v i JOIN (SELECT iso, max(s) AS ls, min(e) AS fe FROM ex_v GROUP BY iso) USING (iso)) GROUP BY chrom, strand, gene, pa) GROUP BY ALL""")
def polya_site_lists(spark, sf):
    return PA.pa_groups(PA.pa_sites(P.isoforms(spark, sf))).select("chrom", "strand", "gene", "pas", "edges", "counts")


@query("polya_report_rows", "SELECT gene, pa, count(*) OVER (PARTITION BY gene) AS n_sites, CASE WHEN count(*) OVER (PARTITION BY gene) > 1 THEN 'APA' ELSE 'single' END AS label FROM (SELECT DISTINCT gene, pa FROM pa_v)")
def polya_report_rows(spark, sf):
    lists = PA.pa_groups(PA.pa_sites(P.isoforms(spark, sf)))
    return PA.label_sites(lists).select("gene", "pa", F.col("n_sites").cast("long").alias("n_sites"), "label")


@query("genes_with_several_polya_sites", "SELECT chrom || ':' || strand || ':' || gene || ':' || string_agg(pa::VARCHAR, ',' ORDER BY pa) AS event FROM (SELECT DISTINCT chrom, strand, gene, pa FROM pa_v) GROUP BY chrom, strand, gene HAVING count(*) > 1")
def genes_with_several_polya_sites(spark, sf):
    return R.apa_list(PA.pa_groups(PA.pa_sites(P.isoforms(spark, sf))))


@query("polya_gap_clusters", f"""
WITH p AS (SELECT gene, chrom, strand, CASE WHEN strand = '+' THEN hi ELSE lo END AS pos, count(*) AS n FROM iso_v GROUP BY ALL),
c AS ({CL.format(gap=24, keys='gene', o='pos', p='pos', src='p', out='i')})
SELECT gene, min(pos) AS start, max(pos) AS "end", CAST(sum(n) AS BIGINT) AS n, arg_max(pos, n * 1000000000 - pos) AS peak FROM c GROUP BY gene, i""")
def polya_gap_clusters(spark, sf):
    return PA.gap_clusters(PA.end_sites(P.isoforms(spark, sf)), 24).select("gene", "start", "end", "n", "peak")


@query("polya_peak_clusters")
def polya_peak_clusters(spark, sf):
    return PA.peak_clusters(PA.end_sites(P.isoforms(spark, sf)), distance=24, window=3, support=2)


@query("reads_of_peak_clusters")
def reads_of_peak_clusters(spark, sf):
    iso = P.isoforms(spark, sf)
    return PA.cluster_reads(iso, PA.peak_clusters(PA.end_sites(iso), 24, 3, 2)).select("gene", "iso", "peak")


@query("intron_support_summary", """
WITH s AS (SELECT i.iso, i.n_ex - 1 AS introns, count(j.js) AS supported FROM iso_v i LEFT JOIN intr_v v ON v.iso = i.iso
  LEFT JOIN junc_v j ON j.chrom = v.chrom AND j.strand = v.strand AND j.js = v.a AND j.je = v.b GROUP BY i.iso, i.n_ex)
SELECT introns, supported, count(*) AS n, CAST(sum(count(*)) OVER (PARTITION BY introns) AS BIGINT) AS n_introns, round(count(*)::DOUBLE / sum(count(*)) OVER (), 6) AS share FROM s GROUP BY introns, supported""")
def intron_support_summary(spark, sf):
    s = A.support_summary(A.intron_support(P.isoforms(spark, sf), P.junction_table(spark, sf)))
    return s.select(F.col("introns").cast("long").alias("introns"), "supported", "n", "n_introns", F.round("share", 6).alias("share"))


@query("majority_label", """
SELECT gene, min(priority) AS priority, any_value(n) AS n FROM (SELECT gene, priority, count(*) AS n, max(count(*)) OVER (PARTITION BY gene) AS m FROM iso_v GROUP BY gene, priority) WHERE n = m GROUP BY gene""")
def majority_label(spark, sf):
    return TR.majority(P.isoforms(spark, sf), ["gene"], "priority")


@query("widest_isoform", "SELECT gene, iso AS rep_iso, hi - lo AS span FROM iso_v QUALIFY row_number() OVER (PARTITION BY gene ORDER BY hi - lo DESC, iso) = 1")
def widest_isoform(spark, sf):
    return TR.longest_per(P.isoforms(spark, sf), ["gene"])


view("sheet_v", """
SELECT o_custkey // 10 AS strain, o_custkey AS sample, string_agg(o_orderkey::VARCHAR, ';' ORDER BY o_orderkey) AS files FROM orders GROUP BY ALL""")


def sheet(spark, sf):
    """Ten customers are a strain, a customer is a sample, its orders are the replicate files."""
    files = F.array_join(F.transform(F.array_sort(F.collect_list("o_orderkey")), lambda x: x.cast("string")), ";")
    return P.table(spark, sf, "orders").groupBy(F.floor(F.col("o_custkey") / 10).cast("long").alias("strain"), F.col("o_custkey").alias("sample")).agg(files.alias("files"))


@query("strain_merge", """
WITH l AS (SELECT strain, sample, u.i, u.f FROM sheet_v, LATERAL (SELECT unnest(string_split(files, ';')) AS f, unnest(range(0, len(string_split(files, ';')))) AS i) u),
k AS (SELECT strain, min(len(string_split(files, ';'))) AS k FROM sheet_v GROUP BY strain),
j AS (SELECT strain, i, string_agg(f, ',' ORDER BY sample) AS f FROM l JOIN k USING (strain) WHERE i < k GROUP BY ALL)
SELECT strain, string_agg(f, ';' ORDER BY i) AS files FROM j GROUP BY strain""")
def strain_merge(spark, sf):
    return SA.merge_strains(sheet(spark, sf), ["strain"])


@query("condition_files", """
SELECT strain AS condition, sample || '_repeat' || u.i AS name, u.f AS file, 'paired' AS paired, 151 AS read_length FROM sheet_v,
  LATERAL (SELECT unnest(string_split(files, ';')) AS f, unnest(range(0, len(string_split(files, ';')))) AS i) u""")
def condition_files(spark, sf):
    s = sheet(spark, sf).withColumnRenamed("strain", "condition").withColumn("paired", F.lit("paired")).withColumn("read_length", F.lit(151))
    return SA.condition_files(s)


@query("samples_of_conditions", "SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def samples_of_conditions(spark, sf):
    c = P.table(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("condition"))
    return SA.of_conditions(c, ["BUILDING", "MACHINERY"]).select("c_custkey")


@query("comparable_conditions", """
WITH s AS (SELECT c_nationkey AS condition, c_nationkey % 2 AS paired, 50 * (c_nationkey % 3) AS read_length FROM customer),
o AS (SELECT condition, min(paired) AS p, min(read_length) AS l FROM s GROUP BY condition HAVING min(paired) = max(paired) AND min(read_length) = max(read_length))
SELECT a.condition AS cond1, b.condition AS cond2, a.p AS paired, a.l AS read_length FROM o a JOIN o b ON a.p = b.p AND a.l = b.l AND a.condition < b.condition""")
def comparable_conditions(spark, sf):
    from spliceloom.operators.significance import comparable
    s = P.table(spark, sf, "customer").select(F.col("c_nationkey").alias("condition"), (F.col("c_nationkey") % 2).alias("paired"), (50 * (F.col("c_nationkey") % 3)).alias("read_length"))
    return comparable(s)


# clusters along a chromosome

NOV = """SELECT *, sum(CASE WHEN p IS NULL OR lo >= p THEN 1 ELSE 0 END) OVER (PARTITION BY chrom, strand ORDER BY lo, iso ROWS UNBOUNDED PRECEDING) AS c
FROM (SELECT *, max(hi) OVER (PARTITION BY chrom, strand ORDER BY lo, iso ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM iso_v WHERE status = 'P')"""


@query("novel_locus_names", f"SELECT iso, chrom || ':' || strand || ':Novel_' || c AS locus FROM ({NOV})")
def novel_locus_names(spark, sf):
    return W.novel_loci(part(spark, sf, "P")).select("iso", "locus")


@query("novel_locus_spans", f"""SELECT chrom, strand, min(lo) AS start, max(hi) AS "end" FROM ({NOV}) GROUP BY chrom, strand, c""")
def novel_locus_spans(spark, sf):
    return W.merged(part(spark, sf, "P"), ["chrom", "strand"], join_touching=False)


@query("merged_exon_islands", """
WITH d AS (SELECT DISTINCT chrom, s, e FROM ex_v), p AS (SELECT *, max(e) OVER (PARTITION BY chrom ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM d),
i AS (SELECT *, sum(CASE WHEN p IS NULL OR s > p + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS i FROM p)
SELECT chrom, min(s) AS s, max(e) AS e FROM i GROUP BY chrom, i""")
def merged_exon_islands(spark, sf):
    return W.merged(TR.exon_rows(P.isoforms(spark, sf)), ["chrom"], "s", "e", gap=50, width=4096)


@query("two_way_junction_clusters", f"""
WITH d AS (SELECT DISTINCT chrom, strand, a, b FROM intr_v), c1 AS ({CL.format(gap=15, keys='chrom, strand', o='a, b', p='a', src='d', out='i')}),
c2 AS ({CL.format(gap=15, keys='chrom, strand, i', o='b, a', p='b', src='(SELECT * EXCLUDE (g) FROM c1)', out='k')})
SELECT chrom, strand, a, b, min(a) OVER (PARTITION BY chrom, strand, i) AS start_cluster, min(b) OVER (PARTITION BY chrom, strand, i, k) AS end_cluster FROM c2""")
def two_way_junction_clusters(spark, sf):
    j = TR.intron_rows(P.isoforms(spark, sf)).select("chrom", "strand", "a", "b").distinct()
    return W.two_way_clusters(j, ["chrom", "strand"], "a", "b", 15)


event_views("loc_", f"SELECT e.* REPLACE (c.locus AS gene) FROM exr_v e JOIN (SELECT iso, chrom || ':' || strand || ':Novel_' || c AS locus FROM ({NOV})) c ON c.iso = e.iso")


@query("novel_event_loci", "SELECT as_type, gene AS locus, event_id, lo, hi, n_inc FROM loc_event_v")
def novel_event_loci(spark, sf):
    """Events of all types among isoforms without a gene, inside their novel loci."""
    from spliceloom.operators.events import all_events
    iso = W.novel_loci(part(spark, sf, "P")).drop("gene").withColumnRenamed("locus", "gene")
    return all_events(iso).select("as_type", F.col("gene").alias("locus"), "event_id", "lo", "hi", "n_inc")


@query("ranked_isoforms", "SELECT iso, reads AS freq FROM iso_v WHERE status <> 'F'")
def ranked_isoforms(spark, sf):
    s = P.isoforms(spark, sf).select("iso", F.col("reads").alias("freq"), F.when(F.col("status") == "F", "annotated").otherwise("novel").alias("annotation"))
    return R.score_list(s, "novel").select("iso", "freq")


@query("isoforms_by_position", "SELECT chrom, lo AS start, iso FROM iso_v")
def isoforms_by_position(spark, sf):
    return P.isoforms(spark, sf).select("chrom", "start", "iso").orderBy("chrom", "start", "iso")


@query("length_histogram", "SELECT bin, n, round(n::DOUBLE / (sum(n) OVER () * 100), 9) AS density FROM (SELECT CAST(len // 100 AS BIGINT) AS bin, count(*) AS n FROM iso_v GROUP BY 1)")
def length_histogram(spark, sf):
    return R.histogram(P.isoforms(spark, sf).select(B.length(F.col("exons")).alias("len")), [], "len", 100).withColumn("density", F.round("density", 9))


@query("box_plot_summary", """
WITH q AS (SELECT priority, quantile_cont(len, 0.25) AS q1, quantile_cont(len, 0.5) AS median, quantile_cont(len, 0.75) AS q3 FROM iso_v GROUP BY priority)
SELECT q.priority, q1, median, q3, CAST(min(len) FILTER (len >= q1 - (q3 - q1) * 1.5) AS BIGINT) AS low, CAST(max(len) FILTER (len <= q3 + (q3 - q1) * 1.5) AS BIGINT) AS high, count(*) AS n
FROM iso_v JOIN q USING (priority) GROUP BY q.priority, q1, median, q3""")
def box_plot_summary(spark, sf):
    return R.box_summary(P.isoforms(spark, sf).select("priority", B.length(F.col("exons")).alias("len")), ["priority"], "len")


@query("result_index", """
SELECT gene, bool_or(a) AS has_p, bool_or(b) AS has_urgent FROM (SELECT gene, status = 'P' AS a, priority = '1-URGENT' AS b FROM iso_v) WHERE a OR b GROUP BY gene""")
def result_index(spark, sf):
    iso = P.isoforms(spark, sf)
    return R.result_index({"p": iso.filter("status = 'P'"), "urgent": iso.filter("priority = '1-URGENT'")})


@query("accuracy_histogram", "SELECT CAST(floor(l_discount * 200 + 50 + l_tax * 100) AS BIGINT) AS bin, count(*) AS n FROM lineitem WHERE (100 * l_discount * 2 + 50 + l_tax * 100) < 101 GROUP BY 1")
def accuracy_histogram(spark, sf):
    li = P.table(spark, sf, "lineitem")
    return R.accuracy_histogram(li.select((F.col("l_discount") * 200 + 50 + F.col("l_tax") * 100).alias("coverage"), F.lit(100.0).alias("identity")))


@query("delimited_values", "SELECT l_orderkey AS iso, l_extendedprice AS length FROM lineitem")
def delimited_values(spark, sf):
    per = P.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("iso")).agg(F.array_join(F.collect_list(F.col("l_extendedprice").cast("string")), ",").alias("lengths"))
    return R.split_list(per, "lengths", "length")


@query("tail_site_report", """
SELECT gene, chrom, pa AS site, pa + 1 AS site_end, 'APA' || row_number() OVER (PARTITION BY gene ORDER BY pa) AS apa, n::DOUBLE AS count, n::DOUBLE AS length FROM
(SELECT gene, chrom, CASE WHEN strand = '+' THEN hi ELSE lo END AS pa, count(*) AS n FROM iso_v GROUP BY ALL)""")
def tail_site_report(spark, sf):
    p = PA.pa_sites(P.isoforms(spark, sf)).withColumn("_s", F.concat_ws("_", "chrom", "pa"))
    rows = F.array_sort(F.collect_list(F.struct("pa", "_s", "n")))
    col = lambda c: F.array_join(F.transform("_r", lambda x: x[c].cast("string")), ";")
    g = p.groupBy("gene").agg(rows.alias("_r")).select("gene", col("_s").alias("sites"), col("n").alias("counts"), col("n").alias("lengths"))
    return R.tail_report(g)


@query("rpkm_values", "SELECT iso, round(reads * 1e6 / (len / 1000.0 * 1000000), 6) AS rpkm FROM iso_v")
def rpkm_values(spark, sf):
    iso = P.isoforms(spark, sf)
    return iso.select("iso", F.round(F.col("reads") * 1e6 / (B.length(F.col("exons")) / 1000.0 * 1000000), 6).alias("rpkm"))


@query("gene_prefix", "SELECT iso, 'PB.' || gene AS prefix FROM iso_v")
def gene_prefix(spark, sf):
    name = F.concat_ws(".", F.lit("PB"), "gene", "iso")
    return P.isoforms(spark, sf).select("iso", F.substring_index(name, ".", 2).alias("prefix"))


@query("result_frame_concat", "SELECT iso, 'kept' AS origin FROM iso_v WHERE status = 'F' UNION ALL SELECT iso, 'novel' FROM iso_v WHERE status = 'O'")
def result_frame_concat(spark, sf):
    return part(spark, sf, "F").select("iso", F.lit("kept").alias("origin")).unionByName(part(spark, sf, "O").select("iso", F.lit("novel").alias("origin")))


@query("significant_gene_union", "SELECT gene FROM iso_v WHERE reads >= 7 UNION SELECT gene FROM iso_v WHERE n_ex >= 5")
def significant_gene_union(spark, sf):
    iso = P.isoforms(spark, sf)
    return iso.filter("reads >= 7").select("gene").union(iso.filter("size(exons) >= 5").select("gene")).distinct()
