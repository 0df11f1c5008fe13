"""Group tests, enrichment and learning."""

from __future__ import annotations

from pyspark.sql import functions as F

from spliceloom.functions import blocks as B
from spliceloom.operators import assign as A
from spliceloom.operators import features as FT
from spliceloom.operators import learning as L
from spliceloom.operators import sweeps as W
from spliceloom.operators import significance as T
from spliceloom.plans import proxy as P
from spliceloom.plans.registry import query, view
from spliceloom.session import bucketed, written
from spliceloom.sources.text import FEATURES

# tail length of an order: mean hundredth of the price; two sides by line status of the event type
view("len_v", """
SELECT o_custkey // 2 AS gene, l_linestatus AS side, floor(l_extendedprice / 100) AS value, l_returnflag, o_orderpriority, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")


def lengths(spark, sf):
    li = P.table(spark, sf, "lineitem").select("l_orderkey", "l_linestatus", "l_extendedprice", "l_returnflag", "l_quantity")
    od = P.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    j = li.join(od, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.select(F.floor(F.col("o_custkey") / 2).cast("long").alias("gene"), F.col("l_linestatus").alias("side"), F.floor(F.col("l_extendedprice") / 100).cast("double").alias("value"),
                    "l_returnflag", "o_orderpriority", "o_custkey")


view("rank_v", """
SELECT {k}, side, value, rank() OVER (PARTITION BY {k} ORDER BY value) + (count(*) OVER (PARTITION BY {k}, value) - 1) / 2.0 AS r,
  count(*) OVER (PARTITION BY {k}, value) AS tie FROM len_v""".format(k="gene"))
view("two_v", """
SELECT gene, n1, n2, (m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1.0 / n1 + 1.0 / n2)) AS t,
  (12.0 / ((n1 + n2) * (n1 + n2 + 1)) * (r1 * r1 / n1 + r2 * r2 / n2) - 3 * (n1 + n2 + 1)) / (1 - ties / (pow(n1 + n2, 3) - (n1 + n2))) AS h FROM (
SELECT gene, count(*) FILTER (side = 'F') AS n1, count(*) FILTER (side = 'O') AS n2, avg(value) FILTER (side = 'F') AS m1, avg(value) FILTER (side = 'O') AS m2,
  var_samp(value) FILTER (side = 'F') AS v1, var_samp(value) FILTER (side = 'O') AS v2, sum(r) FILTER (side = 'F') AS r1, sum(r) FILTER (side = 'O') AS r2,
  sum(tie * tie - 1)::DOUBLE AS ties FROM rank_v GROUP BY gene) WHERE n1 >= 5 AND n2 >= 5""")


@query("tail_length_tests", "SELECT gene, n1, n2, round(t, 6) AS t, round(h, 6) AS h FROM two_v")
def tail_length_tests(spark, sf):
    r = T.two_sample(lengths(spark, sf), ["gene"], first="F", second="O", min_n=5)
    return r.select("gene", "n1", "n2", F.round("t", 6).alias("t"), F.round("h", 6).alias("h"))


@query("tail_length_differences")
def tail_length_differences(spark, sf):
    r = T.significant_pairs(T.two_sample(lengths(spark, sf), ["gene"], first="F", second="O", min_n=5), 0.05)
    return r.select("gene", "n1", "n2", F.round("p_t", 6).alias("p_t"), F.round("p_h", 6).alias("p_h"))


@query("average_ranks", """
SELECT gene, value, count(*) AS ties, any_value(r) AS rank FROM rank_v GROUP BY gene, value""")
def average_ranks(spark, sf):
    return W.average_ranks(lengths(spark, sf).select("gene", "value"), ["gene"], "value", 64.0)


@query("exact_medians", "SELECT gene, quantile_cont(value, 0.5) AS median FROM len_v GROUP BY gene")
def exact_medians(spark, sf):
    return W.exact_median(lengths(spark, sf), ["gene"], "value", width=64.0)


@query("polya_site_length_pairs")
def polya_site_length_pairs(spark, sf):
    v = lengths(spark, sf).select("gene", F.col("l_returnflag").alias("site"), "value")
    r = T.site_pairs(v, min_n=5, alpha=0.05)
    return r.select("gene", "a_site", "b_site", F.round("t", 6).alias("t"), F.round("h", 6).alias("h"))


@query("polya_sites_with_length_difference")
def polya_sites_with_length_difference(spark, sf):
    v = lengths(spark, sf).select("gene", F.col("l_returnflag").alias("site"), "value")
    return T.valid_sites(T.site_pairs(v, min_n=5, alpha=0.05), 0.05)


@query("allele_chi_square", """
WITH c AS (SELECT o_custkey AS event, l_returnflag AS haplo, count(*) FILTER (side = 'F') AS inc, count(*) FILTER (side = 'O') AS exc FROM (SELECT l_returnflag, l_linestatus AS side, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey) GROUP BY ALL),
ok AS (SELECT event, arg_min(haplo, -inc * 1000 + ascii(haplo)) AS inc_haplo, arg_min(haplo, -exc * 1000 + ascii(haplo)) AS exc_haplo, sum(inc) AS i, sum(exc) AS e, count(*) FILTER (inc + exc > 0) AS n FROM c GROUP BY event
  HAVING max(inc) >= 5 AND max(exc) >= 5 AND min(inc) <= 3 AND min(exc) <= 3 AND count(*) FILTER (inc + exc > 0) > 1),
x AS (SELECT c.event, ok.*, inc, exc, (inc + exc) * i / (i + e) AS ei, (inc + exc) * e / (i + e) AS ee FROM c JOIN ok USING (event) WHERE inc + exc > 0)
SELECT event, any_value(inc_haplo) AS inc_haplo, any_value(exc_haplo) AS exc_haplo, any_value(n) AS n_rows,
  round(sum(pow(abs(inc - ei) - CASE WHEN n = 2 THEN least(0.5, abs(inc - ei)) ELSE 0 END, 2) / ei + pow(abs(exc - ee) - CASE WHEN n = 2 THEN least(0.5, abs(exc - ee)) ELSE 0 END, 2) / ee), 6) AS chi2 FROM x GROUP BY event""")
def allele_chi_square(spark, sf):
    r = T.allele_association(allele_cells(spark, sf), ["event"], alpha=None)
    return r.select("event", "inc_haplo", "exc_haplo", "n_rows", F.round("chi2", 6).alias("chi2"))


def allele_cells(spark, sf):
    r = lengths(spark, sf)
    return r.groupBy(F.col("o_custkey").alias("event"), F.col("l_returnflag").alias("haplo")).agg(
        F.sum((F.col("side") == "F").cast("long")).alias("inc"), F.sum((F.col("side") == "O").cast("long")).alias("exc"))


@query("allele_associations")
def allele_associations(spark, sf):
    r = T.allele_association(allele_cells(spark, sf), ["event"], alpha=0.05)
    return r.select("event", "inc_haplo", "exc_haplo", F.round("p", 6).alias("p"))


@query("even_split_tests", """
SELECT event, round(2 * pow(greatest(d - 0.5, 0), 2) / e1 + 2 * pow(greatest(d - 0.5, 0), 2) / e2, 6) AS chi2 FROM (
  SELECT o_custkey AS event, count(*) FILTER (l_linestatus = 'F') AS a, count(*) FILTER (l_linestatus = 'O') AS b, (count(*) FILTER (l_linestatus = 'F') + count(*) / 2.0) / 2 AS e1,
    (count(*) FILTER (l_linestatus = 'O') + count(*) / 2.0) / 2 AS e2, abs(count(*) FILTER (l_linestatus = 'F') - (count(*) FILTER (l_linestatus = 'F') + count(*) / 2.0) / 2) AS d
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey)""")
def even_split_tests(spark, sf):
    per = allele_cells(spark, sf).groupBy("event").agg(F.sum("inc").alias("a"), F.sum("exc").alias("b"))
    return T.half_test(per, "a", "b", "x").select("event", F.round("x_chi2", 6).alias("chi2"))


@query("allele_expression")
def allele_expression(spark, sf):
    r = lengths(spark, sf)
    n = lambda f, s: F.sum(((F.col("l_returnflag") == f) & (F.col("side") == s)).cast("long"))
    per = r.groupBy("gene").agg(n("A", "F").alias("ref_long"), n("R", "F").alias("alt_long"), n("N", "F").alias("ref_short"), n("N", "O").alias("alt_short"))
    return T.allele_expression(per).select("gene", F.round("long_p", 6).alias("long_p"), F.round("short_p", 6).alias("short_p"))


view("term_v", "SELECT DISTINCT p_brand AS term, p_partkey AS gene FROM part")


def terms(spark, sf):
    return P.table(spark, sf, "part").select(F.col("p_brand").alias("term"), F.col("p_partkey").alias("gene"))


def listed(spark, sf):
    return P.table(spark, sf, "lineitem").filter("l_quantity >= 45").select(F.col("l_returnflag").alias("sample"), F.col("l_partkey").alias("gene")).distinct()


@query("term_counts", """
WITH l AS (SELECT DISTINCT l_returnflag AS sample, l_partkey AS gene FROM lineitem WHERE l_quantity >= 45 AND l_partkey IN (SELECT gene FROM term_v))
SELECT sample, term, count(*) AS hits, any_value(d) AS drawn, any_value(k) AS term_size, (SELECT count(DISTINCT gene) FROM term_v) AS total
FROM l JOIN term_v USING (gene) JOIN (SELECT term, count(*) AS k FROM term_v GROUP BY term) USING (term) JOIN (SELECT sample, count(*) AS d FROM l GROUP BY sample) USING (sample) GROUP BY sample, term""")
def term_counts(spark, sf):
    return T.term_counts(terms(spark, sf), listed(spark, sf), ["sample"])


@query("over_represented_terms")
def over_represented_terms(spark, sf):
    r = T.over_representation(T.term_counts(terms(spark, sf), listed(spark, sf), ["sample"]), ["sample"], min_size=1)
    return r.select("sample", "term", "hits", F.round("p", 6).alias("p"), F.round("p_adj", 6).alias("p_adj"), F.round("q", 6).alias("q"))


@query("adjusted_p_values", """
WITH p AS (SELECT l_orderkey, l_linenumber, l_partkey, (l_extendedprice - floor(l_extendedprice)) AS p FROM lineitem), m AS (SELECT count(*) AS m FROM p),
r AS (SELECT p, rank() OVER (ORDER BY p) + count(*) OVER (PARTITION BY p) - 1 AS r FROM p), d AS (SELECT DISTINCT p, p * m / r AS raw FROM r, m),
a AS (SELECT p, least(min(raw) OVER (ORDER BY p DESC), 1.0) AS p_adj FROM d)
SELECT l_orderkey, l_linenumber, l_partkey, round(p_adj, 6) AS p_adj FROM p JOIN a USING (p)""")
def adjusted_p_values(spark, sf):
    li = P.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_extendedprice") - F.floor("l_extendedprice")).alias("p"))
    return W.bh_adjusted(li).select("l_orderkey", "l_linenumber", "l_partkey", F.round("p_adj", 6).alias("p_adj"))


view("cond_v", """
SELECT o_custkey // 2 AS event_id, o_orderpriority AS condition, count(*) FILTER (l_linestatus = 'F') AS inc, count(*) FILTER (l_linestatus = 'O') AS exc
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""")


def condition_counts(spark, sf):
    return lengths(spark, sf).groupBy(F.col("gene").alias("event_id"), F.col("o_orderpriority").alias("condition")).agg(
        F.sum((F.col("side") == "F").cast("long")).alias("inc"), F.sum((F.col("side") == "O").cast("long")).alias("exc"))


@query("condition_pairs", """
SELECT event_id, a.condition AS cond1, b.condition AS cond2, a.inc AS inc1, a.exc AS exc1, b.inc AS inc2, b.exc AS exc2 FROM cond_v a JOIN cond_v b USING (event_id) WHERE a.condition < b.condition""")
def condition_pairs(spark, sf):
    return T.condition_pairs(condition_counts(spark, sf))


@query("differential_splicing", """
SELECT event_id, cond1, cond2, round(inc1::DOUBLE / (inc1 + exc1) - inc2::DOUBLE / (inc2 + exc2), 6) AS delta_psi,
  CASE WHEN (inc1 + inc2) * (exc1 + exc2) > 0 THEN round(n * pow(g - least(g, n / 2.0), 2) / ((inc1 + exc1) * (inc2 + exc2) * (inc1 + inc2) * (exc1 + exc2))::DOUBLE, 6) END AS chi2 FROM (
  SELECT event_id, a.condition AS cond1, b.condition AS cond2, a.inc AS inc1, a.exc AS exc1, b.inc AS inc2, b.exc AS exc2, (a.inc + a.exc + b.inc + b.exc)::DOUBLE AS n,
    abs(a.inc * b.exc - a.exc * b.inc)::DOUBLE AS g FROM cond_v a JOIN cond_v b USING (event_id) WHERE a.condition < b.condition)""")
def differential_splicing(spark, sf):
    r = T.differential_splicing(condition_counts(spark, sf))
    return r.select("event_id", "cond1", "cond2", F.round("delta_psi", 6).alias("delta_psi"), F.round("chi2", 6).alias("chi2"))


@query("differential_events")
def differential_events(spark, sf):
    r = T.significant(T.differential_splicing(condition_counts(spark, sf)), 0.5)
    return r.select("event_id", "cond1", "cond2", F.round("p", 6).alias("p"), F.round("fdr", 6).alias("fdr"))


# learning: isoform features and the schemes over them

view("feat_v", """
SELECT i.iso, CAST(i.len AS BIGINT) AS "isoLength", i.reads AS "flCount", round(i.reads::DOUBLE / g.r, 3) AS "ratioIsoToGene", i.n_ex AS "exonNum", CASE WHEN i.status = 'F' THEN 'annotated' ELSE 'novel' END AS annotation,
  round(coalesce((length(c.seq) - length(translate(c.seq, 'GC', '')))::DOUBLE / length(c.seq), 0), 3) AS "GC", coalesce(orf_length, 0) AS "orfLength", coalesce(c.integrity, -1) AS "orfIntegrity", coalesce(pep_len, 0) AS "pepLength",
  round(coalesce(fickett, 0), 3) AS "FickettScore", round(coalesce(pi, 0), 3) AS "pI", round(coalesce(coding_probability, 0), 3) AS "codingP", coalesce(coding_label, 'noncoding') AS "codingLabel",
  round(coalesce(ratio, 0), 3) AS "canJuncRatio", round(coalesce(sd_cov, 0), 3) AS "sdJuncCov", coalesce(with_novel, 0) AS "withNovelJunc", round(coalesce(min_novel_rpkm, 0), 3) AS "minNovelJuncRPKM",
  (b.iso IS NOT NULL)::BIGINT AS bite, round(coalesce(min_rpkm, 0), 3) AS "minJuncRPKM", coalesce(n_indels, 0) AS "nIndelsAroundJunc", round(coalesce(min_to_all, 0), 3) AS "ratioMinJuncCovToAllCov",
  coalesce(n_junc_indels, 0) AS "nJuncsWithIndels", (coalesce(n_indels, 0) > 0)::BIGINT AS "indelNearJunc"
FROM iso_v i JOIN (SELECT gene, sum(reads) AS r FROM iso_v GROUP BY gene) g USING (gene) LEFT JOIN tcpc_v c ON c.id = i.iso LEFT JOIN jf_v j ON j.iso = i.iso LEFT JOIN bite_v b ON b.iso = i.iso
LEFT JOIN (SELECT iso, avg(CASE WHEN motif IN ('GT-AG', 'GC-AG', 'AT-AC') THEN 1.0 ELSE 0 END) AS ratio FROM mot_v GROUP BY iso) m ON m.iso = i.iso""")


def base_features(spark, sf):
    """All columns of the feature table. The transcript view is built once, from one scan of the line items, into a table bucketed by isoform."""
    from spliceloom.functions import alignment as AL
    from spliceloom.plans.sequence_queries import MODEL
    iso = P.isoforms(spark, sf).withColumn("annotation", F.when(F.col("status") == "F", "annotated").otherwise("novel"))
    iso = bucketed(iso, "isoforms", "iso")
    start = F.col("pos") - 1
    al = P.alignments(spark, sf, iso).select("chrom", AL.indels(start, F.col("cigar")).alias("indels"), B.introns(AL.cigar_blocks(start, F.col("cigar"))).alias("junctions"))
    return FT.isoform_features(iso, P.genome(spark, sf), P.junction_table(spark, sf, iso), al, MODEL, P.placed_isoforms(spark, sf, iso), 95)


@query("isoform_feature_table", "SELECT * FROM feat_v")
def isoform_feature_table(spark, sf):
    return base_features(spark, sf)


def few_features(spark, sf):
    """The columns that rules alone need, without texts."""
    iso = bucketed(P.isoforms(spark, sf).withColumn("annotation", F.when(F.col("status") == "F", "annotated").otherwise("novel")), "isoforms", "iso")
    from spliceloom.operators.transcripts import intron_rows
    known = intron_rows(iso.filter("annotation = 'annotated'")).select("chrom", "a", "b").distinct()
    none = spark.createDataFrame([], "chrom string, a long, b long, indel string, n long")
    cover = A.junction_features(iso, P.junction_table(spark, sf, iso), known, none, iso.agg(F.count(F.lit(1)).alias("reads_total")))
    out = FT.support_part(iso).join(cover, "iso", "left")
    third = lambda c: F.round(F.coalesce(c, F.lit(0.0)), 3)
    return out.select("iso", "annotation", "flCount", "exonNum", third("ratioIsoToGene").alias("ratioIsoToGene"), third("min_rpkm").alias("minJuncRPKM"),
                      F.coalesce("with_novel", F.lit(0)).alias("withNovelJunc"), third("min_novel_rpkm").alias("minNovelJuncRPKM"))


@query("labelled_isoforms", """
SELECT iso, CASE WHEN annotation = 'annotated' AND "flCount" >= 2 AND "minJuncRPKM" >= 0.05 THEN 'positive' WHEN annotation = 'annotated' THEN 'kept' ELSE 'unlabelled' END AS role,
  CASE WHEN annotation = 'annotated' THEN 1.0 ELSE 0.0 END::DOUBLE AS label FROM feat_v""")
def labelled_isoforms(spark, sf):
    return L.labelled(few_features(spark, sf)).select("iso", "role", "label")


def training(spark, sf):
    """Positive and unlabelled isoforms with all features, written once: every scheme reads it more than once."""
    return written(L.labelled(base_features(spark, sf)).filter("role <> 'kept'").select("iso", "role", "label", *FEATURES), "training")


@query("bagged_isoform_scores")
def bagged_isoform_scores(spark, sf):
    return L.bagged_scores(training(spark, sf), FEATURES, "GB", rounds=100).select("iso", "role", "pu_score")


@query("two_step_isoform_scores")
def two_step_isoform_scores(spark, sf):
    return L.two_step(L.assemble(training(spark, sf), FEATURES), "RF", limit=10).select("iso", "role", "state", "pu_score")


@query("supervised_isoform_scores")
def supervised_isoform_scores(spark, sf):
    t = L.assemble(training(spark, sf), FEATURES)
    return L.supervised(t, t, "GB").select("iso", "pu_score")


@query("reliable_negatives", """SELECT iso FROM feat_v WHERE annotation = 'novel' AND ("ratioIsoToGene" < 0.05 OR ("withNovelJunc" = 1 AND "minNovelJuncRPKM" < 0.05))""")
def reliable_negatives(spark, sf):
    return L.negatives(few_features(spark, sf)).select("iso")


@query("bagged_classes")
def bagged_classes(spark, sf):
    t = training(spark, sf)
    return L.bagged_probability(t, FEATURES, L.bagged_models(t, FEATURES, "NB", rounds=100)).select("iso", "prob", "predicted", "log_prob_1", "log_prob_0")


@query("kept_isoforms", """
SELECT iso, CASE WHEN annotation = 'annotated' AND NOT ("flCount" >= 2 AND "minJuncRPKM" >= 0.05) THEN 1.0 ELSE "ratioIsoToGene" END::DOUBLE AS pu_score FROM feat_v
WHERE annotation = 'annotated' OR "ratioIsoToGene" >= 0.05""")
def kept_isoforms(spark, sf):
    rows = L.labelled(few_features(spark, sf)).withColumn("pu_score", F.col("ratioIsoToGene"))
    return L.kept_isoforms(rows, 0.05).select("iso", "pu_score")


@query("confusion_scores", """
SELECT tp, fp, fn, round(p, 6) AS precision, round(r, 6) AS recall, round(2 * p * r / (p + r), 6) AS f1 FROM (SELECT *, tp::DOUBLE / (tp + fp) AS p, tp::DOUBLE / (tp + fn) AS r FROM (
  SELECT count(*) FILTER (annotation = 'annotated' AND "exonNum" >= 3) AS tp, count(*) FILTER (annotation <> 'annotated' AND "exonNum" >= 3) AS fp, count(*) FILTER (annotation = 'annotated' AND "exonNum" < 3) AS fn FROM feat_v))""")
def confusion_scores(spark, sf):
    rows = few_features(spark, sf).select((F.col("annotation") == "annotated").cast("int").alias("label"), (F.col("exonNum") >= 3).cast("int").alias("predicted"))
    return L.confusion(rows).select("tp", "fp", "fn", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@query("model_choice")
def model_choice(spark, sf):
    """Five models, five folds and the holdout, a hundred rounds each, on all features."""
    rows = written(base_features(spark, sf), "features")
    pos = L.labelled(rows).filter("role = 'positive'").withColumn("label", F.lit(1.0))
    neg = L.negatives(rows).withColumn("label", F.lit(0.0))
    cols = ["iso", "label", *FEATURES]
    return L.choose_model(pos.select(*cols).unionByName(neg.select(*cols)), FEATURES)
