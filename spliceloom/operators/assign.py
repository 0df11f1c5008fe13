"""Reads, junctions and isoforms against gene models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spliceloom.functions import blocks as B
from spliceloom.functions.sequence import CANONICAL, canonical_site
from spliceloom.operators.overlap import overlap_anti, overlap_join, overlap_size
from spliceloom.operators.sweeps import exact_median, numbered_islands, two_way_clusters
from spliceloom.operators.transcripts import exon_rows, intron_rows
from spliceloom.session import durable, written


def by_keys(rows: DataFrame, keys: DataFrame, on: list[str], include: bool = True, unique: bool = False) -> DataFrame:
    """Rows whose key is in (or not in) a key list; `unique` keeps one row per key."""
    kept = rows.join(keys.select(*on).distinct(), on, "left_semi" if include else "left_anti")
    return kept.dropDuplicates(on) if unique else kept


def measures(offset: int = 10) -> dict[str, Column]:
    """Measures of (exons, t_exons) pairs that carry their introns (introns, t_introns) and lengths (len, t_len)."""
    r, t, ri, ti = F.col("exons"), F.col("t_exons"), F.col("introns"), F.col("t_introns")
    n, m = F.size(ri), F.size(ti)
    flank = (n > 0) & (n <= m) & ((F.slice(ti, F.lit(1), n) == ri) | (F.slice(ti, F.greatest(m - n + 1, F.lit(1)), n) == ri))
    rs, re = r[0]["s"], F.element_at(r, -1)["e"]
    lt = F.element_at(t, -1)
    in_end = ((t[0]["s"] < re) & (re <= t[0]["e"])) | ((lt["s"] <= rs) & (rs < lt["e"]))
    bp = B.overlap_length(r, t)
    return {"bp": bp, "read_cov": bp / F.col("len"), "trans_cov": bp / F.col("t_len"), "shared": B.shared_introns(ri, ti, offset), "flank": flank,
            "in_end_exon": in_end, "n_introns": n, "t_exon_count": m + 1}


def structure_key(df: DataFrame) -> DataFrame:
    """Distinct structures (chrom, strand, exons) with their span; names join back on those columns."""
    x = F.col("exons")
    return df.select("chrom", "strand", "exons").distinct().withColumn("start", x[0]["s"]).withColumn("end", F.element_at(x, -1)["e"])


def assign_pairs(reads: DataFrame, models: DataFrame, offset: int = 10, min_shared: int = 1, min_cov: float = 0.9) -> DataFrame:
    """Class E or I of every overlapping (read structure, transcript) pair, strand ignored.

    reads: chrom, strand, exons...; models: chrom, t_name, t_gene, t_exons. Works on
    distinct read structures, so copies of one structure meet each transcript once.
    """
    x, t = F.col("exons"), F.col("t_exons")
    m = models.select("chrom", "t_name", "t_gene", "t_exons", B.introns(t).alias("t_introns"), B.length(t).alias("t_len"),
                      t[0]["s"].alias("t_start"), F.element_at(t, -1)["e"].alias("t_end"))
    # introns and lengths are made once per structure, before the join multiplies rows
    r = structure_key(reads).withColumn("introns", B.introns(x)).withColumn("len", B.length(x))
    p, v = overlap_join(r, m, ["chrom"], rs="t_start", re="t_end"), measures(offset)
    # one expression, cheap tests first: introns are compared and bases counted only for the pairs that the tests before leave open
    sites = F.when(v["n_introns"] > 0, v["flank"] | (v["shared"] >= F.least(v["n_introns"], F.lit(min_shared)))).otherwise((v["t_exon_count"] <= 1) | v["in_end_exon"])
    return p.withColumns({**v, "exonic": sites | (v["read_cov"] >= min_cov)})


def assign_reads(reads: DataFrame, models: DataFrame, **rules) -> DataFrame:
    """One row per read: class E, I or IG, number of matching transcripts and distinct genes, and the single gene if one.

    Only pairs of the winning class count. Counts come from algebraic
    aggregates over structures; the transcript list itself is `assigned_transcripts`.
    """
    p = assign_pairs(reads, models, **rules)
    key = ["chrom", "strand", "exons"]
    per = p.filter(F.col("exonic").isNotNull()).groupBy(*key, "exonic", "t_gene").agg(F.count(F.lit(1)).alias("n"))  # the pairs are met once
    size = per.groupBy(*key, "exonic").agg(F.sum("n").alias("n_trans"), F.count(F.lit(1)).alias("n_genes"), F.min("t_gene").alias("one_gene"))
    best = size.groupBy(*key).agg(F.max(F.struct("exonic", "n_trans", "n_genes", "one_gene")).alias("_b"))
    cls = best.select(*key, F.when(F.col("_b.exonic"), "E").otherwise("I").alias("class"), F.col("_b.n_trans").alias("n_trans"),
                      F.col("_b.n_genes").alias("n_genes"), F.when(F.col("_b.n_genes") == 1, F.col("_b.one_gene")).alias("one_gene"))
    return (reads.join(cls, key, "left").withColumn("class", F.coalesce("class", F.lit("IG")))
                 .withColumn("n_trans", F.coalesce("n_trans", F.lit(0))).withColumn("n_genes", F.coalesce("n_genes", F.lit(0))))


def assigned_transcripts(reads: DataFrame, models: DataFrame, **rules) -> DataFrame:
    """Long table of the pairs behind `assign_reads` (winning class only)."""
    p = assign_pairs(reads, models, **rules)
    key = ["chrom", "strand", "exons"]
    top = p.groupBy(*key).agg(F.max("exonic").alias("exonic"))
    return reads.join(p.join(top, [*key, "exonic"]), key)


def unambiguous(assigned: DataFrame) -> DataFrame:
    """Gene of reads with class E and one gene; all others are numbered novel loci per chrom and strand."""
    sure = (F.col("class") == "E") & (F.col("n_genes") == 1)
    assigned = written(assigned, "assigned")
    rest = assigned.filter(~sure)
    loci = numbered_islands(rest, ["chrom", "strand"]).select("chrom", "strand", "start", "island_no")
    named = rest.join(loci, ["chrom", "strand", "start"]).withColumn(
        "locus", F.concat_ws(":", "chrom", "strand", "island_no")).drop("island_no")
    return assigned.filter(sure).withColumn("locus", F.col("one_gene").cast("string")).unionByName(named)


def assign_junctions(junctions: DataFrame, models: DataFrame) -> DataFrame:
    """Class and gene rows of junctions: E if an edge is an exon edge or both blocks hit exons, I if only the span overlaps, IG otherwise.

    junctions: chrom, strand, start, js, je, end. models: chrom, strand, t_gene, t_exons.
    Returns the genes of the winning class as rows (junction, class, gene).
    """
    key = ["chrom", "strand", "start", "js", "je", "end"]
    t = F.col("t_exons")
    m = models.select("chrom", "strand", "t_gene", "t_exons").distinct().withColumn(
        "t_start", t[0]["s"]).withColumn("t_end", F.element_at(t, -1)["e"])
    j = junctions.select(*key).distinct()
    p = overlap_join(j, m, ["chrom", "strand"], rs="t_start", re="t_end")
    n = F.size(t)
    donor = F.exists(F.slice(t, F.lit(1), F.greatest(n - 1, F.lit(0))), lambda x: x["e"] == F.col("js"))
    acceptor = F.exists(F.slice(t, F.lit(2), F.greatest(n - 1, F.lit(0))), lambda x: x["s"] == F.col("je"))
    hit = lambda s, e: F.exists(t, lambda x: (s < x["e"]) & (e > x["s"]))
    both = hit(F.col("start"), F.col("js")) & hit(F.col("je"), F.col("end"))
    g = p.withColumn("exonic", donor | acceptor | both).groupBy(*key, "t_gene").agg(F.max("exonic").alias("exonic"))
    top = g.groupBy(*key).agg(F.max("exonic").alias("exonic"))
    won = g.join(top, [*key, "exonic"]).select(*key, F.when(F.col("exonic"), "E").otherwise("I").alias("class"), "t_gene")
    none = j.join(top.select(*key), key, "left_anti").select(*key, F.lit("IG").alias("class"),
                                                             F.lit(None).cast(g.schema["t_gene"].dataType).alias("t_gene"))
    return won.unionByName(none)


def shared_site_genes(reads: DataFrame, models: DataFrame, offset: int = 0) -> DataFrame:
    """(iso, t_gene) pairs: a read joins a gene when an intron start or end coincides within `offset` and the spans overlap,
    or, for single-exon reads, when half of the read lies in a transcript span.

    reads: chrom, strand, iso, start, end, exons; models: chrom, strand, t_gene, t_name, t_exons.
    Equal sites are an equi-join; both sides are reduced to distinct sites first.
    """
    t = F.col("t_exons")
    span = models.withColumn("t_start", t[0]["s"]).withColumn("t_end", F.element_at(t, -1)["e"])
    def sites(gaps: DataFrame, keep: list[str]) -> DataFrame:
        return gaps.select("chrom", "strand", *keep, F.explode(F.array(
            F.struct(F.lit("a").alias("edge"), F.col("a").alias("at")),
            F.struct(F.lit("b").alias("edge"), F.col("b").alias("at")))).alias("_s")).select("chrom", "strand", *keep, "_s.edge", "_s.at")
    rs = sites(intron_rows(reads), ["iso"]).distinct()
    ms = sites(intron_rows(span.withColumnRenamed("t_exons", "exons"), ["t_gene"]), ["t_gene"]).distinct()
    used = rs.select("chrom", "strand", "edge", "at").distinct()
    if offset:
        near = F.explode(F.sequence(F.col("at") - offset, F.col("at") + offset))
        ms = ms.withColumn("at", near).distinct()
    site_genes = used.join(ms, ["chrom", "strand", "edge", "at"])
    multi = rs.join(site_genes, ["chrom", "strand", "edge", "at"]).select("iso", "t_gene")
    mono = reads.filter(F.size("exons") == 1).select("chrom", "strand", "iso", "start", "end")
    cover = overlap_size(mono.select("chrom", "strand", "start", "end").distinct(),
                         span.select("chrom", "strand", "t_gene", "t_start", "t_end").distinct(),
                         ["chrom", "strand"], rs="t_start", re="t_end").filter(F.col("left_share") >= 0.5)
    single = mono.join(cover.select("chrom", "strand", "start", "end", "t_gene").distinct(), ["chrom", "strand", "start", "end"]).select("iso", "t_gene")
    return multi.unionByName(single).distinct()


def without_gene(reads: DataFrame, joined: DataFrame) -> DataFrame:
    """Reads that joined no gene."""
    return reads.join(joined.select("iso").distinct(), "iso", "left_anti")


def known_isoforms(isoforms: DataFrame, models: DataFrame) -> DataFrame:
    """Add `annotation`: a multi-exon isoform is known when its intron chain is annotated on the chromosome, a mono-exon
    one when it covers half of an annotated mono-exon transcript.

    models: chrom, t_name, t_exons.
    """
    chain = lambda c: B.chain(B.introns(F.col(c)))
    known = models.filter(F.size("t_exons") > 1).select("chrom", chain("t_exons").alias("chain")).distinct().withColumn("_k", F.lit(True))
    multi = isoforms.filter(F.size("exons") > 1).withColumn("chain", chain("exons")).join(known, ["chrom", "chain"], "left").drop("chain")
    mono_models = models.filter(F.size("t_exons") == 1).select(
        "chrom", F.col("t_exons")[0]["s"].alias("t_start"), F.col("t_exons")[0]["e"].alias("t_end")).distinct()
    mono = isoforms.filter(F.size("exons") == 1)
    hit = overlap_size(mono.select("chrom", "start", "end").distinct(), mono_models, ["chrom"], rs="t_start", re="t_end").filter(
        F.col("right_share") >= 0.5).select("chrom", "start", "end").distinct().withColumn("_k", F.lit(True))
    out = multi.unionByName(mono.join(hit, ["chrom", "start", "end"], "left"))
    return out.withColumn("annotation", F.when(F.col("_k"), "annotated").otherwise("novel")).drop("_k")


def filter_reads(reads: DataFrame, known_introns: DataFrame, max_intron: int = 50000, min_chain: int = 2, min_seen: int = 3) -> DataFrame:
    """Long reads worth keeping; known_introns: chrom, a, b of annotation and short reads.

    Single-exon reads stay. Others need summed introns <= max, chain support >= min_chain and either four introns or
    a third of their introns known or seen min_seen times. All counts are over distinct structures weighted by copies.
    """
    single = reads.filter(F.size("exons") == 1)
    copies = reads.filter(F.size("exons") > 1).withColumn("introns", B.introns(F.col("exons"))).groupBy("chrom", "introns").agg(
        F.count(F.lit(1)).alias("n"))
    rows = copies.withColumn("chain", B.chain(F.col("introns"))).select(
        "chrom", "chain", "n", F.size("introns").alias("k"), B.length(F.col("introns")).alias("total"), F.explode("introns").alias("x")).select(
        "chrom", "chain", "n", "k", "total", F.col("x.s").alias("a"), F.col("x.e").alias("b"))
    seen = rows.groupBy("chrom", "a", "b").agg(F.sum("n").alias("seen"))
    mark = seen.join(known_introns.select("chrom", "a", "b").distinct().withColumn("_k", F.lit(True)), ["chrom", "a", "b"], "left").select(
        "chrom", "a", "b", F.coalesce(F.col("_k"), F.col("seen") >= min_seen).alias("good"))
    ok = rows.join(mark, ["chrom", "a", "b"]).groupBy("chrom", "chain", "n", "k", "total").agg(
        F.sum(F.col("good").cast("int")).alias("good")).filter(
        (F.col("total") <= max_intron) & (F.col("n") >= min_chain) & ((F.col("k") >= 4) | (F.col("good") * 3 >= F.col("k"))))
    multi = reads.filter(F.size("exons") > 1).withColumn("chain", B.chain(B.introns(F.col("exons"))))
    return single.unionByName(multi.join(ok.select("chrom", "chain"), ["chrom", "chain"], "left_semi").drop("chain"))


def covered_junctions(junctions: DataFrame, gene_spans: DataFrame, share: float = 0.05) -> DataFrame:
    """Junctions of a gene without those under `share` of max(median, mean) of the gene's coverage.

    junctions: chrom, strand, start, end, cnt; gene_spans: chrom, strand, gene, g_start, g_end.
    """
    pairs = overlap_join(junctions, gene_spans, ["chrom", "strand"], rs="g_start", re="g_end").select(
        "gene", "chrom", "strand", "start", "end", "cnt").distinct()
    mean = pairs.groupBy("gene").agg(F.avg("cnt").alias("mean"))
    level = exact_median(pairs, ["gene"], "cnt").join(mean, "gene").select("gene", F.greatest("median", "mean").alias("level"))
    return pairs.join(level, "gene").filter(F.col("cnt") >= F.col("level") * share).drop("level")


def junction_support(long_reads: DataFrame, short_junctions: DataFrame, models: DataFrame) -> DataFrame:
    """Counts per junction from long reads, short reads and annotation (null where absent)."""
    key = ["chrom", "strand", "a", "b"]
    l = intron_rows(long_reads).groupBy(*key).agg(F.count(F.lit(1)).alias("l_score"))
    s = short_junctions.groupBy("chrom", "strand", F.col("js").alias("a"), F.col("je").alias("b")).agg(F.sum("cnt").alias("j_score"))
    r = intron_rows(models.withColumnRenamed("t_exons", "exons")).groupBy(*key).agg(F.count(F.lit(1)).alias("r_score"))
    return l.join(s, key, "full").join(r, key, "full")


def extracted_junctions(alignments: DataFrame, anchor: int = 5, min_intron: int = 50, max_intron: int = 50000) -> DataFrame:
    """Junction counts from alignments (chrom, strand, anchors): both anchors and the intron size in range."""
    rows = alignments.select("chrom", "strand", F.explode("anchors").alias("x")).select("chrom", "strand", "x.*")
    size = F.col("e") - F.col("s")
    return rows.filter((F.col("s") - F.col("left") >= anchor) & (F.col("right") - F.col("e") >= anchor)
                       & (size >= min_intron) & (size <= max_intron)).groupBy("chrom", "strand", F.col("s").alias("a"), F.col("e").alias("b")).agg(
        F.count(F.lit(1)).alias("cnt"), F.min("left").alias("start"), F.max("right").alias("end"))


def intron_support(isoforms: DataFrame, junctions: DataFrame) -> DataFrame:
    """Per isoform: introns and introns present as junctions. junctions: chrom, strand, js, je."""
    known = junctions.select("chrom", "strand", F.col("js").alias("a"), F.col("je").alias("b")).distinct().withColumn("_k", F.lit(1))
    hit = intron_rows(isoforms).join(known, ["chrom", "strand", "a", "b"], "left").groupBy("iso").agg(F.count("_k").alias("supported"))
    return isoforms.select("iso", (F.size("exons") - 1).alias("introns")).join(hit, "iso", "left").withColumn(
        "supported", F.coalesce("supported", F.lit(0)))


def support_summary(support: DataFrame) -> DataFrame:
    """Isoforms by (introns, supported) with the number of isoforms having that many introns and the share of all."""
    cell = support.groupBy("introns", "supported").agg(F.count(F.lit(1)).alias("n"))
    row = cell.groupBy("introns").agg(F.sum("n").alias("n_introns"))
    total = cell.agg(F.sum("n").alias("_all")).withColumn("_one", F.lit(1))
    out = cell.join(row, "introns").withColumn("_one", F.lit(1)).join(F.broadcast(total), "_one")  # one row
    return out.withColumn("share", F.col("n") / F.col("_all")).drop("_one", "_all")


def site_scores(motifs: DataFrame) -> DataFrame:
    """(iso, score): canonical sites of all introns read forward less those read reverse; a site outside its sequence has no vote."""
    one = lambda s, kind, two: F.coalesce(canonical_site(s, kind, F.col(two)).cast("int"), F.lit(0))
    point = lambda s, left, right: one(s, left, "left_two") + one(s, right, "right_two")
    return motifs.groupBy("iso").agg(F.sum(point("+", "donor", "acceptor") - point("-", "acceptor", "donor")).alias("score"))


def strand_vote(reads: DataFrame, motifs: DataFrame, models: DataFrame, margin: int = 0, min_cov: float = 0.5) -> DataFrame:
    """Decide the strand of reads: canonical sites read forward against reverse, the models' strand otherwise.

    reads: iso, chrom, strand, start, end, exons; motifs: iso, left_two, right_two (one row per intron);
    models: chrom, t_strand, t_exons. A mono-exon read follows the models it covers by `min_cov` on either side when
    they agree; an undecided multi-exon read follows overlapping models when they agree; others keep their strand.
    """
    score = site_scores(motifs)
    t = F.col("t_exons")
    m = models.select("chrom", "t_strand", "t_exons").distinct().withColumn("t_start", t[0]["s"]).withColumn("t_end", F.element_at(t, -1)["e"])
    pairs = overlap_join(structure_key(reads), m, ["chrom"], rs="t_start", re="t_end")
    bp = B.overlap_length(F.col("exons"), t)
    enough = (F.size("exons") > 1) | (bp / B.length(F.col("exons")) >= min_cov) | (bp / B.length(t) >= min_cov)
    agree = pairs.filter(enough).groupBy("chrom", "strand", "exons").agg(F.min("t_strand").alias("_lo"), F.max("t_strand").alias("_hi"))
    by_model = F.when(F.col("_lo") == F.col("_hi"), F.col("_lo"))
    by_site = F.when(F.col("score") > margin, "+").when(-F.col("score") > margin, "-")
    out = reads.join(score, "iso", "left").join(agree, ["chrom", "strand", "exons"], "left")
    new = F.when(F.size("exons") > 1, F.coalesce(by_site, by_model)).otherwise(by_model)
    return (out.withColumn("new_strand", F.coalesce(new, F.col("strand")))
               .withColumn("confirmed", F.col("new_strand") == F.col("strand")).drop("score", "_lo", "_hi"))


def correct_junctions(isoforms: DataFrame, junctions: DataFrame, motifs: DataFrame, max_change: float = 0.05) -> DataFrame:
    """Replace unsupported isoform junctions by the short-read junctions they overlap.

    A junction is replaced when it is not a short-read junction, overlaps no other isoform junction and at least one
    short-read junction. All replacements of an isoform are made at once. `outcome`: kept (no edit), corrected,
    dropped (an exon would have no length), restored (exon length changes too much, or a new motif is not canonical).
    motifs: chrom, strand, js, je, motif of the short-read junctions.
    """
    key = ["chrom", "strand", "a", "b"]
    iso_j = intron_rows(isoforms).select(*key).distinct()
    sr = junctions.select("chrom", "strand", F.col("js").alias("a"), F.col("je").alias("b")).distinct()
    other = iso_j.select("chrom", "strand", F.col("a").alias("oa"), F.col("b").alias("ob"))
    alone = overlap_join(iso_j, other, ["chrom", "strand"], "a", "b", "oa", "ob").groupBy(*key).agg(
        F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == 1).select(*key)
    todo = iso_j.join(sr, key, "left_anti").join(alone, key, "left_semi")
    new = sr.join(motifs.select("chrom", "strand", F.col("js").alias("a"), F.col("je").alias("b"), "motif"), key, "left").select(
        "chrom", "strand", F.col("a").alias("na"), F.col("b").alias("nb"), F.coalesce(F.col("motif").isin(CANONICAL), F.lit(False)).alias("ok"))
    swap = overlap_join(todo, new, ["chrom", "strand"], "a", "b", "na", "nb").groupBy(*key).agg(
        F.array_sort(F.collect_list(F.struct(F.col("na").alias("s"), F.col("nb").alias("e")))).alias("to"), F.min("ok").alias("ok"))
    rows = intron_rows(isoforms).join(swap, key, "left")
    own = F.array(B.block(F.col("a"), F.col("b")))
    edits = rows.groupBy("iso").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("a", F.coalesce("to", own).alias("to")))), lambda x: x["to"])).alias("gaps"),
        F.count("to").alias("edits"), F.min(F.coalesce("ok", F.lit(True))).alias("canonical"))
    x = F.col("exons")
    new_exons = B.from_introns(x[0]["s"], F.element_at(x, -1)["e"], F.col("gaps"))
    out = isoforms.join(edits, "iso", "left").withColumn("edits", F.coalesce("edits", F.lit(0))).withColumn(
        "new_exons", F.when(F.col("edits") > 0, new_exons).otherwise(x))
    before, after = B.length(x), B.length(F.col("new_exons"))
    far = (before * (1 - max_change) > after) | (before * (1 + max_change) < after)
    outcome = (F.when(F.col("edits") == 0, "kept").when(~B.valid(F.col("new_exons")), "dropped")
               .when(far | ~F.col("canonical"), "restored").otherwise("corrected"))
    return (out.withColumn("outcome", outcome)
               .withColumn("new_exons", F.when(F.col("outcome") == "corrected", F.col("new_exons")).otherwise(x)).drop("gaps", "canonical"))


def consensus_junctions(support: DataFrame, gap: int = 15) -> DataFrame:
    """Target junction of each cluster member: unique best short-read support, else unique best long-read support, else the
    single annotated one.

    support: chrom, strand, a, b, l_score, j_score, r_score. Members with short-read or annotation support stay.
    """
    key = ["chrom", "strand", "start_cluster", "end_cluster"]
    support = written(support, "support")  # the clusters read it several times
    c = written(two_way_clusters(support, ["chrom", "strand"], "a", "b", gap), "clusters")
    top = c.groupBy(*key).agg(F.max("j_score").alias("_j"), F.max("l_score").alias("_l"), F.count("r_score").alias("_r"))
    me = F.struct(F.col("a").alias("a"), F.col("b").alias("b"))
    m = c.join(top, key)
    best = m.groupBy(*key).agg(
        F.sum((F.col("j_score") == F.col("_j")).cast("int")).alias("nj"), F.min(F.when(F.col("j_score") == F.col("_j"), me)).alias("bj"),
        F.sum((F.col("l_score") == F.col("_l")).cast("int")).alias("nl"), F.min(F.when(F.col("l_score") == F.col("_l"), me)).alias("bl"),
        F.count("r_score").alias("nr"), F.min(F.when(F.col("r_score").isNotNull(), me)).alias("br"))
    to = (F.when(F.col("nj") == 1, F.col("bj")).when(F.col("nl") == 1, F.col("bl"))
          .when((F.col("nl") > 1) & (F.col("nr") == 1), F.col("br")))
    moved = (c.join(best.withColumn("to", to), key).filter(F.col("to").isNotNull() & F.col("j_score").isNull() & F.col("r_score").isNull())
              .select("chrom", "strand", "a", "b", F.col("to.a").alias("to_a"), F.col("to.b").alias("to_b")))
    return moved.filter((F.col("a") != F.col("to_a")) | (F.col("b") != F.col("to_b")))


def move_junctions(reads: DataFrame, moves: DataFrame) -> DataFrame:
    """Apply junction moves to reads unless an exon breaks; an end pushed past its exon takes the next edge.

    Returns the reads with `exons` rebuilt; a read left without exons in between is dropped.
    """
    rows = intron_rows(reads).join(moves, ["chrom", "strand", "a", "b"], "left")
    gaps = rows.groupBy("iso").agg(F.array_sort(F.collect_list(F.struct(
        "a", "b", F.coalesce("to_a", "a").alias("s"), F.coalesce("to_b", "b").alias("e")))).alias("g"))
    g = F.col("g")
    clash = lambda x, y: (x["s"] <= y["b"]) & (x["e"] > y["a"])
    neighbour = lambda x: F.exists(g, lambda y: ((y["a"] != x["a"]) | (y["b"] != x["b"])) & clash(x, y))
    safe = F.array_sort(F.transform(g, lambda x: F.when(neighbour(x), B.block(x["a"], x["b"])).otherwise(B.block(x["s"], x["e"]))))
    x = F.col("exons")
    lo, hi = x[0]["s"], F.element_at(x, -1)["e"]
    out = reads.join(gaps.select("iso", safe.alias("_g")), "iso", "left")
    head = F.col("_g")[0]["s"] <= lo
    tail = F.element_at("_g", -1)["e"] >= hi
    start = F.when(head, F.col("_g")[0]["e"]).otherwise(lo)
    end = F.when(tail, F.element_at("_g", -1)["s"]).otherwise(hi)
    inner = F.slice("_g", F.when(head, 2).otherwise(1),
                    F.greatest(F.size("_g") - head.cast("int") - tail.cast("int"), F.lit(0)))
    new = F.when(F.col("_g").isNull(), x).otherwise(B.from_introns(start, end, inner))
    return out.withColumn("exons", new).drop("_g").filter(B.valid(F.col("exons")))


def junction_features(isoforms: DataFrame, junctions: DataFrame, known: DataFrame, indels: DataFrame, total_reads: DataFrame) -> DataFrame:
    """Junction coverage features of multi-exon isoforms.

    junctions: chrom, js, je, cnt; known: chrom, a, b; indels: chrom, a, b, indel, n (an indel near a junction and its
    total count); total_reads: one row with `reads_total`. An indel is valid at half of the junction's coverage.
    """
    cov = junctions.groupBy("chrom", F.col("js").alias("a"), F.col("je").alias("b")).agg(F.sum("cnt").alias("cov"))
    lens = isoforms.filter(F.size("exons") > 1).select("iso", "chrom", B.length(F.col("exons")).alias("len"))
    rows = intron_rows(isoforms).select("iso", "chrom", "a", "b").join(cov, ["chrom", "a", "b"]).join(
        known.select("chrom", "a", "b").distinct().withColumn("_k", F.lit(True)), ["chrom", "a", "b"], "left").join(
        lens.select("iso", "len"), "iso").withColumn("_one", F.lit(1)).join(
        F.broadcast(total_reads.withColumn("_one", F.lit(1))), "_one")  # one row
    rows = written(rows.select("iso", "chrom", "a", "b", "cov", "_k", "len", "reads_total"), "cover")
    rpkm = F.col("cov") / (F.col("len") / 1000.0 * F.col("reads_total") / 1000000.0)
    novel = F.col("_k").isNull()
    per = rows.withColumn("rpkm", rpkm).groupBy("iso").agg(
        (F.min("cov") / F.sum("cov")).alias("min_to_all"), F.stddev_pop("cov").alias("sd_cov"), F.min("rpkm").alias("min_rpkm"),
        F.max(novel.cast("int")).alias("with_novel"), F.min(F.when(novel, F.col("rpkm"))).alias("min_novel_rpkm"))
    good = rows.select("iso", "chrom", "a", "b", "cov").join(indels, ["chrom", "a", "b"]).filter(F.col("n") / F.col("cov") >= 0.5)
    ind = good.groupBy("iso").agg(F.count_distinct("indel").alias("n_indels"), F.count_distinct("a", "b").alias("n_junc_indels"))
    zero = {c: 0 for c in ("min_to_all", "sd_cov", "min_rpkm", "with_novel", "min_novel_rpkm", "n_indels", "n_junc_indels")}
    return lens.select("iso").join(per, "iso", "left").join(ind, "iso", "left").fillna(zero)


def indels_near_junctions(alignments: DataFrame, reach: int = 10) -> DataFrame:
    """(chrom, a, b, indel, n): indels closer than `reach` to an edge of a junction of the same read, with the indel's total count.

    alignments: chrom, read, junctions array<struct<s,e>> (0-based), indels array<struct<kind,pos,end,n>> (1-based).
    """
    one = alignments.select("chrom", "junctions", F.explode("indels").alias("i")).select("chrom", "junctions", "i.kind", "i.pos", "i.end", "i.n")
    p, e, key = F.col("pos"), F.col("end"), ["chrom", "kind", "pos", "n"]
    near = lambda j: F.least(*[F.abs(u - v) for u in (p, e) for v in (j["s"] + 1, j["e"])]) < reach
    # a row for each junction in reach, or one without; the first of an indel's rows counts it, so one scan gives both the pairs and the totals
    rows = one.select(*key, F.posexplode_outer(F.filter("junctions", near)).alias("k", "j")).groupBy(*key, F.col("j.s").alias("a"), F.col("j.e").alias("b")).agg(
        F.sum((F.coalesce("k", F.lit(0)) == 0).cast("long")).alias("first"))
    rows = written(rows, "indels")
    total = rows.groupBy(*key).agg(F.sum("first").alias("total"))
    return rows.filter("a IS NOT NULL").join(total, key).select("chrom", "a", "b", F.concat_ws(":", "kind", "pos", "n").alias("indel"), F.col("total").alias("n"))


def canonical_ratio(motifs: DataFrame) -> DataFrame:
    """(iso, canonical_ratio): share of canonical junctions; one whose motif is unknown is not canonical. motifs: iso, motif, a row for each intron."""
    return motifs.groupBy("iso").agg(F.avg(F.coalesce(F.col("motif").isin(CANONICAL), F.lit(False)).cast("double")).alias("canonical_ratio"))


def biting_isoforms(isoforms: DataFrame, known: DataFrame, exons: DataFrame) -> DataFrame:
    """Isoforms with a novel junction overlapping an annotated exon on the strand. known: chrom, a, b; exons: chrom, strand, s, e."""
    novel = intron_rows(isoforms).join(known.select("chrom", "a", "b").distinct(), ["chrom", "a", "b"], "left_anti")
    hit = overlap_join(novel.select("chrom", "strand", "a", "b").distinct(), exons.select("chrom", "strand", "s", "e").distinct(),
                       ["chrom", "strand"], "a", "b", "s", "e").select("chrom", "strand", "a", "b").distinct()
    return novel.join(hit, ["chrom", "strand", "a", "b"], "left_semi").select("iso").distinct()


def region_depth(isoforms: DataFrame, gene_spans: DataFrame) -> DataFrame:
    """Depth steps inside gene regions from block boundary deltas: gene, pos, depth (until the next step).

    gene_spans: gene, chrom, g_start, g_end. Deltas are summed per position before the running sum.
    """
    from spliceloom.operators.sweeps import running
    ex = exon_rows(isoforms).select("chrom", "s", "e")
    copies = ex.groupBy("chrom", "s", "e").agg(F.count(F.lit(1)).alias("n"))
    cut = overlap_join(copies, gene_spans, ["chrom"], "s", "e", "g_start", "g_end").select(
        "gene", F.greatest("s", "g_start").alias("s"), F.least("e", "g_end").alias("e"), "n")
    deltas = cut.select("gene", F.explode(F.array(F.struct(F.col("s").alias("pos"), F.col("n").alias("d")),
                                                  F.struct(F.col("e").alias("pos"), (-F.col("n")).alias("d")))).alias("x")).select("gene", "x.*")
    steps = deltas.groupBy("gene", "pos").agg(F.sum("d").alias("d")).filter(F.col("d") != 0)
    return running(steps, ["gene"], "pos", depth=("sum", "d")).select("gene", "pos", "depth")


def no_overlap(left: DataFrame, right: DataFrame, strand: bool, **cols) -> DataFrame:
    return overlap_anti(left, right, ["chrom", "strand"] if strand else ["chrom"], **cols)
