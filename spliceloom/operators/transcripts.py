"""Transcript tables: exon and intron rows, features, collapse and summary aggregates.

Standard columns: chrom, strand, gene, iso, start, end, exons, reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spliceloom.functions import blocks as B
from spliceloom.functions.sequence import let
from spliceloom.operators.sweeps import two_way_clusters, with_point_island
from spliceloom.session import durable

ID = ["chrom", "strand", "gene", "iso"]


def exon_rows(isoforms: DataFrame, keep: list[str] = (), exons: str = "exons") -> DataFrame:
    """One row per exon with the neighbouring edges: s, e, prev_e, next_s, k (0-based)."""
    rich = let(F.col(exons), lambda ex: F.transform(ex, lambda x, i: F.struct(
        x["s"].alias("s"), x["e"].alias("e"), F.when(i > 0, F.get(ex, i - 1)["e"]).alias("prev_e"),
        F.get(ex, i + 1)["s"].alias("next_s"), i.alias("k"))))
    cols = [c for c in ID if c in isoforms.columns]
    return isoforms.select(*cols, *keep, F.explode(rich).alias("_x")).select(*cols, *keep, "_x.*")


def intron_rows(isoforms: DataFrame, keep: list[str] = ()) -> DataFrame:
    """One row per intron: a, b, k (0-based)."""
    cols = [c for c in ID if c in isoforms.columns]
    gaps = let(F.col("exons"), B.introns)
    return (isoforms.select(*cols, *keep, F.posexplode(gaps).alias("k", "_x"))
                    .select(*cols, *keep, "k", F.col("_x.s").alias("a"), F.col("_x.e").alias("b")))


def feature_index(k: Column, n: Column, strand: Column) -> Column:
    """1-based index in transcription order."""
    return F.when(strand == "+", k + 1).otherwise(n - k)


def features(models: DataFrame, kind: str, prime: int | None = None, complete_only: bool = False) -> DataFrame:
    """Feature rows of gene models (trans, chrom, strand, start, end, cds_start, cds_end, exons): tss, tts, intron, exon, cds or utr.

    `index` counts in transcription order. UTR rows carry a `side` (L or R).
    """
    plus = F.col("strand") == "+"
    if kind in ("tss", "tts"):
        left = plus if kind == "tss" else ~plus
        s = F.when(left, F.col("start")).otherwise(F.col("end") - 1)
        return models.select("chrom", s.alias("start"), (s + 1).alias("end"), "trans", "strand")
    cs, ce, x = F.col("cds_start"), F.col("cds_end"), F.col("exons")
    if kind == "utr":
        rows = models
        if complete_only:
            rows = rows.filter((F.col("cds_start_stat") == "cmpl") & (F.col("cds_end_stat") == "cmpl"))
        sides = [("L", B.left_utr(x, cs), F.col("cds_start") != F.col("start"), 5),
                 ("R", B.right_utr(x, ce), F.col("cds_end") != F.col("end"), 3)]
        both = []  # a null where the side is not asked for
        for side, parts, there, plus_prime in sides:
            if prime is not None:
                there = there & (plus if prime == plus_prime else ~plus)
            both.append(F.when(there, F.struct(F.lit(side).alias("side"), parts.alias("parts"))))
        one = rows.select("chrom", "trans", "strand", F.explode(F.filter(F.array(*both), lambda u: u.isNotNull())).alias("_u"))
        return _feature_rows(one.select("*", F.col("_u.side").alias("side")), F.col("_u.parts"), ["side"])
    parts = {"exon": x, "intron": B.introns(x), "cds": B.clip(x, cs, ce)}[kind]
    return _feature_rows(models, parts)


def _feature_rows(models: DataFrame, parts: Column, keep: list[str] = ()) -> DataFrame:
    return (models.select("chrom", "trans", "strand", *keep, let(parts, lambda p: p).alias("_p"))
            .select("chrom", "trans", "strand", *keep, F.size("_p").alias("_n"), F.posexplode("_p").alias("_k", "_x"))
            .select("chrom", F.col("_x.s").alias("start"), F.col("_x.e").alias("end"), "trans", "strand",
                    feature_index(F.col("_k"), F.col("_n"), F.col("strand")).cast("long").alias("index"), *keep))


def feature_chains(models: DataFrame, kind: str) -> DataFrame:
    """One row per transcript whose blocks are its exons, introns or CDS parts."""
    x = F.col("exons")
    parts = {"exon": x, "intron": B.introns(x), "cds": B.clip(x, F.col("cds_start"), F.col("cds_end"))}[kind]
    out = models.select("chrom", "trans", "strand", parts.alias("blocks")).filter(F.size("blocks") > 0)
    return out.withColumn("start", F.col("blocks")[0]["s"]).withColumn("end", F.element_at("blocks", -1)["e"])


def flanks(models: DataFrame, lengths: DataFrame, bases: int, upstream: bool) -> DataFrame:
    """Up- or downstream flank clamped to the chromosome."""
    left = (F.col("strand") == "+") if upstream else (F.col("strand") != "+")
    s = F.when(left, F.col("start") - bases).otherwise(F.col("end"))
    return (models.join(lengths, "chrom")
            .select("chrom", F.greatest(s, F.lit(0)).alias("f_start"), F.least(s + bases, F.col("length")).alias("f_end"),
                    "trans", "strand"))


def three_prime_sites(reads: DataFrame) -> DataFrame:
    """Distinct 1-bp 3' ends by strand."""
    pos = F.when(F.col("strand") == "+", F.col("end")).otherwise(F.col("start") + 1)
    return reads.select("chrom", (pos - 1).alias("start"), pos.alias("end"), "strand").distinct()


def revise_ends(reads: DataFrame, peaks: DataFrame) -> DataFrame:
    """Move the 3' edge of a read to its cluster peak when the peak stays in the outer block. peaks: iso, peak."""
    x, p = F.col("exons"), F.col("peak")
    n = F.size(x)
    plus = F.transform(x, lambda b, i: B.block(b["s"], F.when((i == n - 1) & (p > b["s"]), p).otherwise(b["e"])))
    minus = F.transform(x, lambda b, i: B.block(F.when((i == 0) & (p <= b["e"]), p - 1).otherwise(b["s"]), b["e"]))
    out = reads.join(peaks, "iso", "left")
    return (out.withColumn("exons", F.when(p.isNull(), x).when(F.col("strand") == "+", plus).otherwise(minus)).drop("peak")
               .withColumn("start", F.col("exons")[0]["s"]).withColumn("end", F.element_at("exons", -1)["e"]))


def compare_exons(pairs: DataFrame) -> DataFrame:
    """Exons of `new_exons` against `old_exons` of the same gene: kind new, first, last, inner, or extension 5'/3'.

    A new exon overlaps or touches no old one. A refined exon overlaps exactly
    one old exon position with another edge: its free side may differ at the
    outer exons, and it must not reach the neighbouring old exons.
    """
    o, n = F.col("old_exons"), F.col("new_exons")
    lo, ln = F.size(o), F.size(n)
    apart = F.filter(n, lambda x: ~F.exists(o, lambda y: (x["s"] <= y["e"]) & (y["s"] <= x["e"])))
    def tagged(kind: str, arr: Column) -> Column:
        return F.transform(arr, lambda x: F.struct(F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e")))
    first = F.when(lo > 1, F.filter(n, lambda x: (x["s"] < o[0]["e"]) & (o[0]["s"] < x["e"])
                                    & (x["e"] < F.get(o, F.lit(1))["s"]) & (x["e"] != o[0]["e"])))
    lst, pre = F.element_at(o, -1), F.get(o, lo - 2)
    is_last = lambda x: ((pre["e"] < x["s"]) & (x["s"] < lst["e"]) & (x["s"] != lst["s"]) & (x["e"] > lst["s"]))
    last = F.when(lo > 1, F.filter(n, is_last))
    def inner_hit(x: Column, i: Column) -> Column:
        return F.exists(F.sequence(F.lit(1), lo - 2), lambda k: (
            (F.get(o, k - 1)["e"] < x["s"]) & (x["s"] < F.get(o, k)["e"]) & (F.get(o, k)["s"] < x["e"])
            & (x["e"] < F.get(o, k + 1)["s"]) & ~((F.get(o, k)["s"] == x["s"]) & (F.get(o, k)["e"] == x["e"]))
            & ~((i == 0) & (x["s"] > F.get(o, k)["s"])) & ~((i == ln - 1) & (x["e"] < F.get(o, k)["e"]))))
    inner = F.when(lo > 2, F.filter(n, inner_hit))
    nothing = F.array().cast("array<struct<kind:string,s:bigint,e:bigint>>")
    plus = F.col("strand") == "+"
    nl = F.element_at(n, -1)
    left = F.when((n[0]["s"] < o[0]["s"]) & (o[0]["s"] < n[0]["e"]), F.array(F.struct(
        F.when(plus, "extension5").otherwise("extension3").alias("kind"), n[0]["s"].alias("s"), o[0]["s"].alias("e"))))
    right = F.when((nl["e"] > lst["e"]) & (lst["e"] > nl["s"]), F.array(F.struct(
        F.when(plus, "extension3").otherwise("extension5").alias("kind"), lst["e"].alias("s"), nl["e"].alias("e"))))
    parts = F.concat(tagged("new", apart), *[F.coalesce(p, nothing) for p in (
        tagged("first", first), tagged("last", last), tagged("inner", inner), left, right)])
    keep = [c for c in pairs.columns if c not in ("old_exons", "new_exons")]
    return pairs.select(*keep, F.explode(parts).alias("_x")).select(*keep, "_x.*")


def distinct_exons(isoforms: DataFrame, strand: bool = True) -> DataFrame:
    keys = ["chrom", "strand"] if strand else ["chrom"]
    return exon_rows(isoforms).select(*keys, "s", "e").distinct()


def distinct_junctions(isoforms: DataFrame, strand: bool = True) -> DataFrame:
    """Distinct introns with the smallest isoform as representative and the number of isoforms."""
    keys = ["chrom", "strand", "a", "b"] if strand else ["chrom", "a", "b"]
    return intron_rows(isoforms).groupBy(*keys).agg(F.min("iso").alias("first_iso"), F.count(F.lit(1)).alias("n_iso"))


def junction_isoforms(isoforms: DataFrame) -> DataFrame:
    """Long junction-to-isoform table, distinct."""
    return intron_rows(isoforms).select("chrom", "strand", "a", "b", "iso").distinct()


def chain_groups(isoforms: DataFrame) -> DataFrame:
    """Distinct intron chains per chromosome with the first isoform."""
    multi = isoforms.filter(F.size("exons") > 1).withColumn("chain", B.chain(B.introns(F.col("exons"))))
    return multi.groupBy("chrom", "chain").agg(F.min("iso").alias("first_iso"), F.count(F.lit(1)).alias("n_iso"))


def gene_bounds(isoforms: DataFrame) -> DataFrame:
    return isoforms.groupBy("gene", "chrom", "strand").agg(
        F.min("start").alias("gene_start"), F.max("end").alias("gene_end"), F.count(F.lit(1)).alias("n_iso"))


def gene_lengths(isoforms: DataFrame) -> DataFrame:
    """Distinct exon and intron bases over all genes (each distinct block of a gene counts once)."""
    ex = exon_rows(isoforms).select(F.lit("exon").alias("kind"), "gene", F.col("s"), F.col("e"))
    it = intron_rows(isoforms).select(F.lit("intron").alias("kind"), "gene", F.col("a").alias("s"), F.col("b").alias("e"))
    return ex.unionByName(it).distinct().groupBy("kind").agg(F.sum(F.col("e") - F.col("s")).alias("bases"))


def collapse_chains(isoforms: DataFrame, known: DataFrame) -> DataFrame:
    """One row per intron chain: longest isoform, support, gene support, ratio and annotation.

    known: distinct (chrom, chain) of the annotation. Gene support counts the
    reads of all isoforms of the representative's gene.
    """
    totals = isoforms.groupBy("gene").agg(F.sum("reads").alias("gene_support"))
    multi = isoforms.filter(F.size("exons") > 1).select(
        "chrom", "gene", "iso", "reads", B.chain(B.introns(F.col("exons"))).alias("chain"), B.length(F.col("exons")).alias("len"))
    best = multi.groupBy("chrom", "chain").agg(
        F.min(F.struct((-F.col("len")).alias("neg"), F.col("iso").alias("iso"), F.col("gene").alias("gene"))).alias("_r"),
        F.sum("reads").alias("iso_support"), F.count(F.lit(1)).alias("n_members"))
    rows = best.select("chrom", "chain", F.col("_r.iso").alias("iso"), F.col("_r.gene").alias("gene"), "iso_support", "n_members")
    return (rows.join(totals, "gene").join(known.select("chrom", "chain").distinct().withColumn("_k", F.lit(True)),
                                           ["chrom", "chain"], "left")
            .withColumn("ratio", F.col("iso_support") / F.col("gene_support"))
            .withColumn("annotation", F.when(F.col("_k"), "annotated").otherwise("novel")).drop("_k"))


def merge_samples(isoforms: DataFrame) -> DataFrame:
    """Merge isoforms of several samples by chain; the widest span represents, `name` joins the samples' isoforms.

    Input carries `sample`. The joined name is made per (chain, sample) first,
    so a chain's name has one part per sample.
    """
    multi = isoforms.filter(F.size("exons") > 1).select(
        "chrom", "sample", "iso", "start", "end", B.chain(B.introns(F.col("exons"))).alias("chain"))
    per = multi.groupBy("chrom", "chain", "sample").agg(
        F.min("iso").alias("first_iso"), F.count(F.lit(1)).alias("n"),
        F.max(F.struct((F.col("end") - F.col("start")).alias("span"), (-F.col("start")).alias("neg_start"))).alias("w"))
    name = F.array_join(F.transform(F.array_sort(F.collect_list(F.concat_ws("_", "sample", "first_iso"))), lambda x: x), "+")
    return per.groupBy("chrom", "chain").agg(name.alias("name"), F.sum("n").alias("n_members"), F.max("w").alias("_w")).select(
        "chrom", "chain", "name", "n_members", (-F.col("_w.neg_start")).alias("start"),
        (F.col("_w.span") - F.col("_w.neg_start")).alias("end"))


def snap_junctions(introns: DataFrame, gap: int) -> DataFrame:
    """Distinct introns with the most used start and end of their fuzzy cluster (start gaps, then end gaps)."""
    used = durable(introns.groupBy("chrom", "strand", "a", "b").agg(F.count(F.lit(1)).alias("n")))
    keys = ["chrom", "strand", "start_cluster", "end_cluster"]
    rows = durable(two_way_clusters(used, ["chrom", "strand"], "a", "b", gap))
    top = rows.groupBy(*keys).agg(F.max(F.struct("n", (-F.col("a")).alias("na"), (-F.col("b")).alias("nb"))).alias("_t"))
    return rows.join(top, keys).select("chrom", "strand", "a", "b", (-F.col("_t.na")).alias("to_a"), (-F.col("_t.nb")).alias("to_b"))


def collapse_alignments(reads: DataFrame, fuzzy: int = 5, five_gap: int = 1000, three_gap: int = 100, min_reads: int = 2,
                        min_coverage: float = 0.99, min_identity: float = 0.95) -> DataFrame:
    """Isoforms from alignments: thresholds, fuzzy junctions, same chain, 3' then 5' ends within a gap, minimum reads.

    reads: chrom, strand, iso (read name), exons, coverage, identity (percent).
    Ends are clustered by gaps between distinct positions.
    """
    good = reads.filter((F.col("coverage") >= min_coverage * 100) & (F.col("identity") >= min_identity * 100))
    it = intron_rows(good)
    snapped = it.join(snap_junctions(it, fuzzy), ["chrom", "strand", "a", "b"])
    gaps = F.array_sort(F.collect_list(F.struct("to_a", "to_b")))
    chains = snapped.groupBy("chrom", "strand", "iso").agg(
        F.array_join(F.transform(gaps, lambda g: F.concat_ws("-", g["to_a"], g["to_b"])), ";").alias("chain"))
    x, plus = F.col("exons"), F.col("strand") == "+"
    ends = good.join(chains, ["chrom", "strand", "iso"], "left").withColumn("chain", F.coalesce("chain", F.lit(""))).select(
        "chrom", "strand", "iso", "chain", x[0]["s"].alias("start"), F.element_at(x, -1)["e"].alias("end")).withColumn(
        "_three", F.when(plus, F.col("end")).otherwise(F.col("start"))).withColumn(
        "_five", F.when(plus, F.col("start")).otherwise(F.col("end")))
    keys = ["chrom", "strand", "chain"]
    rows = durable(with_point_island(durable(ends), keys, "_three", three_gap, "three_cluster"))
    rows = with_point_island(rows, [*keys, "three_cluster"], "_five", five_gap, "five_cluster")
    return rows.groupBy(*keys, "three_cluster", "five_cluster").agg(
        F.count(F.lit(1)).alias("reads"), F.min("start").alias("start"), F.max("end").alias("end")).filter(F.col("reads") >= min_reads)


def tiles(lengths: DataFrame, size: int) -> DataFrame:
    """Fixed tiling of each chromosome."""
    return (lengths.withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(size).cast("long"))))
                   .withColumn("end", F.least(F.col("start") + size, F.col("length"))).drop("length"))


def n_tiles(lengths: DataFrame, parts: int) -> DataFrame:
    """Each chromosome in `parts` tiles of equal (rounded up) size."""
    return (lengths.withColumn("_z", F.ceil(F.col("length") / parts).cast("long"))
            .withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.col("_z"))))
            .withColumn("end", F.least(F.col("start") + F.col("_z"), F.col("length"))).drop("length", "_z"))


def longest_per(df: DataFrame, keys: list[str]) -> DataFrame:
    """Widest isoform per key, smallest name on ties."""
    best = F.min(F.struct((F.col("start") - F.col("end")).alias("neg"), F.col("iso").alias("iso")))
    return df.groupBy(*keys).agg(best.alias("_b")).select(*keys, F.col("_b.iso").alias("rep_iso"), (-F.col("_b.neg")).alias("span"))


def majority(df: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Most frequent label per key, smallest label on ties, counted before it is chosen."""
    counts = df.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(*keys).agg(F.min(F.struct((-F.col("n")).alias("neg"), F.col(label).alias(label))).alias("_m")).select(
        *keys, f"_m.{label}", (-F.col("_m.neg")).alias("n"))


def rank_in(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """First n rows per key of a small, already aggregated table (a top-k report)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
