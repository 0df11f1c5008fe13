"""Group tests: statistics by Spark aggregates, tail probabilities by vectorised UDFs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spliceloom.functions import blocks as B
from spliceloom.functions.stats import chi_square_sf, hypergeometric_tail, pooled_t, t_two_sided
from spliceloom.functions.sequence import let
from spliceloom.operators.sweeps import average_ranks, bh_adjusted


def two_sample(values: DataFrame, keys: list[str], side: str = "side", value: str = "value", first: str = "inc",
               second: str = "exc", min_n: int = 1) -> DataFrame:
    """Pooled t and tie-corrected Kruskal-Wallis H of two sides per key, with p values.

    Values are counted per (key, side, value) before ranking, and ranks come
    from sums over cells of the value axis, so a key of any size is spread.
    """
    cells = values.groupBy(*keys, side, value).agg(F.count(F.lit(1)).alias("_n"))
    mean = lambda s: F.avg(F.when(F.col(side) == s, F.col(value)))
    var = lambda s: F.var_samp(F.when(F.col(side) == s, F.col(value)))
    cnt = lambda s: F.sum((F.col(side) == s).cast("long"))
    moments = values.groupBy(*keys).agg(cnt(first).alias("n1"), cnt(second).alias("n2"), mean(first).alias("mean1"),
                                        mean(second).alias("mean2"), var(first).alias("_v1"), var(second).alias("_v2"))
    moments = moments.filter((F.col("n1") >= min_n) & (F.col("n2") >= min_n))
    ranks = average_ranks(values.select(*keys, value), keys, value)
    ties = ranks.groupBy(*keys).agg(F.sum(F.col("ties") * F.col("ties") * F.col("ties") - F.col("ties")).alias("_ties"))
    by_side = cells.join(ranks.select(*keys, value, "rank"), [*keys, value]).groupBy(*keys).agg(
        F.sum(F.when(F.col(side) == first, F.col("rank") * F.col("_n"))).alias("_r1"),
        F.sum(F.when(F.col(side) == second, F.col("rank") * F.col("_n"))).alias("_r2"))
    rows = moments.join(by_side, keys).join(ties, keys)
    n1, n2 = F.col("n1"), F.col("n2")
    n = n1 + n2
    h = (12 / (n * (n + 1)) * (F.col("_r1") * F.col("_r1") / n1 + F.col("_r2") * F.col("_r2") / n2) - 3 * (n + 1))
    fix = 1 - F.col("_ties") / (F.pow(n.cast("double"), 3) - n)
    rows = rows.withColumn("t", pooled_t(n1, F.col("mean1"), F.col("_v1"), n2, F.col("mean2"), F.col("_v2"))).withColumn(
        "h", F.when(fix > 0, h / fix))
    return (rows.withColumn("p_t", t_two_sided(F.col("t"), (n - 2).cast("double")))
                .withColumn("p_h", chi_square_sf(F.col("h"), F.lit(1.0))).drop("_v1", "_v2", "_r1", "_r2", "_ties"))


def significant_pairs(tests: DataFrame, alpha: float = 0.001) -> DataFrame:
    return tests.filter((F.col("p_t") <= alpha) & (F.col("p_h") <= alpha))


def spanning_reads(members: DataFrame, reads: DataFrame) -> DataFrame:
    """IR inclusion reads must cover the whole intron. members: event_id, lo, hi, side, read; reads: read, exons."""
    rows = members.join(reads.select("read", "exons"), "read")
    whole = F.exists("exons", lambda x: (x["s"] <= F.col("lo")) & (F.col("hi") <= x["e"]))
    return rows.filter((F.col("side") != "inc") | whole).drop("exons")


def site_pairs(values: DataFrame, min_n: int = 10, ratio: float = 50.0, alpha: float = 0.001) -> DataFrame:
    """Tail length between the sites of a gene: tests of all site pairs that pass size, ratio and t.

    values: gene, site, value. Pairs are formed from per-site summaries; only
    pairs with p_t <= alpha bring their counted values to the rank test.
    """
    per = values.groupBy("gene", "site").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("m"), F.var_samp("value").alias("v"))
    per = per.filter(F.col("n") >= min_n)
    side = lambda p: per.select("gene", *[F.col(c).alias(f"{p}_{c}") for c in ("site", "n", "m", "v")])
    pairs = side("a").join(side("b"), "gene").filter(
        (F.col("a_site") < F.col("b_site")) & (F.col("a_n") / F.col("b_n") < ratio) & (F.col("b_n") / F.col("a_n") < ratio))
    t = pooled_t(F.col("a_n"), F.col("a_m"), F.col("a_v"), F.col("b_n"), F.col("b_m"), F.col("b_v"))
    pairs = pairs.withColumn("t", t).withColumn("p_t", t_two_sided(F.col("t"), (F.col("a_n") + F.col("b_n") - 2).cast("double")))
    hits = pairs.filter(F.col("p_t") <= alpha).select("gene", "a_site", "b_site", "t", "p_t")
    ids = hits.select("gene", "a_site", "b_site")
    sides = ids.select("*", F.col("a_site").alias("site"), F.lit("inc").alias("side")).unionByName(
        ids.select("*", F.col("b_site").alias("site"), F.lit("exc").alias("side")))
    kw = two_sample(sides.join(values, ["gene", "site"]), ["gene", "a_site", "b_site"])
    return hits.join(kw.select("gene", "a_site", "b_site", "n1", "n2", "h", "p_h"), ["gene", "a_site", "b_site"])


def valid_sites(pairs: DataFrame, alpha: float = 0.001) -> DataFrame:
    """Sites in at least one significant pair, for genes with two or more."""
    ok = significant_pairs(pairs, alpha)
    sites = ok.select("gene", F.explode(F.array("a_site", "b_site")).alias("site")).distinct()
    many = sites.groupBy("gene").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= 2)
    return sites.join(many.select("gene"), "gene", "left_semi")


def chi_square_table(cells: DataFrame, keys: list[str], row: str, yates: bool = True) -> DataFrame:
    """Chi-square of key x row x (inc, exc) counts; rows without counts drop out.

    Adds chi2, dof, n_rows and the continuity correction for one degree of freedom when asked.
    """
    per = cells.groupBy(*keys, row).agg(F.sum("inc").alias("inc"), F.sum("exc").alias("exc")).filter(F.col("inc") + F.col("exc") > 0)
    total = per.groupBy(*keys).agg(F.sum("inc").alias("_i"), F.sum("exc").alias("_e"), F.count(F.lit(1)).alias("n_rows"))
    r = per.join(total, keys).filter((F.col("_i") > 0) & (F.col("_e") > 0))
    line, n = F.col("inc") + F.col("exc"), F.col("_i") + F.col("_e")
    def part(o: Column, c: Column) -> Column:
        e = line * c / n
        d = F.abs(o - e)
        d = F.when(F.lit(yates) & (F.col("n_rows") == 2), d - F.least(d, F.lit(0.5))).otherwise(d)
        return d * d / e
    return r.groupBy(*keys, "n_rows").agg(
        F.sum(part(F.col("inc"), F.col("_i")) + part(F.col("exc"), F.col("_e"))).alias("chi2")).withColumn(
        "dof", F.col("n_rows") - 1)


def allele_association(cells: DataFrame, keys: list[str], haplo: str = "haplo", alpha: float = 0.001, yates: bool = True,
                       high: int = 5, low: int = 3) -> DataFrame:
    """Events whose haplotypes split between inclusion and exclusion.

    cells: keys, haplo, inc, exc. Each column needs a maximum >= high and a minimum <= low, more than one haplotype with
    counts, p <= alpha and different top haplotypes. Use alpha=None to keep the statistic of all rows that pass the counts.
    """
    per = cells.groupBy(*keys, haplo).agg(F.sum("inc").alias("inc"), F.sum("exc").alias("exc"))
    top = lambda c: F.min(F.struct((-F.col(c)).alias("neg"), F.col(haplo).alias("h")))["h"]
    shape = per.groupBy(*keys).agg(
        F.max("inc").alias("_mi"), F.min("inc").alias("_li"), F.max("exc").alias("_me"), F.min("exc").alias("_le"),
        F.sum((F.col("inc") + F.col("exc") > 0).cast("int")).alias("_used"), top("inc").alias("inc_haplo"), top("exc").alias("exc_haplo"))
    ok = shape.filter((F.least("_mi", "_me") >= high) & (F.greatest("_li", "_le") <= low) & (F.col("_used") > 1))
    out = chi_square_table(per, keys, haplo, yates).join(ok.select(*keys, "inc_haplo", "exc_haplo"), keys)
    if alpha is None:
        return out
    out = out.withColumn("p", chi_square_sf(F.col("chi2"), F.col("dof").cast("double")))
    return out.filter((F.col("p") <= alpha) & (F.col("inc_haplo") != F.col("exc_haplo")))


def half_test(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """Chi-square of a two-count table against an even split of its total (two rows: observed, expected), corrected."""
    n = F.col(a) + F.col(b)
    half = n / 2
    def cell(o: Column, other: Column) -> Column:
        e = (o + other) / 2
        d = F.abs(o - e)
        d = d - F.least(d, F.lit(0.5))
        return F.when(e > 0, d * d / e).otherwise(0.0)
    chi = cell(F.col(a), half) + cell(half, F.col(a)) + cell(F.col(b), half) + cell(half, F.col(b))
    return df.withColumn(f"{out}_chi2", chi)


def allele_expression(df: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Genes where both long-read and short-read counts of REF and ALT differ from half and half."""
    both = half_test(half_test(df, "ref_long", "alt_long", "long"), "ref_short", "alt_short", "short")
    for k in ("long", "short"):
        both = both.withColumn(f"{k}_p", chi_square_sf(F.col(f"{k}_chi2"), F.lit(1.0)))
    return both.filter((F.col("long_p") <= alpha) & (F.col("short_p") <= alpha))


def term_counts(terms: DataFrame, genes: DataFrame, group: list[str] = ()) -> DataFrame:
    """Per (group, term): k hits of n listed genes, K of N annotated genes. terms: term, gene; genes: group, gene."""
    g = list(group)
    t = terms.select("term", "gene").distinct()
    universe = t.select("gene").distinct()
    listed = genes.select(*g, "gene").distinct().join(universe, "gene", "left_semi")
    size = t.groupBy("term").agg(F.count(F.lit(1)).alias("term_size"))
    total = universe.agg(F.count(F.lit(1)).alias("total")).withColumn("_one", F.lit(1))
    drawn = listed.groupBy(*g, F.lit(1).alias("_one")).agg(F.count(F.lit(1)).alias("drawn"))
    hits = listed.join(t, "gene").groupBy(*g, "term").agg(F.count(F.lit(1)).alias("hits")).withColumn("_one", F.lit(1))
    return hits.join(size, "term").join(drawn, [*g, "_one"]).join(F.broadcast(total), "_one").drop("_one")  # one row


def over_representation(counts: DataFrame, group: list[str] = (), min_size: int = 10, max_size: int = 100000, cutoff: float = 1.0,
                        by: str = "p_adj", q_cut: float = 1.0) -> DataFrame:
    """Hypergeometric tail, adjusted p and q per term; terms outside the size bounds are left out first."""
    g = list(group)
    sized = counts.filter((F.col("term_size") >= min_size) & (F.col("term_size") <= max_size))
    long = lambda c: F.col(c).cast("long")
    p = sized.withColumn("p", hypergeometric_tail(long("hits"), long("drawn"), long("term_size"), long("total")))
    adj = bh_adjusted(p, "p", g)
    # share of null terms from the upper part of the p axis
    key = [*g, "_one"]
    null = adj.groupBy(*g, F.lit(1).alias("_one")).agg(F.least(F.avg((F.col("p") >= 0.05).cast("double")) / 0.95, F.lit(1.0)).alias("_pi"))
    q = adj.withColumn("_one", F.lit(1)).join(null if g else F.broadcast(null), key).withColumn("q", F.col("p_adj") * F.col("_pi"))
    return q.filter((F.col(by) <= cutoff) & (F.col("q") <= q_cut)).drop("_one", "_pi")


def condition_pairs(counts: DataFrame) -> DataFrame:
    """Event counts of every pair of conditions: event_id, cond1, cond2, inc/exc of both. counts: event_id, condition, inc, exc."""
    side = lambda p: counts.select("event_id", F.col("condition").alias(f"cond{p}"), F.col("inc").alias(f"inc{p}"), F.col("exc").alias(f"exc{p}"))
    return side(1).join(side(2), "event_id").filter(F.col("cond1") < F.col("cond2"))


def differential_splicing(counts: DataFrame, yates: bool = True) -> DataFrame:
    """Inclusion difference and 2x2 chi-square per event and condition pair, p adjusted per pair of conditions."""
    per = counts.groupBy("event_id", "condition").agg(F.sum("inc").alias("inc"), F.sum("exc").alias("exc"))
    r = condition_pairs(per).withColumn("delta_psi", F.col("inc1") / (F.col("inc1") + F.col("exc1")) - F.col("inc2") / (F.col("inc2") + F.col("exc2")))
    a, b, c, d = (F.col(x).cast("double") for x in ("inc1", "exc1", "inc2", "exc2"))
    n = a + b + c + d
    gap = F.abs(a * d - b * c)
    gap = gap - F.least(gap, n / 2) if yates else gap
    margins = (a + b) * (c + d) * (a + c) * (b + d)
    r = r.withColumn("chi2", F.when(margins > 0, n * gap * gap / margins)).withColumn("p", chi_square_sf(F.col("chi2"), F.lit(1.0)))
    return bh_adjusted(r, "p", ["cond1", "cond2"], "fdr")


def significant(tests: DataFrame, alpha: float = 0.05, column: str = "fdr") -> DataFrame:
    return tests.filter(F.col(column) <= alpha)


def comparable(samples: DataFrame) -> DataFrame:
    """Pairs of conditions that may be compared: each with one layout and one read length, and the same in both.

    samples: condition, paired, read_length.
    """
    one = samples.groupBy("condition").agg(F.min("paired").alias("paired"), F.max("paired").alias("_p"),
                                           F.min("read_length").alias("read_length"), F.max("read_length").alias("_l"))
    even = one.filter((F.col("paired") == F.col("_p")) & (F.col("read_length") == F.col("_l")))
    side = lambda k: even.select("paired", "read_length", F.col("condition").alias(f"cond{k}"))
    return side(1).join(side(2), ["paired", "read_length"]).filter(F.col("cond1") < F.col("cond2"))


PAIR = [f"{side}_{c}" for side in ("inc", "exc") for c in ("chain", "n", "r")]


def chain_pairs(members: DataFrame, isoforms: DataFrame, min_reads: int = 0) -> DataFrame:
    """Inclusion x exclusion isoform groups of an event by intron chain: the key columns of the event (all but side and iso, gene among them), side chains and their isoform and read counts.

    Isoforms with at most one intron share the chain monoExon; isoforms below
    min_reads are left out; isoforms are reduced to chains before pairing. Members are dealt out by event once, for the reduction and the pairing.
    """
    keys = [c for c in members.columns if c not in ("side", "iso")]
    multi = F.size("exons") > 2
    chain = F.when(multi, let(F.col("exons"), lambda x: B.chain(B.introns(x)))).otherwise("monoExon")
    iso = isoforms.filter(F.col("reads") >= min_reads).select("gene", "iso", chain.alias("chain"), F.col("reads").alias("r"))
    per = members.join(iso, ["gene", "iso"]).drop("iso").repartition(*keys).groupBy(*keys, "side", "chain").agg(
        F.count(F.lit(1)).alias("n"), F.sum("r").alias("r"))
    side = lambda s: per.filter(F.col("side") == s).select(*keys, *[F.col(c).alias(f"{s}_{c}") for c in ("chain", "n", "r")])
    return side("inc").join(side("exc"), keys).select(*keys, *PAIR)


def one_pair(pairs: DataFrame) -> DataFrame:
    """A single pair per event: the last by chain text."""
    keys = [c for c in pairs.columns if c not in PAIR]
    return pairs.groupBy(*keys).agg(
        F.max_by(F.struct(*[c for c in PAIR if c in pairs.columns]), F.struct("inc_chain", "exc_chain")).alias("_p")).select(*keys, "_p.*")


def best_allele(haplotypes: DataFrame, alleles: DataFrame) -> DataFrame:
    """Closest allele text per haplotype and locus by edit-distance ratio; ties go to the smaller allele name.

    haplotypes: locus, haplo; alleles: locus, allele, text (REF and ALT, so two per locus).
    """
    pairs = haplotypes.join(alleles, "locus")
    ratio = 1 - F.levenshtein("haplo", "text") / F.greatest(F.length("haplo"), F.length("text"))
    best = F.min(F.struct((-ratio).alias("neg"), F.col("allele").alias("allele")))
    return pairs.groupBy("locus", "haplo").agg(best.alias("_b")).select("locus", "haplo", "_b.allele", (-F.col("_b.neg")).alias("ratio"))


def allele_table(ref: DataFrame, alt: DataFrame) -> DataFrame:
    """Full join of REF and ALT quantities per gene with zero for a missing side. Inputs: gene, n."""
    return ref.select("gene", F.col("n").alias("ref_n")).join(alt.select("gene", F.col("n").alias("alt_n")), "gene", "full").fillna(0, ["ref_n", "alt_n"])
