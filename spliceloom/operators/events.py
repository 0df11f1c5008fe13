"""Alternative splicing events inside genes.

Isoforms are first reduced to distinct exon variants (edges plus neighbouring
edges) with their isoform and read counts, so the joins grow with the distinct
structures of a gene, not with its isoforms. Joins run on (gene, tile): a large
gene is spread over its positions. Member lists stay long tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spliceloom.functions import blocks as B
from spliceloom.functions.sequence import let
from spliceloom.operators.overlap import overlap_join
from spliceloom.operators.transcripts import exon_rows
from spliceloom.session import compact, written

OFFSET = 5
TILE = 4096
GENE = ["gene", "chrom", "strand"]
SITE = [*GENE, "left"]
VARIANT = [*GENE, "s", "e", "prev_e", "next_s"]


def exon_variants(isoforms: DataFrame) -> DataFrame:
    """Distinct exons with neighbours: n_iso isoforms and w reads each.

    Every event type reads this small table several times, so it is cut from
    the isoform plan once instead of scanning the isoforms again per use.
    """
    return written(exon_rows(isoforms, ["reads"]).groupBy(*VARIANT).agg(
        F.count(F.lit(1)).alias("n_iso"), F.sum("reads").alias("w")), "variants")


class Shared:
    """Isoforms and what several event types read of them, each worked out and written once, when first asked for."""

    def __init__(self, isoforms: DataFrame, offset: int = OFFSET) -> None:
        self.isoforms, self.offset = written(isoforms, "isoforms"), offset

    @cached_property
    def variants(self) -> DataFrame:
        return exon_variants(self.isoforms)

    @cached_property
    def skips(self) -> DataFrame:
        """The rows of `_skips` with the text of the inner chain."""
        return written(_skips(self.isoforms, self.variants).withColumn("name", B.chain(F.col("inner"))), "skips")

    @cached_property
    def edges(self) -> DataFrame:
        """All A3SS and A5SS events as pairs of edges: both left and right edges are paired once for the two strands."""
        return written(_site_events(_both_axes(self.variants), self.offset), "edges")


def shared(isoforms: DataFrame | Shared, offset: int = OFFSET) -> Shared:
    return isoforms if isinstance(isoforms, Shared) else Shared(isoforms, offset)


def _span_tiles(s: Column, last: Column) -> Column:
    return F.explode(F.sequence(F.floor(s / TILE).cast("long"), F.floor(last / TILE).cast("long")))


def _psi(df: DataFrame) -> DataFrame:
    """PSI per mille from isoform counts and from read counts."""
    share = lambda i, e: F.col(i) / (F.col(i) + F.col(e)) * 1000
    return df.withColumn("psi", share("n_inc", "n_exc")).withColumn("psi_reads", share("w_inc", "w_exc"))


def within_models(events: DataFrame, models: DataFrame, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Events overlapping a transcript of their gene. models: gene, tx_start, tx_end."""
    spans = events.select("gene", F.col(lo).alias("_lo"), F.col(hi).alias("_hi")).distinct()
    hit = overlap_join(spans, models.select("gene", "tx_start", "tx_end").distinct(), ["gene"], "_lo", "_hi", "tx_start", "tx_end")
    keep = hit.select("gene", F.col("_lo").alias(lo), F.col("_hi").alias(hi)).distinct()
    return events.join(keep, ["gene", lo, hi], "left_semi")


def _retained_pairs(variants: DataFrame, offset: int) -> DataFrame:
    """Introns with the exons that run through them (gene, a, b, the intron's counts n_exc and w_exc, s, e and the exon's counts)."""
    introns = (variants.filter(F.col("next_s").isNotNull()).groupBy(*GENE, F.col("e").alias("a"), F.col("next_s").alias("b"))
               .agg(F.sum("n_iso").alias("n_exc"), F.sum("w").alias("w_exc")).withColumn("_t", F.floor(F.col("a") / TILE).cast("long")))
    exons = (variants.groupBy(*GENE, "s", "e").agg(F.sum("n_iso").alias("n_iso"), F.sum("w").alias("w"))
             .withColumn("_t", _span_tiles(F.col("s"), F.col("e"))))
    return introns.join(exons, [*GENE, "_t"]).filter(
        (F.col("s") < F.col("a") - offset) & (F.col("e") > F.col("b") + offset)).drop("_t")


def retained_introns(isoforms: DataFrame, offset: int = OFFSET, models: DataFrame | None = None,
                     variants: DataFrame | None = None) -> DataFrame:
    """IR: an intron of one isoform lies inside an exon of another, both edges further than `offset` apart."""
    variants = exon_variants(isoforms) if variants is None else variants
    ev = _retained_pairs(variants, offset).groupBy(*GENE, F.col("a").alias("lo"), F.col("b").alias("hi")).agg(
        F.sum("n_iso").alias("n_inc"), F.sum("w").alias("w_inc"), F.first("n_exc").alias("n_exc"), F.first("w_exc").alias("w_exc"))
    ev = _psi(ev.withColumn("event_id", F.concat(F.col("gene"), F.lit(":"), F.col("lo"), F.lit("-"), F.col("hi"))))
    return within_models(ev, models) if models is not None else ev


def structures(isoforms: DataFrame) -> DataFrame:
    """Distinct exon structures of each gene: sid (a hash of the exons), exons, n_iso, w, and ``sums``, the running hash sums before each exon and behind the last."""
    one = isoforms.groupBy(*GENE, F.xxhash64("exons").alias("sid")).agg(
        F.min("exons").alias("exons"), F.max("exons").alias("_x"), F.count(F.lit(1)).alias("n_iso"), F.sum("reads").alias("w"))
    return compact(_same(one, "exons").withColumn("sums", chain_sums(F.col("exons"))), "structures")


def _same(df: DataFrame, column: str) -> DataFrame:
    """Fail if rows that share a hash hold different values: ``_x`` is the largest, ``column`` the smallest."""
    return df.withColumn(column, F.when(F.col(column) == F.col("_x"), F.col(column)).otherwise(F.raise_error(F.lit("two exon chains share a hash")).cast(df.schema[column].dataType))).drop("_x")


def chain_sums(exons: Column) -> Column:
    """Running sums of exon hashes; the difference of two of them names the chain between, since coordinates order it. Terms of 52 bits leave room for 2,000 exons."""
    term = lambda x: F.shiftrightunsigned(F.xxhash64(x["s"], x["e"]), 12)
    return F.aggregate(exons, F.array(F.lit(0).cast("long")), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + term(x))))


def chain_between(rows: DataFrame, edge: str = "l", site: str = "r") -> tuple[DataFrame, DataFrame]:
    """(donors, acceptors) of structures: right exon edges with the sum behind the exon, and left edges with the sum before it; each with its exon number."""
    keys = [c for c in ("gene", "chrom", "strand") if c in rows.columns]
    at = rows.select(*keys, "sid", "sums", F.posexplode("exons").alias("k", "x"), F.size("exons").alias("_n"))
    donors = at.filter(F.col("k") < F.col("_n") - 2).select(*keys, "sid", "k", F.col("x.e").alias(edge), F.get("sums", F.col("k") + 1).alias("after"))
    acceptors = at.filter(F.col("k") > 0).select(*keys, "sid", F.col("k").alias("j"), F.col("x.s").alias(site), F.get("sums", "k").alias("before"))
    return donors, acceptors


def _skips(isoforms: DataFrame, variants: DataFrame | None = None) -> DataFrame:
    """(gene, l, r, n_inner, chain, inner, sid) rows: structures that keep the exons between l and r, which the exact intron (l, r) of others skips.

    Structures with an exon end at l meet the introns of their gene at l, and those that go on at r stay: two narrow joins on (gene, l) and
    (gene, sid, r). The chain between is a difference of two running hash sums; exon lists are fetched for the hits alone.
    """
    variants = exon_variants(isoforms) if variants is None else variants
    skips = variants.filter(F.col("next_s").isNotNull()).groupBy(
        *GENE, F.col("e").alias("l"), F.col("next_s").alias("r")).agg(F.sum("n_iso").alias("n_exc"), F.sum("w").alias("w_exc"))
    st = structures(isoforms)
    donors, acceptors = chain_between(st)
    hits = donors.join(skips, [*GENE, "l"]).join(acceptors, [*GENE, "sid", "r"]).filter("j > k + 1")
    hits = hits.withColumn("n_inner", F.col("j") - F.col("k") - 1).withColumn("chain", F.col("before") - F.col("after"))
    full = hits.join(st.select(*GENE, "sid", "exons", "n_iso", "w"), [*GENE, "sid"])
    return full.withColumn("inner", F.slice("exons", F.col("k") + 2, F.col("n_inner"))).drop("exons", "before", "after", "j", "k")


def skipped_exons(isoforms: DataFrame, models: DataFrame | None = None, variants: DataFrame | None = None, skips: DataFrame | None = None) -> DataFrame:
    """SE: a chain of inner exons kept by some isoforms and skipped by the exact intron of others."""
    ev = (_skips(isoforms, variants) if skips is None else skips).groupBy(*GENE, "l", "r", "n_inner", "chain").agg(
        F.min("inner").alias("inner"), F.max("inner").alias("_x"), F.sum("n_iso").alias("n_inc"), F.sum("w").alias("w_inc"), F.first("n_exc").alias("n_exc"), F.first("w_exc").alias("w_exc"))
    ev, x = _same(ev, "inner"), F.col("inner")
    ev = (ev.withColumn("chain", B.chain(x)).withColumn("lo", x[0]["s"]).withColumn("hi", F.element_at(x, -1)["e"]).drop("n_inner")
            .withColumn("event_id", F.concat(F.col("gene"), F.lit(":"), F.col("l"), F.lit("@"), "chain", F.lit("@"), F.col("r"))))
    ev = _psi(ev)
    return within_models(ev, models) if models is not None else ev


def _axis(rows: DataFrame, left: Column) -> DataFrame:
    """Exons by the edge in question: the left one where ``left``, else the right one on the mirrored axis, so that both follow one rule. Exons without a neighbour there are left out."""
    at = lambda one, two: F.when(F.col("left"), one).otherwise(two)
    s, e = F.col("s"), F.col("e")
    out = rows.withColumn("left", left)
    return out.withColumns({"edge": at(s, -e), "other": at(e, -s), "neigh": at(F.col("prev_e"), -F.col("next_s"))}).filter(F.col("neigh").isNotNull())


def _both_axes(rows: DataFrame) -> DataFrame:
    return _axis(rows, F.lit(True)).unionByName(_axis(rows, F.lit(False)))


def _site_events(axis: DataFrame, offset: int, extension: int = 0) -> DataFrame:
    """Distinct pairs of edges (a, b) of overlapping exons that differ.

    The including exon reaches further out, so the excluding edge b falls inside it; its edge a must stay clear of the other transcript's neighbouring
    exon. Given the two edges, each of the two conditions looks at one exon alone. So an event takes one exon at a that reaches beyond b, and one at b whose neighbour
    ends before a: the furthest and the nearest decide, and edges are paired, not exons.
    """
    at = axis.groupBy(*SITE, "edge").agg(F.max("other").alias("far"), F.min("neigh").alias("near"))
    inc = at.select(*SITE, F.col("edge").alias("a"), "far").withColumn("_t", _span_tiles(F.col("a"), F.col("far") + extension))
    exc = at.select(*SITE, F.col("edge").alias("b"), "near").withColumn("_t", F.floor(F.col("b") / TILE).cast("long"))
    return inc.join(exc, [*SITE, "_t"]).filter(
        (F.col("b") - F.col("a") > offset) & (F.col("b") < F.col("far") + extension) & (F.col("a") - F.col("near") > offset)).select(*SITE, "a", "b")


def _site_names(events: DataFrame) -> DataFrame:
    """lo and hi on the axis as it is, and the event type."""
    sign = F.when(F.col("left"), 1).otherwise(-1)
    a, b = F.col("a") * sign, F.col("b") * sign
    kind = F.when(F.col("left") == (F.col("strand") == "+"), "A3SS").otherwise("A5SS")
    return events.withColumns({"lo": F.least(a, b), "hi": F.greatest(a, b), "as_type": kind})


def _site_sides(events: DataFrame, axis: DataFrame, offset: int, extension: int = 0) -> DataFrame:
    """Events with the exons of the axis on both sides, told apart by side: events meet the exons once, by the edge of the side."""
    at = lambda side, edge: events.select("*", F.lit(side).alias("side"), F.col(edge).alias("edge"))
    hit = at("inc", "a").unionByName(at("exc", "b")).join(axis, [*SITE, "edge"])
    return hit.filter(F.when(F.col("side") == "inc", F.col("b") < F.col("other") + extension).otherwise(F.col("a") - F.col("neigh") > offset))


def _site_counts(events: DataFrame, axis: DataFrame, offset: int, extension: int = 0) -> DataFrame:
    """Counts and smallest junctions of both sides of each event."""
    rows = _site_sides(events, axis.select(*SITE, "edge", "other", "neigh", "n_iso", "w"), offset, extension)
    left, edge, neigh = F.col("left"), F.col("edge"), F.col("neigh")
    junction = F.struct(F.when(left, neigh).otherwise(-edge).alias("a"), F.when(left, edge).otherwise(-neigh).alias("b"))
    total = lambda c, s: F.sum(F.when(F.col("side") == s, F.col(c)))
    least = lambda s: F.min(F.when(F.col("side") == s, junction))
    return _site_names(rows.groupBy(*SITE, "a", "b").agg(
        total("n_iso", "inc").alias("n_inc"), total("n_iso", "exc").alias("n_exc"), total("w", "inc").alias("w_inc"), total("w", "exc").alias("w_exc"),
        least("inc").alias("inc_junc"), least("exc").alias("exc_junc"))).drop("a", "b", "left")


def _is_left(as_type: str) -> Column:
    """On which strand the event type compares left edges."""
    return F.col("strand") == ("+" if as_type == "A3SS" else "-")


def alternative_sites(isoforms: DataFrame, as_type: str, offset: int = OFFSET, extension: int = 0,
                      variants: DataFrame | None = None) -> DataFrame:
    """A3SS or A5SS: overlapping exons of two isoforms with different inner edges.

    Of several junction pairs of an event the smallest is reported.
    """
    axis = _axis(exon_variants(isoforms) if variants is None else variants, _is_left(as_type))
    ev = _site_counts(_site_events(axis, offset, extension), axis, offset, extension).drop("as_type")
    return _psi(ev.withColumn("event_id", _span_id()))


def _span_id() -> Column:
    return F.concat(F.col("gene"), F.lit(":"), F.col("lo"), F.lit("-"), F.col("hi"))


def event_members(isoforms: DataFrame, as_type: str, offset: int = OFFSET, variants: DataFrame | None = None) -> DataFrame:
    """Long table of the isoforms on both sides of each event: event_id, lo, hi, side, iso."""
    rows = exon_rows(isoforms, ["reads"])
    variants = exon_variants(isoforms) if variants is None else variants
    if as_type == "IR":
        pairs = _retained_pairs(variants, offset).select(*GENE, "a", "b", "s", "e")
        inc = pairs.join(rows.select(*GENE, "iso", "reads", "s", "e"), [*GENE, "s", "e"]).select(
            *GENE, F.col("a").alias("lo"), F.col("b").alias("hi"), F.lit("inc").alias("side"), "iso", "reads")
        hit = pairs.select(*GENE, "a", "b").distinct()
        gaps = rows.filter(F.col("next_s").isNotNull()).select(*GENE, "iso", "reads", F.col("e").alias("a"), F.col("next_s").alias("b"))
        exc = gaps.join(hit, [*GENE, "a", "b"]).select(
            *GENE, F.col("a").alias("lo"), F.col("b").alias("hi"), F.lit("exc").alias("side"), "iso", "reads")
        out = inc.unionByName(exc)
        name = F.concat(F.col("lo"), F.lit("-"), F.col("hi"))
    elif as_type == "SE":
        ev = compact(_skips(isoforms, variants).select(*GENE, "l", "r", "n_inner", "chain", "inner", "sid"), "skips")
        key = [*GENE, "l", "r", "inner"]
        own = isoforms.select(*GENE, "iso", "reads", F.xxhash64("exons").alias("sid"))
        inc = ev.join(own, [*GENE, "sid"]).select(*key, F.lit("inc").alias("side"), "iso", "reads")
        gaps = rows.filter(F.col("next_s").isNotNull()).select(*GENE, "iso", "reads", F.col("e").alias("l"), F.col("next_s").alias("r"))
        each = ev.groupBy(*GENE, "l", "r", "n_inner", "chain").agg(F.first("inner").alias("inner"))
        exc = each.join(gaps, [*GENE, "l", "r"]).select(*key, F.lit("exc").alias("side"), "iso", "reads")
        out = inc.unionByName(exc)
        name = F.concat(F.col("l"), F.lit("@"), B.chain(F.col("inner")), F.lit("@"), F.col("r"))
    else:
        left = _is_left(as_type)
        out = _site_members(_site_events(_axis(variants, left), offset), _axis(rows, left), offset).select(*GENE, "lo", "hi", "side", "iso", "reads")
        name = F.concat(F.col("lo"), F.lit("-"), F.col("hi"))
    return out.select(F.concat(F.col("gene"), F.lit(":"), name).alias("event_id"), "gene", "side", "iso", "reads")


def all_events(isoforms: DataFrame | Shared, offset: int = OFFSET, models: DataFrame | None = None) -> DataFrame:
    """One long table of the four event types."""
    cols = [*GENE, "event_id", "lo", "hi", "n_inc", "n_exc", "w_inc", "w_exc", "psi", "psi_reads"]
    base = shared(isoforms, offset)
    sites = _psi(_site_counts(base.edges, _both_axes(base.variants), base.offset).withColumn("event_id", _span_id())).select("as_type", *cols)
    out = sites
    for kind, df in (("IR", retained_introns(base.isoforms, base.offset, models, base.variants)), ("SE", skipped_exons(base.isoforms, models, base.variants, base.skips))):
        out = out.unionByName(df.select(F.lit(kind).alias("as_type"), *cols))
    return out


EVENT = ["as_type", "gene", "lo", "hi", "name"]


def all_members(isoforms: DataFrame | Shared, offset: int = OFFSET) -> DataFrame:
    """Long table of the isoforms on both sides of all events; types that meet the exon rows by one key share a join."""
    return member_rows(isoforms, offset).select("as_type", event_text().alias("event_id"), "gene", "side", "iso", "reads")


def event_text() -> Column:
    """The event id of the columns EVENT."""
    own = F.when(F.col("as_type") == "SE", F.concat(F.col("lo"), F.lit("@"), F.col("name"), F.lit("@"), F.col("hi"))).otherwise(F.concat(F.col("lo"), F.lit("-"), F.col("hi")))
    return F.concat(F.col("gene"), F.lit(":"), own)


def member_rows(isoforms: DataFrame | Shared, offset: int = OFFSET) -> DataFrame:
    """The members of all events by the columns EVENT, which are narrower than a text: name is the inner chain of an SE event between lo and hi, and empty for other types."""
    base = shared(isoforms, offset)
    rows = exon_rows(base.isoforms, ["reads"])
    cols = ["as_type", *GENE, "lo", "hi", "name", "side", "iso", "reads"]
    of = lambda df, kind, side: df.withColumns({"as_type": F.lit(kind), "name": F.lit(""), "side": F.lit(side)})
    pairs = _retained_pairs(base.variants, base.offset).select(*GENE, "a", "b", "s", "e")
    kept = of(pairs.join(rows.select(*GENE, "iso", "reads", "s", "e"), [*GENE, "s", "e"]).withColumnsRenamed({"a": "lo", "b": "hi"}), "IR", "inc").select(*cols)
    left_out = pairs.select(*GENE, F.col("a").alias("lo"), F.col("b").alias("hi"), F.lit("IR").alias("as_type"), F.lit("").alias("name")).distinct()
    skipped = base.skips.select(*GENE, F.col("l").alias("lo"), F.col("r").alias("hi"), F.lit("SE").alias("as_type"), "name", "sid")
    left_out = left_out.unionByName(skipped.drop("sid").distinct())
    gaps = rows.filter(F.col("next_s").isNotNull()).select(*GENE, F.col("e").alias("lo"), F.col("next_s").alias("hi"), "iso", "reads").join(
        left_out, [*GENE, "lo", "hi"]).withColumn("side", F.lit("exc")).select(*cols)
    own = base.isoforms.select(*GENE, "iso", "reads", F.xxhash64("exons").alias("sid"))
    whole = skipped.join(own, [*GENE, "sid"]).withColumn("side", F.lit("inc")).select(*cols)
    sites = _site_members(base.edges, _both_axes(rows), base.offset).withColumn("name", F.lit("")).select(*cols)
    return kept.unionByName(gaps).unionByName(whole).unionByName(sites).drop("chrom", "strand")


def _site_members(events: DataFrame, axis: DataFrame, offset: int) -> DataFrame:
    """Events with the isoforms on both sides."""
    return _site_names(_site_sides(events.select(*SITE, "a", "b"), axis.select(*SITE, "edge", "other", "neigh", "iso", "reads"), offset))


def supported(isoforms: DataFrame, min_reads: int = 2) -> DataFrame:
    """Isoforms with enough reads for event calling."""
    return isoforms.filter(F.col("reads") >= min_reads)


def confirmed_introns(events: DataFrame, junctions: DataFrame) -> DataFrame:
    """IR events whose intron equals a junction; strand does not matter."""
    return events.join(junctions.select("chrom", F.col("js").alias("lo"), F.col("je").alias("hi")).distinct(),
                       ["chrom", "lo", "hi"], "left_semi")


def confirmed_sites(events: DataFrame, junctions: DataFrame, as_type: str) -> DataFrame:
    """A3SS/A5SS events with both edges seen as a junction site on the strand; counts and integer PSI from the junctions."""
    left = _is_left(as_type)  # left exon edges are the right ends of junctions
    sites = junctions.select("chrom", "strand", F.when(left, F.col("je")).otherwise(F.col("js")).alias("site"), "cnt").groupBy(
        "chrom", "strand", "site").agg(F.sum("cnt").alias("n"))
    rows = (events.join(sites.withColumnsRenamed({"site": "lo", "n": "_lo_n"}), ["chrom", "strand", "lo"])
                  .join(sites.withColumnsRenamed({"site": "hi", "n": "_hi_n"}), ["chrom", "strand", "hi"]))
    inc = F.when(left, F.col("_lo_n")).otherwise(F.col("_hi_n"))
    exc = F.when(left, F.col("_hi_n")).otherwise(F.col("_lo_n"))
    return (rows.withColumn("inc_count", inc).withColumn("exc_count", exc)
                .withColumn("junction_psi", F.floor(inc / (inc + exc) * 1000).cast("long")).drop("_lo_n", "_hi_n"))


def confirmed_skips(events: DataFrame, skips: DataFrame) -> DataFrame:
    """SE events that short reads name alike. skips: gene, left, right, chain, named by `name_novel_skips`."""
    seen = skips.select(F.concat(F.col("gene"), F.lit(":"), F.col("left"), F.lit("@"), F.col("chain"), F.lit("@"), F.col("right")).alias("event_id"))
    return events.join(seen.distinct(), "event_id", "left_semi")


def confirmed_events(events: DataFrame, junctions: DataFrame, skips: DataFrame) -> DataFrame:
    """(as_type, event_id) of the events of all four types that short reads confirm, each by the rule of its type."""
    kind = lambda t: events.filter(F.col("as_type") == t)
    parts = [confirmed_introns(kind("IR"), junctions), confirmed_skips(kind("SE"), skips), *[confirmed_sites(kind(t), junctions, t) for t in ("A3SS", "A5SS")]]
    out = None
    for p in parts:
        one = p.select("as_type", "event_id")
        out = one if out is None else out.unionByName(one)
    return out.distinct()


def with_confidence(events: DataFrame, confirmed: DataFrame | None) -> DataFrame:
    """`confident` flag: confirmed by short reads, or every event when there are none. confirmed: as_type, event_id."""
    if confirmed is None:
        return events.withColumn("confident", F.lit(True))
    mark = confirmed.select("as_type", "event_id").distinct().withColumn("_c", F.lit(True))
    return events.join(mark, ["as_type", "event_id"], "left").withColumn("confident", F.coalesce("_c", F.lit(False))).drop("_c")


def event_isoforms(members: DataFrame, events: DataFrame) -> DataFrame:
    """Distinct isoforms on any side of the given events."""
    return members.join(events.select("as_type", "event_id").distinct(), ["as_type", "event_id"], "left_semi").select("iso").distinct()


def splice_site_rows(events: DataFrame, as_type: str) -> DataFrame:
    """Ordered splice-site rows (chrom, left, right, strand, side) parsed from event ids.

    IR gives its intron; SE the introns around each inner exon and the skipping
    intron; A3SS/A5SS one open-ended site per side.
    """
    locus = F.regexp_extract("event_id", r":([^:]*)$", 1)
    base = events.select("event_id", "chrom", "strand", locus.alias("_l"))
    num = lambda c: c.cast("long")
    out = lambda df, l, r, s: df.select("event_id", "chrom", num(l).alias("left"), num(r).alias("right"), "strand", F.lit(s).alias("side"))
    if as_type == "SE":
        p = F.split("_l", "@")
        edges = F.split(F.concat(p[0], F.lit("-"), F.regexp_replace(p[1], ";", "-"), F.lit("-"), p[2]), "-")
        pair = F.transform(F.sequence(F.lit(0), F.size(edges) - 2, F.lit(2)), lambda i: F.struct(
            F.get(edges, i).alias("l"), F.get(edges, i + 1).alias("r")))
        inc = base.withColumn("_p", F.explode(pair))
        return out(inc, F.col("_p.l"), F.col("_p.r"), "inc").unionByName(out(base, p[0], p[2], "exc"))
    p = F.split("_l", "-")
    none = F.lit(None)
    if as_type == "IR":
        return out(base, p[0], p[1], "inc")
    left = _is_left(as_type)  # left exon edges: the site is the right end of an intron
    side = lambda keep, drop, s: out(base, F.when(~left, drop), F.when(left, keep), s)
    return side(p[0], p[1], "inc").unionByName(side(p[1], p[0], "exc"))


def known_or_novel(events: DataFrame, known_ids: DataFrame) -> DataFrame:
    """Events joined with their annotation; `known_ids` holds as_type and event_id."""
    mark = known_ids.select("as_type", "event_id").distinct().withColumn("_k", F.lit(True))
    return (events.join(mark, ["as_type", "event_id"], "left").withColumn("annotation", F.when(F.col("_k"), "Known").otherwise("Novel")).drop("_k"))


def short_read_skips(junctions: DataFrame, models: DataFrame, reads: DataFrame) -> DataFrame:
    """SE from short-read junctions: donors with two acceptors, structures taken from annotation first, then long reads.

    models, reads: chrom, strand, name, exons (name is the gene for models).
    Joined on shared exon edges: the transcript must have the donor edge and
    both acceptor edges, and the exon before the outer acceptor must end at a
    donor seen in the junctions. PSI is the skipping count over all counts of the donor.
    """
    plus = F.col("strand") == "+"
    j = junctions.groupBy("chrom", "strand", "donor", "acceptor").agg(F.sum("cnt").alias("cnt"))
    donors = j.groupBy("chrom", "strand", "donor").agg(F.sum("cnt").alias("total"))
    def edges(t: DataFrame, source: str) -> DataFrame:
        return t.select("chrom", "strand", F.lit(source).alias("source"), "name", "exons")
    both = edges(models, "annotation").unionByName(edges(reads, "reads"))
    # exons in transcription order with mirrored coordinates on '-', so one rule serves both strands
    way = F.when(plus, F.col("exons")).otherwise(F.reverse(F.transform("exons", lambda x: B.block(-x["e"], -x["s"]))))
    both = both.select("chrom", "strand", "source", "name", way.alias("exons")).distinct()
    st = compact(both.withColumn("sid", F.monotonically_increasing_id()).withColumn("sums", chain_sums(F.col("exons"))), "structures")
    place, one = ["chrom", "strand"], ["chrom", "strand", "sid"]
    sign = F.when(plus, 1).otherwise(-1)
    jj = j.select("chrom", "strand", (F.col("donor") * sign).alias("dn"), (F.col("acceptor") * sign).alias("ac"), "cnt")
    dd = donors.select("chrom", "strand", (F.col("donor") * sign).alias("dn"), "total")
    # acceptors of a donor that are exon starts of the structure that holds the donor
    at_donor, at_acceptor = chain_between(st, "dn", "ac")
    ends = st.select(*one, F.posexplode("exons").alias("j", "x")).select(*one, (F.col("j") + 1).alias("j"), F.col("x.e").alias("_last"))
    hits = compact(at_donor.join(jj, [*place, "dn"]).join(at_acceptor, [*one, "ac"]).filter("j > k"), "short_hits")
    outer = hits.filter("j > k + 1").join(ends, [*one, "j"]).join(dd.select(*place, F.col("dn").alias("_last")).distinct(), [*place, "_last"], "left_semi")
    inner = hits.select(*one, "k", F.col("ac").alias("ac_in"), F.col("j").alias("j_in"), F.col("before").alias("before_in"))
    pair = outer.join(inner, [*one, "k"]).filter("j_in < j")
    pair = pair.select(*one, "dn", "ac", "cnt", "j_in", (F.col("j") - F.col("j_in")).alias("n"), (F.col("before") - F.col("before_in")).alias("chain"))
    ev = pair.join(st.select(*one, "source", "name", "exons"), one).withColumn("body", F.slice("exons", F.col("j_in") + 1, F.col("n")))
    best = ev.groupBy(*place, "dn", "ac", "n", "chain").agg(F.min("body").alias("body"), F.max("body").alias("_x"),
        F.min(F.struct("source", F.col("name").cast("string").alias("name"))).alias("_b"), F.first("cnt").alias("skip_count"))
    best = _same(best, "body")
    real = F.when(plus, F.col("body")).otherwise(F.reverse(F.transform("body", lambda x: B.block(-x["e"], -x["s"]))))
    res = best.join(dd, ["chrom", "strand", "dn"]).withColumn("exons", real)
    dn, ac = F.col("dn") * sign, F.col("ac") * sign
    return res.select(
        "chrom", "strand", F.least(dn, ac).alias("left"), F.greatest(dn, ac).alias("right"), B.chain(F.col("exons")).alias("chain"),
        F.col("_b.source").alias("source"), F.when(F.col("_b.source") == "annotation", F.col("_b.name")).otherwise("Novel").alias("gene"),
        "skip_count", "total", F.floor(F.col("skip_count") / F.col("total") * 1000).cast("long").alias("psi"))


def name_novel_skips(skips: DataFrame, models: DataFrame) -> DataFrame:
    """Give a novel SE the gene of the models sharing a junction edge, when that is exactly one gene.

    models: gene, chrom, strand, exons. An edge matches when the left site is an exon end or the right site an exon start.
    """
    ex = models.select("chrom", "strand", "gene", F.explode("exons").alias("x"))
    ends = ex.select("chrom", "strand", F.col("x.e").alias("left"), "gene").distinct()
    starts = ex.select("chrom", "strand", F.col("x.s").alias("right"), "gene").distinct()
    novel = skips.filter(F.col("gene") == "Novel").drop("gene")
    key = ["chrom", "strand", "left", "right"]
    sites = novel.select(*key).distinct()
    found = sites.join(ends, ["chrom", "strand", "left"]).select(*key, "gene").unionByName(
        sites.join(starts, ["chrom", "strand", "right"]).select(*key, "gene")).distinct()
    one = found.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.min("gene").cast("string").alias("_g")).filter(F.col("_n") == 1)
    named = novel.join(one.select(*key, "_g"), key, "left").withColumn("gene", F.coalesce("_g", F.lit("Novel"))).drop("_g")
    return skips.filter(F.col("gene") != "Novel").unionByName(named.select(*skips.columns))
