"""Column expressions over block lists: arrays of struct<s,e>, sorted, half-open."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCKS = "array<struct<s:bigint,e:bigint>>"


def block(s: Column, e: Column) -> Column:
    return F.struct(s.cast("long").alias("s"), e.cast("long").alias("e"))


def empty() -> Column:
    return F.array().cast(BLOCKS)


def from_text(start: Column, sizes: Column, starts: Column) -> Column:
    """Exon blocks from a start and comma lists of sizes and relative starts."""
    ints = lambda c: F.filter(F.split(c, ","), lambda x: x != "")
    return F.transform(F.arrays_zip(ints(sizes).alias("z"), ints(starts).alias("r")),
                       lambda x: block(start + x["r"].cast("long"), start + x["r"].cast("long") + x["z"].cast("long")))


def from_edges(starts: Column, ends: Column) -> Column:
    """Exon blocks from comma lists of absolute starts and ends."""
    ints = lambda c: F.filter(F.split(c, ","), lambda x: x != "")
    return F.transform(F.arrays_zip(ints(starts).alias("s"), ints(ends).alias("e")),
                       lambda x: block(x["s"], x["e"]))


def introns(exons: Column) -> Column:
    """Gaps between neighbouring blocks; empty for one block."""
    nxt = F.slice(exons, F.lit(2), F.greatest(F.size(exons), F.lit(1)))
    pairs = F.zip_with(exons, nxt, lambda a, b: block(a["e"], b["s"]))
    return F.slice(pairs, F.lit(1), F.greatest(F.size(exons) - 1, F.lit(0)))


def length(blocks: Column) -> Column:
    return F.aggregate(blocks, F.lit(0).cast("long"), lambda t, b: t + b["e"] - b["s"])


def chain(blocks: Column) -> Column:
    """`s-e;s-e` text of a block list."""
    return F.array_join(F.transform(blocks, lambda b: F.concat_ws("-", b["s"], b["e"])), ";")


def sizes_text(blocks: Column) -> Column:
    return F.array_join(F.transform(blocks, lambda b: (b["e"] - b["s"]).cast("string")), ",")


def starts_text(blocks: Column) -> Column:
    return F.array_join(F.transform(blocks, lambda b: (b["s"] - blocks[0]["s"]).cast("string")), ",")


def clip(blocks: Column, lo: Column, hi: Column) -> Column:
    """Parts of blocks inside [lo, hi)."""
    return F.filter(F.transform(blocks, lambda b: block(F.greatest(b["s"], lo), F.least(b["e"], hi))),
                    lambda b: b["e"] > b["s"])


def clipped_length(blocks: Column, lo: Column, hi: Column) -> Column:
    return F.aggregate(blocks, F.lit(0).cast("long"),
                       lambda t, b: t + F.greatest(F.least(b["e"], hi) - F.greatest(b["s"], lo), F.lit(0)))


def cds_length(exons: Column, cds_start: Column, cds_end: Column) -> Column:
    return clipped_length(exons, cds_start, cds_end)


def utr_length(exons: Column, cds_start: Column, cds_end: Column, strand: Column, prime: int) -> Column:
    left = clipped_length(exons, exons[0]["s"], cds_start)
    right = clipped_length(exons, cds_end, F.element_at(exons, -1)["e"])
    first, second = (left, right) if prime == 5 else (right, left)
    return F.when(strand == "+", first).otherwise(second)


def left_utr(exons: Column, cds_start: Column) -> Column:
    return clip(exons, exons[0]["s"], cds_start)


def right_utr(exons: Column, cds_end: Column) -> Column:
    return clip(exons, cds_end, F.element_at(exons, -1)["e"])


def both_utrs(exons: Column, cds_start: Column, cds_end: Column) -> Column:
    return F.concat(left_utr(exons, cds_start), right_utr(exons, cds_end))


def _fold(blocks: Column, joins) -> Column:
    """Left fold of sorted blocks that extends the last block while `joins(last, next)` holds."""
    def step(done: Column, b: Column) -> Column:
        last = F.element_at(done, -1)
        grown = F.concat(F.slice(done, F.lit(1), F.size(done) - 1),
                         F.array(block(last["s"], F.greatest(last["e"], b["e"]))))
        return F.when(F.size(done) == 0, F.array(b)).when(joins(last, b), grown).otherwise(F.concat(done, F.array(b)))
    return F.aggregate(F.array_sort(blocks), empty(), step)


def merge(blocks: Column) -> Column:
    """Union of overlapping or touching blocks."""
    return _fold(blocks, lambda last, b: b["s"] <= last["e"])


def sew(blocks: Column) -> Column:
    """Join blocks that touch exactly end to start."""
    return _fold(blocks, lambda last, b: b["s"] == last["e"])


def union(a: Column, b: Column) -> Column:
    return merge(F.concat(a, b))


def intersect(a: Column, b: Column, touching: bool = True) -> Column:
    """Pairwise overlaps of two block lists; length-0 contacts count when `touching`."""
    pieces = F.flatten(F.transform(a, lambda x: F.transform(
        b, lambda y: block(F.greatest(x["s"], y["s"]), F.least(x["e"], y["e"])))))
    keep = (lambda p: p["s"] <= p["e"]) if touching else (lambda p: p["s"] < p["e"])
    return F.array_sort(F.filter(pieces, keep))


def overlap_length(a: Column, b: Column) -> Column:
    """Bases shared by two lists of disjoint blocks."""
    return F.aggregate(a, F.lit(0).cast("long"), lambda t, x: t + clipped_length(b, x["s"], x["e"]))


def subtract(a: Column, b: Column) -> Column:
    """Parts of `a` outside `b`: `a` cut by the gaps that the merged `b` leaves."""
    far = F.lit(1 << 60)
    m = merge(b)
    gaps = F.filter(F.zip_with(F.concat(F.array(block(-far, -far)), m), F.concat(m, F.array(block(far, far))),
                               lambda x, y: block(x["e"], y["s"])), lambda g: g["s"] < g["e"])
    return intersect(a, gaps, False)


def touches(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Interval overlap with contact allowed."""
    return F.greatest(s1, s2) <= F.least(e1, e2)


def contains(outer: Column, inner: Column) -> Column:
    """The introns of `inner` are consecutive introns of `outer`; an end may pass its outer exon only where that
    exon is the outer transcript's own end. A transcript without introns is contained in none."""
    oi, ii = introns(outer), introns(inner)
    n = F.size(ii)
    at = F.array_position(oi, F.get(ii, F.lit(0))).cast("int")
    run = F.slice(oi, F.greatest(at, F.lit(1)), n)
    left = (at == 1) | (inner[0]["s"] >= F.get(outer, at - 1)["s"])
    right = (at + n == F.size(outer)) | (F.element_at(inner, -1)["e"] <= F.get(outer, at - 1 + n)["e"])
    return F.coalesce((n > 0) & (at > 0) & (run == ii) & left & right, F.lit(False))


def in_intron(exons: Column, s: Column, e: Column) -> Column:
    return F.exists(introns(exons), lambda i: (i["s"] <= s) & (e <= i["e"]))


def has_intron(exons: Column, s: Column, e: Column) -> Column:
    return F.exists(introns(exons), lambda i: (i["s"] == s) & (i["e"] == e))


def explained(exons: Column, s: Column, e: Column, slop: int = 0) -> Column:
    """Neither end of a read falls in an intron: starts may lie `slop` left, ends `slop` right of an exon."""
    last = F.element_at(exons, -1)["e"]
    start_ok = F.exists(exons, lambda x: (x["s"] - slop <= s) & (s <= x["e"])) | (s > last)
    end_ok = F.exists(exons, lambda x: (x["s"] <= e) & (e <= x["e"] + slop)) | (e > last + slop)
    return start_ok & end_ok


def cds_start_exon(exons: Column, cds_start: Column) -> Column:
    """0-based index of the exon holding the CDS start, null if none."""
    at = F.array_position(F.transform(exons, lambda x: (x["s"] <= cds_start) & (cds_start <= x["e"])), True)
    return F.when(at > 0, at - 1).cast("int")


def cds_end_exon(exons: Column, cds_end: Column) -> Column:
    """0-based index of the last exon holding the CDS end, null if none."""
    at = F.array_position(F.reverse(F.transform(exons, lambda x: (x["s"] <= cds_end) & (cds_end <= x["e"]))), True)
    return F.when(at > 0, F.size(exons) - at).cast("int")


def site_class(site: Column, cds_start: Column, cds_end: Column, exons: Column, strand: Column) -> Column:
    """struct(type, index) of a 1-based base: TSS, TTS, Exon/UTR/CDS, their introns, or Intergenic."""
    last = F.size(exons) - 1
    lo, hi = exons[0]["s"], F.element_at(exons, -1)["e"]
    coding = cds_start != cds_end
    ei = (F.array_position(F.transform(exons, lambda x: (x["s"] < site) & (site <= x["e"])), True) - 1).cast("int")
    ii = (F.array_position(F.transform(introns(exons), lambda x: (x["s"] < site) & (site <= x["e"])), True) - 1).cast("int")
    x, g = F.get(exons, ei), F.get(introns(exons), ii)
    exon = F.concat(
        F.when(~coding, "Exon").when((site <= cds_start) | (cds_end < site), "UTR").otherwise("CDS"),
        F.when((site - 1 == x["s"]) & (site - 1 != cds_start), "_Left").otherwise(""),
        F.when(site - 1 == cds_start, "_Start").otherwise(""),
        F.when((site == x["e"]) & (site != cds_end), "_Right").otherwise(""),
        F.when(site == cds_end, "_End").otherwise(""))
    intron = F.concat(
        F.when(~coding, "Intron").when((site > cds_start) & (site < cds_end), "CDS_Intron").otherwise("UTR_Intron"),
        F.when(site - 1 == g["s"], "_Left").otherwise(""),
        F.when(site == g["e"], "_Right").otherwise(""))
    out = lambda t, i: F.struct(t.alias("type"), i.cast("int").alias("index"))
    ends = lambda plus, minus: F.when(strand == "-", minus).otherwise(plus)
    return (F.when(site <= lo, out(F.lit("Intergenic"), F.lit(0)))
            .when(site > hi, out(F.lit("Intergenic"), last))
            .when(site - 1 == lo, out(ends("TSS", "TTS"), F.lit(0)))
            .when(site == hi, out(ends("TTS", "TSS"), last))
            .when(ei >= 0, out(exon, ei)).otherwise(out(intron, ii)))


def region_class(start: Column, end: Column, a: Column, b: Column, exons: Column) -> Column:
    """Region label from the site classes `a` of its first base and `b` of its last base."""
    def kind(t: Column) -> Column:
        return (F.when(t.isin("TSS", "TTS"), "end").when(t.startswith("Exon"), "exon").when(t.startswith("Intron"), "intron")
                .when(t.rlike("^(UTR|CDS)_Intron"), "part_intron")
                .when(t.rlike("^UTR(_(Left|Right))?$|^CDS(_(Left|Right|Start|End))?$"), "part").otherwise("outside"))
    ta, tb, ka, kb = a["type"], b["type"], kind(a["type"]), kind(b["type"])
    same = a["index"] == b["index"]
    word = lambda w: F.concat(ta, F.lit(f"-{w}-"), tb)
    pair = F.when(same, word("Adjacent")).otherwise(word("Span"))
    before = F.when(a["index"] == b["index"] - 1, word("Adjacent")).otherwise(word("Span"))
    whole = ta.endswith("_Left") & tb.endswith("_Right") & (F.split(ta, "_")[0] == F.split(tb, "_")[0])
    def inner(name: Column) -> Column:
        return F.when(~same, word("Span")).when(whole, name).otherwise(word("In"))
    return (F.when(ka.isin("end", "exon"), F.when(kb == "exon", inner(F.lit("Exon"))).otherwise(pair))
            .when(ka == "intron", F.when(kb == "intron", inner(F.lit("Intron"))).otherwise(before))
            .when(ka == "part", F.when(kb == "part", inner(F.split(ta, "_")[0])).otherwise(pair))
            .when(ka == "part_intron", F.when(kb == "part_intron", inner(F.concat(F.split(ta, "_")[0], F.lit("_Intron"))))
                  .otherwise(before))
            .when(tb == "Intergenic", F.when((end < exons[0]["s"]) | (start > F.element_at(exons, -1)["e"]), "Intergenic")
                  .otherwise("Intergenic-Span-Intergenic")).otherwise(pair))


def shared_introns(a: Column, b: Column, offset: int = 0) -> Column:
    """Introns of `a` matched by an intron of `b` within `offset` at both ends."""
    return F.size(F.filter(a, lambda x: F.exists(b, lambda y: (F.abs(x["s"] - y["s"]) <= offset)
                                                 & (F.abs(x["e"] - y["e"]) <= offset))))


def valid(exons: Column) -> Column:
    return F.forall(exons, lambda x: x["e"] > x["s"])


def from_introns(start: Column, end: Column, gaps: Column) -> Column:
    """Exons of a transcript span with the given introns taken out."""
    lefts = F.concat(F.array(start.cast("long")), F.transform(gaps, lambda g: g["e"]))
    rights = F.concat(F.transform(gaps, lambda g: g["s"]), F.array(end.cast("long")))
    return F.zip_with(lefts, rights, lambda s, e: block(s, e))


def frames(exons: Column, cds_start: Column, cds_end: Column, strand: Column) -> Column:
    """Reading frame at the first coding base of each exon in transcription order, -1 outside the CDS."""
    coding = F.transform(exons, lambda x: F.greatest(F.least(x["e"], cds_end) - F.greatest(x["s"], cds_start), F.lit(0)))
    def walk(parts: Column) -> Column:
        seed = F.struct(F.lit(0).cast("long").alias("done"), F.array().cast("array<int>").alias("f"))
        return F.aggregate(parts, seed, lambda a, n: F.struct(
            (a["done"] + n).cast("long").alias("done"),
            F.concat(a["f"], F.array(F.when(n > 0, F.pmod(a["done"], F.lit(3))).otherwise(-1).cast("int"))).alias("f")))["f"]
    return F.when(strand == "-", F.reverse(walk(F.reverse(coding)))).otherwise(walk(coding))


def slice_by_length(exons: Column, lo: Column, hi: Column, reverse: bool | Column = False) -> Column:
    """Genomic blocks of transcript-relative bases [lo, hi); counted from the right end when `reverse`."""
    total = length(exons)
    rev = F.lit(reverse) if isinstance(reverse, bool) else reverse
    a, b = F.when(rev, total - hi).otherwise(lo), F.when(rev, total - lo).otherwise(hi)
    seed = F.struct(F.lit(0).cast("long").alias("done"), empty().alias("out"))
    def step(acc: Column, x: Column) -> Column:
        s = x["s"] + F.greatest(a - acc["done"], F.lit(0))
        e = x["s"] + F.least(b - acc["done"], x["e"] - x["s"])
        return F.struct((acc["done"] + x["e"] - x["s"]).cast("long").alias("done"),
                        F.when(s < e, F.concat(acc["out"], F.array(block(s, e)))).otherwise(acc["out"]).alias("out"))
    return F.aggregate(exons, seed, step)["out"]
