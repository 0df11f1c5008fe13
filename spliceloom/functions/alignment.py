"""Column expressions on SAM fields: flags, CIGAR, MD and tags."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spliceloom.functions.blocks import block
from spliceloom.functions.sequence import let

# Letter of each flag condition, all bits of the mask must be set.
FLAG_LETTERS = [("p", 0x1), ("P", 0x3), ("u", 0x4), ("U", 0x8), ("r", 0x10), ("R", 0x20),
                ("1", 0x40), ("2", 0x80), ("s", 0x100), ("f", 0x200), ("d", 0x400)]


def has_bits(flag: Column, mask: int) -> Column:
    return flag.bitwiseAND(F.lit(mask)) == mask


def flag_letters(flag: Column) -> Column:
    return F.concat(*[F.when(has_bits(flag, m), c).otherwise("") for c, m in FLAG_LETTERS])


def strand_of(flag: Column, xs: Column | None = None) -> Column:
    base = F.when(has_bits(flag, 0x10), "-").otherwise("+")
    return base if xs is None else F.when(xs.isin("+", "-"), xs).otherwise(base)


def coding_strand(library: str, flag: Column) -> Column:
    """Transcribed strand of a read by library type; '' when the flags leave it open."""
    if library == "fr-unstranded":
        return F.lit(".")
    mapped_rev, mapped_fwd = has_bits(flag, 0x10), ~has_bits(flag, 0x4) & ~has_bits(flag, 0x10)
    mate_rev = has_bits(flag, 0x20)
    mate_out = mate_rev | has_bits(flag, 0x8)
    first, second = has_bits(flag, 0x40), has_bits(flag, 0x80)
    rev_pair, fwd_pair = mapped_rev & ~mate_rev, mapped_fwd & mate_out
    one = (first & rev_pair) | (second & fwd_pair)
    two = (first & fwd_pair) | (second & rev_pair)
    single = ~first & ~second
    # single reads of the first-strand protocol come from the opposite strand
    plus, minus = ("+", "-") if library == "fr-firststrand" else ("-", "+")
    unpaired = (F.when(mapped_rev, plus).when(mapped_fwd, minus) if library == "fr-firststrand"
                else F.when(mapped_fwd, minus).when(mapped_rev, plus))
    return F.coalesce(F.when(single, unpaired), F.when(~single & one, plus), F.when(~single & two, minus), F.lit(""))


def pair_orientation(flag: Column) -> Column:
    """Strand told by mate flags, '' when they do not tell."""
    masked = lambda m: flag.bitwiseAND(F.lit(m))
    return (F.when((masked(0b1111101) == 0b1010001) | (masked(0b11111101) == 0b10100001), "+")
            .when((masked(0b1111101) == 0b1100001) | (masked(0b11111101) == 0b10010001), "-").otherwise(""))


def reverse_strand(flag: Column, mask: int = 0x10) -> Column:
    """Flip the strand bit (0x10) or the mate strand bit (0x20)."""
    return flag.bitwiseXOR(F.lit(mask))


def cigar_length(cigar: Column, ops: str) -> Column:
    parts = F.regexp_extract_all(cigar, F.lit(f"([0-9]+)[{ops}]"), 1)
    return F.aggregate(parts, F.lit(0).cast("long"), lambda t, n: t + n.cast("long"))


def read_length(cigar: Column) -> Column:
    return cigar_length(cigar, "MISH=X")


def unclipped_length(cigar: Column) -> Column:
    """Bases present in SEQ: everything but hard clips."""
    return cigar_length(cigar, "MIS=X")


def aligned_length(cigar: Column) -> Column:
    return cigar_length(cigar, "MI=X")


def indel_length(cigar: Column) -> Column:
    return cigar_length(cigar, "ID")


WALK = T.StructType([T.StructField("blocks", T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("s", "e")]))),
                     T.StructField("indels", T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), *(T.StructField(c, T.LongType()) for c in ("pos", "end", "n"))])))])


def cigar_steps(cigar: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, operation (its letter's code) and length of all operations of a column of CIGAR texts: digits with a letter of MIDNSHP=X behind them."""
    text = pc.fill_null(cigar.cast(pa.large_string()), "")
    off = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[off[0]:off[-1]]
    off = off - off[0]
    digit = (data >= 48) & (data <= 57)
    at = np.flatnonzero(np.isin(data, np.frombuffer(b"MIDNSHP=X", np.uint8)))
    row = np.searchsorted(off, at, side="right") - 1
    other = np.maximum.accumulate(np.where(digit, -1, np.arange(len(data))))  # the last character up to here that is no digit
    first = np.maximum(other[at - 1] + 1, off[row]) if len(at) else at
    use = (at > off[row]) & (first < at)
    at, row, first = at[use], row[use], first[use]
    n, size = np.zeros(len(at), np.int64), at - first
    for k in range(size.max(initial=0)):
        d = np.where(k < size, data[np.maximum(at - 1 - k, 0)].astype(np.int64) - 48, 0)
        if k > 17 and d.any():
            raise OverflowError("a length of a CIGAR has over 18 digits")
        n += d * 10 ** min(k, 18)
    return row, data[at], n


@F.arrow_udf(WALK)
def walked(start: pa.Array, cigar: pa.Array) -> pa.Array:
    """Exon blocks and indels of alignments from their 0-based starts, all alignments of a batch in one pass of running sums."""
    rows, lost, none = len(cigar), start.is_null().to_numpy(zero_copy_only=False), cigar.is_null()
    begin = pc.fill_null(start, 0).to_numpy(zero_copy_only=False).astype(np.int64)
    row, op, n = cigar_steps(cigar)
    is_op = lambda letters: np.isin(op, np.frombuffer(letters, np.uint8))
    number = lambda v, r: pa.array(v, pa.int64(), mask=lost[r])
    lists = lambda sizes, values: pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), values, mask=none)
    heads = np.searchsorted(row, np.arange(rows + 1))

    def places(letters: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Position before each operation, and behind the last one of each row; only the given operations move on."""
        upto = np.append(0, np.cumsum(np.where(is_op(letters), n, 0)))
        return begin[row] + upto[:-1] - upto[heads[row]], begin + upto[heads[1:]] - upto[heads[:-1]]

    at, end = places(b"MD=XN")
    gap = np.flatnonzero(is_op(b"N"))
    r = row[gap]
    sizes = np.bincount(r, minlength=rows) + 1
    last, place = np.cumsum(sizes) - 1, np.arange(len(gap)) + r
    s, e = np.empty(sizes.sum(), np.int64), np.empty(sizes.sum(), np.int64)
    s[last - sizes + 1], s[place + 1], e[place], e[last] = begin, at[gap] + n[gap], at[gap], end
    owner = np.repeat(np.arange(rows), sizes)
    blocks = lists(sizes, pa.StructArray.from_arrays([number(s, owner), number(e, owner)], ["s", "e"]))

    edit = np.flatnonzero(is_op(b"ID"))
    r, size, pos = row[edit], n[edit], places(b"MD=XNP")[0][edit] + 1
    drop = op[edit] == ord("D")
    kind = pa.array(["insertion", "deletion"]).take(pa.array(drop.astype(np.int8)))
    found = pa.StructArray.from_arrays([kind, number(pos, r), number(pos + np.where(drop, size - 1, 0), r), pa.array(size, pa.int64())], ["kind", "pos", "end", "n"])
    return pa.StructArray.from_arrays([blocks, lists(np.bincount(r, minlength=rows), found)], ["blocks", "indels"])


def walk(start: Column, cigar: Column) -> Column:
    return walked(start.cast("long"), cigar)


def cigar_blocks(start: Column, cigar: Column) -> Column:
    """Exon blocks of an alignment from its 0-based start; N splits, insertions and clips take no room."""
    return walk(start, cigar)["blocks"]


def blocks_with_clips(start: Column, cigar: Column) -> Column:
    """Blocks whose outer edges include leading and trailing clips."""
    lead = F.coalesce(F.regexp_extract(cigar, "^([0-9]+)[SH]", 1).try_cast("long"), F.lit(0))
    tail = F.coalesce(F.regexp_extract(cigar, "([0-9]+)[SH]$", 1).try_cast("long"), F.lit(0))
    return let(F.struct(cigar_blocks(start, cigar).alias("b"), lead.alias("lead"), tail.alias("tail")), lambda v: F.transform(
        v["b"], lambda x, i: block(x["s"] - F.when(i == 0, v["lead"]).otherwise(0),
                                   x["e"] + F.when(i == F.size(v["b"]) - 1, v["tail"]).otherwise(0))))


def junction_anchors(start: Column, cigar: Column) -> Column:
    """array<struct<left,s,e,right>>: each intron with the start of the block before and the end of the block after."""
    def body(b: Column) -> Column:
        nxt = F.slice(b, F.lit(2), F.greatest(F.size(b), F.lit(1)))
        pairs = F.zip_with(b, nxt, lambda x, y: F.struct(x["s"].alias("left"), x["e"].alias("s"), y["s"].alias("e"),
                                                         y["e"].alias("right")))
        return F.slice(pairs, F.lit(1), F.greatest(F.size(b) - 1, F.lit(0)))
    return let(cigar_blocks(start, cigar), body)


def indels(start: Column, cigar: Column) -> Column:
    """array<struct<kind,pos,end,n>> of insertions and deletions, 1-based positions."""
    return walk(start, cigar)["indels"]


def md_match_length(md: Column) -> Column:
    return F.aggregate(F.regexp_extract_all(md, F.lit("([0-9]+)"), 1), F.lit(0).cast("long"), lambda t, n: t + n.cast("long"))


def md_mismatches(md: Column) -> Column:
    """Mismatching bases of an MD tag; deleted bases (after ^) do not count."""
    return F.array_join(F.regexp_extract_all(F.regexp_replace(md, r"\^[ACGTN]+", ""), F.lit("([ACGTN]+)"), 1), "")


def mismatch_length(md: Column) -> Column:
    return F.length(md_mismatches(md))


def n_base_count(md: Column) -> Column:
    m = md_mismatches(md)
    return F.length(m) - F.length(F.translate(m, "N", ""))


def coverage_percent(cigar: Column) -> Column:
    return F.round(aligned_length(cigar) / read_length(cigar) * 100, 6)


def identity_percent(cigar: Column, md: Column) -> Column:
    return F.round(md_match_length(md) / aligned_length(cigar) * 100, 6)


def tag(line: Column, name: str) -> Column:
    """Value of an optional tag in a SAM line, null when absent."""
    v = F.regexp_extract(line, rf"\t{name}:[A-Za-z]:([^\t]+)", 1)
    return F.when(v != "", v)


def best_hits(line: Column) -> Column:
    return tag(line, "X0").cast("long")


def sub_hits(line: Column) -> Column:
    return tag(line, "X1").cast("long")


def min_alternative_nm(line: Column) -> Column:
    """Smallest NM among the alternative hits of the XA tag."""
    return F.array_min(F.transform(F.regexp_extract_all(tag(line, "XA"), F.lit("([0-9]+);"), 1), lambda n: n.cast("long")))
