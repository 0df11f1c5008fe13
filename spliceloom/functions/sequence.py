"""Column expressions on nucleotide text and quality text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Splice motifs counted as canonical.
CANONICAL = ["GT-AG", "GC-AG", "AT-AC"]
# poly(A) signal hexamers counted around sites.
SIGNALS = ["AATAAA", "AAATAA", "ATAAAA", "ATTAAA", "ATAAAT", "TAATAA",
           "ATAAAG", "AAAATA", "CAATAA", "ATAAAC", "AAAAAA", "AAAAAG"]
# The hexamers above without the plain A run, accepted at a sequence end.
END_SIGNALS = [h for h in SIGNALS if h != "AAAAAA"]


def let(value: Column, body) -> Column:
    """Evaluate `value` once and use it in `body`."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def letters(seq: Column) -> Column:
    return F.filter(F.split(seq, ""), lambda c: c != "")


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def on_strand(seq: Column, strand: Column) -> Column:
    return F.when(strand == "-", reverse_complement(seq)).otherwise(seq)


def count_of(seq: Column, letters: str) -> Column:
    return F.length(seq) - F.length(F.translate(seq, letters, ""))


def gc(seq: Column) -> Column:
    return count_of(seq, "GCgc") / F.length(seq)


def gc_slices(seq: Column, parts: int = 20) -> Column:
    """(part, gc) with the GC percent of successive slices of ``length div parts`` bases; a rest makes further slices."""
    def body(c: Column) -> Column:
        size = F.greatest(F.floor(F.size(c) / parts), F.lit(1)).cast("int")
        def one(i: Column) -> Column:
            piece = F.slice(c, i * size + 1, size)
            hits = F.size(F.filter(piece, lambda x: x.isin("G", "C", "g", "c")))
            return F.struct(i.alias("part"), (hits * 100 / F.size(piece)).alias("gc"))
        return F.transform(F.sequence(F.lit(0), (F.ceil(F.size(c) / size) - 1).cast("int")), one)
    return let(letters(seq), body)


def canonical_site(strand: str, side: str, two: Column) -> Column:
    """Is a dinucleotide on the + genome text a canonical donor or acceptor of the strand."""
    sites = {("+", "donor"): ["GT", "GC", "AT"], ("+", "acceptor"): ["AG", "AC"],
             ("-", "donor"): ["AC", "GC", "AT"], ("-", "acceptor"): ["CT", "GT"]}
    return two.isin(sites[(strand, side)])


def has_end_signal(seq: Column) -> Column:
    return F.right(F.upper(seq), F.lit(6)).isin(END_SIGNALS)


def kmers(seq: Column, k: int) -> Column:
    """All k-letter windows in order."""
    def body(c: Column) -> Column:
        n = F.size(c) - (k - 1)
        at = lambda i: F.concat(*[F.get(c, i + j) for j in range(k)])
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), at)).otherwise(F.array().cast("array<string>"))
    return let(letters(seq), body)


def base_fraction(seq: Column, bases: str) -> Column:
    """Share of the given bases, upper or lower case."""
    return count_of(seq, bases.upper() + bases.lower()) / F.length(seq)


def quality(qual: Column, base: int = 33) -> Column:
    """Phred values of a quality string; `base` is 33 or 64 by platform."""
    return F.transform(letters(qual), lambda c: F.ascii(c) - base)


def quality_sum(qual: Column, base: int = 33) -> Column:
    return F.aggregate(quality(qual, base), F.lit(0).cast("long"), lambda t, q: t + q)


def quality_mean(qual: Column, base: int = 33) -> Column:
    return quality_sum(qual, base) / F.length(qual)


def low_quality_count(qual: Column, below: int, base: int = 33) -> Column:
    return F.size(F.filter(quality(qual, base), lambda q: q < below))


def bad_tail(qual: Column, tail: int, below: int, base: int = 33) -> Column:
    """Any of the last `tail` qualities is under `below`."""
    return low_quality_count(F.right(qual, F.lit(tail)), below, base) > 0


def trim(text: Column, bases: int, prime: int) -> Column:
    """Take `bases` letters off the 5' or 3' end."""
    keep = F.greatest(F.length(text) - bases, F.lit(0))
    return F.right(text, keep) if prime == 5 else F.left(text, keep)


def trim_pattern(seq: Column, qual: Column, pattern: str, prime: int) -> Column:
    """struct(seq, qual) with a pattern taken off one end of the sequence and as many qualities."""
    cut = F.regexp_replace(seq, f"^(?:{pattern})" if prime == 5 else f"(?:{pattern})$", "")
    side = F.right if prime == 5 else F.left
    return F.struct(cut.alias("seq"), side(qual, F.length(cut)).alias("qual"))


TOGETHER = 1 << 20  # letters of the texts that one step takes at once
ORF = T.StructType([T.StructField(c, T.IntegerType()) for c in ("start", "end", "integrity")])


def joined(seq: pd.Series) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Texts put together up to TOGETHER letters, nulls left out: their row numbers, one byte per letter, and where each begins and the last ends."""
    rows = np.flatnonzero(seq.notna().to_numpy())
    texts = seq.to_numpy()[rows]
    upto = np.append(0, np.cumsum([len(s) for s in texts], dtype=np.int64))
    lo = 0
    while lo < len(rows):
        hi = max(lo + 1, int(np.searchsorted(upto, upto[lo] + TOGETHER, side="right")) - 1)
        yield rows[lo:hi], np.frombuffer("".join(texts[lo:hi]).encode("ascii", "replace"), np.uint8), upto[lo:hi + 1] - upto[lo]
        lo = hi


def orfs_in(x: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts of `joined` that have an ORF, and (start, end, integrity) of the longest of each; see `longest_orf`."""
    one, two, three = x[:-2], x[1:-1], x[2:]
    start = (one == 65) & (two == 84) & (three == 71)
    at = np.flatnonzero(start | (one == 84) & (((two == 65) & ((three == 65) | (three == 71))) | ((two == 71) & (three == 65))))
    row = np.searchsorted(off, at, side="right") - 1
    inside = at + 3 <= off[row + 1]
    at, row = at[inside], row[inside]
    lane = 3 * row + (at - off[row]) % 3
    order = np.argsort(lane, kind="stable")
    at, row, lane, start = at[order], row[order], lane[order], start[at[order]]
    # codons of one frame up to a stop or the end of the text are a run, which counts from its first start
    first = np.flatnonzero(np.concatenate([[True], (lane[1:] != lane[:-1]) | ~start[:-1]])[:len(at)])
    last = np.append(first[1:], len(at))[:len(first)] - 1
    first, last = first[start[first]], last[start[first]]
    row, begin, closed = row[first], at[first], ~start[last]
    size = np.where(closed, at[last] + 3 - begin, (off[row + 1] - begin) // 3 * 3)
    best = np.lexsort((begin, -size, row))
    best = best[np.concatenate([[True], row[best][1:] != row[best][:-1]])[:len(best)]]
    row, begin = row[best], begin[best] - off[row[best]]
    return row, np.column_stack([begin, begin + size[best], np.where(closed[best], 1, -1)])


@F.pandas_udf(ORF)
def longest_orf(seq: pd.Series) -> pd.DataFrame:
    """struct(start, end, integrity) of the longest ATG-to-stop run over three frames.

    An open run reaches the last whole codon and has integrity -1, a closed one
    includes its stop and has 1. Ties go to the upstream start. No ORF: (0, 0, -1). Null text: nulls.
    """
    out = np.tile(np.array([0, 0, -1], np.int32), (len(seq), 1))
    for rows, x, off in joined(seq):
        some, found = orfs_in(x, off)
        out[rows[some]] = found
    none = seq.isna().to_numpy()
    return pd.DataFrame({c: pd.arrays.IntegerArray(np.ascontiguousarray(v), none.copy()) for c, v in zip(("start", "end", "integrity"), out.T)})


# Fickett position and content thresholds, probabilities and weights.
FICKETT_POSITION_STEPS = [1.9, 1.8, 1.7, 1.6, 1.5, 1.4, 1.3, 1.2, 1.1, 0.0]
FICKETT_CONTENT_STEPS = [0.33, 0.31, 0.29, 0.27, 0.25, 0.23, 0.21, 0.19, 0.17, 0.0]
FICKETT_POSITION = {
    "A": [0.51, 0.55, 0.57, 0.52, 0.48, 0.58, 0.57, 0.54, 0.50, 0.36],
    "C": [0.29, 0.44, 0.55, 0.49, 0.52, 0.60, 0.60, 0.56, 0.51, 0.38],
    "G": [0.62, 0.67, 0.74, 0.65, 0.61, 0.62, 0.52, 0.41, 0.31, 0.17],
    "T": [0.51, 0.60, 0.69, 0.64, 0.62, 0.67, 0.58, 0.48, 0.39, 0.24],
}
FICKETT_CONTENT = {
    "A": [0.40, 0.55, 0.58, 0.58, 0.52, 0.48, 0.45, 0.45, 0.38, 0.19],
    "C": [0.50, 0.63, 0.59, 0.50, 0.46, 0.45, 0.47, 0.56, 0.59, 0.33],
    "G": [0.21, 0.40, 0.47, 0.50, 0.52, 0.56, 0.57, 0.52, 0.44, 0.23],
    "T": [0.30, 0.49, 0.56, 0.53, 0.48, 0.48, 0.52, 0.57, 0.60, 0.51],
}
FICKETT_POSITION_WEIGHT = {"A": 0.062, "C": 0.093, "G": 0.205, "T": 0.154}
FICKETT_CONTENT_WEIGHT = {"A": 0.084, "C": 0.076, "G": 0.081, "T": 0.055}


def _step_table(value: Column, steps: list[float], table: list[float], weight: float) -> Column:
    out = F.when(value >= steps[0], table[0] * weight)
    for limit, p in zip(steps[1:], table[1:]):
        out = out.when(value >= limit, p * weight)
    return out


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def phase_counts(seq: pd.Series) -> pd.Series:
    """Counts of A, C, G, T at each codon phase: twelve numbers, phases inside bases. Null text: null."""
    code = np.full(256, 4, np.uint8)
    code[list(b"ACGT")] = range(4)

    def of(s: str | None) -> np.ndarray | None:
        if s is None:
            return None
        x = code[np.frombuffer(s.encode("ascii", "replace"), np.uint8)]
        return np.stack([np.bincount(x[i::3], minlength=5)[:4] for i in range(3)], axis=1).ravel()
    return pd.Series([of(s) for s in seq], dtype=object)


def fickett(seq: Column) -> Column:
    """Fickett score from the base counts of each codon phase."""
    def values(c: Column) -> Column:
        n = {b: [c["n"][3 * i + k] for k in range(3)] for i, b in enumerate("ACGT")}
        return F.struct(*[((n[b][0] + n[b][1] + n[b][2]) / c["size"]).alias(f"{b}c") for b in "ACGT"],
                        *[(F.greatest(*n[b]) / (F.least(*n[b]) + 1.0)).alias(f"{b}p") for b in "ACGT"])
    def score(v: Column) -> Column:
        total = F.lit(0.0)
        for b in "ACGT":
            total = total + _step_table(v[f"{b}c"], FICKETT_CONTENT_STEPS, FICKETT_CONTENT[b], FICKETT_CONTENT_WEIGHT[b])
            total = total + _step_table(v[f"{b}p"], FICKETT_POSITION_STEPS, FICKETT_POSITION[b], FICKETT_POSITION_WEIGHT[b])
        return total
    counted = F.struct(phase_counts(seq).alias("n"), F.length(seq).alias("size"))
    return F.when(F.length(seq) < 2, F.lit(0.0)).otherwise(let(counted, lambda c: let(values(c), score)))
