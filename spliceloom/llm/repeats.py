"""Repeated byte strings by truncated longest-previous-factor arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spliceloom.session import durable, written

from .common import fresh, sized
from .lines import mixed

GRAM = 48             # bytes of an anchor
HOT = 4096            # occurrences of an anchor up to which one task orders its suffixes
CHUNK = 1 << 20       # bytes of context ordered at once
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
_powers: dict[str, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(str(base))
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = _powers[str(base)] = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size - 1, base)]))
    return have[:n]


def prefixes(b: np.ndarray) -> np.ndarray:
    """Running sums of bytes times powers: the hash of any slice follows from two of them."""
    return np.concatenate([[np.uint64(0)], np.cumsum((b.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(b)))])


def slices(p: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Hash of ``length`` bytes from each start."""
    return mixed((p[starts + length] - p[starts]) * powers(INVERSE, len(p))[starts], length)


def runs_of(mask: np.ndarray, starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Byte intervals covered by the strings of ``length`` at the marked ascending starts."""
    s = starts[mask]
    if not len(s):
        return []
    cut = np.flatnonzero(np.diff(s) > length)
    return list(zip(s[np.concatenate([[0], cut + 1])].tolist(), (s[np.concatenate([cut, [len(s) - 1]])] + length).tolist()))


def anchors(b: np.ndarray, length: int) -> tuple[list[tuple[int, int, int, int]], list[tuple[int, int]], list[tuple[int, int]]]:
    """Anchors (value, place, first start, last start) of the strings of ``length`` in a text, and what repeats inside it.

    The anchor of a string is its smallest 48-byte gram, the leftmost if there are several, so equal strings have equal anchors at equal
    offsets. Where a string repeats inside the text only the first copy gets an anchor; the intervals covered by all copies, and by all but the first,
    are returned.
    """
    n = len(b) - length + 1
    if n <= 0:
        return [], [], []
    p = prefixes(b)
    h = slices(p, np.arange(len(b) - GRAM + 1), GRAM)
    w = length - GRAM + 1
    # minima of all windows of w grams: running minima from both ends of blocks of w
    pad = np.concatenate([h, np.full(-len(h) % w, np.uint64(2**64 - 1))]).reshape(-1, w)
    ahead = np.minimum.accumulate(pad, axis=1).ravel()
    back = np.minimum.accumulate(pad[:, ::-1], axis=1)[:, ::-1].ravel()
    low = np.minimum(back[:n], ahead[w - 1:w - 1 + n])
    edges = np.concatenate([[0], np.flatnonzero(low[1:] != low[:-1]) + 1, [n]]).tolist()
    found = []
    for s, end in zip(edges, edges[1:]):
        value = low[s]
        while s < end:
            at = s + int(np.argmax(h[s:s + w] == value))
            found.append((int(value), at, s, min(at, end - 1)))
            s = at + 1
    if len({v for v, *_ in found}) == len(found):
        return found, [], []
    later, both = np.zeros(n, bool), np.zeros(n, bool)
    part = narrowed([b.tobytes()], length)
    if part:
        data, starts, row, offset = suffixes([t for _, _, t in part], length)
        place = np.array([s for _, s, _ in part])[row] + offset
        previous, following = factors(data, starts, place, length)
        later[place], both[place] = previous >= length, (previous >= length) | (following >= length)
    first = ~later
    kept = [x for x in found if first[x[2]:x[3] + 1].any()]
    return kept, runs_of(both, np.arange(n), length), runs_of(later, np.arange(n), length)


def signed(v: list[int]) -> pa.Array:
    return pa.array(np.array(v, np.uint64).view(np.int64))


def scan(texts: DataFrame, length: int, first: bool) -> DataFrame:
    """(x, value, place, start, stop): a row per anchor (start null) and per interval that repeats inside a text (value null)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                x, v, at, s, e = [], [], [], [], []
                for key, t in zip(b.column(0).slice(lo, 512).to_pylist(), b.column(1).slice(lo, 512)):
                    got, both, later = anchors(np.frombuffer(t.as_buffer(), np.uint8), length)
                    for value, place, *_ in got:
                        x.append(key), v.append(value - 2**64 if value >= 2**63 else value), at.append(place), s.append(None), e.append(None)
                    for start, stop in later if first else both:
                        x.append(key), v.append(None), at.append(None), s.append(start), e.append(stop)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()), pa.array(v, pa.int64()), pa.array(at, pa.int64()), pa.array(s, pa.int64()), pa.array(e, pa.int64())], names=["x", "value", "place", "start", "stop"])
    return texts.select("x", "text").mapInArrow(run, "x binary, value long, place long, start long, stop long")


def contexts(texts: DataFrame, length: int) -> DataFrame:
    """(value, doc, x, start, bytes) of rows (x, doc, text, wanted): the bytes of all strings that have a wanted anchor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                c = b.slice(lo, 256)
                out = {"value": [], "doc": [], "x": [], "start": [], "bytes": []}
                for x, doc, t, wanted in zip(c.column(0).to_pylist(), c.column(1).to_pylist(), c.column(2), c.column(3).to_pylist()):
                    raw = t.as_buffer().to_pybytes()
                    want = set(wanted)
                    for value, _, s, e in anchors(np.frombuffer(raw, np.uint8), length)[0]:
                        value = value - 2**64 if value >= 2**63 else value
                        if value in want:
                            for k, y in zip(out, (value, doc, x, s, raw[s:e + length])):
                                out[k].append(y)
                yield pa.RecordBatch.from_arrays([pa.array(out["value"], pa.int64()), pa.array(out["doc"], pa.int64()), pa.array(out["x"], pa.binary()), pa.array(out["start"], pa.int64()), pa.array(out["bytes"], pa.binary())], names=list(out))
    return texts.select("x", "doc", "text", "wanted").mapInArrow(run, "value long, doc long, x binary, start long, bytes binary")


def suffix_order(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, lcp) of the suffixes at ``starts`` cut to ``length`` bytes; each start has that many bytes behind it.

    Prefix doubling: ranks of eight-byte words, then of pairs of ranks, up to the largest power of two; the last sort takes the ranks of the first and the
    last bytes, which overlap. ``lcp[k]`` is the common prefix of suffix k and the one before it in the order, from the kept ranks.
    """
    n = len(data)
    word = np.zeros(n, np.uint64)
    for k in range(8):
        word[:n - k] |= data[k:].astype(np.uint64) << np.uint64(56 - 8 * k)
    levels = [(8, ranked(word))]
    while 2 * levels[-1][0] <= length:
        h, rank = levels[-1]
        further = np.zeros(n, np.int64)
        further[:n - h] = rank[h:] + 1
        levels.append((2 * h, ranked((rank.astype(np.int64) << 32) | further)))
    h, rank = levels[-1]
    order = np.argsort((rank[starts].astype(np.int64) << 32) | rank[starts + length - h], kind="stable")
    p, q = starts[order][1:], starts[order][:-1]
    lcp = np.zeros(len(p), np.int64)
    for h, rank in reversed(levels):
        lcp += np.where(rank[np.minimum(p + lcp, n - 1)] == rank[np.minimum(q + lcp, n - 1)], h, 0)
    differ = word[np.minimum(p + lcp, n - 1)] ^ word[np.minimum(q + lcp, n - 1)]  # fewer than eight bytes are left
    bits = lambda x: np.frexp(x.astype(np.float64))[1]
    high, low = differ >> np.uint64(32), (differ >> np.uint64(8)) & np.uint64(0xFFFFFF)
    lcp += np.where(high > 0, (32 - bits(high)) // 8, 4 + (24 - bits(low)) // 8)
    return order, np.concatenate([[0], np.minimum(lcp, length)]) if len(starts) else np.zeros(0, np.int64)


def ranked(keys: np.ndarray) -> np.ndarray:
    """Dense ranks; equal keys have equal ranks."""
    order = np.argsort(keys)
    new = np.concatenate([[0], np.cumsum(keys[order][1:] != keys[order][:-1])]) if len(keys) else np.zeros(0, np.int64)
    out = np.empty(len(keys), np.int32)
    out[order] = new
    return out


def factor(position: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """Longest previous factor of each suffix, by rows of the suffix order: its longer match with the nearest suffix on either side that starts earlier.

    Each suffix starts from its neighbour and takes over the neighbour's own link while that starts no earlier, with the least lcp on the way: the stack of the
    sequential algorithm, followed by all suffixes at once. A match that has shrunk to nothing ends its chain.
    """
    def nearest(pos: np.ndarray, step: np.ndarray) -> np.ndarray:
        link, least = np.arange(len(pos)) - 1, step.copy()
        open_ = np.arange(len(pos))
        while True:
            open_ = open_[(link[open_] >= 0) & (least[open_] > 0)]
            open_ = open_[pos[link[open_]] >= pos[open_]]  # a suffix read twice is no match of itself
            if not len(open_):
                return np.where((link >= 0) & (least > 0), least, 0)
            via = link[open_]
            least[open_], link[open_] = np.minimum(least[open_], least[via]), link[via]

    up = nearest(position, lcp)
    down = nearest(position[::-1], np.concatenate([[0], lcp[1:][::-1]]))[::-1]
    return np.maximum(up, down)


def factors(data: np.ndarray, starts: np.ndarray, position: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Longest previous and longest next factor, cut to ``length``, of the suffixes at ``starts``, whose places in the corpus are ``position``."""
    order, lcp = suffix_order(data, starts, length)
    previous, following = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
    previous[order], following[order] = factor(position[order], lcp), factor(-position[order], lcp)
    return previous, following


def suffixes(rows: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all contexts, place in them, context, offset in it) of every suffix with ``length`` bytes."""
    data = np.frombuffer(b"".join(rows), np.uint8)
    sizes = np.array([len(r) for r in rows])
    counts = sizes - length + 1
    row = np.repeat(np.arange(len(rows)), counts)
    offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return data, np.repeat(np.cumsum(sizes) - sizes, counts) + offset, row, offset


def narrowed(rows: list[bytes], length: int) -> list[tuple[int, int, bytes]]:
    """(row, start, bytes) of the stretches whose strings of ``length`` have a fingerprint that occurs twice: all others match nothing and need no place in the order."""
    data, at, row, offset = suffixes(rows, length)
    _, ids, counts = np.unique(slices(prefixes(data), at, length), return_inverse=True, return_counts=True)
    twice = counts[ids] > 1
    out = []
    for r in np.unique(row[twice]).tolist():
        of = slice(*np.searchsorted(row, [r, r + 1]))
        out.extend((r, s, rows[r][s:e]) for s, e in runs_of(twice[of], offset[of], length))
    return out


def repeated(doc: list[int], x: list[bytes], start: list[int], rows: list[bytes], length: int, first: bool) -> Iterator[tuple[bytes, int, int]]:
    """Intervals (x, start, stop) whose strings occur elsewhere in the group, or only earlier if ``first``: longest previous, or next, factor of ``length``."""
    ids = {k: i for i, k in enumerate(sorted(set(zip(doc, x))))}
    part = narrowed(rows, length)
    if not part:
        return
    of = np.array([ids[doc[r], x[r]] for r, _, _ in part], np.int64)
    first_byte = np.array([start[r] + s for r, s, _ in part], np.int64)
    data, starts, row, offset = suffixes([b for _, _, b in part], length)
    previous, following = factors(data, starts, (of[row] << 40) | (first_byte[row] + offset), length)
    hit = previous >= length if first else (previous >= length) | (following >= length)
    for r in np.unique(row[hit]).tolist():
        at = slice(*np.searchsorted(row, [r, r + 1]))
        for s, e in runs_of(hit[at], offset[at], length):
            yield x[part[r][0]], int(first_byte[r]) + s, int(first_byte[r]) + e


def group_intervals(ctx: DataFrame, length: int, first: bool) -> DataFrame:
    """Intervals found among contexts that share an anchor; whole anchors stream through a task in order of their value."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def flush(rows: list[tuple]) -> pa.RecordBatch:
            got = list(repeated([r[1] for r in rows], [r[2] for r in rows], [r[3] for r in rows], [r[4] for r in rows], length, first)) if len(rows) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([g[i] for g in got], k) for i, k in enumerate((pa.binary(), pa.int64(), pa.int64()))], names=["x", "start", "stop"])

        for b in batches:
            for r in zip(*(b.column(i).to_pylist() for i in range(5))):
                if held and r[0] != held[-1][0] and size > CHUNK:
                    yield flush(held)
                    held, size = [], 0
                held.append(r)
                size += len(r[4])
        if held:
            yield flush(held)

    ordered = ctx.repartition("value").sortWithinPartitions("value")
    return ordered.mapInArrow(run, "x binary, start long, stop long")


def hot_intervals(ctx: DataFrame, length: int, first: bool) -> DataFrame:
    """The same for anchors with more than HOT contexts, which no task orders: fingerprints of the cut suffixes are the shuffle key, combined on the map side."""
    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                c = b.slice(lo, 256)
                data, at, row, offset = suffixes(c.column("bytes").to_pylist(), length)
                name, take = slices(prefixes(data), at, length), pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(name.view(np.int64)), c.column("doc").take(take), c.column("x").take(take), pa.array(c.column("start").to_numpy()[row] + offset)], names=["name", "doc", "x", "start"])
    n = ctx.select("doc", "x", "start", "bytes").mapInArrow(names, "name long, doc long, x binary, start long")
    at = F.struct("doc", "x", "start")
    ends = n.groupBy("name").agg(F.min(at).alias("lo"), F.max(at).alias("hi")).filter(F.col("lo") != F.col("hi"))
    hit = n.join(ends, "name")
    return (hit.filter(at != F.col("lo")) if first else hit).select("x", "start", (F.col("start") + length).alias("stop"))


def without_repeats(docs: DataFrame, length: int = 400, keep_first: bool = True, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Remove every byte covered by a string of ``length`` bytes that also starts elsewhere in the corpus, in the same document or another.

    With ``keep_first`` the first copy (by key, then place) stays and later ones go; without, all copies go. Strings are judged on the
    input, overlaps count, matches never cross documents. Equal texts are compared as wholes first, so one of them enters the search. Texts send
    their anchors (about one per 180 bytes), only anchors that occur twice send bytes, and suffixes are ordered among contexts that
    share an anchor.

    Returns all columns plus ``n_bytes``, ``n_removed``, ``n_spans`` (long) and ``kept`` (binary, since a cut may fall inside a character). Null text is
    empty. Null keys come first; rows that repeat key and text are copies of each other and, with ``keep_first``, all stay. A clashing input name keeps
    its column, the new one gets an underscore.
    """
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    x, doc = fresh(docs, "_x", "_doc")
    d = docs.withColumn(x, F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))).withColumn(doc, F.coalesce(F.col(key).cast("long"), F.lit(-(2**63))))
    copies = durable(d.groupBy(F.col(x).alias("x")).agg(F.min(doc).alias("first_doc"), F.count(F.lit(1)).alias("n_copies")).filter("n_copies > 1"))
    n_copies = copies.count()
    texts = d.filter(F.octet_length(text) >= length).select(F.col(x).alias("x"), F.col(doc).alias("doc"), F.col(text).alias("text"))
    again = copies.select("x", "first_doc")
    one = texts.join(sized(again, n_copies), "x", "left").filter(F.col("first_doc").isNull() | (F.col("doc") == F.col("first_doc"))).drop("first_doc")
    found = written(scan(one, length, keep_first), "anchors")
    anchor = found.filter(F.col("value").isNotNull()).select("x", "value", "place")
    at = F.struct("x", "place")
    often = anchor.groupBy("value").agg(F.min(at).alias("lo"), F.max(at).alias("hi"), F.count(F.lit(1)).alias("n")).filter(F.col("lo") != F.col("hi")).select("value", "n")
    pairs = written(anchor.join(often, "value").select("x", "value", "n"), "wanted")
    wanted = pairs.groupBy("x").agg(F.collect_set("value").alias("wanted"))  # at most the anchors of one text
    n_pairs = pairs.count()
    ctx = written(contexts(one.join(sized(wanted, n_pairs), "x"), length), "contexts")
    hot = durable(pairs.filter(F.col("n") > HOT).select("value").distinct())
    few = hot.count()  # at most one in HOT anchors
    spans = group_intervals(ctx.join(sized(hot, few), "value", "left_anti"), length, keep_first)
    if few:
        spans = spans.unionByName(hot_intervals(ctx.join(sized(hot, few), "value", "left_semi"), length, keep_first))
    local = found.filter(F.col("start").isNotNull()).select("x", "start", "stop")
    spans = written(spans.unionByName(local).groupBy("x").agg(F.collect_set(F.struct("start", "stop")).alias("spans")), "spans")
    n_spans = spans.agg(F.coalesce(F.sum(F.size("spans")), F.lit(0))).first()[0]
    s, fd, nb, nr, ns, kept = fresh(d, "_spans", "_first", "n_bytes", "n_removed", "n_spans", "kept")
    full = d.join(sized(spans.select(F.col("x").alias(x), F.col("spans").alias(s)), n_spans), x, "left").join(sized(again.select(F.col("x").alias(x), F.col("first_doc").alias(fd)), n_copies), x, "left")
    gone = F.col(fd).isNotNull() & (F.octet_length(text) >= length)
    if keep_first:
        gone = gone & (F.col(doc) != F.col(fd))
    full = full.withColumn(s, F.when(gone, F.array(F.struct(F.lit(0).cast("long").alias("start"), F.octet_length(text).cast("long").alias("stop")))).otherwise(F.col(s)))
    schema = T.StructType([*docs.schema.fields, *(T.StructField(c, T.LongType()) for c in (nb, nr, ns)), T.StructField(kept, T.BinaryType())])
    at_text = docs.columns.index(text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = ([], [], [], [])
            for t, sp in zip(b.column(at_text), b.column(b.num_columns - 1).to_pylist()):
                raw = t.as_buffer().to_pybytes() if t.is_valid else b""
                pieces, upto, removed, count = [], 0, 0, 0
                for i, v in enumerate(sorted((v["start"], v["stop"]) for v in sp or [])):
                    if i == 0 or v[0] > upto:  # a new maximal run
                        pieces.append(raw[upto:v[0]])
                        removed, count, upto = removed + v[1] - v[0], count + 1, v[1]
                    elif v[1] > upto:
                        removed, upto = removed + v[1] - upto, v[1]
                pieces.append(raw[upto:])
                for o, y in zip(out, (len(raw), removed, count, b"".join(pieces))):
                    o.append(y)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *(pa.array(o, pa.int64()) for o in out[:3]), pa.array(out[3], pa.binary())], names=schema.names)

    return full.select(*docs.columns, s).mapInArrow(cut, schema)
