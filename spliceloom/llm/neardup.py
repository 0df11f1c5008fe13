"""Near-duplicate documents by HyperMinHash."""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spliceloom.session import durable, written

from .common import fresh, numbered, sized
from .components import components
from .lines import mixed

WIDTH = 5
BANDS, BUCKETS = 32, 4   # one band is one hash function that deals shingles to four buckets
MANTISSA = 10            # bits kept after the leading one
EMPTY = 0xFFFF
COLD = 64                # members up to which a band's pairs are listed
BLOCK = 192              # members of a block of a larger group
EXACT_BELOW = 64         # sets up to this size skip the estimate
MISS = 1e-12             # most that the estimate may lose of pairs at the threshold

_rng = np.random.default_rng(20240229)
FACTORS = _rng.integers(0, 2**31, BANDS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
SHIFTS = _rng.integers(0, 2**32, BANDS, dtype=np.uint32)


def shingle_set(text: bytes | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the five-word shingles of a whole text; fewer words are one shingle."""
    w = (text or b"").lower().split()  # bytes: A-Z, and the six ASCII separators
    if len(w) < WIDTH:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(w), 1)], np.uint64) if w else np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w))
    n = len(w) - WIDTH + 1
    x = h[:n]
    for i in range(1, WIDTH):
        x = mixed(x, i) + h[i:n + i]
    return np.unique(mixed(x, 9))


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """HyperMinHash registers, (sets, BANDS * BUCKETS) of 16 bits: leading zeros, then MANTISSA bits, of each bucket's minimum.

    The two top bits of a band's hash name the bucket; flipping them brings a bucket to the front, so that its minimum is a plain one.
    """
    out = np.full((len(sets), BANDS, BUCKETS), EMPTY, np.uint16)
    for at, s in enumerate(sets):
        low = np.full((BUCKETS, BANDS), 2**32 - 1, np.uint32)
        x = (s >> np.uint64(32)).astype(np.uint32)
        for first in range(0, len(x), 4096):
            h = x[first:first + 4096, None] * FACTORS + SHIFTS
            for b in range(BUCKETS):
                low[b] = np.minimum(low[b], (h ^ np.uint32(b << 30)).min(axis=0))
        out[at] = compressed(low).T
    return out.reshape(len(sets), BANDS * BUCKETS)


def compressed(low: np.ndarray) -> np.ndarray:
    bits = np.frexp(low.astype(np.float64))[1].astype(np.int64)  # bit length
    zeros = 30 - bits
    mantissa = ((low.astype(np.int64) << np.maximum(zeros, 0)) >> (29 - MANTISSA)) & ((1 << MANTISSA) - 1)
    return np.where(low >= 2**30, EMPTY, (zeros << MANTISSA) | mantissa).astype(np.uint16)


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(Jaccard estimate, buckets used) of pairs of register rows, less the matches that compression makes by chance.

    Two minima of unlike sets fall in one register cell with probability about l1 * l2 / (l1 + l2)^2 times the relative width of a cell, which is 2^-MANTISSA
    / ln 2 on average, where l are the bucket loads.
    """
    used = (a != EMPTY) | (b != EMPTY)
    k = np.maximum(used.sum(axis=1), 1)
    share = ((a == b) & used).sum(axis=1) / k
    chance = na * nb / (na + nb).astype(np.float64) ** 2 * 2.0 ** -MANTISSA / np.log(2)
    return np.maximum(0.0, (share - chance) / (1 - chance)), k


def least_equal(t: float) -> np.ndarray:
    """For each number of used buckets, the largest cut that a pair with Jaccard ``t`` falls below with probability MISS at most (exact binomial)."""
    out = []
    for k in range(BANDS * BUCKETS + 1):
        below, cut = 0.0, 0
        while cut <= k and (below := below + comb(k, cut) * t ** cut * (1 - t) ** (k - cut)) <= MISS:
            cut += 1
        out.append(cut)
    return np.array(out)


def binary(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def signatures(docs: DataFrame) -> DataFrame:
    """(doc, text_key, print, n, regs) of rows (doc, text_key, text): the 128-bit fingerprint of the set, its size and registers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                c = b.slice(lo, 512)
                sets = [shingle_set(t.as_buffer().to_pybytes() if t.is_valid else None) for t in c.column(2)]
                yield pa.RecordBatch.from_arrays([c.column(0), c.column(1), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64()), binary(registers(sets))],
                                                 names=["doc", "text_key", "print", "n", "regs"])
    return docs.select("doc", "text_key", "text").mapInArrow(run, "doc long, text_key long, print binary, n long, regs binary")


def bands(nodes: DataFrame) -> DataFrame:
    """(band, print, n): one row per node and band; the key is the band's four registers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 2048):
                c = b.slice(lo, 2048)
                keys = np.frombuffer(b"".join(c.column(2).to_pylist()), "<u8").reshape(c.num_rows, BANDS)
                key = np.stack([mixed(keys[:, i], i) for i in range(BANDS)], axis=1).view(np.int64).ravel()
                take = pa.array(np.repeat(np.arange(c.num_rows), BANDS))
                yield pa.RecordBatch.from_arrays([pa.array(key), c.column(0).take(take), c.column(1).take(take)], names=["band", "print", "n"])
    return nodes.select("print", "n", "regs").mapInArrow(run, "band long, print binary, n long")


def estimated(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) with at least ``least_equal`` buckets alike; small sets always pass."""
    least = least_equal(percent / 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            if x.num_rows:
                ra, rb = (np.frombuffer(b"".join(x.column(c).to_pylist()), np.uint16).reshape(x.num_rows, -1) for c in ("ra", "rb"))
                na, nb = (x.column(c).to_numpy() for c in ("na", "nb"))
                j, k = estimate(ra, rb, na, nb)
                ok = (j * k >= least[k] - 0.5) | (np.minimum(na, nb) <= EXACT_BELOW)  # the correction takes off less than 0.05 of a bucket
                yield x.select(["a", "b"]).filter(pa.array(ok))
    side = lambda c: nodes.select(F.col("print").alias(c), F.col("n").alias(f"n{c}"), F.col("regs").alias(f"r{c}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "ra", "rb").mapInArrow(run, "a binary, b binary")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets reach the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            ok = []
            for sa, sb in zip(x.column("sa"), x.column("sb")):
                a, b = (np.frombuffer(s.as_buffer(), np.uint64) for s in (sa, sb))
                both = len(np.intersect1d(a, b, assume_unique=True))
                ok.append(100 * both >= percent * (len(a) + len(b) - both))
            yield x.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))
    side = lambda c: sets.select(F.col("print").alias(c), F.col("hashes").alias(f"s{c}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sa", "sb").mapInArrow(run, "a binary, b binary")


def block_links(x: pa.Table, percent: int) -> pa.Table:
    """Links that join different components among the rows of two blocks (print, comp, block, hashes), by exact counts."""
    sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in x.column("hashes").combine_chunks()]
    comp, prints, block = x.column("comp").to_pylist(), x.column("print").to_pylist(), x.column("block").to_numpy()
    n = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), n)
    _, ids, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts >= 2
    column = np.cumsum(shared) - 1
    keep = shared[ids]
    owner, col = owner[keep], column[ids[keep]]
    both = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(col, kind="stable")
    owner, col = owner[order], col[order]
    for lo in range(0, int(shared.sum()), 8192):
        at = slice(*np.searchsorted(col, [lo, lo + 8192]))
        m = np.zeros((len(sets), 8192), np.float32)
        m[owner[at], col[at] - lo] = 1
        both += m @ m.T
    linked = 100 * both >= percent * (n[:, None] + n[None, :] - both) - 1e-3
    if block.min() != block.max():
        linked &= block[:, None] != block[None, :]
    root = {c: c for c in comp}

    def find(c):
        while root[c] != c:
            root[c] = c = root[root[c]]
        return c

    a, b = [], []
    for i, j in zip(*np.nonzero(np.triu(linked, 1))):
        ci, cj = find(comp[i]), find(comp[j])
        if ci != cj:
            root[ci] = cj
            a.append(prints[i]), b.append(prints[j])
    return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})


def large_group_links(hot: DataFrame, comps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All links between different components inside the groups that large bands form.

    ``hot``: (a, b) with b in a large band whose hub is a. Members are cut into blocks by hash, those of the group's largest component apart; every pair
    of blocks but two of that component is one task, which compares all members exactly and returns only links that join components.
    """
    group = components(hot).select(F.col("node").alias("print"), F.col("root").alias("grp"))
    member = group.join(comps.select(F.col("node").alias("print"), F.col("root")), "print", "left").select("print", "grp", F.coalesce("root", "print").alias("comp"))
    sizes = member.groupBy("grp", "comp").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("grp").agg(F.max_by("comp", F.struct("n", "comp")).alias("main"), F.max("n").alias("n_main"), F.sum("n").alias("n_all"), F.count(F.lit(1)).alias("n_comps")).filter("n_comps > 1")
    m = member.join(main, "grp").withColumn("nm", F.ceil(F.col("n_main") / BLOCK)).withColumn("no", F.ceil((F.col("n_all") - F.col("n_main")) / BLOCK))
    m = m.withColumn("block", F.when(F.col("comp") == F.col("main"), F.pmod(F.xxhash64("print"), F.col("nm"))).otherwise(F.col("nm") + F.pmod(F.xxhash64("print"), F.col("no"))))
    other = F.sequence(F.when(F.col("comp") == F.col("main"), F.col("nm")).otherwise(F.lit(0).cast("long")), F.col("nm") + F.col("no") - 1)
    dealt = m.select("grp", "print", "comp", "block", F.explode(other).alias("o")).select("grp", "print", "comp", "block", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"))
    full = dealt.join(sets, "print").select("grp", "i", "j", "print", "comp", "block", "hashes")
    return full.groupBy("grp", "i", "j").applyInArrow(lambda x: block_links(x, percent), "a binary, b binary")


def open_groups(hot: DataFrame, comps: DataFrame) -> bool:
    """Whether any hub and member of a large band are still in different components."""
    root = lambda c: comps.select(F.col("node").alias(c), F.col("root").alias(f"_{c}"))
    both = hot.join(root("a"), "a", "left").join(root("b"), "b", "left")
    return not both.filter(F.coalesce("_a", "a") != F.coalesce("_b", "b")).isEmpty()


def near_duplicates(docs: DataFrame, percent: int = 85, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id, kept) per row: components of documents with 100 * intersection >= percent * union of five-word shingle sets.

    Documents with equal sets are one node, however many copies there are. Nodes are banded on groups of four HyperMinHash registers (a pair
    at 0.85 shares none of the 32 bands with probability 6e-11, at 0.80 5e-8). Bands of up to COLD nodes list their pairs, larger ones pair each node with the
    smallest; pairs pass the collision-corrected estimate, then an exact test on full sets. Groups that large bands form are then completed: all their
    pairs across components are compared exactly, block by block, without being listed.

    component_id is the smallest key reachable; kept is true for the rows with that key. Null or empty texts have 0 shingles and a
    component of their own; null keys count as larger than all, and a component of only null keys has a null id and keeps all
    its rows. Only the two named columns are read. An empty table gives no rows.
    """
    d = docs.select(F.col(key).cast("long").alias("doc"), F.xxhash64(text).alias("text_key"), F.col(text).alias("text"))
    rows = written(signatures(d), "signatures")
    nodes = written(rows.filter("n > 0").groupBy("print").agg(F.min("doc").alias("doc"), F.min("text_key").alias("text_key"), F.first("n").alias("n"), F.first("regs").alias("regs")), "nodes")
    band = bands(nodes)
    multi = written(band.join(band.groupBy("band").agg(F.count(F.lit(1)).alias("size"), F.min("print").alias("hub")).filter("size > 1"), "band"), "bands")
    few = multi.filter(F.col("size") <= COLD)
    left, right = (few.select("band", F.col("print").alias(c), F.col("n").alias(f"n{c}")) for c in ("a", "b"))
    listed = left.join(right, "band").filter((F.col("a") < F.col("b")) & (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))).select("a", "b")
    hot = durable(multi.filter((F.col("size") > COLD) & (F.col("print") != F.col("hub"))).select(F.col("hub").alias("a"), F.col("print").alias("b")).distinct())
    near = durable(estimated(listed.unionByName(hot).distinct(), nodes, percent))
    used = near.select(F.col("a").alias("print")).union(near.select("b")).union(hot.select("a")).union(hot.select("b")).distinct()
    wanted = durable(nodes.join(used, "print", "left_semi").select(F.col("text_key").alias("_k")).distinct())
    picked = d.join(sized(wanted, wanted.count()), F.col("text_key") == F.col("_k"), "left_semi")

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                sets = [shingle_set(t.as_buffer().to_pybytes() if t.is_valid else None) for t in b.column(0).slice(lo, 256)]
                yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["print", "hashes"])

    sets = written(picked.select("text").mapInArrow(full, "print binary, hashes binary").groupBy("print").agg(F.first("hashes").alias("hashes")), "sets")
    links = durable(verified(near, sets, percent))
    comps = components(links)
    if open_groups(hot, comps):
        more = durable(large_group_links(hot, comps, sets, percent))
        if not more.isEmpty():
            comps = components(links.unionByName(more))
    named = nodes.select("print", "doc").join(comps.withColumnRenamed("node", "print"), "print", "left").withColumn("root", F.coalesce("root", "print"))
    least = named.groupBy("root").agg(F.min("doc").alias("component"))
    label = named.join(least, "root").select("print", "component")
    k, n, c, kept = key, "n_shingles", "component_id", "kept"
    out = rows.select("doc", "n", F.when(F.col("n") > 0, F.col("print")).alias("print")).join(label, "print", "left")
    out = out.withColumn("component", F.when(F.col("n") == 0, F.col("doc")).otherwise(F.col("component")))
    return out.select(F.col("doc").alias(k), F.col("n").alias(n), F.col("component").alias(c), F.col("doc").eqNullSafe(F.col("component")).alias(kept))


def without_near_duplicates(docs: DataFrame, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of ``near_duplicates``, with all its columns: the smallest key, nulls last, then the first row.

    Groups are formed by row, so a null or repeated key neither saves a copy nor takes another row along. Rows without a word all stay.
    """
    row, name = fresh(docs, "_row", "_gone")
    rows = numbered(docs, row)
    group = durable(near_duplicates(rows, percent, row, text).select(F.col(row).alias(name), F.col("component_id").alias("g")))
    order = F.struct(F.col(key).isNull(), F.col(key), F.col(row))
    best = group.join(rows.select(key, row), F.col(row) == F.col(name)).groupBy("g").agg(F.min_by(name, order).alias(name))
    gone = durable(group.select(name).join(best, name, "left_anti"))
    return rows.join(sized(gone, gone.count()), F.col(row) == F.col(name), "left_anti").drop(row)
