"""Line dedup through sharded minimal perfect hashes."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spliceloom.session import work_dir, written

from .common import fresh
from .tokens import filesystem

SEPARATORS = b" \t\n\x0b\f\r"
GAMMA = 1.5        # bits per key on each level
SHARD_KEYS = 500_000
CACHE_BYTES = 96 << 20  # of shards that a Python worker keeps
HELD_LINES, HELD_BYTES = 200_000, 32 << 20  # lines, or bytes of text, that wait for one visit of the shards


def mixed(h: np.ndarray, level: int) -> np.ndarray:
    """One more independent hash of 64-bit hashes."""
    x = h ^ np.uint64((0x9E3779B97F4A7C15 * (2 * level + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: on each level the keys alone in their bit settle there.

    The place of a key is the number of set bits before its bit, over all levels. ``bits`` are the levels as 64-bit words,
    ``rank`` the set bits before each word. What a foreign key gets is arbitrary; fingerprints tell it apart.
    """

    def __init__(self, sizes: list[int], bits: np.ndarray) -> None:
        self.sizes, self.bits = sizes, bits
        self.firsts = np.cumsum([0, *sizes])[:-1] if sizes else np.zeros(0, np.int64)
        counts = np.bitwise_count(bits).astype(np.int64)
        self.rank = np.cumsum(counts) - counts

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, words, level = [], [], 0
        while len(keys):
            size = max(1, -(-int(len(keys) * GAMMA) // 64)) * 64
            at = (mixed(keys, level) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            words.append(np.packbits(alone.reshape(-1, 64), axis=1, bitorder="little").view("<u8").ravel())
            sizes.append(size)
            keys, level = keys[~alone[at]], level + 1
        return cls(sizes, np.concatenate(words) if words else np.zeros(0, np.uint64))

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, -1 where no level has its bit."""
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (size, first) in enumerate(zip(self.sizes, self.firsts)):
            if not len(left):
                break
            at = (mixed(keys[left], level) % np.uint64(size)).astype(np.int64) + int(first)
            word, bit = self.bits[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = word[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[left[hit]] = self.rank[at[hit] >> 6] + np.bitwise_count(below).astype(np.int64)
            left = left[~hit]
        return out


def build_shard(hi: np.ndarray, lo: np.ndarray, count: np.ndarray, last: np.ndarray) -> dict[str, np.ndarray]:
    """Arrays of one shard: levels, then fingerprint, count and last document at each key's place.

    Keys that share their high half with another one cannot have places of their own; all but the first of them stand in the ``more_`` arrays, sorted by high half.
    """
    hi, lo, count, last = (v[np.lexsort((lo, hi))] for v in (hi, lo, count, last))
    first = np.concatenate([[True], hi[1:] != hi[:-1]]) if len(hi) else np.zeros(0, bool)
    ph = PerfectHash.build(hi[first])
    order = np.argsort(ph.places(hi[first]))
    main = {k: v[first][order] for k, v in (("print", lo), ("count", count), ("last", last))}
    return {"sizes": np.array(ph.sizes, np.int64), "bits": ph.bits, **main, **{f"more_{k}": v[~first] for k, v in (("hi", hi), ("print", lo), ("count", count), ("last", last))}}


def probe(shard: dict[str, np.ndarray], hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(count, last document) of each key, count 0 for keys the shard lacks."""
    count, last = np.zeros(len(hi), np.int64), np.zeros(len(hi), np.int64)
    if len(shard["print"]):
        at = PerfectHash(shard["sizes"].tolist(), shard["bits"]).places(hi)
        ok = (at >= 0) & (shard["print"][at] == lo)
        count[ok], last[ok] = shard["count"][at[ok]], shard["last"][at[ok]]
        for i in np.flatnonzero(np.isin(hi, shard["more_hi"]) & ~ok).tolist():
            among = slice(*np.searchsorted(shard["more_hi"], [hi[i], hi[i] + np.uint64(1)])) if hi[i] != np.uint64(2**64 - 1) else slice(np.searchsorted(shard["more_hi"], hi[i]), None)
            for j in np.flatnonzero(shard["more_print"][among] == lo[i])[:1]:
                count[i], last[i] = shard["more_count"][among][j], shard["more_last"][among][j]
    return count, last


class ShardReader:
    """Probes of many lines at a time: the shards are visited in order, once for each call, and kept up to CACHE_BYTES."""

    def __init__(self, folder: str, paths: dict[int, str], n_shards: int) -> None:
        self.fs, self.paths, self.n_shards, self.reads = filesystem(folder)[0], paths, n_shards, 0
        self.cache: dict[int, dict[str, np.ndarray]] = {}

    def shard(self, s: int) -> dict[str, np.ndarray]:
        if s not in self.cache:
            with self.fs.open_input_file(self.paths[s]) as f:
                z = np.load(io.BytesIO(f.read()))
                new = {k: z[k] for k in z.files}
            self.reads += 1
            while self.cache and sum(a.nbytes for x in (*self.cache.values(), new) for a in x.values()) > CACHE_BYTES:
                self.cache.pop(next(iter(self.cache)))
            self.cache[s] = new
        return self.cache[s]

    def probe(self, hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        count, last = np.zeros(len(hi), np.int64), np.zeros(len(hi), np.int64)
        of = shard_numbers(hi, self.n_shards)
        wanted = [s for s in np.unique(of).tolist() if s in self.paths]
        for s in sorted(wanted, key=lambda s: (s not in self.cache, s)):  # those at hand first
            m = np.flatnonzero(of == s)
            count[m], last[m] = probe(self.shard(s), hi[m], lo[m])
        return count, last


def line_key(line: bytes) -> bytes:
    return line.strip(SEPARATORS).lower()  # bytes.lower touches A-Z only


def long_lines(text: bytes, least: int) -> Iterator[tuple[int, int, int]]:
    """(line number, hash high, hash low) of every line whose key has at least ``least`` code points."""
    for i, line in enumerate(text.split(b"\n")):
        if len(line) >= least:
            k = line_key(line)
            if len(k) >= least and (k.isascii() or len(k.decode("utf-8", "replace")) >= least):
                d = xxhash.xxh3_128_intdigest(k)
                yield i, d >> 64, d & (2**64 - 1)


def line_counts(docs: DataFrame, key: str, text: str, least: int) -> DataFrame:
    """(hi, lo, n_docs, last) of every distinct key: in how many documents, and the largest ``key`` among them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hi, lo, of = [], [], []
            for k, t in zip(b.column(0).to_pylist(), b.column(1)):
                if t.is_valid:
                    for h, l in {(h, l) for _, h, l in long_lines(t.as_buffer().to_pybytes(), least)}:
                        hi.append(h), lo.append(l), of.append(k)
            yield pa.RecordBatch.from_arrays([pa.array(np.array(hi, np.uint64).view(np.int64)), pa.array(np.array(lo, np.uint64).view(np.int64)), pa.array(of, pa.int64())], names=["hi", "lo", "of"])

    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(-(2**63))).alias("k"), F.col(text).alias("t")).mapInArrow(run, "hi long, lo long, of long")
    return rows.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("n_docs"), F.max("of").alias("last"))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", least_chars: int = 40, least_docs: int = 5) -> DataFrame:
    """Drop lines whose key stands in at least ``least_docs`` documents, except in the largest ``key`` that holds it.

    The key of a line is the line without separators at its ends and with A-Z lower-cased; keys under ``least_chars`` code points stay. Keys
    are 128-bit hashes: the high half addresses a minimal perfect hash, sharded so that a build holds SHARD_KEYS keys or so, and the low
    half is the stored fingerprint, 64 bits so that even 10^12 probes expect no false drop; keys with one high half stand in a short list beside the arrays. Each
    shard is built in one task and written to the shared folder. Documents never join lines: a task gathers the lines of many documents and then
    visits the shards in order, each once, with a bounded cache.

    Returns all columns with ``text`` cleaned, plus ``n_lines`` and ``n_dropped`` (long). A null or empty text is one empty line and stays as it
    is. A null key counts as smaller than any; rows that repeat a key are documents of their own when counted and keep the line
    together. Clashing column names keep the input's column.
    """
    spark = docs.sparkSession
    folder = work_dir(spark, "line-shards")
    often = written(line_counts(docs, key, text, least_chars).filter(F.col("n_docs") >= least_docs), "line-keys")
    n_shards = max(1, -(-often.count() // SHARD_KEYS))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid
        parts: dict[str, list] = {}
        t = pa.Table.from_batches(list(batches), pa.schema([("hi", pa.int64()), ("lo", pa.int64()), ("n_docs", pa.int64()), ("last", pa.int64()), ("shard", pa.int32())]))
        got = {c: t.column(c).to_numpy().copy() for c in t.column_names}
        fs, root = filesystem(folder)
        for s in np.unique(got["shard"]):
            at = got["shard"] == s
            arrays = build_shard(got["hi"][at].view(np.uint64), got["lo"][at].view(np.uint64), got["n_docs"][at], got["last"][at])
            fs.create_dir(root, recursive=True)
            path = f"{root}/shard-{s:06d}-{uuid.uuid4().hex}"
            with fs.open_output_stream(path, compression=None) as out:
                np.savez(out, **arrays)
            parts.setdefault("shard", []).append(int(s)), parts.setdefault("path", []).append(path)
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(parts["shard"], pa.int32()), pa.array(parts["path"], pa.string())], names=["shard", "path"])

    keyed = often.withColumn("shard", F.pmod("hi", F.lit(n_shards)).cast("int"))
    manifest = written(keyed.repartition(n_shards, "shard").mapInArrow(build, "shard int, path string"), "line-manifest")
    paths = {r["shard"]: r["path"] for r in manifest.collect()}  # one row per shard
    n_lines, n_dropped = fresh(docs, "n_lines", "n_dropped")
    shard_of = fresh(docs, "_key")[0]
    work = docs.withColumn(shard_of, F.coalesce(F.col(key).cast("long"), F.lit(-(2**63))))
    schema = T.StructType([*docs.schema.fields, T.StructField(n_lines, T.LongType()), T.StructField(n_dropped, T.LongType())])
    at_text = docs.columns.index(text)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = ShardReader(folder, paths, n_shards)

        def flush(held: list[pa.RecordBatch], at: list[tuple[int, int, int, int, int]]) -> Iterator[pa.RecordBatch]:
            of, row, line = (np.array([x[i] for x in at], np.int64) for i in range(3))
            hi, lo = (np.array([x[i] for x in at], np.uint64) for i in (3, 4))
            count, last = reader.probe(hi, lo)
            keys = [b.column(b.num_columns - 1).to_numpy() for b in held]
            own = np.array([keys[o][r] for o, r in zip(of.tolist(), row.tolist())], np.int64)
            gone = (count >= least_docs) & (own != last)
            drop: dict[tuple[int, int], set] = {}
            for o, r, i in zip(of[gone].tolist(), row[gone].tolist(), line[gone].tolist()):
                drop.setdefault((o, r), set()).add(i)
            for o, b in enumerate(held):
                new, total = [], []
                for r, v in enumerate(b.column(at_text)):
                    t = v.as_buffer().to_pybytes() if v.is_valid else None
                    total.append((t or b"").count(b"\n") + 1)
                    new.append(t.decode() if t is not None and (o, r) not in drop else t if t is None else b"\n".join(x for i, x in enumerate(t.split(b"\n")) if i not in drop[o, r]).decode())
                cols = [pa.array(new, pa.string()) if i == at_text else b.column(i) for i in range(b.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(total, pa.int64()), pa.array([len(drop.get((o, r), ())) for r in range(b.num_rows)], pa.int64())], names=schema.names)

        held, at, size = [], [], 0
        for whole in batches:
            for lo in range(0, whole.num_rows, 512):
                b = whole.slice(lo, 512)
                for r, v in enumerate(b.column(at_text)):
                    if v.is_valid:
                        t = v.as_buffer().to_pybytes()
                        size += len(t)
                        at.extend((len(held), r, i, h, l) for i, h, l in long_lines(t, least_chars))
                held.append(b)
                if len(at) > HELD_LINES or size > HELD_BYTES:
                    yield from flush(held, at)
                    held, at, size = [], [], 0
        if held:
            yield from flush(held, at)

    return work.mapInArrow(clean, schema)


def shard_numbers(hi: np.ndarray, n_shards: int) -> np.ndarray:
    """The shard of each key: its high half, as a signed number, modulo the number of shards."""
    return np.mod(hi.view(np.int64), np.int64(n_shards))
