"""Alignment of two tokenizers over the same bytes, with corpus-wide counts of linked ids."""

from __future__ import annotations

import hashlib
import io
import json
import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spliceloom.session import work_dir

from .common import fresh
from .tokens import byte_bpe, filesystem

CHUNK = 1 << 20          # bytes of text aligned at once; a longer text is a chunk of its own
HELD = 2_000_000         # distinct pairs that a task counts before it hands them on
SHARD_PAIRS = 2_000_000  # pairs of a shard of the count table
LOOKUPS = 8_000_000      # pairs of documents looked up in one visit of the shards
CACHE_BYTES = 96 << 20   # of shards that a Python worker keeps
#: The word pattern of the byte-level vocabulary, a fixed value of its pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Beyond these code points libraries may know other versions of the character classes.
UNSURE = re.compile("[^\x00-\u024f\u2000-\u206f]")

Vocabulary = tuple[Callable[[list[str]], list], list[bytes]]


def byte_level_letters() -> dict[str, int]:
    """The byte behind each letter of a byte-level vocabulary: printable Latin-1 stands for itself, other bytes follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def byte_level(path: str) -> Vocabulary:
    """(encoder of texts with a space in front, bytes of each id) of a byte-level BPE file.

    Ids are merge ranks, so texts of well-known code points go through a faster encoder built from the same file; other texts go through the tokenizers library.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    letter = byte_level_letters()
    special = {t["id"] for t in model["added_tokens"]}
    vocab = {i: bytes(letter[c] for c in s) for s, i in model["model"]["vocab"].items() if i not in special}
    entries = [vocab.get(i, b"") for i in range(max(*vocab, *special) + 1)]
    fast = tiktoken.Encoding("byte level", pat_str=PATTERN, mergeable_ranks={b: i for i, b in vocab.items()}, special_tokens={})
    exact = byte_bpe(path)
    return lambda texts: [fast.encode_to_numpy(" " + t) if not UNSURE.search(t) else np.array(exact([" " + t])[0], np.uint32) for t in texts], entries


def pieces(path: str) -> Vocabulary:
    """(encoder of texts, which puts a space in front itself, bytes of each id) of a sentencepiece model."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    entry = lambda i: bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()
    return lambda texts: [np.array(x, np.uint32) for x in sp.encode(texts, num_threads=1)], [entry(i) for i in range(len(sp))]


class Side:
    """Flattened tokens of one tokenizer over a chunk: ids, document of each, and byte offset of each end inside its document."""

    def __init__(self, ids: list[np.ndarray], entries: pa.Array, sizes: np.ndarray) -> None:
        offsets = np.cumsum([0, *map(len, ids)])
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.uint32), *ids]).astype(np.int32)))
        self.n = np.diff(offsets)
        self.flat = lists.flatten()
        self.doc = pc.list_parent_indices(lists)
        width = pa.array(sizes).take(self.flat)
        self.total = pc.cumulative_sum(width).to_numpy()   # over the chunk
        upto = np.concatenate([[0], self.total])[offsets]  # before each document
        self.end = pc.subtract(pa.array(self.total), pa.array(upto).take(self.doc))
        self.upto = upto
        self.text = entries.take(self.flat)                # bytes of all tokens, one after another

    def data(self) -> memoryview:
        return memoryview(self.text.buffers()[2] or b"").cast("B")[:int(self.upto[-1])]


def faithful(raw: list[bytes], sides: list[Side]) -> np.ndarray:
    """Which documents both tokenizers give back byte by byte; documents without text never do."""
    whole = b"".join(raw)
    ok = np.array([len(r) > 1 for r in raw])
    starts = np.cumsum([0, *map(len, raw)])
    for s in sides:
        data = s.data()
        if not (np.array_equal(s.upto, starts) and data == whole):
            ok &= np.array([data[a:b] == r for r, a, b in zip(raw, s.upto, s.upto[1:])])
    return ok


def digits(n: int, marks: str) -> list[bytes]:
    return [f"{i}{m}".encode() for m in marks for i in range(n)]


class Aligner:
    """Two tokenizers, loaded once per worker."""

    loaded: dict[tuple[str, str], Aligner] = {}

    def __init__(self, path_a: str, path_b: str) -> None:
        (self.encode_a, a), (self.encode_b, b) = byte_level(path_a), pieces(path_b)
        self.n_a, self.n_b = len(a), len(b)
        self.entries = [pa.array(x, pa.binary()) for x in (a, b)]
        self.sizes = [np.array([len(y) for y in x], np.int64) for x in (a, b)]
        # every id as text with the mark behind it: "," inside a side, "|" between the sides, ";" between groups
        self.marked = pa.array([*digits(self.n_a, ",|"), *digits(self.n_b, ",;")], pa.binary())

    @classmethod
    def of(cls, path_a: str, path_b: str) -> Aligner:
        key = (path_a, path_b)
        if key not in cls.loaded:
            cls.loaded[key] = cls(*key)
        return cls.loaded[key]

    def chunk(self, texts: list[str | None], digest: bool) -> tuple[pa.Array, ...]:
        """(n_a, n_b, n_groups, n_links, groups, pairs, times) of each text; ``pairs`` are distinct linked ids a * n_b + b, ``times`` their links."""
        texts = [t or "" for t in texts]
        raw = [b" " + t.encode() for t in texts]
        ids_a, ids_b = self.encode_a(texts), self.encode_b(texts)
        none = np.zeros(0, np.uint32)
        sides = [Side([i if r != b" " else none for i, r in zip(ids, raw)], e, s) for ids, e, s in zip((ids_a, ids_b), self.entries, self.sizes)]
        ok = faithful(raw, sides)
        if not ok.all():
            sides = [Side([i if y else none for i, y in zip(ids, ok)], e, s) for ids, e, s in zip((ids_a, ids_b), self.entries, self.sizes)]
        a, b = sides
        # group cuts: ends that both sides have, by a hash join on (document, end)
        left = pa.table({"doc": a.doc, "end": a.end, "ia": pa.array(np.arange(len(a.flat)))})
        right = pa.table({"doc": b.doc, "end": b.end, "ib": pa.array(np.arange(len(b.flat)))})
        cut = left.join(right, ["doc", "end"], join_type="inner", use_threads=False).sort_by("ia")
        ia, ib = cut.column("ia").to_numpy(), cut.column("ib").to_numpy()
        n_groups = np.bincount(cut.column("doc").to_numpy(), minlength=len(texts))
        # links: one for each piece between neighbouring ends of either side
        size = int(a.total[-1]) if len(a.total) else 0
        at_a, at_b = np.zeros(size + 1, bool), np.zeros(size + 1, bool)
        at_a[a.total], at_b[b.total] = True, True
        piece = np.flatnonzero(at_a | at_b)
        ka, kb = np.cumsum(at_a)[piece] - at_a[piece], np.cumsum(at_b)[piece] - at_b[piece]
        of, fa, fb = a.doc.to_numpy(), a.flat.to_numpy().astype(np.int64), b.flat.to_numpy().astype(np.int64)
        doc = of[ka]
        n_links = np.bincount(doc, minlength=len(texts))
        pairs = pa.table({"doc": doc, "pair": fa[ka] * self.n_b + fb[kb]}).group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
        order = np.lexsort((pairs.column("pair").to_numpy(), pairs.column("doc").to_numpy()))
        bounds = pa.array(np.concatenate([[0], np.cumsum(np.bincount(pairs.column("doc").to_numpy(), minlength=len(texts)))]), pa.int32())
        lists = [pa.ListArray.from_arrays(bounds, pa.array(pairs.column(c).to_numpy()[order].astype(k))) for c, k in (("pair", np.int64 if self.n_a * self.n_b >= 2**31 else np.int32), ("count_all", np.int32))]
        groups = self.groups(fa, fb, ia, ib, a.n, b.n, digest)
        return (*(pa.array(x.astype(np.int64)) for x in (a.n, b.n, n_groups, n_links)), groups, *lists)

    def groups(self, fa: np.ndarray, fb: np.ndarray, ia: np.ndarray, ib: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, digest: bool) -> pa.Array:
        """``a1,a2|b1;a3|b2,b3`` of each document: tokens of both sides dealt to their places in one flat array, whose bytes are the texts."""
        last_a, last_b = np.zeros(len(fa), bool), np.zeros(len(fb), bool)
        last_a[ia], last_b[ib] = True, True
        g_a, g_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        before_b = np.concatenate([[0], ib + 1])[g_a] if len(fa) else g_a   # tokens of b in earlier groups
        until_a = (ia + 1)[g_b] if len(fb) else g_b                         # tokens of a up to this group's end
        code = np.empty(len(fa) + len(fb), np.int64)
        code[np.arange(len(fa)) + before_b] = fa + last_a * self.n_a
        code[np.arange(len(fb)) + until_a] = fb + last_b * self.n_b + 2 * self.n_a
        text = self.marked.take(pa.array(code))
        offset = np.frombuffer(text.buffers()[1], np.int32)[:len(code) + 1] if len(code) else np.zeros(1, np.int32)
        data = memoryview(text.buffers()[2] or b"")
        bounds = offset[np.concatenate([[0], np.cumsum(n_a + n_b)])]
        cut = [data[x:y - 1] if y > x else None for x, y in zip(bounds.tolist(), bounds[1:].tolist())]
        return pa.array(["" if c is None else hashlib.sha256(c).hexdigest() if digest else bytes(c).decode() for c in cut], pa.string())


def chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about CHUNK bytes."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    lo, held = 0, 0
    for i, n in enumerate(size.tolist()):
        if held and held + n > CHUNK:
            yield lo, i
            lo, held = i, 0
        held += n + 1
    if lo < len(size):
        yield lo, len(size)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, n): in how many rows each pair stands. Tasks count in memory, Spark adds the partial counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def merged() -> pa.Table:
            return pa.concat_tables(held).group_by("pair", use_threads=False).aggregate([("n", "sum")]).rename_columns(["pair", "n"])

        size = 0
        for b in batches:
            flat = b.column(0).flatten()
            held.append(pa.table({"pair": flat, "n": pa.array(np.ones(len(flat), np.int64))}).group_by("pair", use_threads=False).aggregate([("n", "sum")]).rename_columns(["pair", "n"]))
            size += held[-1].num_rows
            if size > 2 * HELD:
                held = [merged()]
                size = held[0].num_rows
                if size > HELD:
                    yield from held[0].to_batches()
                    held, size = [], 0
        if held:
            yield from merged().to_batches()

    kind = rows.schema["pairs"].dataType.elementType
    schema = T.StructType([T.StructField("pair", kind), T.StructField("n", T.LongType())])
    return rows.select("pairs").mapInArrow(run, schema).groupBy("pair").agg(F.sum("n").alias("n"))


def count_shards(counts: DataFrame, n_b: int) -> list[tuple[int, int, str]]:
    """Write (pair, n, whether n is the highest of its a) as sorted shards in the shared folder; (first, last, path) of each."""
    best = counts.groupBy(F.expr(f"pair div {n_b}").alias("a")).agg(F.max("n").alias("most"))  # a vocabulary at most
    n_shards = max(1, -(-counts.count() // SHARD_PAIRS))
    full = counts.withColumn("a", F.expr(f"pair div {n_b}")).join(best, "a").select(F.col("pair").cast("long"), "n", (F.col("n") == F.col("most")).alias("top"))
    folder = work_dir(counts.sparkSession, "pair-counts")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(batches), pa.schema([("pair", pa.int64()), ("n", pa.int64()), ("top", pa.bool_())]))  # about SHARD_PAIRS rows
        if t.num_rows:
            fs, root = filesystem(folder)
            fs.create_dir(root, recursive=True)
            path = f"{root}/{uuid.uuid4().hex}"
            with fs.open_output_stream(path, compression=None) as out:
                np.savez(out, **{c: t.column(c).to_numpy() for c in t.column_names})
            pair = t.column("pair")
            yield pa.RecordBatch.from_arrays([pa.array([pair[0].as_py()]), pa.array([pair[-1].as_py()]), pa.array([path])], names=["first", "last", "path"])

    manifest = full.repartitionByRange(n_shards, "pair").sortWithinPartitions("pair").mapInArrow(write, "first long, last long, path string")
    return sorted((r["first"], r["last"], r["path"]) for r in manifest.collect())  # a row for each SHARD_PAIRS pairs


def aligned(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """Align the tokens of a byte-level BPE (A, over a space and the text) with those of a sentencepiece model (B) on whole texts.

    Returns per row: the key, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` (long) and ``groups`` (text, or with ``digest`` its
    SHA-256). Where tokens of both sides end at one byte a group ends; a link is a pair of tokens that share bytes. The count of an id pair is
    the number of rows that hold it linked; ``n_best`` are links whose count is the highest of their A id, ``count_sum`` is over links.

    Tokens are flat Arrow arrays with parent indices; ends are segmented cumulative sums of entry lengths, group cuts a hash join on (document,
    end), pairs a group_by. Texts are encoded once: pairs wait in the shared folder. Spark adds the partial counts; the count table is sorted shards there,
    visited in order once for every LOOKUPS pairs of a task, so neither the driver nor a task ever holds all of it.

    Texts that are null or empty, or whose joined token bytes differ from a space and the text on either side, have zeros and an empty string. Null and repeated
    keys are rows like any other. Only the two named columns are read, so no name can clash. A text must fit in a task; an empty table gives no rows.
    """
    spark = docs.sparkSession
    aligner = Aligner.of(path_a, path_b)
    n_b = aligner.n_b
    kind = "long" if aligner.n_a * n_b >= 2**31 else "int"

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["k", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"]
        for b in batches:
            for lo, hi in chunks(b.column(1)):
                part = b.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([part.column(0), *Aligner.of(path_a, path_b).chunk(part.column(1).to_pylist(), digest)], names=names)

    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(align, T.StructType([T.StructField("k", docs.schema[key].dataType), *T.StructType.fromDDL(f"n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<{kind}>, times array<int>")]))
    path = work_dir(spark, "aligned")
    rows.write.option("compression", "zstd").parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    at = work_dir(spark, "pair-totals")
    pair_counts(rows).write.parquet(at)
    shards = count_shards(spark.read.parquet(at), n_b)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = filesystem(path)
        cache: dict[str, dict[str, np.ndarray]] = {}

        def shard(p: str) -> dict[str, np.ndarray]:
            if p not in cache:
                with fs.open_input_file(p) as f:
                    z = np.load(io.BytesIO(f.read()))
                    new = {c: z[c] for c in z.files}
                while cache and sum(x.nbytes for s in (*cache.values(), new) for x in s.values()) > CACHE_BYTES:
                    cache.pop(next(iter(cache)))
                cache[p] = new
            return cache[p]

        def flush(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            pairs = t.column(5).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            times = t.column(6).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            doc = pc.list_parent_indices(t.column(5)).to_numpy()
            n, top = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), bool)
            for first, last, p in shards:
                m = slice(None) if len(shards) == 1 else np.flatnonzero((pairs >= first) & (pairs <= last))
                if len(pairs[m]):
                    s = shard(p)
                    at = np.searchsorted(s["pair"], pairs[m])
                    n[m], top[m] = s["n"][at], s["top"][at]
            total = lambda v: pa.array(np.bincount(doc, weights=v, minlength=t.num_rows).astype(np.int64))
            return pa.RecordBatch.from_arrays([*t.columns[:5], total(times * top), exact_sums(doc, times * n, t.num_rows), t.column(7)], names=out.names)

        held, size = [], 0
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                held.append(part)
                size += len(part.column(5).flatten())
                if size > LOOKUPS:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    names = fresh(docs.select(key), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
    out = T.StructType([docs.schema[key], *(T.StructField(c, T.StringType() if c is names[-1] else T.LongType()) for c in names)])
    return rows.select("k", "n_a", "n_b", "n_groups", "n_links", "pairs", "times", "groups").mapInArrow(look_up, out)


def exact_sums(group: np.ndarray, values: np.ndarray, n: int) -> pa.Array:
    """Sums of integers per ascending group, without rounding."""
    total = np.concatenate([[0], np.cumsum(values)])
    edge = np.searchsorted(group, np.arange(n + 1))
    return pa.array(total[edge[1:]] - total[edge[:-1]])
