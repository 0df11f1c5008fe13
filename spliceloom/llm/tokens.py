"""Token ids as seekable zstandard files."""

from __future__ import annotations

import itertools
import json
import os
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from spliceloom.session import work_dir, written

# Fixed values of the seekable zstandard format: magic of the skippable frames and of the table's end.
SKIPPABLE_TABLE, SKIPPABLE_KEYS, TABLE_END = 0x184D2A5E, 0x184D2A50, 0x8F92EAB1
CHECKSUMS = 0x80
CHUNK = 4 << 20        # bytes of text cut and looked up at once; a longer text is a chunk of its own
REMEMBERED = 300_000   # stretches in each of the two generations that a Python worker keeps
LONGEST = 64           # bytes of a stretch worth keeping
AT_ONCE = 2048         # new stretches shown to the library as one text


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else "file://" + os.path.abspath(uri))


class FrameWriter:
    """One independent frame per document; then a skippable frame with the documents' keys, and the seek table."""

    def __init__(self, out) -> None:
        self.out, self.table, self.keys = out, [], []
        self.pack = zstandard.ZstdCompressor(level=3)

    def add(self, key: int | None, ids: np.ndarray) -> None:
        raw = ids.astype("<u4").tobytes()
        frame = self.pack.compress(raw)
        self.out.write(frame)
        self.table.append(struct.pack("<III", len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.keys.append(struct.pack("<?q", key is not None, key or 0))

    def close(self) -> None:
        keys, table = b"".join(self.keys), b"".join(self.table)
        self.out.write(struct.pack("<II", SKIPPABLE_KEYS, len(keys)) + keys)
        self.out.write(struct.pack("<II", SKIPPABLE_TABLE, len(table) + 9) + table + struct.pack("<IBI", len(self.table), CHECKSUMS, TABLE_END))


class FrameReader:
    """Random access to the documents of one file: reads the tables, then only the frames asked for."""

    def __init__(self, file) -> None:
        self.file = file
        size = file.size()
        n, flags, end = struct.unpack("<IBI", self.at(size - 9, 9))
        if end != TABLE_END or not flags & CHECKSUMS:
            raise ValueError("no seek table with checksums at the end of the file")
        start = size - 9 - 12 * n
        entries = np.frombuffer(self.at(start, 12 * n), "<u4").reshape(n, 3)
        self.packed, self.raw, self.sums = (entries[:, i].astype(np.int64) for i in range(3))
        self.starts = np.cumsum(self.packed) - self.packed
        keys = np.frombuffer(self.at(start - 8 - 9 * n, 9 * n), np.dtype([("have", "?"), ("key", "<i8")]))
        self.keys = [int(k["key"]) if k["have"] else None for k in keys]
        self.unpack = zstandard.ZstdDecompressor()

    def at(self, place: int, length: int) -> bytes:
        self.file.seek(place)
        return self.file.read(length)

    def ids(self, i: int) -> np.ndarray:
        raw = self.unpack.decompress(self.at(int(self.starts[i]), int(self.packed[i])), max_output_size=max(1, int(self.raw[i])))
        if len(raw) != self.raw[i] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.sums[i]:
            raise ValueError(f"frame {i} is damaged")
        return np.frombuffer(raw, "<u4")


def byte_bpe(path: str) -> Callable[[list[str]], list[list[int]]]:
    """Encoder of whole texts by a tokenizers file; special strings in a text are ordinary text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    batch = getattr(t, "encode_batch_fast", t.encode_batch)
    return lambda texts: [e.ids for e in batch(texts, add_special_tokens=False)]


def cuts(data: np.ndarray) -> np.ndarray:
    """Where a byte-level word always ends, whatever stands before and behind: a flag for each byte of UTF-8 text, and one for the end (false).

    No word of the pattern goes on from a character that is no white space into a blank, or from an ASCII letter into an ASCII mark, and none looks back, so the
    words of a text are those of its stretches between such places. Blanks are the ASCII ones; whatever any Unicode version took for white space ends no stretch.
    """
    out = np.zeros(len(data) + 1, bool)
    kind = KINDS[data]
    i = np.flatnonzero(kind[1:] == 1) + 1
    p, q, r = data[i - 1], data[np.maximum(i - 2, 0)], data[np.maximum(i - 3, 0)]
    odd = (q == 0xC2) | ((r == 0xE1) & ((q == 0x9A) | (q == 0xA0))) | ((r == 0xE2) & ((q == 0x80) | (q == 0x81))) | ((r == 0xE3) & (q == 0x80))
    out[i] = ((p > 0x20) & (p < 0x7F)) | ((p >= 0x80) & ~odd)
    out[1:-1] |= (kind[1:] == 2) & (kind[:-1] == 3)
    return out


#: 1 blank, 2 ASCII mark, 3 ASCII letter, 0 any other byte.
KINDS = np.array([1 if chr(b) in " \t\n\r" else 0 if b < 0x21 or b > 0x7E else 3 if chr(b).isalpha() else 0 if chr(b).isdigit() else 2 for b in range(256)], np.uint8)


class StretchEncoder:
    """Ids of whole texts by the tokenizers library, which is shown each new stretch between two cuts once.

    The worker keeps the ids of the stretches it met last. New stretches go to the library joined, where the places between them are cuts too; the bytes of the
    ids tell them apart again. A file whose words may cross a cut has its texts encoded whole.
    """

    loaded: dict[str, StretchEncoder] = {}

    def __init__(self, path: str) -> None:
        self.encode = byte_bpe(path)
        self.new: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        with open(path, encoding="utf-8") as f:
            c = json.load(f)
        model, pre = c["model"], c.get("pre_tokenizer") or {}
        vocab = model["vocab"] if model.get("type") == "BPE" else {}
        self.cut = (bool(vocab) and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space", True) and pre.get("use_regex", True)
                    and not any(c.get(k) for k in ("normalizer", "truncation", "padding")) and all(t["special"] for t in c.get("added_tokens", []))
                    and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix")) and sum(len(t) == 1 for t in vocab) >= 256)
        if self.cut:
            self.size = np.zeros(max(vocab.values()) + 1, np.int64)  # bytes of each id: a byte-level entry has a letter for each
            self.size[list(vocab.values())] = [len(t) for t in vocab]

    @classmethod
    def of(cls, path: str) -> StretchEncoder:
        if path not in cls.loaded:
            cls.loaded[path] = cls(path)
        return cls.loaded[path]

    def fresh(self, words: list[bytes]) -> list[bytes]:
        """Ids of stretches by the library; those that cannot stand behind the one before them begin a text of their own."""
        if not words:
            return []
        ends = np.cumsum([len(w) for w in words])
        apart = ~cuts(np.frombuffer(b"".join(words), np.uint8))[ends]
        edges = np.union1d(np.flatnonzero(apart) + 1, np.arange(0, len(words), AT_ONCE)).tolist()
        got = self.encode([b"".join(words[s:e]).decode() for s, e in itertools.pairwise(edges)])
        ids = np.fromiter(itertools.chain.from_iterable(got), "<u4")
        upto = np.cumsum(self.size[ids])
        last = np.searchsorted(upto, ends)
        if not len(ids) or upto[-1] != ends[-1] or (upto[last] != ends).any():
            raise ValueError("the ids do not give back the bytes of the text")
        raw, at = ids.tobytes(), [0, *(4 * (last + 1)).tolist()]
        return [raw[s:e] for s, e in itertools.pairwise(at)]

    def lookup(self, words: list[bytes]) -> list[bytes]:
        out = [self.new.get(w) or self.old.get(w) for w in words]
        empty = [i for i, x in enumerate(out) if x is None]
        for i, x in zip(empty, self.fresh([words[i] for i in empty])):
            out[i] = x
        if len(self.new) > REMEMBERED:
            self.old, self.new = self.new, {}
        self.new.update(itertools.islice(((w, x) for w, x in zip(words, out) if len(w) <= LONGEST), REMEMBERED))
        return out

    def __call__(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text as little-endian bytes, in order."""
        if not self.cut:
            yield from (np.array(ids, "<u4").tobytes() for ids in self.encode(texts.to_pylist()))
            return
        texts = texts.cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        starts = offsets - offsets[0]
        mark = cuts(data)
        mark[starts] = True
        edges = np.flatnonzero(mark)
        words = pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(data)]).dictionary_encode()
        ids = pa.array(self.lookup(words.dictionary.to_pylist()), pa.large_binary()).take(words.indices)
        at = np.frombuffer(ids.buffers()[1], np.int64)[np.searchsorted(edges, starts)].tolist()
        raw = memoryview(ids.buffers()[2] or b"")
        yield from (bytes(raw[s:e]) for s, e in itertools.pairwise(at))


def portions(texts: pa.Array, size: int) -> list[tuple[int, int]]:
    """Rows (from, to) of portions of at most ``size`` bytes; a longer text is one alone."""
    upto = np.cumsum(np.array(pc.binary_length(texts), np.int64))
    out, s = [], 0
    while s < len(upto):
        e = max(s + 1, int(np.searchsorted(upto, size + (upto[s - 1] if s else 0), "right")))
        out.append((s, e))
        s = e
    return out


def write_token_files(docs: DataFrame, tokenizer: str, folder: str | None = None, key: str = "doc_id", text: str = "text", end_id: int = 0, portion: int = CHUNK) -> DataFrame:
    """Write the ids of every whole text, each with ``end_id`` behind, in ascending ``key`` order (nulls first).

    Each ordered partition writes one file under ``folder`` (by default a new one in the shared folder) and one row of
    the manifest (part, path, n_docs, n_ids), which is returned. Every attempt at a task writes a file of its own name, and only the rows
    of attempts that succeed enter the manifest, so a lost executor leaves at most a file nobody reads. Null text is
    empty; equal keys stand together in random order; an empty table gives an empty manifest. ``text`` and ``key`` alone are read.
    About ``portion`` bytes of text are encoded at once.
    """
    spark = docs.sparkSession
    folder = folder or work_dir(spark, "tokens")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.rand(23).alias("tie"))
    rows = rows.repartitionByRange(n, "key", "tie").sortWithinPartitions("key", "tie").select("key", "text").withColumn("part", F.spark_partition_id())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        out = writer = None
        n_ids, behind = 0, np.array([end_id], "<u4").tobytes()
        for b in batches:
            if not b.num_rows:
                continue
            if out is None:
                encode, part = StretchEncoder.of(tokenizer), b.column("part")[0].as_py()
                fs.create_dir(root, recursive=True)
                path = f"{root}/part-{part:06d}-{uuid.uuid4().hex}.zst"
                out = fs.open_output_stream(path, compression=None)
                writer = FrameWriter(out)
            keys, texts = b.column("key").to_pylist(), b.column("text")
            for s, e in portions(texts, portion):
                for k, ids in zip(keys[s:e], encode(texts.slice(s, e - s))):
                    writer.add(k, np.frombuffer(ids + behind, "<u4"))
                    n_ids += len(ids) // 4 + 1
        if out is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "path": [path], "n_docs": [len(writer.keys)], "n_ids": [n_ids]})

    return written(rows.mapInArrow(write, "part int, path string, n_docs long, n_ids long"), "token-manifest")


def read_token_files(manifest: DataFrame, folder_uri: str | None = None, with_ids: bool = False) -> DataFrame:
    """Every document of the files: key, start (ids of all documents before it), n_tokens, ids_crc32 and, if asked for, ids.

    Each task opens its files, reads their tables and unpacks one frame at a time; checksums are verified. Offsets of files come from
    the manifest, which has one row per file.
    """
    spark = manifest.sparkSession
    uri = folder_uri or work_dir(spark, "x")
    before = F.coalesce(F.sum("n_ids").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    files = manifest.select("path", before.cast("long").alias("before"))  # one row per file
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = filesystem(uri)
        for b in batches:
            for path, start in zip(b.column("path").to_pylist(), b.column("before").to_pylist()):
                with fs.open_input_file(path) as f:
                    r = FrameReader(f)
                    for lo in range(0, len(r.keys), 512):
                        out = {"key": [], "start": [], "n_tokens": [], "ids_crc32": [], "ids": []}
                        for i in range(lo, min(lo + 512, len(r.keys))):
                            ids = r.ids(i)
                            for k, v in zip(out, (r.keys[i], start, len(ids), zlib.crc32(ids.tobytes()), ids.tolist() if with_ids else None)):
                                out[k].append(v)
                            start += len(ids)
                        yield pa.RecordBatch.from_arrays([pa.array(out["key"], pa.int64()), pa.array(out["start"], pa.int64()), pa.array(out["n_tokens"], pa.int64()),
                                                          pa.array(out["ids_crc32"], pa.int64()), pa.array(out["ids"], pa.list_(pa.int64()))], names=list(out))

    rows = files.repartition(n, "path").mapInArrow(read, "key long, start long, n_tokens long, ids_crc32 long, ids array<long>")
    return rows if with_ids else rows.drop("ids")
