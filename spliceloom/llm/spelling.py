"""Spelling variants: words one edit apart, joined on pivotal grams."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spliceloom.session import durable, written

from .common import dealt, spread

LETTERS = "a-zÀ-ÿ"  # after A-Z are lower-cased: 90 letters, so at most 8,100 bigrams
LEAST_CHARS = 5               # words of five letters have four bigrams, among them two that share no letter
SLIPS = 97                    # one in SLIPS (document, word) pairs loses a letter
HELD = 500_000                # distinct words that a task counts before it hands them on


def slipped(prefix: bytes, word: str) -> str:
    """The word as the document spells it: with one code point less where SLIPS divides the checksum of document and word."""
    h = crc32(word.encode(), crc32(prefix))
    if h % SLIPS:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of all runs of letters of LEAST_CHARS code points or more in whole texts, A-Z lower-cased and slips applied.

    Tasks count in memory and hand on partial counts, which Spark adds up. Null texts have no words; a null key is spelt as the empty string.
    """
    run_of = re.compile(f"[{LETTERS}]{{{LEAST_CHARS},}}")  # shorter runs cannot give a word

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(total.keys()), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return out

        for b in batches:
            for k, t in zip(b.column(0).to_pylist(), b.column(1)):
                if not t.is_valid:
                    continue
                prefix = f"{'' if k is None else k}:".encode()
                for word, n in Counter(run_of.findall(t.as_buffer().to_pybytes().lower().decode())).items():
                    total[slipped(prefix, word)] += n
                if len(total) > HELD:
                    yield flush()
        if total:
            yield flush()

    parts = docs.select(F.col(key), F.col(text)).mapInArrow(run, "word string, n long")
    return parts.filter(F.char_length("word") >= LEAST_CHARS).groupBy("word").agg(F.sum("n").alias("n"))


def gram_counts(words: DataFrame) -> dict[str, int]:
    """In how many places of the words each bigram stands: at most the square of the alphabet, so it may go through the driver."""
    at = F.explode(F.sequence(F.lit(1), F.char_length("word") - 1))
    g = words.select("word", at.alias("at")).select(F.substring("word", F.col("at"), F.lit(2)).alias("g"))
    return {r["g"]: r["n"] for r in g.groupBy("g").agg(F.count(F.lit(1)).alias("n")).collect()}


def pivots(places: list[int], cost: list[int], need: int = 2) -> list[int]:
    """The ``need`` bigrams without a common letter that cost least, among ascending ``places``: a dynamic programme over places.

    ``best[k]`` after place i is the cheapest choice of k bigrams from the places so far; it extends the choice of k - 1 that ends two places
    before or earlier.
    """
    best: list[list[tuple[int, tuple[int, ...]] | None]] = []
    for i, p in enumerate(places):
        before = next((j for j in range(i - 1, -1, -1) if places[j] <= p - 2), -1)
        row: list[tuple[int, tuple[int, ...]] | None] = [(0, ())]
        for k in range(1, need + 1):
            skip = best[i - 1][k] if i else None
            less = (best[before][k - 1] if before >= 0 else (0, ()) if k == 1 else None)
            take = (less[0] + cost[i], (*less[1], p)) if less is not None else None
            row.append(min((x for x in (skip, take) if x is not None), default=None))
        best.append(row)
    return list(best[-1][need][1])


def prefix_places(word: str, order: dict[str, tuple[int, str]], edits: int = 1) -> tuple[list[int], tuple[int, str]]:
    """Places of the gram prefix, and the last gram in it: the 2 * edits + 1 rarest bigrams, with all other places of the same bigrams."""
    ranks = [order[word[i:i + 2]] for i in range(len(word) - 1)]
    last = sorted(ranks)[2 * edits]
    return [i for i, r in enumerate(ranks) if r <= last], last


def sides(word: str, at: int, length: int) -> tuple[int, int]:
    """Two keys of a bigram: with all that stands before it, and with all behind it, for a partner of ``length``.

    Gram and place are in the keys: the place of a left key is that of its last two letters, the place of a right key follows from ``length``.
    """
    left = xxhash.xxh3_64_intdigest(f"<{length}<{word[:at + 2]}")
    right = xxhash.xxh3_64_intdigest(f">{length}>{word[at:]}")
    return left - 2**63, right - 2**63


def keyed(words: DataFrame, counts: dict[str, int], probe: bool) -> DataFrame:
    """(key, word, last): the index over gram prefixes, or with ``probe`` the pivots of each word, for partners of each length in reach."""
    order = {g: (n, g) for g, n in counts.items()}
    rank = {g: i for i, g in enumerate(sorted(order, key=order.get))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 4096):
                keys, out, lasts = [], [], []
                for w in b.column(0).slice(lo, 4096).to_pylist():
                    places, last = prefix_places(w, order)
                    chosen = pivots(places, [order[w[p:p + 2]][0] for p in places]) if probe else places
                    lengths = (len(w) - 1, len(w), len(w) + 1) if probe else (len(w),)
                    for p in chosen:
                        for n in lengths:
                            for k in sides(w, p, n):
                                keys.append(k), out.append(w), lasts.append(rank[last[1]])
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(out, pa.string()), pa.array(lasts, pa.int32())], names=["key", "word", "last"])

    return words.select("word").mapInArrow(run, "key long, word string, last int")


def near_words(words: DataFrame) -> DataFrame:
    """(word, near): all pairs, both ways, of distinct words of LEAST_CHARS code points or more that differ by one inserted, deleted or replaced code point.

    Bigrams are ordered from rare to frequent. The prefix of a word is its three rarest; its pivots are two of them without a common letter, cheapest
    in sum. One edit spoils at most one of the two pivots. The other one stands in the partner too, and in the partner's prefix
    if that ends no earlier in the order; so it is enough to look for the pivots of the word whose prefix ends first.
    Position limits: the edit lies behind the pivot, and then all up to the pivot is equal, or before it, and then all from the
    pivot on is equal, shifted by the difference in length. These parts are in the key, so lists are short even for a bigram that stands in
    every word. Candidates are verified by edit distance.
    """
    counts = gram_counts(words)
    if not counts:
        return words.select("word", F.col("word").alias("near")).limit(0)
    index, probe = keyed(words, counts, False), keyed(words, counts, True)
    found = probe.withColumnsRenamed({"word": "a", "last": "last_a"}).join(dealt(index.withColumnRenamed("word", "b")), "key").filter("last_a <= last AND a <> b")
    pairs = found.filter(F.levenshtein("a", "b", 1) == 1).select(F.least("a", "b").alias("word"), F.greatest("a", "b").alias("near")).distinct()
    both = F.explode(F.array(F.struct("word", "near"), F.struct(F.col("near").alias("word"), F.col("word").alias("near"))))
    return pairs.select(both.alias("p")).select("p.word", "p.near")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for rows (word, form): forms followed to the last, by doubling. Counts at least double on the way, so rounds are few."""
    now = durable(forms.select("word", F.col("form").alias("root")))
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        new = durable(now.join(dealt(step), "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if new.filter("moved").isEmpty():
            return new.select("word", "root")
        now = new.select("word", "root")


def spelling_groups(words: DataFrame, ratio: int = 2) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of rows (word, n): the near word of largest n, if it has ``ratio`` times the word's n, and where that leads.

    Ties go to the smallest word in code-point order. Words without a near word have n_near 0 and are their own root. Words must be distinct and of
    LEAST_CHARS letters or more; an empty table gives no rows.
    """
    table = written(words.select("word", "n"), "words")
    pairs = near_words(spread(table))
    best = pairs.join(dealt(table.withColumnsRenamed({"word": "near", "n": "near_n"})), "near")
    best = best.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    rows = table.join(dealt(best), "word", "left")
    ok = -F.col("best.less") >= ratio * F.col("n")
    rows = written(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(ok, F.col("best.near")).alias("form"), F.when(ok, -F.col("best.less")).alias("form_n")), "forms")
    lead = roots(rows.filter("form IS NOT NULL").select("word", "form"))
    return rows.join(dealt(lead), "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame, least: int = 3, ratio: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``spelling_groups`` over the words of whole documents that occur ``least`` times or more.

    Only the two named columns are read, so other columns cannot clash. Null and empty texts have no words; rows that repeat key and text
    count again. An empty table gives no rows.
    """
    return spelling_groups(word_counts(docs.select(key, text), key, text).filter(F.col("n") >= least), ratio)
