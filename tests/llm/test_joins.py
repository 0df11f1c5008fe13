"""The set join, the tokenizer alignment and the spelling groups against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from pyspark.sql import functions as F
from spliceloom.llm import alignment, setjoin, spelling
from test_operators import SCHEMA, corpus, docs, none  # noqa: F401

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def grams(text, width):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


def joined(rows, percent, width):
    """Counter of (key, size, component) by comparing all pairs of distinct sets."""
    by = defaultdict(list)
    for d, t in rows:
        by[grams(t, width)].append(d)
    nodes = [s for s in by if s]
    root = {s: s for s in nodes}

    def find(s):
        while root[s] != s:
            s = root[s]
        return s

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            both = len(a & b)
            if 100 * both >= percent * (len(a) + len(b) - both):
                root[find(a)] = find(b)
    low = defaultdict(lambda: None)
    for s in nodes:
        ids = [d for d in by[s] if d is not None]
        if ids:
            f = find(s)
            low[f] = min(ids) if low[f] is None else min(low[f], min(ids))
    return Counter((d, len(grams(t, width)), low[find(grams(t, width))] if grams(t, width) else d) for d, t in rows)


@pytest.mark.parametrize("cold", [8, 3])
def test_ngram_join(docs, none, cold, monkeypatch):  # noqa: F811
    monkeypatch.setattr(setjoin, "COLD", cold)
    monkeypatch.setattr(setjoin, "BLOCK", 7)
    monkeypatch.setattr(setjoin, "CLUSTER", 2_000_000 if cold == 8 else 400)  # the second joins most candidates pair by pair
    for percent, width in ((90, 3), (80, 2)):
        got = setjoin.ngram_join(docs, percent, width)
        assert got.columns == ["doc_id", "n_shingles", "component_id"]
        assert Counter(tuple(r) for r in got.collect()) == joined([(r[0], r[1]) for r in corpus()], percent, width)
    assert setjoin.ngram_join(none).count() == 0


def test_join_of_one_hot_group(spark, monkeypatch):
    """A third of the rows are near copies of one text that mostly link over others; two clusters of it must not be lost behind the leader."""
    monkeypatch.setattr(setjoin, "COLD", 8)
    monkeypatch.setattr(setjoin, "BLOCK", 16)
    r = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for g in range(6):  # clusters at about 0.85 of each other, their members linked inside
        w = list(base)
        for j in r.sample(range(120), 3):
            w[j] = f"g{g}-{j}"
        for k in range(12):
            v = list(w)
            v[r.randrange(120)] = f"m{g}-{k}"
            rows.append((len(rows), " ".join(v)))
    rows += [(1000 + i, " ".join(r.choice(base) for _ in range(90))) for i in range(60)]
    got = setjoin.ngram_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    want = joined(rows, 90, 3)
    assert Counter(tuple(x) for x in got.collect()) == want and len({c for _, _, c in want}) > 62


def test_list_walk():
    """The walk with skips lists the pairs that the size and position bounds allow, and no others."""
    r = np.random.default_rng(6)
    rows = sorted({(int(h), int(n), int(i)) for h, n, i in zip(r.integers(0, 5, 300), r.integers(8, 60, 300), r.integers(0, 8, 300))})
    h, n, i = (np.array(c) for c in zip(*rows))
    got = set(zip(*(x.tolist() for x in setjoin.listed_pairs(h, n, i, 80))))
    want = {(a, b) for a in range(len(rows)) for b in range(a + 1, len(rows)) if h[a] == h[b] and 100 * n[a] >= 80 * n[b] and 180 * (min(i[a], i[b]) + min(n[a] - i[a], n[b] - i[b])) >= 80 * (n[a] + n[b])}
    assert got == want and want
    assert all(len(x) == 0 for x in setjoin.listed_pairs(h[:0], n[:0], i[:0], 80))


def test_prefix_holds_a_common_shingle():
    r = np.random.default_rng(7)
    ranks = r.integers(0, 256, 1 << setjoin.SKETCH_BITS).astype(np.uint8)
    for n in (1, 2, 9, 10, 11, 200):
        a = np.unique(r.integers(0, 2**64, n, dtype=np.uint64))
        cut = len(a) // 10  # the partner is the set less a tenth of it
        for _ in range(20):
            b = np.sort(r.permutation(a)[cut:])
            assert set(setjoin.ordered_prefix(a, ranks, 90)) & set(setjoin.ordered_prefix(b, ranks, 90))


def brute_alignment(rows):
    tk = Tokenizer.from_file(A)
    tk.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    letter, entry = alignment.byte_level_letters(), {i: s for s, i in tk.get_vocab().items()}

    def bytes_b(i):
        m = re.fullmatch("<0x(..)>", sp.id_to_piece(i))
        return bytes([int(m[1], 16)]) if m else sp.id_to_piece(i).replace("▁", " ").encode()

    out, counts = [], Counter()
    for key, text in rows:
        whole = b" " + (text or "").encode()
        a, b = (tk.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)) if text else ([], [])
        ba, bb = [bytes(letter[c] for c in entry[i]) for i in a], [bytes_b(i) for i in b]
        if not text or b"".join(ba) != whole or b"".join(bb) != whole:
            out.append((key, [], [], [], []))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in ba]).tolist(), np.cumsum([len(x) for x in bb]).tolist()
        links = [(a[i], b[j]) for i in range(len(a)) for j in range(len(b)) if max(ends_a[i] - len(ba[i]), ends_b[j] - len(bb[j])) < min(ends_a[i], ends_b[j])] if len(a) < 400 else walk(a, b, ends_a, ends_b)
        cuts = sorted(set(ends_a) & set(ends_b))
        groups = [([x for x, e in zip(a, ends_a) if lo < e <= hi], [x for x, e in zip(b, ends_b) if lo < e <= hi]) for lo, hi in zip([0, *cuts], cuts)] if len(a) < 400 else None
        counts.update(set(links))
        out.append((key, a, b, groups, links))
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    return [(k, len(a), len(b), None if g is None else len(g), len(ls), sum(counts[p] == best[p[0]] for p in ls), sum(counts[p] for p in ls),
             None if g is None else ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)) for k, a, b, g, ls in out]


def walk(a, b, ends_a, ends_b):
    i = j = 0
    out = []
    while i < len(a):
        out.append((a[i], b[j]))
        x, y = ends_a[i], ends_b[j]
        i, j = i + (x <= y), j + (y <= x)
    return out


ODD = [None, "", " ", "  a  b ", "▁x and ▁", "<s>hi</s> <unk> <0x41> <|endoftext|>", "é́ ﬁ ①　x 😀 漢字", "a\x00b\r\n\tc", "naïve façade", "the the the", "the the the", "x" * 3000]


def test_alignment(spark, docs, none, monkeypatch):  # noqa: F811
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "the end"), (3, "the end")] + [(r[0], r[1]) for r in corpus()]
    df = spark.createDataFrame([(k, t, "x", "y") for k, t in rows], "doc_id long, text string, n_a string, k string").repartition(3)
    want = brute_alignment(rows)
    for shard, lookups in ((2_000_000, 8_000_000), (50, 300)):  # many shards, many visits
        monkeypatch.setattr(alignment, "SHARD_PAIRS", shard)
        monkeypatch.setattr(alignment, "LOOKUPS", lookups)
        monkeypatch.setattr(alignment, "CHUNK", lookups)
        got = alignment.aligned(df, A, B)
        assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
        got = sorted(map(tuple, got.collect()), key=repr)
        have = defaultdict(list)
        for g in got:
            have[(g[0], g[1], g[2], *g[4:7])].append((g[3], g[7]))
        assert len(got) == len(want)
        for w in want:
            found = have[(w[0], w[1], w[2], *w[4:7])]
            assert found and (w[3] is None or (w[3], w[7]) in found), w
    text = {(r["doc_id"], r["n_links"]): r["groups"] for r in alignment.aligned(df, A, B).collect()}
    for r in alignment.aligned(df, A, B, digest=True).collect():
        t = text[(r["doc_id"], r["n_links"])]
        assert r["groups"] == (hashlib.sha256(t.encode()).hexdigest() if t else "")
    assert alignment.aligned(none, A, B).count() == 0


def test_fast_encoder_equals_the_library():
    encode, entries = alignment.byte_level(A)
    tk = Tokenizer.from_file(A)
    tk.encode_special_tokens = True
    r = random.Random(2)
    texts = [t for t in ODD if t] + ["".join(chr(r.choice([r.randrange(1, 0x250), r.randrange(0x2000, 0x2070), 32, 10])) for _ in range(200)) for _ in range(300)]
    for t, ids in zip(texts, encode(texts)):
        assert ids.tolist() == tk.encode(" " + t, add_special_tokens=False).ids, t
        assert b"".join(entries[i] for i in ids) == b" " + t.encode()


def brute_spelling(rows, least):
    count = Counter()
    for d, t in rows:
        for w, n in Counter(re.findall("[A-Za-zÀ-ÿ]+", t or "")).items():
            w = w.encode().lower().decode()
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            count[w] += n
    n = {w: c for w, c in count.items() if len(w) >= 5 and c >= least}
    return brute_groups(n)


def brute_groups(n):
    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    found = {w: [v for v in n if v != w and near(v, w)] for w in n}
    form = {}
    for w, vs in found.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 2 * n[w]:
            form[w] = best
    out = {}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w] = (n[w], len(found[w]), form.get(w), n[form[w]] if w in form else None, root)
    return out


def test_spelling_of_documents(spark, docs, none):  # noqa: F811
    r = random.Random(12)
    stems = ["".join(r.choice("abcdéñÿ") for _ in range(r.randint(5, 9))) for _ in range(40)]
    extra = [(i, " ".join(r.choice(stems).upper() if r.random() < 0.2 else r.choice(stems) for _ in range(120))) for i in range(40)] + [(None, "héllo×÷a HÉLLO héllo"), (None, None), (7, "")]
    df = spark.createDataFrame([(k, t, "z") for k, t in extra], "doc_id long, text string, word string").repartition(4)
    for rows, frame in ((extra, df), ([(x[0], x[1]) for x in corpus()], docs)):
        got = {x["word"]: (x["n"], x["n_near"], x["form"], x["form_n"], x["root"]) for x in spelling.spelling_variants(frame, 3).collect()}
        assert got == brute_spelling(rows, 3) and got
    assert spelling.spelling_variants(none).count() == 0


def test_spelling_groups(spark):
    r = random.Random(3)
    n = {}
    for _ in range(60):  # few letters: repeated bigrams, ties, chains of forms
        w = "".join(r.choice("ab") for _ in range(r.randint(5, 8)))
        n[w] = r.choice([1, 2, 4, 8, 16, 16])
        v = list(w)
        v[r.randrange(len(v))] = r.choice("abc")
        n.setdefault("".join(v), r.choice([1, 2, 4]))
        n.setdefault(w + r.choice("ab"), r.choice([1, 3]))
    n |= {"aaaaa": 1, "aaaaaa": 2, "aaaaaaa": 4, "aaaaaaaa": 8, "x" * 5000: 1, "x" * 4999 + "y": 9, "lonely": 5}
    got = {x["word"]: (x["n"], x["n_near"], x["form"], x["form_n"], x["root"]) for x in spelling.spelling_groups(spark.createDataFrame(list(n.items()), "word string, n long")).collect()}
    assert got == brute_groups(n)
    assert got["aaaaa"][4] in n and got["lonely"] == (5, 0, None, None, "lonely")


def test_hot_bigram_keeps_lists_short(spark):
    """Every word starts with one bigram and ends with another; the candidates stay near the number of words."""
    r = random.Random(9)
    words = list({"qu" + "".join(r.choice("abcdefghij") for _ in range(6)) + "zy" for _ in range(3000)})
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    counts = spelling.gram_counts(df)
    found = spelling.keyed(df, counts, True).withColumnRenamed("word", "a").join(spelling.keyed(df, counts, False), "key").filter("a <> word").count()
    assert found < 60 * len(words)


def test_pivots_are_cheapest():
    r = random.Random(1)
    for _ in range(300):
        places = sorted(r.sample(range(9), r.randint(3, 6)))
        if places[-1] - places[0] < 2:
            continue
        cost = [r.randint(1, 50) for _ in places]
        of = dict(zip(places, cost))
        want = min(of[p] + of[q] for p in places for q in places if q - p >= 2)
        p, q = spelling.pivots(places, cost)
        assert q - p >= 2 and of[p] + of[q] == want


def test_gram_counts_and_slips(spark):
    assert spelling.gram_counts(spark.createDataFrame([("ababa", 1), ("bcdef", 1)], "word string, n long")) == {"ab": 2, "ba": 2, "bc": 1, "cd": 1, "de": 1, "ef": 1}
    slips = [w for i in range(2000) if (w := spelling.slipped(b"5:", f"word{'x' * (i % 7)}{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}")) and len(w) < 6 + i % 7]
    assert slips and F is not None
