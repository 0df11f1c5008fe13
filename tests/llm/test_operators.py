"""Corpus operators against brute force, on small tables with nulls, empty and long texts, ties, repeats and clashing names."""

import datetime
import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from spliceloom.llm import chat as C
from spliceloom.llm import lines, neardup, pii, quality, queries, repeats
from spliceloom.llm.components import components
from spliceloom.llm.decontaminate import contaminated, without_contaminated
from spliceloom.llm.lines import PerfectHash, dedup_lines
from spliceloom.llm.mixing import mix
from spliceloom.llm.neardup import estimate, near_duplicates, registers, without_near_duplicates
from spliceloom.llm.quality import accepted, quality_rules
from spliceloom.llm.repeats import without_repeats
from spliceloom.llm.sharding import contiguous_shards
from spliceloom.llm.tokens import FrameReader, StretchEncoder, byte_bpe, filesystem, portions, read_token_files, write_token_files

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, kept string, n_words string, size string, _x string"


def corpus() -> list[tuple]:
    """Prose of made-up words with copies, near copies, shared lines and passages, periodic junk and odd rows."""
    r = random.Random(5)
    vocab = ["".join(r.choice("abcdeéñß") for _ in range(r.randint(2, 7))) for _ in range(300)] + ["the", "of", "and", "to", "in", "a"] * 15
    prose = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    shared, line = prose(90), prose(12)
    texts = []
    for i in range(40):
        t = prose(r.choice([3, 8, 60, 200, 500]))
        if i % 4 == 0:
            t += "\n" + shared + "\n" + prose(30)
        if i % 3 == 0:
            t += f"\n  {line.upper() if i % 2 else line}\t\n{line}"
        texts.append(t)
    base = prose(260).split()
    for i in range(90):  # a large group of near copies of a base
        w = list(base)
        for _ in range(r.randint(0, 7)):
            w[r.randrange(len(w))] = r.choice(vocab)
        texts.append(" ".join(w))
    texts += [texts[3]] * 7 + ["ab " * 700, "ab " * 700 + "x", "z" * 3000, prose(30_000), "", "   \n\t\n", None, None, "\n", "one two", "One Two", "x\n" * 40 + "y"]
    rows = [(i * 3 % 1000, t, r.choice(["en", "de", "xx", None]), r.choice(["a", "a", "b", None]), None, "s", "k", "n", "z", "x") for i, t in enumerate(texts)]
    return rows + [rows[0], rows[0], (None, texts[1], None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "d.parquet")
    spark.createDataFrame(corpus(), SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def words(t):
    return (t or "").encode().split()


def shingles(t, low=True):
    w = [x.lower() if low else x for x in words(t)]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_sharding(spark, docs, none):
    rows = docs.withColumn("bytes", F.coalesce(F.octet_length("text"), F.lit(0)) + 1)
    out = contiguous_shards(rows, 4, "bytes")
    assert out.columns == [*rows.columns, "_shard", "slot"]  # the input's own shard column stays
    got = sorted(((r["doc_id"] if r["doc_id"] is not None else -1), r["_shard"], r["slot"], r["bytes"]) for r in out.collect())
    assert len(got) == len(corpus())
    sizes, slots, ranges = defaultdict(int), defaultdict(list), defaultdict(list)
    for d, s, slot, b in got:
        sizes[s] += b
        slots[s].append(slot)
        ranges[s].append(d)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(max(ranges[s]) <= min(ranges[s + 1]) for s in range(3))
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(g[3] for g in got)
    assert contiguous_shards(none.withColumn("bytes", F.lit(1)), 4, "bytes").count() == 0
    assert {r["_shard"] for r in contiguous_shards(docs.withColumn("bytes", F.lit(None).cast("long")), 4, "bytes").collect()} == {0}


def test_quality(docs, none):
    q = quality_rules(docs)
    for r in q.collect():
        t = r["text"] or ""
        w = [x.decode() for x in words(t)]
        at = defaultdict(list)
        for i in range(len(w) - 4):
            at[tuple(w[i:i + 5])].append(i)
        cov = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
        lines = [x for x in t.split("\n") if x.encode().split()]
        failed = len(w) < 10 or 100 * len(cov) > 20 * len(w)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == (
            len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(cov), failed)
        assert not (failed and r["kept"])
        if r["lang"] in ("xx", None):
            assert r["char_js"] is None and r["kept"] == (not failed)
    kept = accepted(docs)
    assert kept.columns == docs.columns and kept.count() == q.filter("kept").count()
    assert quality_rules(none).count() == accepted(none).count() == 0


def test_quality_divergence(spark):
    good = "The house of the man is in the town and it was on the way to the sea. " + " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)} x{chr(97 + i % 26)}{chr(97 + i // 26)} y{chr(97 + i % 26)}{chr(97 + i // 26)} {['the', 'of', 'and', 'to', 'in'][i % 5]}" for i in range(60))
    rows = [(1, good, "en"), (2, " ".join(f"{w}***" for w in good.split()), "en"), (3, good.upper() + "!!", "en"), (4, good, "xx")]
    got = {r["doc_id"]: r["kept"] for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got == {1: True, 2: False, 3: False, 4: True}


@pytest.mark.parametrize("lang", ["en", "de", "fr", "es"])
def test_quality_word_soup(spark, lang):
    r = random.Random(3)
    low = [c for c in "bcdfghjklmnpqrstvwxz"]
    upper = 0.35 if lang == "de" else 0.1  # nouns, or starts of sentences
    common = list(quality.WORD_SHARES[lang].items())

    def soup(n, filled):
        out = []
        for _ in range(n):
            w = "".join(r.choice(low) for _ in range(r.randint(3, 8)))
            w = (w.capitalize() if r.random() < upper else w) + r.choice([","] + [""] * 8 + ["."])
            x = r.random() * 100
            for k, share in common if filled else ():
                x -= share
                if x < 0:
                    w = k
                    break
            out.append(w)
        return " ".join(out)

    # with the common words in their shares a text stays, without any it goes
    rows = [(i, soup(300, i % 2 == 0), lang) for i in range(40)]
    got = {r["doc_id"]: r for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(g["char_js"] < 0.05 and not g["base_failed"] for g in got.values())
    assert {i: g["kept"] for i, g in got.items()} == {i: i % 2 == 0 for i in range(40)}
    assert all(abs(g["word_js"] - quality.bare_js(lang)) < 1e-9 for i, g in got.items() if i % 2)


def test_near_duplicates(spark, docs, none):
    for percent in (85, 80):
        got = near_duplicates(docs, percent).collect()
        assert len(got) == len(corpus())
        by = defaultdict(list)  # nodes are sets; the rows of one set share a component
        for d, t, *_ in corpus():
            by[frozenset(shingles(t))].append(d)
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
        want = Counter()
        for d, t, *_ in corpus():
            s = frozenset(shingles(t))
            c = low[find(s)] if s else d
            want[(d, len(s), c, d == c)] += 1
        assert Counter(tuple(r) for r in got) == want
    kept = without_near_duplicates(docs, 80)
    assert kept.columns == docs.columns
    assert near_duplicates(none).count() == 0 and without_near_duplicates(none).count() == 0


def test_stages_decide_by_row(spark):
    r = random.Random(8)
    a, b, c, d = (" ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(120)) for _ in range(4))
    schema = "doc_id long, text string, n int"
    # copies under null ids, one id with two texts, exact repeats under one id, words of no text
    rows = [(None, a, 1), (None, a, 2), (9, a, 3), (None, b, 4), (None, b, 5), (2, c, 6), (7, d, 7), (7, c, 8), (7, d, 9), (None, "", 10), (None, None, 11)]
    kept = without_near_duplicates(spark.createDataFrame(rows, schema).repartition(3), 80).collect()
    left = {x["n"] for x in kept}
    assert left & {1, 2, 3} == {3} and len(left & {4, 5}) == 1 and left & {6, 8} == {6} and len(left & {7, 9}) == 1 and {10, 11} <= left and len(kept) == 6
    rows = [(None, a, 1), (None, b, 2), (3, a + " " + c, 3), (3, d, 4), (4, a, 5), (4, a, 6), (None, None, 7)]
    bench = spark.createDataFrame([(1, " ".join(a.split()[10:60]))], "item_id long, text string")
    assert {x["n"] for x in without_contaminated(spark.createDataFrame(rows, schema).repartition(3), bench).collect()} == {2, 4, 7}


def test_hyperminhash_estimate():
    r = np.random.default_rng(3)
    both, a, b = (np.unique(r.integers(0, 2**64, n, dtype=np.uint64)) for n in (4000, 500, 500))
    x, y = np.union1d(both, a), np.union1d(both, b)
    regs = registers([x, y])
    j, _ = estimate(regs[:1], regs[1:], np.array([len(x)]), np.array([len(y)]))
    assert abs(j[0] - 0.8) < 0.15


def test_estimate_keeps_borderline_pairs(spark):
    for percent, cut in ((85, 76), (80, 67)):
        least, t = neardup.least_equal(percent / 100), percent / 100
        tail = lambda c: sum(math.comb(128, i) * t ** i * (1 - t) ** (128 - i) for i in range(c))
        assert least[128] == cut and tail(cut) <= 1e-12 < tail(cut + 1)
    a = np.arange(128, dtype=np.uint16)
    alike = {b"a": 128, b"b": 80, b"c": 70}  # buckets equal to those of a
    nodes = spark.createDataFrame([(bytearray(p), 1000, bytearray(np.where(np.arange(128) < n, a, a + 1000).astype(np.uint16).tobytes())) for p, n in alike.items()], "print binary, n long, regs binary")
    pairs = spark.createDataFrame([(bytearray(b"a"), bytearray(b"b")), (bytearray(b"a"), bytearray(b"c"))], "a binary, b binary")
    assert [bytes(r["b"]) for r in neardup.estimated(pairs, nodes, 85).collect()] == [b"b"]


def test_components(spark):
    r = random.Random(1)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(120)] + [(300 + i, 301 + i) for i in range(60)] + [(500, i + 501) for i in range(50)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {x["node"]: x["root"] for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}


def test_decontamination(spark, docs, none):
    texts = {d: t for d, t, *_ in corpus() if t}
    long_ = texts[max(texts, key=lambda k: (len(texts[k]), k or 0))].split()
    items = [(1, " ".join(long_[100:130])), (2, " ".join(long_[20_000:20_030]).replace("a", "A")), (3, None), (4, ""), (5, "one two"), (6, "never seen words in any of these documents at all"), (7, " ".join([*long_[50:80], "other", "tail"])), (8, " ".join(long_[100:130]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = set()
    low = lambda t: {tuple(x.decode().lower() for x in s) for s in shingles(t, low=False)}
    sets = [(d, low(t)) for d, t, *_ in corpus()]
    for i, t in items:
        q = low(t)
        want |= {(d, i, len(q), len(q & s)) for d, s in sets if q and 100 * len(q & s) >= 80 * len(q)}
    got = contaminated(docs, bench).collect()
    assert {tuple(r)[:4] for r in got} == want and len(got) == len(want) and {1, 2, 5, 7, 8} <= {r["item_id"] for r in got}
    bad = {d for d, *_ in want}
    assert without_contaminated(docs, bench).count() == sum(d not in bad for d, *_ in corpus())
    assert contaminated(none, bench).count() == 0 and contaminated(docs, bench.limit(0)).count() == 0


def luhn(digits):
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed([int(c) for c in digits]))) % 10 == 0


def test_pseudonyms(spark, docs, none):
    text = "Mail Bo.b7@mail.example.com, card 4111-1111 1111 1111, bad 4111111111111112, call +1 (988) 555-2485, ip 45.114.23.72 not 300.1.2.3, ssn 123-45-6789 not 666-12-3456, iban GB82 WEST 1234 5698 7654 32, on 2020-02-29 or 12/25/2020 or 25.12.2020 not 2021-02-29."
    rows = [(1, text), (2, "again 4111-1111 1111 1111 and 45.114.23.72"), (3, "nothing"), (4, None), (5, ""), (6, text)]
    df = spark.createDataFrame([(i, t, "own") for i, t in rows], "doc_id long, text string, n_pii string")
    got = {r["doc_id"]: r for r in pii.pseudonymised(df, "k").collect()}
    assert got[1]["n_pii"] == "own" and got[1]["_n_pii"] == 9 and got[3]["_n_pii"] == got[4]["_n_pii"] == got[5]["_n_pii"] == 0
    assert got[4]["text"] is None and got[5]["text"] == "" and got[6]["text"] == got[1]["text"]
    new = got[1]["text"]
    for kept in ("bad 4111111111111112", "not 300.1.2.3", "not 666-12-3456", "not 2021-02-29", "@mail.example.com"):
        assert kept in new
    for gone in ("4111-1111 1111 1111", "45.114.23.72", "123-45-6789", "555-2485", "2020-02-29", "12/25/2020", "Bo.b7@"):
        assert gone not in new
    card = new.split("card ")[1].split(",")[0]
    assert luhn(card.replace("-", "").replace(" ", "")) and card in got[2]["text"]
    iban = new.split("iban ")[1].split(",")[0].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    datetime.date.fromisoformat(new.split("on ")[1].split(" ")[0])
    assert all(0 <= int(o) < 256 for o in new.split("ip ")[1].split(" ")[0].split("."))
    other = {r["doc_id"]: r for r in pii.pseudonymised(df, "another key").collect()}
    assert other[1]["text"] != new
    assert pii.pseudonymised(none, "k").count() == 0 and pii.pseudonymised(docs, "k").count() == len(corpus())


def test_pseudonyms_in_part(spark):
    visa, amex = "4111 1111 1111 1111", "3782 822463 10005"
    texts = [visa, f"{visa} 12/25", f"{visa} 123", f"2 {visa}", f"1234 {visa}", f"{visa} 12/25/2030", f"{visa} 5500 0000 0000 0004", f"{amex} 1234", "4111111111111111 123", "2 4111111111111111 12/25", f"{visa} 12", f"{visa} 2020-02-29",
             "6304 0000 0000 0000 000", "25/12/2020", "12/25/2020", "2020/12/25", "212 555 1234", "31/02/2020", "4111-1111-1111-1111-123"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.pseudonymised(rows, "k").collect()}
    new = {t: got[i]["text"] for i, t in enumerate(texts)}
    n = [got[i]["n_pii"] for i in range(len(texts))]
    assert n == [1, 1, 1, 1, 1, 2, 2, 1, 1, 1, 1, 2, 1, 1, 1, 1, 1, 0, 1]
    card = new[visa]
    assert card != visa and luhn(card.replace(" ", ""))
    for t in texts[1:5] + [texts[10]]:
        assert new[t] == t.replace(visa, card)
    for t in (texts[5], texts[6], texts[11]):
        assert new[t].startswith(card + " ") and new[t][20:] != t[20:] and len(new[t]) == len(t)
    assert new[texts[8]] == card.replace(" ", "") + " 123" and new[texts[9]] == "2 " + card.replace(" ", "") + " 12/25" and new[texts[18]] == card.replace(" ", "-") + "-123"
    assert new[texts[7]].endswith(" 1234") and luhn(new[texts[7]][:-5].replace(" ", "")) and amex not in new[texts[7]]
    day, month, year = map(int, new["25/12/2020"].split("/"))
    assert datetime.date(year, month, day) != datetime.date(2020, 12, 25) and day > 12
    assert datetime.date.fromisoformat(new["2020/12/25"].replace("/", "-")) == datetime.datetime.strptime(new["12/25/2020"], "%m/%d/%Y").date()
    assert new["212 555 1234"] != "212 555 1234" and new["31/02/2020"] == "31/02/2020"
    # the dates that only read day-first are permuted among themselves
    late = [d for k in range(4000) if (d := datetime.date(1999, 1, 1) + datetime.timedelta(k)).day > 12]
    days = spark.createDataFrame([(d.year, d.month, d.day) for d in late], "y int, m int, d int").select(pii.new_late_day(F.col("y"), F.col("m"), F.col("d"), "k").alias("x")).collect()
    assert len({r["x"] for r in days}) == len(late) and all(r["x"].day > 12 and 1800 <= r["x"].year < 2200 for r in days)


def test_feistel_permutes(spark):
    df = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("s"), (F.col("id") % 20).alias("l"), F.floor(F.col("id") / 20).alias("r"))
    assert df.select(pii.feistel_text(F.col("s"), pii.DIGITS, "k").alias("x")).distinct().count() == 1000
    assert df.select(pii.feistel_pair(F.col("l"), F.col("r"), 20, 50, "k", "t").alias("x")).distinct().count() == 1000
    days = spark.range(3000).select(F.date_add(F.lit("1990-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    assert days.select(pii.new_day(F.year("d"), F.month("d"), F.day("d"), "k").alias("x")).distinct().count() == 3000


def test_token_files(spark, docs, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    manifest = write_token_files(docs, path)
    got = read_token_files(manifest, with_ids=True).collect()
    t = Tokenizer.from_file(path)
    want = Counter((d, tuple(t.encode(x or "", add_special_tokens=False).ids + [0])) for d, x, *_ in corpus())
    assert Counter((r["key"], tuple(r["ids"])) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at and r["n_tokens"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        at += r["n_tokens"]
    keys = [-1 if r["key"] is None else r["key"] for r in sorted(got, key=lambda r: r["start"])]
    assert keys == sorted(keys)
    one = manifest.first()
    fs, where = filesystem(one["path"])
    raw = bytearray(fs.open_input_file(where).read())
    raw[5] ^= 255
    broken = where + ".broken"
    with fs.open_output_stream(broken, compression=None) as out:
        out.write(bytes(raw))
    with pytest.raises(Exception):
        FrameReader(fs.open_input_file(broken)).ids(0)
    assert read_token_files(write_token_files(none, path)).count() == 0


def test_stretches_give_the_ids_of_whole_texts(tmp_path, monkeypatch):
    import json

    import public_tokenizers
    import pyarrow as pa

    path = public_tokenizers.path("byte_bpe_50k.json")
    r = random.Random(11)
    letters = [*" \t\n\r\x0b\x0c\x1c\x1f\x00\x7f\x85\xa0\u1680\u180e\u2003\u200b\u2028\u202f\u205f\u3000\ufeff", *"  \n''stmrevld,.-!09aZ_²½éßяあ漢\u0301\u0660\U0001F600\U0001D7D8"]
    texts = ["", " ", "a", "", "don't, we'll'sbar ''re", "x  y\n\n z\t", "<|endoftext|> a<|endoftext|>", "é  ", *("".join(r.choices(letters, k=r.randint(1, 40))) for _ in range(4000)), ""]
    chars = [chr(c) for c in [*range(0xD800), *range(0xE000, 0x10000), *range(0x10000, 0x110000, 97)]]
    texts += ["".join(f"a{c} b{c}\n,{c}'s {c} " for c in chars[i:i + 500]) for i in range(0, len(chars), 500)]

    def given(encoder: StretchEncoder, size: int) -> list[list[int]]:
        rows = pa.array(["cut off", *texts]).slice(1)
        return [np.frombuffer(x, "<u4").tolist() for s, e in portions(rows, size) for x in encoder(rows.slice(s, e - s))]

    want = byte_bpe(path)(texts)
    for size in (1, 3000, 1 << 22):
        assert given(StretchEncoder(path), size) == want
    monkeypatch.setattr("spliceloom.llm.tokens.REMEMBERED", 50)  # what is kept changes no result
    assert given(StretchEncoder(path), 3000) == want
    with open(path, encoding="utf-8") as f:
        spaced = json.load(f)
    spaced["pre_tokenizer"]["add_prefix_space"] = True  # then a stretch is no text of its own
    other = str(tmp_path / "spaced.json")
    with open(other, "w", encoding="utf-8") as f:
        json.dump(spaced, f)
    assert not StretchEncoder(other).cut and given(StretchEncoder(other), 3000) == byte_bpe(other)(texts)


def test_the_library_is_shown_a_stretch_once():
    import public_tokenizers
    import pyarrow as pa

    encoder = StretchEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    shown, encode = [], encoder.encode
    encoder.encode = lambda texts: shown.extend(texts) or encode(texts)
    r = random.Random(3)
    words = ["".join(r.choices("abcdefgh", k=7)) for _ in range(100)]
    text = " " + " ".join(r.choice(words) for _ in range(5000))
    got = list(encoder(pa.array([text]))) + list(encoder(pa.array([text, text])))
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [encode([text])[0]] * 3
    assert sum(map(len, shown)) == len(set(text.split())) * 8


def test_chat(spark, tmp_path):
    said = C.END + C.START + "assistant ok"
    rows = [(1, 10, None, "user", "hi", 0.0), (1, 11, 10, "assistant", "low", 0.1), (1, 12, 10, "assistant", said + "<\\|", 0.9), (1, 13, 12, "user", None, 0.2), (1, 14, 11, "user", "deep", 0.0),
            (4, 1, 2, "user", "on a cycle", 0.0), (4, 2, 1, "user", "on a cycle", 0.0), (4, 3, 2, "user", "below a cycle", 0.0), (2, 10, 99, None, "", None), (None, 1, None, "a\\n\nb|<|", "null tree", 1.0)] + [(3, i, i - 1 if i else None, "assistant" if i % 2 else "user", f"t{i}", 0.0) for i in range(70)]
    m = spark.createDataFrame(rows, "tree long, id long, parent long, role string, text string, score double")
    out = C.chat(m).withColumn("turns", C.read_turns(F.col("formatted"))).withColumn("loss", C.read_loss(F.col("formatted"), F.col("loss_spans")))
    got = {r["tree"]: ([tuple(t) for t in r["turns"]], r["loss"]) for r in out.collect()}
    assert got[1] == ([("user", "hi"), ("assistant", said + "<\\|"), ("user", "")], said + "<\\|")
    assert 4 not in got and got[2] == ([("", "")], "") and got[None] == ([("a\\n\nb|<|", "null tree")], "")
    assert [t[1] for t in got[3][0]] == [f"t{i}" for i in range(70)] and got[3][1] == "".join(f"t{i}" for i in range(1, 70, 2))
    assert C.chat(m, paths=2).filter("tree = 1").count() == 2 and C.chat(m.limit(0)).count() == 0


def test_chat_rows_that_repeat_tie_or_clash(spark):
    """One message in several rows, ties of branches, a very long text, rows without an id, and extra columns of any name."""
    long_ = "x<|im_end|>\n" * 60_000
    rows = [(1, 1, None, "user", "root", 0.0)] * 3 + [(1, 1, None, "user", "zz other text of this id", 0.0), (1, 2, 1, "assistant", "a", 0.5), (1, 2, 1, "assistant", "a", 0.5), (1, 3, 1, "assistant", "b", 0.5),
            (1, None, 1, "user", "nobody", 9.0), (2, 5, None, "user", "q", None), (2, 6, 5, "assistant", long_, None), (2, 6, 5, "assistant", long_, None), (3, 1, 1, "user", "its own parent", 0.0)]
    m = spark.createDataFrame([(*r, "p", 7, "f") for r in rows], "tree long, id long, parent long, role string, text string, score double, path string, depth int, formatted string").repartition(3)
    out = C.chat(m, paths=5).withColumn("turns", C.read_turns(F.col("formatted"))).withColumn("loss", C.read_loss(F.col("formatted"), F.col("loss_spans")))
    got = {(r["tree"], r["path"]): ([t["text"] for t in r["turns"]], r["n_turns"], r["loss"]) for r in out.collect()}
    assert got == {(1, 1): (["root", "a"], 2, "a"), (1, 2): (["root", "b"], 2, "b"), (2, 1): (["q", long_], 2, long_)}
    assert C.chat(m.limit(0)).count() == 0


def test_line_dedup(docs, none):
    rows = [(r[0], r[1]) for r in corpus()]
    key = lambda x: x.strip(" \t\n\x0b\f\r").encode().lower().decode()
    low = -(2**63)
    where = defaultdict(list)
    for d, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= 40:
                where[k].append(low if d is None else d)
    gone = {k: max(v) for k, v in where.items() if len(v) >= 5}
    want = Counter()
    for d, t in rows:
        ls = (t or "").split("\n")
        left = [x for x in ls if key(x) not in gone or gone[key(x)] == (low if d is None else d)]
        want[(d, None if t is None else "\n".join(left), len(ls), len(ls) - len(left))] += 1
    assert gone
    out = dedup_lines(docs)
    assert Counter((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in out.collect()) == want
    assert dedup_lines(none).count() == 0


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(2).integers(0, 2**64, 5000, dtype=np.uint64))
    assert sorted(PerfectHash.build(keys).places(keys)) == list(range(len(keys)))
    assert len(PerfectHash.build(keys[:0]).places(keys)) == len(keys)


def test_equal_high_halves_end_and_are_told_apart():
    r = np.random.default_rng(4)
    hi = np.concatenate([r.integers(0, 2**64, 40, dtype=np.uint64), np.array([7, 7, 7, 2**64 - 1, 2**64 - 1, 0, 0], np.uint64)])
    lo = np.arange(len(hi)).astype(np.uint64)
    shard = lines.build_shard(hi, lo, np.arange(len(hi)) + 5, np.arange(len(hi)) + 100)
    count, last = lines.probe(shard, hi, lo)
    assert count.tolist() == list(range(5, 5 + len(hi))) and last.tolist() == list(range(100, 100 + len(hi)))
    assert not lines.probe(shard, hi, lo + np.uint64(1000))[0].any()
    assert not lines.probe(lines.build_shard(*(x[:0] for x in (hi, lo, lo, lo))), hi, lo)[0].any()


def test_shards_are_read_once_a_visit(tmp_path, monkeypatch):
    """With a cache that holds no two shards, a visit of all lines reads every shard once."""
    monkeypatch.setattr(lines, "CACHE_BYTES", 1)
    r = np.random.default_rng(5)
    hi, lo = r.integers(0, 2**64, 3000, dtype=np.uint64), r.integers(0, 2**64, 3000, dtype=np.uint64)
    of, paths = lines.shard_numbers(hi, 6), {}
    for s in range(6):
        m = of == s
        paths[s] = str(tmp_path / f"shard-{s}")
        with open(paths[s], "wb") as f:
            np.savez(f, **lines.build_shard(hi[m], lo[m], np.full(m.sum(), 9), np.flatnonzero(m)))
    reader = lines.ShardReader(str(tmp_path), paths, 6)
    for visit in (1, 2):
        count, last = reader.probe(hi, lo)
        assert (count == 9).all() and last.tolist() == list(range(3000))
        assert reader.reads == (6 if visit == 1 else 11)  # the second visit starts with the one at hand


@pytest.mark.parametrize("first", [False, True])
def test_repeats(spark, docs, none, first, monkeypatch):
    length = 120
    rows = [(r[0], r[1]) for r in corpus()]
    copies = Counter(rows)
    low = -(2**63)
    at = defaultdict(set)
    for d, t in copies:
        b = (t or "").encode()
        for s in range(len(b) - length + 1):
            at[b[s:s + length]].add((low if d is None else d, b, s))
    want = Counter()
    for (d, t), n in copies.items():
        b = (t or "").encode()
        m = np.zeros(len(b) + 1, int)
        for s in range(len(b) - length + 1):
            v = at[b[s:s + length]]
            hit = min(v) != (low if d is None else d, b, s) if first else len(v) > 1 or n > 1
            if hit:
                m[s] += 1
                m[s + length] -= 1
        cov = np.cumsum(m)[:len(b)] > 0
        spans = int((np.diff(np.concatenate([[0], cov.astype(int)])) == 1).sum())
        want[(d, len(b), int(cov.sum()), spans, bytes(np.frombuffer(b, np.uint8)[~cov]))] += n
    for hot in (8192, 2):  # the second sends almost every anchor the other way
        monkeypatch.setattr("spliceloom.llm.repeats.HOT", hot)
        out = without_repeats(docs, length, keep_first=first)
        got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["_kept"])) for r in out.collect())
        assert got == want
    assert without_repeats(none, length).count() == 0


@pytest.mark.parametrize("length", [8, 23, 64, 120])
def test_factor_arrays(length):
    """Order, common prefixes and longest previous and next factors of cut suffixes, against comparing all pairs."""
    r = random.Random(length)
    for texts in ([bytes(r.choice(b"ab") for _ in range(r.randint(length, length + 60))) for _ in range(4)], [b"ab" * 90, b"ab" * 70 + b"c", b"z" * 150], [bytes(range(256))[:length]] * 3, [r.randbytes(length + 30)] * 2 + [r.randbytes(length)]):
        data, starts, row, offset = repeats.suffixes(texts, length)
        suffix = [texts[i][o:o + length] for i, o in zip(row, offset)]
        order, lcp = repeats.suffix_order(data, starts, length)
        common = lambda a, b: next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), length)
        assert [suffix[k] for k in order] == sorted(suffix)
        assert lcp.tolist() == [0] + [common(suffix[a], suffix[b]) for a, b in zip(order, order[1:])]
        position = np.array(r.sample(range(10 ** 6), len(starts)))
        previous, following = repeats.factors(data, starts, position, length)
        for k, s in enumerate(suffix):
            assert previous[k] == max((common(s, t) for t, p in zip(suffix, position) if p < position[k]), default=0)
            assert following[k] == max((common(s, t) for t, p in zip(suffix, position) if p > position[k]), default=0)
    order, lcp = repeats.suffix_order(np.zeros(0, np.uint8), np.zeros(0, np.int64), length)
    assert len(order) == len(lcp) == 0


def test_mixing(docs, none):
    rows = docs.withColumn("n", F.size(F.split(F.coalesce("text", F.lit("")), " ")).cast("long"))
    out, copies = mix(rows, "n", "source", ["doc_id"], [3, 1, 2])
    got = out.collect()
    assert len(got) == len(corpus())
    totals, taken, target, largest = defaultdict(int), defaultdict(int), {}, max(r["n"] for r in got)
    for r in got:
        totals[r["source"]] += r["n"]
        taken[r["source"]] += r["n"] * len(r["shards"])
        target[r["source"]] = r["target"]
        assert len(r["shards"]) <= 2
    assert all(r["source_size"] == totals[r["source"]] for r in got)
    left, open_, want = 1.5 * sum(totals.values()), dict(zip(["a", "b", None], [3, 1, 2])), {}
    while open_:
        level = left / sum(open_.values())
        full = [s for s in open_ if level * open_[s] >= 2 * totals[s]]
        if not full:
            want |= {s: level * w for s, w in open_.items()}
            break
        for s in full:
            want[s] = 2.0 * totals[s]
            left -= want[s]
            del open_[s]
    assert all(abs(target[s] - want[s]) < 1e-6 * want[s] for s in want)
    assert all(abs(taken[s] - want[s]) <= largest for s in want)
    c = copies.collect()
    assert Counter((r["doc_id"], r["_shard"]) for r in c) == Counter((r["doc_id"], s) for r in got for s in r["shards"])
    summed = defaultdict(int)
    for r in c:
        summed[r["source"]] += r["n"]
    assert summed == {s: n for s, n in taken.items() if n}
    assert "shuffle_key" in copies.columns and {r["_shard"] for r in c} <= set(range(8))
    assert sorted(map(str, mix(rows, "n", "source", ["doc_id"], [3, 1, 2])[0].collect())) == sorted(map(str, got))
    a, b = mix(none.withColumn("n", F.lit(1)), "n", "source", ["doc_id"], [3, 1, 2])
    assert a.count() == b.count() == 0


def test_mixing_of_one_large_source(spark):
    """Many rows in the cut block, one key that repeats, sizes of 0: the target is met within one key, and whole blocks go to one shard."""
    r = random.Random(3)
    rows = [(i, "big", r.randint(0, 9)) for i in range(20_000)] + [(77, "big", 3)] * 40 + [(-1, "small", 5), (-2, "none", 0)]
    df = spark.createDataFrame(rows, "doc_id long, source string, n int").repartition(6)
    out, copies = mix(df, "n", "source", ["doc_id"], [3, 1, 2], share=0.7)
    got = out.collect()
    big = [x for x in got if x["source"] == "big"]
    assert abs(sum(x["n"] * len(x["shards"]) for x in big) - big[0]["target"]) <= 41 * 9 and len({str(x["shards"]) for x in big if x["doc_id"] == 77}) == 1
    of = defaultdict(set)
    for x in copies.withColumn("block", F.shiftrightunsigned(F.xxhash64(F.lit(11), "doc_id"), 56)).collect():
        of[x["source"], x["block"], x["copy"]].add(x["shard"])
    assert all(len(v) == 1 for v in of.values()) and len(set.union(*of.values())) == 8


SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    cur = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    assert sorted(repr([r[c] for c in cols]) for r in df.collect()) == sorted(repr([dict(zip(names, r))[c] for c in cols]) for r in cur.fetchall())


def test_contract_columns(spark):
    want = {"op1_sharding": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"}, "op7_chat_formatting": {"conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"},
            "op10_mixing": {"doc_id", "size", "source_size", "target", "taken", "shards"}, "op11_ngram_join": {"doc_id", "n_shingles", "component_id"},
            "op12_tokenizer_alignment": {"doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"}, "op13_spelling_variants": {"word", "form", "root", "n", "n_near", "form_n"}}
    for name, cols in want.items():
        assert set(queries.QUERIES[name](spark, SF).columns) == cols


def test_pipeline(spark, tmp_path):
    out = corpus_pipeline.run(spark, SF)
    rows = out.collect()
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontamination", "mixing", "sharding"]
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    ok = {r["doc_id"] for r in quality_rules(spark.read.parquet(f"{SF}/documents.parquet")).filter("kept").collect()}
    assert rows and {r["doc_id"] for r in rows} <= ok and max(Counter(r["doc_id"] for r in rows).values()) <= 2
    assert all(r["text"] == docs[r["doc_id"]]["text"] for r in rows)
    sets = {r["doc_id"]: shingles(r["text"]) for r in rows}
    ids = sorted(sets)
    assert not [(a, b) for i, a in enumerate(ids) for b in ids[:i] if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    items = [shingles(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert not [i for i in ids for q in items if q and 100 * len(q & sets[i]) >= 80 * len(q)]
    assert {r["shard"] for r in rows} <= set(range(8))
    assert hashlib.sha256(repr(sorted((r["doc_id"], r["shard"], r["slot"]) for r in rows)).encode()).hexdigest() == hashlib.sha256(
        repr(sorted((r["doc_id"], r["shard"], r["slot"]) for r in corpus_pipeline.run(spark, SF).collect())).encode()).hexdigest()
