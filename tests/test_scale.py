"""Steps that must not repeat work or fill one task as the tables grow."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from spliceloom.functions import sequence as Q
from spliceloom.operators import transcripts as TR
from spliceloom.plans import load
from spliceloom.plans import proxy as P
from spliceloom.plans.registry import QUERIES
from spliceloom.sources import text as S


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """40 orders of 4 line items each, two customers a gene."""
    sf = str(tmp_path_factory.mktemp("tables"))
    k = F.col("id")
    spark.range(40).select(k.alias("o_orderkey"), (k % 8).alias("o_custkey"), F.element_at(F.array(*map(F.lit, "FOP")), (k % 3 + 1).cast("int")).alias("o_orderstatus"),
                           F.lit("1-URGENT").alias("o_orderpriority")).write.parquet(f"{sf}/orders.parquet")
    spark.range(160).select(F.floor(k / 4).alias("l_orderkey"), (k % 4 + 1).cast("int").alias("l_linenumber"), (k * 7 % 5).alias("l_partkey"), (k * 3 % 7).alias("l_suppkey"),
                            (k % 50).cast("double").alias("l_quantity")).write.parquet(f"{sf}/lineitem.parquet")
    return sf


def test_large_tables_are_dealt_out_by_rows(spark, tables, monkeypatch):
    want = sorted(map(str, P.isoforms(spark, tables).collect()))
    monkeypatch.setattr(P, "TASK_ROWS", 8)
    dealt = P.isoforms(spark, tables)
    assert dealt.rdd.getNumPartitions() == 20 and sorted(map(str, dealt.collect())) == want


def test_utr_sides_come_from_one_pass(spark, capsys):
    rows = [("c", "p", "+", 0, 100, 20, 70, [(0, 30), (50, 100)]), ("c", "m", "-", 0, 100, 60, 100, [(0, 30), (50, 100)]), ("c", "n", "+", 0, 100, 0, 100, [(0, 100)])]
    m = spark.createDataFrame(rows, "chrom string, trans string, strand string, start long, end long, cds_start long, cds_end long, exons array<struct<s:long,e:long>>")
    got = TR.features(m, "utr")
    assert sorted((r["trans"], r["side"], r["start"], r["end"], r["index"]) for r in got.collect()) == [
        ("m", "L", 0, 30, 2), ("m", "L", 50, 60, 1), ("p", "L", 0, 20, 1), ("p", "R", 70, 100, 1)]
    five, three = (sorted((r["trans"], r["start"]) for r in TR.features(m, "utr", p).collect()) for p in (5, 3))
    assert five == [("p", 0)] and three == [("m", 0), ("m", 50), ("p", 70)]
    got.explain()
    assert "Union" not in capsys.readouterr().out


def test_sam_lines_are_built_once(spark, capsys):
    tail = ["0", "chr1", "5", "60", "3M", "*", "0", "0", "AAA", "*"]
    rows = [("@HD", ["VN:1.6"]), ("a", [*tail, "RG:Z:REF", "NH:i:1", "RG:Z:ALT"]), ("b", [*tail, "RG:Z:ALT", "NH:i:2"]), ("c", [*tail, "NH:i:1"]), ("d", [*tail, "NH:i:1", "RG:Z:ALT"])]
    lines = spark.createDataFrame(rows, "name string, rest array<string>").select(F.concat_ws("\t", "name", "rest").alias("value"))
    got = S.allele_reads(S.sam(lines))
    assert sorted(map(tuple, got.collect())) == [("a", "REF"), ("d", "ALT")]
    got.explain()
    plan = capsys.readouterr().out
    assert plan.count("concat_ws(") == 1 and plan.count("map_from_entries(") == 1
    S.sam(lines).filter("not mapped").select("name").explain()
    assert capsys.readouterr().out.count("concat_ws(") == 1


@pytest.mark.parametrize("name", ["reads_with_moved_junctions", "read_loci", "utr_features"])
def test_isoforms_are_built_once(spark, tables, monkeypatch, name):
    load()
    calls, slots = [], P.slots
    monkeypatch.setattr(P, "slots", lambda *a: calls.append(1) or slots(*a))
    assert QUERIES[name](spark, tables).count() > 0 and len(calls) == 1


def plain_orf(s):
    """Codon by codon: the longest run from an ATG to a stop or the last whole codon."""
    best = (0, 0, -1)
    for frame in range(3):
        start = None
        for i in range(frame, len(s) - 2, 3):
            codon = s[i:i + 3]
            if start is None and codon == "ATG":
                start = i
            if start is not None and (codon in ("TAA", "TAG", "TGA") or i + 6 > len(s)):
                closed = codon in ("TAA", "TAG", "TGA")
                best = min(best, (start, i + 3, 1 if closed else -1), key=lambda o: (o[0] - o[1], o[0]))
                start = None
    return best


@pytest.mark.parametrize("together", [1, 50, 1 << 20])
def test_open_frames_of_many_texts_take_few_steps(monkeypatch, together):
    r, step, taken = np.random.default_rng(4), Q.orfs_in, []
    monkeypatch.setattr(Q, "TOGETHER", together)
    monkeypatch.setattr(Q, "orfs_in", lambda x, off: taken.append(len(off) - 1) or step(x, off))
    few = [None, "", "A", "AT", "ATG", "GATG", "ATGA", "TAA", "ATGTAAATGTAG", "ATGAAATAAATGAAATAA", "éATGé", "ATGNTAG", "atgtaa", None]
    texts = few + ["".join(r.choice(list("ATGTGAATGACN"), r.integers(0, 60))) for _ in range(1000)]
    got = Q.longest_orf.func(pd.Series(texts, dtype=object))
    assert list(map(str, got.dtypes)) == ["Int32"] * 3
    for s, o in zip(texts, got.itertuples(index=False)):
        assert all(v is pd.NA for v in o) if s is None else tuple(o) == plain_orf(s), (s, o)
    assert sum(taken) == len(texts) - 2 and (len(taken) == 1 or together < 1 << 20)
    assert Q.longest_orf.func(pd.Series([], dtype=object)).empty
