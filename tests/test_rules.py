"""Poly(A) peaks, junction edits, statistics, sequences and readers."""

import random

import pytest
from pyspark.sql import functions as F

from spliceloom.functions import coding as C
from spliceloom.functions import sequence as Q
from spliceloom.functions.stats import hypergeometric_tail
from spliceloom.operators import assign as A
from spliceloom.operators import polya as PA
from spliceloom.operators import significance as T
from spliceloom.session import durable
from spliceloom.sources import sequences as SQ
from spliceloom.sources import sinks as K
from spliceloom.sources import text as S

X = "array<struct<s:bigint,e:bigint>>"


def test_peak_clusters(spark):
    ends = [1000] * 6 + [1010] * 2 + [1100] * 5
    reads = spark.createDataFrame([("G", "c", "+", i, 900, e) for i, e in enumerate(ends)], "gene string, chrom string, strand string, iso long, start long, end long")
    c = PA.peak_clusters(PA.end_sites(reads), distance=24, window=3, support=5)
    got = {(r["start"], r["end"], r["n"], r["peak"]) for r in c.collect()}
    assert got == {(1000, 1000, 6, 1000), (1100, 1100, 5, 1100)}
    assert PA.cluster_reads(reads, c).count() == 11


def isoform(spark, exons, iso=1):
    return spark.createDataFrame([("c", "+", "G", iso, exons[0][0], exons[-1][1], exons, 1)],
                                 f"chrom string, strand string, gene string, iso long, start long, end long, exons {X}, reads long")


def corrected(spark, exons, junctions, motif="GT-AG"):
    j = spark.createDataFrame([("c", "+", a, b, 5) for a, b in junctions], "chrom string, strand string, js long, je long, cnt long")
    r = A.correct_junctions(isoform(spark, exons), j, j.withColumn("motif", F.lit(motif))).first()
    return r["outcome"], [(x["s"], x["e"]) for x in r["new_exons"]]


def test_junction_correction_outcomes(spark):
    ex = [(0, 100), (200, 300), (400, 500)]
    assert corrected(spark, ex, [(102, 200), (300, 400)]) == ("corrected", [(0, 102), (200, 300), (400, 500)])
    assert corrected(spark, ex, [(100, 200), (300, 400)]) == ("kept", ex)
    assert corrected(spark, ex, [(160, 200), (300, 400)])[0] == "restored"
    assert corrected(spark, ex, [(102, 200), (300, 400)], "AA-AA") == ("restored", ex)
    assert corrected(spark, ex, [(100, 310), (300, 400)])[0] == "dropped"


def test_junction_moves(spark):
    r = isoform(spark, [(0, 100), (200, 300), (400, 500)])
    def moved(a, b, ta, tb):
        m = spark.createDataFrame([("c", "+", a, b, ta, tb)], "chrom string, strand string, a long, b long, to_a long, to_b long")
        return [(x["s"], x["e"]) for x in A.move_junctions(r, m).first()["exons"]]
    assert moved(100, 200, 104, 206) == [(0, 104), (206, 300), (400, 500)]
    # the new junction would run into the next one, so it stays
    assert moved(100, 200, 104, 310) == [(0, 100), (200, 300), (400, 500)]


def test_two_sample_statistics(spark):
    rows = [("k", "inc", v) for v in (50.0, 60.0, 70.0, 80.0)] + [("k", "exc", v) for v in (90.0, 100.0, 110.0, 130.0)]
    r = T.two_sample(spark.createDataFrame(rows, "k string, side string, value double"), ["k"]).first()
    assert r["t"] == pytest.approx(-3.9703446152) and r["h"] == pytest.approx(5.3333333333) and r["p_h"] == pytest.approx(0.0209213353, abs=1e-9)
    assert r["p_t"] == pytest.approx(0.0073640592, abs=1e-7)


def test_chi_square_and_hypergeometric(spark):
    cells = spark.createDataFrame([("e", "h1", 10, 2), ("e", "h2", 3, 9), ("e", "h3", 0, 0)], "event string, haplo string, inc long, exc long")
    r = T.chi_square_table(cells, ["event"], "haplo").first()
    assert r["chi2"] == pytest.approx(6.0419580420) and r["dof"] == 1
    r = T.allele_association(cells, ["event"], alpha=0.05).first()
    assert (r["inc_haplo"], r["exc_haplo"]) == ("h1", "h2") and r["p"] == pytest.approx(0.0139697819, abs=1e-9)
    p = spark.createDataFrame([(2, 4, 5, 20)], "k long, n long, g long, m long").select(hypergeometric_tail("k", "n", "g", "m").alias("p")).first()["p"]
    assert p == pytest.approx(0.2487100103)


def brute_orf(seq):
    best = (0, 0, -1)
    for f in range(3):
        codons = [(seq[i:i + 3], i) for i in range(f, len(seq) - 2, 3)]
        start = None
        for codon, i in codons:
            if start is None and codon == "ATG":
                start = i
            elif start is not None and codon in ("TAG", "TAA", "TGA"):
                if (i + 3 - start, -start) > (best[1] - best[0], -best[0]):
                    best = (start, i + 3, 1)
                start = None
        if start is not None:
            end = codons[-1][1] + 3
            if (end - start, -start) > (best[1] - best[0], -best[0]):
                best = (start, end, -1)
    return best


def test_open_frames_and_fickett_against_restatement(spark):
    rng = random.Random(9)
    seqs = ["".join(rng.choice("ACGT") for _ in range(rng.randrange(2, 400))) for _ in range(60)] + ["ATGAAATAG", "CCATGAAA", "AC"]
    df = spark.createDataFrame(list(enumerate(seqs)), "id long, seq string")
    for r in df.select("id", Q.longest_orf(F.col("seq")).alias("o"), Q.fickett(F.col("seq")).alias("f")).collect():
        s = seqs[r["id"]]
        o = r["o"]
        got = (o["start"], o["end"], o["integrity"])
        want = brute_orf(s)
        assert got == want or (want[1] == 0 and got[1] - got[0] == 0), (s, got, want)
        score = 0.0
        for b in "ACGT":
            n = [s[k::3].count(b) for k in range(3)]
            for value, steps, table, weight in ((sum(n) / len(s), Q.FICKETT_CONTENT_STEPS, Q.FICKETT_CONTENT, Q.FICKETT_CONTENT_WEIGHT),
                                                (max(n) / (min(n) + 1.0), Q.FICKETT_POSITION_STEPS, Q.FICKETT_POSITION, Q.FICKETT_POSITION_WEIGHT)):
                score += next(p for st, p in zip(steps, table[b]) if value >= st) * weight[b]
        assert r["f"] == pytest.approx(score)


def test_coding_features(spark):
    r = C.coding_features(spark.createDataFrame([(1, "CCAUGAAAGACTGGTAG"), (2, "CCCC")], "id long, seq string")).orderBy("id").collect()
    assert (r[0]["orf_start"], r[0]["pep_len"], r[0]["integrity"]) == (3, 5, 1)
    assert 3 < r[0]["pi"] < 8
    assert (r[1]["orf_start"], r[1]["pep_len"], r[1]["integrity"], r[1]["pi"]) == (0, 0, -1, 0.0)


def test_reverse_complement_twice(spark):
    df = spark.createDataFrame([("ACGTTGCAN",)], "s string")
    assert df.select(Q.reverse_complement(Q.reverse_complement(F.col("s"))).alias("x")).first()["x"] == "ACGTTGCAN"


def test_fasta_in_small_blocks(spark, tmp_path):
    rng = random.Random(1)
    genome = {f"chr{i}": "".join(rng.choice("ACGT") for _ in range(n)) for i, n in ((1, 25_431), (2, 10_000), (3, 77))}
    path = tmp_path / "g.fa"
    path.write_text("".join(f">{k} note\n" + "".join(v[i:i + 60] + "\n" for i in range(0, len(v), 60)) for k, v in genome.items()))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        g = durable(SQ.read_genome(spark, str(path)))
        lines = SQ.fasta_lines(SQ.numbered_lines(spark, str(path)))
        assert {r["chrom"]: r["length"] for r in SQ.chrom_lengths(lines).collect()} == {k: len(v) for k, v in genome.items()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    for r in g.collect():
        assert r["seq"] == genome[r["chrom"]][r["chunk"] * 10_000:r["chunk"] * 10_000 + 11_000]
    spans = [("chr1", "+", 9_990, 10_020), ("chr1", "-", 5, 25_000), ("chr3", "+", 70, 90)]
    got = SQ.windows(g, spark.createDataFrame(spans, "chrom string, strand string, s long, e long"), "s", "e", "t", "strand").collect()
    want = genome["chr1"][5:25_000][::-1].translate(str.maketrans("ACGT", "TGCA"))
    assert {r["s"]: r["t"] for r in got} == {9_990: genome["chr1"][9_990:10_020], 5: want}


def test_spans_outside_their_sequence(spark):
    pieces = [("c", 0, "GTAACCGGAG"), ("d", 0, "ACGT" * 3000)]
    g = SQ.chunks(spark.createDataFrame(pieces, "chrom string, pos long, seq string"))
    rows = [("cut", "c", "+", [(0, 4), (8, 14)]), ("whole", "c", "-", [(0, 4), (8, 10)]), ("far", "x", "+", [(0, 4)]), ("none", "c", "+", []), ("long", "d", "+", [(1, 11_001)]), ("over", "d", "+", [(1, 12_001)])]
    tr = spark.createDataFrame(rows, "iso string, chrom string, strand string, exons array<struct<s:long,e:long>>")
    assert {r["iso"]: r["seq"] for r in SQ.spliced(g, tr).collect()} == {"cut": None, "whole": "CTTTAC", "far": None, "none": None, "long": ("ACGT" * 3000)[1:11_001], "over": None}
    introns = spark.createDataFrame([("c", "+", 0, 10), ("c", "-", 0, 10), ("c", "+", 0, 14), ("x", "+", 0, 10)], "chrom string, strand string, a long, b long")
    got = sorted((r["chrom"], r["strand"], r["b"], r["left_two"], r["motif"]) for r in SQ.splice_motifs(g, introns).collect())
    assert got == [("c", "+", 10, "GT", "GT-AG"), ("c", "+", 14, "GT", None), ("c", "-", 10, "GT", "CT-AC"), ("x", "+", 10, None, None)]
    twice = spark.createDataFrame([("d", "+", 1, 2_001)] * 2, "chrom string, strand string, s long, e long")
    assert [r["t"] for r in SQ.windows(g, twice, "s", "e", "t").collect()] == [("ACGT" * 3000)[1:2_001]] * 2


def test_fastq_in_small_blocks(spark, tmp_path):
    path = tmp_path / "r.fq"
    path.write_text("".join(f"@read{i} x\n{'ACGT' * (i % 5 + 1)}\n+\n{'IIII' * (i % 5 + 1)}\n" for i in range(200)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        got = {r["id"]: (r["seq"], r["qual"]) for r in SQ.fastq_records(SQ.numbered_lines(spark, str(path))).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {f"read{i}": ("ACGT" * (i % 5 + 1), "IIII" * (i % 5 + 1)) for i in range(200)}


def test_transcript_fasta(spark, tmp_path):
    (tmp_path / "t.fa").write_text(">a one\nACG\nT\n>b\nGG\n")
    assert {r["id"]: r["seq"] for r in SQ.fasta_records(spark, str(tmp_path / "t.fa")).collect()} == {"a": "ACGT", "b": "GG"}


def test_bed_round_trip(spark, tmp_path):
    df = isoform(spark, [(10, 20), (30, 45)]).withColumn("name", F.lit("r1")).withColumn("score", F.lit(3))
    K.write_lines(K.bed12_lines(df), str(tmp_path / "b"))
    r = S.read_bed12(spark, str(tmp_path / "b")).first()
    assert (r["name"], [(x["s"], x["e"]) for x in r["exons"]]) == ("r1", [(10, 20), (30, 45)])
    K.write_headed(df.select("name", "score"), str(tmp_path / "h"))
    assert S.headed(spark, str(tmp_path / "h")).first()["name"] == "r1"


def test_headed_sources(spark, tmp_path):
    (tmp_path / "hap.txt").write_text("#x\nhaplotype\tPB.1.1\tPB.1.2\nACG\t3\t4\n")
    assert sorted((r["haplo"], r["iso"], r["n"]) for r in S.read_haplotypes(spark, str(tmp_path / "hap.txt")).collect()) == [("ACG", "PB.1.1", 3), ("ACG", "PB.1.2", 4)]
    (tmp_path / "q.sf").write_text("Name\tLength\tEffectiveLength\tTPM\tNumReads\nT1\t9\t8\t1.5\t7\n")
    assert S.read_quant(spark, str(tmp_path / "q.sf")).first()["NumReads"] == 7
    sheet = spark.createDataFrame([("p", "s", "c", "1", "f", "paired", 150)], S.CONDITION_COLUMNS)
    assert S.condition_sheet(sheet).count() == 1
    assert S.condition_sheet(sheet.drop("repeat"), sheet.limit(0)).count() == 0
    with pytest.raises(ValueError):
        S.condition_sheet(sheet.drop("repeat"))
    (tmp_path / "f.txt").write_text("isoform\tisoLength\nPB.1\t5\n")
    assert S.read_features(spark, str(tmp_path / "f.txt")).columns == ["iso", "isoLength"]


def test_tail_by_ratios_equals_exact_sums(spark):
    from math import comb
    r = random.Random(4)
    rows = [(2, 4, 5, 20), (0, 3, 2, 9), (9, 3, 2, 9), (3, 9, 3, 9)]
    for _ in range(400):
        m = r.randint(1, 60)
        g, n = r.randint(0, m), r.randint(0, m)
        rows.append((r.randint(0, m), n, g, m))
    got = spark.createDataFrame(rows, "k long, n long, g long, m long").select("k", "n", "g", "m", hypergeometric_tail("k", "n", "g", "m").alias("p")).collect()
    for x in got:
        want = sum(comb(x["g"], i) * comb(x["m"] - x["g"], x["n"] - i) for i in range(x["k"], min(x["n"], x["g"]) + 1) if x["n"] - i <= x["m"] - x["g"] and x["n"] >= i) / comb(x["m"], x["n"])
        assert x["p"] == pytest.approx(want, abs=1e-12)


def test_tail_of_large_sets_in_bounded_memory():
    import tracemalloc
    import numpy as np
    import pandas as pd
    n = 10_000
    r = np.random.default_rng(1)
    g, d = r.integers(50_000, 100_000, n), r.integers(50_000, 100_000, n)
    m = np.full(n, 1_000_000)
    k = (g * d / m + r.normal(0, 60, n)).astype(int)
    tracemalloc.start()
    p = hypergeometric_tail.func(pd.Series(k), pd.Series(d), pd.Series(g), pd.Series(m))
    assert tracemalloc.get_traced_memory()[1] < 40e6
    tracemalloc.stop()
    z = (k - 0.5 - g * d / m) / np.sqrt(d * (g / m) * (1 - g / m) * (m - d) / (m - 1))
    from math import erfc
    normal = np.array([erfc(v / 2**0.5) / 2 for v in z])
    assert np.abs(p.to_numpy() - normal).max() < 0.01 and p.between(0, 1).all()


@pytest.mark.parametrize("kind", ["even", "tiny", "tied"])
def test_adjusted_p_on_sketched_cells(spark, monkeypatch, kind):
    import numpy as np
    from spliceloom.operators import sweeps as W
    monkeypatch.setattr(W, "CELL_VALUES", 50)
    r = np.random.default_rng(2)
    p = {"even": r.random(2000), "tiny": 10.0 ** -r.uniform(0, 250, 2000), "tied": r.choice(np.concatenate([[0.0, 1.0, 0.5] * 300, r.random(600)]), 2000)}[kind]
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(p)] + [(-1, None), (-2, float("nan"))], "id long, p double")
    got = {x["id"]: x["p_adj"] for x in W.bh_adjusted(df).collect()}
    order = np.argsort(-p, kind="stable")
    rank = np.array([(p <= x).sum() for x in p])
    want = np.empty(len(p))
    want[order] = np.minimum(1, np.minimum.accumulate((p * len(p) / rank)[order]))
    assert got.pop(-1) is None and got.pop(-2) is None
    assert np.allclose([got[i] for i in range(len(p))], want, rtol=1e-12)
    distinct = df.filter("p is not null and not isnan(p)").select("p").distinct()
    sizes = [x["count"] for x in distinct.withColumn("c", W.quantile_cells(distinct, "p")).groupBy("c").count().collect()]
    assert max(sizes) <= 2 * 50 + 2


def test_column_pick_by_index_range_and_name(spark):
    df = spark.createDataFrame([("N", "O", 1), ("N", "F", 2), (None, "O", 3)], "a string, b string, c long")
    assert [r[0] for r in S.pick(df, [(1, 2)], ":", equals="N:O").collect()] == ["N:O"]
    assert sorted(r[0] for r in S.pick(df, ["c", 1], "/").collect()) == ["1/N", "2/N", "3/"]
    assert S.pick(df, [3, "a"]).columns == ["c", "a"]
