"""Tile joins and cell scans against brute force on random intervals."""

import random

import pytest
from pyspark.sql import functions as F

from spliceloom.functions import blocks as B
from spliceloom.operators import overlap as O
from spliceloom.operators import sweeps as W


def spans(rng, n, far=3000, longest=60, wide=0.1):
    out = []
    for i in range(n):
        s = rng.randrange(far)
        size = rng.randrange(1, longest) if rng.random() > wide else rng.randrange(1000, 2500)
        out.append((rng.choice("ab"), s, s + size, i))
    return out


@pytest.mark.parametrize("hot,touching", [(None, False), (5, False), (None, True)])
def test_overlap_join_equals_brute_force(spark, hot, touching):
    rng = random.Random(7)
    a, b = spans(rng, 120), spans(rng, 120)
    da = spark.createDataFrame(a, "k string, start long, end long, i long")
    db = spark.createDataFrame(b, "k string, r_start long, r_end long, j long")
    got = sorted((r["i"], r["j"]) for r in O.overlap_join(da, db, ["k"], tile=8, hot_rows=hot, touching=touching).collect())
    meet = (lambda x, y: x[1] <= y[2] and y[1] <= x[2]) if touching else (lambda x, y: x[1] < y[2] and y[1] < x[2])
    assert got == sorted((x[3], y[3]) for x in a for y in b if x[0] == y[0] and meet(x, y))


@pytest.mark.parametrize("gap,touch", [(0, False), (0, True), (25, True)])
def test_islands_equal_brute_force(spark, gap, touch):
    rng = random.Random(3)
    rows = spans(rng, 150, far=20000, longest=90, wide=0.02)
    df = spark.createDataFrame(rows, "k string, start long, end long, i long")
    got = {(r["k"], r["start"]): (r["island_start"], r["island_no"]) for r in W.numbered_islands(df, ["k"], gap=gap, join_touching=touch, width=64).collect()}
    for key in "ab":
        reach, first, no = None, None, 0
        for _, s, e, _ in sorted((r for r in rows if r[0] == key), key=lambda r: r[1]):
            if reach is None or (s > reach + gap if touch else s >= reach + gap):
                first, no = s, no + 1
            # equal starts are one point: their first island holds
            if got[(key, s)] != (first, no):
                assert False, (key, s, got[(key, s)], first, no)
            reach = e if reach is None else max(reach, e)


def test_running_folds(spark):
    rng = random.Random(5)
    rows = [("a", p, rng.randrange(50)) for p in rng.sample(range(5000), 200)]
    df = spark.createDataFrame(rows, "k string, p long, v long")
    got = {r["p"]: (r["s"], r["s_before"], r["m"]) for r in W.running(df, ["k"], "p", width=37, s=("sum", "v"), m=("max", "v")).collect()}
    total, top = 0, None
    for _, p, v in sorted(rows, key=lambda r: r[1]):
        before = total
        total += v
        top = v if top is None else max(top, v)
        assert got[p] == (total, before, top)


def test_nearest_keeps_ties_and_signs(spark):
    pts = spark.createDataFrame([("c", "+", 100, 101), ("c", "-", 100, 101), ("c", "+", 500, 501)], "chrom string, strand string, start long, end long")
    fts = spark.createDataFrame([("c", "+", 90, 95), ("c", "+", 106, 110), ("c", "-", 101, 103), ("c", "+", 480, 520)], "chrom string, strand string, f_start long, f_end long")
    got = {(r["strand"], r["start"], r["f_start"], r["distance"]) for r in O.nearest(pts, fts, ["chrom", "strand"]).collect()}
    assert got == {("+", 100, 90, -6), ("+", 100, 106, 6), ("-", 100, 101, -1), ("+", 500, 480, 0)}


def test_neighbour(spark):
    s = spark.createDataFrame([("c", p) for p in (10, 20, 25, 25, 90)] + [("d", 5)], "chrom string, pos long")
    got = {r["pos"]: (r["near"], r["distance"]) for r in O.neighbour(s, ["chrom"], "pos").collect()}
    assert got == {10: (20, 10), 20: (25, 5), 25: (25, 0), 90: (25, 65)}


def test_quantiles_and_adjusted_p(spark):
    v = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0]
    df = spark.createDataFrame([("k", x) for x in v], "k string, x double")
    import numpy as np
    r = W.exact_quantiles(df, ["k"], "x", q1=0.25, m=0.5, q3=0.75).first()
    assert [r["q1"], r["m"], r["q3"]] == list(np.quantile(v, [0.25, 0.5, 0.75]))
    p = [0.001, 0.01, 0.01, 0.04, 0.2, 0.9, 1e-9]
    got = {r["p"]: r["p_adj"] for r in W.bh_adjusted(spark.createDataFrame([(x,) for x in p], "p double")).collect()}
    order = sorted(p, reverse=True)
    best, want = 1.0, {}
    for k, x in enumerate(order):
        best = min(best, x * len(p) / (len(p) - k))
        want[x] = min(best, want.get(x, 1.0))
    assert all(abs(got[x] - want[x]) < 1e-12 for x in p)


def lists(spark, a, b=None):
    t = "array<struct<s:bigint,e:bigint>>"
    return spark.createDataFrame([(a, b or [])], f"a {t}, b {t}")


def as_pairs(v):
    return [(x["s"], x["e"]) for x in v]


def test_block_algebra_on_random_lists(spark):
    rng = random.Random(11)
    rows = []
    for _ in range(40):
        one = lambda: sorted((s, s + rng.randrange(1, 12)) for s in rng.sample(range(80), rng.randrange(1, 5)))
        rows.append((one(), one()))
    t = "array<struct<s:bigint,e:bigint>>"
    df = spark.createDataFrame(rows, f"a {t}, b {t}")
    m = B.merge(F.col("a"))
    out = df.select("a", "b", m.alias("m"), B.merge(m).alias("mm"), B.subtract(m, F.col("b")).alias("d"), B.union(F.col("a"), F.col("b")).alias("u"),
                    B.overlap_length(m, B.merge(F.col("b"))).alias("n")).collect()
    bases = lambda v: {p for x in v for p in range(x["s"], x["e"])}
    for r in out:
        assert r["m"] == r["mm"]
        assert bases(r["m"]) == bases(r["a"])
        assert bases(r["d"]) == bases(r["a"]) - bases(r["b"])
        assert bases(r["u"]) == bases(r["a"]) | bases(r["b"])
        assert r["n"] == len(bases(r["a"]) & bases(r["b"]))


def test_block_goldens(spark):
    df = lists(spark, [(1, 5), (3, 9), (20, 30)])
    assert as_pairs(df.select(B.merge(F.col("a")).alias("x")).first()["x"]) == [(1, 9), (20, 30)]
    one = lists(spark, [(5, 9)])
    assert one.select(B.introns(F.col("a")).alias("x")).first()["x"] == []
    tr = lists(spark, [(10, 20), (30, 45), (60, 70)])
    x = F.col("a")
    r = tr.select(B.frames(x, F.lit(15), F.lit(65), F.lit("+")).alias("f"), B.frames(x, F.lit(15), F.lit(65), F.lit("-")).alias("g"),
                  B.clip(x, F.lit(12), F.lit(14)).alias("c"), B.from_introns(F.lit(10), F.lit(70), B.introns(x)).alias("back")).first()
    assert r["f"] == [0, 2, 2] and r["g"] == [2, 2, 0]
    assert as_pairs(r["c"]) == [(12, 14)]
    assert as_pairs(r["back"]) == [(10, 20), (30, 45), (60, 70)]
