"""Events by their edges against all pairs of exons, and how often event queries deal out their rows."""

import random

import pytest
from pyspark.sql import functions as F

from spliceloom.operators import events as E
from spliceloom.operators import significance as S

SCHEMA = "gene long, chrom string, strand string, iso long, start long, end long, exons array<struct<s:long,e:long>>, reads long"


def made(n, seed):
    r, rows = random.Random(seed), []
    for i in range(n):
        gene = r.randrange(3)
        at, exons = r.randrange(0, 40), []
        for _ in range(r.randrange(1, 6)):
            size = r.choice([15, 40, 300, 9000 if r.random() < 0.1 else 60])
            exons.append((at, at + size))
            at += size + r.choice([4, 12, 50, 200])
        rows.append((gene, f"chr{gene}", "+-"[gene % 2], i % (n - 5), exons[0][0], exons[-1][1], exons, r.randrange(1, 4)))  # some ids repeat
    return rows


def by_pairs(rows, kind, offset, extension):
    """{event: (inc rows, exc rows, smallest junctions)} from all pairs of exons of a gene."""
    out = {}
    for gene in {x[0] for x in rows}:
        own = [x for x in rows if x[0] == gene]
        left = own[0][2] == ("+" if kind == "A3SS" else "-")
        ex = []
        for i, x in enumerate(own):
            for k, (s, e) in enumerate(x[6]):
                before, after = (x[6][k - 1][1] if k else None), (x[6][k + 1][0] if k + 1 < len(x[6]) else None)
                if (before if left else after) is not None:
                    ex.append((s, e, before, s, i) if left else (-e, -s, -after, -e, i))
        for a in ex:
            for b in ex:
                if b[0] - a[0] > offset and b[0] < a[1] + extension and a[0] - b[2] > offset:
                    key = (gene, *sorted((abs(a[0]), abs(b[0]))))
                    inc, exc = out.setdefault(key, (set(), set()))
                    inc.add((a, a[4])), exc.add((b, b[4]))
    counted = {}
    for key, sides in out.items():
        own = [x for x in rows if x[0] == key[0]]
        left = own[0][2] == ("+" if kind == "A3SS" else "-")
        junction = lambda x: (x[2], x[0]) if left else (-x[0], -x[2])
        counted[key] = tuple(v for side in sides for v in (len(side), sum(own[i][7] for _, i in side), min(junction(x) for x, _ in side)))
    return counted


@pytest.mark.parametrize("offset,extension", [(5, 0), (0, 10)])
def test_site_events_equal_all_pairs_of_exons(spark, offset, extension):
    rows = made(60, 3)
    iso = spark.createDataFrame(rows, SCHEMA)
    for kind in ("A3SS", "A5SS"):
        got = {(r["gene"], r["lo"], r["hi"]): (r["n_inc"], r["w_inc"], tuple(r["inc_junc"]), r["n_exc"], r["w_exc"], tuple(r["exc_junc"]))
               for r in E.alternative_sites(iso, kind, offset, extension).collect()}
        want = by_pairs(rows, kind, offset, extension)
        assert got == want and len(want) > 20
        if not extension:
            n = {(r["event_id"], r["side"]): (r["n"], r["w"]) for r in E.event_members(iso, kind, offset).groupBy("event_id", "side").agg(F.count(F.lit(1)).alias("n"), F.sum("reads").alias("w")).collect()}
            assert n == {(f"{g}:{lo}-{hi}", s): v[i:i + 2] for (g, lo, hi), v in want.items() for s, i in (("inc", 0), ("exc", 3))}


def dealt(df, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return [x for x in df._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange hashpartitioning" in x]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_event_types_deal_their_rows_out_seldom(spark):
    iso = spark.createDataFrame(made(40, 5), SCHEMA)
    v = E.exon_variants(iso)
    assert len(dealt(E.retained_introns(iso, variants=v), spark)) <= 5
    base = E.Shared(iso)
    assert set(base.edges.columns) == {"gene", "chrom", "strand", "left", "a", "b"}  # pairs of edges, no exons
    folder = [f for f in base.skips.inputFiles()] and base.edges.inputFiles()
    assert all("zstd" in f for f in folder)


def test_chain_pairs_deal_members_out_by_event_once(spark):
    iso = spark.createDataFrame(made(40, 6), SCHEMA)
    members = E.all_members(iso).select("event_id", "gene", "side", "iso")
    pairs = S.chain_pairs(members, iso, 2)
    assert sum("event_id" in x for x in dealt(S.one_pair(pairs), spark)) == 2  # once a side
    want, chain = {}, {}
    for g, _, _, i, _, _, ex, r in made(40, 6):
        chain.setdefault((g, i), []).append((";".join(f"{a[1]}-{b[0]}" for a, b in zip(ex, ex[1:])) if len(ex) > 2 else "monoExon", r))
    for m in members.collect():
        for c, r in chain[m["gene"], m["iso"]]:
            if r >= 2:
                n = want.setdefault((m["event_id"], m["gene"]), {}).setdefault((m["side"], c), [0, 0])
                n[0] += 1
                n[1] += r
    want = sorted((*e, a, *x, b, *y) for e, t in want.items() for (s, a), x in t.items() if s == "inc" for (q, b), y in t.items() if q == "exc")
    assert sorted(tuple(r) for r in pairs.collect()) == want and want
