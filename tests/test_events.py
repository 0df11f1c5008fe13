"""Hand-made genes with known events."""

from pyspark.sql import functions as F

from spliceloom.operators import events as E
from spliceloom.sources.sinks import event_lines

GENES = [
    ("chr1", "+", "G1", 1, [(100, 200), (300, 400), (500, 600)]),
    ("chr1", "+", "G1", 2, [(100, 200), (500, 600)]),
    ("chr1", "+", "G1", 3, [(100, 400), (500, 600)]),
    ("chr2", "-", "G2", 4, [(100, 200), (300, 400)]),
    ("chr2", "-", "G2", 5, [(100, 230), (300, 400)]),
    ("chr2", "-", "G2", 6, [(100, 205), (300, 400)]),
]


def isoforms(spark, rows=GENES):
    return spark.createDataFrame(
        [(c, s, g, i, x[0][0], x[-1][1], x, 1) for c, s, g, i, x in rows],
        "chrom string, strand string, gene string, iso long, start long, end long, exons array<struct<s:bigint,e:bigint>>, reads long")


def ids(df):
    return {(r["event_id"], r["n_inc"], r["n_exc"], r["psi"]) for r in df.collect()}


def test_ir(spark):
    assert ids(E.retained_introns(isoforms(spark))) == {("G1:200-300", 1, 1, 500.0)}


def test_se(spark):
    assert ids(E.skipped_exons(isoforms(spark))) == {("G1:200@300-400@500", 1, 1, 500.0)}


def test_alternative_sites(spark):
    a5 = E.alternative_sites(isoforms(spark), "A5SS").collect()
    assert [(r["event_id"], tuple(r["inc_junc"]), tuple(r["exc_junc"])) for r in a5] == [("G1:200-400", (400, 500), (200, 500))]
    a3 = {(r["event_id"], tuple(r["inc_junc"]), tuple(r["exc_junc"])) for r in E.alternative_sites(isoforms(spark), "A3SS").collect()}
    assert a3 == {("G2:200-230", (230, 300), (200, 300)), ("G2:205-230", (230, 300), (205, 300))}


def test_members_match_counts(spark):
    iso = isoforms(spark)
    m = {(r["as_type"], r["event_id"], r["side"], r["iso"]) for r in E.all_members(iso).collect()}
    assert ("IR", "G1:200-300", "inc", 3) in m and ("IR", "G1:200-300", "exc", 1) in m
    assert ("SE", "G1:200@300-400@500", "inc", 1) in m and ("SE", "G1:200@300-400@500", "exc", 2) in m
    assert ("A3SS", "G2:205-230", "exc", 6) in m and ("A3SS", "G2:205-230", "inc", 5) in m


def test_long_member_lists_split_into_parts(spark):
    rows = [("chr1", "+", "G", i, [(100, 400 + 10 * (i % 3))]) for i in range(60)] + [("chr1", "+", "G", 100, [(100, 200), (300, 390)])]
    iso = isoforms(spark, rows)
    ev, mem = E.retained_introns(iso), E.event_members(iso, "IR")
    parts = event_lines(ev, mem, ["event_id"], per_line=10).collect()
    assert len(parts) > 1
    got = sorted(int(x) for p in parts for x in p["inc_isos"].split(",") if x)
    assert got == list(range(60))


def test_sites_of_ids(spark):
    rows = E.splice_site_rows(E.skipped_exons(isoforms(spark)), "SE").collect()
    assert {(r["left"], r["right"], r["side"]) for r in rows} == {(200, 300, "inc"), (400, 500, "inc"), (200, 500, "exc")}


def test_one_gene_may_hold_most_rows(spark):
    """Many copies of a structure change the counts, not the events."""
    rows = GENES + [("chr1", "+", "G1", 100 + k, GENES[0][4]) for k in range(300)]
    r = E.retained_introns(isoforms(spark, rows)).collect()
    assert [(x["n_inc"], x["n_exc"]) for x in r] == [(1, 301)]


def test_novel_skip_gets_single_gene(spark):
    skips = spark.createDataFrame([("chr1", "+", 200, 500, "300-400", "reads", "Novel", 3, 4, 750), ("chr1", "+", 900, 990, "950-960", "reads", "Novel", 1, 2, 500)],
                                  "chrom string, strand string, left long, right long, chain string, source string, gene string, skip_count long, total long, psi long")
    got = {r["left"]: r["gene"] for r in E.name_novel_skips(skips, isoforms(spark).select("gene", "chrom", "strand", "exons")).collect()}
    assert got == {200: "G1", 900: "Novel"}


def test_annotation_limits_events(spark):
    m = spark.createDataFrame([("G1", 0, 250)], "gene string, tx_start long, tx_end long")
    assert E.retained_introns(isoforms(spark), models=m).count() == 1
    m = spark.createDataFrame([("G1", 400, 450)], "gene string, tx_start long, tx_end long")
    assert E.retained_introns(isoforms(spark), models=m).filter(F.col("gene") == "G1").count() == 0


def brute_skips(rows):
    """SE events by the rule, isoform by isoform."""
    out = {}
    for _, _, g, _, x in rows:
        for _, _, g2, i, y in rows:
            if g != g2:
                continue
            for (_, l), (r, _) in zip(x, x[1:]):
                ends, starts = [e for _, e in y], [s for s, _ in y]
                if l in ends and r in starts and starts.index(r) > ends.index(l) + 1:
                    inner = tuple(y[ends.index(l) + 1:starts.index(r)])
                    out.setdefault((g, l, r, inner), set()).add(i)
    return {(g, f"{g}:{l}@{';'.join(f'{s}-{e}' for s, e in inner)}@{r}", len(v), sum(any((a[1], b[0]) == (l, r) for a, b in zip(x, x[1:])) for _, _, h, _, x in rows if h == g)) for (g, l, r, inner), v in out.items()}


def test_skips_of_random_genes(spark):
    import random
    r = random.Random(11)
    rows = []
    for g in range(6):  # the last gene holds most isoforms and long chains
        slots = [(100 * k, 100 * k + r.choice([40, 40, 50])) for k in range(4 if g < 5 else 14)]
        for _ in range(8 if g < 5 else 60):
            keep = sorted(r.sample(range(len(slots)), r.randint(2, len(slots))))
            rows.append(("c", "+" if g % 2 else "-", f"G{g}", len(rows), [slots[k] for k in keep]))
    iso = isoforms(spark, rows)
    ev = E.skipped_exons(iso)
    assert {(x["gene"], x["event_id"], x["n_inc"], x["n_exc"]) for x in ev.collect()} == brute_skips(rows)
    mem = E.event_members(iso, "SE").groupBy("event_id", "side").agg(F.count(F.lit(1)).alias("n")).collect()
    n = {(m["event_id"], m["side"]): m["n"] for m in mem}
    assert all(n[e, "inc"] == i and n[e, "exc"] == x for _, e, i, x in brute_skips(rows))
    keys = E._skips(iso)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" in keys and not any("exons" in line or "tail" in line for line in keys.split("\n") if "hashpartitioning" in line)


def test_event_types_share_what_they_read(spark, monkeypatch):
    """The isoforms, their variants and the skips are written once for events and members together, and both are as for each type alone."""
    made = []
    keep = E.written
    monkeypatch.setattr(E, "written", lambda df, name: made.append(name) or keep(df, name))
    iso = isoforms(spark)
    base = E.Shared(iso)
    ev, mem = E.all_events(base), E.all_members(base)
    assert sorted(made) == ["edges", "isoforms", "skips", "variants"]
    kinds = {"IR": E.retained_introns(iso), "SE": E.skipped_exons(iso), **{t: E.alternative_sites(iso, t) for t in ("A3SS", "A5SS")}}
    cols = ["event_id", "lo", "hi", "n_inc", "n_exc", "w_inc", "w_exc"]
    assert sorted((r["as_type"], *[r[c] for c in cols]) for r in ev.collect()) == sorted((t, *[r[c] for c in cols]) for t, df in kinds.items() for r in df.collect())
    cols = ["event_id", "gene", "side", "iso", "reads"]
    want = sorted((t, *[r[c] for c in cols]) for t in kinds for r in E.event_members(iso, t).collect())
    assert sorted((r["as_type"], *[r[c] for c in cols]) for r in mem.collect()) == want
