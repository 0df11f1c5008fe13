"""Sequence text: genome chunks, motifs, profiles, coding features."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from spliceloom.functions import coding as C
from spliceloom.functions import sequence as Q
from spliceloom.operators import assign as A
from spliceloom.operators import polya as PA
from spliceloom.operators import report as R
from spliceloom.plans import proxy as P
from spliceloom.plans.registry import query, view
from spliceloom.session import bucketed
from spliceloom.sources import sequences as SQ


@query("genome_chunks", """
SELECT id AS chrom, c AS chunk, substr(seq, c * 10000 + 1, 11000) AS seq FROM seq_v, unnest(range(0, (length(seq) + 9999) // 10000)) t(c)""")
def genome_chunks(spark, sf):
    return P.genome(spark, sf).filter(F.length("seq") > 0)


@query("sequence_lengths", "SELECT id AS chrom, length(seq) AS length FROM seq_v")
def sequence_lengths(spark, sf):
    return SQ.chrom_lengths(P.sequences(spark, sf).select(F.col("id").alias("chrom"), "seq"))


@query("reverse_complements", "SELECT id, reverse(translate(seq, 'ACGT', 'TGCA')) AS rc FROM seq_v")
def reverse_complements(spark, sf):
    return P.sequences(spark, sf).select("id", Q.reverse_complement(F.col("seq")).alias("rc"))


@query("gc_content", "SELECT id, round((length(seq) - length(translate(seq, 'GC', '')))::DOUBLE / length(seq), 6) AS gc FROM seq_v WHERE length(seq) > 0")
def gc_content(spark, sf):
    return P.sequences(spark, sf).filter(F.length("seq") > 0).select("id", F.round(Q.gc(F.col("seq")), 6).alias("gc"))


@query("gc_along_reads", """
SELECT id, CAST(p AS BIGINT) AS part, round((length(w) - length(translate(w, 'GC', '')))::DOUBLE * 100 / length(w), 6) AS gc FROM (
  SELECT id, p, substr(seq, p * z + 1, z) AS w FROM (SELECT *, greatest(length(seq) // 20, 1) AS z FROM seq_v WHERE length(seq) > 0), unnest(range(0, (length(seq) + z - 1) // z)) t(p))""")
def gc_along_reads(spark, sf):
    r = P.dealt_sequences(spark, sf).filter(F.length("seq") > 0).select("id", F.explode(Q.gc_slices(F.col("seq"))).alias("x"))
    return r.select("id", F.col("x.part").cast("long").alias("part"), F.round("x.gc", 6).alias("gc"))


@query("base_statistics", """
SELECT doc_id AS id, length(text) - length(translate(text, 'aAeE', '')) AS hits, round((length(text) - length(translate(text, 'aAeE', '')))::DOUBLE / length(text), 6) AS fraction
FROM documents WHERE length(text) > 0""")
def base_statistics(spark, sf):
    d = P.table(spark, sf, "documents").filter(F.length("text") > 0)
    return d.select(F.col("doc_id").alias("id"), Q.count_of(F.col("text"), "aAeE").cast("long").alias("hits"), F.round(Q.base_fraction(F.col("text"), "ae"), 6).alias("fraction"))


@query("quality_statistics", """
SELECT id, CAST(list_sum(list_transform(c, lambda x: ascii(x) - 33)) AS BIGINT) AS qsum, round(list_sum(list_transform(c, lambda x: ascii(x) - 33))::DOUBLE / len(c), 6) AS qmean,
  len(list_filter(c, lambda x: ascii(x) - 33 < 34)) AS low, len(list_filter(c[-10:], lambda x: ascii(x) - 33 < 34)) > 0 AS bad_tail
FROM (SELECT id, string_split(seq, '') AS c FROM seq_v WHERE length(seq) >= 10)""")
def quality_statistics(spark, sf):
    s = F.col("seq")
    return P.dealt_sequences(spark, sf).filter(F.length(s) >= 10).select(
        "id", Q.quality_sum(s).alias("qsum"), F.round(Q.quality_mean(s), 6).alias("qmean"), Q.low_quality_count(s, 34).cast("long").alias("low"), Q.bad_tail(s, 10, 34).alias("bad_tail"))


@query("trimmed_reads", """
SELECT id, CASE WHEN length(seq) > 7 THEN substr(seq, 8) ELSE '' END AS left_cut, CASE WHEN length(seq) > 7 THEN substr(seq, 1, length(seq) - 7) ELSE '' END AS right_cut,
  regexp_replace(seq, '[AC]+$', '') AS pattern_cut, length(regexp_replace(seq, '[AC]+$', '')) AS qual_len FROM seq_v""")
def trimmed_reads(spark, sf):
    s = F.col("seq")
    cut = Q.trim_pattern(s, s, "[AC]+", 3)
    return P.sequences(spark, sf).select("id", Q.trim(s, 7, 5).alias("left_cut"), Q.trim(s, 7, 3).alias("right_cut"), cut.alias("c")).select(
        "id", "left_cut", "right_cut", F.col("c.seq").alias("pattern_cut"), F.length("c.qual").cast("long").alias("qual_len"))


@query("end_signals", """
SELECT id, right(seq, 6) IN ('AATAAA', 'AAATAA', 'ATAAAA', 'ATTAAA', 'ATAAAT', 'TAATAA', 'ATAAAG', 'AAAATA', 'CAATAA', 'ATAAAC', 'AAAAAG') AS signal FROM seq_v""")
def end_signals(spark, sf):
    return P.sequences(spark, sf).select("id", Q.has_end_signal(F.col("seq")).alias("signal"))


# an open run of codons counts to the last whole codon; stops close a run
COD = """
SELECT id, frame, i * 3 + frame AS pos, codon, coalesce(sum(CASE WHEN codon IN ('TAG', 'TAA', 'TGA') THEN 1 ELSE 0 END) OVER (PARTITION BY id, frame ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run
FROM (SELECT id, frame, generate_subscripts(c, 1) - 1 AS i, unnest(c) AS codon FROM (SELECT id, frame, regexp_extract_all(substr(seq, frame + 1), '(...)', 1) AS c FROM {text}, (VALUES (0), (1), (2)) f(frame)))"""
ORF = """
SELECT id, s, e, ok FROM (SELECT id, frame, run, min(pos) FILTER (codon = 'ATG') AS s, max(pos) + 3 AS e, CASE WHEN bool_or(codon IN ('TAG', 'TAA', 'TGA')) THEN 1 ELSE -1 END AS ok
  FROM {codons} GROUP BY id, frame, run) WHERE s IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY e - s DESC, s) = 1"""
view("cod_v", COD.format(text="seq_v"))
view("orf_v", ORF.format(codons="cod_v"))
view("ttx_v", "SELECT iso AS id, seq FROM tx_v")
view("tcod_v", COD.format(text="ttx_v"))
view("torf_v", ORF.format(codons="tcod_v"))


@query("longest_open_frames", """
SELECT v.id, coalesce(s, 0)::BIGINT AS start, coalesce(e, 0)::BIGINT AS "end", coalesce(ok, -1)::BIGINT AS integrity FROM seq_v v LEFT JOIN orf_v o ON o.id = v.id""")
def longest_open_frames(spark, sf):
    r = P.dealt_sequences(spark, sf).select("id", Q.longest_orf(F.col("seq")).alias("o"))
    return r.select("id", *[F.col(f"o.{c}").cast("long").alias(c) for c in ("start", "end", "integrity")])


def _fickett_sql(text):
    def table(value, steps, probs, weight):
        rows = " ".join(f"WHEN {value} >= {s}::DOUBLE THEN {p * weight!r}::DOUBLE" for s, p in zip(steps, probs))
        return f"CASE {rows} END"
    parts = []
    for b in "ACGT":
        n = [f"len(list_filter(c, lambda x, i: x = '{b}' AND (i - 1) % 3 = {k}))" for k in range(3)]
        parts.append(table(f"({n[0]} + {n[1]} + {n[2]})::DOUBLE / len(c)", Q.FICKETT_CONTENT_STEPS, Q.FICKETT_CONTENT[b], Q.FICKETT_CONTENT_WEIGHT[b]))
        parts.append(table(f"greatest({', '.join(n)}) / (least({', '.join(n)}) + 1.0::DOUBLE)", Q.FICKETT_POSITION_STEPS, Q.FICKETT_POSITION[b], Q.FICKETT_POSITION_WEIGHT[b]))
    return f"SELECT id, CASE WHEN len(c) >= 2 THEN {' + '.join(parts)} ELSE 0.0 END AS fickett FROM (SELECT id, string_split(seq, '') AS c FROM {text} WHERE length(seq) > 0)"


def _coding_sql(text, frames, scores):
    """Peptide, isoelectric point (sixty halvings of the pH range) and coding score, by the constants that the operator uses."""
    index = lambda k: f"(strpos('TCAG', substr(x, {k}, 1)) - 1)"
    letter = f"CASE WHEN least({index(1)}, {index(2)}, {index(3)}) < 0 THEN 'X' ELSE substr('{C.CODE}', CAST(1 + 16 * {index(1)} + 4 * {index(2)} + {index(3)} AS BIGINT), 1) END"
    end = lambda by, other, side: "CASE " + " ".join(f"WHEN {side}(p, 1) = '{a}' THEN {k}" for a, k in by.items()) + f" ELSE {other} END"
    count = lambda a: f"(length(p) - length(replace(p, '{a}', '')))"
    plus = [("1", "first_pk"), *((f"n_{a}", str(k)) for a, k in C.PK_POSITIVE.items())]
    minus = [("1", "last_pk"), *((f"n_{a}", str(k)) for a, k in C.PK_NEGATIVE.items())]
    mid = "((st[1] + st[2]) / 2)"
    charge = " + ".join(f"{n} / (1 + pow(10.0::DOUBLE, {mid} - {k}))" for n, k in plus) + " - (" + " + ".join(f"{n} / (1 + pow(10.0::DOUBLE, {k} - {mid}))" for n, k in minus) + ")"
    counts = ", ".join(f"{count(a)} AS n_{a}" for a in (*C.PK_POSITIVE, *C.PK_NEGATIVE))
    scaled = [f"(-1 + 2 * ({c} - {lo}) / ({hi} - {lo}))" for c, (lo, hi) in zip(("pep_len", "fickett", "pi", "integrity"), C.RANGES)]
    v, w, gamma, rho, pa_, pb = MODEL
    decision = " + ".join(f"{wi} * exp(-{gamma} * ({' + '.join(f'pow({x} - ({y}), 2)' for x, y in zip(scaled, row))}))" for row, wi in zip(v.tolist(), w.tolist()))
    return f"""
SELECT *, CASE WHEN coding_probability > 0.5 THEN 'coding' ELSE 'noncoding' END AS coding_label FROM (SELECT *, 1 / (1 + exp({pa_} * ({decision} - {rho}) + {pb})) AS coding_probability FROM (
SELECT id, seq, length(seq) AS length, orf_start, orf_length, pep_len, coalesce(fickett, 0.0) AS fickett, integrity, CASE WHEN length(p) > 0 THEN (h[1] + h[2]) / 2 ELSE 0.0 END AS pi FROM (
  SELECT *, list_reduce([[0.0::DOUBLE, 14.0::DOUBLE]] || list_transform(range(60), lambda i: [0.0::DOUBLE, 0.0::DOUBLE]), lambda st, i: CASE WHEN {charge} > 0 THEN [{mid}, st[2]] ELSE [st[1], {mid}] END) AS h FROM (
  SELECT *, {end(C.PK_N_END_BY, C.PK_N_END, 'left')} AS first_pk, {end(C.PK_C_END_BY, C.PK_C_END, 'right')} AS last_pk, {counts} FROM (
  SELECT *, length(pep) AS pep_len, trim(regexp_replace(pep, '[XBZJU]', '', 'g'), '*') || '' AS p FROM (
  SELECT v.id, v.seq || '' AS seq, f.fickett, coalesce(o.s + 1, 0) AS orf_start, coalesce(o.e - o.s, 0) AS orf_length, coalesce(o.ok, -1) AS integrity,
    coalesce(array_to_string(list_transform(regexp_extract_all(substr(v.seq, CAST(o.s + 1 AS BIGINT), CAST(o.e - o.s AS BIGINT)), '(...)', 1), lambda x: {letter}), ''), '') || '' AS pep
  FROM {text} v LEFT JOIN {frames} o ON o.id = v.id LEFT JOIN {scores} f ON f.id = v.id WHERE v.seq IS NOT NULL))))))"""


# a small kernel machine of the given kind: scaled vectors, their weights, gamma, rho and the two values of its sigmoid
MODEL = (np.array([[-0.97, -0.17, 0.5, 1.0], [-0.99, -0.4, 0.2, -1.0], [-0.9, 0.3, 0.1, 1.0]]), np.array([1.5, -2.0, 1.0]), 0.125, 0.1, -1.9, -0.5)
view("fick_v", _fickett_sql("seq_v"))
view("tfick_v", _fickett_sql("ttx_v"))
view("cpc_v", _coding_sql("seq_v", "orf_v", "fick_v"))
view("tcpc_v", _coding_sql("ttx_v", "torf_v", "tfick_v"))


@query("fickett_scores", "SELECT f.id, round(fickett, 6) AS fickett FROM fick_v f JOIN seq_v v ON v.id = f.id WHERE length(seq) >= 2")
def fickett_scores(spark, sf):
    return P.dealt_sequences(spark, sf).filter(F.length("seq") >= 2).select("id", F.round(Q.fickett(F.col("seq")), 6).alias("fickett"))


@query("coding_features", "SELECT id, length, orf_start, pep_len, round(fickett, 6) AS fickett, round(pi, 4) AS pi, integrity FROM cpc_v")
def coding_features(spark, sf):
    f = C.coding_features(P.dealt_sequences(spark, sf))
    return f.select("id", "length", "orf_start", "pep_len", F.round("fickett", 6).alias("fickett"), F.round("pi", 4).alias("pi"), "integrity")


@query("peptide_lengths", "SELECT v.id, coalesce((e - s) // 3, 0) AS pep_len FROM seq_v v LEFT JOIN orf_v o ON o.id = v.id")
def peptide_lengths(spark, sf):
    return C.coding_features(P.dealt_sequences(spark, sf)).select("id", F.col("pep_len").cast("long").alias("pep_len"))


@query("coding_probabilities", "SELECT id, round(coding_probability, 6) AS coding_probability, coding_label FROM cpc_v")
def coding_probabilities(spark, sf):
    out = C.coding_probability(C.coding_features(P.dealt_sequences(spark, sf)), *MODEL)
    return out.select("id", F.round("coding_probability", 6).alias("coding_probability"), "coding_label")


@query("splice_motifs", "SELECT chrom, strand, iso, a, b, motif FROM mot_v")
def splice_motifs(spark, sf):
    return motifs(spark, sf).select("chrom", "strand", "iso", "a", "b", "motif")


def motifs(spark, sf):
    return SQ.splice_motifs(P.genome(spark, sf), P.seq_introns(spark, sf))


@query("splice_motif_counts", "SELECT motif, count(*) AS n FROM mot_v GROUP BY motif")
def splice_motif_counts(spark, sf):
    return R.motif_counts(motifs(spark, sf))


SHARES = """WITH c AS (SELECT {k} motif, count(*) AS n FROM mot_v GROUP BY ALL), r AS (SELECT *, row_number() OVER ({p} ORDER BY n DESC, motif DESC) AS k FROM c)
SELECT {k} CASE WHEN k <= 3 THEN motif ELSE 'Other' END AS motif, CAST(sum(n) AS BIGINT) AS n, round(sum(n)::DOUBLE / any_value(t), 6) AS share
FROM (SELECT *, sum(n) OVER ({p}) AS t FROM r) GROUP BY {k} CASE WHEN k <= 3 THEN motif ELSE 'Other' END"""


@query("splice_motif_shares", SHARES.format(k="", p=""))
def splice_motif_shares(spark, sf):
    one = R.motif_counts(motifs(spark, sf)).withColumn("all", F.lit(1))
    return R.motif_shares(one, ["all"]).select("motif", "n", F.round("share", 6).alias("share"))


@query("splice_motif_shares_by_strand", SHARES.format(k="strand,", p="PARTITION BY strand"))
def splice_motif_shares_by_strand(spark, sf):
    return R.motif_shares(R.motif_counts(motifs(spark, sf), ["strand"]), ["strand"]).select("strand", "motif", "n", F.round("share", 6).alias("share"))


@query("canonical_sites", """
SELECT chrom, iso, a, b, l2 IN ('GT', 'GC', 'AT') AS fwd_donor, r2 IN ('AG', 'AC') AS fwd_acceptor, r2 IN ('AC', 'GC', 'AT') AS rev_donor, l2 IN ('CT', 'GT') AS rev_acceptor FROM mot_v""")
def canonical_sites(spark, sf):
    l, r = F.col("left_two"), F.col("right_two")
    return motifs(spark, sf).select("chrom", "iso", "a", "b", Q.canonical_site("+", "donor", l).alias("fwd_donor"), Q.canonical_site("+", "acceptor", r).alias("fwd_acceptor"),
                                    Q.canonical_site("-", "donor", r).alias("rev_donor"), Q.canonical_site("-", "acceptor", l).alias("rev_acceptor"))


@query("canonical_junction_ratio", "SELECT iso, round(avg(CASE WHEN motif IN ('GT-AG', 'GC-AG', 'AT-AC') THEN 1.0 ELSE 0 END), 6) AS ratio FROM mot_v GROUP BY iso")
def canonical_junction_ratio(spark, sf):
    return A.canonical_ratio(motifs(spark, sf)).select("iso", F.round("canonical_ratio", 6).alias("ratio"))


view("vote_v", """
SELECT iso, sum(coalesce(l2 IN ('GT', 'GC', 'AT'), false)::INT + coalesce(r2 IN ('AG', 'AC'), false)::INT - coalesce(l2 IN ('CT', 'GT'), false)::INT - coalesce(r2 IN ('AC', 'GC', 'AT'), false)::INT)::BIGINT AS score
FROM mot_v GROUP BY iso""")


@query("strand_votes", "SELECT iso, score FROM vote_v")
def strand_votes(spark, sf):
    return A.site_scores(motifs(spark, sf))


# models that a read overlaps on its chromosome: those that a mono-exon read covers to half on either side, any for the others
view("agr_v", """
SELECT iso, bool_and(plus) AS lo, bool_or(plus) AS hi FROM (
  SELECT r.iso, m.strand = '+' AS plus FROM iso_v r JOIN iso_v m ON m.status = 'F' AND m.chrom = r.chrom AND m.lo < r.hi AND r.lo < m.hi WHERE r.status <> 'F' AND r.n_ex > 1 UNION ALL
  SELECT r.iso, m.strand = '+' FROM iso_v r JOIN ex_v x ON x.iso = r.iso JOIN ex_v y ON y.status = 'F' AND y.chrom = x.chrom AND y.s < x.e AND x.s < y.e JOIN iso_v m ON m.iso = y.iso
  WHERE r.status <> 'F' AND r.n_ex = 1 GROUP BY r.iso, y.iso, m.strand, r.len, m.len HAVING sum(least(x.e, y.e) - greatest(x.s, y.s)) >= 0.5 * least(r.len, m.len)) GROUP BY iso""")


@query("decided_strands", """
SELECT iso, CASE WHEN plus THEN '+' ELSE '-' END AS strand, CASE WHEN new_plus THEN '+' ELSE '-' END AS new_strand, new_plus = plus AS confirmed FROM (SELECT r.iso, plus,
  coalesce(CASE WHEN n_ex > 1 AND score > 0 THEN true WHEN n_ex > 1 AND score < 0 THEN false END, CASE WHEN a.lo = a.hi THEN a.lo END, plus) AS new_plus
  FROM (SELECT iso, strand = '+' AS plus, n_ex FROM iso_v WHERE status <> 'F') r LEFT JOIN vote_v USING (iso) LEFT JOIN agr_v a USING (iso))""")
def decided_strands(spark, sf):
    reads = P.isoforms(spark, sf).filter("status <> 'F'")
    m = P.t_models(spark, sf).withColumnRenamed("strand", "t_strand")
    out = A.strand_vote(reads, motifs(spark, sf).select("iso", "left_two", "right_two"), m)
    return out.select("iso", "strand", "new_strand", "confirmed")


# 3' ends of the placed isoforms
view("st_v", """
SELECT id, seq, pos, CASE WHEN plus THEN '+' ELSE '-' END AS strand FROM (
  SELECT chrom AS id, plus, pos, any_value(seq) AS seq FROM (SELECT chrom, gene % 2 = 0 AS plus, CASE WHEN gene % 2 = 0 THEN max(e) - 1 ELSE min(s) END AS pos, any_value(seq) AS seq FROM pla_v GROUP BY iso, chrom, gene)
  GROUP BY ALL) WHERE pos > 40 AND pos + 1 + 40 < length(seq)""")
view("swin_v", """
SELECT id AS chrom, pos, side, strand, CASE WHEN strand = '-' THEN reverse(translate(w, 'ACGT', 'TGCA')) ELSE w END AS w FROM (
  SELECT id, pos, strand, 'up' AS side, CASE WHEN strand = '+' THEN substr(seq, pos - 39, 40) ELSE substr(seq, pos + 2, 40) END AS w FROM st_v UNION ALL
  SELECT id, pos, strand, 'down', CASE WHEN strand = '+' THEN substr(seq, pos + 2, 40) ELSE substr(seq, pos - 40, 40) END FROM st_v)""")


def site_texts(spark, sf, k=1):
    x = F.col("exons")
    pos = F.when(F.col("strand") == "+", F.element_at(x, -1)["e"] - 1).otherwise(x[0]["s"])
    sites = P.placed_isoforms(spark, sf).select("chrom", "strand", pos.alias("start"), (pos + 1).alias("end")).distinct()
    spans = SQ.site_windows(sites, sequence_lengths(spark, sf), 40, 40, k)
    return SQ.windows(P.genome(spark, sf), spans, "w_start", "w_end", "seq_w", "strand")


@query("site_window_texts", "SELECT chrom, pos, side, strand, w FROM swin_v")
def site_window_texts(spark, sf):
    return site_texts(spark, sf).select("chrom", F.col("start").alias("pos"), "side", "strand", F.col("seq_w").alias("w"))


@query("letter_profile", """
WITH c AS (SELECT side, unnest(range(0, 40)) AS o, unnest(string_split(w, '')) AS base FROM swin_v)
SELECT side, CAST(o AS BIGINT) AS "offset", base, count(*) AS n, round(count(*)::DOUBLE / any_value(t), 6) AS share FROM (SELECT *, count(*) OVER (PARTITION BY side, o) AS t FROM c)
WHERE base IN ('A', 'C', 'G', 'T') GROUP BY side, o, base""")
def letter_profile(spark, sf):
    r = PA.letter_profile(site_texts(spark, sf), "seq_w")
    return r.select("side", F.col("offset").cast("long").alias("offset"), "base", "n", F.round("share", 6).alias("share"))


def _listed(texts):
    return ", ".join(f"'{t}'" for t in texts)


@query("signal_profile", f"""
WITH w AS (SELECT side, CASE WHEN strand = '-' THEN reverse(translate(w, 'ACGT', 'TGCA')) ELSE w END AS w FROM (
  SELECT 'up' AS side, strand, CASE WHEN strand = '+' THEN substr(seq, pos - 39, 45) ELSE substr(seq, pos + 2, 45) END AS w FROM st_v WHERE pos + 46 < length(seq) UNION ALL
  SELECT 'down', strand, CASE WHEN strand = '+' THEN substr(seq, pos + 2, 45) ELSE substr(seq, greatest(pos - 45, 0) + 1, pos - greatest(pos - 45, 0)) END FROM st_v WHERE pos + 46 < length(seq))),
k AS (SELECT side, o, substr(w, o + 1, 6) AS s FROM (SELECT side, w, unnest(range(0, length(w) - 5)) AS o FROM w)),
c AS (SELECT side, o, CASE WHEN s IN ({_listed(PA.MAIN_SIGNALS)}) THEN s WHEN s IN ({_listed(PA.SIGNALS)}) THEN 'Other' END AS signal, count(*) AS n FROM k GROUP BY ALL)
SELECT side, CAST(o AS BIGINT) AS "offset", signal, n, round(n::DOUBLE / t, 6) AS share FROM (SELECT *, sum(n) OVER (PARTITION BY side, o) AS t FROM c) WHERE signal IS NOT NULL""")
def signal_profile(spark, sf):
    r = PA.signal_profile(site_texts(spark, sf, 6), "seq_w")
    return r.select("side", F.col("offset").cast("long").alias("offset"), "signal", "n", F.round("share", 6).alias("share"))


@query("spliced_transcripts", "SELECT iso, seq FROM tx_v")
def spliced_transcripts(spark, sf):
    return SQ.spliced(P.genome(spark, sf), P.placed_isoforms(spark, sf))


# alignment indels and junction coverage features

view("ind_v", """
SELECT chrom, iso, s + (e - s) // 2 + 1 AS pos, 'insertion:' || (s + (e - s) // 2 + 1) || ':1' AS indel, s + (e - s) // 2 + 1 AS pos2 FROM ex_v UNION ALL
SELECT chrom, iso, s + (e - s) // 2 + 1, 'deletion:' || (s + (e - s) // 2 + 1) || ':2', s + (e - s) // 2 + 2 FROM ex_v""")
view("near_v", """
SELECT DISTINCT i.chrom, v.a, v.b, i.indel FROM ind_v i JOIN intr_v v USING (iso) WHERE least(abs(i.pos - (v.a + 1)), abs(i.pos - v.b), abs(i.pos2 - (v.a + 1)), abs(i.pos2 - v.b)) < 95""")


def near(spark, sf, iso=None):
    from spliceloom.functions import alignment as AL
    from spliceloom.functions import blocks as B
    start = F.col("pos") - 1
    a = P.alignments(spark, sf, iso).select("chrom", AL.indels(start, F.col("cigar")).alias("indels"), B.introns(AL.cigar_blocks(start, F.col("cigar"))).alias("junctions"))
    return A.indels_near_junctions(a, 95)


@query("indels_near_junctions", "SELECT n.chrom, a, b, indel, t.n FROM near_v n JOIN (SELECT chrom, indel, count(*) AS n FROM ind_v GROUP BY ALL) t USING (chrom, indel)")
def indels_near_junctions(spark, sf):
    return near(spark, sf)


def junction_part(spark, sf):
    from spliceloom.operators.transcripts import intron_rows
    iso = bucketed(P.isoforms(spark, sf), "isoforms", "iso")
    known = intron_rows(iso.filter("status = 'F'")).select("chrom", "a", "b").distinct()
    total = iso.agg(F.count(F.lit(1)).alias("reads_total"))
    return A.junction_features(iso, P.junction_table(spark, sf, iso), known, near(spark, sf, iso), total)


view("cover_v", """
SELECT v.iso, v.chrom, v.a, v.b, cov, cov / (i.len / 1000.0 * (SELECT count(*) FROM iso_v) / 1000000.0) AS rpkm, k.chrom IS NULL AS novel
FROM intr_v v JOIN (SELECT chrom, js AS a, je AS b, sum(cnt) AS cov FROM junc_v GROUP BY ALL) USING (chrom, a, b) JOIN iso_v i ON i.iso = v.iso
LEFT JOIN known_v k ON k.chrom = v.chrom AND k.a = v.a AND k.b = v.b""")
view("jf_v", """
SELECT i.iso, coalesce(m, 0) AS min_to_all, coalesce(sd, 0) AS sd_cov, coalesce(mr, 0) AS min_rpkm, coalesce(wn, 0)::BIGINT AS with_novel,
  coalesce(mn, 0) AS min_novel_rpkm, coalesce(ni, 0) AS n_indels, coalesce(nj, 0) AS n_junc_indels FROM iso_v i
LEFT JOIN (SELECT iso, min(cov)::DOUBLE / sum(cov) AS m, stddev_pop(cov) AS sd, min(rpkm) AS mr, max(novel::INT) AS wn, min(rpkm) FILTER (novel) AS mn FROM cover_v GROUP BY iso) USING (iso)
LEFT JOIN (SELECT iso, count(DISTINCT indel) AS ni, count(DISTINCT (a, b)) AS nj FROM (
  SELECT r.iso, r.a, r.b, n.indel FROM cover_v r JOIN near_v n USING (chrom, a, b) JOIN (SELECT chrom, indel, count(*) AS n FROM ind_v GROUP BY ALL) t USING (chrom, indel) WHERE t.n::DOUBLE / cov >= 0.5)
  GROUP BY iso) USING (iso) WHERE n_ex > 1""")


@query("junction_features", """
SELECT iso, round(min_to_all, 6) AS min_to_all, round(sd_cov, 6) AS sd_cov, round(min_rpkm, 4) AS min_rpkm, with_novel, round(min_novel_rpkm, 4) AS min_novel_rpkm, n_indels, n_junc_indels FROM jf_v""")
def junction_features(spark, sf):
    return junction_part(spark, sf).select("iso", F.round("min_to_all", 6).alias("min_to_all"), F.round("sd_cov", 6).alias("sd_cov"), F.round("min_rpkm", 4).alias("min_rpkm"),
                                           F.col("with_novel").cast("long").alias("with_novel"), F.round("min_novel_rpkm", 4).alias("min_novel_rpkm"), "n_indels", "n_junc_indels")


view("bite_v", """
SELECT DISTINCT iso FROM intr_v v WHERE status <> 'F' AND (chrom, a, b) NOT IN (SELECT * FROM known_v)
  AND EXISTS (SELECT 1 FROM ex_v x WHERE x.status = 'F' AND x.chrom = v.chrom AND x.strand = v.strand AND x.s < v.b AND v.a < x.e)""")


@query("biting_isoforms", "SELECT iso FROM bite_v")
def biting_isoforms(spark, sf):
    from spliceloom.operators.transcripts import distinct_exons, intron_rows
    iso = P.isoforms(spark, sf)
    ann = iso.filter("status = 'F'")
    return A.biting_isoforms(iso.filter("status <> 'F'"), intron_rows(ann).select("chrom", "a", "b"), distinct_exons(ann))
