"""Splicing events."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spliceloom.functions import blocks as B
from spliceloom.operators import events as E
from spliceloom.operators import report as R
from spliceloom.plans import proxy as P
from spliceloom.plans.registry import VIEWS, query, view
from spliceloom.session import written
from spliceloom.sources.sinks import event_lines

COUNTS = ["n_inc", "n_exc", "w_inc", "w_exc"]


def tidy(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols, *[F.col(c).cast("long").alias(c) for c in COUNTS], F.round("psi", 6).alias("psi"),
                     F.round("psi_reads", 6).alias("psi_reads"))


PSI_SQL = """CAST(n_inc AS BIGINT) AS n_inc, CAST(n_exc AS BIGINT) AS n_exc, CAST(w_inc AS BIGINT) AS w_inc, CAST(w_exc AS BIGINT) AS w_exc,
  round(n_inc::DOUBLE / (n_inc + n_exc) * 1000, 6) AS psi, round(w_inc::DOUBLE / (w_inc + w_exc) * 1000, 6) AS psi_reads"""

view("ret_v", """
SELECT DISTINCT i.gene, i.chrom, i.strand, i.a AS lo, i.b AS hi, x.iso, x.reads
FROM (SELECT DISTINCT gene, chrom, strand, a, b FROM intr_v) i JOIN exr_v x ON x.gene = i.gene AND x.s < i.a - 5 AND x.e > i.b + 5""")
view("irm_v", """
SELECT gene, chrom, strand, lo, hi, 'inc' AS side, iso, reads FROM ret_v UNION ALL
SELECT gene, chrom, strand, e, next_s, 'exc', iso, reads FROM exr_v WHERE (gene, e, next_s) IN (SELECT gene, lo, hi FROM ret_v)""")
view("ir_v", """
SELECT 'IR' AS as_type, gene, chrom, strand, lo, hi, gene || ':' || lo || '-' || hi AS event_id,
  count(*) FILTER (side = 'inc') AS n_inc, count(*) FILTER (side = 'exc') AS n_exc,
  sum(reads) FILTER (side = 'inc') AS w_inc, sum(reads) FILTER (side = 'exc') AS w_exc
FROM irm_v GROUP BY gene, chrom, strand, lo, hi""")
view("sem_v", """
SELECT d.gene, d.chrom, d.strand, d.l, d.r, d.inner_chain, side, iso, reads FROM (
  SELECT x.gene, x.chrom, x.strand, x.e AS l, y.s AS r, x.iso, x.reads, 'inc' AS side,
    (SELECT string_agg(z.s || '-' || z.e, ';' ORDER BY z.s) FROM ex_v z WHERE z.iso = x.iso AND z.s > x.e AND z.e < y.s) AS inner_chain
  FROM exr_v x JOIN ex_v y ON y.iso = x.iso AND y.k >= x.k + 2
  WHERE (x.gene, x.e, y.s) IN (SELECT gene, e, next_s FROM ex_v WHERE next_s IS NOT NULL)) d
UNION ALL
SELECT s.gene, s.chrom, s.strand, s.l, s.r, s.inner_chain, 'exc', x.iso, x.reads FROM (
  SELECT DISTINCT x.gene, x.chrom, x.strand, x.e AS l, y.s AS r,
    (SELECT string_agg(z.s || '-' || z.e, ';' ORDER BY z.s) FROM ex_v z WHERE z.iso = x.iso AND z.s > x.e AND z.e < y.s) AS inner_chain
  FROM ex_v x JOIN ex_v y ON y.iso = x.iso AND y.k >= x.k + 2) s
JOIN exr_v x ON x.gene = s.gene AND x.e = s.l AND x.next_s = s.r""")
view("se_v", """
SELECT 'SE' AS as_type, gene, chrom, strand, l, r, inner_chain AS chain, CAST(split_part(inner_chain, '-', 1) AS BIGINT) AS lo,
  CAST(split_part(inner_chain, '-', -1) AS BIGINT) AS hi, gene || ':' || l || '@' || inner_chain || '@' || r AS event_id,
  count(*) FILTER (side = 'inc') AS n_inc, count(*) FILTER (side = 'exc') AS n_exc,
  sum(reads) FILTER (side = 'inc') AS w_inc, sum(reads) FILTER (side = 'exc') AS w_exc
FROM sem_v GROUP BY gene, chrom, strand, l, r, inner_chain""")
# left edges compare exon starts with the exon before, right edges exon ends with the exon after
view("edge_v", """
SELECT i.gene, i.chrom, i.strand, 'left' AS edge, i.s AS lo, x.s AS hi, i.iso AS inc_iso, x.iso AS exc_iso, i.reads AS inc_r, x.reads AS exc_r,
  i.prev_e AS ia, i.s AS ib, x.prev_e AS xa, x.s AS xb
FROM exr_v i JOIN exr_v x ON i.gene = x.gene AND i.iso <> x.iso AND i.prev_e IS NOT NULL AND x.prev_e IS NOT NULL
  AND i.s < x.s AND i.s < x.e AND i.e > x.s AND i.s > x.prev_e AND abs(i.s - x.s) > 5 AND abs(i.s - x.prev_e) > 5
UNION ALL
SELECT i.gene, i.chrom, i.strand, 'right', x.e, i.e, i.iso, x.iso, i.reads, x.reads, i.e, i.next_s, x.e, x.next_s
FROM exr_v i JOIN exr_v x ON i.gene = x.gene AND i.iso <> x.iso AND i.next_s IS NOT NULL AND x.next_s IS NOT NULL
  AND x.e < i.e AND i.s < x.e AND i.e > x.s AND i.e < x.next_s AND abs(i.e - x.e) > 5 AND abs(i.e - x.next_s) > 5""")
view("altm_v", """
SELECT DISTINCT CASE WHEN (edge = 'left') = (strand = '+') THEN 'A3SS' ELSE 'A5SS' END AS as_type, gene, chrom, strand, lo, hi, side, iso, reads, a, b
FROM (SELECT *, 'inc' AS side, inc_iso AS iso, inc_r AS reads, ia AS a, ib AS b FROM edge_v
  UNION ALL SELECT *, 'exc', exc_iso, exc_r, xa, xb FROM edge_v)""")
view("alt_v", """
SELECT as_type, gene, chrom, strand, lo, hi, gene || ':' || lo || '-' || hi AS event_id,
  count(*) FILTER (side = 'inc') AS n_inc, count(*) FILTER (side = 'exc') AS n_exc,
  sum(reads) FILTER (side = 'inc') AS w_inc, sum(reads) FILTER (side = 'exc') AS w_exc,
  min({'a': a, 'b': b}) FILTER (side = 'inc') AS ij, min({'a': a, 'b': b}) FILTER (side = 'exc') AS xj
FROM altm_v GROUP BY ALL""")
view("event_v", """
SELECT as_type, gene, chrom, strand, event_id, lo, hi, n_inc, n_exc, w_inc, w_exc FROM ir_v UNION ALL
SELECT as_type, gene, chrom, strand, event_id, lo, hi, n_inc, n_exc, w_inc, w_exc FROM se_v UNION ALL
SELECT as_type, gene, chrom, strand, event_id, lo, hi, n_inc, n_exc, w_inc, w_exc FROM alt_v""")
view("member_v", """
SELECT 'IR' AS as_type, gene || ':' || lo || '-' || hi AS event_id, gene, side, iso, reads FROM irm_v UNION ALL
SELECT 'SE', gene || ':' || l || '@' || inner_chain || '@' || r, gene, side, iso, reads FROM sem_v
WHERE (gene, l, r) IN (SELECT gene, e, next_s FROM ex_v) UNION ALL
SELECT as_type, gene || ':' || lo || '-' || hi, gene, side, iso, reads FROM (SELECT DISTINCT as_type, gene, lo, hi, side, iso, reads FROM altm_v)""")


CHAIN = ["ret_v", "irm_v", "ir_v", "sem_v", "se_v", "edge_v", "altm_v", "alt_v", "event_v"]


def event_views(prefix: str, rows: str) -> None:
    """The event views over other exon rows (a statement with the columns of exr_v), under names with a prefix."""
    names = re.compile(r"\b(" + "|".join([*CHAIN, "exr_v", "ex_v", "intr_v"]) + r")\b")
    view(f"{prefix}exr_v", rows)
    view(f"{prefix}ex_v", f"SELECT * FROM {prefix}exr_v")
    view(f"{prefix}intr_v", f"SELECT gene, iso, chrom, strand, status, e AS a, next_s AS b, k FROM {prefix}exr_v WHERE next_s IS NOT NULL")
    for v in CHAIN:
        view(prefix + v, names.sub(prefix + r"\1", VIEWS[v]))


event_views("sup_", "SELECT * FROM exr_v WHERE reads >= 2")


@query("ir_events", f"SELECT gene, chrom, strand, lo, hi, event_id, {PSI_SQL} FROM ir_v")
def ir_events(spark, sf):
    return tidy(E.retained_introns(P.isoforms(spark, sf)), "gene", "chrom", "strand", "lo", "hi", "event_id")


@query("se_events", f"SELECT gene, chrom, strand, lo, hi, event_id, {PSI_SQL} FROM se_v")
def se_events(spark, sf):
    return tidy(E.skipped_exons(P.isoforms(spark, sf)), "gene", "chrom", "strand", "lo", "hi", "event_id")


def _alternative(as_type):
    def run(spark, sf):
        ev = E.alternative_sites(P.isoforms(spark, sf), as_type)
        pair = lambda c: F.concat_ws("-", F.col(f"{c}.a"), F.col(f"{c}.b")).alias(c)
        ev = ev.withColumn("inc_junc", pair("inc_junc")).withColumn("exc_junc", pair("exc_junc"))
        return tidy(ev, "gene", "chrom", "strand", "lo", "hi", "event_id", "inc_junc", "exc_junc")
    return run


for _t in ("A3SS", "A5SS"):
    query(f"{_t.lower()}_events", f"""SELECT gene, chrom, strand, lo, hi, event_id, ij.a || '-' || ij.b AS inc_junc, xj.a || '-' || xj.b AS exc_junc,
      {PSI_SQL} FROM alt_v WHERE as_type = '{_t}'""")(_alternative(_t))


@query("all_events", f"SELECT as_type, gene, chrom, strand, event_id, lo, hi, {PSI_SQL} FROM event_v")
def all_events(spark, sf):
    return tidy(E.all_events(P.isoforms(spark, sf)), "as_type", "gene", "chrom", "strand", "event_id", "lo", "hi")


@query("event_members", "SELECT as_type, event_id, gene, side, iso FROM member_v")
def event_members(spark, sf):
    return E.all_members(P.isoforms(spark, sf)).select("as_type", "event_id", "gene", "side", "iso")


@query("annotated_ir_events", """
SELECT gene, lo, hi, event_id FROM ir_v v WHERE EXISTS (SELECT 1 FROM mod_v m WHERE m.gene = v.gene AND v.lo < m.hi AND v.hi > m.lo)""")
def annotated_ir_events(spark, sf):
    m = P.models(spark, sf).select("gene", F.col("start").alias("tx_start"), F.col("end").alias("tx_end"))
    return E.retained_introns(P.isoforms(spark, sf), models=m).select("gene", "lo", "hi", "event_id")


@query("event_text_lines", """
SELECT event_id, CAST(n_inc AS BIGINT) AS n_inc, CAST(n_exc AS BIGINT) AS n_exc, 0::BIGINT AS part,
  string_agg(m.iso::VARCHAR, ',' ORDER BY m.iso::VARCHAR) FILTER (m.side = 'inc') AS inc_isos,
  string_agg(m.iso::VARCHAR, ',' ORDER BY m.iso::VARCHAR) FILTER (m.side = 'exc') AS exc_isos
FROM ir_v v JOIN irm_v m USING (gene, lo, hi) GROUP BY event_id, n_inc, n_exc""")
def event_text_lines(spark, sf):
    iso = P.isoforms(spark, sf)
    lines = event_lines(E.retained_introns(iso), E.event_members(iso, "IR"), ["event_id"])
    return lines.select("event_id", "n_inc", "n_exc", "part", "inc_isos", "exc_isos")


@query("supported_isoform_events", "SELECT as_type, gene, event_id, lo, hi, n_inc FROM sup_event_v")
def supported_isoform_events(spark, sf):
    return E.all_events(E.supported(P.isoforms(spark, sf))).select("as_type", "gene", "event_id", "lo", "hi", "n_inc")


@query("confirmed_ir", "SELECT gene, lo, hi, event_id FROM ir_v v WHERE EXISTS (SELECT 1 FROM junc_v j WHERE j.chrom = v.chrom AND j.js = v.lo AND j.je = v.hi)")
def confirmed_ir(spark, sf):
    return E.confirmed_introns(E.retained_introns(P.isoforms(spark, sf)), P.junction_table(spark, sf)).select("gene", "lo", "hi", "event_id")


CONFIRM = """
SELECT v.gene, v.lo, v.hi, v.event_id, CAST(CASE WHEN v.edge = 'left' THEN l.n ELSE h.n END AS BIGINT) AS inc_count,
  CAST(CASE WHEN v.edge = 'left' THEN h.n ELSE l.n END AS BIGINT) AS exc_count,
  CAST(floor((CASE WHEN v.edge = 'left' THEN l.n ELSE h.n END)::DOUBLE / (l.n + h.n) * 1000) AS BIGINT) AS junction_psi
FROM (SELECT *, CASE WHEN (as_type = 'A3SS') = (strand = '+') THEN 'left' ELSE 'right' END AS edge FROM alt_v WHERE as_type = '{t}') v
JOIN (SELECT chrom, strand, 'left' AS edge, je AS site, sum(cnt) AS n FROM junc_v GROUP BY ALL
  UNION ALL SELECT chrom, strand, 'right', js, sum(cnt) FROM junc_v GROUP BY ALL) l
  ON l.chrom = v.chrom AND l.strand = v.strand AND l.edge = v.edge AND l.site = v.lo
JOIN (SELECT chrom, strand, 'left' AS edge, je AS site, sum(cnt) AS n FROM junc_v GROUP BY ALL
  UNION ALL SELECT chrom, strand, 'right', js, sum(cnt) FROM junc_v GROUP BY ALL) h
  ON h.chrom = v.chrom AND h.strand = v.strand AND h.edge = v.edge AND h.site = v.hi"""


def _confirmed(as_type):
    def run(spark, sf):
        ev = E.alternative_sites(P.isoforms(spark, sf), as_type)
        return E.confirmed_sites(ev, P.junction_table(spark, sf), as_type).select(
            "gene", "lo", "hi", "event_id", "inc_count", "exc_count", "junction_psi")
    return run


for _t in ("A3SS", "A5SS"):
    query(f"confirmed_{_t.lower()}", CONFIRM.format(t=_t))(_confirmed(_t))


# events of all types that short reads confirm, each by the rule of its type
view("jsite_v", """
SELECT chrom, strand, 'left' AS edge, je AS site FROM junc_v UNION SELECT chrom, strand, 'right', js FROM junc_v""")
view("skip_name_v", """
SELECT s."left" AS l, s."right" AS r, s.chain, CASE WHEN s.gene <> 'Novel' THEN s.gene WHEN n.k = 1 THEN n.g ELSE 'Novel' END AS gene FROM skip_v s
LEFT JOIN (SELECT s.chrom, s.strand, s."left", s."right", count(DISTINCT x.gene) AS k, min(x.gene)::VARCHAR AS g FROM (SELECT DISTINCT chrom, strand, "left", "right" FROM skip_v WHERE gene = 'Novel') s
  JOIN mex_v x ON x.chrom = s.chrom AND x.strand = s.strand AND (x.e = s."left" OR x.s = s."right") GROUP BY ALL) n
  ON n.chrom = s.chrom AND n.strand = s.strand AND n."left" = s."left" AND n."right" = s."right" """)
view("sure_v", """
SELECT 'IR' AS as_type, event_id FROM ir_v WHERE (chrom, lo, hi) IN (SELECT chrom, js, je FROM junc_v) UNION
SELECT 'SE', event_id FROM se_v WHERE event_id IN (SELECT gene || ':' || l || '@' || chain || '@' || r FROM skip_name_v) UNION
SELECT as_type, event_id FROM (SELECT *, CASE WHEN (as_type = 'A3SS') = (strand = '+') THEN 'left' ELSE 'right' END AS edge FROM alt_v) v
WHERE (chrom, strand, edge, lo) IN (SELECT * FROM jsite_v) AND (chrom, strand, edge, hi) IN (SELECT * FROM jsite_v)""")


def _shared(spark, sf):
    return E.Shared(P.isoforms(spark, sf))


def _confirmed_all(spark, sf, events, iso):
    """Events that short reads confirm; ``iso`` are the isoforms of `_shared`, so that nothing here reads the line items again."""
    from spliceloom.plans.join_queries import short_read_skips
    models = P.models(spark, sf, iso).select("gene", "chrom", "strand", "exons")
    j = written(P.junction_table(spark, sf, iso), "junctions")
    return E.confirmed_events(events, j, E.name_novel_skips(written(short_read_skips(spark, sf, iso, j), "short_skips"), models))


@query("confident_events", "SELECT as_type, event_id, (as_type, event_id) IN (SELECT as_type, event_id FROM sure_v) AS confident FROM event_v")
def confident_events(spark, sf):
    base = _shared(spark, sf)
    ev = written(E.all_events(base).select("as_type", "event_id", "chrom", "strand", "lo", "hi"), "events")
    return E.with_confidence(ev, _confirmed_all(spark, sf, ev, base.isoforms)).select("as_type", "event_id", "confident")


@query("isoforms_in_confident_events", """
SELECT DISTINCT iso FROM member_v WHERE (as_type, event_id) IN (SELECT as_type, event_id FROM sure_v)""")
def isoforms_in_confident_events(spark, sf):
    base = _shared(spark, sf)
    return E.event_isoforms(E.all_members(base), _confirmed_all(spark, sf, E.all_events(base), base.isoforms))


@query("se_splice_sites", """
WITH parts AS (SELECT event_id, chrom, strand, unnest(generate_series(1, len(e) - 1, 2)) AS i, e FROM (
  SELECT event_id, chrom, strand, string_split(l || '-' || replace(chain, ';', '-') || '-' || r, '-') AS e FROM se_v))
SELECT event_id, chrom, strand, 'inc' AS side, CAST(e[i] AS BIGINT) AS "left", CAST(e[i + 1] AS BIGINT) AS "right" FROM parts
UNION ALL SELECT event_id, chrom, strand, 'exc', l, r FROM se_v""")
def se_splice_sites(spark, sf):
    return E.splice_site_rows(E.skipped_exons(P.isoforms(spark, sf)), "SE")


@query("ir_splice_sites", "SELECT event_id, chrom, strand, 'inc' AS side, lo AS \"left\", hi AS \"right\" FROM ir_v")
def ir_splice_sites(spark, sf):
    return E.splice_site_rows(E.retained_introns(P.isoforms(spark, sf)), "IR")


for _t, _plus in (("A3SS", "+"), ("A5SS", "-")):
    query(f"{_t.lower()}_splice_sites", f"""
    SELECT event_id, chrom, strand, 'inc' AS side, CASE WHEN strand <> '{_plus}' THEN hi END AS "left", CASE WHEN strand = '{_plus}' THEN lo END AS "right"
    FROM alt_v WHERE as_type = '{_t}' UNION ALL
    SELECT event_id, chrom, strand, 'exc', CASE WHEN strand <> '{_plus}' THEN lo END, CASE WHEN strand = '{_plus}' THEN hi END
    FROM alt_v WHERE as_type = '{_t}'""")(
        lambda spark, sf, t=_t: E.splice_site_rows(E.alternative_sites(P.isoforms(spark, sf), t), t))

# events found in the annotation alone: the same views over the annotated isoforms
view("fex_v", "SELECT * FROM ex_v WHERE status = 'F'")
view("fexr_v", "SELECT * FROM exr_v WHERE status = 'F'")
view("fintr_v", "SELECT * FROM intr_v WHERE status = 'F'")
for _v in ("ret_v", "irm_v", "ir_v", "sem_v", "se_v", "edge_v", "altm_v", "alt_v", "event_v"):
    view(f"f{_v}", re.sub(r"\b(?:ex|exr|intr|ret|irm|ir|sem|se|edge|altm|alt)_v\b", lambda m: "f" + m[0], VIEWS[_v]))
view("ann_v", "SELECT as_type, event_id FROM fevent_v")
ANNOTATION = "CASE WHEN (as_type, event_id) IN (SELECT as_type, event_id FROM ann_v) THEN 'Known' ELSE 'Novel' END AS annotation"


def _annotated(base):
    """Events of the annotated isoforms alone."""
    return E.all_events(base.isoforms.filter(F.col("status") == "F")).select("as_type", "event_id")


@query("known_and_novel_events", f"SELECT as_type, event_id, chrom, strand, gene, {ANNOTATION} FROM event_v")
def known_and_novel_events(spark, sf):
    base = _shared(spark, sf)
    return E.known_or_novel(E.all_events(base), _annotated(base)).select("as_type", "event_id", "chrom", "strand", "gene", "annotation")


@query("event_type_counts", f"SELECT as_type, annotation, count(*) AS n FROM (SELECT as_type, {ANNOTATION} FROM event_v) GROUP BY ALL")
def event_type_counts(spark, sf):
    base = _shared(spark, sf)
    return R.event_counts(E.known_or_novel(E.all_events(base), _annotated(base)))


@query("event_keys", "SELECT DISTINCT chrom || ':' || event_id || ':' || strand AS event FROM event_v WHERE event_id NOT LIKE '%Novel%'")
def event_keys(spark, sf):
    return R.event_list(E.all_events(P.isoforms(spark, sf)))


def _ids(base):
    return E.all_events(base).select("as_type", "event_id")


@query("events_common_to_annotation", "SELECT as_type, event_id FROM event_v INTERSECT SELECT as_type, event_id FROM ann_v")
def events_common_to_annotation(spark, sf):
    base = _shared(spark, sf)
    return _ids(base).intersect(_annotated(base))


@query("events_outside_annotation", "SELECT as_type, event_id FROM event_v EXCEPT SELECT as_type, event_id FROM ann_v")
def events_outside_annotation(spark, sf):
    base = _shared(spark, sf)
    return _ids(base).subtract(_annotated(base))


@query("events_known_or_confirmed", "SELECT as_type, event_id FROM ann_v UNION SELECT as_type, event_id FROM sure_v")
def events_known_or_confirmed(spark, sf):
    base = _shared(spark, sf)
    return _annotated(base).union(_confirmed_all(spark, sf, E.all_events(base), base.isoforms)).distinct()


@query("event_set_overlap", """
SELECT a.event_id IS NOT NULL AS in_a, b.event_id IS NOT NULL AS in_b, count(*) AS n FROM event_v a FULL JOIN ann_v b ON a.as_type = b.as_type AND a.event_id = b.event_id GROUP BY ALL""")
def event_set_overlap(spark, sf):
    base = _shared(spark, sf)
    return R.set_overlap(_ids(base), _annotated(base), ["as_type", "event_id"])


@query("event_highlights", """
SELECT v.as_type, v.gene, region_start, region_end, n_iso, min(v.lo) AS first_mark, max(v.hi) AS last_mark, count(*) AS n_events
FROM event_v v JOIN (SELECT m.as_type, m.gene, min(i.lo) AS region_start, max(i.hi) AS region_end, count(*) AS n_iso
  FROM (SELECT DISTINCT as_type, gene, iso FROM member_v) m JOIN iso_v i USING (iso) GROUP BY ALL) r ON r.as_type = v.as_type AND r.gene = v.gene
GROUP BY ALL""")
def event_highlights(spark, sf):
    base = _shared(spark, sf)
    return R.highlight_spans(E.all_events(base), E.all_members(base), base.isoforms)


@query("short_read_alternative_sites", """
SELECT as_type, gene, lo, hi, CAST(sum(cnt) FILTER (side = 'inc') AS BIGINT) AS inc, CAST(sum(cnt) FILTER (side = 'exc') AS BIGINT) AS exc,
  CAST(floor(sum(cnt) FILTER (side = 'inc')::DOUBLE / sum(cnt) * 1000) AS BIGINT) AS psi FROM (
  SELECT DISTINCT CASE WHEN (edge = 'left') = (strand = '+') THEN 'A3SS' ELSE 'A5SS' END AS as_type, gene, lo, hi, side, s, e, cnt, other FROM (
    SELECT i.gene, i.strand, 'left' AS edge, i.js AS lo_x, i.je AS lo, x.je AS hi, unnest([{'side': 'inc', 's': i.js, 'e': i.je, 'cnt': i.cnt, 'other': i.js_start},
      {'side': 'exc', 's': x.js, 'e': x.je, 'cnt': x.cnt, 'other': x.js_start}], recursive := true)
    FROM gj_v i JOIN gj_v x ON x.gene = i.gene AND i.je < x.je AND i.je_end + 10 > x.je AND i.je > x.js
    UNION ALL
    SELECT i.gene, i.strand, 'right', 0, x.js, i.js, unnest([{'side': 'inc', 's': i.js, 'e': i.je, 'cnt': i.cnt, 'other': i.js_start},
      {'side': 'exc', 's': x.js, 'e': x.je, 'cnt': x.cnt, 'other': x.js_start}], recursive := true)
    FROM gj_v i JOIN gj_v x ON x.gene = i.gene AND x.js < i.js AND i.js_start - 10 < x.js AND i.js < x.je)) GROUP BY ALL""")
def short_read_alternative_sites(spark, sf):
    j = gene_junctions(spark, sf)
    iso = j.select("gene", "chrom", "strand", F.array(B.block(F.col("start"), F.col("js")), B.block(F.col("je"), F.col("end"))).alias("exons"),
                   F.col("cnt").alias("reads"), F.monotonically_increasing_id().alias("iso"))
    out = None
    for t in ("A3SS", "A5SS"):
        ev = E.alternative_sites(iso, t, offset=0, extension=10).select(
            F.lit(t).alias("as_type"), "gene", "lo", "hi", F.col("w_inc").alias("inc"), F.col("w_exc").alias("exc"),
            F.floor("psi_reads").cast("long").alias("psi"))
        out = ev if out is None else out.unionByName(ev)
    return out


view("gj_v", """
SELECT gene, chrom, strand, e AS js, next_s AS je, CAST(sum(reads) AS BIGINT) AS cnt, min(s) AS js_start, next_s + 100 AS je_end
FROM exr_v WHERE next_s IS NOT NULL AND status = 'O' GROUP BY ALL""")


def gene_junctions(spark, sf):
    from spliceloom.operators.transcripts import exon_rows
    rows = exon_rows(P.isoforms(spark, sf).filter(F.col("status") == "O"), ["reads"]).filter(F.col("next_s").isNotNull())
    return rows.groupBy("gene", "chrom", "strand", F.col("e").alias("js"), F.col("next_s").alias("je")).agg(
        F.sum("reads").alias("cnt"), F.min("s").alias("start")).withColumn("end", F.col("je") + 100)
