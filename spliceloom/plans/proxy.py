"""Transcript-shaped views over the driver tables, on Spark and in SQL.

An order is an isoform, its line items are exon slots, two customers share a
gene. Overlapping or touching slots of an isoform merge into one exon. Order
status tells the role: F orders are the annotation, O orders the short-read
set. Documents read as sequences by mapping every letter to a base.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spliceloom.functions import blocks as B
from spliceloom.plans.registry import view

SLOT = 1000
GENE_ROOM = 10_000
TASK_ROWS = 500_000  # line items that one task joins and groups


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def slots(spark: SparkSession, sf: str) -> DataFrame:
    """Exon slots before merging: gene, iso, status, priority, slot, w, s, e."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    od = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    n = -(-li.count() // TASK_ROWS)  # read from the footers alone
    if n > spark.sparkContext.defaultParallelism:
        # the sorts and hash tables of a task take many times the bytes of its shuffled rows, so large tables are dealt out by rows
        li, od = li.repartition(n, "l_orderkey"), od.repartition(n, "o_orderkey")
    gene = F.floor(F.col("o_custkey") / 2).cast("long")
    per = li.join(od, li.l_orderkey == od.o_orderkey).groupBy(
        F.col("l_orderkey").alias("iso"), gene.alias("gene"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"), F.col("l_linenumber").cast("long").alias("slot")).agg(
        F.min(F.col("l_partkey") % 3).alias("a"), F.max(F.col("l_suppkey") % 3).alias("b"),
        F.max((F.col("l_quantity") >= 46).cast("int")).alias("r"), F.count(F.lit(1)).alias("w"))
    base = F.floor(F.col("gene") / 5).cast("long") * GENE_ROOM + F.col("slot") * SLOT
    return per.select("gene", "iso", "status", "priority", "slot", "w", (base + F.col("a") * 20).alias("s"),
                      F.when(F.col("r") == 1, base + SLOT + 200).otherwise(base + 200 + F.col("b") * 20).alias("e"))


def isoforms(spark: SparkSession, sf: str) -> DataFrame:
    """chrom, strand, gene, iso, start, end, exons, reads, status, priority."""
    per = slots(spark, sf).groupBy("gene", "iso", "status", "priority").agg(
        F.collect_list(B.block(F.col("s"), F.col("e"))).alias("parts"), F.sum("w").alias("reads"))
    ex = per.withColumn("exons", B.merge(F.col("parts"))).drop("parts")
    return ex.select(
        F.concat(F.lit("chr"), F.col("gene") % 5 + 1).alias("chrom"), F.when(F.col("gene") % 2 == 0, "+").otherwise("-").alias("strand"),
        "gene", "iso", F.col("exons")[0]["s"].alias("start"), F.element_at("exons", -1)["e"].alias("end"), "exons", "reads", "status",
        "priority")


def models(spark: SparkSession, sf: str, iso: DataFrame | None = None) -> DataFrame:
    """Annotated transcripts: F orders, with a CDS one slot inside the span where it fits."""
    iso = (isoforms(spark, sf) if iso is None else iso).filter(F.col("status") == "F")
    return iso.select("chrom", "strand", F.col("gene"), F.col("iso").alias("trans"), "start", "end", "exons", "reads",
                      (F.col("start") + 50).alias("cds_start"), (F.col("end") - 70).alias("cds_end"))


def t_models(spark: SparkSession, sf: str, iso: DataFrame | None = None) -> DataFrame:
    return models(spark, sf, iso).select("chrom", "strand", F.col("trans").alias("t_name"), F.col("gene").alias("t_gene"),
                                    F.col("exons").alias("t_exons"))


def junction_table(spark: SparkSession, sf: str, iso: DataFrame | None = None) -> DataFrame:
    """Short-read junctions: introns of O orders with their summed reads, with outer block edges."""
    from spliceloom.operators.transcripts import exon_rows
    rows = exon_rows((isoforms(spark, sf) if iso is None else iso).filter(F.col("status") == "O"), ["reads"]).filter(F.col("next_s").isNotNull())
    return rows.groupBy("chrom", "strand", F.col("e").alias("js"), F.col("next_s").alias("je")).agg(
        F.sum("reads").alias("cnt"), F.min("s").alias("start")).withColumn("end", F.col("je") + 100)


# Printable letters and the base each stands for (code modulo 4 in ACGT).
LETTERS = "".join(chr(c) for c in range(1, 127) if chr(c) != "'")
BASES = "".join("ACGT"[ord(c) % 4] for c in LETTERS)


def to_bases(text: Column) -> Column:
    """Every ASCII letter as a base, any other as N."""
    kept = F.regexp_replace(F.translate(text, "'", "T"), r"[^\x01-\x7E]", "ä")
    return F.translate(kept, LETTERS + "ä", BASES + "N")


def sequences(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(F.col("doc_id").alias("id"), to_bases(F.col("text")).alias("seq"))


def dealt_sequences(spark: SparkSession, sf: str) -> DataFrame:
    """The sequences for heavy work inside each text, dealt out evenly first when the scan has fewer tasks than a shuffle."""
    docs, n = table(spark, sf, "documents").select("doc_id", "text"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    if docs.rdd.getNumPartitions() < n:
        docs = docs.repartition(n)
    return docs.select(F.col("doc_id").alias("id"), to_bases(F.col("text")).alias("seq"))


def genome(spark: SparkSession, sf: str) -> DataFrame:
    from spliceloom.sources.sequences import chunks
    return chunks(sequences(spark, sf).select(F.col("id").alias("chrom"), F.lit(0).cast("long").alias("pos"), "seq"))


def placed_isoforms(spark: SparkSession, sf: str, iso: DataFrame | None = None) -> DataFrame:
    """All isoforms on the document sequences, at a sixteenth of their size: gene, iso, chrom (a document), strand, status, exons.

    The document is the order key modulo the number of documents; what does not fit into a short one goes past its end.
    """
    iso = isoforms(spark, sf) if iso is None else iso
    docs = sequences(spark, sf).select(F.col("id").alias("chrom"), F.length("seq").alias("_len"))
    one = F.lit(1).alias("_one")
    n = table(spark, sf, "documents").agg(F.count(F.lit(1)).alias("_n")).select("*", one)
    rows = iso.drop("chrom").select("*", one).join(F.broadcast(n), "_one").withColumn("chrom", F.pmod("iso", "_n")).join(docs, "chrom")  # one row
    part = lambda v: F.floor((v - F.col("start")) / 16)
    off = F.pmod(F.col("iso"), F.greatest(F.col("_len") - part(F.col("end")), F.lit(1)))
    ex = F.transform("exons", lambda b: B.block((F.col("_off") + part(b["s"])).cast("long"), (F.col("_off") + part(b["e"])).cast("long")))
    return rows.withColumn("_off", off).select("gene", "iso", "chrom", "strand", "status", ex.alias("exons"))


def seq_introns(spark: SparkSession, sf: str) -> DataFrame:
    """Introns of all isoforms on the document sequences: chrom, strand, iso, a, b."""
    from spliceloom.operators.transcripts import intron_rows
    return intron_rows(placed_isoforms(spark, sf)).select("chrom", "strand", "iso", "a", "b")


def alignments(spark: SparkSession, sf: str, iso: DataFrame | None = None) -> DataFrame:
    """Isoforms written as alignments: name, flag, chrom, pos, cigar, md."""
    x = F.col("exons")
    n = F.size(x)
    def op(b: Column, i: Column) -> Column:
        size = b["e"] - b["s"]
        half = F.floor(size / 2).cast("long")
        nxt = F.get(x, i + 1)["s"] - b["e"]
        return F.concat(half, F.lit("M1I2D"), size - half - 2, F.lit("M"), F.when(i < n - 1, F.concat(nxt, F.lit("N"))).otherwise(""))
    def md(b: Column) -> Column:
        size = b["e"] - b["s"]
        half = F.floor(size / 2).cast("long")
        return F.concat(half, F.lit("^AC"), size - half - 40, F.lit("T37"))
    cigar = F.concat(F.col("reads"), F.lit("S"), F.array_join(F.transform(x, op), ""), F.lit("5H"))
    return (isoforms(spark, sf) if iso is None else iso).select(
        F.col("iso").alias("name"), (F.when(F.col("strand") == "-", 16).otherwise(0) + F.when(F.col("status") == "P", 256).otherwise(0)).alias("flag"),
        "chrom", "strand", (F.col("start") + 1).alias("pos"), cigar.alias("cigar"), F.array_join(F.transform(x, md), "N").alias("md"), "exons", "status")


view("slot_v", """
SELECT o_custkey // 2 AS gene, l_orderkey AS iso, o_orderstatus AS status, o_orderpriority AS priority, l_linenumber AS slot,
  min(l_partkey % 3) AS a, max(l_suppkey % 3) AS b, max(CASE WHEN l_quantity >= 46 THEN 1 ELSE 0 END) AS r, count(*) AS w
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""")
view("blk_v", """
SELECT gene, iso, status, priority, slot, w, 'chr' || (gene % 5 + 1) AS chrom, CASE WHEN gene % 2 = 0 THEN '+' ELSE '-' END AS strand,
  (gene // 5) * 10000 + slot * 1000 + a * 20 AS s,
  CASE WHEN r = 1 THEN (gene // 5) * 10000 + (slot + 1) * 1000 + 200 ELSE (gene // 5) * 10000 + slot * 1000 + 200 + b * 20 END AS e
FROM slot_v""")
view("isl_v", """
SELECT *, sum(CASE WHEN p IS NULL OR s > p THEN 1 ELSE 0 END) OVER (PARTITION BY iso ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island
FROM (SELECT *, max(e) OVER (PARTITION BY iso ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM blk_v)""")
view("ex_v", """
SELECT gene, iso, chrom, strand, status, priority, s, e, w,
  row_number() OVER (PARTITION BY iso ORDER BY s) - 1 AS k, count(*) OVER (PARTITION BY iso) AS n,
  lag(e) OVER (PARTITION BY iso ORDER BY s) AS prev_e, lead(s) OVER (PARTITION BY iso ORDER BY s) AS next_s
FROM (SELECT gene, iso, chrom, strand, status, priority, island, min(s) AS s, max(e) AS e, sum(w) AS w FROM isl_v GROUP BY ALL)""")
view("iso_v", """
SELECT gene, iso, chrom, strand, status, priority, min(s) AS lo, max(e) AS hi, count(*) AS n_ex, CAST(sum(w) AS BIGINT) AS reads,
  sum(e - s) AS len, coalesce(string_agg(CASE WHEN next_s IS NOT NULL THEN e || '-' || next_s END, ';' ORDER BY s), '') AS chain,
  string_agg(s || '-' || e, ';' ORDER BY s) AS exon_chain
FROM ex_v GROUP BY ALL""")
view("intr_v", """
SELECT gene, iso, chrom, strand, status, e AS a, next_s AS b, k FROM ex_v WHERE next_s IS NOT NULL""")
view("exr_v", "SELECT ex_v.*, reads FROM ex_v JOIN (SELECT iso, reads FROM iso_v) USING (iso)")
view("junc_v", """
SELECT chrom, strand, e AS js, next_s AS je, CAST(sum(reads) AS BIGINT) AS cnt, min(s) AS js_start, next_s + 100 AS je_end FROM exr_v
WHERE next_s IS NOT NULL AND status = 'O' GROUP BY ALL""")
view("mod_v", """
SELECT gene, iso AS trans, chrom, strand, lo, hi, lo + 50 AS cs, hi - 70 AS ce, n_ex FROM iso_v WHERE status = 'F'""")
view("mex_v", """
SELECT m.trans, m.gene, m.chrom, m.strand, m.lo, m.hi, m.cs, m.ce, m.n_ex, e.s, e.e, e.k, e.prev_e, e.next_s
FROM mod_v m JOIN ex_v e ON e.iso = m.trans""")
view("seq_v", "SELECT doc_id AS id, translate(regexp_replace(replace(text, '''', 'T'), '[^\\x01-\\x7E]', 'ä', 'g'), '"
     + LETTERS.replace("'", "''") + "ä', '" + BASES + "N') AS seq FROM documents")
# the exons of ex_v as numbers alone
view("nslot_v", """
SELECT o_custkey // 2 AS gene, l_orderkey AS iso, l_linenumber AS slot, min(l_partkey % 3) AS a, max(l_suppkey % 3) AS b, max(CASE WHEN l_quantity >= 46 THEN 1 ELSE 0 END) AS r
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""")
view("nblk_v", """
SELECT gene, iso, (gene // 5) * 10000 + slot * 1000 + a * 20 AS s, CASE WHEN r = 1 THEN (gene // 5) * 10000 + (slot + 1) * 1000 + 200 ELSE (gene // 5) * 10000 + slot * 1000 + 200 + b * 20 END AS e FROM nslot_v""")
view("nex_v", """
SELECT gene, iso, min(s) AS s, max(e) AS e FROM (
  SELECT *, sum(CASE WHEN p IS NULL OR s > p THEN 1 ELSE 0 END) OVER (PARTITION BY iso ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island
  FROM (SELECT *, max(e) OVER (PARTITION BY iso ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM nblk_v)) GROUP BY gene, iso, island""")
view("rel_v", """
SELECT iso, gene, iso % (SELECT count(*) FROM documents) AS chrom, (s - lo) // 16 AS s, (e - lo) // 16 AS e, (hi - lo) // 16 AS span, (next_s - lo) // 16 AS next_s FROM (
  SELECT *, min(s) OVER (PARTITION BY iso) AS lo, max(e) OVER (PARTITION BY iso) AS hi, lead(s) OVER (PARTITION BY iso ORDER BY s) AS next_s FROM nex_v)""")
view("pla_v", """
SELECT iso, gene, chrom, seq, length(seq) AS len, iso % greatest(length(seq) - span, 1) + s AS s, iso % greatest(length(seq) - span, 1) + e AS e, iso % greatest(length(seq) - span, 1) + next_s AS next_s
FROM rel_v JOIN seq_v ON id = chrom""")
view("mot_v", """
SELECT chrom, CASE WHEN gene % 2 = 0 THEN '+' ELSE '-' END AS strand, iso, a, b, l2, r2, CASE WHEN gene % 2 = 0 THEN l2 || '-' || r2
  ELSE reverse(translate(r2, 'ACGT', 'TGCA')) || '-' || reverse(translate(l2, 'ACGT', 'TGCA')) END AS motif
FROM (SELECT chrom, gene, iso, e AS a, next_s AS b, CASE WHEN e + 2 <= len THEN substr(seq, CAST(e + 1 AS BIGINT), 2) END AS l2, CASE WHEN next_s <= len THEN substr(seq, CAST(next_s - 1 AS BIGINT), 2) END AS r2
  FROM pla_v WHERE next_s IS NOT NULL)""")
view("tx_v", """
SELECT iso, CASE WHEN NOT inside THEN NULL WHEN gene % 2 = 1 THEN reverse(translate(t, 'ACGT', 'TGCA')) ELSE t END AS seq FROM (
  SELECT iso, gene, bool_and(e <= len) AS inside, string_agg(substr(seq, CAST(s + 1 AS BIGINT), CAST(e - s AS BIGINT)), '' ORDER BY s) AS t FROM pla_v GROUP BY iso, gene)""")
view("aln_v", """
SELECT iso AS name, (CASE WHEN strand = '-' THEN 16 ELSE 0 END) + (CASE WHEN status = 'P' THEN 256 ELSE 0 END) AS flag, chrom, strand, status,
  min(s) + 1 AS pos, any_value(reads) || 'S' || string_agg(((e - s) // 2) || 'M1I2D' || ((e - s) - (e - s) // 2 - 2) || 'M' ||
  CASE WHEN next_s IS NULL THEN '' ELSE (next_s - e) || 'N' END, '' ORDER BY s) || '5H' AS cigar,
  string_agg(((e - s) // 2) || '^AC' || ((e - s) - (e - s) // 2 - 40) || 'T37', 'N' ORDER BY s) AS md
FROM exr_v GROUP BY ALL""")
