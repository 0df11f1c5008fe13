"""FASTA and FASTQ as line tables, and a genome as overlapping chunks.

A chromosome is never one row: lines are placed by running sums over file
blocks and regrouped into fixed chunks, so a genome of any size is read in
parallel and looked up by an equi-join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spliceloom.functions.sequence import on_strand
from spliceloom.operators.sweeps import running

CHUNK = 10_000
LAP = 1_000


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file, block and order inside the block."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value"))


def fasta_lines(numbered: DataFrame) -> DataFrame:
    """(chrom, pos, seq): each sequence line with its record name and 0-based position in the record."""
    head = F.col("value").startswith(">")
    rows = (numbered.withColumn("_h", head.cast("long"))
            .withColumn("_n", F.when(head, 0).otherwise(F.length("value")).cast("long")))
    scan = running(rows, ["file"], "at", cell=F.col("block"), record=("sum", "_h"), upto=("sum", "_n"))
    names = scan.filter(F.col("_h") == 1).select(
        "file", "record", F.regexp_extract("value", r"^>(\S+)", 1).alias("chrom"), F.col("upto").alias("_base"))
    return (scan.filter((F.col("_h") == 0) & (F.col("_n") > 0)).join(names, ["file", "record"])
                .select("chrom", (F.col("upto_before") - F.col("_base")).alias("pos"), F.col("value").alias("seq")))


def chunks(pieces: DataFrame, size: int = CHUNK, lap: int = LAP) -> DataFrame:
    """(chrom, chunk, seq) from placed pieces (chrom, pos, seq); a chunk repeats the next `lap` bases.

    Pieces may be of any length; each is cut at the chunk borders it crosses.
    """
    end = F.col("pos") + F.length("seq")
    first = F.greatest(F.floor((F.col("pos") - lap) / size), F.lit(0))
    cut = (pieces.filter(F.length("seq") > 0)
           .withColumn("chunk", F.explode(F.sequence(first.cast("long"), F.floor((end - 1) / size).cast("long"))))
           .withColumn("_s", F.greatest(F.col("pos"), F.col("chunk") * size))
           .withColumn("_e", F.least(end, (F.col("chunk") + 1) * size + lap)).filter(F.col("_e") > F.col("_s"))
           .withColumn("_q", F.substring("seq", (F.col("_s") - F.col("pos") + 1).cast("int"),
                                         (F.col("_e") - F.col("_s")).cast("int"))))
    parts = F.array_sort(F.collect_list(F.struct("_s", "_q")))
    return cut.groupBy("chrom", "chunk").agg(F.array_join(F.transform(parts, lambda p: p["_q"]), "").alias("seq"))


def read_genome(spark: SparkSession, path: str) -> DataFrame:
    return chunks(fasta_lines(numbered_lines(spark, path)))


def fasta_records(spark: SparkSession, path: str) -> DataFrame:
    """(id, seq) of a FASTA of transcripts or reads, where one record fits a row."""
    rows = spark.read.option("lineSep", ">").text(path).filter(F.length(F.trim("value")) > 0)
    return rows.select(F.regexp_extract("value", r"^(\S+)", 1).alias("id"),
                       F.regexp_replace(F.regexp_replace("value", r"^[^\n]*\n?", ""), r"\s+", "").alias("seq"))


def fastq_records(numbered: DataFrame) -> DataFrame:
    """(id, seq, qual): lines numbered within each file, four to a record."""
    rows = numbered.withColumn("_one", F.lit(1).cast("long"))
    scan = running(rows, ["file"], "at", cell=F.col("block"), line=("sum", "_one"))
    k = F.col("line_before")
    return (scan.groupBy("file", F.floor(k / 4).alias("record"))
                .agg(*[F.max(F.when(F.pmod(k, F.lit(4)) == i, F.col("value"))).alias(n)
                       for i, n in enumerate(["id", "seq", "plus", "qual"])])
                .select(F.regexp_extract("id", r"^@(\S+)", 1).alias("id"), "seq", "qual"))


def chrom_lengths(pieces: DataFrame) -> DataFrame:
    return pieces.groupBy("chrom").agg(F.sum(F.length("seq")).alias("length"))


def span_texts(genome: DataFrame, spans: DataFrame, start: str, end: str, out: str, strand: str | None = None) -> DataFrame:
    """Attach the genome text of [start, end) to each span, reverse-complemented on '-' when `strand` is given.

    Spans no longer than the chunk overlap read one chunk; longer ones are put
    together from the chunks they cross. Every span stays; one that is not wholly
    inside its sequence, or whose sequence is unknown, has a null text.
    """
    short = F.coalesce((F.col(end) - F.col(start)) <= LAP, F.lit(True))
    whole = lambda text: F.when(F.length(text) == F.col(end) - F.col(start), text)
    cut = lambda s, e, c: F.substring("seq", (s - c * CHUNK + 1).cast("int"), (e - s).cast("int"))
    one = (spans.filter(short).withColumn("chunk", F.floor(F.col(start) / CHUNK).cast("long"))
           .join(genome, ["chrom", "chunk"], "left").withColumn(out, whole(cut(F.col(start), F.col(end), F.col("chunk")))).drop("seq", "chunk"))
    wide = spans.filter(~short)
    many = (wide.select("chrom", start, end).distinct().withColumn("chunk", F.explode(F.sequence(
                F.floor(F.col(start) / CHUNK).cast("long"), F.floor((F.col(end) - 1) / CHUNK).cast("long"))))
            .join(genome, ["chrom", "chunk"])
            .withColumn("_p", cut(F.greatest(F.col(start), F.col("chunk") * CHUNK),
                                  F.least(F.col(end), (F.col("chunk") + 1) * CHUNK), F.col("chunk"))))
    parts = F.array_sort(F.collect_list(F.struct("chunk", "_p")))
    text = many.groupBy("chrom", start, end).agg(F.array_join(F.transform(parts, lambda p: p["_p"]), "").alias(out))
    both = one.unionByName(wide.join(text.withColumn(out, whole(F.col(out))), ["chrom", start, end], "left"))
    return both.withColumn(out, on_strand(F.col(out), F.col(strand))) if strand else both


def windows(genome: DataFrame, spans: DataFrame, start: str, end: str, out: str, strand: str | None = None) -> DataFrame:
    """``span_texts`` of the spans that are wholly inside their sequence; the others are left out."""
    return span_texts(genome, spans, start, end, out, strand).filter(F.col(out).isNotNull())


def splice_motifs(genome: DataFrame, introns: DataFrame) -> DataFrame:
    """Add `motif` donor-acceptor (strand aware), `left_two` and `right_two` (genome text) to introns (chrom, strand, a, b).

    Every intron stays; where an edge lies outside its sequence, that edge and the motif are null.
    """
    keys = introns.select("chrom", "a", "b").distinct()
    edges = (keys.withColumn("_x", F.explode(F.array(
        F.struct(F.lit("left_two").alias("side"), F.col("a").alias("s")),
        F.struct(F.lit("right_two").alias("side"), (F.col("b") - 2).alias("s")))))
        .select("chrom", "a", "b", "_x.side", F.col("_x.s").alias("s"), (F.col("_x.s") + 2).alias("e")))
    two = span_texts(genome, edges, "s", "e", "_t")
    wide = two.groupBy("chrom", "a", "b").agg(*[F.max(F.when(F.col("side") == c, F.upper("_t"))).alias(c)
                                                for c in ("left_two", "right_two")])
    l, r = F.col("left_two"), F.col("right_two")
    minus = F.concat_ws("-", on_strand(r, F.lit("-")), on_strand(l, F.lit("-")))
    return (introns.join(wide, ["chrom", "a", "b"], "left")
                   .withColumn("motif", F.when(l.isNotNull() & r.isNotNull(), F.when(F.col("strand") == "-", minus).otherwise(F.concat_ws("-", l, r)))))


def spliced(genome: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Transcript text: exon texts in order, reverse-complemented on '-'. Input: iso, chrom, strand, exons.

    A transcript without exons, or with one that is not wholly inside its sequence, has a null text.
    """
    ex = transcripts.select("iso", "chrom", "strand", F.posexplode_outer("exons").alias("k", "x")).select(
        "iso", "chrom", "strand", "k", F.col("x.s").alias("s"), F.col("x.e").alias("e"))
    got = span_texts(genome, ex, "s", "e", "_q")
    parts = F.array_sort(F.collect_list(F.struct("k", "_q")))
    return (got.groupBy("iso", "strand").agg(F.when(F.count("_q") == F.count(F.lit(1)), F.array_join(F.transform(parts, lambda p: p["_q"]), "")).alias("_t"))
               .select("iso", on_strand(F.col("_t"), F.col("strand")).alias("seq")))


def site_windows(sites: DataFrame, lengths: DataFrame, up: int, down: int, k: int = 1) -> DataFrame:
    """Up- and downstream spans around 1-bp sites that stay inside the chromosome.

    `k` > 1 widens each span so that k-letter windows start at every offset.
    """
    more = k - 1
    s, e, plus = F.col("start"), F.col("end"), F.col("strand") == "+"
    shift = 1 if k == 1 else 0
    # the list of chromosomes is short but its size is left to AQE
    rows = sites.join(lengths, "chrom").filter(
        F.when(plus, (s > up) & (e + down + more < F.col("length"))).otherwise((s > down) & (e + up + more < F.col("length"))))
    lo = F.greatest(s - down - (shift or more), F.lit(0))
    upstream = F.struct(F.lit("up").alias("side"), F.when(plus, s - up).otherwise(e).alias("s"),
                        F.when(plus, s + more).otherwise(e + up + more).alias("e"))
    downstream = F.struct(F.lit("down").alias("side"), F.when(plus, e).otherwise(lo).alias("s"),
                          F.when(plus, e + down + more).otherwise(s - shift).alias("e"))
    return (rows.withColumn("_w", F.explode(F.array(upstream, downstream)))
                .select("chrom", "strand", "start", "end", "_w.side", F.col("_w.s").alias("w_start"), F.col("_w.e").alias("w_end")))
