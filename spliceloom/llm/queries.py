"""Registered queries of the corpus operators, with SQL where it can state the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import chat as C
from .alignment import aligned
from .common import table, words
from .decontaminate import contaminated
from .lines import dedup_lines
from .mixing import mix
from .neardup import near_duplicates
from .pii import pseudonymised
from .quality import quality_rules
from .repeats import without_repeats
from .setjoin import ngram_join
from .sharding import contiguous_shards
from .spelling import spelling_variants
from .tokens import read_token_files, write_token_files

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return wrap


def crc32(text) -> F.Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


@query("op1_sharding")
def op1_sharding(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    rows = docs.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"), crc32(F.col("text")).alias("text_crc32"))
    out = contiguous_shards(rows, 8)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


CONTAMINATED_SQL = """
WITH w AS (SELECT 'd' AS side, doc_id AS id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[ \\t-\\r]+'), lambda x: x <> '') AS w FROM documents
  UNION ALL SELECT 'i', item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[ \\t-\\r]+'), lambda x: x <> '') FROM benchmark),
s AS (SELECT DISTINCT side, id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN ['#' || array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS sh FROM w),
q AS (SELECT id, count(*) AS q FROM s WHERE side = 'i' GROUP BY id)
SELECT d.id AS doc_id, i.id AS item_id, CAST(max(q) AS INTEGER) AS n_item_shingles, CAST(count(*) AS INTEGER) AS n_shared, count(*) / max(q) AS containment
FROM s i JOIN s d ON i.sh = d.sh AND i.side = 'i' AND d.side = 'd' JOIN q ON q.id = i.id GROUP BY d.id, i.id HAVING count(*) >= ceil(max(q) * 80 / 100)"""


@query("op2_decontamination", CONTAMINATED_SQL)
def op2_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op3_pii")
def op3_pii(spark: SparkSession, sf: str) -> DataFrame:
    # the key is a parameter of the operator; a real run passes a secret one
    out = pseudonymised(table(spark, sf, "documents"), spark.conf.get("spliceloom.pii.key", "demonstration key"))
    return out.select("doc_id", "text", "n_pii", "pii_kinds")


@query("op4_quality_rules")
def op4_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    q = quality_rules(table(spark, sf, "documents"))
    return q.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "char_js", "word_js")


@query("op5_near_duplicates")
def op5_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(table(spark, sf, "documents"))


@query("op6_token_output")
def op6_token_output(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    manifest = write_token_files(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_files(manifest).withColumnRenamed("key", "doc_id")


def messages_of(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations as reply trees: each row answers the one before it; the extra conversation is added."""
    rows = table(spark, sf, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    said = C.END + C.START + "assistant ok"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    w = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.unionByName(extra).withColumn("id", F.row_number().over(w))
    return rows.select(F.col("conv_id").alias("tree"), "id", F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


@query("op7_chat_formatting")
def op7_chat_formatting(spark: SparkSession, sf: str) -> DataFrame:
    f = C.chat(messages_of(spark, sf)).withColumn("turns", C.read_turns(F.col("formatted"))).withColumn("loss", C.read_loss(F.col("formatted"), F.col("loss_spans")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return f.select(F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"), F.char_length("loss").cast("long").alias("loss_chars"),
                    F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), F.char_length("formatted").cast("long").alias("formatted_chars"))


LINES_SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
o AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.*, o.key IS NOT NULL AND k.doc_id <> o.last AS gone FROM k LEFT JOIN o ON k.key = o.key)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM m GROUP BY doc_id"""


@query("op8_line_dedup", LINES_SQL)
def op8_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    out = dedup_lines(table(spark, sf, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


@query("op9_repeats")
def op9_repeats(spark: SparkSession, sf: str) -> DataFrame:
    out = without_repeats(table(spark, sf, "documents").select("doc_id", "text"), 400, keep_first=False)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op10_mixing")
def op10_mixing(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select("doc_id", "source", F.size(words(F.col("text"))).cast("long").alias("size"))
    out, _ = mix(rows, "size", "source", ["doc_id"], [3, 1, 2])
    # every copy that the splitting tree placed counts once
    return out.select("doc_id", "size", "source_size", "target", (F.size("shards") * F.col("size")).alias("taken"), "shards")


@query("op11_ngram_join")
def op11_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join(table(spark, sf, "documents"))


@query("op12_tokenizer_alignment")
def op12_tokenizer_alignment(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    out = aligned(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), digest=True)
    return out.withColumnRenamed("groups", "groups_sha256")


@query("op13_spelling_variants")
def op13_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return spelling_variants(table(spark, sf, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


@query("pipeline")
def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)
