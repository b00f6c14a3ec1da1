"""Registered queries of the operators with their production parameters, and their oracles."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.llm import mixture
from pressloom.llm.hard_negatives import HARD_NEGATIVES_SQL, hard_negatives
from pressloom.llm.manifest import MANIFEST_SQL, manifest, verified
from pressloom.llm.mixing import mix
from pressloom.llm.oracles import DECONTAMINATION_SQL, NEAR_DUPLICATES_SQL, REPEATED_STRINGS_SQL
from pressloom.session import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TOKENIZER = os.environ.get("PRESSLOOM_TOKENIZER") or public_tokenizers.path("byte_bpe_50k.json")


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_training_order")
def op1_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sequence, read back from the shards: its slot, place and the digest of its token bytes."""
    from pressloom.llm.token_output import read_slots, write_training_order

    path = shared_dir(spark, "training-order")
    write_training_order(table(spark, sf_dir, "documents"), path, TOKENIZER, key=20240607)
    return read_slots(spark, path).withColumn("tokens_sha256", F.sha2("tokens", 256)).drop("tokens")


@query("op10_token_counts")
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pressloom.llm.token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), TOKENIZER, limit=1024)


@query("op3_minmax_near_duplicates", NEAR_DUPLICATES_SQL)
def op3_minmax_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pressloom.llm.near_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


@query("op9_decontamination", DECONTAMINATION_SQL)
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pressloom.llm.decontam import documents_hit, phrase_matches, positional_index

    index = positional_index(table(spark, sf_dir, "documents"))
    hits = documents_hit(index, phrase_matches(index, table(spark, sf_dir, "benchmark")))
    return hits.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op6_repeated_strings", REPEATED_STRINGS_SQL)
def op6_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pressloom.llm.suffix_dedup import remove_repeats

    out = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s.last - s.first)
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op7_language_id")
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pressloom.llm.langid import identify, train

    documents = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(True)).alias("held_out")
    return identify(documents.select("doc_id", held_out, "text"), train(documents))


@query("op2_mixture", mixture.mix_sql("documents", mixture.SHARE, "doc_id, domain, lang, source, n_tokens, epoch"))
def op2_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    mixed = mix(documents, mixture.WEIGHTS, mixture.domain(), share=mixture.SHARE, max_epochs=mixture.MAX_EPOCHS, seed=mixture.SEED)
    return mixed.select("doc_id", "domain", "lang", "source", "n_tokens", "epoch")


CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, length(text) + length(text) - length(replace(text, '\', '')) + len(regexp_extract_all(text, '<\||</s>|<s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>')) AS text_chars
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(8 + length(role) + 8 + text_chars + 7)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id"""


@query("op4_chat_format", CHAT_SQL)
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pressloom.llm.chat import format_chat, read_loss, read_turns

    text = "</s>[INST] ok [/INST]"
    planted = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"))
    out = format_chat(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(planted))
    turns = F.array_join(F.transform(read_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    back = out.select("conv_id", "n_turns", turns.alias("turns"), read_loss(F.col("formatted"), F.col("loss")).alias("learned"), F.length("formatted").cast("bigint").alias("formatted_chars"))
    return back.select(
        "conv_id",
        "n_turns",
        F.sha2("turns", 256).alias("turns_sha256"),
        F.length("learned").cast("bigint").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        "formatted_chars",
    )


FIXED_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


@query("op8_url_rules")
def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's path holds the id of the document it shows, whose label is the URL's."""
    from pressloom.llm.url_rules import judge, mine

    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labels = table(spark, sf_dir, "labels").select("doc_id", ((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("bad"))
    shown = F.expr("try_cast(regexp_extract(url, '://[^/]*/[a-z]+/([0-9]+)', 1) AS bigint)")
    labelled = pages.withColumn("doc_id", shown).join(labels, "doc_id").select("url", "bad")
    return judge(pages, FIXED_RULES, mine(labelled)).select("page_id", "host", "path", "rule", "verdict")


TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS y FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.y::DOUBLE[], c.y::DOUBLE[])::BIGINT AS score,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.y::DOUBLE[], c.y::DOUBLE[])::BIGINT DESC, c.vec_id) AS rank
  FROM (SELECT DISTINCT * FROM v) q JOIN v c ON q.vec_id <> c.vec_id AND len(q.y) = len(c.y) WHERE q.vec_id % 100 = 0)
WHERE rank <= 10"""


@query("op5_mtree_top_k", TOP_K_SQL)
def op5_mtree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pressloom.llm.mtree import top_k

    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, vectors.where("vec_id % 100 = 0"), k=10)


@query("op11_merkle_manifest", MANIFEST_SQL)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof, and what it leads to after the line breaks of every other id's texts were lost."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    lost = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(lost, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return verified(manifest(documents, now=[F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text]))


@query("op12_hard_negatives", HARD_NEGATIVES_SQL)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh row has a wrong label on purpose; every fiftieth is an anchor."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label")
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", label, "embedding")
    return hard_negatives(vectors, vectors.where("vec_id % 50 = 0"))


@query("op13_fingerprints")
def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pressloom.llm.fingerprints import fingerprints

    return fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))
