"""The ``opN_<name>`` queries: each applies one operator, with production
parameters, to its whole table and derives the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat, decontaminate, langid, licenses, merkle, mixing, packing, quality, secrets,
               simhash, token_files, trie, warc)
from .common import crc32_mod, read_table, written
from .oracle import OP11_SQL, OP12_SQL, OP13_SQL

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.verdicts(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                        "n_repeat_words", "base_failed", "kept", "broken")


def vocabulary(name: str) -> str:
    """Path of a tokenizer file of the installed collection."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(read_table(spark, sf_dir, "documents"),
                                   vocabulary("byte_bpe_50k.json"), "leading", end_id=2)


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.with_control_example(spark, read_table(spark, sf_dir, "conversations"))
    output = written(chat.formatted(chat.messages_from_turns(turns), unique=True), "chat-formatted")
    return chat.digests(output)


# The template's marks are 23 characters a turn; the two replacements per
# control string are what escaping does.
OP3_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (
  SELECT *, replace(replace(replace(replace(replace(role || chr(0) || text, '\', '\\'),
    '<s>', '<\s>'), '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]') AS shown
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  sum(length(shown) - 1 + 23)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(read_table(spark, sf_dir, "documents"))
    base = [r.kind for r in secrets.BASE_RULES]

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of(kinds):
        return F.filter("spans", lambda s: s["kind"].isin(kinds))

    return found.select("doc_id", *[F.size(of([k])).cast("long").alias(f"n_{k}") for k in base],
                        F.sha2(joined(of(base)), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"),
                                      read_table(spark, sf_dir, "benchmark")).drop("text_hash")


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read_table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(read_table(spark, sf_dir, "pages"))


OP7_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (
  SELECT *, CASE WHEN payload_bytes >= 100
                 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first
       THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f
"""


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = packing.pack(read_table(spark, sf_dir, "documents"),
                         vocabulary("word_bpe_49k.json"), "dropped", end_id=1)
    return found.drop("part", "rank")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    tampered = F.coalesce(crc32_mod("doc_id", 7) == 0, F.lit(False))
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    changed = [F.col("n_chars") + 1 if i == 3 else c for i, c in enumerate(columns)]
    proofs = merkle.manifest(docs.select(
        "doc_id", "lang", merkle.leaf_hash(*columns).alias("leaf"),
        F.when(tampered, merkle.leaf_hash(*changed)).alias("tampered")))
    return proofs.select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(merkle.siblings(F.col("witness")), 256).alias("proof_sha256"),
        merkle.folded(F.coalesce("tampered", "leaf"), F.col("witness")).alias("folded_root")) \
        .withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations")
    splices = turns.select("conv_id").distinct().select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % 20).alias("base_id"),
        crc32_mod("conv_id", 4).alias("head"))
    return trie.prefix_trie(turns, splices)


def queries() -> dict[str, Query]:
    return {
        "op1_quality": op1_quality,
        "op2_token_files": op2_token_files,
        "op3_chat": op3_chat,
        "op4_secrets": op4_secrets,
        "op5_decontaminate": op5_decontaminate,
        "op6_langid": op6_langid,
        "op7_warc": op7_warc,
        "op8_packing": op8_packing,
        "op9_licenses": op9_licenses,
        "op10_simhash": op10_simhash,
        "op11_merkle": op11_merkle,
        "op12_mixing": op12_mixing,
        "op13_trie": op13_trie,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_chat": OP3_SQL, "op7_warc": OP7_SQL, "op11_merkle": OP11_SQL,
            "op12_mixing": OP12_SQL, "op13_trie": OP13_SQL}
