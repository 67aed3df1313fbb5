"""Corpus pipeline over ``documents``: stages that each apply one operator.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes each stage's rows as Parquet into the shared folder and gives the
reread table to the next one.

All stages take null ids, texts and other columns, repeated rows, an empty table
and further columns, which all but the last hand on (packing returns its places
alone); what a stage does with the rest is in its docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kubus.llm import decontaminate, packing, quality, secrets, simhash
from kubus.llm.common import read_table, written
from kubus.llm.registry import vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned quality rules reject go, null and empty texts
    among them; equal rows are judged alike."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: the least doc_id, then the
    least text hash; texts without words are one component."""
    return simhash.keep_one(docs, shingle=3, radius=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; null and empty texts hold none."""
    return decontaminate.keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by their kind; all documents stay, null
    and empty texts as they are; n_chars follows a changed text."""
    return secrets.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining document's place in the packed sequences, a row per piece;
    a null or empty text is its end id alone."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"), "dropped", end_id=1) \
        .drop("part", "rank")


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("secret_scan", secret_scan),
          ("best_fit_packing", best_fit_packing)]

# Fingerprints, learned thresholds and packing have no SQL form; the stages
# are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name}")
    return docs
