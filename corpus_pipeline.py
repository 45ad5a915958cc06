"""Documents to training records, in stages that each work on what the one before kept.

Toxic documents go; one document of each group of near copies stays; documents that hold
benchmark items go; sources are mixed to their weights, which may leave a document out or
repeat it; what is left is written as binary records and read back. Documents without an
id are never dropped as copies or leaks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riverloom.llm import leaks, minhash, mixing, queries, records, toxicity
from riverloom.session import saved


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.5."""
    return toxicity.below(docs, queries.toxicity_model(spark, docs, sf_dir))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that share 80 % of their shingles, the one with the smallest id."""
    copies = minhash.near_duplicates(docs, percent=80).where("NOT kept").select("doc_id")
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = leaks.leaks(docs, queries.table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(saved(found, "leaks"), "doc_id", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def write_records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The records written, as read back: doc_id, start, n_tokens, ids_crc32."""
    manifest = records.write_records(docs, queries.vocabulary(), end_id=1)
    return records.checksums(records.read_records(manifest))


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("records", write_records),
]

#: classifier, hashes and tokenizer are beyond SQL; see tests/llm/test_pipeline.py
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
