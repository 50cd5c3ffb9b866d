"""A training corpus from ``documents``: five stages, each on all that the one before kept.

language ID (rejected documents go), near-dedup (one document of each group stays),
benchmark decontamination (documents with a benchmark passage go), secret scan (secrets are
redacted), byte-level BPE (token ids of what is left).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetquarry.llm import byte_bpe, decontaminate, language_id, secrets, simhash
from fleetquarry.llm.common import load, stored
from fleetquarry.llm.queries import pattern, vocabulary


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with enough confidence."""
    return language_id.keep_known(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group linked by SimHash fingerprints (three words, three bits)."""
    return simhash.keep_first(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontaminate.remove_contaminated(docs, load(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced in text (n_chars follows)."""
    return secrets.redact(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, digests and token ids of every document."""
    return byte_bpe.encode_decode(docs, vocabulary("byte_bpe_multi_50k.tiktoken"), pattern(), with_ids=True)


STAGES = [
    ("language_id", known_language),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminated),
    ("secrets", without_secrets),
    ("byte_bpe", encoded),
]

#: A trained model decides the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each stored as Parquet in the shared folder before the next."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
