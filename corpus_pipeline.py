"""The corpus pipeline: documents in, token ids of the training mix out.

Each stage reads what its predecessor kept, as Parquet, and calls one operator of `curbside.llm`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbside.llm import byte_bpe, compression, mixing, near_copies, secrets
from curbside.llm.common import table
from curbside.session import settle


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier predicts good; an empty text is as good as texts are on the whole."""
    return compression.keep_good(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: fingerprints and MinHash propose, five-word shingles decide."""
    return near_copies.keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark."""
    return secrets.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs, table(spark, sf_dir, "labels"))


def byte_bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, token_ids, and restored (the ids decode to the text) of every document left.

    Null texts have no ids.
    """
    ids = docs.select("doc_id", "lang", "source", byte_bpe.encoded_and_restored(F.col("text")).alias("t"))
    return ids.select("doc_id", "lang", "source", F.size("t.token_ids").alias("n_tokens"), "t.token_ids", "t.restored")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("secret scans", secret_scan),
    ("mixing sources to target weights", source_mix),
    ("byte-level BPE", byte_bpe_encoding),
]

#: Compression, fingerprints and tokens have no SQL form; tests compare the run with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each returns is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name.split()[0].lower())
    return docs
