"""One query per corpus operator, over the whole tables it is meant for, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbside.llm import (
    byte_bpe,
    collocations,
    compression,
    fixity,
    lm,
    main_text,
    mixing,
    multi_index,
    outliers,
    ppm,
    secrets,
    simhash,
    whitening,
)
from curbside.llm.common import table
from curbside.llm.oracles import ORACLES  # noqa: F401


def op1_gru_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.log_likelihood(table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"))


def op4_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.judged(table(spark, sf_dir, "documents"))


def op5_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.identify(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records against a replica with faults at known keys."""
    pages = table(spark, sf_dir, "pages")
    records = pages.select(F.col("page_id").alias("key"), fixity.record(F.col("url"), F.col("html")).alias("record"))
    return fixity.audit(records, fixity.damaged(records))


def op10_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.near_vectors(table(spark, sf_dir, "embeddings"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_gru_lm,
        op2_quality_classifier,
        op3_byte_bpe,
        op4_quality_outliers,
        op5_ppm_language,
        op6_secret_scan,
        op7_source_mix,
        op8_simhash,
        op9_warc_fixity,
        op10_multi_index,
        op11_whitening,
        op12_collocations,
        op13_main_text,
    )
}
