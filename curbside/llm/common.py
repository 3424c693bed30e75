"""What the corpus operators share: tables, splits, words, and the size of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word, for Java and DuckDB alike: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

#: Rows of an Arrow batch. Documents are long, so the default of 10,000 would hold too much text at once.
BATCH_ROWS = "1000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def remainder(doc_id: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; null for a null id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string")) % modulus


def unused(name: str, columns: Iterable[str]) -> str:
    """`name`, lengthened until it is none of the columns; Spark's names ignore case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def tokens_of(text: str | None) -> list[bytes]:
    """UTF-8 words of a text with A-Z lowered; bytes.split() splits at exactly the six ASCII white-space bytes."""
    return (text or "").encode("utf-8", "replace").lower().split()
