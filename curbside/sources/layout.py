"""Physical layout of Parquet tables: partitioned writes and their footprint."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def spread_for(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Group rows by partition value before a partitioned write.

    A rebalance, unlike a plain repartition, lets adaptive execution split a value that holds a
    large share of the rows and merge small ones, so files come out evenly sized.
    """
    return df.hint("rebalance", *partition_by)


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str], mode: str = "overwrite") -> None:
    spread_for(df, partition_by).write.mode(mode).partitionBy(*partition_by).parquet(path)


def one_of(column: str, values: Sequence[str | None]) -> Column:
    """True or false, never null: whether a partition column has one of the values, null being a value."""
    known = [v for v in values if v is not None]
    test = F.coalesce(F.col(column).isin(known), F.lit(False)) if known else F.lit(False)
    return test | F.col(column).isNull() if None in values else test


def with_pickup_date(df: DataFrame) -> DataFrame:
    """Local date as text, the partition column of the integrated table."""
    return df.withColumn("pickup_date", F.date_format("pickup_time_local", "yyyy-MM-dd"))


def with_pickup_month(df: DataFrame) -> DataFrame:
    return df.withColumn("pickup_month", F.date_format("pickup_time_local", "yyyy-MM"))


def storage_footprint(spark: SparkSession, *paths: str) -> DataFrame:
    """One row: files, bytes and megabytes of the Parquet files below the paths, and their rows.

    Files are listed, not read, so that files without rows count; rows come from the footers.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
    files = listed.load(list(paths)).select("length").agg(
        F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")
    )
    rows = spark.read.option("mergeSchema", "true").parquet(*paths).agg(F.count("*").alias("rows"))
    return files.crossJoin(rows).select(  # one row each
        "files", "bytes", F.round(F.col("bytes") / F.lit(1024.0 * 1024.0), 2).alias("megabytes"), "rows"
    )


def storage_overhead(extra: DataFrame, base: DataFrame) -> DataFrame:
    """Bytes of `extra` tables as a percentage of `base` tables; both are footprint rows."""
    sides = extra.select("bytes", F.lit(0).alias("b")).union(base.select(F.lit(0), "bytes"))
    total = sides.agg(F.sum("bytes").alias("extra_bytes"), F.sum("b").alias("base_bytes"))
    percent = F.round(F.col("extra_bytes") / F.col("base_bytes") * 100, 2)
    return total.withColumn("overhead_percent", percent)
