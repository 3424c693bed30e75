"""Cleaning: filters on keys, time key and value ranges, with accounting of the rows lost."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbside.operators.dedup import keep_first, total_order


def exclude_codes(df: DataFrame, columns: Sequence[str], codes: Sequence[int]) -> DataFrame:
    """Drop rows where any of the columns holds an excluded code or is NULL."""
    return df.where(reduce(Column.__and__, [~F.col(c).isin(*codes) for c in columns]))


def in_range(column: str, lo: float | None, hi: float | None) -> Column:
    """Inclusive range test that NULL passes."""
    value = F.col(column)
    tests = [value >= lo] if lo is not None else []
    tests += [value <= hi] if hi is not None else []
    if not tests:
        raise ValueError(f"range on {column} needs at least one bound")
    return value.isNull() | reduce(Column.__and__, tests)


def clean(
    df: DataFrame,
    keys: Sequence[str],
    ranges: Mapping[str, tuple],
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """Drop duplicate keys, then rows with NULL keys, no time key, or values out of range.

    A group with a NULL key is dropped whole, so that test goes before the shuffle; the others
    stay after it, because they judge the row that was kept.
    """
    has_time = "time_utc" in df.columns and "time_utc" not in keys
    with_keys = df.dropna(subset=list(keys))
    kept = keep_first(with_keys, keys, order)
    if has_time:
        kept = kept.where(F.col("time_utc").isNotNull())
    tests = [in_range(c, lo, hi) for c, (lo, hi) in ranges.items() if (lo, hi) != (None, None)]
    return reduce(DataFrame.where, tests, kept)


def clean_counts(df: DataFrame, keys: Sequence[str], ranges: Mapping[str, tuple]) -> DataFrame:
    """One row: rows_in, rows_kept, rows_rejected of `clean`.

    One pass: a key's rows shrink to their number and the row that is kept before anything is shuffled.
    """
    first = F.min(F.struct(*total_order(df))).alias("first")
    groups = df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.count("*").alias("n"), first)
    tests = [F.col(f"_{k}").isNotNull() for k in keys]
    if "time_utc" in df.columns and "time_utc" not in keys:
        tests.append(F.col("first.time_utc").isNotNull())
    tests += [in_range(f"first.{c}", lo, hi) for c, (lo, hi) in ranges.items() if (lo, hi) != (None, None)]
    kept = F.count_if(reduce(Column.__and__, tests))
    return groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows_in"), kept.alias("rows_kept")).withColumn(
        "rows_rejected", F.col("rows_in") - F.col("rows_kept")
    )
