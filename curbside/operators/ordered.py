"""Operators that depend on row order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbside.operators.dedup import keep_first
from curbside.session import settle


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The newest row of each key; `order` is ascending in age, newest first."""
    return keep_first(df, keys, order)


def last_n(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """The first `n` rows in `order` (top-n per task, then one merge; no full sort)."""
    return df.orderBy(*order).limit(n)


def previous_value(df: DataFrame, group: str, order: Sequence[str], value: str, name: str) -> DataFrame:
    """`lag(value)` over (partition by group order by order), whatever the size of a group.

    Rows are range-partitioned on (group, order), so that a large group spans many tasks. The lag is taken inside each
    range; the first row of a range takes the last value of the range before, which comes from one row per (group,
    range). Rows that tie on all of `order` should be alike in `value`, or their order is any.
    """
    ranged = df.repartitionByRange(group, *order).withColumn("_range", F.spark_partition_id())
    ranged = settle(ranged, "ranged")
    inside = Window.partitionBy(group, "_range").orderBy(*order)
    rows = ranged.withColumns({"_lag": F.lag(value).over(inside), "_nth": F.row_number().over(inside)})
    last = F.max_by(F.struct(value), F.struct(*order)).getField(value)
    edges = ranged.groupBy(group, "_range").agg(last.alias("_edge"))
    across = Window.partitionBy(group).orderBy("_range")  # one row per range
    edges = edges.withColumn("_edge_before", F.lag("_edge").over(across)).select(
        F.col(group).alias("_g"), F.col("_range").alias("_r"), "_edge_before"
    )
    joined = rows.join(edges, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_range") == F.col("_r")), "left")
    previous = F.when(F.col("_nth") == 1, F.col("_edge_before")).otherwise(F.col("_lag"))
    return joined.withColumn(name, previous).drop("_range", "_lag", "_nth", "_g", "_r", "_edge_before")
