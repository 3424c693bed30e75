"""Insert-only merge: rows whose key is new are added, the others are ignored."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

from curbside.operators.key_filter import KeyFilter

def key_bounds(updates: DataFrame, keys: Sequence[str]) -> tuple[int, dict[str, tuple]]:
    """Number of rows of the updates, and (least, greatest, any null) of their numeric and time keys; one row's worth.

    Bounds travel as text, which keeps wall-clock times independent of the driver's time zone.
    """
    simple = (NumericType, DateType, TimestampType, TimestampNTZType)
    usable = [k for k in keys if isinstance(updates.schema[k].dataType, simple)]
    stats = [F.count("*").alias("n")]
    for i, k in enumerate(usable):
        stats += [
            F.min(k).cast("string").alias(f"lo{i}"),
            F.max(k).cast("string").alias(f"hi{i}"),
            F.max(F.col(k).isNull()).alias(f"null{i}"),
        ]
    found = updates.agg(*stats).first()
    return found.n, {k: (found[f"lo{i}"], found[f"hi{i}"], found[f"null{i}"]) for i, k in enumerate(usable)}


def within(target: DataFrame, bounds: dict[str, tuple]) -> DataFrame:
    """Keep the target rows whose keys lie in the bounds. These reach the Parquet scan, so files that cannot match are
    not read."""
    for k, (low, high, has_null) in bounds.items():
        kind = target.schema[k].dataType
        test = F.col(k).between(F.lit(low).cast(kind), F.lit(high).cast(kind))
        target = target.where(test | F.col(k).isNull() if has_null else test)
    return target


def within_key_range(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`within` the bounds of the updates."""
    return within(target, key_bounds(updates, keys)[1])


def _known_keys(target: DataFrame, keyed: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """Distinct keys of the target that the `n` updates may have too.

    A filter sized by the number of updates cuts the target's keys before they are shuffled; few pass that the updates
    do not have.
    """
    found = target.select(F.struct(*keys).alias("_key"))
    # Struct equality treats NULL fields as equal, and grouping by the struct leaves the rows partitioned as the join
    # needs them.
    return KeyFilter(keyed, n).cut(found, F.col("_key")).select("_key").distinct()


def new_rows(updates: DataFrame, target: DataFrame, keys: Sequence[str], prune: bool = True) -> DataFrame:
    """The update rows without a match on all keys (NULL equals NULL).

    The updates are read twice, first for their number and key bounds; with `prune` the bounds cut the target.
    """
    n, bounds = key_bounds(updates, keys)
    if prune:
        target = within(target, bounds)
    keyed = updates.withColumn("_key", F.struct(*keys))
    return keyed.join(_known_keys(target, keyed, keys, n), "_key", "left_anti").drop("_key")


def merged(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target plus new rows; columns only one side has are NULL on the other."""
    return target.unionByName(new_rows(updates, target, keys), allowMissingColumns=True)


def merge_stats(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows before and after, update rows considered, inserted, ignored.

    The updates are tagged by one join and counted by one aggregate; the target's row count comes from its footers.
    """
    n, bounds = key_bounds(updates, keys)
    keyed = updates.withColumn("_key", F.struct(*keys))
    known = _known_keys(within(target, bounds), keyed, keys, n).withColumn("_known", F.lit(True))
    counted = keyed.join(known, "_key", "left").agg(
        F.count("*").alias("update_rows_considered"), F.count_if(F.col("_known").isNull()).alias("inserted")
    )
    return counted.crossJoin(target.agg(F.count("*").alias("rows_before"))).select(  # one row each
        "rows_before",
        "update_rows_considered",
        "inserted",
        (F.col("rows_before") + F.col("inserted")).alias("rows_after"),
        (F.col("update_rows_considered") - F.col("inserted")).alias("duplicates_ignored_vs_target"),
    )
