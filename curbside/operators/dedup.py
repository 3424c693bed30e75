"""Duplicate handling that holds up when one key owns a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from curbside.operators.key_filter import KeyFilter
from curbside.session import settle


def total_order(df: DataFrame, first: Sequence[str] = ()) -> list[Column]:
    """Order over all plain columns, so that only verbatim copies tie."""
    plain = [
        f.name
        for f in df.schema.fields
        if not isinstance(f.dataType, (ArrayType, MapType, StructType)) and f.name not in first
    ]
    return [F.col(c) for c in (*first, *plain)]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """One row per key (NULL keys form a group): the first in `order`.

    Filtering the row number to 1 lets Catalyst cut every group to one row per map task before
    the shuffle (WindowGroupLimit), so a hot key never reaches one task whole.
    """
    window = Window.partitionBy(*keys).orderBy(*(order or total_order(df)))
    return df.withColumn("_nth", F.row_number().over(window)).where("_nth = 1").drop("_nth")


SALTS = 64


def mark_duplicates(
    df: DataFrame,
    keys: Sequence[str],
    flag: str = "_duplicate",
    order: Sequence[Column] | None = None,
    among: Column | None = None,
) -> DataFrame:
    """Flag every row but the first of its key, keeping all rows.

    Keys are counted first, which moves keys only. Rows whose key surely occurs once, as a filter sized by the number of
    repeated keys tells, need no order and are not shuffled. The others are ranked in two rounds: inside (key, salt),
    the salt being a hash of the whole row and its partition, then among the winners of the salts, at most SALTS to a
    key. So a key on a third of all rows is SALTS groups, also where a join on that key has put all its rows into one
    partition; verbatim copies are split by the partitions they come from. Rows where `among` is false take no part and
    are never flagged. `df` is read three times, so it must give the same rows each time.
    """
    order = list(order or total_order(df))
    takes_part = among if among is not None else F.lit(True)
    repeated = df.where(takes_part).groupBy(*keys).agg(F.count("*").alias("_rows")).where("_rows > 1")
    repeated = settle(repeated.select(F.struct(*keys).alias("_key")), "repeated-keys")
    n = repeated.count()  # from the footers
    if not n:
        return df.withColumn(flag, F.lit(False))
    split = KeyFilter(repeated, n).tag(df, F.struct(*keys), "_maybe")
    maybe = F.col("_maybe") & F.coalesce(takes_part, F.lit(False))
    alone = split.where(~maybe).drop("_maybe").withColumn(flag, F.lit(False))

    whole = [F.col(f"`{f.name}`") for f in df.schema.fields if not _has_map(f.dataType)]
    salt = F.pmod(F.xxhash64(F.spark_partition_id(), *whole), F.lit(SALTS))
    tagged = split.where(maybe).drop("_maybe").withColumn("_salt", salt)
    local = Window.partitionBy(*keys, "_salt").orderBy(*order)
    tagged = tagged.withColumn("_local", F.row_number().over(local))
    # winners of the salts share the group -1; the others stay where they are
    tagged = tagged.withColumn("_round2", F.when(F.col("_local") == 1, F.lit(-1)).otherwise(F.col("_salt")))
    final = Window.partitionBy(*keys, "_round2").orderBy(*order)
    tagged = tagged.withColumn("_final", F.row_number().over(final))
    duplicate = ~((F.col("_local") == 1) & (F.col("_final") == 1))
    return tagged.withColumn(flag, duplicate).drop("_salt", "_local", "_round2", "_final").unionByName(alone)


def _has_map(kind: DataType) -> bool:
    return isinstance(kind, MapType) or any(_has_map(f.dataType) for f in getattr(kind, "fields", []))
