"""Pseudo-random columns that depend on the row's own values only.

Unlike `rand`, they give the same result for any partitioning and after any task retry. The mixing
is plain 64-bit integer arithmetic, so it stays inside generated code, and any SQL engine can
repeat it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

# The Mersenne prime 2^31 - 1 and multipliers of known Lehmer generators.
PRIME = 2147483647
KEY_MULTIPLIER = 48271
ROUNDS = ((625341585, 69621), (1540483477, 40692), (461845907, 16807))


def key_columns(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """Keys as integers; other types through their 64-bit hash."""
    return [
        F.col(k) if isinstance(df.schema[k].dataType, IntegralType) else F.xxhash64(k) for k in keys
    ]


def uniform(seed: int, *keys: Column | str) -> Column:
    """A number in [0, 1) from integer keys; NULL counts as 0.

    Every step uses the one before once, so the expression stays small.
    """
    state = F.lit(seed % PRIME).cast("bigint")
    for key in keys:
        key = F.coalesce((F.col(key) if isinstance(key, str) else key).cast("bigint"), F.lit(0))
        for part in (key, F.shiftright(key, 31)):
            mixed = state.bitwiseXOR(part.bitwiseAND(F.lit(PRIME)))
            state = (mixed * KEY_MULTIPLIER + F.lit(seed % 65536 + 1)) % PRIME
    for mask, multiplier in ROUNDS:
        state = (state.bitwiseXOR(F.lit(mask)) * multiplier) % PRIME
    return state / F.lit(float(PRIME))
