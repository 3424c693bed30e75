"""Group profiles: counts, means, distinct counts and most frequent values from one scan.

Every requested breakdown is one grouping set, so a map task sends at most one row per
(group, value) it has seen, whatever the share of the largest group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _names(kind: str, n: int) -> list[str]:
    return [f"_{kind}{i}" for i in range(n)]


def profile_parts(
    df: DataFrame,
    group: str,
    modes: Mapping[str, Column],
    means: Mapping[str, Column] | None = None,
    distincts: Mapping[str, Column] | None = None,
    by: str | None = None,
    exact: bool = False,
) -> DataFrame:
    """What a profile is made of: one row per group, and one per group and value of each breakdown, with counts and sums.

    With `by` there is one set of rows per value of that column, such as a day. Parts of several days add up. `exact` sums
    are decimals of ten places, so adding up gives the same in any order; values that are no such decimals (NaN,
    infinities) are left out of them.
    """
    means, distincts = means or {}, distincts or {}
    breakdowns = {**modes, **distincts}
    measures = [v.try_cast("decimal(28,10)") if exact else v for v in means.values()]
    fixed = [F.col(c) for c in (by, group) if c]
    prepared = df.select(
        *fixed,
        *[value.alias(f"_b{i}") for i, value in enumerate(breakdowns.values())],
        *[value.alias(f"_m{i}") for i, value in enumerate(measures)],
    )
    keys = [F.col(c) for c in _names("b", len(breakdowns))]
    sets = [fixed] + [[*fixed, key] for key in keys]
    return prepared.groupingSets(sets, *fixed, *keys).agg(
        F.grouping_id().alias("_set"),
        F.count("*").alias("_n"),
        *[F.sum(f"_m{i}").alias(f"_s{i}") for i in range(len(means))],
        *[F.count(f"_m{i}").alias(f"_c{i}") for i in range(len(means))],
    )


def added_parts(parts: DataFrame, group: str) -> DataFrame:
    """Parts of several days as those of all of them."""
    keys = [c for c in parts.columns if c.startswith("_b")]
    sums = [c for c in parts.columns if c[:2] in ("_n", "_s", "_c") and c != "_set"]
    return parts.groupBy(group, *keys, "_set").agg(*[F.sum(c).alias(c) for c in sums])


def profile_of(
    parts: DataFrame, group: str, modes: Sequence[str], means: Sequence[str] = (), distincts: Sequence[str] = ()
) -> DataFrame:
    """The profile that parts make up."""
    breakdowns = [*modes, *distincts]
    width = len(breakdowns)
    all_rolled = (1 << width) - 1

    def in_set(i: int) -> Column:
        # bit of the kept breakdown is 0; the first breakdown is the highest bit
        return F.col("_set") == (all_rolled ^ (1 << (width - 1 - i)))

    def pick(name: str) -> Column:
        return F.max(F.when(F.col("_set") == all_rolled, F.col(name)))

    out = [pick("_n").alias("trips")]
    for i, name in enumerate(means):
        out.append((pick(f"_s{i}").cast("double") / pick(f"_c{i}")).alias(name))
    for i, name in enumerate(breakdowns):
        value = F.col(f"_b{i}")
        here = in_set(i) & value.isNotNull()
        if i < len(modes):
            rank = F.when(here, F.struct(-F.col("_n"), value))
            out.append(F.min_by(value, rank).alias(name))
        else:
            out.append(F.count(F.when(here, F.lit(1))).alias(name))
    return parts.groupBy(group).agg(*out)


def group_profile(
    df: DataFrame,
    group: str,
    modes: Mapping[str, Column],
    means: Mapping[str, Column] | None = None,
    distincts: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Per group: `trips`, a mean per entry of `means`, the mode per entry of `modes`, and a
    distinct count per entry of `distincts`.

    Modes ignore NULL and take the lowest value on ties; they keep their type.
    """
    parts = profile_parts(df, group, modes, means, distincts)
    return profile_of(parts, group, list(modes), list(means or ()), list(distincts or ()))
