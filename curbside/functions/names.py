"""Column naming."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

_WORD_END = re.compile(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])")


def snake_case(name: str) -> str:
    """`PULocationID` -> `pu_location_id`, `Date GMT` -> `date_gmt`."""
    return re.sub(r"\s+", "_", _WORD_END.sub("_", name)).lower()


def snake_case_columns(df: DataFrame) -> DataFrame:
    """Rename all columns in one projection."""
    return df.toDF(*[snake_case(c) for c in df.columns])
