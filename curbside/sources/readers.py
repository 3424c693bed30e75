"""Reading raw files under a contract."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from curbside.functions.names import snake_case, snake_case_columns
from curbside.sources.spec import DatasetSpec


def read_files(
    spark: SparkSession,
    fmt: str,
    paths: str | Sequence[str],
    schema: StructType | str | None = None,
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """Scan CSV (with header) or Parquet, one path or many.

    CSV columns get the types of `schema`, or of `types` by snake-cased name. Only if columns
    remain that neither names are types inferred, which costs a pass over the text.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if fmt == "parquet":
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.parquet(*paths)
    if fmt == "csv":
        reader = spark.read.option("header", True)
        return reader.schema(schema or _csv_schema(spark, paths, types or {})).csv(paths)
    raise ValueError(f"Unsupported format: {fmt}")


def _csv_schema(spark: SparkSession, paths: list[str], types: Mapping[str, str]) -> StructType:
    header = spark.read.option("header", True).csv(paths)  # reads one line
    known = {c: types.get(snake_case(c)) for c in header.columns}
    if not all(known.values()):
        inferred = spark.read.option("header", True).option("inferSchema", True).csv(paths)
        known = {c: known[c] or t for c, t in inferred.dtypes}
    return StructType.fromDDL(", ".join(f"`{c}` {t}" for c, t in known.items()))


def missing_columns(df: DataFrame, required: frozenset[str]) -> list[str]:
    return sorted(required - {c.lower() for c in df.columns})


def require_columns(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    missing = missing_columns(df, spec.required)
    if missing:
        raise ValueError(f"[{spec.name}] missing required columns: {missing}")
    return df


def read_dataset(spark: SparkSession, spec: DatasetSpec, paths: str | Sequence[str]) -> DataFrame:
    """Raw rows with snake-cased names."""
    return snake_case_columns(read_files(spark, spec.format, paths, types=spec.types))


def conform(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Add the time key and apply the dataset's own transform."""
    if spec.add_time_key:
        df = spec.add_time_key(df)
    if spec.transform:
        df = spec.transform(df)
    return df


def with_provenance(df: DataFrame, source: str, schema_version: str = "1.0") -> DataFrame:
    return df.withColumns(
        {
            "data_source": F.lit(source),
            "schema_version": F.lit(schema_version),
            "generated_at": F.current_timestamp(),
        }
    )
