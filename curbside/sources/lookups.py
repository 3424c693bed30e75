"""Weather-condition codes: code -> label -> bucket."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Condition code, label, bucket.
CONDITIONS = (
    (1, "Clear", "Clear"),
    (2, "Fair", "Clear"),
    (3, "Cloudy", "Cloudy"),
    (4, "Overcast", "Cloudy"),
    (5, "Fog", "Fog"),
    (6, "Freezing Fog", "Fog"),
    (7, "Light Rain", "Rain"),
    (8, "Rain", "Rain"),
    (9, "Heavy Rain", "Rain"),
    (10, "Freezing Rain", "Rain"),
    (11, "Heavy Freezing Rain", "Rain"),
    (12, "Sleet", "Snow"),
    (13, "Heavy Sleet", "Snow"),
    (14, "Light Snowfall", "Snow"),
    (15, "Snowfall", "Snow"),
    (16, "Heavy Snowfall", "Snow"),
    (17, "Rain Shower", "Rain"),
    (18, "Heavy Rain Shower", "Rain"),
    (19, "Sleet Shower", "Snow"),
    (20, "Heavy Sleet Shower", "Snow"),
    (21, "Snow Shower", "Snow"),
    (22, "Heavy Snow Shower", "Snow"),
    (23, "Lightning", "Storm"),
    (24, "Hail", "Storm"),
    (25, "Thunderstorm", "Storm"),
    (26, "Heavy Thunderstorm", "Storm"),
    (27, "Storm", "Storm"),
)


def condition_labels(spark: SparkSession, csv_path: str | None = None) -> DataFrame:
    """(coco, weather_condition), from a CSV file or the built-in table."""
    schema = "coco int, weather_condition string"
    if csv_path:
        return spark.read.schema(schema).option("header", True).csv(csv_path)
    return spark.createDataFrame([(code, label) for code, label, _ in CONDITIONS], schema)


def condition_buckets(spark: SparkSession, csv_path: str | None = None) -> DataFrame:
    """(weather_condition, weather_bucket), from a CSV file or the built-in table."""
    schema = "weather_condition string, weather_bucket string"
    if csv_path:
        return spark.read.schema(schema).option("header", True).csv(csv_path)
    return spark.createDataFrame([(label, bucket) for _, label, bucket in CONDITIONS], schema)


def register_conditions(
    spark: SparkSession, labels_csv: str | None = None, buckets_csv: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Expose both lookups as temporary views for SQL users."""
    labels = condition_labels(spark, labels_csv)
    buckets = condition_buckets(spark, buckets_csv)
    labels.createOrReplaceTempView("condition_labels")
    buckets.createOrReplaceTempView("condition_buckets")
    return labels, buckets


def register_view(df: DataFrame, name: str, cache: bool = False) -> DataFrame:
    """Expose a table as a view. Caching is a choice: a cached view no longer prunes partitions.

    A cached view is released with `release_view`.
    """
    if cache:
        df = df.cache()
    df.createOrReplaceTempView(name)
    return df


def release_view(spark: SparkSession, name: str) -> None:
    """Drop a view and the cached rows behind it."""
    if spark.catalog.isCached(name):
        spark.catalog.uncacheTable(name)
    spark.catalog.dropTempView(name)
