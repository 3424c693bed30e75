"""Write synthetic update files for all datasets, with a manifest table."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbside.functions.timekeys import parts_time_key, text_time_key
from curbside.operators.generate import air_update, trip_update, weather_update
from curbside.sources.tables import append_rows

MANIFEST = (
    "dataset string, format string, output_path string, original_row_count bigint, original_from timestamp_ntz, "
    "original_to timestamp_ntz, new_records bigint, duplicate_records bigint, schema_changes array<string>, "
    "generated_at timestamp"
)
TRIP_ROW_KEYS = (
    "vendor_id",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "pu_location_id",
    "do_location_id",
    "fare_amount",
)

# format, generator and time of a row, per dataset
GENERATORS: Mapping[str, tuple[str, Callable[[DataFrame], DataFrame], Callable[[DataFrame], DataFrame]]] = {
    "taxi_trips": (
        "parquet",
        lambda raw: trip_update(raw, TRIP_ROW_KEYS),
        lambda df: df.withColumn("_at", F.col("tpep_pickup_datetime")),
    ),
    "weather": ("csv", weather_update, lambda df: parts_time_key(df).withColumnRenamed("time_utc", "_at")),
    "air_quality": ("csv", air_update, lambda df: text_time_key(df).withColumnRenamed("time_utc", "_at")),
}


def export(df: DataFrame, path: str, fmt: str) -> None:
    """Write an update as a folder of files, as many as there are tasks."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)


def generate_updates(spark: SparkSession, folder: str, raw: Mapping[str, DataFrame]) -> dict[str, str]:
    """One update per raw dataset (snake-cased frames); returns the written paths."""
    rows, paths = [], {}
    for name, source in raw.items():
        fmt, make, timed = GENERATORS[name]
        update = make(source)
        paths[name] = f"{folder}/{name}_update"
        export(update, paths[name], fmt)
        before = timed(source).agg(F.count("*").alias("n"), F.min("_at").alias("lo"), F.max("_at").alias("hi")).first()
        reader = spark.read.schema(update.schema)
        written = reader.parquet(paths[name]) if fmt == "parquet" else reader.option("header", True).csv(paths[name])
        # only trip updates repeat rows; those are the ones that do not lie after the history
        is_new = F.col("_at") > F.lit(str(before.hi)).cast("timestamp_ntz") if name == "taxi_trips" else F.lit(True)
        after = timed(written).agg(F.count("*").alias("n"), F.count_if(is_new).alias("new")).first()
        added = [c for c in update.columns if c not in source.columns]
        rows.append(
            (name, fmt, paths[name], before.n, before.lo, before.hi, after.new, after.n - after.new, added,
             datetime.now(timezone.utc))
        )
    append_rows(spark, f"{folder}/_manifest", rows, MANIFEST)
    return paths
