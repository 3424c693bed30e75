"""Materialised data products, their metadata, and selective refresh."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbside.functions.bands import band_of
from curbside.functions.timekeys import minutes_between, weekday_name
from curbside.operators.profile import added_parts, group_profile, profile_of, profile_parts
from curbside.plans.demand import PM25
from curbside.plans.ingest import integrated_table
from curbside.sources.layout import one_of, spread_for, write_partitioned
from curbside.sources.tables import VersionedTable, append_rows, read_if_exists


def _hour() -> Column:
    return F.hour("pickup_time_local")


def _weekday() -> Column:
    return weekday_name(F.col("pickup_time_local"))


def _minutes() -> Column:
    return minutes_between("pickup_time_local", "dropoff_time_local")


@dataclass(frozen=True)
class Product:
    """A profile of trips by group, and how it is published.

    `breakdowns` gives the modes, means and distinct counts; columns are made when they are needed.
    """

    group: str
    breakdowns: Callable[[], dict[str, dict[str, Column]]]
    publish: Callable[[DataFrame], DataFrame]
    prepare: Callable[[DataFrame], DataFrame] = lambda trips: trips

    def __call__(self, trips: DataFrame) -> DataFrame:
        return self.publish(group_profile(self.prepare(trips), self.group, **self.breakdowns()))

    def parts(self, trips: DataFrame) -> DataFrame:
        """What the trips of each day add to the product."""
        return profile_parts(self.prepare(trips), self.group, **self.breakdowns(), by="pickup_date", exact=True)

    def from_parts(self, parts: DataFrame) -> DataFrame:
        names = {kind: list(columns) for kind, columns in self.breakdowns().items()}
        return self.publish(profile_of(added_parts(parts, self.group), self.group, **names))


zone_stats = Product(
    "pickup_zone",
    lambda: {
        "modes": {
            "most_common_dropoff_zone": F.col("dropoff_zone"), "busiest_hour": _hour(), "busiest_week_day": _weekday(),
        },
        "means": {"distance": F.col("trip_distance"), "duration": _minutes(), "fare": F.col("fare_amount")},
        "distincts": {"days": F.col("pickup_date")},
    },
    lambda profile: profile.select(
        "pickup_zone",
        "trips",
        F.round(F.col("trips") / F.col("days"), 2).alias("avg_trip_per_day"),
        F.round("distance", 2).alias("avg_trip_distance"),
        F.round("duration", 2).alias("avg_trip_duration"),
        F.round("fare", 2).alias("avg_fare_amount"),
        "most_common_dropoff_zone",
        "busiest_hour",
        "busiest_week_day",
    ).orderBy(F.desc("trips")),
)

band_impact_summary = Product(
    "air_quality_category",
    lambda: {
        "modes": {"most_common_hour": _hour()},
        "means": {"distance": F.col("trip_distance")},
        "distincts": {"total_hours": F.col("time_utc")},
    },
    lambda profile: profile.select(
        "air_quality_category",
        "trips",
        "total_hours",
        F.round(F.col("trips") / F.col("total_hours"), 2).alias("avg_trips_per_hour"),
        F.round("distance", 2).alias("avg_trip_distance"),
        "most_common_hour",
    ).orderBy(F.desc("avg_trips_per_hour")),
    lambda trips: trips.withColumn("air_quality_category", band_of(F.col(PM25))),
)

borough_summary = Product(
    "pickup_borough",
    lambda: {
        "modes": {
            "most_common_dropoff_borough": F.col("dropoff_borough"),
            "most_common_pickup_zone": F.col("pickup_zone"),
            "most_common_dropoff_zone": F.col("dropoff_zone"),
            "most_common_hour": _hour(),
            "busiest_week_day": _weekday(),
        },
        "means": {"passengers": F.col("passenger_count")},
    },
    lambda profile: profile.select(
        "pickup_borough",
        "trips",
        "most_common_dropoff_borough",
        # the published column name, though it holds a zone
        F.col("most_common_pickup_zone").alias("most_common_pickup_borough"),
        "most_common_dropoff_zone",
        "most_common_hour",
        F.round("passengers", 2).alias("avg_passenger_count_per_trip"),
        "busiest_week_day",
    ).orderBy(F.desc("trips")),
)

weekday_summary = Product(
    "week_day",
    lambda: {
        "modes": {"busiest_hour": _hour(), "most_common_pickup_zone": F.col("pickup_zone")},
        "means": {"fare": F.col("fare_amount"), "duration": _minutes()},
    },
    lambda profile: profile.select(
        "week_day",
        "trips",
        "busiest_hour",
        "most_common_pickup_zone",
        F.round("fare", 2).alias("avg_fare_amount"),
        F.round("duration", 2).alias("avg_trip_duration"),
    ).orderBy(F.desc("trips")),
    lambda trips: trips.withColumn("week_day", _weekday()),
)

PRODUCTS: Mapping[str, Product] = {
    "taxi_zone_stats": zone_stats,
    "air_quality_impact_summary": band_impact_summary,
    "borough_mobility_summary": borough_summary,
    "weekday_mobility_summary": weekday_summary,
}

# The base datasets each product depends on.
DEPENDENCIES = {
    "taxi_zone_stats": ("taxi_trips",),
    "air_quality_impact_summary": ("taxi_trips", "air_quality"),
    "borough_mobility_summary": ("taxi_trips",),
    "weekday_mobility_summary": ("taxi_trips",),
}

METADATA_TABLE = "data_products_metadata"


def upsert_metadata(existing: DataFrame, refreshed: DataFrame) -> DataFrame:
    """Metadata after a refresh: `created_at` survives, `refresh_at` becomes the new time.

    `refreshed` has table_name, data_source, schema_version, refresh_at; products it does not
    name are kept as they are. Both sides hold one row per product.
    """
    old = existing.select("table_name", F.col("created_at").alias("_created"))
    renewed = refreshed.join(old, "table_name", "left").select(
        "table_name",
        "data_source",
        "schema_version",
        F.coalesce("_created", "refresh_at").alias("created_at"),
        "refresh_at",
    )
    untouched = existing.join(refreshed.select("table_name"), "table_name", "left_anti")
    return renewed.unionByName(untouched)


def refresh_plan(dependencies: DataFrame, changes: DataFrame, metadata: DataFrame) -> DataFrame:
    """Which products are stale.

    dependencies: (table_name, dataset); changes: (dataset, inserted, executed_at) of the last
    run; metadata: (table_name, refresh_at). A product is refreshed if a dataset it depends on
    changed and it was never built or built before the newest change of the run.
    """
    changed = changes.where("inserted > 0").select("dataset", "executed_at").distinct()
    newest = changed.agg(F.max("executed_at").alias("latest_source_time"))  # one row
    touched = (
        dependencies.join(changed.select("dataset").distinct().withColumn("_hit", F.lit(1)), "dataset", "left")
        .groupBy("table_name")
        .agg(F.count("_hit").alias("changed_dependencies"))
    )
    return (
        touched.withColumn("latest_source_time", newest.scalar())
        .join(metadata.select("table_name", "refresh_at"), "table_name", "left")
        .select(
            "table_name",
            "changed_dependencies",
            "refresh_at",
            "latest_source_time",
            F.coalesce(
                (F.col("changed_dependencies") > 0)
                & (F.col("refresh_at").isNull() | (F.col("latest_source_time") > F.col("refresh_at"))),
                F.lit(False),
            ).alias("needs_refresh"),
        )
    )


def dependency_table(spark: SparkSession) -> DataFrame:
    rows = [(name, dataset) for name, datasets in DEPENDENCIES.items() for dataset in datasets]
    return spark.createDataFrame(rows, "table_name string, dataset string")


# Which version of the integrated table a product's parts follow.
PART_STATE = "table_name string, version int, noted_at timestamp"


def _parts_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/_parts/{name}"


def _parts_version(spark: SparkSession, root: str, name: str) -> int | None:
    state = read_if_exists(spark, f"{root.rstrip('/')}/_parts_state", PART_STATE).where(F.col("table_name") == name)
    return state.agg(F.max_by("version", "noted_at")).first()[0]


def _changed_days(spark: SparkSession, root: str, name: str, version: int) -> list | None:
    """Days of the integrated table that a product's parts lack or have as they were; None: all."""
    noted = _parts_version(spark, root, name)
    if noted is None or noted > version:
        return None
    return integrated_table(spark, root).replaced_since(noted)


def _renew_parts(spark: SparkSession, root: str, name: str, trips: DataFrame, days: list | None) -> DataFrame:
    """The parts of a product by day; those of `days` are written anew from their trips, of all days for None.

    Parts are plain Parquet folders of days, overwritten one by one: repeating it after a failure does no harm.
    """
    path, product = _parts_path(root, name), PRODUCTS[name]
    if days is None:
        write_partitioned(product.parts(trips), path, ["pickup_date"])
    elif days:
        some = trips.where(one_of("pickup_date", days))
        fresh = spread_for(product.parts(some), ["pickup_date"]).write.mode("overwrite").partitionBy("pickup_date")
        fresh.option("partitionOverwriteMode", "dynamic").parquet(path)
    return spark.read.schema(product.parts(trips).schema).parquet(path)


def build_products(
    spark: SparkSession,
    root: str,
    trips: DataFrame | None = None,
    names: Iterable[str] = tuple(PRODUCTS),
    source: str = "integrated_taxi_trips",
    schema_version: str = "1.0",
    changed_only: bool = False,
) -> list[str]:
    """Write the named products as new table versions and renew their metadata.

    A product is added up from parts, one set per day. Without `trips` they are those of the integrated table, and with
    `changed_only` its trips are read only for the days that changed since the product was built.
    """
    names = list(names)
    if not names:
        return names
    version = None
    if trips is None:
        table = integrated_table(spark, root)
        commit = table.require()
        trips, version = table.rows_of(commit), commit.version
    for name in names:
        days = _changed_days(spark, root, name, version) if changed_only and version is not None else None
        parts = _renew_parts(spark, root, name, trips, days)
        VersionedTable(spark, root, name).overwrite(PRODUCTS[name].from_parts(parts))
    now = datetime.now(timezone.utc)
    noted = [(name, version, now) for name in names]  # no version: the parts are of other trips and serve nobody else
    append_rows(spark, f"{root.rstrip('/')}/_parts_state", noted, PART_STATE)
    rows = [(name, source, schema_version) for name in names]
    refreshed = spark.createDataFrame(rows, "table_name string, data_source string, schema_version string")
    refreshed = refreshed.withColumn("refresh_at", F.current_timestamp())
    metadata = VersionedTable(spark, root, METADATA_TABLE)
    metadata.overwrite(upsert_metadata(read_metadata(spark, root), refreshed))
    return names


def read_metadata(spark: SparkSession, root: str) -> DataFrame:
    table = VersionedTable(spark, root, METADATA_TABLE)
    if table.exists():
        return table.read()
    return spark.createDataFrame(
        [],
        "table_name string, data_source string, schema_version string, created_at timestamp, refresh_at timestamp",
    )


def refresh_products(
    spark: SparkSession, root: str, trips: DataFrame | None = None, changes: DataFrame | None = None
) -> list[str]:
    """Renew the stale products only; returns their names (at most one per product).

    `changes` has (dataset, inserted, executed_at) of the last run. Without `trips` the integrated table is meant, and of
    it only the days that changed are read. A frame of the caller's is read whole.
    """
    if changes is None:
        raise ValueError("changes of a run are needed")
    plan = refresh_plan(dependency_table(spark), changes, read_metadata(spark, root))
    stale = {row.table_name for row in plan.where("needs_refresh").select("table_name").collect()}
    names = [name for name in PRODUCTS if name in stale]
    return build_products(spark, root, trips, names, changed_only=True)
