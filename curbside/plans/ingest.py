"""From raw files to cleaned tables to the integrated trips table."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from curbside.operators.clean import clean
from curbside.operators.joins import (
    REGION_CODES,
    attach_air,
    attach_hourly,
    attach_zones,
    county_hour_means,
    hourly_weather,
    map_region_codes,
)
from curbside.operators.merge import within_key_range
from curbside.session import settle
from curbside.sources.layout import with_pickup_date
from curbside.sources.lookups import register_view
from curbside.sources.readers import conform, read_dataset, require_columns
from curbside.sources.spec import MOBILITY, DatasetSpec
from curbside.sources.tables import VersionedTable, append_rows, read_if_exists

INTEGRATED = "integrated_taxi_trips"
INGESTION_LOG = (
    "dataset string, rows_in bigint, rows_kept bigint, rows_rejected bigint, execution_time_s double, "
    "schema_version string, executed_at timestamp"
)


def cleaned(spark: SparkSession, spec: DatasetSpec, paths: str | Sequence[str]) -> DataFrame:
    """Raw files of one dataset as a cleaned frame, nothing written."""
    return _cleaned(read_dataset(spark, spec, paths), spec)


def _cleaned(raw: DataFrame, spec: DatasetSpec) -> DataFrame:
    return clean(conform(require_columns(raw, spec), spec), spec.keys, spec.ranges)


def ingest(spark: SparkSession, root: str, spec: DatasetSpec, paths: str | Sequence[str]) -> tuple:
    """Write one cleaned table; returns its ingestion-log row."""
    started = time.time()
    table = VersionedTable(spark, root, spec.name)
    raw = read_dataset(spark, spec, paths)
    rows_kept = table.overwrite(_cleaned(raw, spec)).added_rows
    # counted by itself, which for Parquet reads footers only: a count observed during the write would count the rows of
    # a repeated task twice
    rows_in = raw.count()
    return (
        spec.name,
        rows_in,
        rows_kept,
        rows_in - rows_kept,
        round(time.time() - started, 2),
        spec.schema_version,
        datetime.now(timezone.utc),
    )


def ingest_all(
    spark: SparkSession,
    root: str,
    paths: Mapping[str, str | Sequence[str]],
    specs: Mapping[str, DatasetSpec] = MOBILITY,
) -> None:
    log = [ingest(spark, root, specs[name], where) for name, where in paths.items()]
    append_rows(spark, f"{root}/_ingestion_metadata", log, INGESTION_LOG)


def integrate(trips: DataFrame, zones: DataFrame, weather: DataFrame, air: DataFrame) -> DataFrame:
    """Trips with zones at both ends, region codes, hourly weather and county air quality."""
    out = attach_zones(trips, zones)
    out = map_region_codes(out)
    out = attach_hourly(out, hourly_weather(weather))
    out = attach_air(out, county_hour_means(air, REGION_CODES))
    return with_pickup_date(out)


def integrated_table(spark: SparkSession, root: str) -> VersionedTable:
    return VersionedTable(spark, root, INTEGRATED, partition_by=["pickup_date"])


def register_tables(spark: SparkSession, root: str, cache: bool = False) -> list[str]:
    """Every table that exists as a view of its name, for SQL users; caching is their choice."""
    tables = [VersionedTable(spark, root, name) for name in (*MOBILITY, INTEGRATED)]
    found = [table for table in tables if table.exists()]
    for table in found:
        register_view(table.read(), table.name, cache)
    return [table.name for table in found]


# What the integrated table has taken in: the batches of each dataset, as of a number that grows.
INTEGRATION_STATE = "number bigint, dataset string, batches array<int>, integrated_at timestamp"
SOURCES = ("taxi_trips", "taxi_zone", "weather", "air_quality")


def _state_path(root: str) -> str:
    return f"{root.rstrip('/')}/_integration_state"


def _taken_in(spark: SparkSession, root: str) -> tuple[int, dict[str, list[int]]]:
    """Number of the last integration, and the batches of each dataset it had taken in; none before the first."""
    state = read_if_exists(spark, _state_path(root), INTEGRATION_STATE)
    last = state.agg(F.max("number")).first()[0]
    if last is None:
        return -1, {}
    return last, {r.dataset: list(r.batches) for r in state.where(F.col("number") == last).collect()}  # a row a dataset


def _note_integration(spark: SparkSession, root: str, number: int, commits: Mapping[str, Row]) -> None:
    """Written after the integrated table: a run that dies in between is taken for one that integrated nothing."""
    now = datetime.now(timezone.utc)
    rows = [(number, name, list(commit.batches), now) for name, commit in commits.items()]
    append_rows(spark, _state_path(root), rows, INTEGRATION_STATE)


def _commits(spark: SparkSession, root: str) -> dict[str, Row]:
    return {name: VersionedTable(spark, root, name).require() for name in SOURCES}


def integrate_tables(spark: SparkSession, root: str) -> Row:
    """Build the integrated table from the cleaned tables."""
    number, commits = _taken_in(spark, root)[0] + 1, _commits(spark, root)
    frame = integrate(*[VersionedTable(spark, root, name).rows_of(commits[name]) for name in SOURCES])
    done = integrated_table(spark, root).overwrite(frame)
    _note_integration(spark, root, number, commits)
    return done


def touched_days(trips: DataFrame, new: Mapping[str, DataFrame]) -> DataFrame:
    """(pickup_date): the days of trips that new rows of the datasets bear on.

    Those of new trips; those of trips in an hour of new weather or air rows; those of trips that begin or end in a new
    zone. `trips` are all trips of the table, the new ones included.
    """
    dated = with_pickup_date(trips)
    days = [with_pickup_date(new["taxi_trips"]).select("pickup_date")] if "taxi_trips" in new else []
    observed = [new[n].select("time_utc") for n in ("weather", "air_quality") if n in new]
    if observed:
        hours = settle(reduce(DataFrame.union, observed).distinct(), "hours")
        inside = within_key_range(dated, hours, ["time_utc"])  # only these hours' row groups are read
        days.append(inside.join(hours, "time_utc", "left_semi").select("pickup_date"))
    if "taxi_zone" in new:
        ends = dated.select("pickup_date", F.explode(F.array("pu_location_id", "do_location_id")).alias("location_id"))
        zones = new["taxi_zone"].select("location_id").distinct()
        days.append(ends.join(zones, "location_id", "left_semi").select("pickup_date"))
    return reduce(DataFrame.union, days).distinct()


def integrate_pending(spark: SparkSession, root: str) -> Row | None:
    """Bring the integrated table up to date with all that was merged since it was written, by whatever run.

    What is pending follows from the tables: batches that the integrated table has not noted. So a run that died after
    its merge leaves nothing behind but work for the next one. The days that new rows bear on are integrated anew from
    the cleaned tables and replaced as a whole, so doing it twice does no harm; folders of other days are not touched.
    A table that lost batches (an overwrite, a restore) has the whole integrated table built anew.
    """
    number, taken = _taken_in(spark, root)
    commits = _commits(spark, root)
    if any(set(taken.get(name, [-1])) - set(commit.batches) for name, commit in commits.items()):
        return integrate_tables(spark, root)
    tables = {name: VersionedTable(spark, root, name) for name in SOURCES}
    fresh = {name: [b for b in commit.batches if b not in taken[name]] for name, commit in commits.items()}
    new = {name: tables[name].rows_of(commits[name], batches) for name, batches in fresh.items() if batches}
    if not new:
        return None
    frames = {name: tables[name].rows_of(commits[name]) for name in SOURCES}
    days = [r.pickup_date for r in touched_days(frames["taxi_trips"], new).toLocalIterator()]  # a value a day
    done = None
    if days:
        trips = _of_days(frames["taxi_trips"], days)
        again = integrate(trips, *[frames[name] for name in SOURCES[1:]])
        done = integrated_table(spark, root).replace(again, days)
    _note_integration(spark, root, number + 1, commits)
    return done


def _of_days(trips: DataFrame, days: Sequence[str | None]) -> DataFrame:
    """The trips of some local days; the range of days reaches the scan."""
    known = sorted(day for day in days if day is not None)
    start = F.col("pickup_time_local")
    test = F.lit(False)
    if known:
        until = F.lit(known[-1]).cast("date") + F.expr("INTERVAL 1 DAY")
        kind = trips.schema["pickup_time_local"].dataType
        test = (start >= F.lit(known[0]).cast(kind)) & (start < until.cast(kind))
        test = test & F.date_format(start, "yyyy-MM-dd").isin(known)
    return trips.where(test | start.isNull() if None in days else test)


def build_from_raw(spark: SparkSession, paths: Mapping[str, str | Sequence[str]]) -> DataFrame:
    """The integrated frame straight from raw files, without any table."""
    frames = [cleaned(spark, MOBILITY[n], paths[n]) for n in ("taxi_trips", "taxi_zone", "weather", "air_quality")]
    return integrate(*frames)
