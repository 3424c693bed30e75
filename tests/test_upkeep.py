"""Upkeep of the integrated table and the products: after failures, with late rows, by day."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from curbside.plans import incremental, ingest, products
from curbside.plans.experiments import plan_text
from curbside.plans.incremental import apply_update, run_updates
from curbside.plans.ingest import SOURCES, integrate_tables, integrated_table
from curbside.sources.spec import MOBILITY, TAXI_TRIPS
from curbside.sources.tables import VersionedTable
from tests.conftest import AIR_HEADER, TRIP_SCHEMA, WEATHER_HEADER, at, rows, trip, write_csv


class Lost(RuntimeError):
    """Stands for the loss of the driver."""


def whole(spark, root):
    """The integrated table as a build from the cleaned tables gives it."""
    return ingest.integrate(*[VersionedTable(spark, root, name).read() for name in SOURCES])


def same_as_whole(spark, root) -> bool:
    stored = integrated_table(spark, root).read()
    built = whole(spark, root)
    assert set(stored.columns) == set(built.columns)
    return rows(stored.select(*built.columns)) == rows(built)


def written(root) -> dict[str, float]:
    files = glob.glob(f"{root}/integrated_taxi_trips/**/*.parquet", recursive=True)
    return {f: os.stat(f).st_mtime_ns for f in files}


def new_trips(spark):
    return spark.createDataFrame([trip("2024-04-01 08:00", pu=2), trip("2024-01-05 17:00", pu=4, fare=21.0)], TRIP_SCHEMA)


@pytest.mark.parametrize("run_ids", [("epoch-1", "epoch-1"), ("epoch-1", "epoch-2")])
@pytest.mark.parametrize("where", ["integrate_pending", "after integration"])
def test_a_run_lost_after_its_merge_is_made_up_for(spark, platform, monkeypatch, run_ids, where):
    def lost(*_):
        raise Lost

    with monkeypatch.context() as patch:
        if where == "integrate_pending":
            patch.setattr(incremental, "integrate_pending", lost)
        else:
            patch.setattr(ingest, "_note_integration", lost)
        with pytest.raises(Lost):
            apply_update(spark, platform, TAXI_TRIPS, new_trips(spark), run_ids[0])
    assert VersionedTable(spark, platform, "taxi_trips").read().count() == 8
    again = apply_update(spark, platform, TAXI_TRIPS, new_trips(spark), run_ids[1])
    assert again["inserted"] == 0 and integrated_table(spark, platform).read().count() == 8
    assert same_as_whole(spark, platform)
    before = integrated_table(spark, platform).latest_version()
    apply_update(spark, platform, TAXI_TRIPS, new_trips(spark), "epoch-3")
    assert integrated_table(spark, platform).latest_version() == before  # nothing was pending


def test_a_lost_run_is_made_up_for_by_another_dataset(spark, platform, monkeypatch, tmp_path):
    def lost(*_):
        raise Lost

    with monkeypatch.context() as patch:
        patch.setattr(incremental, "integrate_pending", lost)
        with pytest.raises(Lost):
            run_updates(spark, platform, {"taxi_trips": new_trips(spark)})
    path = write_csv(tmp_path / "w.csv", WEATHER_HEADER, [(2024, 4, 1, 12, 9.5, 50, 0.0, 0, 200, 7.0, 9, 1000.0, 8, 1)])
    run_updates(spark, platform, {"weather": path})
    found = {r.pickup_time_local: r.pickup_weather_temperature for r in integrated_table(spark, platform).read().collect()}
    assert len(found) == 8 and found[at("2024-04-01 08:00")] == 9.5 and same_as_whole(spark, platform)


def test_late_zones_reach_trips_that_are_there(spark, raw_paths, root):
    ingest.ingest_all(spark, root, raw_paths)
    zones = VersionedTable(spark, root, "taxi_zone")
    every = zones.read()
    late = every.where("location_id % 2 = 0")
    rest = spark.createDataFrame(every.where("location_id % 2 = 1").collect(), every.schema)
    late = spark.createDataFrame(late.collect(), every.schema)
    zones.overwrite(rest)
    integrate_tables(spark, root)
    table = integrated_table(spark, root)
    assert table.read().where("pickup_zone IS NULL OR dropoff_zone IS NULL").count() > 0
    run_updates(spark, root, {"taxi_zone": late})
    assert table.read().where("pickup_zone IS NULL OR dropoff_zone IS NULL").count() == 0
    assert same_as_whole(spark, root)


def test_only_touched_days_are_written(spark, platform, tmp_path):
    files = written(platform)
    path = write_csv(tmp_path / "a.csv", AIR_HEADER, [("36", "061", 71, 1, "2024-01-05", "10:00", "2024-01-05", "15:00", 28.0)])
    run_updates(spark, platform, {"taxi_trips": new_trips(spark), "air_quality": path})
    after = written(platform)
    assert {f: after[f] for f in files} == files
    days = {part for f in set(after) - set(files) for part in f.split(os.sep) if part.startswith("pickup_date=")}
    assert days == {"pickup_date=2024-04-01", "pickup_date=2024-01-05"}
    table = integrated_table(spark, platform)
    commit = table.require()
    assert (commit.op, sorted(commit.replaced), commit.n_rows) == ("replace", ["2024-01-05", "2024-04-01"], 8)
    assert same_as_whole(spark, platform) and table.read(0).count() == 6
    assert table.replaced_since(0) == ["2024-01-05", "2024-04-01"] and table.replaced_since(commit.version) == []


def test_replaced_days_are_pruned_as_partitions(spark, platform):
    run_updates(spark, platform, {"taxi_trips": new_trips(spark)})
    plan = plan_text(integrated_table(spark, platform).read())
    assert any("PartitionFilters" in line and "_batch" in line for line in plan.splitlines())
    read = integrated_table(spark, platform).read().select(F.input_file_name().alias("f")).distinct().collect()
    assert not any("_batch=0/pickup_date=2024-01-05" in r.f for r in read)


def test_trips_without_a_time_are_kept_up(spark, platform):
    """Without validation a trip may lack its pickup time; its day is null, and is replaced like others."""
    lacking = spark.createDataFrame([trip("2024-04-01 08:00")], TRIP_SCHEMA).withColumn(
        "tpep_pickup_datetime", F.lit(None).cast("timestamp_ntz")
    )
    options = incremental.UpdateOptions(validate=False, monitor=False)
    for fare in (1.0, 2.0):
        apply_update(spark, platform, TAXI_TRIPS, lacking.withColumn("fare_amount", F.lit(fare)), options=options)
    assert integrated_table(spark, platform).read().where("pickup_date IS NULL").count() == 2
    assert same_as_whole(spark, platform)


def test_a_restored_table_is_integrated_anew(spark, platform):
    run_updates(spark, platform, {"taxi_trips": new_trips(spark)})
    VersionedTable(spark, platform, "taxi_trips").restore(0)
    more = spark.createDataFrame([trip("2024-05-01 08:00", pu=2)], TRIP_SCHEMA)
    run_updates(spark, platform, {"taxi_trips": more})
    assert integrated_table(spark, platform).read().count() == 7 and same_as_whole(spark, platform)


def test_products_read_only_changed_days(spark, platform, monkeypatch):
    products.build_products(spark, platform)
    report = run_updates(spark, platform, {"taxi_trips": new_trips(spark)})
    seen = []
    real = products._renew_parts

    def renew(spark_, root, name, trips, days):
        seen.append(days)
        plan = plan_text(products.PRODUCTS[name].parts(trips.where(F.col("pickup_date").isin(days))))
        assert any("PartitionFilters" in line and "pickup_date" in line for line in plan.splitlines())
        return real(spark_, root, name, trips, days)

    monkeypatch.setattr(products, "_renew_parts", renew)
    changes = report.select("dataset", "inserted", "executed_at")
    assert set(products.refresh_products(spark, platform, changes=changes)) == set(products.PRODUCTS)
    assert seen == [["2024-01-05", "2024-04-01"]] * 4
    trips = integrated_table(spark, platform).read()
    for name, product in products.PRODUCTS.items():
        assert rows(VersionedTable(spark, platform, name).read()) == rows(product(trips)), name
    with pytest.raises(ValueError):
        products.refresh_products(spark, platform)


def test_parts_of_other_days_keep_their_files(spark, platform):
    products.build_products(spark, platform)
    parts = lambda: {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{platform}/_parts/taxi_zone_stats/*/*.parquet")}
    before = parts()
    report = run_updates(spark, platform, {"taxi_trips": new_trips(spark)})
    products.refresh_products(spark, platform, changes=report.select("dataset", "inserted", "executed_at"))
    after = parts()
    kept = {f for f in before if "2024-01-05" not in f}
    assert kept and all(after[f] == before[f] for f in kept)
    assert not any(f in after for f in set(before) - kept)


def test_mobility_sources_are_the_datasets():
    assert set(SOURCES) == set(MOBILITY)
