from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from curbside.plans import demand, monitoring, products
from curbside.plans.experiments import plan_text
from curbside.plans.incremental import RUN_REPORT, UpdateOptions, apply_update, run_updates
from curbside.plans.ingest import build_from_raw, integrated_table, register_tables
from curbside.plans.updates import MANIFEST, generate_updates
from curbside.sources.lookups import condition_buckets, condition_labels, register_conditions
from curbside.sources.readers import read_dataset, read_files, require_columns
from curbside.sources.spec import MOBILITY, TAXI_TRIPS, TAXI_ZONE
from curbside.sources.tables import VersionedTable
from curbside.streaming.updates import stream_updates
from tests.conftest import AIR_HEADER, TRIP_SCHEMA, WEATHER_HEADER, at, rows, trip, write_csv


def test_readers(spark, raw_paths, tmp_path):
    with pytest.raises(ValueError):
        read_files(spark, "orc", raw_paths["taxi_trips"])
    with pytest.raises(ValueError):
        require_columns(read_dataset(spark, TAXI_ZONE, raw_paths["taxi_zone"]).drop("zone"), TAXI_ZONE)
    air = read_dataset(spark, MOBILITY["air_quality"], raw_paths["air_quality"])
    assert dict(air.dtypes)["time_gmt"] == "string"
    assert dict(air.dtypes)["state_code"] == "int" and dict(air.dtypes)["date_gmt"] == "date"
    extra = write_csv(tmp_path / "extra.csv", ["temp", "Some Note", "n"], [(1, "x", 5)])
    assert dict(read_files(spark, "csv", extra, types={"temp": "double"}).dtypes) == {
        "temp": "double", "Some Note": "string", "n": "int"
    }
    twice = read_files(spark, "parquet", [raw_paths["taxi_trips"], raw_paths["taxi_trips"]])
    assert twice.count() == 26


def test_ingestion_counts_and_tables(spark, platform):
    log = {r.dataset: (r.rows_in, r.rows_kept, r.rows_rejected)
           for r in spark.read.parquet(f"{platform}/_ingestion_metadata").collect()}
    assert log == {
        "taxi_zone": (9, 9, 0),
        "weather": (7, 5, 2),
        "air_quality": (6, 4, 2),
        "taxi_trips": (13, 6, 7),
    }


def test_integrated_rows(spark, platform, raw_paths):
    out = integrated_table(spark, platform).read()
    by_time = {r.pickup_time_local: r for r in out.collect()}
    first = by_time[at("2024-01-05 10:15")]
    assert (first.pickup_borough, first.dropoff_zone, first.state_code, first.county_code) == (
        "Manhattan", "Corona", "36", "061"
    )
    assert first.pickup_air_quality_pm25 == 10.0 and first.pickup_weather_temperature == 3.5
    night = by_time[at("2024-01-05 23:30")]
    assert night.pickup_date == "2024-01-05" and night.time_utc == at("2024-01-06 04:00")
    assert night.pickup_air_quality_pm25 == 40.0 and night.pickup_weather_condition_code == 7
    assert by_time[at("2024-03-10 02:30")].time_utc == at("2024-03-10 07:00")
    raw = build_from_raw(spark, raw_paths)
    assert rows(raw.select(*sorted(out.columns))) == rows(out.select(*sorted(out.columns)))


def test_views_for_sql_users(spark, platform):
    assert set(register_tables(spark, platform)) == {*MOBILITY, "integrated_taxi_trips"}
    register_conditions(spark)
    answer = spark.sql(
        """SELECT weather_bucket, count(*) AS trips FROM integrated_taxi_trips
           LEFT JOIN condition_labels ON pickup_weather_condition_code = coco
           LEFT JOIN condition_buckets USING (weather_condition) GROUP BY 1"""
    )
    assert rows(answer) == [(None, 3), ("Cloudy", 1), ("Rain", 2)]


def test_six_questions(spark, platform):
    trips = integrated_table(spark, platform).read()
    labels, buckets = register_conditions(spark)
    assert labels.count() == 27 and buckets.count() == 27
    assert demand.monthly_zone_demand(trips).agg(F.sum("num_trips")).first()[0] == 6
    by_bucket = {r.weather: (r.miles, r.trips) for r in demand.distance_by_bucket(trips, labels, buckets).collect()}
    assert by_bucket == {"Cloudy": (2.0, 1), "Rain": (3.0, 2), None: (3.83, 3)}
    hinted = demand.distance_by_bucket(trips, labels, buckets, hint=True)
    assert rows(hinted) == rows(demand.distance_by_bucket(trips, labels, buckets))
    assert {r.weather for r in demand.distance_by_label(trips, labels).collect()} >= {"Unknown", "Light Rain"}
    bands = {r.air_quality_category: r.trips for r in demand.demand_by_band(trips).collect()}
    assert bands == {"Moderate": 1, "Unhealthy for Sensitive": 1, "Hazardous": 1, "Unknown": 3}
    spread = {r.pickup_zone: r.stddev_trips for r in demand.zone_variation(trips, labels, buckets).collect()}
    assert spread["Red Hook"] is None  # a single condition has no spread
    top = demand.top_hours_per_weekday(trips)
    assert top.count() == 6 and top.where("dow = 'Friday'").count() == 4  # four hours tie for the first place
    trends = demand.monthly_trends(trips).collect()
    assert [(t.pickup_month, t.total_trips, t.airport_trips) for t in trends] == [
        ("2024-01", 3, 1), ("2024-02", 1, 0), ("2024-03", 2, 0)
    ]
    assert trends[0].airport_trip_percentage == 33.33 and trends[0].total_revenue == 45.5
    assert rows(demand.monthly_trends(trips, prune=False)) == rows(demand.monthly_trends(trips))


def test_questions_read_only_what_they_need(spark, platform):
    trips = integrated_table(spark, platform).read()
    demand_plan = plan_text(demand.monthly_zone_demand(trips))
    assert "ReadSchema: struct<pickup_zone:string>" in demand_plan
    trends = plan_text(demand.monthly_trends(trips)).splitlines()
    assert any("PartitionFilters" in line and "pickup_date" in line for line in trends)
    assert "fare_amount" not in next(line for line in trends if line.startswith("ReadSchema"))


def test_integration_joins_are_hashed(spark, raw_paths):
    frame = build_from_raw(spark, raw_paths)
    plan = plan_text(frame)
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert plan.split("\n\n")[0].count("BroadcastHashJoin") >= 4


def test_products_metadata_and_refresh(spark, platform):
    trips = integrated_table(spark, platform).read()
    products.build_products(spark, platform, trips)
    before = {r.table_name: r for r in products.read_metadata(spark, platform).collect()}
    assert set(before) == set(products.PRODUCTS)
    zone = {r.pickup_zone: r for r in VersionedTable(spark, platform, "taxi_zone_stats").read().collect()}
    assert zone["Corona"].trips == 3 and zone["Corona"].avg_fare_amount == 16.17  # two zones of one name

    def changes(*items):
        frame = spark.createDataFrame(list(items), "dataset string, inserted bigint")
        return frame.withColumn("executed_at", F.current_timestamp())

    assert products.refresh_products(spark, platform, trips, changes()) == []
    assert products.refresh_products(spark, platform, trips, changes(("weather", 5), ("taxi_trips", 0))) == []
    refreshed = products.refresh_products(spark, platform, trips, changes(("air_quality", 1)))
    assert refreshed == ["air_quality_impact_summary"]
    after = {r.table_name: r for r in products.read_metadata(spark, platform).collect()}
    changed = after["air_quality_impact_summary"]
    assert changed.created_at == before["air_quality_impact_summary"].created_at < changed.refresh_at
    assert after["taxi_zone_stats"] == before["taxi_zone_stats"]
    old = changes(("taxi_trips", 3)).withColumn("executed_at", F.lit("2020-01-01").cast("timestamp"))
    assert products.refresh_products(spark, platform, trips, old) == []


def update_rows():
    return [
        trip("2024-01-05 10:15"),  # already in the table
        trip("2024-04-01 08:00", pu=2, fare=11.0),
        trip("2024-04-01 08:00", pu=2, fare=11.0),  # copy within the file
        trip("2024-04-02 09:00", pu=999, fare=12.0),  # no such zone
        trip("2024-04-03 10:00", minutes=-5, fare=13.0),  # ends before it starts
        trip("2024-04-04 11:00", rate=7, fare=14.0),
        trip("2024-04-05 12:00", rate=99, fare=15.0),
        trip("2024-04-06 13:00", vendor=None),  # NULL key
        trip("2024-04-07 14:00", fare=-1.0),
        trip("2024-04-08 15:00", pu=264),  # filtered before the rules
    ]


def test_incremental_update(spark, platform):
    batch = spark.createDataFrame(update_rows(), TRIP_SCHEMA).withColumn("Tip Note", F.lit("x"))
    report = run_updates(spark, platform, {"taxi_trips": batch}).first()
    assert (report.update_rows_considered, report.inserted, report.duplicates_ignored_vs_target) == (3, 2, 1)
    assert (report.rejected_invalid_records, report.intra_file_duplicate_records, report.quarantined_records) == (5, 1, 6)
    assert (report.processed_records, report.validation_failures) == (9, 6)
    assert report.schema_evolved_on_target == ["tip_note"] and report.schema_version == "1.1"
    assert (report.rows_before, report.rows_after) == (6, 8)
    rejects = VersionedTable(spark, platform, "rejects_taxi_trips").read()
    reasons = {r._rule_id: r.n for r in rejects.groupBy("_rule_id").agg(F.count("*").alias("n")).collect()}
    assert reasons == {
        "not_null[key_cols]": 1,
        "range[fare_amount:0..None]": 1,
        "duplicate[vendor_id,pickup_time_local,dropoff_time_local,pu_location_id,do_location_id,fare_amount]": 1,
        "ref[pu_location_id->taxi_zone]": 1,
        "predicate[dropoff_after_pickup]": 1,
        "allowed[ratecode_id]": 1,
    }
    integrated = integrated_table(spark, platform)
    assert integrated.read().count() == 8 and integrated.read(0).count() == 6
    assert integrated.read().where("pickup_date = '2024-04-01'").first().pickup_borough == "Queens"
    again = run_updates(spark, platform, {"taxi_trips": batch}).first()
    assert (again.inserted, again.rows_after) == (0, 8)
    reports = spark.read.schema(RUN_REPORT).parquet(f"{platform}/_run_report")
    assert rows(monitoring.latest_run(reports).select("run_id")) == [(again.run_id,)]


def test_hard_failure_changes_nothing(spark, platform):
    batch = spark.createDataFrame(update_rows(), TRIP_SCHEMA).drop("fare_amount")
    report = run_updates(spark, platform, {"taxi_trips": batch}).first()
    assert report.hard_failure and "fare_amount" in report.hard_failure_reason
    assert (report.rejected_invalid_records, report.inserted, report.quarantined_records) == (10, 0, 0)
    assert VersionedTable(spark, platform, "taxi_trips").latest_version() == 0
    log = spark.read.schema(monitoring.RULE_LOG).parquet(f"{platform}/_validation_metrics")
    assert monitoring.hard_failures(log).first().rule_id == "schema_contract"


def test_without_validation_copies_in_the_file_are_kept(spark, platform):
    batch = spark.createDataFrame(update_rows(), TRIP_SCHEMA)
    options = UpdateOptions(validate=False, monitor=False)
    report = run_updates(spark, platform, {"taxi_trips": batch}, options=options).first()
    assert (report.inserted, report.validation_failures) == (8, 0)
    with pytest.raises(ValueError):
        run_updates(spark, platform, {"buses": batch})


def test_csv_update_with_a_new_column(spark, platform, tmp_path):
    new = [(2024, 5, 1, h, 20.0, 50, 0.1, 0, 90, 5.0, 9, 1000.0, 4, 1, 20.0 + 50 * h) for h in range(3)]
    path = write_csv(tmp_path / "w.csv", [*WEATHER_HEADER, "humidity"], new)
    report = run_updates(spark, platform, {"weather": path}).first()
    assert (report.inserted, report.rejected_invalid_records) == (2, 1)  # humidity 120 is out of range
    weather = VersionedTable(spark, platform, "weather").read()
    assert weather.where("humidity IS NULL").count() == 5 and weather.count() == 7


def test_generated_updates_apply(spark, platform, raw_paths, tmp_path):
    raw = {name: read_dataset(spark, MOBILITY[name], raw_paths[name]) for name in ("taxi_trips", "weather", "air_quality")}
    folder = str(tmp_path / "updates")
    paths = generate_updates(spark, folder, raw)
    manifest = {r.dataset: r for r in spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest").collect()}
    assert manifest["weather"].new_records == 168 and manifest["weather"].schema_changes == ["humidity"]
    assert manifest["air_quality"].new_records == 4 * 168 and manifest["air_quality"].schema_changes == ["aqi"]
    trips = manifest["taxi_trips"]
    assert trips.original_to == at("2024-03-15 08:00") and trips.schema_changes == []
    assert trips.new_records + trips.duplicate_records == spark.read.parquet(paths["taxi_trips"]).count()
    air = read_files(spark, "csv", paths["air_quality"])
    assert air.where("sample_measurement < 0 or aqi < 0 or aqi > 500").count() == 0
    reports = {r.dataset: r for r in run_updates(spark, platform, {n: paths[n] for n in ("weather", "air_quality")}).collect()}
    weather = reports["weather"]
    assert weather.schema_evolved_on_target == ["humidity"]
    # one of the six replayed observations is near the upper temperature bound
    assert weather.inserted + weather.rejected_invalid_records == 168 and 140 <= weather.inserted
    assert reports["air_quality"].inserted == 4 * 168 and reports["air_quality"].schema_version == "1.1"


def test_stream_of_files(spark, platform, tmp_path):
    folder, checkpoint = str(tmp_path / "arriving"), str(tmp_path / "checkpoint")
    frame = spark.createDataFrame(update_rows(), TRIP_SCHEMA)
    table = VersionedTable(spark, platform, "taxi_trips")
    frame.write.mode("append").parquet(folder)
    for expected in (8, 8):
        query = stream_updates(spark, platform, TAXI_TRIPS, folder, frame.schema, checkpoint)
        assert query.awaitTermination(120) and query.exception() is None
        assert table.read().count() == expected
    spark.createDataFrame([trip("2024-06-01 08:00", fare=50.0)], TRIP_SCHEMA).write.mode("append").parquet(folder)
    stream_updates(spark, platform, TAXI_TRIPS, folder, frame.schema, checkpoint).awaitTermination(120)
    assert table.read().count() == 9


def late_rows() -> dict:
    """A new trip, and weather and air of its hour and of a trip that is there already."""
    hours = [(2024, 2, 1, 14), (2024, 4, 1, 14), (2024, 3, 15, 13)]
    return {
        "taxi_trips": [trip("2024-04-01 10:00", pu=4, fare=44.0)],
        "weather": [(*h, 9.5, 50, 0.0, 0, 200, 7.0, 9, 1000.0, 8, 1) for h in hours],
        "air_quality": [
            ("36", "005", 70, 1, "2024-04-01", "10:00", "2024-04-01", "14:00", 50.0),
            ("36", "061", 71, 1, "2024-01-05", "10:00", "2024-01-05", "15:00", 28.0),  # third monitor of that hour
        ],
    }


@pytest.mark.parametrize("order", [("taxi_trips", "weather", "air_quality"), ("air_quality", "weather", "taxi_trips")])
def test_updates_do_not_depend_on_the_order_of_datasets(spark, platform, tmp_path, order):
    data = late_rows()
    batches = {
        "taxi_trips": spark.createDataFrame(data["taxi_trips"], TRIP_SCHEMA),
        "weather": write_csv(tmp_path / "w.csv", WEATHER_HEADER, data["weather"]),
        "air_quality": write_csv(tmp_path / "a.csv", AIR_HEADER, data["air_quality"]),
    }
    before = {r.pickup_time_local: r for r in integrated_table(spark, platform).read().collect()}
    run_updates(spark, platform, {n: batches[n] for n in order})
    after = {r.pickup_time_local: r for r in integrated_table(spark, platform).read().collect()}
    new = after[at("2024-04-01 10:00")]
    assert (new.pickup_weather_temperature, new.pickup_air_quality_pm25) == (9.5, 50.0)
    late = after[at("2024-01-05 10:15")]
    assert before[at("2024-01-05 10:15")].pickup_air_quality_pm25 == 10.0 and late.pickup_air_quality_pm25 == 16.0
    assert len(after) == len(before) + 1 and integrated_table(spark, platform).read().count() == 7
    untouched = at("2024-02-02 09:30")
    assert after[untouched].asDict() == before[untouched].asDict()


def test_a_late_measurement_refreshes_the_air_product(spark, platform, tmp_path):
    products.build_products(spark, platform, integrated_table(spark, platform).read())
    path = write_csv(tmp_path / "a.csv", AIR_HEADER, late_rows()["air_quality"])
    report = run_updates(spark, platform, {"air_quality": path})
    trips = integrated_table(spark, platform).read()
    done = products.refresh_products(spark, platform, trips, report.select("dataset", "inserted", "executed_at"))
    assert done == ["air_quality_impact_summary"]
    stored = VersionedTable(spark, platform, "air_quality_impact_summary").read()
    assert rows(stored) == rows(products.band_impact_summary(trips))
    assert trips.where("pickup_air_quality_pm25 = 16.0").count() == 1


def test_a_batch_sent_again_is_logged_and_quarantined_once(spark, platform):
    batch = spark.createDataFrame(update_rows(), TRIP_SCHEMA)
    first, second = (apply_update(spark, platform, TAXI_TRIPS, batch, "epoch-1") for _ in range(2))
    assert (first["inserted"], second["inserted"]) == (2, 0)
    assert first["quarantined_records"] == second["quarantined_records"] == 6
    assert VersionedTable(spark, platform, "rejects_taxi_trips").read().count() == 6
    log = spark.read.schema(monitoring.RULE_LOG).parquet(f"{platform}/_validation_metrics")
    assert log.count() == log.select("rule_id").distinct().count() and log.where("elapsed_s IS NOT NULL").isEmpty()


def test_monitoring_reports(spark):
    runs = spark.createDataFrame(
        [("p", d, at(f"2024-01-0{day} 00:00"), t, 10, 5, f, "1.0", f)
         for d, day, t, f in [("a", 1, 1.0, 0), ("a", 2, 3.0, 2), ("a", 3, 2.0, 1), ("b", 1, 5.0, 0)]],
        monitoring.RUN_LOG,
    )
    assert rows(monitoring.failures_by_dataset(runs)) == [("a", 2, 3), ("b", 0, 0)]
    assert rows(monitoring.runtime_by_dataset(runs)) == [("a", 2.0, 3.0), ("b", 5.0, 5.0)]
    change = monitoring.runtime_change(runs).collect()
    assert [(c.dataset, c.change_s) for c in change] == [("a", None), ("a", 2.0), ("a", -1.0), ("b", None)]
    assert monitoring.runs_by_time(runs).count() == 4
    log = spark.createDataFrame(
        [("r", "a", at("2024-01-01 00:00"), "x", "t", 0, 0, 0, 1.0, False, "1.0"),
         ("r", "a", at("2024-01-01 00:00"), "y", "t", 8, 2, 6, 2.0, True, "1.0")],
        monitoring.RULE_LOG,
    )
    assert rows(monitoring.rule_failures(log)) == [("a", "y", "t", 2, 8, 25.0)]
    assert rows(monitoring.rule_types(log)) == [("t", 2, 2, 1.5)]
    assert monitoring.hard_failures(log).count() == 1


def test_lookup_files(spark, tmp_path):
    path = write_csv(tmp_path / "labels.csv", ["coco", "weather_condition"], [(1, "Clear")])
    assert rows(condition_labels(spark, path)) == [(1, "Clear")]
    assert {r.weather_bucket for r in condition_buckets(spark).collect()} == {
        "Clear", "Cloudy", "Fog", "Rain", "Snow", "Storm"
    }
    assert len(AIR_HEADER) == 9
