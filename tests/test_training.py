from __future__ import annotations

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.errors import PythonException
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import functions as F

from curbside.operators import boosted_trees
from curbside.operators.features import (
    analyse_categories,
    analyse_numbers,
    analyse_times,
    imputer,
    indexer,
    numeric_candidates,
    with_split_name,
)
from curbside.operators.generate import trip_update
from curbside.plans import experiments, incremental, training
from curbside.plans.ingest import integrated_table
from curbside.sources.lookups import condition_buckets, condition_labels

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def trips(spark):
    rng = random.Random(2)
    data = []
    for i in range(400):
        distance = rng.uniform(1, 10)
        pickup = START + timedelta(hours=rng.randrange(2000))
        data.append(
            (i, pickup, pickup + timedelta(minutes=rng.randrange(60)), rng.choice(["A", "B", "C", None]),
             rng.choice(["Bronx", "Queens"]), rng.choice(["A", "B"]), distance, rng.choice([1, 2, None]),
             rng.choice([None, 5.0, 20.0]), rng.uniform(-5, 20), None if i % 50 == 0 else 3 * distance + 2,
             rng.choice([1, 7, None]), pickup.strftime("%Y-%m-%d"), rng.choice([0.0, 1.5]), pickup)
        )
    return spark.createDataFrame(
        data,
        "id bigint, pickup_time_local timestamp_ntz, dropoff_time_local timestamp_ntz, pickup_zone string, "
        "pickup_borough string, dropoff_zone string, trip_distance double, passenger_count bigint, "
        "pickup_air_quality_pm25 double, pickup_weather_temperature double, fare_amount double, "
        "pickup_weather_condition_code int, pickup_date string, airport_fee double, time_utc timestamp_ntz",
    ).withColumn("total_amount", F.col("fare_amount") + 1)


def test_numeric_candidates_include_all_numeric_types(spark):
    df = spark.range(1).select(
        F.lit(1).cast("tinyint").alias("a"), F.lit(1).cast("decimal(5,2)").alias("b"), F.lit("x").alias("c"),
        F.lit(1.0).alias("fare_amount"), F.lit(1).alias("vendor_id"), F.lit(1).alias("state_code"),
    )
    assert numeric_candidates(df) == ["a", "b"]


def test_analyses_match_plain_aggregates(trips):
    stats = {(r.feature, r.value): r for r in analyse_categories(trips, ("pickup_zone", "dropoff_zone")).collect()}
    for feature in ("pickup_zone", "dropoff_zone"):
        plain = trips.groupBy(feature).agg(F.count("*").alias("n"), F.avg("fare_amount").alias("m")).collect()
        for r in plain:
            assert stats[(feature, r[0])]["count"] == r.n
            assert stats[(feature, r[0])].mean_fare == pytest.approx(r.m)
    hours = analyse_times(trips, ("pickup_time_local",)).collect()
    assert sum(r["count"] for r in hours) == 400 and [r.value for r in hours] == list(range(24))
    assert analyse_times(trips, ("pickup_time_local",), parts=("day_of_week", "month", "day")).count() == 7 + 3 + 31


def test_correlation_ignores_missing_pairs(trips):
    pairs = analyse_numbers(trips).collect()
    assert pairs[0].candidate == "trip_distance" and pairs[0].correlation == pytest.approx(1.0)
    assert [abs(p.correlation) for p in pairs] == sorted((abs(p.correlation) for p in pairs), reverse=True)


def test_index_order_and_unseen_values(spark):
    seen = spark.createDataFrame([("b",), ("b",), ("a",), ("c",)], "s string")
    model = indexer(["s"]).fit(seen)
    new = spark.createDataFrame([("b",), ("a",), ("c",), ("z",), (None,)], "s string")
    assert [r.s_index for r in model.transform(new).collect()] == [0.0, 1.0, 2.0, 3.0, 3.0]


def test_imputer_uses_the_median(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (90.0,), (None,)], "v double")
    assert sorted(r.v_imputed for r in imputer(["v"]).fit(df).transform(df).collect()) == [1.0, 2.0, 2.0, 90.0]


def test_hash_split_is_stable_and_complete(trips):
    split = with_split_name(trips, ("a", "b", "c"), (0.7, 0.15, 0.15), ["id"])
    sizes = {r.split: r["count"] for r in split.groupBy("split").count().collect()}
    assert sum(sizes.values()) == 400 and 240 < sizes["a"] < 320
    again = with_split_name(trips.repartition(5), ("a", "b", "c"), (0.7, 0.15, 0.15), ["id"])
    assert split.select("id", "split").exceptAll(again.select("id", "split")).isEmpty()


def test_training_data(trips):
    for keys in (["id"], None):
        parts = training.training_data(trips, keys=keys)
        assert sum(p.count() for p in parts) == trips.where("fare_amount IS NOT NULL").count()
        first = parts[2].first()
        assert len(first.features) == 4 + 2 + 3 and parts[0].columns == ["fare_amount", "features"]


def test_model_by_version_and_registry(spark, root, tmp_path, trips):
    table = integrated_table(spark, root)
    table.overwrite(trips)
    table.append(trips.withColumn("fare_amount", F.col("fare_amount") * 2))
    models = str(tmp_path / "models")
    path, metrics = training.train_on_version(spark, root, models, version=0, max_iter=2, keys=["id"])
    assert path.endswith("fare_model_v0") and metrics["r2"] > 0.5
    scored = PipelineModel.load(path).transform(table.read(0).where("fare_amount IS NOT NULL"))
    ours = training.regression_metrics(scored, digits=6).first()
    for name in ("rmse", "mae", "r2"):
        evaluator = RegressionEvaluator(labelCol="fare_amount", metricName=name)
        assert ours[name] == pytest.approx(evaluator.evaluate(scored), abs=1e-5)
    registry = spark.read.schema(training.REGISTRY).parquet(f"{models}/_registry").first()
    assert (registry.table_version, registry.max_bins, registry.rmse) == (0, 300, metrics["rmse"])


def test_compare_inputs(trips):
    results = training.compare_inputs({"a": lambda: trips, "b": lambda: trips}, max_iter=1, keys=["id"])
    assert [r["rows"] for r in results] == [400, 400] and results[0]["rmse"] == results[1]["rmse"]


def test_trip_update_follows_history(trips):
    batch = trip_update(trips, ["id"], pickup="pickup_time_local", dropoff="dropoff_time_local",
                        new_fraction=0.3, duplicate_fraction=0.2)
    newest = trips.agg(F.max("pickup_time_local")).first()[0]
    new = batch.where(F.col("pickup_time_local") > newest)
    copies = batch.where(F.col("pickup_time_local") <= newest)
    assert 80 < new.count() < 160 and 45 < copies.count() < 115
    assert copies.exceptAll(trips).isEmpty()
    assert new.agg(F.min("pickup_time_local")).first()[0] >= newest + timedelta(seconds=1)
    both = new.alias("n").join(trips.alias("t"), "id")
    assert both.where("abs(n.trip_distance / t.trip_distance - 1) > 0.1000001").isEmpty()
    assert both.where("abs(n.fare_amount / t.fare_amount - 1) > 0.0500001").isEmpty()
    assert both.where("abs(n.passenger_count - t.passenger_count) > 1 OR n.passenger_count < 1").isEmpty()
    moved = "timestampdiff(SECOND, n.pickup_time_local, n.dropoff_time_local)"
    assert both.where(f"{moved} <> timestampdiff(SECOND, t.pickup_time_local, t.dropoff_time_local)").isEmpty()
    assert trip_update(trips, ["id"], pickup="pickup_time_local", dropoff="dropoff_time_local",
                       new_fraction=0.3, duplicate_fraction=0.2).exceptAll(batch).isEmpty()


def test_experiments_agree(spark, root, trips):
    labels, buckets = condition_labels(spark), condition_buckets(spark)
    table = integrated_table(spark, root)
    table.overwrite(trips)
    stored = table.read()
    results = [
        experiments.caching(stored, labels, buckets),
        experiments.pruning(stored, "2024-01-01", "2024-02-01"),
        experiments.broadcasting(spark, stored, labels, buckets),
        experiments.adaptive(spark, stored),
    ]
    assert all(r["same_result"] for r in results)
    assert "AdaptiveSparkPlan" in results[3]["adaptive_plan"] and "AdaptiveSparkPlan" not in results[3]["static_plan"]
    layouts = experiments.layouts(spark, trips)
    assert layouts["monthly"]["files"] >= 3 and layouts["flat"]["megabytes"] >= 0
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_trees_as_columns_predict_like_the_model(trips):
    train, test = training.split_rows(
        trips, "fare_amount", (*training.FEATURES_CATEGORICAL, *training.FEATURES_NUMERIC, *training.FEATURES_DATE),
        training.SPLIT, training.SEED, ["id"],
    )
    stages = [*training.feature_stages(), training.gbt(max_iter=5)]
    model = training.Pipeline(stages=stages).fit(train)
    ours = training.scored_by_columns(model, test).select("id", "prediction").collect()
    theirs = {r.id: r.prediction for r in model.transform(test).select("id", "prediction").collect()}
    assert len(ours) == len(theirs) > 50 and len(set(theirs.values())) > 5
    for r in ours:
        assert r.prediction == pytest.approx(theirs[r.id], rel=1e-12)


def _nodes(model) -> list[list[str]]:
    return [tree.toDebugString.splitlines()[1:] for tree in model.trees]


def test_trees_of_blocks_are_those_of_spark(spark, tmp_path):
    """Few and many values, categories, a constant, a skewed feature; the label depends on all and has noise."""
    rng = random.Random(5)
    data = []
    for _ in range(6000):
        few, many, kind, skewed = rng.randrange(12), rng.gauss(0, 1), rng.choice("abcdefg"), 0.0 if rng.random() < 0.7 else rng.random()
        label = few * 3 + many * ord(kind) + (20 if kind in "bf" else 0) + 9 * skewed + rng.gauss(0, 4)
        data.append((float(few), many, kind, skewed, 1.0, label))
    rows = spark.createDataFrame(data, "few double, many double, kind string, skewed double, same double, fare_amount double")
    stages = [indexer(["kind"]), VectorAssembler(inputCols=["few", "many", "kind_index", "skewed", "same"], outputCol="features")]
    ready = training.Pipeline(stages=stages).fit(rows).transform(rows).repartition(3)
    for settings in ({"max_iter": 4}, {"max_iter": 2, "max_bins": 20}):
        ours = training.gbt(**settings).fit_in_blocks(ready)
        theirs = GBTRegressor(labelCol="fare_amount", maxIter=settings["max_iter"], maxBins=settings.get("max_bins", 300)).fit(ready)
        assert len(ours.trees) == settings["max_iter"] and ours.treeWeights == theirs.treeWeights
        for a, b in zip(_nodes(ours), _nodes(theirs)):
            assert [line for line in a if "Predict" not in line] == [line for line in b if "Predict" not in line]
        both = ours.transform(ready).select("prediction", "features").withColumnRenamed("prediction", "ours")
        both = theirs.transform(both)
        assert both.where("abs(ours - prediction) > 1e-9 * (1 + abs(prediction))").isEmpty()
        assert ours.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), abs=1e-9)
        ours.write().overwrite().save(str(tmp_path / "model"))
        assert _nodes(GBTRegressionModel.load(str(tmp_path / "model"))) == _nodes(ours)


def test_many_rows_are_fitted_in_blocks(trips, monkeypatch):
    """Spark's own fit, which holds all rows as objects, is for fewer rows; both fits refuse the same."""
    ready = training.training_data(trips, keys=["id"])[0]
    theirs = training.gbt(max_iter=3).fit(ready)
    monkeypatch.setattr(boosted_trees, "BLOCKS_FROM", 0)
    monkeypatch.setattr(GBTRegressor, "_fit", None)
    ours = training.gbt(max_iter=3).fit(ready)
    # nodes of a few rows are split alike by several features, so rows are compared and not trees
    both = theirs.transform(ours.transform(ready).select("features", F.col("prediction").alias("ours")))
    assert both.where("abs(ours - prediction) > 1e-9 * abs(prediction)").isEmpty()
    for wrong in ("NULL", "double('nan')"):
        with pytest.raises(PythonException, match="Labels MUST NOT be Null or NaN"):
            training.gbt(max_iter=1).fit(ready.withColumn("fare_amount", F.expr(wrong).cast("double")))


def test_summary_of_values_keeps_ranks():
    """Values beyond the bound are merged with the next larger ones: counts stay whole and ranks are near."""
    rng = np.random.default_rng(1)
    kept = np.empty(0), np.empty(0)
    whole = rng.lognormal(size=200_000)
    for part in np.split(whole, 20):
        kept = boosted_trees._merged(np.append(kept[0], part), np.append(kept[1], np.ones(len(part))), 2000)
    values, counts = kept
    assert len(values) <= 4000 and counts.sum() == 200_000 and (np.diff(values) > 0).all() and values[-1] == whole.max()
    ranks = np.searchsorted(np.sort(whole), values, side="right")
    assert np.abs(np.cumsum(counts) - ranks).max() < 0.005 * 200_000


def test_raw_files_and_platform_train_the_same_model(spark, platform, raw_paths):
    settings = {"categorical": ("vendor_id",), "numeric": ("trip_distance",), "dates": ("pickup_time_local",)}
    keys = ["pickup_time_local", "pu_location_id", "fare_amount"]
    raw, stored = training.raw_and_platform(spark, platform, raw_paths, max_iter=1, keys=keys, **settings)
    assert (raw["input"], stored["input"]) == ("raw", "platform")
    assert raw["rows"] == stored["rows"] == 6 and raw["rmse"] == stored["rmse"]


def test_rejects_are_read_by_run(spark, root):
    for run in ("r1", "r2"):
        incremental.quarantine(spark, root, "lines", spark.range(3).withColumn("_rule_id", F.lit("x")), run)
    table = incremental.rejects_table(spark, root, "lines")
    found = incremental.rejects_of_run(table, "r2")
    assert found.count() == 3 and table.read().count() == 6
    plan = experiments.plan_text(found)
    assert any("PartitionFilters" in line and "r2" in line for line in plan.splitlines())
    assert incremental.quarantine(spark, root, "lines", spark.range(9), "r1") == 3
