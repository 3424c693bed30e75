"""Training sets and the versioned fare model."""

from __future__ import annotations

import re
import time
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbside.operators.boosted_trees import BlockGBTRegressor
from curbside.operators.features import (
    FEATURES_CATEGORICAL,
    FEATURES_DATE,
    FEATURES_NUMERIC,
    TARGET,
    feature_stages,
    require_few_values,
    with_split_name,
)
from curbside.plans.ingest import build_from_raw, integrated_table
from curbside.session import fresh_folder, settle
from curbside.sources.tables import append_rows

# Model settings.
SEED = 42
MAX_ITER = 20
MAX_BINS = 300
SPLIT = (0.8, 0.2)

REGISTRY = (
    "table_version int, path string, target string, categorical array<string>, numeric array<string>, "
    "dates array<string>, seed int, max_iter int, max_bins int, rmse double, mae double, r2 double, "
    "trained_at timestamp"
)


def split_rows(
    df: DataFrame, target: str, features: Sequence[str], weights: Sequence[float], seed: int,
    keys: Sequence[str] | None,
) -> list[DataFrame]:
    """Rows with a known target, split by weight; only the columns needed are kept.

    Every stage of a pipeline passes over its input, so the rows are stored once, with the name
    of their split. With row keys the split is by hash, otherwise it is Spark's random split.
    """
    known = df.where(F.col(target).isNotNull())
    if not keys:
        return settle(known.select(target, *features), "training").randomSplit(list(weights), seed=seed)
    names = [f"part{i}" for i in range(len(weights))]
    kept = dict.fromkeys([target, *features, *keys, "split"])
    path = fresh_folder(df.sparkSession, "training")
    # one folder per split, so that each is read alone
    with_split_name(known, names, weights, keys, seed).select(*kept).write.partitionBy("split").parquet(path)
    stored = df.sparkSession.read.schema(f"{_ddl(known, kept)}").parquet(path)
    return [stored.where(F.col("split") == name).drop("split") for name in names]


def _ddl(df: DataFrame, names: Sequence[str]) -> str:
    """The columns as a schema text; the split is text."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields} | {"split": "string"}
    return ", ".join(f"`{n}` {kinds[n]}" for n in names)


def training_data(
    df: DataFrame,
    target: str = TARGET,
    categorical: Sequence[str] = FEATURES_CATEGORICAL,
    numeric: Sequence[str] = FEATURES_NUMERIC,
    dates: Sequence[str] = FEATURES_DATE,
    train_ratio: float = 0.7,
    validation_ratio: float = 0.15,
    seed: int = SEED,
    keys: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train, validation and test sets of (target, features).

    Preprocessing is fitted on the training rows alone and applied to all three.
    """
    weights = [train_ratio, validation_ratio, 1.0 - train_ratio - validation_ratio]
    parts = split_rows(df, target, (*categorical, *numeric, *dates), weights, seed, keys)
    require_few_values(parts[0], categorical, MAX_BINS)
    model = Pipeline(stages=feature_stages(categorical, numeric, dates)).fit(parts[0])
    train, validation, test = (model.transform(p).select(target, "features") for p in parts)
    return train, validation, test


def gbt(target: str = TARGET, max_iter: int = MAX_ITER, max_bins: int = MAX_BINS, seed: int = SEED) -> GBTRegressor:
    return BlockGBTRegressor(labelCol=target, featuresCol="features", maxIter=max_iter, maxBins=max_bins, seed=seed)


def regression_metrics(
    predictions: DataFrame, target: str = TARGET, prediction: str = "prediction", digits: int = 4
) -> DataFrame:
    """One row: rmse, mae, r2, from a single aggregate over the predictions."""
    error = F.col(prediction) - F.col(target)
    sums = predictions.agg(
        F.count("*").alias("n"),
        F.sum(error * error).alias("sse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop(target).alias("variance"),
    )
    return sums.select(
        F.round(F.sqrt(F.col("sse") / F.col("n")), digits).alias("rmse"),
        F.round("mae", digits).alias("mae"),
        F.round(1 - F.col("sse") / (F.col("variance") * F.col("n")), digits).alias("r2"),
    )


def fit_and_score(
    df: DataFrame,
    target: str = TARGET,
    categorical: Sequence[str] = FEATURES_CATEGORICAL,
    numeric: Sequence[str] = FEATURES_NUMERIC,
    dates: Sequence[str] = FEATURES_DATE,
    max_iter: int = MAX_ITER,
    max_bins: int = MAX_BINS,
    seed: int = SEED,
    keys: Sequence[str] | None = None,
) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """Fit preprocessing and model on 80 %; the other 20 % come back scored, with their metrics."""
    train, test = split_rows(df, target, (*categorical, *numeric, *dates), SPLIT, seed, keys)
    require_few_values(train, categorical, max_bins)
    stages = [*feature_stages(categorical, numeric, dates), gbt(target, max_iter, max_bins, seed)]
    model = Pipeline(stages=stages).fit(train)
    scored = model.transform(test)
    return model, scored, regression_metrics(scored, target)


def train_and_evaluate(df: DataFrame, **settings) -> tuple[PipelineModel, dict[str, float]]:
    model, _, metrics = fit_and_score(df, **settings)
    return model, metrics.first().asDict()


def train_on_version(
    spark: SparkSession, root: str, models: str, version: int | None = None, **settings
) -> tuple[str, dict[str, float]]:
    """Train on a version of the integrated table (latest by default) and save the model.

    The model path names the version; the registry table gets one row per training.
    """
    table = integrated_table(spark, root)
    version = table.latest_version() if version is None else version
    model, metrics = train_and_evaluate(table.read(version), **settings)
    path = f"{models.rstrip('/')}/fare_model_v{version}"
    model.write().overwrite().save(path)
    row = (
        version,
        path,
        settings.get("target", TARGET),
        list(settings.get("categorical", FEATURES_CATEGORICAL)),
        list(settings.get("numeric", FEATURES_NUMERIC)),
        list(settings.get("dates", FEATURES_DATE)),
        settings.get("seed", SEED),
        settings.get("max_iter", MAX_ITER),
        settings.get("max_bins", MAX_BINS),
        metrics["rmse"],
        metrics["mae"],
        metrics["r2"],
        datetime.now(timezone.utc),
    )
    append_rows(spark, f"{models.rstrip('/')}/_registry", [row], REGISTRY)
    return path, metrics


def tree_prediction(model: GBTRegressionModel, features: str | Column = "features") -> Column:
    """The prediction of boosted trees as a column expression over the feature vector.

    With it rows are scored in generated code, and a scored table needs no model object. The trees are read from the
    model's own description, which prints thresholds and leaves exactly.
    """
    values = vector_to_array(F.col(features) if isinstance(features, str) else features)
    trees = [_tree_column(tree.toDebugString.splitlines()[1:], values) for tree in model.trees]
    return reduce(Column.__add__, [F.lit(float(w)) * t for w, t in zip(model.treeWeights, trees)])


_QUESTION = re.compile(r"\s*(?:If|Else) \(feature (\d+) (<=|>|in|not in) (.*)\)\s*")


def _tree_column(lines: list[str], values: Column) -> Column:
    """A tree from its description: `If (question)`, the branch below it, `Else (...)`, the other branch."""
    remaining = iter(lines)

    def node() -> Column:
        line = next(remaining)
        if "Predict:" in line:
            return F.lit(float(line.split("Predict:")[1]))
        feature, relation, operand = _QUESTION.fullmatch(line).groups()
        value = F.get(values, F.lit(int(feature)))
        if relation == "<=":
            test = value <= F.lit(float(operand))
        else:
            test = value.isin([float(v) for v in operand.strip("{}").split(",")])
            test = ~test if relation == "not in" else test
        yes = node()
        next(remaining)  # the Else line says the opposite
        return F.when(test, yes).otherwise(node())

    return node()


def scored_by_columns(model: PipelineModel, df: DataFrame) -> DataFrame:
    """`df` with the prediction of a fitted pipeline whose last stage are boosted trees."""
    prepared = PipelineModel(model.stages[:-1]).transform(df)
    return prepared.withColumn("prediction", tree_prediction(model.stages[-1]))


def raw_and_platform(spark: SparkSession, root: str, paths: Mapping[str, str | Sequence[str]], **settings) -> list[dict]:
    """The same model from raw files, read, cleaned and joined for it, and from the stored integrated table."""
    return compare_inputs(
        {
            "raw": lambda: build_from_raw(spark, paths),
            "platform": lambda: integrated_table(spark, root).read(),
        },
        **settings,
    )


def compare_inputs(builders: dict, **settings) -> list[dict]:
    """Preparation time, training time and metrics for each way to obtain the same data."""
    results = []
    for name, build in builders.items():
        started = time.perf_counter()
        frame = build().cache()
        rows = frame.count()
        prepared = time.perf_counter()
        _, metrics = train_and_evaluate(frame, **settings)
        done = time.perf_counter()
        frame.unpersist()
        results.append({"input": name, "rows": rows, "prepare_s": prepared - started, "train_s": done - prepared, **metrics})
    return results
