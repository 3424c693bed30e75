"""Reports over the run log and the rule-metrics log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbside.operators.ordered import previous_value

RUN_LOG = (
    "pipeline_name string, dataset string, executed_at timestamp, execution_time_s double, "
    "processed_records bigint, inserted_records bigint, rejected_records bigint, "
    "schema_version string, validation_failures bigint"
)
RULE_LOG = (
    "run_id string, dataset string, executed_at timestamp, rule_id string, rule_type string, "
    "rows_in bigint, rows_failed bigint, rows_passed bigint, elapsed_s double, "
    "hard_failure boolean, schema_version string"
)


def failures_by_dataset(runs: DataFrame) -> DataFrame:
    return (
        runs.groupBy("dataset")
        .agg(
            F.count_if(F.col("validation_failures") > 0).alias("runs_with_failures"),
            F.sum("validation_failures").alias("total_validation_failures"),
        )
        .orderBy(F.desc("runs_with_failures"), F.desc("total_validation_failures"))
    )


def runtime_by_dataset(runs: DataFrame) -> DataFrame:
    return (
        runs.groupBy("dataset")
        .agg(
            F.round(F.avg("execution_time_s"), 2).alias("avg_time_s"),
            F.max("execution_time_s").alias("max_time_s"),
        )
        .orderBy(F.desc("avg_time_s"))
    )


def runs_by_time(runs: DataFrame) -> DataFrame:
    # the further columns let the sort split a moment that many runs share
    return runs.select("executed_at", "dataset", "processed_records", "rejected_records").orderBy(
        "executed_at", "dataset", "processed_records", "rejected_records"
    )


def runtime_change(runs: DataFrame, order: tuple[str, ...] = ("executed_at",)) -> DataFrame:
    """Difference to the dataset's run before; NULL for the first."""
    ties = (*order, "execution_time_s")  # runs of one moment follow each other by their time
    changed = previous_value(runs.select("dataset", *ties), "dataset", ties, "execution_time_s", "_before")
    return changed.select(
        "dataset", *order, "execution_time_s", (F.col("execution_time_s") - F.col("_before")).alias("change_s")
    ).orderBy("dataset", *ties)


def rule_failures(rule_log: DataFrame) -> DataFrame:
    """Rules that ever failed, with their failure rate in percent."""
    return (
        rule_log.groupBy("dataset", "rule_id", "rule_type")
        .agg(F.sum("rows_failed").alias("total_failed"), F.sum("rows_in").alias("total_checked"))
        .where("total_failed > 0")
        .withColumn(
            "fail_pct", F.round(F.col("total_failed") / F.nullif("total_checked", F.lit(0)) * F.lit(100), 2)
        )
        .orderBy("dataset", F.desc("total_failed"))
    )


def rule_types(rule_log: DataFrame) -> DataFrame:
    return (
        rule_log.groupBy("rule_type")
        .agg(
            F.count_distinct("rule_id").alias("distinct_rules"),
            F.sum("rows_failed").alias("total_failed"),
            F.round(F.avg("elapsed_s"), 3).alias("avg_elapsed_s"),
        )
        .orderBy(F.desc("total_failed"))
    )


def hard_failures(rule_log: DataFrame) -> DataFrame:
    return (
        rule_log.where("hard_failure")
        .select("run_id", "dataset", "executed_at", "rule_id")
        .orderBy(F.desc("executed_at"), "run_id", "dataset", "rule_id")
    )


def latest_run(reports: DataFrame) -> DataFrame:
    """All rows of the run that started last."""
    newest = reports.agg(F.max_by("run_id", F.struct("started_at", "run_id")))
    return reports.where(F.col("run_id") == newest.scalar())
