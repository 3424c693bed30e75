"""Incremental maintenance: validate a batch, quarantine its rejects, merge, integrate, log."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbside.functions.names import snake_case_columns
from curbside.operators.merge import new_rows
from curbside.operators.rules import (
    Duplicate,
    NotNull,
    NumericRange,
    Rule,
    SchemaContract,
    Validator,
    passed,
    rejected,
    with_reference,
)
from curbside.plans.ingest import SOURCES, integrate_pending, integrated_table
from curbside.plans.monitoring import RULE_LOG, RUN_LOG
from curbside.session import discard, fresh_folder, settle_at
from curbside.sources.readers import conform, read_dataset
from curbside.sources.spec import MOBILITY, DatasetSpec
from curbside.sources.tables import VersionedTable, append_rows, read_if_exists

# Fields of a run's report.
RUN_REPORT = (
    "run_id string, started_at timestamp, dataset string, hard_failure boolean, hard_failure_reason string, "
    "rejected_invalid_records bigint, intra_file_duplicate_records bigint, quarantined_records bigint, "
    "schema_columns_added_from_update array<string>, schema_evolved_on_target array<string>, "
    "schema_version string, rows_before bigint, rows_after bigint, update_rows_considered bigint, "
    "inserted bigint, duplicates_ignored_vs_target bigint, processed_records bigint, "
    "validation_failures bigint, execution_time_s double, executed_at timestamp"
)


@dataclass(frozen=True)
class UpdateOptions:
    validate: bool = True
    monitor: bool = True
    integrate: bool = True


def rules_for(spec: DatasetSpec, references: Mapping[str, DataFrame | None] | None = None) -> list[Rule]:
    """Row rules of a contract, in order: keys, ranges, duplicates, references, extra rules."""
    rules: list[Rule] = [NotNull(spec.keys, rule_id="not_null[key_cols]")] if spec.keys else []
    rules += [NumericRange(c, lo, hi) for c, (lo, hi) in spec.ranges.items() if (lo, hi) != (None, None)]
    if spec.keys:
        rules.append(Duplicate(spec.keys))
    tables = references or {}
    known = {c: (tables.get(name), ref, name) for c, (name, ref) in spec.references.items()}
    return rules + with_reference(spec.extra_rules, known)


def load_references(spark: SparkSession, root: str, spec: DatasetSpec) -> dict[str, DataFrame | None]:
    """The tables a contract refers to; None where one does not exist yet."""
    tables = {name: VersionedTable(spark, root, name) for name, _ in spec.references.values()}
    return {name: table.read() if table.exists() else None for name, table in tables.items()}


def rejects_table(spark: SparkSession, root: str, dataset: str) -> VersionedTable:
    return VersionedTable(spark, root, f"rejects_{dataset}", partition_by=["_run_id"])


def rejects_of_run(table: VersionedTable, run_id: str) -> DataFrame:
    return table.read().where(F.col("_run_id") == run_id)


def quarantine(spark: SparkSession, root: str, dataset: str, rejects: DataFrame, run_id: str) -> int:
    """Append rejects with run id and time; returns their number. Nothing is written for none.

    Rejects are stored by run id. Those of a run that are stored already, as when a stream sends its batch again, are not
    stored twice; asking for them reads the footers of that run's folder only.
    """
    if rejects.isEmpty():
        return 0
    table = rejects_table(spark, root, dataset)
    if table.exists() and (stored := rejects_of_run(table, run_id).count()):
        return stored
    stamped = rejects.withColumns({"_run_id": F.lit(run_id), "_rejected_at": F.current_timestamp()})
    return table.append(stamped).added_rows


def align_types(updates: DataFrame, target: DataFrame) -> DataFrame:
    """Cast the columns both sides have to the target's types."""
    known = {f.name: f.dataType for f in target.schema.fields}
    return updates.select(*[F.col(c).cast(known[c]) if c in known else F.col(c) for c in updates.columns])


def merge_batch(spark: SparkSession, root: str, spec: DatasetSpec, updates: DataFrame) -> dict:
    """Insert the rows with new keys as one batch; columns the table lacks are added to it.

    `updates` is read twice (key bounds, then the join), so it should be a stored frame.
    """
    table = VersionedTable(spark, root, spec.name)
    before = table.require()
    target = table.rows_of(before)
    after = table.append(new_rows(align_types(updates, target), target, spec.keys), op="merge")
    first = before if before.version == 0 else table.require(0)
    major = spec.schema_version.split(".")[0]
    return {
        "rows_before": before.n_rows,
        "rows_after": after.n_rows,
        "inserted": after.added_rows,
        "schema_columns_added_from_update": sorted(set(updates.columns) - set(before.columns)),
        "schema_evolved_on_target": sorted(set(after.columns) - set(before.columns)),
        "schema_version": f"{major}.{len(set(after.columns) - set(first.columns))}",
    }


def apply_update(
    spark: SparkSession,
    root: str,
    spec: DatasetSpec,
    batch: DataFrame,
    run_id: str | None = None,
    options: UpdateOptions = UpdateOptions(),
) -> dict:
    """Apply one batch to one dataset, integrate whatever is merged and not integrated yet, and return its report.

    A call that dies can be repeated, with the same run id or another: what it merged is not inserted twice, and what it
    left unintegrated is pending, as `integrate_pending` finds from the tables.
    """
    report = merge_update(spark, root, spec, batch, run_id, options)
    if options.integrate:
        _integrate(spark, root, [spec.name])
    return report


def _integrate(spark: SparkSession, root: str, names: Iterable[str]) -> None:
    if not set(SOURCES).isdisjoint(names) and integrated_table(spark, root).exists():
        integrate_pending(spark, root)


def merge_update(
    spark: SparkSession,
    root: str,
    spec: DatasetSpec,
    batch: DataFrame,
    run_id: str | None = None,
    options: UpdateOptions = UpdateOptions(),
) -> dict:
    """Validate and merge one batch; its report.

    A run id that the rule log has already, as a stream sends after a failure, is not logged again.
    """
    run_id = run_id or str(uuid.uuid4())
    started_at, clock = datetime.now(timezone.utc), time.time()
    df = snake_case_columns(batch)
    contract = SchemaContract(spec.required, spec.optional)
    major = spec.schema_version.split(".")[0]
    report = {
        "run_id": run_id,
        "started_at": started_at,
        "dataset": spec.name,
        "hard_failure": False,
        "hard_failure_reason": None,
        "rejected_invalid_records": 0,
        "intra_file_duplicate_records": 0,
        "quarantined_records": 0,
        "schema_columns_added_from_update": [],
        "schema_evolved_on_target": [],
        "schema_version": f"{major}.0",
        "rows_before": None,
        "rows_after": None,
        "update_rows_considered": 0,
        "inserted": 0,
        "duplicates_ignored_vs_target": 0,
    }
    rule_rows: list[tuple] = []
    if options.validate:
        schema_check = contract.report(df).first()
        rule_rows.append(
            (contract.rule_id, contract.rule_type, schema_check.rows_in, schema_check.rows_failed,
             schema_check.rows_passed, schema_check.hard_failure)
        )
        if schema_check.hard_failure:
            report["hard_failure"] = True
            report["hard_failure_reason"] = schema_check.reason
            report["rejected_invalid_records"] = schema_check.rows_in

    folder = fresh_folder(spark, f"tagged-{spec.name}")
    replayed = _is_logged(spark, root, run_id, spec.name)
    if not report["hard_failure"]:
        updates, considered = conform(df, spec), None
        if options.validate:
            validator = Validator(rules_for(spec, load_references(spark, root, spec)))
            tagged = settle_at(validator.tag(updates), folder)
            metrics = validator.rule_metrics(tagged).orderBy("rule_order").collect()  # one row per rule
            rule_rows += [
                (m.rule_id, m.rule_type, m.rows_in, m.rows_failed, m.rows_passed, False) for m in metrics
            ]
            duplicates = sum(m.rows_failed for m in metrics if m.rule_type == "duplicate")
            report["intra_file_duplicate_records"] = duplicates
            report["rejected_invalid_records"] = sum(m.rows_failed for m in metrics) - duplicates
            if any(m.rows_failed for m in metrics):
                report["quarantined_records"] = quarantine(spark, root, spec.name, rejected(tagged), run_id)
            updates = passed(tagged)
            considered = metrics[-1].rows_passed if metrics else None
        report["update_rows_considered"] = updates.count() if considered is None else considered
        report |= merge_batch(spark, root, spec, updates)
        report["duplicates_ignored_vs_target"] = report["update_rows_considered"] - report["inserted"]
        discard(spark, folder)

    failures = report["rejected_invalid_records"] + report["intra_file_duplicate_records"]
    report["validation_failures"] = failures
    report["processed_records"] = 0 if report["hard_failure"] else report["update_rows_considered"] + failures
    report["execution_time_s"] = round(time.time() - clock, 2)
    report["executed_at"] = datetime.now(timezone.utc)
    if options.monitor and not replayed:
        log_run(spark, root, report)
        log_rules(spark, root, report, rule_rows)
    return report


def _is_logged(spark: SparkSession, root: str, run_id: str, dataset: str) -> bool:
    """Whether the rule log has rows of this run and dataset."""
    log = read_if_exists(spark, f"{root}/_validation_metrics", RULE_LOG)
    return not log.where((F.col("run_id") == run_id) & (F.col("dataset") == dataset)).isEmpty()


def log_run(spark: SparkSession, root: str, report: dict, name: str = "incremental_update") -> None:
    row = (
        name,
        report["dataset"],
        report["executed_at"],
        float(report["execution_time_s"]),
        report["processed_records"],
        report["inserted"],
        report["rejected_invalid_records"],
        report["schema_version"],
        report["validation_failures"],
    )
    append_rows(spark, f"{root}/_monitoring", [row], RUN_LOG)


def log_rules(spark: SparkSession, root: str, report: dict, rule_rows: list[tuple]) -> None:
    """One row per rule. Rules run in one pass and have no time of their own: `elapsed_s` is NULL, and the time of the
    batch is in the run log."""
    if not rule_rows:
        return
    rows = [
        (report["run_id"], report["dataset"], report["executed_at"], rule_id, rule_type, rows_in, failed, ok,
         None, hard, report["schema_version"])
        for rule_id, rule_type, rows_in, failed, ok, hard in rule_rows
    ]
    append_rows(spark, f"{root}/_validation_metrics", rows, RULE_LOG)


def run_updates(
    spark: SparkSession,
    root: str,
    batches: Mapping[str, str | DataFrame],
    specs: Mapping[str, DatasetSpec] = MOBILITY,
    options: UpdateOptions = UpdateOptions(),
) -> DataFrame:
    """Apply one batch per dataset (a path or a frame) and append the run's report rows.

    All datasets are merged before anything is integrated, so their order does not matter.
    """
    unknown = sorted(set(batches) - set(specs))
    if unknown:
        raise ValueError(f"Unknown datasets: {unknown}. Available: {sorted(specs)}")
    run_id = str(uuid.uuid4())
    reports = []
    for name, batch in batches.items():
        frame = read_dataset(spark, specs[name], batch) if isinstance(batch, str) else batch
        reports.append(merge_update(spark, root, specs[name], frame, run_id, options))
    if options.integrate:
        _integrate(spark, root, batches)
    names = [part.split(" ")[0] for part in RUN_REPORT.split(", ")]
    rows = [tuple(r[n] for n in names) for r in reports]
    append_rows(spark, f"{root}/_run_report", rows, RUN_REPORT)
    return spark.createDataFrame(rows, RUN_REPORT)

