"""Experiments: the same result computed in different ways, timed and compared."""

from __future__ import annotations

import statistics
import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager, redirect_stdout
from io import StringIO

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbside.operators.rules import Rule, Validator, passed, rejected
from curbside.plans import demand
from curbside.plans.incremental import UpdateOptions, apply_update
from curbside.session import fresh_folder
from curbside.sources.layout import storage_footprint, storage_overhead, with_pickup_month, write_partitioned
from curbside.sources.spec import DatasetSpec
from curbside.sources.tables import VersionedTable


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Runtime settings (dots written as `__`) for the duration of a block."""
    wanted = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def fingerprint(df: DataFrame) -> tuple[int, int]:
    """Row count and an order-free hash sum, computed where the rows are."""
    hashed = df.select(F.xxhash64(*df.columns).cast("decimal(38,0)").alias("h"))
    row = hashed.agg(F.count("*").alias("n"), F.coalesce(F.sum("h"), F.lit(0)).alias("s")).first()
    return row.n, int(row.s)


def plan_text(df: DataFrame) -> str:
    out = StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def timed(run: Callable[[], object]) -> tuple[float, object]:
    started = time.perf_counter()
    value = run()
    return time.perf_counter() - started, value


def compare(first: Callable[[], object], second: Callable[[], object], names: tuple[str, str]) -> dict:
    """Seconds of both variants and whether they agree."""
    seconds_a, a = timed(first)
    seconds_b, b = timed(second)
    return {f"{names[0]}_s": seconds_a, f"{names[1]}_s": seconds_b, "same_result": a == b}


def caching(trips: DataFrame, labels: DataFrame, buckets: DataFrame) -> dict:
    """The six questions on the stored table and on a cached one; filling the cache is timed by itself."""

    def run() -> dict:
        return {n: fingerprint(df) for n, df in demand.six_questions(trips, labels, buckets).items()}

    seconds, plain = timed(run)
    trips.cache()
    try:
        fill_seconds, _ = timed(trips.count)
        cached_seconds, cached = timed(run)
    finally:
        trips.unpersist()
    return {"uncached_s": seconds, "fill_s": fill_seconds, "cached_s": cached_seconds, "same_result": plain == cached}


def pruning(trips: DataFrame, start: str, end: str) -> dict:
    """Monthly trends by pickup time and by partition column; `trips` must not be cached."""
    return compare(
        lambda: fingerprint(demand.monthly_trends(trips, start, end, prune=False)),
        lambda: fingerprint(demand.monthly_trends(trips, start, end, prune=True)),
        ("unpruned", "pruned"),
    )


def broadcasting(spark: SparkSession, trips: DataFrame, labels: DataFrame, buckets: DataFrame) -> dict:
    """Distance per bucket by shuffle joins and by hinted broadcast joins."""
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        return compare(
            lambda: fingerprint(demand.distance_by_bucket(trips, labels, buckets)),
            lambda: fingerprint(demand.distance_by_bucket(trips, labels, buckets, hint=True)),
            ("shuffle", "broadcast"),
        )


def adaptive(spark: SparkSession, trips: DataFrame) -> dict:
    """Monthly zone demand with adaptive execution off and on, with both plans."""
    plans = {}

    def run(enabled: str) -> tuple[int, int]:
        with settings(spark, spark__sql__adaptive__enabled=enabled):
            question = demand.monthly_zone_demand(trips)
            plans[enabled] = plan_text(question)
            return fingerprint(question)

    result = compare(lambda: run("false"), lambda: run("true"), ("static", "adaptive"))
    return {**result, "static_plan": plans["false"], "adaptive_plan": plans["true"]}


def layouts(spark: SparkSession, trips: DataFrame) -> dict[str, dict]:
    """Write time, size, files and latency of three questions: one folder versus one per month."""
    folder = fresh_folder(spark, "layouts")
    flat, monthly = f"{folder}/flat", f"{folder}/monthly"
    writes = {
        flat: lambda: trips.write.parquet(flat),
        monthly: lambda: write_partitioned(with_pickup_month(trips), monthly, ["pickup_month"]),
    }
    out = {}
    for path, write in writes.items():
        write_s, _ = timed(write)
        stored = spark.read.parquet(path)
        size = storage_footprint(spark, path).first()
        latency, _ = timed(
            lambda: [
                fingerprint(q(stored))
                for q in (demand.trips_by_borough, demand.duration_by_day, demand.fare_by_borough)
            ]
        )
        out[path.rsplit("/", 1)[1]] = {
            "write_s": write_s, "megabytes": size.megabytes, "files": size.files, "three_questions_s": latency
        }
    return out


def update_overhead(
    spark: SparkSession, root: str, spec: DatasetSpec, batch: DataFrame, repeats: int = 3
) -> dict[str, float]:
    """Median seconds of an update with validation and monitoring on or off.

    The table is restored to its version before each run, so all runs do the same work.
    """
    table = VersionedTable(spark, root, spec.name)
    start = table.latest_version()
    medians = {}
    for validate in (False, True):
        for monitor in (False, True):
            options = UpdateOptions(validate=validate, monitor=monitor, integrate=False)
            runs = []
            for _ in range(repeats):
                table.restore(start)
                runs.append(timed(lambda: apply_update(spark, root, spec, batch, options=options))[0])
            medians[f"validate={validate},monitor={monitor}"] = statistics.median(runs)
    plain = medians["validate=False,monitor=False"]
    medians["validation_cost_s"] = medians["validate=True,monitor=False"] - plain
    medians["monitoring_cost_s"] = medians["validate=False,monitor=True"] - plain
    return medians


def validation_passes(df: DataFrame, rules: Sequence[Rule]) -> dict:
    """All rules in one pass, against one filter and count per rule."""

    def one_pass() -> list[int]:
        validator = Validator(rules)
        found = validator.rule_metrics(validator.tag(df)).orderBy("rule_order").collect()
        return [row.rows_failed for row in found]

    def rule_by_rule() -> list[int]:
        current, failed = df, []
        for rule in rules:
            tagged = Validator([rule]).tag(current)
            failed.append(rejected(tagged).count())
            current = passed(tagged)
        return failed

    return compare(one_pass, rule_by_rule, ("one_pass", "rule_by_rule"))


def overhead_of(extra: VersionedTable, base: VersionedTable) -> dict:
    """Storage of one stored table as a share of another."""
    sizes = [storage_footprint(t.spark, t.path) for t in (extra, base)]
    return storage_overhead(*sizes).first().asDict()


def run_timings(queries: Mapping[str, Callable[[], DataFrame]]) -> dict[str, float]:
    """Seconds to compute every query completely; rows go nowhere."""
    return {
        name: timed(lambda: build().write.format("noop").mode("overwrite").save())[0]
        for name, build in queries.items()
    }
