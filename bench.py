"""Timings. Prints one JSON line; `--experiments` prints the variant comparisons instead.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local threads.
"""

from __future__ import annotations

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from curbside.plans import experiments as ex
from curbside.plans.ingest import integrated_table
from curbside.plans.training import compare_inputs
from curbside.session import fresh_folder, get_spark, settle
from curbside.sources.lookups import condition_buckets, condition_labels
from curbside.sources.tables import VersionedTable
from curbside.star import bindings as b
from curbside.star.queries import FEATURES, LINES_SPEC, QUERIES

HEADLINE = (
    "integrated_trips",
    "monthly_zone_demand",
    "metric_by_bucket",
    "demand_by_band",
    "zone_variation",
    "top_hours_per_weekday",
    "monthly_trends",
    "zone_stats",
    "band_impact_summary",
    "borough_summary",
    "weekday_summary",
    "clean_dataset",
    "rule_duplicate",
    "validate_waterfall",
    "validate_rule_metrics",
    "merge_insert_only",
    "incremental_update",
    "update_batch",
    "layout_partitioned",
    "mon_runtime_change",
    "feature_by_category",
    "feature_by_hour",
    "feature_correlation",
    "training_set",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    if "--experiments" in sys.argv:
        print(json.dumps(run_experiments(spark, folder), indent=1))
        return
    builders = {name: (lambda name=name: QUERIES[name](spark, folder)) for name in HEADLINE}
    ex.run_timings(builders)  # warm-up
    seconds = ex.run_timings(builders)
    rounded = {name: round(value, 3) for name, value in seconds.items()}
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": rounded,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


def run_experiments(spark, folder: str) -> dict:
    labels, buckets = condition_labels(spark), condition_buckets(spark)
    hourly = settle(b.integrated(spark, folder), "hourly")
    root = fresh_folder(spark, "bench")
    months = integrated_table(spark, root)
    months.overwrite(b.month_trips(spark, folder))
    trips = months.read()
    wide = hourly.withColumns({"passenger_count": ex.F.lit(1), "airport_fee": ex.F.lit(0.0),
                               "total_amount": hourly.fare_amount})
    base, _ = b.base_and_update(spark, folder)
    VersionedTable(spark, root, "lines").overwrite(base)
    batch = b.table(spark, folder, "lineitem").where(f"l_shipdate >= timestamp_ntz'{b.UPDATE_FROM}'")
    adaptive = ex.adaptive(spark, trips)
    priced = b.priced_lines(spark, folder)
    stored = settle(priced, "priced")
    return {
        "caching": ex.caching(wide, labels, buckets),
        "pruning": ex.pruning(trips, *b.MONTHS),
        "broadcasting": ex.broadcasting(spark, hourly, labels, buckets),
        "adaptive": {k: v for k, v in adaptive.items() if not k.endswith("_plan")},
        "layouts": ex.layouts(spark, trips),
        "validation": ex.validation_passes(b.shipments(spark, folder), b.shipment_rules(spark, folder)),
        "update_overhead": ex.update_overhead(spark, root, LINES_SPEC, batch),
        "storage_overhead": ex.overhead_of(
            VersionedTable(spark, root, "rejects_lines"), VersionedTable(spark, root, "lines")
        ),
        "inputs": compare_inputs(
            {"raw": lambda: priced, "stored": lambda: stored}, **FEATURES, keys=b.LINE_ROW_KEYS
        ),
    }


if __name__ == "__main__":
    main()
