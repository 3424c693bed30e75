"""The update step fed by a folder of arriving files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from curbside.plans.incremental import UpdateOptions, apply_update
from curbside.sources.spec import DatasetSpec


def stream_updates(
    spark: SparkSession,
    root: str,
    spec: DatasetSpec,
    folder: str,
    schema: StructType | str,
    checkpoint: str,
    options: UpdateOptions = UpdateOptions(),
) -> StreamingQuery:
    """Apply every file not seen yet, then stop.

    No state is kept in the stream: duplicates are decided against the target table, so a batch
    that is replayed after a failure inserts nothing twice.
    """

    def apply(batch: DataFrame, epoch: int) -> None:
        apply_update(batch.sparkSession, root, spec, batch, f"{spec.name}-{epoch}", options)

    source = spark.readStream.schema(schema)
    if spec.format == "csv":
        source = source.option("header", True)
    return (
        source.format(spec.format)
        .load(folder)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
