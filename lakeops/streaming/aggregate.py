"""Running aggregate over a folder of files, whole result rewritten each run (complete output mode)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from lakeops.operators.writes import overwrite
from lakeops.sources.snapshot import CommitResult, SnapshotTable
from lakeops.streaming.ingest import STREAMING_WRITE, _last_batch


def stream_aggregate(
    spark: SparkSession,
    src: str,
    fmt: str,
    schema: T.StructType,
    keys: Sequence[str | Column],
    aggs: Sequence[Column],
    target: SnapshotTable,
    checkpoint: str,
    max_files: int = 10_000,
) -> list[CommitResult]:
    """Aggregate all files seen so far; only new ones are read, the rest is state in the checkpoint."""
    app = checkpoint.rstrip("/")
    results: list[CommitResult] = []

    def publish(batch: DataFrame, batch_id: int) -> None:
        if batch_id <= _last_batch(target, app):
            return
        table = SnapshotTable(batch.sparkSession, target.base, target.name)
        results.append(overwrite(batch, table, operation=STREAMING_WRITE, txn=(app, batch_id)))

    stream = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", max_files).load(src)
    query = (
        stream.groupBy(*keys)
        .agg(*aggs)
        .writeStream.outputMode("complete")
        .foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return results
