"""Snapshots as they arrive: each new file once, with a checkpoint in place of looking for what is done."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from deedloom.sources.sinks import write_partitioned


def stream_snapshots(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, process: Callable[[DataFrame], DataFrame], by: str = "snapshot_date", kind: str = "parquet", files_a_batch: int = 1) -> StreamingQuery:
    """A query that runs ``process`` on each batch of new files and writes its result by partition; ends when all are done.

    A title's rows are all in one snapshot's file, so what ``process`` does within titles is complete in a batch. A batch
    that runs again after a failure replaces its partitions, so each is written once.
    """
    new = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).format(kind).load(source)

    def write(batch: DataFrame, _: int) -> None:
        write_partitioned(process(batch), target, by)

    return new.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
