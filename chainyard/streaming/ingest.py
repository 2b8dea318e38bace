"""File-triggered incremental ingestion with Structured Streaming.

A file-source stream over a landing folder, run with
``trigger(availableNow=True)`` from the scheduler: each run processes every
file that arrived since the previous run (the checkpoint keeps the set of
files already read -- each file is loaded exactly once) and then stops.
Each micro-batch is upserted into a versioned table with the keyed merge,
so a batch replayed after a crash (published, but its offset not yet
committed) merges to the same result: the merge is idempotent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from chainyard.operators.merge import merge_incremental
from chainyard.store import TableStore


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json",
                max_files_per_trigger: int | None = None, **options) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path)


def merge_stream_into(stream: DataFrame, store: TableStore, table: str, key,
                      checkpoint: str, layer: str | None = None,
                      order_by=("_ingestion_timestamp",)) -> int:
    """Run the stream to exhaustion (available-now) merging each
    micro-batch into ``table``; returns the number of batches run."""
    batches = []

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        target = store.read(table, layer)
        store.commit(table, merge_incremental(target, batch, key, order_by, stored=True), layer)
        batches.append(epoch_id)

    q = (stream.writeStream.foreachBatch(upsert)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return len(batches)
