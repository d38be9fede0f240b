"""Starting streaming queries: checkpoints, triggers and publishing with retries."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tickloom.session import run_dir


def start(
    stream: DataFrame,
    on_batch: Callable[[DataFrame, int], None],
    mode: str = "append",
    checkpoint: str | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Run ``on_batch`` per micro-batch: every ``every`` ('1 minute'), or once over what is there.

    The batch is kept while it is used, since merging reads it several times; its size is bounded
    by the source's per-trigger limit and what is lost with an executor is recomputed. Streams run
    without adaptive execution, but a batch handed out here is an ordinary one, so it is turned on
    for the merging: skewed joins and small partitions are then dealt with at run time.
    """
    spark = stream.sparkSession

    def kept(batch: DataFrame, batch_id: int) -> None:
        conf = batch.sparkSession.conf
        before = conf.get("spark.sql.adaptive.enabled")
        conf.set("spark.sql.adaptive.enabled", "true")
        batch = batch.persist()
        try:
            on_batch(batch, batch_id)
        finally:
            batch.unpersist()
            conf.set("spark.sql.adaptive.enabled", before)

    writer = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(kept)
        .option("checkpointLocation", checkpoint or run_dir(spark, "checkpoint"))
    )
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def drain(query: StreamingQuery) -> None:
    """Wait for an available-now query and surface its error."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def publish_with_retry(
    publish: Callable[[DataFrame, int], None], attempts: int = 3, delay_s: float = 1.0
) -> Callable[[DataFrame, int], None]:
    """Skip empty batches; retry with doubling delay; then fail the batch, so that it is replayed."""
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        wait = delay_s
        for attempt in range(1, attempts + 1):
            try:
                publish(batch, batch_id)
                return
            except Exception:
                if attempt == attempts:
                    raise
                time.sleep(wait)
                wait *= 2

    return on_batch


def use_rocksdb(spark: SparkSession) -> None:
    """Large or arbitrary state belongs in the RocksDB provider."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
