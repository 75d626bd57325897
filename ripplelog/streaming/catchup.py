"""Catching up with a staged log: reads what is there, or up to a position, then stops; restarts go on where it stopped.

Offsets are the stream's checkpoint. Every batch writes a new version of the target, named after the batch, and then
moves a small pointer file: a batch that is repeated writes the same version again, and nobody reads half of one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession

from ripplelog.sources import log_source
from ripplelog.sources.versions import VersionedTable
from ripplelog.streaming.dedup import STATE_STORE, newest, place

def catch_up(
    spark: SparkSession, source: str, schema, target: VersionedTable, checkpoint: str, key: Iterable[str], order: Callable[[], Column], rows: Callable[[DataFrame], DataFrame] = lambda x: x, files_a_batch: int = 100
) -> None:
    """Brings `target` up to date with the log files in `source` and returns."""
    stream = rows(spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(source))

    def write(batch: DataFrame, batch_id: int) -> None:
        target.upsert(batch, batch_id, key, order())

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def append(spark: SparkSession, source: str, schema, target: str, checkpoint: str, rows: Callable[[DataFrame], DataFrame] = lambda x: x, files_a_batch: int = 100) -> None:
    """Adds every event to `target`; the file sink writes each batch once."""
    stream = rows(spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(source))
    stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def follow(
    spark: SparkSession, source: str, schema, target: VersionedTable, checkpoint: str, key: Iterable[str], rows: Callable[[DataFrame], DataFrame] = lambda x: x, start: tuple[str, int] | None = None, end: tuple[str, int] | None = None
) -> None:
    """Brings `target` up to date with a staged log (sources.log_source) up to the position `end`, or to what is there, and
    returns; the next call goes on at the position where this one stopped, in the middle of a file too.

    rows: what to make of the log's events; the result has the key and the log's position. Each key's last position is the
    stream's state, so that events which come again or late change nothing, and a batch writes the parts of the target that
    its keys are in and reads no other.
    """
    log_source.register(spark)
    stream = spark.readStream.format(log_source.FORMAT).schema(schema).options(**log_source.options(source, start, end)).load()
    news = newest(rows(stream).withColumn("_place", place()), key)

    def write(batch: DataFrame, batch_id: int) -> None:
        target.upsert(batch.drop("_place"), batch_id, key)

    before = {k: spark.conf.get(k, None) for k in STATE_STORE}
    for k, v in STATE_STORE.items():
        spark.conf.set(k, v)
    try:
        news.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
