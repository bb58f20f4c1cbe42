"""Image-event streams: landing, deduplication, hourly counts.

The functions take any streaming frame; ``kafka_messages`` is the production source.
Watermarks need a zoned timestamp, so ``uploaded_at`` must be ``timestamp``.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import rules
from ..operators import events as ev

#: State of streams on disk, its changes (not whole copies) written to the checkpoint.
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

#: How late an event may be and still count in its hour.
LATE_BY = "1 hour"


def kafka_messages(spark: SparkSession, servers: str, topic: str = "image-events", **options: str) -> DataFrame:
    """Message texts of a Kafka topic. Needs Spark's Kafka package on the class path."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    for key, value in {"subscribe": topic, "startingOffsets": "earliest", **options}.items():
        reader = reader.option(key, value)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def first_deliveries(events: DataFrame, window: str = f"{rules.RETENTION_DAYS} days") -> DataFrame:
    """One row per image within the retention window; state older than it is dropped,
    and so are events later than it."""
    return events.withWatermark("uploaded_at", window).dropDuplicatesWithinWatermark(["image_id"])


def hourly_counts(events: DataFrame, late_by: str = LATE_BY) -> DataFrame:
    """Uploads per hour and source. In append mode an hour is emitted once it is closed."""
    return ev.uploads_per_hour(events.withWatermark("uploaded_at", late_by))


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB: on the executors' disks, with changes
    written to the checkpoint, so seven days of image ids need not fit the heap."""
    before = {key: spark.conf.get(key, None) for key in ROCKSDB}
    for key, value in ROCKSDB.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@dataclass(frozen=True)
class Finished:
    """A run of a stream that came to its end: micro-batches, rows read, and rows refused as too late."""

    batches: int
    rows: int
    refused: int


def finished(spark: SparkSession, query: StreamingQuery) -> Finished:
    """Wait for a run and add up what it read and what its watermark refused.

    A deduplication counts refused events; a windowed count sums its rows per task and window first, and counts these sums.
    Spark remembers fewer micro-batches than ``spark.sql.streaming.numRecentProgressUpdates``; a run of as
    many raises, as its counts may not be whole.
    """
    query.awaitTermination()
    progress = query.recentProgress
    if len(progress) >= int(spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")) - 1:
        raise RuntimeError("a longer run than Spark remembers: raise spark.sql.streaming.numRecentProgressUpdates")
    return Finished(
        len({p["batchId"] for p in progress if p["numInputRows"]}), sum(p["numInputRows"] for p in progress),
        sum(o["numRowsDroppedByWatermark"] for p in progress for o in p["stateOperators"]),
    )


def land_by_day(events: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Append a stream of events (with ``dt``) to ``dt=`` folders, each event once."""
    return (
        events.writeStream.format("parquet").partitionBy("dt").option("path", root)
        .option("checkpointLocation", checkpoint).outputMode("append")
        .trigger(availableNow=True).start()
    )


def write_appended(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to a Parquet folder; the sink's log makes each batch count once."""
    return (
        stream.writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).outputMode("append")
        .trigger(availableNow=True).start()
    )
