"""Image events: parsing, rules, deduplication, status and metrics.

An event row holds ``image_id, source, uploaded_at, status`` and, once processed,
``processed_at, duration_ms, format, bytes_in, bytes_out, error``. All functions
also accept streaming frames where they only project, filter or union.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from .. import rules
from ..session import settled
from .applications import Rule
from .quantiles import exact_percentiles, percentiles_of_counts
from .sampling import keep_first

# Statuses and the percentiles of the latency report.
PENDING, DONE, ERROR = "PENDING", "DONE", "ERROR"
LATENCY_PERCENTILES = {"p50": 0.50, "p95": 0.95, "p99": 0.99}

#: The JSON message of the image topic.
EVENT_SCHEMA = StructType([
    StructField("image_id", StringType()),
    StructField("s3_key", StringType()),
    StructField("size", LongType()),
    StructField("content_type", StringType()),
    StructField("uploaded_at", TimestampType()),
])

#: One metadata record per processed image, in column order; ``dt`` is the partition.
METADATA_COLUMNS = {
    "image_id": "string", "source": "string", "uploaded_at": "timestamp", "processed_at": "timestamp",
    "duration_ms": "bigint", "width": "int", "height": "int", "format": "string", "bytes_in": "bigint",
    "bytes_out": "bigint", "status": "string", "error": "string", "dt": "date",
}


def parse_events(messages: DataFrame, value: str = "value") -> DataFrame:
    """Fields of JSON messages plus ``dt``; text that is not such a message gives nulls."""
    parsed = F.from_json(F.col(value).cast("string"), EVENT_SCHEMA)
    return messages.select(parsed.alias("_event")).select("_event.*").withColumn(
        "dt", F.to_date("uploaded_at")
    )


def metadata_records(events: DataFrame) -> DataFrame:
    """One record per event in the layout of the metadata table.

    An end of processing that is not given follows from the upload time and the
    duration, the day from the upload time; fields the events do not carry are null.
    """
    ended = F.col("uploaded_at") + F.make_dt_interval(secs=F.col("duration_ms") / 1000)
    if "processed_at" in events.columns:
        ended = F.coalesce("processed_at", ended)
    known = events.withColumns({"processed_at": ended, "dt": F.to_date("uploaded_at")})
    absent = {c: F.lit(None).cast(t) for c, t in METADATA_COLUMNS.items() if c not in known.columns}
    return known.withColumns(absent).select(*METADATA_COLUMNS)


def event_rules(content_types: Iterable[str], max_bytes: int) -> tuple[Rule, ...]:
    """Upload rules: accepted content type, declared size within the limit."""
    return (
        Rule("unsupported_content_type", F.col("content_type").isin(list(content_types))),
        Rule("size_over_limit", (F.col("size") > 0) & (F.col("size") <= max_bytes)),
    )


def union_sources(by_source: Mapping[str, DataFrame]) -> DataFrame:
    """One frame from several ingestion paths, columns matched by name, tagged ``source``."""
    tagged = [frame.withColumn("source", F.lit(name)) for name, frame in by_source.items()]
    if not tagged:
        raise ValueError("no sources given")
    out = tagged[0]
    for other in tagged[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def dedupe_images(events: DataFrame, tie_break: Sequence[str] = ("source",)) -> DataFrame:
    """The earliest upload of each image over all paths and redeliveries."""
    return keep_first(events, ["image_id"], ["uploaded_at", *tie_break])


def status_rank() -> Column:
    """Which status wins among events of the same time: a finished image stays finished."""
    status = F.col("status")
    return F.when(status == DONE, 3).when(status == ERROR, 2).when(status == PENDING, 1).otherwise(0)


def status_rows(events: DataFrame, order: Sequence[str] = ("uploaded_at",)) -> DataFrame:
    """``latest_status`` with ``last_at``, the time of the last event."""
    last = F.max(F.struct(*order, status_rank().alias("rank"), "status"))
    return events.groupBy("image_id").agg(
        last.getField("status").alias("status"),
        F.count(F.lit(1)).alias("attempts"),
        F.count_if(F.col("status") == ERROR).alias("failures"),
        (F.min("uploaded_at") + F.expr(f"INTERVAL {rules.RETENTION_DAYS} DAYS")).alias("expires_at"),
        last.getField(order[0]).alias("last_at"),
    )


def latest_status(events: DataFrame, order: Sequence[str] = ("uploaded_at",)) -> DataFrame:
    """Status per image after its last event, its attempts, and when it expires.

    Events that ``order`` leaves equal are decided by ``status_rank``. One aggregation with map-side partials: an image with very many redeliveries
    is one row per task before the shuffle.
    """
    return status_rows(events, order).drop("last_at")


def routed(status: DataFrame, max_attempts: int = rules.MAX_ATTEMPTS) -> DataFrame:
    """``latest_status`` with the next step: ``done``, ``wait``, ``retry`` or ``dead_letter``."""
    route = (
        F.when(F.col("status") == DONE, "done")
        .when(F.col("status") != ERROR, "wait")
        .when(F.col("failures") >= max_attempts, "dead_letter")
        .otherwise("retry")
    )
    return status.withColumn("route", route)


def dead_letters(
    events: DataFrame, max_attempts: int = rules.MAX_ATTEMPTS, order: Sequence[str] = ("uploaded_at",)
) -> DataFrame:
    """Images whose last event failed after at least ``max_attempts`` failures."""
    return routed(latest_status(events, order), max_attempts).where("route = 'dead_letter'").drop("route")


def skip_done(incoming: DataFrame, status: DataFrame, tie_break: Sequence[str] = ("source",)) -> DataFrame:
    """Incoming images still to be processed: first delivery each, unless already done.

    Deduplicated before the anti-join, so both sides hold one row per image.
    """
    done = status.where(F.col("status") == DONE).select("image_id")
    return dedupe_images(incoming, tie_break).join(done, "image_id", "left_anti")


def uploads_per_hour(events: DataFrame) -> DataFrame:
    """Uploads per event-time hour and source. With a watermark this also runs as a stream."""
    return (
        events.groupBy(F.window("uploaded_at", "1 hour"), "source")
        .agg(F.count(F.lit(1)).alias("uploads"))
        .select(F.col("window.start").alias("hour_start"), "source", "uploads")
    )


def latency_percentiles(events: DataFrame, groups: Sequence[str] = ("source",)) -> DataFrame:
    """Exact processing-time percentiles per group, in milliseconds."""
    return exact_percentiles(events, groups, "duration_ms", LATENCY_PERCENTILES)


def _rate() -> Column:
    return F.round(F.col("failed") / F.col("images"), 6)


def failure_rate_daily(events: DataFrame) -> DataFrame:
    """Images, failed images and their ratio per day."""
    return events.groupBy("dt").agg(
        F.count(F.lit(1)).alias("images"),
        F.count_if(F.col("status") == ERROR).alias("failed"),
    ).withColumn("failure_rate", _rate())


def format_mix(events: DataFrame) -> DataFrame:
    """Images per format and their share. The window runs over one row per format."""
    return (
        events.groupBy("format").agg(F.count(F.lit(1)).alias("images"))
        .withColumn("share", F.round(F.col("images") / F.sum("images").over(Window.partitionBy()), 6))
    )


def daily_metrics(events: DataFrame) -> DataFrame:
    """Counts, bytes, failure rate and latency percentiles per day and source.

    Holds no image id, so it may outlive the retention window.
    """
    groups = ["dt", "source"]
    # The events are read once: everything below is derived from these counts.
    per_value = settled(
        events.groupBy(*groups, "duration_ms").agg(
            F.count(F.lit(1)).alias("images"),
            F.count_if(F.col("status") == ERROR).alias("failed"),
            F.sum("bytes_in").alias("bytes_in"),
        )
    )
    totals = per_value.groupBy(*groups).agg(
        *[F.sum(c).alias(c) for c in ("images", "failed", "bytes_in")]
    ).withColumn("failure_rate", _rate())
    latency = percentiles_of_counts(per_value, groups, "duration_ms", "images", LATENCY_PERCENTILES)
    latency = latency.withColumnsRenamed({"dt": "_dt", "source": "_source"})
    same = F.col("dt").eqNullSafe(F.col("_dt")) & F.col("source").eqNullSafe(F.col("_source"))
    return totals.join(latency, same, "left").select(
        *groups, "images", "failed", "failure_rate", "bytes_in", *LATENCY_PERCENTILES
    )
