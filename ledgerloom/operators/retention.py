"""Seven-day retention: what is expired, what stays, the deletion manifest and the sweep."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import rules
from ..session import settled


def _limit(events: DataFrame, cutoff: datetime, days: int) -> Column:
    """The oldest upload time that is kept, as a constant of the column's own type.

    A cut-off with a zone is that instant, also for times stored without zone, which are
    in UTC; one without zone is a time of the session's zone or, without zone, as it is.
    """
    kind = dict(events.dtypes)["uploaded_at"]
    moment = cutoff.astimezone(timezone.utc).replace(tzinfo=None) if cutoff.tzinfo else cutoff
    text = moment.isoformat(sep=" ", timespec="microseconds")
    if kind == "timestamp" and cutoff.tzinfo:
        text += "+00:00"
    return F.lit(text).cast(kind) - F.expr(f"INTERVAL {days} DAYS")


def expired(events: DataFrame, cutoff: datetime, days: int = rules.RETENTION_DAYS) -> DataFrame:
    """Rows uploaded more than ``days`` days before ``cutoff``."""
    return events.where(F.col("uploaded_at") < _limit(events, cutoff, days))


def kept(events: DataFrame, cutoff: datetime, days: int = rules.RETENTION_DAYS) -> DataFrame:
    """The other rows; an unknown upload time is kept, it cannot be shown to be old."""
    return events.where(F.coalesce(F.col("uploaded_at") >= _limit(events, cutoff, days), F.lit(True)))


def manifest(events: DataFrame, cutoff: datetime, days: int = rules.RETENTION_DAYS) -> DataFrame:
    """Per ``dt``: rows, expired rows, and what the sweep does with the partition.

    ``drop`` when every row is expired, ``rewrite`` when some are, else ``keep``.
    """
    old = F.coalesce(F.col("uploaded_at") < _limit(events, cutoff, days), F.lit(False))
    return (
        events.groupBy("dt")
        .agg(F.count(F.lit(1)).alias("objects"), F.count_if(old).alias("objects_older_than_7d"))
        .withColumn(
            "action",
            F.when(F.col("objects_older_than_7d") == F.col("objects"), "drop")
            .when(F.col("objects_older_than_7d") > 0, "rewrite")
            .otherwise("keep"),
        )
    )


def due_days(events: DataFrame, cutoff: datetime, days: int = rules.RETENTION_DAYS) -> DataFrame:
    """Events of the days up to the limit's own day; other partitions are not opened.

    The limit's day counts one day more, for tables whose days are those of another zone.
    """
    last = F.date_add(F.to_date(_limit(events, cutoff, days)), 1)
    return events.where(F.col("dt") <= last)


def sweep_table(
    spark: SparkSession, table: str, cutoff: datetime, days: int = rules.RETENTION_DAYS
) -> DataFrame:
    """Remove every expired row of a managed table partitioned by ``dt``.

    Days that are expired as a whole are dropped in one statement; a day that is expired in
    part is written anew with the rows that stay. Only the days up to the limit are read.
    Returns the manifest of what was done; one row per such day comes to the driver.
    """
    events = spark.table(table)
    done = (
        manifest(due_days(events, cutoff, days), cutoff, days).where("action <> 'keep'")
        .withColumn("swept_at", F.lit(cutoff.isoformat(sep=" "))).orderBy("dt").collect()
    )
    partly = [r["dt"] for r in done if r["action"] == "rewrite"]
    if partly:
        # Stored first: a table cannot be replaced while it is read.
        stay = settled(kept(events.where(F.col("dt").isin(partly)), cutoff, days))
        for day in partly:
            rows = stay.where(F.col("dt") == F.lit(day)).drop("dt")
            spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (dt = DATE'{day.isoformat()}') SELECT * FROM {{rows}}", rows=rows)
    whole = ", ".join(f"PARTITION (dt = DATE'{r['dt'].isoformat()}')" for r in done if r["action"] == "drop")
    if whole:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {whole}")
    schema = "dt date, objects long, objects_older_than_7d long, action string, swept_at string"
    return spark.createDataFrame(done, schema)
