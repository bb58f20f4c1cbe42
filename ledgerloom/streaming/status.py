"""The status index of images: micro-batches in hash buckets of the image, folded bucket by bucket.

Below the root of a state lie ``batches/batch_id=N/bucket=B`` with the images that micro-batch N touched,
``snapshots/batch_id=N/bucket=B`` with all images of a bucket as of N, ``commits/N`` for every
finished micro-batch, and ``layout``, the number of buckets and how often each is folded. Bucket B
is folded at every N for which N + B is a multiple of ``every``, so each micro-batch folds its share
of the buckets, and which snapshot a bucket starts from follows from the number of the last commit.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import events as ev
from ..sources.tables import write_by_day

STATUS_SCHEMA = "image_id string, status string, attempts long, failures long, expires_at timestamp, last_at timestamp"

#: Buckets of a new state. A bucket's snapshot is what one task folds.
BUCKETS = 64

#: Micro-batches between two snapshots of a bucket.
COMPACT_EVERY = 24

_KINDS = ("batches", "snapshots")


@dataclass(frozen=True)
class Layout:
    """How a state is cut; fixed when it is created."""

    buckets: int
    every: int

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64("image_id"), F.lit(self.buckets)).cast("int")

    def due(self, batch_id: int) -> list[int]:
        """Buckets that are folded at ``batch_id``."""
        return [b for b in range(self.buckets) if (batch_id + b) % self.every == 0]

    def folded_at(self, batch_id: int) -> Column:
        """Number of the newest snapshot of the row's bucket as of ``batch_id``; negative before the first."""
        return F.lit(batch_id) - F.pmod(F.lit(batch_id) + F.col("bucket"), F.lit(self.every))


def read_layout(spark: SparkSession, root: str) -> Layout | None:
    """The layout of the state below ``root``; ``None`` where there is no state."""
    try:
        row = spark.read.schema("buckets int, every int").json(f"{root}/layout").first()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise
    return row and Layout(row["buckets"], row["every"])


def _created(spark: SparkSession, root: str, wanted: Layout) -> Layout:
    found = read_layout(spark, root)
    if found is None:
        spark.createDataFrame([(wanted.buckets, wanted.every)], "buckets int, every int").coalesce(1).write.mode("overwrite").json(f"{root}/layout")
        return wanted
    if found != wanted:
        raise ValueError(f"the state below {root} has {found}, not {wanted}")
    return found


def _numbers(spark: SparkSession, folder: str) -> dict[int, str]:
    """Entries ``N`` or ``name=N`` of a folder by N."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return {}
    entries = [e.getPath() for e in files.listStatus(path)]
    return {int(p.getName().rpartition("=")[2]): p.toString() for p in entries if p.getName().rpartition("=")[2].isdigit()}


def _commit(spark: SparkSession, root: str, batch_id: int) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/commits/{batch_id}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True).close()


def _remove_before(spark: SparkSession, root: str, limit: int) -> None:
    """Remove folders and commits with numbers up to ``limit``."""
    for kind in (*_KINDS, "commits"):
        for number, path in _numbers(spark, f"{root}/{kind}").items():
            if number <= limit:
                target = spark._jvm.org.apache.hadoop.fs.Path(path)
                target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _rows(spark: SparkSession, root: str, kind: str, first: int, last: int) -> DataFrame | None:
    """Rows of the folders ``first`` to ``last`` of a kind, with ``batch_id`` and ``bucket``."""
    paths = [p for n, p in sorted(_numbers(spark, f"{root}/{kind}").items()) if first <= n <= last]
    if not paths:
        return None
    reader = spark.read.schema(f"{STATUS_SCHEMA}, batch_id int, bucket int").option("basePath", f"{root}/{kind}")
    return reader.parquet(*paths)


def _log(spark: SparkSession, root: str, first: int, last: int, folded_at: Column, buckets: Sequence[int] | None) -> DataFrame | None:
    """Per bucket its snapshot ``folded_at`` and the micro-batches after it, up to ``last``.

    Both conditions are on folder names, so only the folders of the wanted buckets are opened.
    """
    parts = []
    for kind, wanted in zip(_KINDS, (F.col("batch_id") > folded_at, F.col("batch_id") == folded_at)):
        rows = _rows(spark, root, kind, first, last)
        if rows is not None:
            rows = rows if buckets is None else rows.where(F.col("bucket").isin(list(buckets)))
            parts.append(rows.where(wanted).drop("batch_id"))
    return parts[0].unionByName(parts[1]) if len(parts) == 2 else (parts[0] if parts else None)


def merge_status(log: DataFrame, *also: str) -> DataFrame:
    """Fold per-batch status rows into one row per image: last status, summed attempts."""
    last = F.max(F.struct("last_at", ev.status_rank().alias("rank"), "status"))
    return log.groupBy(*also, "image_id").agg(
        last.getField("status").alias("status"), F.sum("attempts").alias("attempts"),
        F.sum("failures").alias("failures"), F.min("expires_at").alias("expires_at"),
        last.getField("last_at").alias("last_at"),
    )


def read_status(
    spark: SparkSession, root: str, since: datetime | Column | None = None, buckets: Sequence[int] | None = None
) -> DataFrame | None:
    """Current status per image from the state written by ``track_status``, as of its last commit.

    ``since`` leaves out images that expired before it, decided on the whole of what is known
    about an image, not on single rows of the log. ``buckets`` reads only these; see ``touched_buckets``.
    """
    layout = read_layout(spark, root)
    newest = max(_numbers(spark, f"{root}/commits"), default=None) if layout else None
    if newest is None:
        return None
    log = _log(spark, root, newest - layout.every + 1, newest, layout.folded_at(newest), buckets)
    if log is None:
        return None
    status = merge_status(log)
    return status if since is None else status.where(F.col("expires_at") >= F.lit(since))


def track_status(
    events: DataFrame, root: str, checkpoint: str, compact_every: int = COMPACT_EVERY,
    max_age: str | None = None, buckets: int = BUCKETS,
) -> StreamingQuery:
    """Keep the image index: each micro-batch adds one row per image it touched, by bucket.

    Folders carry the number of the micro-batch, so one that runs again replaces itself. Each folds
    the buckets that are due, ``1 / compact_every`` of the state, out of their last snapshot and what
    came since; no other bucket is opened. Folders that no bucket needs are removed one round
    later, so neither the number of files nor a read grows with the age of the job. With
    ``max_age`` (an interval text) a snapshot leaves out images that had expired that long before its newest event.
    """
    spark = events.sparkSession
    layout = _created(spark, root, Layout(buckets, compact_every))

    def process(batch: DataFrame, batch_id: int) -> None:
        rows = ev.status_rows(batch).withColumn("bucket", layout.bucket())
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(f"{root}/batches/batch_id={batch_id}")
        due, before = layout.due(batch_id), batch_id - layout.every
        if due:
            folded = merge_status(_log(spark, root, before, batch_id, F.lit(before), due), "bucket")
            if max_age is not None:
                newest = folded.agg(F.max("last_at").alias("t")).first()["t"]
                folded = folded.where(F.col("expires_at") >= F.lit(newest) - F.expr(f"INTERVAL {max_age}"))
            (folded.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket")
             .parquet(f"{root}/snapshots/batch_id={batch_id}"))
        _commit(spark, root, batch_id)
        _remove_before(spark, root, batch_id - 2 * layout.every)

    return (
        events.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def process_new_images(
    events: DataFrame, state_root: str, output: str, checkpoint: str, tie_break: Sequence[str] = ("source",)
) -> StreamingQuery:
    """Pass on the images that are not yet done, once each per micro-batch, by day.

    A micro-batch looks into the buckets of its own images only.
    """
    spark = events.sparkSession

    def process(batch: DataFrame, batch_id: int) -> None:
        layout = read_layout(spark, state_root)
        bucket = layout.bucket() if layout else F.lit(None).cast("int")
        # At most one number per bucket.
        extent = batch.agg(F.count(F.lit(1)).alias("rows"), F.min("uploaded_at").alias("first"), F.collect_set(bucket).alias("buckets")).first()
        if not extent["rows"]:
            return
        status = read_status(spark, state_root, extent["first"], extent["buckets"])
        todo = ev.dedupe_images(batch, tie_break) if status is None else ev.skip_done(batch, status, tie_break)
        # The whole folder is replaced: an earlier attempt may have had other days.
        write_by_day(todo, f"{output}/batch_id={batch_id}", replace_all=True)

    return (
        events.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
