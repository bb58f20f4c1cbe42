"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Applied only where the launcher has not set a value. Partition counts are left
#: to AQE: it coalesces small shuffle partitions and splits skewed ones.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "ledgerloom", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the defaults above; ``extra`` maps config keys to values."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session without that setting gets a temporary folder; on a
    cluster a machine-local folder would be lost with its machine, so it is refused.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerloom-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def clean_scratch(spark: SparkSession, older_than_hours: float) -> int:
    """Remove what ``scratch_path`` gave out and nobody wrote to for so long; returns how many folders.

    Whoever runs the jobs owns the scratch folder. A frame may still read from a folder
    after the function that wrote it returned, so nothing is removed on the way; choose
    an age above that of the longest job.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/ledgerloom")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return 0
    limit = (time.time() - older_than_hours * 3600) * 1000
    old = [e.getPath() for e in files.listStatus(path) if e.getModificationTime() < limit]
    return sum(bool(files.delete(p, True)) for p in old)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is ever reused or overwritten."""
    return f"{shared_folder(spark)}/ledgerloom/{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable, keeping the cluster's own setting."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def settled(frame: DataFrame) -> DataFrame:
    """``frame`` computed once and stored in the checkpoint folder.

    For an expensive intermediate with several readers. It is stored where every
    executor can read it, so losing executors does not bring the work back.
    """
    ensure_checkpoint_dir(frame.sparkSession)
    return frame.checkpoint()
