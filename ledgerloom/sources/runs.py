"""One whole onboarding run over a folder of batches."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import rules
from ..operators.applications import clean, validate
from .batches import POSITION, discover_batches, scan_batches
from .sinks import Written, write_outputs


def _recorded(spark: SparkSession, ledger: str, stamp: str) -> DataFrame | None:
    """Files that runs other than ``stamp`` have finished; ``None`` before the first run."""
    try:
        done = spark.read.schema("path string, run_ts string").json(ledger)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise
    return done.where(F.col("run_ts") != stamp)


def run(
    spark: SparkSession,
    input_folder: str,
    output: str,
    run_ts: datetime | None = None,
    reference: date = rules.REFERENCE_DATE,
    ledger: str | None = None,
    fmt: str = "parquet",
    in_order: bool = False,
) -> Written:
    """Process the batches waiting in ``input_folder``; no batches is a success.

    ``ledger`` is a folder recording finished files, so the next run leaves them
    out; it is written after the outputs, and a failed run can simply be repeated.
    Repeating a run with its own ``run_ts`` processes the same files again and
    replaces its outputs. Without a ledger every file in the folder is processed.
    ``in_order`` writes rows in input order: files by name, rows as in the file.
    """
    run_ts = run_ts or datetime.now()
    stamp = run_ts.strftime(rules.RUN_STAMP)
    finished = _recorded(spark, ledger, stamp) if ledger else None
    files = discover_batches(spark, input_folder, finished=finished)
    if not files:
        return Written("", dict.fromkeys(("read", "successful", "unsuccessful"), 0), {})

    rows = scan_batches(spark, files, positions=in_order)
    order = POSITION if in_order else ()
    written = write_outputs(
        validate(clean(rows, reference)), output, run_ts, fmt, order_by=order, files=len(files)
    )
    if ledger:
        entries = spark.createDataFrame([(f, stamp) for f in files], "path string, run_ts string")
        entries.coalesce(1).write.mode("overwrite").json(f"{ledger}/run={stamp}")
    return written
