"""Hourly onboarding as an ``availableNow`` stream over a folder."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .. import rules
from ..operators.applications import clean, validate
from ..sources.batches import scan_batches
from ..sources.sinks import write_outputs

#: The fixed schema of Spark's binaryFile source.
_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def stream_applications(
    spark: SparkSession,
    input_folder: str,
    output: str,
    checkpoint: str,
    reference: date = rules.REFERENCE_DATE,
    fmt: str = "parquet",
    max_files: int | None = None,
    archive: str | None = None,
) -> StreamingQuery:
    """Process the files that arrived since the last start, each once, then stop.

    The stream carries file paths only; each micro-batch is read by header name as
    in a batch run (a CSV stream would bind columns by position). Outputs go to
    ``successful/batch_id=N`` and ``unsuccessful/batch_id=N``, so a micro-batch that
    runs again replaces itself. Without new files nothing is written. With ``archive``
    Spark moves finished files there, under their full path; it does so when a later
    batch commits, and the checkpoint keeps files apart whether they moved or not.
    """
    # The content column is never selected, so no file is loaded whole.
    source = (
        spark.readStream.format("binaryFile").schema(_FILE_SCHEMA).option("pathGlobFilter", rules.BATCH_GLOB)
    )
    if max_files:
        source = source.option("maxFilesPerTrigger", max_files)
    if archive:
        source = source.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    source = source.load(input_folder).select("path")

    def process(batch: DataFrame, batch_id: int) -> None:
        files = sorted(r["path"] for r in batch.collect())
        if not files:
            return
        validated = validate(clean(scan_batches(spark, files), reference))
        write_outputs(validated, output, f"batch_id={batch_id}", fmt, files=len(files))

    return (
        source.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
