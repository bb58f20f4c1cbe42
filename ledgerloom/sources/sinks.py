"""The two outputs of a run and its audit record."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from .. import rules
from ..operators import applications as ap

FORMATS = ("parquet", "csv")


#: Columns of a run's audit record.
RECORD_SCHEMA = "files int, rows_read long, rows_successful long, rows_unsuccessful long"


@dataclass(frozen=True)
class Written:
    """A finished run: its folder name, rows (``read`` and per output) and the output folders."""

    run: str
    rows: Mapping[str, int]
    folders: Mapping[str, str]
    files: int = 0


def write_record(spark: SparkSession, output: str, written: Written) -> None:
    """The audit row of a run, below ``runs``. It is written last: a run without one is not finished."""
    counted = [written.rows[k] for k in ("read", "successful", "unsuccessful")]
    row = spark.createDataFrame([(written.files, *counted)], RECORD_SCHEMA)
    row.coalesce(1).write.mode("overwrite").json(f"{output}/runs/{written.run}")


def read_records(spark: SparkSession, output: str) -> DataFrame:
    """Audit rows of all finished runs below ``output``, with the folder column of the run."""
    return spark.read.schema(RECORD_SCHEMA).json(f"{output}/runs")


def write_frame(frame: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Write one folder, replacing what an earlier attempt left there.

    CSV keeps spaces at the ends of fields and tells '' from null.
    """
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}")
    writer = frame.write.mode("overwrite")
    if fmt == "csv":
        (writer.option("header", True).option("escape", '"').option("emptyValue", '""')
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    else:
        writer.parquet(path)
    return path


def write_outputs(
    validated: DataFrame,
    output: str,
    run: datetime | str,
    fmt: str = "parquet",
    keep: StorageLevel | None = StorageLevel.MEMORY_AND_DISK,
    order_by: Sequence[str] = (),
    files: int = 0,
) -> Written:
    """Write both outputs under one run name, count while writing, and record the run.

    ``run`` is the time of the run (folder ``run_ts=stamp``) or a folder name. ``keep``
    holds the validated rows between the two writes. Pass ``None`` when the batch is
    larger than the cluster's disks: the input is then scanned twice. Input rows are
    counted before the split and must equal the sum of the two outputs; only then is the
    run recorded. ``order_by`` sorts the outputs (a range shuffle); without it rows stay
    where they were read.
    """
    name = run if isinstance(run, str) else f"run_ts={run.strftime(rules.RUN_STAMP)}"
    frame = validated.orderBy(*order_by) if order_by else validated
    frame = frame.persist(keep) if keep is not None else frame
    sides = {"successful": ap.successful, "unsuccessful": ap.unsuccessful}
    seen = {side: Observation() for side in ("read", *sides)}
    folders = {}
    try:
        for side, pick in sides.items():
            # The rows that are read are counted on their way into the first output.
            source = frame if folders else frame.observe(seen["read"], F.count(F.lit(1)).alias("rows"))
            rows = pick(source).observe(seen[side], F.count(F.lit(1)).alias("rows"))
            folders[side] = write_frame(rows, f"{output}/{side}/{name}", fmt)
    finally:
        if keep is not None:
            frame.unpersist()
    rows = {side: o.get.get("rows", 0) for side, o in seen.items()}
    if rows["read"] != rows["successful"] + rows["unsuccessful"]:
        raise RuntimeError(f"rows lost or doubled: {rows}")
    written = Written(name, rows, folders, files)
    write_record(validated.sparkSession, output, written)
    return written
