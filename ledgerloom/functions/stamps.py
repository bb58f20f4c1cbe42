"""Run stamps carried in file and folder names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def run_stamp_of(file_name: Column) -> Column:
    """Timestamp (no zone) from a ``YYYYMMDD_HHMMSS`` run in a file name, else null."""
    stamp = F.regexp_extract(file_name, r"([0-9]{8}_[0-9]{6})", 1)
    return F.try_to_timestamp(F.nullif(stamp, F.lit("")), F.lit("yyyyMMdd_HHmmss")).cast("timestamp_ntz")
