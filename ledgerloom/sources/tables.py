"""Typed loads and partitioned tables."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import rules
from .sinks import read_records


def _or_fail(value: Column, source: Column, kind: str, what: str) -> Column:
    shown = F.concat(F.lit(f"bad {what}: "), F.coalesce(source.cast("string"), F.lit("null")))
    return F.coalesce(value, F.raise_error(shown).cast(kind))


def typed_members(accepted: DataFrame) -> DataFrame:
    """The accepted output with real types. A malformed birthday or flag stops the load."""
    flag = F.lower(F.btrim(F.col("above_18").cast("string"), F.lit(rules.WHITESPACE)))
    birthday = F.when(
        F.col("birthday").rlike(r"\A[0-9]{8}\z"), F.try_to_date("birthday", rules.BIRTHDAY_OUT)
    )
    boolean = F.when(flag == "true", F.lit(True)).when(flag == "false", F.lit(False))
    return accepted.select(
        "membership_id", "first_name", "last_name", "email",
        _or_fail(birthday, F.col("birthday"), "date", "birthday").alias("birthday"),
        _or_fail(boolean, F.col("above_18"), "boolean", "above_18").alias("above_18"),
        "mobile",
    )


def latest_run(spark: SparkSession, output: str, side: str = "successful", fmt: str = "parquet") -> DataFrame:
    """Rows of one output of the newest finished run, chosen by its stamp, not by file times.

    Stamps come from the run records, one small file per run, which are written last; a
    run that failed half-way has none. Then one folder is read.
    """
    try:
        newest = read_records(spark, output).agg(F.max(F.col("run_ts").cast("string")).alias("stamp")).first()["stamp"]
    except AnalysisException as error:
        raise FileNotFoundError(f"no finished run below {output}") from error
    reader = spark.read.option("basePath", f"{output}/{side}")
    if fmt == "csv":
        reader = reader.option("header", True).option("escape", '"').option("multiLine", True)
    return reader.format(fmt).load(f"{output}/{side}/run_ts={newest}")


def read_in_order(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """A written Parquet folder with the columns that give its row order, and their names.

    Part files are numbered in write order, so this is the order of a run written
    with ``in_order``.
    """
    place = {"_file": F.col("_metadata.file_name"), "_index": F.col("_metadata.row_index")}
    return spark.read.parquet(path).withColumns(place), list(place)


def write_partitioned(
    frame: DataFrame, root: str, column: str, mode: str = "overwrite", replace_all: bool = False
) -> None:
    """Parquet in one folder per value of ``column``; a rewrite replaces only its own folders,
    or all of them with ``replace_all``.

    The rebalance hint gathers each value's rows into few files, splits a value that is
    much larger than the others, and keeps small ones from becoming many small files.
    """
    (
        frame.hint("rebalance", column).write.mode(mode)
        .option("partitionOverwriteMode", "static" if replace_all else "dynamic").partitionBy(column).parquet(root)
    )


def write_by_day(frame: DataFrame, root: str, mode: str = "overwrite", replace_all: bool = False) -> None:
    """``write_partitioned`` by ``dt``."""
    write_partitioned(frame, root, "dt", mode, replace_all)


def day_folders(spark: SparkSession, root: str, first: str | date, last: str | date) -> list[str]:
    """Folders of the days ``first`` to ``last`` that exist.

    Their names follow from the bounds, so each is looked up by itself and the table is not listed:
    the work depends on the days that are asked for, not on those that are stored.
    """
    start, end = (date.fromisoformat(str(d)) for d in (first, last))
    path = spark._jvm.org.apache.hadoop.fs.Path
    names = [f"{root}/dt={start + timedelta(n)}" for n in range((end - start).days + 1)]
    files = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    return [n for n in names if files.exists(path(n))]


def read_days(spark: SparkSession, root: str, first: str, last: str | None = None, schema: str | None = None) -> DataFrame:
    """Days ``first`` to ``last`` of a table written by ``write_by_day``.

    With both bounds only the folders of these days are looked at (``day_folders``); days that are missing hold
    no rows. ``schema`` (without ``dt``) spares the look into a file, and is needed where the table may be
    missing altogether. Without ``last`` the table's folders are listed and the others are not opened.
    """
    reader = spark.read if schema is None else spark.read.schema(f"{schema}, dt date")
    after = F.col("dt") >= F.lit(first).cast("date")
    if last is None:
        return reader.parquet(root).where(after)
    folders = day_folders(spark, root, first, last)
    if folders:
        return reader.option("basePath", root).parquet(*folders).where(after & (F.col("dt") <= F.lit(last).cast("date")))
    return spark.createDataFrame([], f"{schema}, dt date") if schema is not None else spark.read.parquet(root).limit(0)


def write_by_month(transactions: DataFrame, root: str) -> None:
    """Transactions in ``month=YYYY-MM`` folders."""
    month = F.date_format(F.to_date("transaction_ts"), "yyyy-MM")
    write_partitioned(transactions.withColumn("month", month), root, "month")


def read_months(spark: SparkSession, root: str, first: str, last: str) -> DataFrame:
    """Months ``first`` to ``last`` (``YYYY-MM``) of ``write_by_month``; others are not opened."""
    month = F.col("month").cast("string")
    return spark.read.parquet(root).where((month >= first) & (month <= last))


def read_months_of(spark: SparkSession, root: str, calendar: DataFrame, wanted: Column) -> DataFrame:
    """Transactions of ``write_by_month`` in the months of ``calendar`` (month, ...) that are ``wanted``, with its columns.

    Which folders are opened is known only when the calendar has been read: Spark sends the months it
    found to the scan (dynamic partition pruning). A calendar has a row a month, so it is broadcast.
    """
    months = calendar.where(wanted).withColumn("month", F.col("month").cast("string"))
    stored = spark.read.option("basePath", root).schema(_with_text_month(spark, root)).parquet(root)
    return stored.join(F.broadcast(months), "month")


def _with_text_month(spark: SparkSession, root: str) -> StructType:
    """The table's schema with the folder name as text, as it is written."""
    found = spark.read.parquet(root).schema
    return StructType([StructField(f.name, StringType() if f.name == "month" else f.dataType) for f in found])


def calendar_months(spark: SparkSession, first: str, last: str) -> DataFrame:
    """(month, quarter, year) for the months ``first`` to ``last``, both ``YYYY-MM``."""
    start, end = (F.to_date(F.lit(f"{m}-01")) for m in (first, last))
    days = spark.range(1).select(F.explode(F.sequence(start, end, F.expr("INTERVAL 1 MONTH"))).alias("day"))
    quarter = F.concat(F.year("day").cast("string"), F.lit("-Q"), F.quarter("day").cast("string"))
    return days.select(F.date_format("day", "yyyy-MM").alias("month"), quarter.alias("quarter"), F.year("day").alias("year"))
