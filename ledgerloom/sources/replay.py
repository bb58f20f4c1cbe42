"""Runs compared by checksums of hash buckets; only buckets that differ are opened.

A run kept for comparison has its rows in ``rows/bucket=B``, by a hash of the whole row, and a
``checksums`` table with one line per bucket. Equal bags of rows have equal checksums whatever the
order or the files, so two equal runs are told from these lines alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.quality import replay_difference

#: Buckets of a kept run, the unit that is compared row by row.
BUCKETS = 256

_BUCKET, _HALF = "bucket", (1 << 32) - 1


def _row_hash(frame: DataFrame, seed: int) -> Column:
    """64 bits of a whole row. Spark's hash passes over nulls, so where they are is hashed as well; maps go as JSON."""
    values = [F.to_json(F.col(f"`{n}`")) if t.startswith("map") else F.col(f"`{n}`") for n, t in frame.dtypes]
    nulls = F.concat(F.lit(f"{seed}:"), *[F.when(F.col(f"`{n}`").isNull(), "1").otherwise("0") for n in frame.columns])
    return F.xxhash64(nulls, *values)


def checksums(frame: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, rows, and three sums) of a frame; at most ``buckets`` lines, merged in each task before the shuffle.

    Halves of two hashes are added up, so copies count as often as they are there.
    """
    first, second = _row_hash(frame, 1), _row_hash(frame, 2)
    hashed = frame.select(F.pmod(first, F.lit(buckets)).cast("int").alias(_BUCKET), first.alias("h"), second.alias("g"))
    return hashed.groupBy(_BUCKET).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("h").bitwiseAND(_HALF)).alias("low"),
        F.sum(F.shiftrightunsigned("h", 32)).alias("high"), F.sum(F.col("g").bitwiseAND(_HALF)).alias("other"),
    )


def keep_run(frame: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Store ``frame`` by buckets with its checksums. Its columns are kept; none may be called ``bucket``."""
    if _BUCKET in (c.lower() for c in frame.columns):
        raise ValueError(f"a column is called {_BUCKET}")
    spark = frame.sparkSession
    placed = frame.withColumn(_BUCKET, F.pmod(_row_hash(frame, 1), F.lit(buckets)).cast("int"))
    (placed.hint("rebalance", _BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy(_BUCKET).parquet(f"{path}/rows"))
    kept = spark.read.schema(placed.schema).parquet(f"{path}/rows").drop(_BUCKET)
    checksums(kept, buckets).withColumn("buckets", F.lit(buckets)).coalesce(1).write.mode("overwrite").parquet(f"{path}/checksums")
    # The columns, for a run without rows.
    frame.limit(0).write.mode("overwrite").parquet(f"{path}/columns")


def differing_buckets(spark: SparkSession, first: str, second: str) -> list[int]:
    """Buckets of two kept runs whose checksums differ. Reads one line per bucket and run."""
    lines = [spark.read.parquet(f"{path}/checksums") for path in (first, second)]
    sizes = {r["buckets"] for frame in lines for r in frame.select("buckets").distinct().collect()}
    if len(sizes) > 1:
        raise ValueError(f"the runs were kept in different numbers of buckets: {sorted(sizes)}")
    columns = [c for c in lines[0].columns if c not in (_BUCKET, "buckets")]
    told = lines[0].select(_BUCKET, F.struct(*columns).alias("a")).join(lines[1].select(_BUCKET, F.struct(*columns).alias("b")), _BUCKET, "full")
    return sorted(r[_BUCKET] for r in told.where(~F.col("a").eqNullSafe(F.col("b"))).collect())


def _rows(spark: SparkSession, path: str, buckets: list[int]) -> DataFrame:
    schema = spark.read.parquet(f"{path}/columns").schema
    if not buckets:
        return spark.createDataFrame([], schema)
    # Folder names decide, so other buckets are neither opened nor read.
    rows = spark.read.schema(f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in schema)}, {_BUCKET} int").parquet(f"{path}/rows")
    return rows.where(F.col(_BUCKET).isin(buckets)).drop(_BUCKET)


def kept_difference(spark: SparkSession, first: str, second: str) -> DataFrame:
    """``replay_difference`` of two kept runs: equal ones are told by their checksums, others by the buckets that differ."""
    buckets = differing_buckets(spark, first, second)
    return replay_difference(_rows(spark, first, buckets), _rows(spark, second, buckets))
