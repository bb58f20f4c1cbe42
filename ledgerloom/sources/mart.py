"""Sales tables stored so that their usual joins move nothing: hash buckets, sorted, one file each.

Baskets and their lines lie in equal buckets of the transaction; members and a second copy of the
baskets in equal buckets of the member. Spark then joins and groups bucket by bucket without an exchange.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Buckets of each table; a bucket is what one task reads.
BUCKETS = 256

#: A key with more rows than this many average buckets makes its bucket a long task.
HOT_BUCKETS = 4

_LARGEST = "largest_key_share"


@dataclass(frozen=True)
class Mart:
    """Names of the stored tables: by transaction ``headers`` and ``lines``, by member ``members`` and ``purchases``."""

    prefix: str

    @property
    def headers(self) -> str:
        return f"{self.prefix}_headers"

    @property
    def lines(self) -> str:
        return f"{self.prefix}_lines"

    @property
    def members(self) -> str:
        return f"{self.prefix}_members"

    @property
    def purchases(self) -> str:
        return f"{self.prefix}_purchases"

    @property
    def tables(self) -> tuple[str, ...]:
        return (self.headers, self.lines, self.members, self.purchases)


def store_bucketed(frame: DataFrame, name: str, key: str, buckets: int = BUCKETS) -> None:
    """Save ``frame`` as a table in sorted buckets of ``key``, one file per bucket.

    Rows are shuffled by the same hash that buckets use, so each task writes one bucket. The share of the rows
    that the most frequent key holds is kept with the table; ``bucketed`` looks at it.
    """
    spark = frame.sparkSession
    frame.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    counted = spark.table(name).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    share = counted.agg(F.coalesce(F.max("n") / F.sum("n"), F.lit(0.0)).alias("share")).first()["share"]
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{_LARGEST}' = '{float(share)}')")


def bucketed(spark: SparkSession, name: str) -> DataFrame:
    """A table of ``store_bucketed`` for joins and groups by its key.

    Where one key holds more than ``HOT_BUCKETS`` average buckets the plain files are read instead: then the rows are
    shuffled as usual, with partial sums and AQE's skew handling. The rows are the same.
    """
    told = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    detail = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    if float(told.get(_LARGEST, 0)) * int(detail["Num Buckets"]) > HOT_BUCKETS:
        return spark.read.schema(spark.table(name).schema).parquet(detail["Location"])
    return spark.table(name)


def store_mart(prefix: str, members: DataFrame, transactions: DataFrame, lines: DataFrame, buckets: int = BUCKETS) -> Mart:
    """Store the three tables, baskets twice; ``prefix`` may name a database."""
    mart = Mart(prefix)
    store_bucketed(transactions, mart.headers, "transaction_id", buckets)
    store_bucketed(lines, mart.lines, "transaction_id", buckets)
    store_bucketed(members, mart.members, "membership_id", buckets)
    store_bucketed(transactions, mart.purchases, "membership_id", buckets)
    return mart


def drop_mart(spark: SparkSession, mart: Mart) -> None:
    for name in mart.tables:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
