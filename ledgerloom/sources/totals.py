"""Basket totals kept up to date by signed changes: what a feed added less what it took away.

Below the root of the kept totals lie ``base/feed=N``, all totals after feed N, and ``deltas/feed=M``, the
signed sums of every later feed. The totals are the sums of both, so no line outside a feed is ever
read again. A feed that is applied once more replaces its own delta, or is ignored when the base holds it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: A line as a change feed shows it, before and after the change.
LINE_IMAGE = "struct<transaction_id:bigint,quantity:int,unit_cost_at_purchase:decimal(10,2),unit_weight_at_purchase:decimal(8,3)>"

#: What is kept per transaction.
TOTALS_SCHEMA = "transaction_id long, price decimal(22,2), weight decimal(22,3), line_count long"


def change(op: str, before: Column | None = None, after: Column | None = None) -> list[Column]:
    """Columns of a change feed: ``op`` and both images of the line; an insert has no ``before``, a delete no ``after``."""
    images = {"before": before, "after": after}
    return [F.lit(op).alias("op")] + [
        (F.lit(None) if image is None else image).cast(LINE_IMAGE).alias(name) for name, image in images.items()
    ]


def line_image(**changed: Column) -> Column:
    """The image of the line in the current row, with some columns replaced."""
    names = ("transaction_id", "quantity", "unit_cost_at_purchase", "unit_weight_at_purchase")
    return F.struct(*[changed.get(n, F.col(n)).alias(n) for n in names])


def _sums(signed: DataFrame) -> DataFrame:
    """Totals per transaction of lines with a ``sign``. Partial sums are made before the shuffle."""
    quantity = F.col("sign") * F.col("quantity")
    return signed.groupBy("transaction_id").agg(
        F.coalesce(F.sum(quantity * F.col("unit_cost_at_purchase")), F.lit(0)).cast("decimal(22,2)").alias("price"),
        F.coalesce(F.sum(quantity * F.col("unit_weight_at_purchase")), F.lit(0)).cast("decimal(22,3)").alias("weight"),
        F.sum("sign").cast("long").alias("line_count"),
    )


def signed_totals(feed: DataFrame) -> DataFrame:
    """What a feed changes per transaction: new images added, old ones retracted.

    A moved line retracts from the basket it left and adds to the one it joined. An image that is
    null, or belongs to no transaction, counts nothing; a transaction whose changes cancel out stays in
    the list with zeros, as it was touched.
    """
    sides = F.array(F.struct(F.lit(-1).alias("sign"), F.col("before").alias("line")), F.struct(F.lit(1).alias("sign"), F.col("after").alias("line")))
    lines = feed.select(F.explode(sides).alias("side")).select("side.sign", "side.line.*").where(F.col("transaction_id").isNotNull())
    return _sums(lines)


def _folders(spark: SparkSession, folder: str) -> dict[int, str]:
    """Finished folders ``feed=N`` by N; the writer's last file marks them."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return {}
    done = [e.getPath() for e in files.listStatus(path) if files.exists(jvm.org.apache.hadoop.fs.Path(e.getPath(), "_SUCCESS"))]
    return {int(p.getName().partition("=")[2]): p.toString() for p in done}


def _base(spark: SparkSession, root: str) -> tuple[int, str]:
    found = _folders(spark, f"{root}/base")
    if not found:
        raise FileNotFoundError(f"no kept totals below {root}")
    return max(found.items())


def create_totals(lines: DataFrame, root: str) -> None:
    """Totals of all lines, the state before the first feed. The only time that lines are read."""
    _sums(lines.withColumn("sign", F.lit(1))).write.mode("overwrite").parquet(f"{root}/base/feed=0")


def apply_feed(spark: SparkSession, root: str, number: int, feed: DataFrame) -> bool:
    """Keep the signed totals of feed ``number`` (from 1, ascending); False when the base holds it already.

    Feeds may be applied in any order, and any of them again: sums don't depend on the order.
    """
    if number <= _base(spark, root)[0]:
        return False
    signed_totals(feed).write.mode("overwrite").parquet(f"{root}/deltas/feed={number}")
    return True


def _deltas(spark: SparkSession, root: str, after: int) -> list[tuple[int, str]]:
    return sorted((n, p) for n, p in _folders(spark, f"{root}/deltas").items() if n > after)


def read_totals(spark: SparkSession, root: str) -> DataFrame:
    """(transaction_id, price, weight, line_count) after all feeds applied so far.

    A transaction that lost its last line stays with zeros.
    """
    number, base = _base(spark, root)
    paths = [base, *[p for _, p in _deltas(spark, root, number)]]
    rows = spark.read.schema(TOTALS_SCHEMA).parquet(*paths)
    if len(paths) == 1:
        return rows
    return rows.groupBy("transaction_id").agg(
        F.sum("price").cast("decimal(22,2)").alias("price"), F.sum("weight").cast("decimal(22,3)").alias("weight"),
        F.sum("line_count").alias("line_count"))


def touched_totals(spark: SparkSession, root: str, since: int) -> DataFrame:
    """Totals of the transactions touched by feeds from ``since`` on: what to merge into the headers."""
    if since <= _base(spark, root)[0]:
        raise ValueError(f"feed {since} is part of the base already")
    paths = [p for n, p in _deltas(spark, root, 0) if n >= since]
    totals = read_totals(spark, root)
    if not paths:
        return totals.limit(0)
    touched = spark.read.schema(TOTALS_SCHEMA).parquet(*paths).select("transaction_id").distinct()
    return totals.join(touched, "transaction_id", "left_semi")


def fold_totals(spark: SparkSession, root: str) -> int:
    """Fold the deltas into a new base; returns the number of the last feed it holds.

    The base before it stays until the next fold, for readers that have opened it; folders it holds are
    removed then. Feeds must have come without a gap up to the last one: a late feed would be ignored.
    """
    number, _ = _base(spark, root)
    deltas = _deltas(spark, root, number)
    if not deltas:
        return number
    last = deltas[-1][0]
    if [n for n, _ in deltas] != list(range(number + 1, last + 1)):
        raise ValueError(f"feeds {number + 1} to {last} have gaps")
    read_totals(spark, root).write.mode("overwrite").parquet(f"{root}/base/feed={last}")
    for kind in ("base", "deltas"):
        for old, path in _folders(spark, f"{root}/{kind}").items():
            if old < number or (kind == "deltas" and old <= number):
                target = spark._jvm.org.apache.hadoop.fs.Path(path)
                target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    return last


def broken_totals(totals: DataFrame) -> DataFrame:
    """Transactions that no set of lines can have: a feed retracted what was never there, or was applied to other lines."""
    none_left = (F.col("line_count") == 0) & ((F.col("price") != 0) | (F.col("weight") != 0))
    return totals.where((F.col("line_count") < 0) | (F.col("price") < 0) | (F.col("weight") < 0) | none_left)
