"""Surrogate keys and change ids without funnelling a table through one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.session import scratch_path

ROWS_PER_BUCKET = 1_000_000


def numbered(
    df: DataFrame, by: str, name: str, start: int = 1, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Consecutive numbers in the order of a unique column of any orderable type.

    Rows are range-partitioned by the column into buckets of about ``rows_per_bucket`` and stored in
    the shared folder with their bucket. They are numbered inside it and shifted by the number of
    rows in earlier buckets, so no task sees more than a bucket. Only the bucket counts, one row
    per bucket, meet in one task.
    """
    spark, total = df.sparkSession, df.count()
    buckets = max(1, -(-total // rows_per_bucket))
    if buckets == 1:
        rank = F.row_number().over(Window.orderBy(by))
        return df.withColumn(name, (rank + (start - 1)).cast("bigint"))
    path = scratch_path(spark, "numbered")
    ranged = df.repartitionByRange(buckets, by).withColumn("_bucket", F.spark_partition_id())
    ranged.write.parquet(path)
    placed = spark.read.schema(ranged.schema).parquet(path)
    sizes = placed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("_bucket").alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy(by))
    shifted = placed.withColumn("_rank", rank).join(offsets, F.col("_bucket") == F.col("_of"))
    return shifted.withColumn(name, (F.col("_before") + F.col("_rank") + (start - 1)).cast("bigint")).drop(
        "_bucket", "_rank", "_before", "_of"
    )


def highest(df: DataFrame, column: str) -> int:
    """The largest key in use, 0 for an empty table."""
    return df.agg(F.max(column)).first()[0] or 0


def with_surrogate_keys(
    new_rows: DataFrame, existing: DataFrame, natural_key: str, surrogate: str
) -> DataFrame:
    """Keys for new dimension members, continuing after those in use."""
    return numbered(new_rows, natural_key, surrogate, highest(existing, surrogate) + 1)


def with_change_id(changes: DataFrame, last_id: int, order_by: str, name: str = "change_id") -> DataFrame:
    """A rising id per actual change."""
    return numbered(changes, order_by, name, last_id + 1)


def marked(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit("\\N"))


def row_hash(columns: list[str]) -> Column:
    """Digest of the listed columns in which NULL differs from empty text."""
    return F.md5(F.concat_ws("|", *[marked(F.col(c)) for c in columns]))
