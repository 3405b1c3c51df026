"""Lake tables, catalog tables and the union of trip products."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.functions.times import date_key
from meterlake.sources.landing import by_header


def partitioned(spark: SparkSession, root: str) -> DataFrame:
    """A year/month/day table with its partition columns, so that filters prune folders."""
    return spark.read.parquet(root)


def days_from(trips: DataFrame, first: Column) -> DataFrame:
    """The day folders from the day of an instant on.

    A range on the timestamp alone opens every file to look at its statistics; this
    condition is on partition columns, so the other folders are not even listed. A table
    without those columns is returned as it is.
    """
    if not {"pickup_year", "pickup_month", "pickup_day"} <= set(trips.columns):
        return trips
    folder = F.col("pickup_year") * 10_000 + F.col("pickup_month") * 100 + F.col("pickup_day")
    return trips.filter(folder >= date_key(first))


def partitioned_from_paths(spark: SparkSession, root: str, ts: str = "tpep_pickup_datetime") -> DataFrame:
    """The same table read file by file: partition values are recovered from each file's
    path, or from the timestamp where the path has none."""
    files = spark.read.option("recursiveFileLookup", True).parquet(root)
    return with_path_partitions(files, ts)


def with_path_partitions(files: DataFrame, ts: str) -> DataFrame:
    path, at = F.col("_metadata.file_path"), F.col(ts)

    def from_path(name: str, fallback: Column) -> Column:
        return F.coalesce(F.regexp_extract(path, rf"{name}=(\d+)", 1).try_cast("int"), fallback)

    return files.withColumns(
        {
            "pickup_year": from_path("pickup_year", F.year(at)),
            "pickup_month": from_path("pickup_month", F.month(at)),
            "pickup_day": from_path("pickup_day", F.dayofmonth(at)),
        }
    )


def master(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def weather(spark: SparkSession, path: str) -> DataFrame:
    """Daily observations, Parquet or headered CSV."""
    if path.rstrip("/").endswith(".csv"):
        declared = (
            "date DATE, precipitation DOUBLE, snow_depth DOUBLE, snowfall DOUBLE,"
            " max_temperature INT, min_temperature INT, average_wind_speed DOUBLE"
        )
        return by_header(spark, path, T.StructType.fromDDL(declared))
    return spark.read.parquet(path)


def union_products(products: dict[str, tuple[DataFrame, dict[str, str]]], cab_types: dict[str, int]) -> DataFrame:
    """Trips of several products in one table, tagged with their cab type.

    Each product comes with a map from its column names to the common ones; columns a
    product lacks are NULL.
    """
    parts = [
        df.select(
            *[F.col(c).alias(names.get(c, c)) for c in df.columns], F.lit(cab_types[product]).alias("cab_type_id")
        )
        for product, (df, names) in products.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
