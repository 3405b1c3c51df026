"""Partitioned tables, mapped tables, split exports and logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DAY = ("pickup_year", "pickup_month", "pickup_day")


def write_partitioned(
    df: DataFrame, path: str, by: Sequence[str] = DAY, sort: Sequence[str] = (), replace_all: bool = False
) -> None:
    """Parquet folders per partition value.

    Only the partitions present in ``df`` are replaced, so a rerun of some days leaves the
    others alone. Rows are rebalanced by partition value first: at run time, small shuffle
    partitions are merged and a day that holds most rows is split, which gives files of
    even size. Sorting inside a file lets readers skip row groups.
    """
    rows = df.hint("rebalance", *[F.col(c) for c in by])
    if sort:
        rows = rows.sortWithinPartitions(*by, *sort)
    mode = "static" if replace_all else "dynamic"
    rows.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(*by).parquet(path)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def append(df: DataFrame, path: str) -> None:
    """Add rows, such as log or audit records."""
    df.write.mode("append").parquet(path)


def apply_mapping(df: DataFrame, mapping: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Columns renamed and cast: (source name, target name, target type). A value that does
    not fit the target type becomes NULL."""
    return df.select(*[F.col(source).try_cast(kind).alias(target) for source, target, kind in mapping])


def save_table(df: DataFrame, name: str, path: str | None = None, mode: str = "overwrite") -> None:
    """A catalog table, kept at ``path`` or in the warehouse folder."""
    writer = df.write.mode(mode)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def save_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], connections: int = 16) -> None:
    """Rows to a relational table over a bounded number of connections."""
    df.repartition(connections).write.mode("append").jdbc(url, table, properties=properties)


def export_csv(df: DataFrame, path: str, rows_per_file: int = 20_000_000) -> None:
    """Compressed CSV files of at most ``rows_per_file`` rows."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("maxRecordsPerFile", rows_per_file)
        .option("compression", "gzip")
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(path)
    )
