"""Whole-table changes as pure functions: the caller writes the result to a new place.

Plain Parquet tables know no MERGE, UPDATE or DELETE, and a path must not be overwritten
while it is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.functions.times import at, days_before
from meterlake.operators.joins import lookup_join


def without_keys(table: DataFrame, gone: DataFrame, keys: list[str], small: bool | None = None) -> DataFrame:
    """Rows of ``table`` whose key does not occur in ``gone``."""
    listed = gone.select(*[F.col(k).alias(f"_gone_{k}") for k in keys]).distinct()
    return lookup_join(table, listed, [(k, f"_gone_{k}") for k in keys], "left_anti", small=small)


def upsert(table: DataFrame, changes: DataFrame, keys: list[str], small: bool | None = None) -> DataFrame:
    """Insert rows, replacing those with the same key.

    Changes that are costly to compute should pass ``small=False``: measuring them for a
    broadcast would compute them once more.
    """
    return without_keys(table, changes, keys, small).unionByName(changes)


def retain(table: DataFrame, day: str, as_of: str, days: int) -> DataFrame:
    """Drop rows older than a horizon."""
    return table.filter(F.col(day) >= F.to_date(days_before(at(as_of), days)))


def update(table: DataFrame, where: Column, values: dict[str, Column]) -> DataFrame:
    """Set columns in the rows that satisfy a predicate."""
    hit = F.coalesce(where, F.lit(False))
    return table.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in values.items()})


def cleared(table: DataFrame) -> DataFrame:
    """An empty table of the same schema, such as staging after a merge."""
    return table.filter(F.lit(False))


def first_rows(table: DataFrame, where: Column, by: str, n: int, key: str) -> DataFrame:
    """Keys of at most ``n`` matching rows in a stated order; a top-n, never a global sort."""
    return table.filter(where).orderBy(by).select(key).limit(n)


def run_log(
    rows: DataFrame, name: str, version: str, started: str, ended: str, executor: str
) -> DataFrame:
    """One execution-log row about a table just built."""
    return rows.agg(F.count(F.lit(1)).alias("rows_processed")).select(
        F.lit(name).alias("transformation_name"),
        F.lit(version).alias("version"),
        at(started).alias("execution_start"),
        at(ended).alias("execution_end"),
        F.lit("SUCCESS").alias("status"),
        "rows_processed",
        F.lit(executor).alias("executed_by"),
    )
