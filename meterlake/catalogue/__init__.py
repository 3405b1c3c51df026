"""Named queries over the supplied tables, each with an independent SQL statement."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

MODULES = ("lake", "files", "warehouse", "analytics", "summaries", "quality", "history", "governance")


def present(df: DataFrame) -> DataFrame:
    """Plain result types, equal in every engine: text for dates, BIGINT, DOUBLE."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("date", "timestamp", "timestamp_ntz"):
            c = c.cast("string")
        elif kind in ("tinyint", "smallint", "int"):
            c = c.cast("bigint")
        elif kind == "float" or kind.startswith("decimal"):
            c = c.cast("double")
        out.append(c.alias(name))
    return df.select(*out)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where one exists, the SQL that must give the same rows."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return present(build(spark, sf_dir))

        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def load() -> None:
    for module in MODULES:
        import_module(f"{__name__}.{module}")
