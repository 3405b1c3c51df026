"""Master data seeded from constants.

Built from SQL VALUES, so the optimizer knows their few bytes and no Python worker starts.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from meterlake import schemas as S


def _literal(value: Any) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, str):
        escaped = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"
    return str(value)


def values(spark: SparkSession, columns: Sequence[str], rows: Sequence[Sequence[Any]]) -> DataFrame:
    """An inline table. Columns are ``name type`` pairs."""
    names = [c.split(" ", 1)[0] for c in columns]
    body = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    casts = ", ".join(
        f"CAST({n} AS {c.split(' ', 1)[1]}) AS {n}" for n, c in zip(names, columns, strict=True)
    )
    return spark.sql(f"SELECT {casts} FROM VALUES {body} AS t({', '.join(names)})")


def vendors(spark: SparkSession) -> DataFrame:
    rows = [(i, n) for i, n, _ in S.VENDORS if i != S.UNKNOWN_VENDOR]
    return values(spark, ["vendor_id int", "vendor_name string"], rows)


def rate_codes(spark: SparkSession) -> DataFrame:
    return values(spark, ["rate_code_id int", "rate_code_desc string"], S.LAKE_RATE_CODES)


def cab_types(spark: SparkSession) -> DataFrame:
    return values(spark, ["id int", "type string"], S.CAB_TYPES)


def masters(spark: SparkSession, zones: DataFrame) -> dict[str, DataFrame]:
    """The three master tables of the lake."""
    return {"vendor": vendors(spark), "rate_code": rate_codes(spark), "taxi_zone": zones}
