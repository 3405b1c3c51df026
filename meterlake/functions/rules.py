"""Row predicates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

POSITIVE = ("passenger_count", "trip_distance", "fare_amount", "total_amount")
REQUIRED = (
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "vendorid",
    "ratecodeid",
    "pulocationid",
    "dolocationid",
)
RESOLVED = ("vendor_name", "rate_code_desc", "pu_zone", "do_zone")


def every(predicates: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, predicates)


def some(predicates: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, predicates)


def valid_trip() -> Column:
    """Positive measures, both times and all four master keys."""
    return every(
        [F.col(c) > 0 for c in POSITIVE] + [F.col(c).isNotNull() for c in REQUIRED]
    )


def resolved(columns: tuple[str, ...] = RESOLVED) -> Column:
    return every([F.col(c).isNotNull() for c in columns])


def blank(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""


def within_month(ts: Column, year: int, month: int) -> Column:
    """One calendar month as a range on the timestamp, so file statistics can prune."""
    after = f"{year + month // 12:04d}-{month % 12 + 1:02d}-01"
    return (ts >= F.lit(f"{year:04d}-{month:02d}-01").cast("timestamp_ntz")) & (
        ts < F.lit(after).cast("timestamp_ntz")
    )
