"""Bad-row removal with a reject count per rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.functions.times import elapsed_seconds


def trip_rules(max_minutes: int = 1440) -> dict[str, Column]:
    """Name and predicate of each way a raw trip can be bad."""
    c = F.col
    seconds = elapsed_seconds(c("tpep_pickup_datetime"), c("tpep_dropoff_datetime"))
    return {
        "missing_location": c("pulocationid").isNull() | c("dolocationid").isNull(),
        "negative_fare": c("fare_amount") < 0,
        "impossible_duration": seconds.isNull() | (seconds <= 0) | (seconds > max_minutes * 60),
        "corrupted_fields": c("trip_distance").isNull() | c("passenger_count").isNull() | c("vendorid").isNull(),
    }


def coordinate_rules(bounds: tuple[float, float, float, float]) -> dict[str, Column]:
    """For trips with coordinates: both ends known and inside (west, south, east, north)."""
    west, south, east, north = bounds

    def outside(end: str) -> Column:
        x, y = F.col(f"{end}_longitude"), F.col(f"{end}_latitude")
        return x.isNull() | y.isNull() | ~x.between(west, east) | ~y.between(south, north)

    return {"invalid_coordinates": outside("pickup") | outside("dropoff")}


def good_rows(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that break no rule; a rule that is unknown for a row does not reject it."""
    keep = F.lit(True)
    for bad in rules.values():
        keep = keep & ~F.coalesce(bad, F.lit(False))
    return df.filter(keep)


def reject_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row: rows seen, rows per broken rule, and rows kept, from a single pass."""
    broken = {n: F.coalesce(p, F.lit(False)) for n, p in rules.items()}
    anything = F.lit(False)
    for p in broken.values():
        anything = anything | p
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(p).alias(n) for n, p in broken.items()],
        F.count_if(~anything).alias("kept_rows"),
    )
