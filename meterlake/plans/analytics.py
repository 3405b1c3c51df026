"""Questions asked of the combined trips table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.functions.exact import cents, exact_avg, rounded_avg, scaled
from meterlake.functions.times import at
from meterlake.operators.joins import lookup_join


def by_cab_type(trips: DataFrame, cab_types: DataFrame) -> DataFrame:
    per_id = trips.groupBy("cab_type_id").agg(F.count(F.lit(1)).alias("n"))
    named = lookup_join(per_id, cab_types, [("cab_type_id", "id")], "inner")
    return (
        named.groupBy(F.col("type").alias("cab_type"))
        .agg(F.sum("n").alias("trip_count"))
        .orderBy(F.desc("trip_count"), "cab_type")
    )


def by_payment(trips: DataFrame) -> DataFrame:
    """Average fare, tip and tip share per payment type, over trips with a positive fare."""
    share = F.try_divide(cents("tip_amount").cast("double"), F.nullif(cents("fare_amount"), F.lit(0)).cast("double"))
    return (
        trips.filter(F.col("fare_amount") > 0)
        .groupBy("payment_type")
        .agg(
            F.count(F.lit(1)).alias("trips"),
            rounded_avg("fare_amount").alias("avg_fare"),
            rounded_avg("tip_amount").alias("avg_tip"),
            F.round(F.avg(share) * 100, 1).alias("tip_pct"),
        )
        .orderBy(F.desc("trips"), "payment_type")
    )


def top_neighbourhoods(trips: DataFrame, areas: DataFrame, k: int = 20) -> DataFrame:
    """Pickups per neighbourhood; trips are counted per area id before names are joined."""
    per_id = trips.groupBy("pulocationid").agg(F.count(F.lit(1)).alias("n"))
    named = lookup_join(per_id, areas, [("pulocationid", "gid")], "inner")
    return (
        named.groupBy(F.col("ntaname").alias("neighborhood"))
        .agg(F.sum("n").alias("pickups"))
        .orderBy(F.desc("pickups"), "neighborhood")
        .limit(k)
    )


def by_hour_with_weather(trips: DataFrame, weather: DataFrame) -> DataFrame:
    """Trips per hour of day and the mean precipitation of their days.

    Trips are counted per day and hour first, so the weather join sees at most 24 rows
    per day; the mean is weighted by those counts and skips days without observation.
    """
    pickup = F.col("tpep_pickup_datetime")
    counted = trips.groupBy(F.to_date(pickup).alias("trip_date"), F.hour(pickup).alias("hour_of_day")).agg(
        F.count(F.lit(1)).alias("n")
    )
    observed = weather.select(F.col("date").alias("_date"), "precipitation")
    joined = lookup_join(counted, observed, [("trip_date", "_date")])
    rain = F.when(F.col("precipitation").isNotNull(), F.col("n"))
    return (
        joined.groupBy("hour_of_day")
        .agg(
            F.sum("n").alias("trips"),
            F.try_divide(
                F.sum(scaled("precipitation") * F.col("n")).cast("double"), F.sum(rain) * F.lit(10000.0)
            ).alias("avg_precip"),
        )
        .orderBy("hour_of_day")
    )


def daily_trend(trips: DataFrame, first: str, last: str) -> DataFrame:
    """Trips per day between two instants, both included; the range reaches the scan."""
    pickup = F.col("tpep_pickup_datetime")
    return (
        trips.filter(pickup.between(at(first), at(last)))
        .groupBy(F.to_date(pickup).alias("trip_date"))
        .agg(F.count(F.lit(1)).alias("daily_trips"))
        .orderBy("trip_date")
    )


def fare_by_year(trips: DataFrame) -> DataFrame:
    return (
        trips.groupBy(F.year("tpep_pickup_datetime").alias("year"))
        .agg(F.count(F.lit(1)).alias("trips"), exact_avg("fare_amount").alias("avg_fare"))
        .orderBy("year")
    )
