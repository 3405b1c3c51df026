"""Landing to validated to curated, and the hourly zone-pair KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.functions import features as X
from meterlake.functions.casts import cast_if_present
from meterlake.functions.exact import SCALE, exact_avg, exact_sum, units_sum
from meterlake.functions.rules import RESOLVED, resolved, valid_trip
from meterlake.functions.times import elapsed_seconds, fractional_minutes
from meterlake.operators.joins import fits_broadcast, lookup_join

NUMERIC = ["passenger_count", "trip_distance", "fare_amount", "total_amount", "tip_amount"]
MASTER_KEYS = ["vendorid", "ratecodeid", "pulocationid", "dolocationid"]
ROUTE_HOUR = [
    "pickup_year",
    "pickup_month",
    "pickup_day",
    "pickup_hour",
    "pickup_day_of_week",
    "pickup_day_of_month",
    "pulocationid",
    "dolocationid",
]


class GateFailure(Exception):
    """Too few trips resolve against the masters."""


def validate(raw: DataFrame) -> DataFrame:
    """Typed rows with positive measures, both times and all master keys."""
    typed = cast_if_present(raw, NUMERIC, "double")
    return cast_if_present(typed, MASTER_KEYS, "int").filter(valid_trip())


def featurise(
    trips: DataFrame, long_miles: float = 20, short_miles: float = 1, high_tip: int = 20
) -> DataFrame:
    """Duration, tip share, calendar columns and trip flags."""
    pickup, dropoff = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    tip, fare, miles = F.col("tip_amount"), F.col("fare_amount"), F.col("trip_distance")
    return trips.withColumns(
        {
            "trip_duration_minutes": fractional_minutes(pickup, dropoff),
            "tip_pct": X.tip_percent(tip, fare),
            "pickup_hour": F.hour(pickup),
            "pickup_day_of_week": F.dayofweek(pickup),
            "pickup_day_of_month": F.dayofmonth(pickup),
            "is_long_trip": X.flag(miles > long_miles),
            "is_short_trip": X.flag(miles < short_miles),
            "high_tip_flag": X.flag(X.tip_share_above(tip, fare, high_tip)),
            "pickup_year": F.year(pickup),
            "pickup_month": F.month(pickup),
            "pickup_day": F.dayofmonth(pickup),
        }
    )


def enrich(
    trips: DataFrame, vendors: DataFrame, rates: DataFrame, zones: DataFrame
) -> DataFrame:
    """Attach vendor, rate code and both zones; the trip keeps one key per entity."""
    vendor = vendors.select(F.col("vendor_id").alias("_vendor"), "vendor_name")
    rate = rates.select("rate_code_id", "rate_code_desc")
    out = lookup_join(trips, vendor, [("vendorid", "_vendor")]).drop("_vendor")
    out = lookup_join(out, rate, [("ratecodeid", "rate_code_id")]).drop("rate_code_id")
    return _with_zones(out, zones, ["locationid", "borough", "zone", "service_zone"])


def _with_zones(rows: DataFrame, zones: DataFrame, columns: list[str]) -> DataFrame:
    """Both zones of a trip; the master's size is checked once for its two roles."""
    zones = zones.select(*columns)
    small = fits_broadcast(zones)
    for role in ("pu", "do"):
        named = zones.select(*[F.col(c).alias(f"{role}_{c}") for c in columns])
        key = f"{role}_locationid"
        rows = lookup_join(rows, named, [(f"{role}locationid", key)], small=small).drop(key)
    return rows


def gate_report(
    trips: DataFrame,
    vendors: DataFrame,
    rates: DataFrame,
    zones: DataFrame,
    columns: tuple[str, ...] = RESOLVED,
    threshold: float = 0.99,
) -> DataFrame:
    """One row: trips, resolved trips, their ratio and whether it reaches the threshold.

    Whether a trip resolves depends on its four keys only, so trips are first counted per
    key combination: the scan reads four columns and the joins see that small table.
    """
    combinations = trips.groupBy(*MASTER_KEYS).agg(F.count(F.lit(1)).alias("n"))
    named = enrich(combinations, vendors, rates, zones)
    return (
        named.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
            F.coalesce(F.sum(F.when(resolved(columns), F.col("n"))), F.lit(0)).alias("golden_records"),
        )
        .withColumn(
            "resolved_ratio",
            F.try_divide(F.col("golden_records").cast("double"), F.col("total_records").cast("double")),
        )
        .withColumn("passed", F.coalesce(F.col("resolved_ratio") >= threshold, F.lit(False)))
    )


def gate(report: DataFrame) -> None:
    """Stop a run whose gate report did not pass."""
    row = report.first()
    if row["total_records"] == 0:
        raise GateFailure("no trips to check")
    if not row["passed"]:
        raise GateFailure(
            f"{row['golden_records']} of {row['total_records']} trips resolve against the masters"
        )


def golden(
    enriched: DataFrame, data_zone: str = "curated_trip_level", data_owner: str = "Ops VP"
) -> DataFrame:
    """Fully resolved trips with their governance labels."""
    return enriched.filter(resolved()).withColumns(
        {"data_zone": F.lit(data_zone), "data_owner": F.lit(data_owner)}
    )


def kpis(
    trips: DataFrame,
    zones: DataFrame,
    as_of: str,
    rush: tuple[tuple[int, int], ...] = X.LAKE_RUSH,
    data_owner: str = "Ops VP",
    data_domain: str = "trip_kpis",
) -> DataFrame:
    """Hourly revenue, tip, distance and speed figures per zone pair.

    Grouping runs on the eight numeric keys; zone names depend on the zone id alone and are
    attached to the far smaller result instead of travelling through the shuffle.
    """
    pickup, dropoff = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    seconds = elapsed_seconds(pickup, dropoff)
    rush_flag = X.flag(X.in_windows(F.col("pickup_hour"), rush))
    grouped = trips.groupBy(*ROUTE_HOUR).agg(
        F.count(F.lit(1)).alias("total_rides"),
        exact_sum("fare_amount").alias("total_fare"),
        exact_sum("tip_amount").alias("total_tip"),
        exact_sum("total_amount").alias("total_revenue"),
        exact_avg("fare_amount").alias("avg_fare"),
        F.avg("tip_pct").alias("avg_tip_pct"),
        F.sum("high_tip_flag").alias("num_high_tip_trips"),
        exact_avg("trip_distance").alias("avg_trip_distance"),
        F.try_divide(F.sum(seconds).cast("double"), F.count(seconds) * F.lit(60.0)).alias(
            "avg_trip_duration"
        ),
        exact_sum("trip_distance").alias("sum_trip_distance"),
        F.sum("is_long_trip").alias("num_long_trips"),
        F.sum("is_short_trip").alias("num_short_trips"),
        F.sum(rush_flag).alias("num_rush_hour_rides"),
        # whole-number totals, so that every ratio below is a single division
        units_sum("total_amount").cast("double").alias("_revenue"),
        units_sum("tip_amount").cast("double").alias("_tip"),
        units_sum("trip_distance").cast("double").alias("_miles"),
        F.sum(seconds).alias("_seconds"),
    )
    named = _with_zones(grouped, zones, ["locationid", "borough", "zone"])
    miles, revenue = F.col("_miles"), F.col("_revenue")
    return named.withColumns(
        {
            "revenue_per_mile": X.guarded_ratio(revenue, miles),
            "avg_revenue_per_ride": revenue / (F.col("total_rides") * F.lit(float(SCALE))),
            "avg_speed_mph": X.guarded_ratio(miles * 3600, F.col("_seconds") * SCALE),
            "tip_per_mile": X.guarded_ratio(F.col("_tip"), miles),
            "data_zone": F.lit("curated_aggregated"),
            "data_owner": F.lit(data_owner),
            "data_domain": F.lit(data_domain),
            "aggregated_at": F.lit(as_of).cast("timestamp_ntz"),
            "pickup_year": F.coalesce("pickup_year", F.lit(0)),
            "pickup_month": F.coalesce("pickup_month", F.lit(0)),
            "pickup_day": F.coalesce("pickup_day", F.lit(0)),
        }
    ).drop("_revenue", "_tip", "_miles", "_seconds")
