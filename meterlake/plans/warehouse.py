"""Star schema: dimensions, fact loads, rollups and reporting views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake import schemas as S
from meterlake.functions import features as X
from meterlake.functions.exact import SCALE, exact_avg, exact_sum, round_ratio, units_sum
from meterlake.functions.times import date_key, minute_boundaries
from meterlake.operators.joins import asof_join, cut_versions, few_versions, fits_broadcast, lookup_join
from meterlake.session import stored
from meterlake.sources.masters import values




# --- dimensions ---------------------------------------------------------------------------


def dim_date(spark: SparkSession, first: str = "2020-01-01", days: int = 4018) -> DataFrame:
    """One row per day; Sunday is 0, weeks are ISO weeks, names are not padded."""
    calendar = spark.range(days).select(
        F.date_add(F.lit(first).cast("date"), F.col("id").cast("int")).alias("full_date")
    )
    return calendar_columns(calendar)


def calendar_columns(days: DataFrame) -> DataFrame:
    d = F.col("full_date")
    weekday = F.dayofweek(d) - 1
    return days.select(
        date_key(d).alias("date_sk"),
        d,
        weekday.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_of_week_name"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_of_year"),
        F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_short"),
        F.quarter(d).alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_name"),
        F.year(d).alias("year"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        weekday.isin(0, 6).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
    )


def _named_range(hour: Column, ranges: list[tuple[int, int, str]]) -> Column:
    named = F.lit(None).cast("string")
    for first, last, name in ranges:
        named = F.when(hour.between(first, last), name).otherwise(named)
    return named


def dim_time(spark: SparkSession) -> DataFrame:
    """One row per hour of the day."""
    hour = F.col("id").cast("int")
    return spark.range(24).select(
        hour.alias("time_sk"),
        hour.alias("hour_24"),
        ((hour + 11) % 12 + 1).alias("hour_12"),
        F.when(hour < 12, "AM").otherwise("PM").alias("am_pm"),
        _named_range(hour, S.TIME_PERIODS).alias("time_period"),
        X.in_windows(hour, X.WAREHOUSE_RUSH).alias("rush_hour_flag"),
        _named_range(hour, S.DAY_PARTS).alias("day_part"),
        hour.between(*S.BUSINESS_HOURS).alias("business_hour"),
    )


def dim_vendor(spark: SparkSession) -> DataFrame:
    rows = [(sk, *row) for sk, row in enumerate(S.VENDORS, 1)]
    return values(
        spark, ["vendor_sk int", "vendor_id int", "vendor_name string", "vendor_code string"], rows
    )


def dim_ratecode(spark: SparkSession) -> DataFrame:
    columns = [
        "ratecode_sk int",
        "ratecode_id int",
        "rate_code_name string",
        "rate_description string",
        "is_flat_rate boolean",
        "is_negotiated boolean",
    ]
    return values(spark, columns, [(sk, *row) for sk, row in enumerate(S.RATE_CODES, 1)])


def dim_payment(spark: SparkSession) -> DataFrame:
    columns = [
        "payment_sk int",
        "payment_type_id int",
        "payment_type_name string",
        "payment_category string",
        "allows_tip_record boolean",
    ]
    return values(spark, columns, [(sk, *row) for sk, row in enumerate(S.PAYMENTS, 1)])


def dim_zone(zones: DataFrame, core_borough: str = "Manhattan") -> DataFrame:
    """Zones with their classification and an unknown member; the key follows the zone id."""
    spark = zones.sparkSession
    unknown = values(
        spark,
        ["locationid int", "borough string", "zone string", "service_zone string"],
        [(S.UNKNOWN_ZONE, "Unknown", "Unknown", "Unknown")],
    )
    service, borough = F.col("service_zone"), F.col("borough")
    return (
        zones.select("locationid", "borough", "zone", "service_zone")
        .unionByName(unknown)
        .select(
            (F.col("locationid") + 2).alias("zone_sk"),
            F.col("locationid").alias("location_id"),
            borough,
            F.col("zone").alias("zone_name"),
            service,
            X.is_true(service == "Airports").alias("is_airport"),
            X.is_true(borough == core_borough).alias("is_manhattan"),
            X.is_true(service == "Yellow Zone").alias("is_yellow_zone"),
            X.zone_category(borough, service, core_borough).alias("zone_category"),
        )
    )


def warehouse_dims(
    spark: SparkSession, zones: DataFrame, core_borough: str = "Manhattan"
) -> dict[str, DataFrame]:
    return {
        "vendor": dim_vendor(spark),
        "zone": dim_zone(zones, core_borough),
        "ratecode": dim_ratecode(spark),
        "payment": dim_payment(spark),
        "time": dim_time(spark),
    }


# Surrogate keys of the unknown members, found by natural key
VENDOR_UNKNOWN_SK = [v[0] for v in S.VENDORS].index(S.UNKNOWN_VENDOR) + 1
RATECODE_UNKNOWN_SK = [r[0] for r in S.RATE_CODES].index(S.UNKNOWN_RATE_CODE) + 1
PAYMENT_UNKNOWN_SK = [p[0] for p in S.PAYMENTS].index(S.UNKNOWN_PAYMENT) + 1
ZONE_UNKNOWN_SK = S.UNKNOWN_ZONE + 2


# --- facts --------------------------------------------------------------------------------


def _timed(staging: DataFrame) -> DataFrame:
    defaults = {
        "_rate": F.coalesce("ratecodeid", F.lit(S.UNKNOWN_RATE_CODE)),
        "_payment": F.coalesce("payment_type", F.lit(S.DEFAULT_PAYMENT)),
    }
    return staging.filter(
        F.col("tpep_pickup_datetime").isNotNull() & F.col("tpep_dropoff_datetime").isNotNull()
    ).withColumns(defaults)


def _small_dims(rows: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    rate = dims["ratecode"].select("ratecode_sk", F.col("ratecode_id").alias("_rate_id"))
    payment = dims["payment"].select("payment_sk", F.col("payment_type_id").alias("_payment_id"))
    rows = lookup_join(rows, rate, [("_rate", "_rate_id")])
    return lookup_join(rows, payment, [("_payment", "_payment_id")])


def _fact_columns(rows: DataFrame, rush: tuple[tuple[int, int], ...]) -> DataFrame:
    pickup, dropoff = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    tip, fare, miles = F.col("tip_amount"), F.col("fare_amount"), F.col("trip_distance")
    airport = X.is_true(F.col("pu_airport")) | X.is_true(F.col("do_airport"))
    return rows.select(
        F.col("trip_id").alias("trip_sk"),
        date_key(pickup).alias("pickup_date_sk"),
        F.hour(pickup).alias("pickup_time_sk"),
        date_key(dropoff).alias("dropoff_date_sk"),
        F.hour(dropoff).alias("dropoff_time_sk"),
        "vendor_sk",
        "pickup_zone_sk",
        "dropoff_zone_sk",
        F.coalesce("ratecode_sk", F.lit(RATECODE_UNKNOWN_SK)).alias("ratecode_sk"),
        F.coalesce("payment_sk", F.lit(PAYMENT_UNKNOWN_SK)).alias("payment_sk"),
        "store_and_fwd_flag",
        F.col("passenger_count").try_cast("smallint").alias("passenger_count"),
        "trip_distance",
        "fare_amount",
        F.col("extra").alias("extra_amount"),
        "mta_tax",
        "tip_amount",
        "tolls_amount",
        "improvement_surcharge",
        "congestion_surcharge",
        "airport_fee",
        "cbd_congestion_fee",
        "total_amount",
        minute_boundaries(pickup, dropoff).alias("trip_duration_minutes"),
        X.tip_percent_2dp(tip, fare).alias("tip_percentage"),
        X.is_true(miles > 10).alias("is_long_trip"),
        X.is_true(miles < 1).alias("is_short_trip"),
        X.tip_share_above(tip, fare, 20).alias("is_high_tip"),
        X.is_true(F.col("payment_type") == 2).alias("is_cash_trip"),
        airport.alias("is_airport_trip"),
        X.in_windows(F.hour(pickup), rush).alias("is_rush_hour"),
    )


def _zone_lookup(zone: DataFrame, role: str) -> DataFrame:
    return zone.select(
        F.col("zone_sk").alias(f"_{role}_zone_sk"),
        F.col("location_id").alias(f"_{role}_location"),
        F.col("is_airport").alias(f"{role}_airport"),
    )


def load_fact(
    staging: DataFrame, dims: dict[str, DataFrame], rush: tuple[tuple[int, int], ...] = X.WAREHOUSE_RUSH
) -> DataFrame:
    """Staged trips as facts. The trip id serves as key: a running number over all facts
    would order the whole table for no gain."""
    vendor = dims["vendor"].select(F.col("vendor_sk").alias("_vendor_sk"), F.col("vendor_id").alias("_vendor"))
    rows = lookup_join(_timed(staging), vendor, [("vendorid", "_vendor")])
    small = fits_broadcast(_zone_lookup(dims["zone"], "pu"))
    for role in ("pu", "do"):
        zone = _zone_lookup(dims["zone"], role)
        rows = lookup_join(rows, zone, [(f"{role}locationid", f"_{role}_location")], small=small)
    keyed = _small_dims(rows, dims).withColumns(
        {
            "vendor_sk": F.coalesce("_vendor_sk", F.lit(VENDOR_UNKNOWN_SK)),
            "pickup_zone_sk": F.coalesce("_pu_zone_sk", F.lit(ZONE_UNKNOWN_SK)),
            "dropoff_zone_sk": F.coalesce("_do_zone_sk", F.lit(ZONE_UNKNOWN_SK)),
        }
    )
    return _fact_columns(keyed, rush)


def load_fact_asof(
    staging: DataFrame,
    vendor_versions: DataFrame,
    zone_versions: DataFrame,
    dims: dict[str, DataFrame],
    rush: tuple[tuple[int, int], ...] = X.WAREHOUSE_RUSH,
    small: bool | None = None,
) -> DataFrame:
    """Facts that point at the dimension versions valid when the trip happened: vendor and
    pickup zone at pickup, dropoff zone at dropoff."""
    vendor = vendor_versions.select(
        F.col("vendor_sk").alias("_vendor_sk"),
        F.col("vendor_id").alias("_vendor"),
        F.col("effective_start_date").alias("_v_from"),
        F.col("effective_end_date").alias("_v_to"),
    )
    rows = asof_join(
        _timed(staging), vendor, [("vendorid", "_vendor")], "tpep_pickup_datetime", "_v_from", "_v_to", small
    )
    # both roles share the cut versions
    zones = zone_versions.select("location_id", "effective_start_date", "effective_end_date", "zone_sk", "is_airport")
    zones = stored(cut_versions(zones, ["location_id"], "effective_start_date", "effective_end_date"), "versions")
    if small is None:
        small = few_versions(zones, ["location_id"])
    for role, at in (("pu", "tpep_pickup_datetime"), ("do", "tpep_dropoff_datetime")):
        versions = zones.select(
            F.col("zone_sk").alias(f"_{role}_zone_sk"),
            F.col("location_id").alias(f"_{role}_location"),
            F.col("is_airport").alias(f"{role}_airport"),
            F.col("effective_start_date").alias(f"_{role}_from"),
            F.col("effective_end_date").alias(f"_{role}_to"),
        )
        key = [(f"{role}locationid", f"_{role}_location")]
        rows = asof_join(rows, versions, key, at, f"_{role}_from", f"_{role}_to", small, cut=True)
    keyed = _small_dims(rows, dims).withColumns(
        {
            "vendor_sk": F.coalesce("_vendor_sk", F.lit(VENDOR_UNKNOWN_SK)),
            "pickup_zone_sk": F.coalesce("_pu_zone_sk", F.lit(ZONE_UNKNOWN_SK)),
            "dropoff_zone_sk": F.coalesce("_do_zone_sk", F.lit(ZONE_UNKNOWN_SK)),
        }
    )
    return _fact_columns(keyed, rush)


# --- rollups ------------------------------------------------------------------------------


def agg_daily(fact: DataFrame) -> DataFrame:
    """Date x vendor x pickup zone. Card trips are all trips not paid in cash."""
    return fact.groupBy("pickup_date_sk", "vendor_sk", "pickup_zone_sk").agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.sum("passenger_count").alias("total_passengers"),
        exact_sum("trip_distance").alias("total_distance"),
        exact_sum("fare_amount").alias("total_fare"),
        exact_sum("tip_amount").alias("total_tips"),
        exact_sum("total_amount").alias("total_revenue"),
        exact_avg("trip_distance").alias("avg_trip_distance"),
        exact_avg("fare_amount").alias("avg_fare"),
        exact_avg("tip_percentage").alias("avg_tip_percentage"),
        F.avg("trip_duration_minutes").alias("avg_trip_duration"),
        F.count_if("is_cash_trip").alias("cash_trip_count"),
        F.count_if(~F.col("is_cash_trip")).alias("card_trip_count"),
        F.count_if("is_airport_trip").alias("airport_trip_count"),
        F.count_if("is_rush_hour").alias("rush_hour_trip_count"),
    )


def agg_hourly(fact: DataFrame) -> DataFrame:
    """Date x hour x pickup zone; dropoffs and net flow stay 0 here, see :func:`net_flow`."""
    return fact.groupBy(
        F.col("pickup_date_sk").alias("date_sk"),
        F.col("pickup_time_sk").alias("time_sk"),
        F.col("pickup_zone_sk").alias("zone_sk"),
    ).agg(
        F.count(F.lit(1)).alias("pickup_count"),
        F.lit(0).alias("dropoff_count"),
        F.lit(0).alias("net_flow"),
        exact_sum("fare_amount").alias("total_fare"),
        exact_avg("fare_amount").alias("avg_fare"),
    )


def net_flow(fact: DataFrame) -> DataFrame:
    """Pickups, dropoffs and their difference per date, hour and zone, in one grouping."""
    ends = F.explode(
        F.array(
            F.struct(
                F.col("pickup_date_sk").alias("date_sk"),
                F.col("pickup_time_sk").alias("time_sk"),
                F.col("pickup_zone_sk").alias("zone_sk"),
                F.lit(1).alias("p"),
                F.lit(0).alias("d"),
            ),
            F.struct(
                F.col("dropoff_date_sk").alias("date_sk"),
                F.col("dropoff_time_sk").alias("time_sk"),
                F.col("dropoff_zone_sk").alias("zone_sk"),
                F.lit(0).alias("p"),
                F.lit(1).alias("d"),
            ),
        )
    )
    return (
        fact.select(ends.alias("e"))
        .groupBy("e.date_sk", "e.time_sk", "e.zone_sk")
        .agg(F.sum("e.p").alias("pickup_count"), F.sum("e.d").alias("dropoff_count"))
        .withColumn("net_flow", F.col("pickup_count") - F.col("dropoff_count"))
    )


# --- reporting ----------------------------------------------------------------------------


def revenue_by_vendor(fact: DataFrame, vendor: DataFrame, dates: DataFrame) -> DataFrame:
    """Daily trips and revenue per vendor. Facts are grouped by key before names are joined."""
    per_key = fact.groupBy("pickup_date_sk", "vendor_sk").agg(
        F.count(F.lit(1)).alias("_trips"), units_sum("total_amount", 100).alias("_revenue")
    )
    day = dates.select("date_sk", "full_date")
    names = vendor.select(F.col("vendor_sk").alias("_sk"), "vendor_name")
    joined = lookup_join(per_key, day, [("pickup_date_sk", "date_sk")], "inner")
    joined = lookup_join(joined, names, [("vendor_sk", "_sk")], "inner")
    out = joined.groupBy("full_date", "vendor_name").agg(
        F.sum("_trips").alias("trips"), (F.sum("_revenue").cast("double") / F.lit(100.0)).alias("revenue")
    )
    return out.orderBy("full_date", F.desc("revenue"), "vendor_name")


def top_zones(fact: DataFrame, zone: DataFrame, k: int = 10) -> DataFrame:
    """The busiest pickup zones; ties by name."""
    per_key = fact.groupBy("pickup_zone_sk").agg(
        F.count(F.lit(1)).alias("_trips"), units_sum("total_amount", 100).alias("_revenue")
    )
    names = zone.select("zone_sk", "zone_name", "borough")
    joined = lookup_join(per_key, names, [("pickup_zone_sk", "zone_sk")], "inner")
    out = joined.groupBy("zone_name", "borough").agg(
        F.sum("_trips").alias("trips"), (F.sum("_revenue").cast("double") / F.lit(100.0)).alias("revenue")
    )
    return out.orderBy(F.desc("trips"), "zone_name", "borough").limit(k)


def rush_comparison(fact: DataFrame) -> DataFrame:
    period = F.when(F.col("is_rush_hour"), "Rush Hour").otherwise("Non-Rush Hour")
    return fact.groupBy(period.alias("period")).agg(
        F.count(F.lit(1)).alias("trips"),
        exact_avg("fare_amount").alias("avg_fare"),
        exact_avg("tip_percentage").alias("avg_tip_pct"),
    )


def _units(fact: DataFrame, keys: list[str], amounts: list[str], flags: list[str] = (), counts: list[str] = ()) -> DataFrame:
    """Facts grouped by their numeric keys, amounts in whole units: all that a view needs, before any name is looked up."""
    parts = [F.count(F.lit(1)).alias("n")]
    for c in amounts:
        parts += [units_sum(c).alias(f"{c}_units"), F.count(c).alias(f"{c}_n")]
    parts += [F.count_if(f).alias(f"{f}_n") for f in flags]
    parts += [F.sum(c).alias(f"{c}_sum") for c in counts]
    return fact.groupBy(*keys).agg(*parts)


def _total(amount: str) -> Column:
    return round_ratio(F.sum(f"{amount}_units"), F.lit(SCALE), 2)


def _mean(amount: str) -> Column:
    return round_ratio(F.sum(f"{amount}_units"), F.sum(f"{amount}_n") * F.lit(SCALE), 2)


def view_daily(fact: DataFrame, vendor: DataFrame, dates: DataFrame) -> DataFrame:
    day = dates.select("date_sk", "full_date", "day_of_week_name", "month_name", "year", "is_weekend")
    names = vendor.select(F.col("vendor_sk").alias("_sk"), "vendor_name")
    amounts = ["trip_distance", "fare_amount", "tip_amount", "total_amount", "tip_percentage", "trip_duration_minutes"]
    flags = ["is_cash_trip", "is_airport_trip", "is_rush_hour"]
    grouped = _units(fact, ["pickup_date_sk", "vendor_sk"], amounts, flags, ["passenger_count"])
    joined = lookup_join(grouped, day, [("pickup_date_sk", "date_sk")], "inner")
    joined = lookup_join(joined, names, [("vendor_sk", "_sk")], "inner")
    return joined.groupBy(
        F.col("full_date").alias("trip_date"), "day_of_week_name", "month_name", "year", "is_weekend", "vendor_name"
    ).agg(
        F.sum("n").alias("total_trips"),
        F.sum("passenger_count_sum").alias("total_passengers"),
        _total("trip_distance").alias("total_distance"),
        _total("fare_amount").alias("total_fare"),
        _total("tip_amount").alias("total_tips"),
        _total("total_amount").alias("total_revenue"),
        _mean("trip_distance").alias("avg_trip_distance"),
        _mean("fare_amount").alias("avg_fare"),
        _mean("tip_percentage").alias("avg_tip_percentage"),
        _mean("trip_duration_minutes").alias("avg_trip_duration"),
        F.sum("is_cash_trip_n").alias("cash_trips"),
        F.sum("is_airport_trip_n").alias("airport_trips"),
        F.sum("is_rush_hour_n").alias("rush_hour_trips"),
    )


def view_zone(fact: DataFrame, zone: DataFrame) -> DataFrame:
    names = zone.select("zone_sk", "borough", "zone_name", "zone_category", "is_airport")
    amounts = ["total_amount", "fare_amount", "tip_percentage", "trip_distance"]
    grouped = _units(fact, ["pickup_zone_sk"], amounts)
    joined = lookup_join(grouped, names, [("pickup_zone_sk", "zone_sk")], "inner")
    return joined.groupBy("borough", "zone_name", "zone_category", "is_airport").agg(
        F.sum("n").alias("pickup_count"),
        _total("total_amount").alias("total_revenue"),
        _mean("fare_amount").alias("avg_fare"),
        _mean("tip_percentage").alias("avg_tip_pct"),
        _mean("trip_distance").alias("avg_distance"),
    )


def view_hourly(fact: DataFrame, times: DataFrame, dates: DataFrame) -> DataFrame:
    hour = times.select("time_sk", "hour_24", "time_period", "rush_hour_flag", "day_part")
    day = dates.select("date_sk", "day_of_week_name", "is_weekend")
    grouped = _units(fact, ["pickup_time_sk", "pickup_date_sk"], ["total_amount", "fare_amount"])
    joined = lookup_join(grouped, hour, [("pickup_time_sk", "time_sk")], "inner")
    joined = lookup_join(joined, day, [("pickup_date_sk", "date_sk")], "inner")
    return joined.groupBy(
        "hour_24", "time_period", "rush_hour_flag", "day_part", "day_of_week_name", "is_weekend"
    ).agg(
        F.sum("n").alias("trip_count"),
        _total("total_amount").alias("total_revenue"),
        _mean("fare_amount").alias("avg_fare"),
    )


def view_payment(fact: DataFrame, payment: DataFrame) -> DataFrame:
    names = payment.select(F.col("payment_sk").alias("_sk"), "payment_type_name", "payment_category")
    grouped = _units(fact, ["payment_sk"], ["total_amount", "fare_amount", "tip_amount", "tip_percentage"])
    joined = lookup_join(grouped, names, [("payment_sk", "_sk")], "inner")
    return joined.groupBy("payment_type_name", "payment_category").agg(
        F.sum("n").alias("trip_count"),
        _total("total_amount").alias("total_revenue"),
        _mean("fare_amount").alias("avg_fare"),
        _mean("tip_amount").alias("avg_tip"),
        _mean("tip_percentage").alias("avg_tip_pct"),
    )


def view_masked(fact: DataFrame) -> DataFrame:
    """Facts for analysts: amounts generalised, exact ones left out."""
    return fact.select(
        "trip_sk",
        "pickup_date_sk",
        "pickup_time_sk",
        "vendor_sk",
        "pickup_zone_sk",
        "dropoff_zone_sk",
        X.nearest(F.col("fare_amount"), 10).alias("fare_amount_rounded"),
        X.nearest(F.col("tip_amount"), 5).alias("tip_amount_rounded"),
        X.nearest(F.col("total_amount"), 10).alias("total_amount_rounded"),
        "trip_distance",
        "passenger_count",
        "trip_duration_minutes",
        "is_rush_hour",
        "is_airport_trip",
        "is_cash_trip",
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Name and row count of each table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    out = counts[0]
    for other in counts[1:]:
        out = out.unionByName(other)
    return out
