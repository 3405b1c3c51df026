"""Daily summary, vendor-day and route-day tables with full and incremental refresh."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.functions import features as X
from meterlake.functions.casts import safe_cents, safe_whole
from meterlake.functions.exact import SCALE, cents, long_sum, mean_cents, round_ratio, rounded_avg, rounded_sum, units_sum
from meterlake.functions.rules import within_month
from meterlake.functions.times import at, days_before, hours_before, whole_minutes
from meterlake.operators.joins import fits_broadcast, lookup_join
from meterlake.operators.tables import retain, upsert

VENDOR_DAY = ["vendor_id", "metric_date"]
ROUTE_DAY = ["pickup_zone_id", "dropoff_zone_id", "metric_date"]


def active_names(vendors: DataFrame) -> DataFrame:
    """Source id and name of the vendors in force."""
    return vendors.filter(F.col("lifecycle_state") == "ACTIVE").select(
        F.col("source_vendor_id").alias("_vendor"), "vendor_name"
    )


def cleaned(trips: DataFrame, year: int, month: int) -> DataFrame:
    """One month of trips with every field made safe and scored by ten rules. Amounts,
    distance and duration are whole hundredths from here on."""
    c = F.col
    safe = trips.filter(within_month(c("tpep_pickup_datetime"), year, month)).select(
        F.to_date("tpep_pickup_datetime").alias("trip_date"),
        c("tpep_pickup_datetime").alias("pickup"),
        c("tpep_dropoff_datetime").alias("dropoff"),
        safe_whole(c("vendorid")).alias("vendor"),
        safe_whole(c("passenger_count"), 0).alias("passengers"),
        safe_cents(c("trip_distance")).alias("distance"),
        safe_cents(c("trip_duration_minutes")).alias("duration"),
        safe_cents(c("fare_amount")).alias("fare"),
        safe_cents(c("tip_amount")).alias("tip"),
        safe_cents(c("total_amount")).alias("total"),
        safe_cents(c("tolls_amount")).alias("tolls"),
        (safe_cents(c("congestion_surcharge")) + safe_cents(c("airport_fee"))).alias("surcharges"),
        safe_whole(c("pulocationid")).alias("pu"),
        safe_whole(c("dolocationid")).alias("do"),
        "pu_zone",
        "pu_borough",
        "do_zone",
        "do_borough",
        *[F.coalesce(c(n), F.lit(0)).alias(n) for n in ("is_long_trip", "is_short_trip", "high_tip_flag")],
        c("ratecodeid"),
    )
    rules = [
        c("total") >= 0,
        c("fare") >= 0,
        c("distance") >= 0,
        c("pickup") < c("dropoff"),
        c("duration").between(100, 144_000),
        c("passengers").between(1, 8),
        c("pu").isNotNull(),
        c("do").isNotNull(),
        c("vendor").isNotNull(),
        c("pickup").isNotNull(),
    ]
    return safe.withColumns({"score": X.quality_score(rules), "tip_share": X.tip_hundredths(c("tip"), c("fare"))})


def daily_summary(trips: DataFrame, vendors: DataFrame, year: int, month: int) -> DataFrame:
    """Vendor x pickup zone x dropoff zone per day.

    Only vendors in force lend their name; the vendor join runs after the grouping, where
    one row per vendor, route and day is left.
    """
    c = F.col
    keyed = cleaned(trips, year, month).filter(
        c("trip_date").isNotNull() & c("vendor").isNotNull() & c("pu").isNotNull()
    )
    places = ["pu_zone", "pu_borough", "do_zone", "do_borough"]
    sums = ["total", "fare", "tip", "tolls", "surcharges", "distance", "duration", "tip_share", "score"]
    counts = ["passengers", "is_long_trip", "is_short_trip", "high_tip_flag"]
    grouped = keyed.groupBy("trip_date", "vendor", "pu", "do", *places).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("score").alias("n_scored"),
        *[long_sum(s).alias(f"s_{s}") for s in sums],
        *[F.sum(s).alias(f"s_{s}") for s in counts],
        F.count_if(c("tip") > 0).alias("tipped"),
        F.count_if(c("ratecodeid") == 1).alias("standard"),
        F.count_if(c("ratecodeid").isin(2, 3)).alias("airport"),
        F.count_if(c("ratecodeid") == 5).alias("negotiated"),
    )
    named = lookup_join(grouped, active_names(vendors), [("vendor", "_vendor")])

    def amount(total: str) -> Column:
        return c(f"s_{total}").cast("double") / F.lit(100.0)

    def mean(total: str) -> Column:
        return mean_cents(c(f"s_{total}"), c("n"))

    def place(name: str) -> Column:
        return F.coalesce(c(name), F.lit("Unknown"))

    return named.select(
        c("trip_date").alias("summary_date"),
        c("vendor").alias("vendor_id"),
        F.coalesce("vendor_name", F.lit("Unknown Vendor")).alias("vendor_name"),
        c("pu").alias("pickup_zone_id"),
        place("pu_zone").alias("pickup_zone_name"),
        place("pu_borough").alias("pickup_borough"),
        c("do").alias("dropoff_zone_id"),
        place("do_zone").alias("dropoff_zone_name"),
        place("do_borough").alias("dropoff_borough"),
        c("n").alias("total_trips"),
        c("s_passengers").alias("total_passengers"),
        amount("total").alias("total_revenue"),
        amount("fare").alias("total_fare"),
        amount("tip").alias("total_tips"),
        amount("tolls").alias("total_tolls"),
        amount("surcharges").alias("total_surcharges"),
        amount("distance").alias("total_distance"),
        mean("distance").alias("avg_distance"),
        mean("duration").alias("avg_trip_duration"),
        mean("fare").alias("avg_fare"),
        mean("tip").alias("avg_tip"),
        mean("total").alias("avg_total_amount"),
        c("tipped").alias("trips_with_tips"),
        mean_cents(c("tipped") * 10_000, c("n")).alias("tip_percentage"),
        mean("tip_share").alias("avg_tip_pct"),
        c("s_is_long_trip").alias("long_trips"),
        c("s_is_short_trip").alias("short_trips"),
        c("s_high_tip_flag").alias("high_tip_trips"),
        c("standard").alias("standard_rate_trips"),
        c("airport").alias("airport_trips"),
        c("negotiated").alias("negotiated_trips"),
        mean_cents(c("s_score") * 100, c("n_scored")).alias("data_quality_score"),
        c("n").alias("source_row_count"),
    )


# --- vendor-day ---------------------------------------------------------------------------


def vendor_performance(
    trips: DataFrame, vendors: DataFrame, since: str | None = None, refresh_type: str = "FULL"
) -> DataFrame:
    """Vendor x day from a given instant on."""
    pickup, dropoff = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    wanted = trips.filter(pickup.isNotNull() & F.col("vendorid").isNotNull())
    if since is not None:
        wanted = wanted.filter(pickup >= at(since))
    share = X.tip_percent(F.col("tip_amount"), F.col("fare_amount"))
    grouped = wanted.groupBy(
        F.col("vendorid").alias("vendor_id"), F.to_date(pickup).alias("metric_date")
    ).agg(
        F.count(F.lit(1)).alias("total_trips"),
        rounded_sum("total_amount").alias("total_revenue"),
        rounded_sum("trip_distance").alias("total_distance"),
        rounded_avg(whole_minutes(pickup, dropoff)).alias("avg_trip_duration"),
        rounded_avg("fare_amount").alias("avg_fare"),
        F.round(F.avg(share), 2).alias("avg_tip_pct"),
        F.count(F.lit(1)).alias("source_row_count"),
    )
    named = lookup_join(grouped, active_names(vendors), [("vendor_id", "_vendor")]).drop("_vendor")
    return named.withColumn("refresh_type", F.lit(refresh_type))


# what the figures of a vendor and day are made of: whole units and counts, which add up
SHARE_UNITS = 10**9
VENDOR_STATE = ["n", "revenue", "distance", "minutes", "n_minutes", "fare", "n_fare", "share", "n_share"]


def vendor_state(trips: DataFrame) -> DataFrame:
    """Mergeable sums per vendor and day of pickup, trips without a pickup time under a NULL day."""
    pickup, dropoff = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    share = X.tip_percent(F.col("tip_amount"), F.col("fare_amount"))
    minutes = whole_minutes(pickup, dropoff)
    sums = [
        F.count(F.lit(1)),
        units_sum("total_amount"),
        units_sum("trip_distance"),
        long_sum(minutes),
        F.count(minutes),
        units_sum("fare_amount"),
        F.count("fare_amount"),
        units_sum(share, SHARE_UNITS),
        F.count(share),
    ]
    keyed = trips.filter(F.col("vendorid").isNotNull()).groupBy(F.to_date(pickup).alias("metric_date"), F.col("vendorid").cast("int").alias("vendor_id"))
    return keyed.agg(*[s.cast("decimal(38,0)").alias(c) for s, c in zip(sums, VENDOR_STATE, strict=True)])


def vendor_figures(state: DataFrame, vendors: DataFrame, refresh_type: str = "FULL") -> DataFrame:
    """The figures of :func:`vendor_performance` from merged states."""
    c = F.col
    figures = state.select(
        "vendor_id",
        "metric_date",
        c("n").cast("bigint").alias("total_trips"),
        round_ratio(c("revenue"), F.lit(SCALE), 2).alias("total_revenue"),
        round_ratio(c("distance"), F.lit(SCALE), 2).alias("total_distance"),
        round_ratio(c("minutes"), c("n_minutes"), 2).alias("avg_trip_duration"),
        round_ratio(c("fare"), c("n_fare") * SCALE, 2).alias("avg_fare"),
        round_ratio(c("share"), c("n_share") * SHARE_UNITS, 2).alias("avg_tip_pct"),
        c("n").cast("bigint").alias("source_row_count"),
    )
    named = lookup_join(figures, active_names(vendors), [("vendor_id", "_vendor")]).drop("_vendor")
    return named.withColumn("refresh_type", F.lit(refresh_type))


def refresh_vendors_full(
    old: DataFrame, trips: DataFrame, vendors: DataFrame, as_of: str, keep_days: int = 365
) -> DataFrame:
    """Expire what is older than the horizon and rebuild everything since then."""
    since = (at(as_of), keep_days)
    recent = trips.filter(F.col("tpep_pickup_datetime") >= F.to_date(days_before(*since)).cast("timestamp_ntz"))
    new = vendor_performance(recent, vendors)
    return upsert(retain(old, "metric_date", as_of, keep_days), new, VENDOR_DAY, small=False)


def whole_days_since(trips: DataFrame, as_of: str, hours: int) -> DataFrame:
    """Trips of every day touched by the last ``hours``, complete days."""
    first_day = F.to_date(hours_before(at(as_of), hours)).cast("timestamp_ntz")
    return trips.filter(F.col("tpep_pickup_datetime") >= first_day)


def refresh_vendors_incremental(
    old: DataFrame, trips: DataFrame, vendors: DataFrame, as_of: str, hours: int = 24
) -> DataFrame:
    """Recompute each affected day in full: replacing a day by part of its trips would lose
    the rest. The range filter prunes all other days at the scan."""
    new = vendor_performance(whole_days_since(trips, as_of, hours), vendors, refresh_type="INCREMENTAL")
    return upsert(old, new, VENDOR_DAY, small=False)


def recent_vendor_days(summary: DataFrame, as_of: str, days: int = 30, k: int = 20) -> DataFrame:
    first = F.to_date(days_before(at(as_of), days))
    return (
        summary.filter((F.col("metric_date") >= first) & F.col("vendor_name").isNotNull())
        .select("vendor_name", "metric_date", "total_trips", "total_revenue", "avg_fare", "avg_tip_pct")
        .orderBy(F.desc("metric_date"), F.desc("total_revenue"), "vendor_name")
        .limit(k)
    )


# --- route-day ----------------------------------------------------------------------------


def route_patterns(trips: DataFrame, as_of: str, days: int = 90, refresh_type: str = "FULL") -> DataFrame:
    """Zone pair x day with its busiest pickup hour (the earliest among equals).

    Trips are first grouped by hour, then the hours of a day are combined: two partial
    aggregations instead of a lookup per row.
    """
    pickup, dropoff = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    recent = trips.filter(
        (pickup >= F.to_date(days_before(at(as_of), days)).cast("timestamp_ntz"))
        & F.col("pulocationid").isNotNull()
        & F.col("dolocationid").isNotNull()
    )
    minutes = whole_minutes(pickup, dropoff)
    hourly = recent.groupBy(
        F.col("pulocationid").alias("pickup_zone_id"),
        F.col("dolocationid").alias("dropoff_zone_id"),
        F.to_date(pickup).alias("metric_date"),
        F.hour(pickup).alias("hour"),
    ).agg(
        F.count(F.lit(1)).alias("n"),
        units_sum("fare_amount", 100).alias("fare"),
        units_sum("trip_distance", 100).alias("miles"),
        F.sum(minutes).alias("minutes"),
        F.count(minutes).alias("n_minutes"),
    )
    n = F.sum("n")
    return hourly.groupBy(*ROUTE_DAY).agg(
        n.alias("trip_count"),
        round_ratio(F.sum("fare"), n * 100, 2).alias("avg_fare"),
        round_ratio(F.sum("miles"), n * 100, 2).alias("avg_distance"),
        round_ratio(F.sum("minutes"), F.sum("n_minutes"), 2).alias("avg_duration"),
        F.max_by("hour", F.struct(F.col("n"), -F.col("hour"))).alias("peak_hour"),
        F.lit(refresh_type).alias("refresh_type"),
    )


def top_routes(routes: DataFrame, zones: DataFrame, as_of: str, days: int = 7, k: int = 10) -> DataFrame:
    """Busiest routes of the last days; averages are means of the daily means, and
    ``weighted_avg_fare`` weighs each day by its trips."""
    recent = routes.filter(F.col("metric_date") >= F.to_date(days_before(at(as_of), days)))
    per_pair = recent.groupBy("pickup_zone_id", "dropoff_zone_id").agg(
        F.sum("trip_count").alias("n"),
        F.count(F.lit(1)).alias("days"),
        F.sum(cents("avg_fare")).alias("fare"),
        F.sum(cents("avg_distance")).alias("miles"),
        F.sum(cents("avg_fare") * F.col("trip_count")).alias("weighted"),
    )
    named = per_pair
    small = fits_broadcast(zones.select("source_zone_id", "zone_name"))
    for end in ("pickup", "dropoff"):
        names = zones.select(
            F.col("source_zone_id").alias(f"_{end}"), F.col("zone_name").alias(f"{end}_zone")
        )
        named = lookup_join(named, names, [(f"{end}_zone_id", f"_{end}")], small=small)
    days_total = F.sum("days") * F.lit(100.0)
    return (
        named.groupBy("pickup_zone", "dropoff_zone")
        .agg(
            F.sum("n").alias("total_trips"),
            (F.sum("fare") / days_total).alias("avg_fare"),
            (F.sum("miles") / days_total).alias("avg_distance_miles"),
            (F.sum("weighted") / (F.sum("n") * F.lit(100.0))).alias("weighted_avg_fare"),
        )
        .orderBy(F.desc("total_trips"), F.asc_nulls_first("pickup_zone"), F.asc_nulls_first("dropoff_zone"))
        .limit(k)
    )


def freshness_of(summaries: dict[str, DataFrame], as_of: str, updated: str = "last_updated") -> DataFrame:
    """Last refresh, minutes since then and rows of each summary table."""
    parts = [
        df.agg(F.max(updated).alias("last_refresh"), F.count(F.lit(1)).alias("total_records")).select(
            F.lit(name).alias("view_name"),
            "last_refresh",
            whole_minutes(F.col("last_refresh"), at(as_of)).alias("minutes_since_refresh"),
            "total_records",
        )
        for name, df in summaries.items()
    ]
    out = parts[0]
    for other in parts[1:]:
        out = out.unionByName(other)
    return out
