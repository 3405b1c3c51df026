"""Daily, vendor-day and route-day summaries and their refreshes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake import jobs
from meterlake.catalogue import query
from meterlake.catalogue.sqltext import DAILY_SELECT, VENDOR_DAY_COLUMNS, bigint, sql
from meterlake.functions.times import at, days_before
from meterlake.operators import tables
from meterlake.plans import lake
from meterlake.plans import summaries as M
from meterlake.session import scratch_path
from meterlake.sources import governed, masters
from meterlake.sources import testtables as T
from meterlake.streaming import refresh

INCREMENT_AS_OF = "2024-01-29 15:30:00"


def trip_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All trips with features and zone names, resolved or not."""
    return lake.enrich(
        lake.featurise(T.trips(spark, sf_dir)),
        masters.vendors(spark),
        masters.rate_codes(spark),
        T.zones(spark, sf_dir),
    )


def vendor_masters(spark: SparkSession) -> DataFrame:
    return governed.vendor_masters(spark, proposed=(6,))


def zone_masters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return governed.zone_masters(T.zones(spark, sf_dir), proposed=(11, 23))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.daily_summary(trip_level(spark, sf_dir), vendor_masters(spark), 2024, 1)


@query("an_daily_summary", sql("daily", DAILY_SELECT))
def an_daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily(spark, sf_dir)


def shifted(trips: DataFrame, days: int) -> DataFrame:
    """Trips moved to earlier days, as the content of an older summary."""
    back = F.make_dt_interval(F.lit(days), F.lit(0), F.lit(0), F.lit(0))
    moved = {c: F.col(c) - back for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime")}
    return trips.withColumns(moved)


@query(
    "mv_vendor_full",
    sql(
        "vendor_day",
        f"""SELECT {VENDOR_DAY_COLUMNS}, CAST(metric_date AS VARCHAR) AS metric_date, 'FULL' AS refresh_type FROM vendor_day
        UNION ALL SELECT {VENDOR_DAY_COLUMNS}, CAST(metric_date - 360 AS VARCHAR), 'OLD' FROM vendor_day
        WHERE metric_date - 360 >= DATE '2023-01-31'""",
    ),
)
def mv_vendor_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips, vendors = T.trips(spark, sf_dir), vendor_masters(spark)
    old = M.vendor_performance(shifted(trips, 360), vendors, refresh_type="OLD")
    return M.refresh_vendors_full(old, trips, vendors, T.TRIPS_AS_OF)


@query(
    "mv_vendor_inc",
    sql(
        "vendor_day",
        f"""SELECT {VENDOR_DAY_COLUMNS}, CAST(metric_date AS VARCHAR) AS metric_date,
          CASE WHEN metric_date >= DATE '2024-01-28' THEN 'INCREMENTAL' ELSE 'FULL' END AS refresh_type FROM vendor_day""",
    ),
)
def mv_vendor_inc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A summary that stopped during 28 January, brought up to date from the last 24 hours."""
    trips, vendors = T.trips(spark, sf_dir), vendor_masters(spark)
    before = trips.filter(F.col("tpep_pickup_datetime") < at("2024-01-28 15:30:00"))
    old = M.vendor_performance(before, vendors)
    return M.refresh_vendors_incremental(old, trips, vendors, INCREMENT_AS_OF)


@query(
    "mv_vendor_stream",
    sql(
        "vendor_day",
        f"""SELECT {VENDOR_DAY_COLUMNS}, CAST(metric_date AS VARCHAR) AS metric_date, 'INCREMENTAL' AS refresh_type FROM vendor_day""",
    ),
)
def mv_vendor_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary after five micro-batches that each hold trips of many days, merged every second batch."""
    landed, store, summary, mark = (scratch_path(spark, f"stream-{n}") for n in ("in", "store", "summary", "mark"))
    trips, vendors = T.trips(spark, sf_dir).drop("cab_type_id"), vendor_masters(spark)
    for part in range(5):
        trips.filter(F.pmod("trip_id", F.lit(5)) == part).coalesce(1).write.parquet(f"{landed}/{part}")
    stream = refresh.trip_stream(spark, landed, trips.schema, files_per_batch=1)
    refresh.start_vendor_refresh(stream, store, summary, vendors, mark, available_now=True, keep=2).awaitTermination()
    return spark.read.parquet(summary)


@query(
    "mv_routes",
    sql(
        "routes",
        f"""SELECT {bigint('pickup_zone_id dropoff_zone_id peak_hour')}, CAST(metric_date AS VARCHAR) AS metric_date,
          trip_count, avg_fare, avg_distance, avg_duration, 'FULL' AS refresh_type FROM routes""",
    ),
)
def mv_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.route_patterns(T.trips(spark, sf_dir), T.TRIPS_AS_OF)


@query(
    "mv_routes_refresh",
    sql(
        "routes",
        f"""SELECT {bigint('pickup_zone_id dropoff_zone_id peak_hour')}, CAST(metric_date AS VARCHAR) AS metric_date,
          trip_count, avg_fare, avg_distance, avg_duration, 'FULL' AS refresh_type FROM routes""",
    ),
)
def mv_routes_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two refreshes leave on disk: the first, months earlier, kept days that the second drops."""
    target, log = scratch_path(spark, "routes"), scratch_path(spark, "routes-log")
    trips = T.trips(spark, sf_dir)
    early = str(spark.range(1).select(days_before(at(T.TRIPS_AS_OF), 60)).first()[0])
    for as_of in (early, T.TRIPS_AS_OF):
        jobs.refresh_route_patterns(spark, trips, target, log, as_of)
    return spark.read.parquet(target).drop("last_updated")


@query(
    "jn_corr_argmax",
    sql("peaks", f"SELECT {bigint('pickup_zone_id dropoff_zone_id h n')}, CAST(metric_date AS VARCHAR) AS metric_date FROM peaks"),
)
def jn_corr_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Busiest hour of each route and day with its trips."""
    pickup = F.col("tpep_pickup_datetime")
    hourly = (
        T.trips(spark, sf_dir)
        .groupBy(
            F.col("pulocationid").alias("pickup_zone_id"),
            F.col("dolocationid").alias("dropoff_zone_id"),
            F.to_date(pickup).alias("metric_date"),
            F.hour(pickup).alias("h"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = F.max_by(F.struct("h", "n"), F.struct(F.col("n"), -F.col("h"))).alias("best")
    return hourly.groupBy(*M.ROUTE_DAY).agg(best).select(*M.ROUTE_DAY, "best.h", "best.n")


@query(
    "an_vendor_recent",
    sql(
        "vendor_day",
        """SELECT vendor_name, CAST(metric_date AS VARCHAR) AS metric_date, total_trips, total_revenue, avg_fare, avg_tip_pct
        FROM vendor_day WHERE metric_date >= DATE '2024-01-01' AND vendor_name IS NOT NULL
        ORDER BY vendor_day.metric_date DESC, total_revenue DESC, vendor_name LIMIT 20""",
    ),
)
def an_vendor_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = M.vendor_performance(T.trips(spark, sf_dir), vendor_masters(spark))
    return M.recent_vendor_days(summary, T.TRIPS_AS_OF)


@query(
    "an_top_routes",
    sql(
        "routes mzones",
        """SELECT p.zone_name AS pickup_zone, d.zone_name AS dropoff_zone, CAST(sum(trip_count) AS BIGINT) AS total_trips,
          CAST(sum(CAST(round(avg_fare * 100) AS BIGINT)) AS DOUBLE) / (100 * count(*)) AS avg_fare,
          CAST(sum(CAST(round(avg_distance * 100) AS BIGINT)) AS DOUBLE) / (100 * count(*)) AS avg_distance_miles,
          CAST(sum(CAST(round(avg_fare * 100) AS BIGINT) * trip_count) AS DOUBLE) / CAST(100 * sum(trip_count) AS DOUBLE)
            AS weighted_avg_fare
        FROM routes LEFT JOIN mzones p ON pickup_zone_id = p.source_zone_id
        LEFT JOIN mzones d ON dropoff_zone_id = d.source_zone_id
        WHERE metric_date >= DATE '2024-01-24' GROUP BY 1, 2
        ORDER BY total_trips DESC, pickup_zone NULLS FIRST, dropoff_zone NULLS FIRST LIMIT 10""",
    ),
)
def an_top_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    routes = M.route_patterns(T.trips(spark, sf_dir), T.TRIPS_AS_OF)
    return M.top_routes(routes, zone_masters(spark, sf_dir), T.TRIPS_AS_OF)


@query(
    "dq_mv_fresh",
    sql(
        "vendor_day routes",
        """SELECT 'vendor_performance' AS view_name, CAST(max(metric_date) + INTERVAL 90 MINUTE AS VARCHAR) AS last_refresh,
          date_sub('minute', max(metric_date) + INTERVAL 90 MINUTE, TIMESTAMP '2024-01-31') AS minutes_since_refresh,
          count(*) AS total_records FROM vendor_day
        UNION ALL SELECT 'route_patterns', CAST(max(metric_date) + INTERVAL 3 HOUR AS VARCHAR),
          date_sub('minute', max(metric_date) + INTERVAL 3 HOUR, TIMESTAMP '2024-01-31'), count(*) FROM routes""",
    ),
)
def dq_mv_fresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each day's rows count as refreshed some time into that day."""
    trips = T.trips(spark, sf_dir)

    def stamped(df: DataFrame, minutes: int) -> DataFrame:
        shift = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes), F.lit(0))
        return df.withColumn("last_updated", F.col("metric_date").cast("timestamp_ntz") + shift)

    summaries = {
        "vendor_performance": stamped(M.vendor_performance(trips, vendor_masters(spark)), 90),
        "route_patterns": stamped(M.route_patterns(trips, T.TRIPS_AS_OF), 180),
    }
    return M.freshness_of(summaries, T.TRIPS_AS_OF)


# --- table changes -------------------------------------------------------------------------


@query(
    "snk_upsert",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders
       WHERE o_orderkey % 4 <> 0 OR o_orderkey % 5 = 0""",
)
def snk_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth order arrives changed; those missing from the table are inserted."""
    orders = T.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    held = orders.filter("o_orderkey % 4 <> 0")
    changes = orders.filter("o_orderkey % 5 = 0").withColumn("o_orderstatus", F.lit("X"))
    return tables.upsert(held, changes, ["o_orderkey"])


@query(
    "snk_retain",
    """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_day FROM orders
       WHERE o_orderdate >= TIMESTAMP '2001-11-05' - INTERVAL 1500 DAY""",
)
def snk_retain(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = T.table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("o_day"))
    return tables.retain(orders, "o_day", T.LINES_AS_OF, 1500)


@query(
    "snk_delete",
    """SELECT c_custkey, c_mktsegment FROM customer
       WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""",
)
def snk_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = T.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    gone = T.table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'")
    return tables.without_keys(customer, gone.select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query(
    "snk_update_case",
    """SELECT p_partkey, CASE WHEN p_size > 25 THEN 'LARGE' ELSE p_brand END AS p_brand,
         CASE WHEN p_size > 25 THEN p_retailprice * 2 ELSE p_retailprice END AS p_retailprice FROM part""",
)
def snk_update_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = T.table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_retailprice", "p_size")
    changed = tables.update(
        part, F.col("p_size") > 25, {"p_brand": F.lit("LARGE"), "p_retailprice": F.col("p_retailprice") * 2}
    )
    return changed.drop("p_size")


@query(
    "snk_log",
    sql(
        "vendor_day",
        """SELECT 'vendor_performance_full' AS transformation_name, '1.0.0' AS version,
          '2024-01-31 02:00:00' AS execution_start, '2024-01-31 02:05:00' AS execution_end, 'SUCCESS' AS status,
          count(*) AS rows_processed, 'summary_refresh' AS executed_by FROM vendor_day""",
    ),
)
def snk_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = M.vendor_performance(T.trips(spark, sf_dir), vendor_masters(spark))
    return tables.run_log(
        built, "vendor_performance_full", "1.0.0", "2024-01-31 02:00:00", "2024-01-31 02:05:00", "summary_refresh"
    )
