"""Star schema loads, rollups and reporting views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.catalogue import query
from meterlake.catalogue.sqltext import FACT_SELECT, bigint, dollars, ratio, rdiv, sql
from meterlake.operators import keys
from meterlake.plans import warehouse as W
from meterlake.sources import testtables as T


def dims(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return W.warehouse_dims(spark, T.zones(spark, sf_dir), T.CORE_BOROUGH)


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.load_fact(T.trips(spark, sf_dir), dims(spark, sf_dir))


def counted(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias(name))


# --- dimensions, each with how often the trips or orders use its members -------------------


@query(
    "dm_date",
    sql(
        "ddate",
        f""", days AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1),
        span AS (SELECT DATE '1990-01-01' + CAST(i AS INTEGER) AS d FROM range(15000) AS r(i)),
        cal AS (SELECT * FROM span WHERE d BETWEEN (SELECT min(d) FROM days) AND (SELECT max(d) FROM days))
        SELECT CAST(strftime(c.d, '%Y%m%d') AS BIGINT) AS date_sk, CAST(c.d AS VARCHAR) AS full_date,
          CAST(dayofweek(c.d) AS BIGINT) AS day_of_week, dayname(c.d) AS day_of_week_name,
          CAST(day(c.d) AS BIGINT) AS day_of_month, CAST(dayofyear(c.d) AS BIGINT) AS day_of_year,
          CAST(weekofyear(c.d) AS BIGINT) AS week_of_year, CAST(month(c.d) AS BIGINT) AS month_number,
          monthname(c.d) AS month_name, left(monthname(c.d), 3) AS month_short,
          CAST(quarter(c.d) AS BIGINT) AS quarter, 'Q' || quarter(c.d) AS quarter_name,
          CAST(year(c.d) AS BIGINT) AS year, strftime(c.d, '%Y-%m') AS year_month,
          dayofweek(c.d) IN (0, 6) AS is_weekend, false AS is_holiday,
          CAST(coalesce(n, 0) AS BIGINT) AS n_orders
        FROM cal c LEFT JOIN days USING (d)""",
    ),
)
def dm_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar over every day from the first to the last order."""
    orders = T.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d"))
    per_day = orders.groupBy("d").agg(F.count(F.lit(1)).alias("n_orders"))
    days = per_day.agg(F.min("d").alias("lo"), F.max("d").alias("hi")).select(
        F.explode(F.sequence("lo", "hi")).alias("full_date")
    )
    calendar = W.calendar_columns(days)
    return calendar.join(per_day, calendar.full_date == per_day.d, "left").drop("d").fillna(0, ["n_orders"])


@query(
    "dm_time",
    sql(
        "trips dtime",
        f""", n AS (SELECT hour(tpep_pickup_datetime) AS h, count(*) AS n FROM trips GROUP BY 1)
        SELECT {bigint('time_sk hour_24 hour_12')}, am_pm, time_period, rush_hour_flag, day_part, business_hour,
          coalesce(n, 0) AS n_trips FROM dtime LEFT JOIN n ON h = time_sk""",
    ),
)
def dm_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = counted(T.trips(spark, sf_dir).withColumn("h", F.hour("tpep_pickup_datetime")), "h", "n_trips")
    times = W.dim_time(spark)
    return times.join(used, times.time_sk == used["_key"], "left").drop("_key").fillna(0, ["n_trips"])


@query(
    "dm_vendor",
    sql(
        "trips dvendor",
        f""", n AS (SELECT vendorid, count(*) AS n FROM trips GROUP BY 1)
        SELECT {bigint('vendor_sk vendor_id')}, vendor_name, vendor_code, coalesce(n, 0) AS n_trips
        FROM dvendor LEFT JOIN n ON vendorid = vendor_id""",
    ),
)
def dm_vendor(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = counted(T.trips(spark, sf_dir), "vendorid", "n_trips")
    vendor = W.dim_vendor(spark)
    return vendor.join(used, vendor.vendor_id == used["_key"], "left").drop("_key").fillna(0, ["n_trips"])


@query(
    "dm_ratecode",
    sql(
        "trips drate",
        f""", n AS (SELECT coalesce(ratecodeid, 99) AS c, count(*) AS n FROM trips GROUP BY 1)
        SELECT {bigint('ratecode_sk ratecode_id')}, rate_code_name, rate_description, is_flat_rate, is_negotiated,
          coalesce(n, 0) AS n_trips FROM drate LEFT JOIN n ON c = ratecode_id""",
    ),
)
def dm_ratecode(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = T.trips(spark, sf_dir).withColumn("c", F.coalesce("ratecodeid", F.lit(99)))
    used = counted(coded, "c", "n_trips")
    rate = W.dim_ratecode(spark)
    return rate.join(used, rate.ratecode_id == used["_key"], "left").drop("_key").fillna(0, ["n_trips"])


@query(
    "dm_payment",
    sql(
        "trips dpay",
        f""", n AS (SELECT payment_type, count(*) AS n FROM trips GROUP BY 1)
        SELECT {bigint('payment_sk payment_type_id')}, payment_type_name, payment_category, allows_tip_record,
          coalesce(n, 0) AS n_trips FROM dpay LEFT JOIN n ON payment_type = payment_type_id""",
    ),
)
def dm_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = counted(T.trips(spark, sf_dir), "payment_type", "n_trips")
    payment = W.dim_payment(spark)
    joined = payment.join(used, payment.payment_type_id == used["_key"], "left")
    return joined.drop("_key").fillna(0, ["n_trips"])


@query(
    "dm_zone",
    sql(
        "trips dzone",
        f""", n AS (SELECT pulocationid, count(*) AS n FROM trips GROUP BY 1)
        SELECT {bigint('zone_sk location_id')}, borough, zone_name, service_zone, is_airport, is_manhattan,
          is_yellow_zone, zone_category, coalesce(n, 0) AS n_trips
        FROM dzone LEFT JOIN n ON pulocationid = location_id""",
    ),
)
def dm_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = counted(T.trips(spark, sf_dir), "pulocationid", "n_trips")
    zone = W.dim_zone(T.zones(spark, sf_dir), T.CORE_BOROUGH)
    return zone.join(used, zone.location_id == used["_key"], "left").drop("_key").fillna(0, ["n_trips"])


@query(
    "dm_key",
    """SELECT c_custkey, c_name, CAST(CASE WHEN c_custkey % 3 = 0 THEN c_custkey // 3 + 1
         ELSE (SELECT max(c_custkey // 3 + 1) FROM customer WHERE c_custkey % 3 = 0)
           + row_number() OVER (PARTITION BY c_custkey % 3 = 0 ORDER BY c_custkey) END AS BIGINT) AS customer_sk
       FROM customer""",
)
def dm_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two thirds of the customers arrive new and get keys after those in use."""
    customer = T.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    known = customer.filter("c_custkey % 3 = 0").withColumn("customer_sk", F.expr("c_custkey div 3 + 1"))
    new = customer.filter("c_custkey % 3 <> 0")
    return known.unionByName(keys.with_surrogate_keys(new, known, "c_custkey", "customer_sk"))


@query(
    "dm_change_id",
    """SELECT o_orderkey, o_orderstatus, 5000 + row_number() OVER (ORDER BY o_orderkey) AS change_id
       FROM orders WHERE o_orderstatus <> 'O'""",
)
def dm_change_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = T.table(spark, sf_dir, "orders").filter("o_orderstatus <> 'O'")
    ids = keys.with_change_id(changes.select("o_orderkey", "o_orderstatus"), 5000, "o_orderkey")
    return ids


# --- facts and rollups ---------------------------------------------------------------------


@query("an_fact", sql("fact", f"{FACT_SELECT} fact"))
def an_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact(spark, sf_dir)


def vendor_versions(spark: SparkSession) -> DataFrame:
    """Vendor 2 was renamed on 10 January, vendor 6 on 20 January."""
    return W.dim_vendor(spark).selectExpr(
        "explode(CASE WHEN vendor_id IN (2, 6) THEN array(1, 2) ELSE array(1) END) AS version_number", "*"
    ).selectExpr(
        "vendor_sk + if(version_number = 2, 100, 0) AS vendor_sk",
        "vendor_id",
        "vendor_name",
        "version_number",
        "CASE WHEN version_number = 1 THEN timestamp_ntz'1900-01-01 00:00:00'"
        " WHEN vendor_id = 2 THEN timestamp_ntz'2024-01-10 00:00:00'"
        " ELSE timestamp_ntz'2024-01-20 12:00:00' END AS effective_start_date",
        "CASE WHEN version_number = 2 OR vendor_id NOT IN (2, 6) THEN timestamp_ntz'9999-12-31 23:59:59'"
        " WHEN vendor_id = 2 THEN timestamp_ntz'2024-01-10 00:00:00'"
        " ELSE timestamp_ntz'2024-01-20 12:00:00' END AS effective_end_date",
    )


def zone_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth zone gets a new version on 15 January that is no airport any more."""
    return W.dim_zone(T.zones(spark, sf_dir), T.CORE_BOROUGH).selectExpr(
        "explode(CASE WHEN location_id % 10 = 0 THEN array(1, 2) ELSE array(1) END) AS version_number", "*"
    ).selectExpr(
        "zone_sk + if(version_number = 2, 1000, 0) AS zone_sk",
        "location_id",
        "borough",
        "zone_name",
        "zone_category",
        "is_airport AND version_number = 1 AS is_airport",
        "if(version_number = 1, timestamp_ntz'1900-01-01 00:00:00', timestamp_ntz'2024-01-15 00:00:00')"
        " AS effective_start_date",
        "if(version_number = 2 OR location_id % 10 <> 0, timestamp_ntz'9999-12-31 23:59:59',"
        " timestamp_ntz'2024-01-15 00:00:00') AS effective_end_date",
    )


FACT_ASOF = """, versioned AS (SELECT s.*,
     coalesce(v.vendor_sk + CASE WHEN (s.vendorid = 2 AND tpep_pickup_datetime >= '2024-01-10')
         OR (s.vendorid = 6 AND tpep_pickup_datetime >= '2024-01-20 12:00:00') THEN 100 ELSE 0 END, 5) AS vendor_sk,
     coalesce(p.zone_sk + CASE WHEN p.location_id % 10 = 0 AND tpep_pickup_datetime >= '2024-01-15' THEN 1000 ELSE 0 END, 1)
       AS pickup_zone_sk,
     coalesce(d.zone_sk + CASE WHEN d.location_id % 10 = 0 AND tpep_dropoff_datetime >= '2024-01-15' THEN 1000 ELSE 0 END, 1)
       AS dropoff_zone_sk,
     coalesce(r.ratecode_sk, 7) AS ratecode_sk, coalesce(y.payment_sk, 5) AS payment_sk,
     coalesce(p.is_airport AND NOT (p.location_id % 10 = 0 AND tpep_pickup_datetime >= '2024-01-15'), false)
       OR coalesce(d.is_airport AND NOT (d.location_id % 10 = 0 AND tpep_dropoff_datetime >= '2024-01-15'), false)
       AS is_airport_trip
   FROM staged s LEFT JOIN dvendor v ON s.vendorid = v.vendor_id
   LEFT JOIN dzone p ON s.pulocationid = p.location_id LEFT JOIN dzone d ON s.dolocationid = d.location_id
   LEFT JOIN drate r ON coalesce(s.ratecodeid, 99) = r.ratecode_id
   LEFT JOIN dpay y ON coalesce(s.payment_type, 0) = y.payment_type_id)
"""


def fact_asof(spark: SparkSession, sf_dir: str, small: bool | None = None) -> DataFrame:
    return W.load_fact_asof(
        T.trips(spark, sf_dir),
        vendor_versions(spark),
        zone_versions(spark, sf_dir),
        dims(spark, sf_dir),
        small=small,
    )


@query("an_fact_asof", sql("staged dvendor drate dpay dzone", f"{FACT_ASOF} {FACT_SELECT} versioned"))
def an_fact_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_asof(spark, sf_dir)


@query("an_fact_asof_large", sql("staged dvendor drate dpay dzone", f"{FACT_ASOF} {FACT_SELECT} versioned"))
def an_fact_asof_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way taken when the versioned dimensions are too large to broadcast."""
    return fact_asof(spark, sf_dir, small=False)


@query(
    "an_agg_daily",
    sql(
        "fact",
        f"""SELECT {bigint('pickup_date_sk vendor_sk pickup_zone_sk')}, count(*) AS trip_count,
          CAST(sum(passengers) AS BIGINT) AS total_passengers, {dollars('sum(dist_c)')} AS total_distance,
          {dollars('sum(fare_c)')} AS total_fare, {dollars('sum(tip_c)')} AS total_tips,
          {dollars('sum(total_c)')} AS total_revenue, {ratio('sum(dist_c)', '100 * count(*)')} AS avg_trip_distance,
          {ratio('sum(fare_c)', '100 * count(*)')} AS avg_fare,
          {ratio('sum(tip2)', '100 * count(*)')} AS avg_tip_percentage,
          {ratio('sum(minutes)', 'count(*)')} AS avg_trip_duration,
          CAST(count_if(is_cash_trip) AS BIGINT) AS cash_trip_count,
          CAST(count_if(NOT is_cash_trip) AS BIGINT) AS card_trip_count,
          CAST(count_if(is_airport_trip) AS BIGINT) AS airport_trip_count,
          CAST(count_if(is_rush_hour) AS BIGINT) AS rush_hour_trip_count
        FROM fact GROUP BY pickup_date_sk, vendor_sk, pickup_zone_sk""",
    ),
)
def an_agg_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.agg_daily(fact(spark, sf_dir))


@query(
    "an_agg_hourly",
    sql(
        "fact",
        f"""SELECT CAST(pickup_date_sk AS BIGINT) AS date_sk, CAST(pickup_time_sk AS BIGINT) AS time_sk,
          CAST(pickup_zone_sk AS BIGINT) AS zone_sk, count(*) AS pickup_count, CAST(0 AS BIGINT) AS dropoff_count,
          CAST(0 AS BIGINT) AS net_flow, {dollars('sum(fare_c)')} AS total_fare,
          {ratio('sum(fare_c)', '100 * count(*)')} AS avg_fare
        FROM fact GROUP BY pickup_date_sk, pickup_time_sk, pickup_zone_sk""",
    ),
)
def an_agg_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.agg_hourly(fact(spark, sf_dir))


@query(
    "an_net_flow",
    sql(
        "fact",
        f""", p AS (SELECT pickup_date_sk AS date_sk, pickup_time_sk AS time_sk, pickup_zone_sk AS zone_sk,
               count(*) AS n FROM fact GROUP BY ALL),
        d AS (SELECT dropoff_date_sk AS date_sk, dropoff_time_sk AS time_sk, dropoff_zone_sk AS zone_sk,
               count(*) AS m FROM fact GROUP BY ALL)
        SELECT {bigint('date_sk time_sk zone_sk')}, coalesce(n, 0) AS pickup_count,
          coalesce(m, 0) AS dropoff_count, coalesce(n, 0) - coalesce(m, 0) AS net_flow
        FROM p FULL JOIN d USING (date_sk, time_sk, zone_sk)""",
    ),
)
def an_net_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.net_flow(fact(spark, sf_dir))


@query(
    "an_rev_vendor",
    sql(
        "fact ddate",
        f"""SELECT CAST(full_date AS VARCHAR) AS full_date, vendor_name, count(*) AS trips,
          {dollars('sum(total_c)')} AS revenue
        FROM fact JOIN ddate ON pickup_date_sk = date_sk JOIN dvendor USING (vendor_sk) GROUP BY 1, 2""",
    ),
)
def an_rev_vendor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.revenue_by_vendor(fact(spark, sf_dir), W.dim_vendor(spark), W.dim_date(spark))


@query(
    "an_top_zones",
    sql(
        "fact",
        f"""SELECT zone_name, borough, count(*) AS trips, {dollars('sum(total_c)')} AS revenue
        FROM fact JOIN dzone ON pickup_zone_sk = zone_sk GROUP BY 1, 2
        ORDER BY trips DESC, zone_name, borough LIMIT 10""",
    ),
)
def an_top_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.top_zones(fact(spark, sf_dir), dims(spark, sf_dir)["zone"])


@query(
    "an_rush_cmp",
    sql(
        "fact",
        f"""SELECT CASE WHEN is_rush_hour THEN 'Rush Hour' ELSE 'Non-Rush Hour' END AS period, count(*) AS trips,
          {ratio('sum(fare_c)', '100 * count(*)')} AS avg_fare, {ratio('sum(tip2)', '100 * count(*)')} AS avg_tip_pct
        FROM fact GROUP BY 1""",
    ),
)
def an_rush_cmp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.rush_comparison(fact(spark, sf_dir))


N100 = "100 * count(*)"


@query(
    "an_v_daily",
    sql(
        "fact ddate",
        f"""SELECT CAST(full_date AS VARCHAR) AS trip_date, day_of_week_name, month_name,
          CAST(year AS BIGINT) AS year, is_weekend, vendor_name, count(*) AS total_trips,
          CAST(sum(passengers) AS BIGINT) AS total_passengers, {dollars('sum(dist_c)')} AS total_distance,
          {dollars('sum(fare_c)')} AS total_fare, {dollars('sum(tip_c)')} AS total_tips,
          {dollars('sum(total_c)')} AS total_revenue, {rdiv('sum(dist_c)', N100, 2)} AS avg_trip_distance,
          {rdiv('sum(fare_c)', N100, 2)} AS avg_fare, {rdiv('sum(tip2)', N100, 2)} AS avg_tip_percentage,
          {rdiv('sum(minutes)', 'count(*)', 2)} AS avg_trip_duration,
          CAST(count_if(is_cash_trip) AS BIGINT) AS cash_trips,
          CAST(count_if(is_airport_trip) AS BIGINT) AS airport_trips,
          CAST(count_if(is_rush_hour) AS BIGINT) AS rush_hour_trips
        FROM fact JOIN ddate ON pickup_date_sk = date_sk JOIN dvendor USING (vendor_sk) GROUP BY 1, 2, 3, 4, 5, 6""",
    ),
)
def an_v_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.view_daily(fact(spark, sf_dir), W.dim_vendor(spark), W.dim_date(spark))


@query(
    "an_v_zone",
    sql(
        "fact",
        f"""SELECT borough, zone_name, zone_category, is_airport, count(*) AS pickup_count,
          {dollars('sum(total_c)')} AS total_revenue, {rdiv('sum(fare_c)', N100, 2)} AS avg_fare,
          {rdiv('sum(tip2)', N100, 2)} AS avg_tip_pct, {rdiv('sum(dist_c)', N100, 2)} AS avg_distance
        FROM fact JOIN dzone ON pickup_zone_sk = zone_sk GROUP BY 1, 2, 3, 4""",
    ),
)
def an_v_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.view_zone(fact(spark, sf_dir), dims(spark, sf_dir)["zone"])


@query(
    "an_v_hourly",
    sql(
        "fact ddate dtime",
        f"""SELECT CAST(hour_24 AS BIGINT) AS hour_24, time_period, rush_hour_flag, day_part, day_of_week_name,
          is_weekend, count(*) AS trip_count, {dollars('sum(total_c)')} AS total_revenue,
          {rdiv('sum(fare_c)', N100, 2)} AS avg_fare
        FROM fact JOIN dtime ON pickup_time_sk = time_sk JOIN ddate ON pickup_date_sk = date_sk
        GROUP BY 1, 2, 3, 4, 5, 6""",
    ),
)
def an_v_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.view_hourly(fact(spark, sf_dir), W.dim_time(spark), W.dim_date(spark))


@query(
    "an_v_payment",
    sql(
        "fact",
        f"""SELECT payment_type_name, payment_category, count(*) AS trip_count,
          {dollars('sum(total_c)')} AS total_revenue, {rdiv('sum(fare_c)', N100, 2)} AS avg_fare,
          {rdiv('sum(tip_c)', N100, 2)} AS avg_tip, {rdiv('sum(tip2)', N100, 2)} AS avg_tip_pct
        FROM fact JOIN dpay USING (payment_sk) GROUP BY 1, 2""",
    ),
)
def an_v_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.view_payment(fact(spark, sf_dir), W.dim_payment(spark))


@query(
    "an_v_masked",
    sql(
        "fact",
        f"""SELECT trip_id AS trip_sk, {bigint('pickup_date_sk pickup_time_sk vendor_sk pickup_zone_sk dropoff_zone_sk')},
          {rdiv('fare_c', '1000', 0)} * 10 AS fare_amount_rounded,
          {rdiv('tip_c', '500', 0)} * 5 AS tip_amount_rounded,
          {rdiv('total_c', '1000', 0)} * 10 AS total_amount_rounded, {dollars('dist_c')} AS trip_distance,
          CAST(passengers AS BIGINT) AS passenger_count, CAST(minutes AS BIGINT) AS trip_duration_minutes,
          is_rush_hour, is_airport_trip, is_cash_trip FROM fact""",
    ),
)
def an_v_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.view_masked(fact(spark, sf_dir))


@query(
    "dq_rowcounts",
    sql(
        "fact",
        """SELECT 'dim_vendor' AS table_name, count(*) AS row_count FROM dvendor
        UNION ALL SELECT 'dim_zone', count(*) FROM dzone UNION ALL SELECT 'dim_ratecode', count(*) FROM drate
        UNION ALL SELECT 'dim_payment', count(*) FROM dpay UNION ALL SELECT 'stg_trips', count(*) FROM trips
        UNION ALL SELECT 'fact_trip', count(*) FROM fact
        UNION ALL SELECT 'agg_daily', count(*) FROM (SELECT DISTINCT pickup_date_sk, vendor_sk, pickup_zone_sk FROM fact)
        UNION ALL SELECT 'agg_hourly', count(*) FROM (SELECT DISTINCT pickup_date_sk, pickup_time_sk, pickup_zone_sk FROM fact)""",
    ),
)
def dq_rowcounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, f, staged = dims(spark, sf_dir), fact(spark, sf_dir), T.trips(spark, sf_dir)
    tables = {
        "dim_vendor": d["vendor"],
        "dim_zone": d["zone"],
        "dim_ratecode": d["ratecode"],
        "dim_payment": d["payment"],
        "stg_trips": staged,
        "fact_trip": f,
        "agg_daily": W.agg_daily(f),
        "agg_hourly": W.agg_hourly(f),
    }
    return W.row_counts(tables)
