"""Lake zones and hourly KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.catalogue import query
from meterlake.catalogue.sqltext import dollars, ratio, sql
from meterlake.plans import lake
from meterlake.sources import masters
from meterlake.sources import testtables as T


def golden_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = lake.featurise(lake.validate(T.trips(spark, sf_dir)))
    enriched = lake.enrich(
        silver, masters.vendors(spark), masters.rate_codes(spark), T.zones(spark, sf_dir)
    )
    return lake.golden(enriched)


@query(
    "an_kpi",
    sql(
        "golden",
        f""", g AS (SELECT date_trunc('hour', tpep_pickup_datetime) AS h, pulocationid, pu_zone, pu_borough,
             dolocationid, do_zone, do_borough, count(*) AS n, sum(fare_c) AS fc, sum(tip_c) AS tc,
             sum(total_c) AS ac, avg(tip_pct) AS tp, sum(high_tip_flag) AS ht, sum(dist_c) AS dc,
             sum(secs) AS sc, sum(CASE WHEN dist_c > 2000 THEN 1 ELSE 0 END) AS lt,
             sum(CASE WHEN dist_c < 100 THEN 1 ELSE 0 END) AS st FROM golden GROUP BY ALL)
        SELECT CAST(year(h) AS BIGINT) AS pickup_year, CAST(month(h) AS BIGINT) AS pickup_month,
          CAST(day(h) AS BIGINT) AS pickup_day, CAST(hour(h) AS BIGINT) AS pickup_hour,
          CAST(dayofweek(h) + 1 AS BIGINT) AS pickup_day_of_week,
          CAST(day(h) AS BIGINT) AS pickup_day_of_month,
          CAST(pulocationid AS BIGINT) AS pulocationid, pu_zone, pu_borough,
          CAST(dolocationid AS BIGINT) AS dolocationid, do_zone, do_borough,
          CAST(n AS BIGINT) AS total_rides, {dollars('fc')} AS total_fare, {dollars('tc')} AS total_tip,
          {dollars('ac')} AS total_revenue, {ratio('fc', '100 * n')} AS avg_fare,
          round(tp, 6) AS avg_tip_pct, CAST(ht AS BIGINT) AS num_high_tip_trips,
          {ratio('dc', '100 * n')} AS avg_trip_distance, {ratio('sc', '60 * n')} AS avg_trip_duration,
          {dollars('dc')} AS sum_trip_distance, CAST(lt AS BIGINT) AS num_long_trips,
          CAST(st AS BIGINT) AS num_short_trips,
          CAST(CASE WHEN hour(h) BETWEEN 7 AND 10 OR hour(h) BETWEEN 16 AND 19 THEN n ELSE 0 END AS BIGINT)
            AS num_rush_hour_rides,
          {ratio('ac', 'dc')} AS revenue_per_mile, {ratio('ac', '100 * n')} AS avg_revenue_per_ride,
          CASE WHEN sc > 0 THEN {ratio('dc * 36', 'sc')} ELSE 0.0 END AS avg_speed_mph,
          {ratio('tc', 'dc')} AS tip_per_mile,
          'curated_aggregated' AS data_zone, 'Ops VP' AS data_owner, 'trip_kpis' AS data_domain,
          '2024-01-31 00:00:00' AS aggregated_at
        FROM g""",
    ),
)
def an_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = T.zones(spark, sf_dir)
    out = lake.kpis(golden_trips(spark, sf_dir), zones, T.TRIPS_AS_OF)
    return out.withColumn("avg_tip_pct", F.round("avg_tip_pct", 6))


@query(
    "flt_valid",
    sql(
        "valid",
        f"""SELECT trip_id, CAST(vendorid AS BIGINT) AS vendorid,
          CAST(tpep_pickup_datetime AS VARCHAR) AS tpep_pickup_datetime,
          round(secs / 60.0, 4) AS trip_duration_minutes,
          round(tip_c * 100.0 / fare_c, 6) AS tip_pct,
          CAST(hour(tpep_pickup_datetime) AS BIGINT) AS pickup_hour,
          CAST(dayofweek(tpep_pickup_datetime) + 1 AS BIGINT) AS pickup_day_of_week,
          CAST(CASE WHEN dist_c > 2000 THEN 1 ELSE 0 END AS BIGINT) AS is_long_trip,
          CAST(CASE WHEN dist_c < 100 THEN 1 ELSE 0 END AS BIGINT) AS is_short_trip,
          CAST(CASE WHEN tip_c * 5 > fare_c THEN 1 ELSE 0 END AS BIGINT) AS high_tip_flag
        FROM valid""",
    ),
)
def flt_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = lake.featurise(lake.validate(T.trips(spark, sf_dir)))
    return silver.select(
        "trip_id",
        "vendorid",
        "tpep_pickup_datetime",
        F.round(F.col("trip_duration_minutes").cast("double"), 4).alias("trip_duration_minutes"),
        F.round("tip_pct", 6).alias("tip_pct"),
        "pickup_hour",
        "pickup_day_of_week",
        "is_long_trip",
        "is_short_trip",
        "high_tip_flag",
    )


@query(
    "dq_gate",
    sql(
        "valid vendors rates zones",
        """SELECT CAST(count(*) AS BIGINT) AS total_records,
          CAST(count_if(vendorid IN (SELECT vendor_id FROM vendors)
            AND ratecodeid IN (SELECT rate_code_id FROM rates)
            AND pulocationid IN (SELECT locationid FROM zones)
            AND dolocationid IN (SELECT locationid FROM zones)) AS BIGINT) AS golden_records,
          CAST(golden_records AS DOUBLE) / total_records AS resolved_ratio,
          resolved_ratio >= 0.99 AS passed FROM valid""",
    ),
)
def dq_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake.gate_report(
        lake.validate(T.trips(spark, sf_dir)),
        masters.vendors(spark),
        masters.rate_codes(spark),
        T.zones(spark, sf_dir),
    )
