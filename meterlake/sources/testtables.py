"""The supplied benchmark tables seen as trips, zones and masters.

``events`` carries the trips because its ids are unique and its times are real. Every
expression is whole-number arithmetic with one division by 100 for money, so any engine
computes the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterlake.sources.masters import values

TRIPS_AS_OF = "2024-01-31 00:00:00"
LINES_AS_OF = "2001-11-05 00:00:00"
CORE_BOROUGH = "ASIA"


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A supplied table. Its schema is read from a file footer once, not per query."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


SECOND = "INTERVAL '1' SECOND"
EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as trips.

    Short chains of constants are array lookups and times are multiples of one second: the
    code generated for a stage then stays small enough for the JVM to compile.
    """
    base = table(spark, sf_dir, "events").selectExpr(
        "event_id AS k",
        "user_id AS u",
        "cast(CASE event_type WHEN 'click' THEN 1 WHEN 'purchase' THEN 1 WHEN 'view' THEN 2"
        " WHEN 'signup' THEN 3 ELSE 4 END AS int) AS payment_type",
        f"{EPOCH} + cast(cast(ts - {EPOCH} AS interval second) AS bigint) * {SECOND} AS pickup",
        "cast(round(value * 100) AS bigint) * if(event_id % 211 = 5, -1, 1) AS fc",
    )
    tips = base.selectExpr("*", "if(payment_type = 1, fc * (k % 6) * 5 div 100, 0L) AS tip_c")
    return tips.selectExpr(
        "k AS trip_id",
        "CASE WHEN k % 1000 = 11 THEN NULL WHEN k % 500 = 3 THEN 3"
        " ELSE try_element_at(array(1, 2, 6, 7), cast(k % 4 AS int) + 1) END AS vendorid",
        "pickup AS tpep_pickup_datetime",
        f"if(k % 701 = 9, NULL, pickup + ((k * 131) % 5400 - 60) * {SECOND}) AS tpep_dropoff_datetime",
        "cast(k % 7 AS double) AS passenger_count",
        "cast((k * 37) % 2500 AS double) / 100 AS trip_distance",
        "if(k % 41 > 6, 1, try_element_at(array(2, 3, 4, 5, 6, 99, NULL), cast(k % 41 AS int) + 1)) AS ratecodeid",
        "if(k % 50 = 0, 'Y', 'N') AS store_and_fwd_flag",
        "cast(if(k % 400 = 7, 265, u % 25) AS int) AS pulocationid",
        "cast((u + k) % 25 AS int) AS dolocationid",
        "payment_type",
        "cast(fc AS double) / 100 AS fare_amount",
        "cast(k % 3 * 50 AS double) / 100 AS extra",
        "0.5D AS mta_tax",
        "cast(tip_c AS double) / 100 AS tip_amount",
        "if(k % 10 = 0, 6.94D, 0.0D) AS tolls_amount",
        "1.0D AS improvement_surcharge",
        "cast(fc + tip_c + k % 3 * 50 + if(k % 10 = 0, 1094, 400) + if(k % 13 = 0, 175, 0)"
        " + if(k % 997 = 1, 1, 0) AS double) / 100 AS total_amount",
        "2.5D AS congestion_surcharge",
        "if(k % 13 = 0, 1.75D, 0.0D) AS airport_fee",
        "0.0D AS cbd_congestion_fee",
        "cast(1 + k % 2 AS int) AS cab_type_id",
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "n_nationkey AS locationid",
        "r_name AS borough",
        "n_name AS zone",
        "CASE n_nationkey % 5 WHEN 0 THEN 'Airports' WHEN 1 THEN 'Yellow Zone'"
        " ELSE 'Boro Zone' END AS service_zone",
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One observation per day with trips, the last day missing."""
    days = (
        table(spark, sf_dir, "events")
        .select(F.to_date("ts").alias("date"))
        .distinct()
        .filter("date < date'2024-01-30'")
    )
    return days.selectExpr("date", "cast((day(date) * 7) % 11 AS double) / 10 AS precipitation")


def neighbourhoods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr("n_nationkey AS gid", "n_name AS ntaname")


def master_vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as vendor masters in various governance states."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey + 1 AS vendor_id",
        "s_suppkey AS source_vendor_id",
        "s_name AS vendor_name",
        "CASE WHEN s_suppkey % 7 = 3 THEN 'PROPOSED' WHEN s_suppkey % 11 = 5 THEN 'REJECTED'"
        " ELSE 'ACTIVE' END AS lifecycle_state",
        "cast(90 + s_suppkey % 11 AS decimal(5,2)) AS match_confidence",
        "'catalogue' AS source_system",
        "timestamp_ntz'2000-01-01 00:00:00'"
        " + make_dt_interval(cast(s_suppkey % 600 AS int), 0, 0, 0) AS created_at",
        "'initial_load' AS created_by",
        "if(s_suppkey % 7 = 3 OR s_suppkey % 13 = 1, NULL, 'steward') AS approved_by",
        "if(s_suppkey % 17 = 2, NULL, s_suppkey) AS change_id",
    )


def versioned_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One to three versions per supplier, half-open and gap-free."""
    starts = values(
        spark,
        ["version_number int", "effective_start_date timestamp_ntz", "modulus int"],
        [
            (1, "1900-01-01 00:00:00", 1),
            (2, "1998-01-01 00:00:00", 10),
            (3, "2000-01-01 00:00:00", 30),
        ],
    )
    supplier = table(spark, sf_dir, "supplier")
    versions = supplier.join(F.broadcast(starts), F.expr("s_suppkey % modulus = 0"))
    return versions.selectExpr(
        "s_suppkey",
        "if(version_number = 1, s_name, concat(s_name, ' v', version_number)) AS supplier_name",
        "version_number",
        "effective_start_date",
        "CASE WHEN version_number = 1 AND s_suppkey % 10 = 0 THEN timestamp_ntz'1998-01-01 00:00:00'"
        " WHEN version_number = 2 AND s_suppkey % 30 = 0 THEN timestamp_ntz'2000-01-01 00:00:00'"
        " ELSE timestamp_ntz'9999-12-31 23:59:59' END AS effective_end_date",
        "CASE version_number WHEN 1 THEN s_suppkey % 10 <> 0 WHEN 2 THEN s_suppkey % 30 <> 0"
        " ELSE true END AS is_current",
    )
