"""Declared table schemas and fixed reference values."""

from __future__ import annotations

from pyspark.sql import types as T

OPEN_END = "9999-12-31 23:59:59"
BEGINNING = "1900-01-01 00:00:00"

TRIP_SCHEMA = T.StructType(
    [
        T.StructField("vendorid", T.IntegerType()),
        T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
        T.StructField("passenger_count", T.DoubleType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("ratecodeid", T.IntegerType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("pulocationid", T.IntegerType()),
        T.StructField("dolocationid", T.IntegerType()),
        T.StructField("payment_type", T.IntegerType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("improvement_surcharge", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("congestion_surcharge", T.DoubleType()),
        T.StructField("airport_fee", T.DoubleType()),
        T.StructField("cbd_congestion_fee", T.DoubleType()),
    ]
)

ZONE_SCHEMA = T.StructType(
    [
        T.StructField("locationid", T.IntegerType()),
        T.StructField("borough", T.StringType()),
        T.StructField("zone", T.StringType()),
        T.StructField("service_zone", T.StringType()),
    ]
)

# --- Fixed values: master data of the public trip-record dictionary -----------------------

# vendor id, name, code; 0 is the unknown member of the warehouse
VENDORS = [
    (1, "Creative Mobile Technologies, LLC", "CMT"),
    (2, "Curb Mobility, LLC", "CURB"),
    (6, "Myle Technologies Inc", "MYLE"),
    (7, "Helix", "HELIX"),
    (0, "Unknown Vendor", "UNK"),
]

# rate code id, name in the lake
LAKE_RATE_CODES = [
    (1, "Standard rate"),
    (2, "JFK"),
    (3, "Newark"),
    (4, "Nassau or Westchester"),
    (5, "Negotiated fare"),
    (6, "Group ride"),
    (99, "Null/unknown"),
]

# rate code id, name, description, flat rate, negotiated in the warehouse
RATE_CODES = [
    (1, "Standard Rate", "Standard metered fare", False, False),
    (2, "JFK", "Flat fare to/from JFK Airport", True, False),
    (3, "Newark", "Newark Airport fare", False, False),
    (4, "Nassau/Westchester", "Trips to Nassau or Westchester", False, False),
    (5, "Negotiated Fare", "Pre-negotiated flat fare", True, True),
    (6, "Group Ride", "Shared ride fare", False, False),
    (99, "Unknown", "Unknown or null rate code", False, False),
]

# payment type id, name, category, tips recorded
PAYMENTS = [
    (1, "Credit Card", "ELECTRONIC", True),
    (2, "Cash", "CASH", False),
    (3, "No Charge", "OTHER", False),
    (4, "Dispute", "OTHER", False),
    (5, "Unknown", "OTHER", False),
    (6, "Voided Trip", "OTHER", False),
    (0, "Not Recorded", "OTHER", False),
]

CAB_TYPES = [(1, "yellow"), (2, "green")]

# first hour, last hour, name
TIME_PERIODS = [
    (0, 4, "Late Night"),
    (5, 6, "Early Morning"),
    (7, 8, "Morning Rush"),
    (9, 11, "Morning"),
    (12, 13, "Midday"),
    (14, 16, "Afternoon"),
    (17, 18, "Evening Rush"),
    (19, 20, "Evening"),
    (21, 23, "Night"),
]
DAY_PARTS = [
    (0, 4, "Night"),
    (5, 6, "Dawn"),
    (7, 11, "Morning"),
    (12, 16, "Afternoon"),
    (17, 20, "Evening"),
    (21, 23, "Night"),
]
BUSINESS_HOURS = (9, 17)

# Members that stand for "not known" in the warehouse, by natural key
UNKNOWN_VENDOR = 0
UNKNOWN_RATE_CODE = 99
UNKNOWN_PAYMENT = 5
DEFAULT_PAYMENT = 0
UNKNOWN_ZONE = -1

# Columns copied to the relational golden table: (name in the lake, type there). Fixed values.
GOLDEN_COLUMNS = [
    ("pickup_hour", "int"),
    ("pu_locationid", "int"),
    ("pu_service_zone", "string"),
    ("tpep_dropoff_datetime", "timestamp_ntz"),
    ("congestion_surcharge", "double"),
    ("pickup_month", "string"),
    ("passenger_count", "double"),
    ("tolls_amount", "double"),
    ("data_owner", "string"),
    ("is_long_trip", "tinyint"),
    ("trip_distance", "double"),
    ("cbd_congestion_fee", "double"),
    ("trip_duration_minutes", "decimal(27,6)"),
    ("do_service_zone", "string"),
    ("ratecodeid", "int"),
    ("extra", "double"),
    ("pickup_day", "string"),
    ("high_tip_flag", "tinyint"),
    ("fare_amount", "double"),
    ("vendorid", "int"),
    ("pickup_day_of_week", "int"),
    ("vendor_name", "string"),
    ("tip_pct", "double"),
    ("rate_code_desc", "string"),
    ("do_borough", "string"),
    ("improvement_surcharge", "double"),
    ("do_zone", "string"),
    ("pu_borough", "string"),
    ("pickup_year", "string"),
    ("dolocationid", "int"),
    ("pickup_day_of_month", "int"),
    ("pulocationid", "int"),
    ("store_and_fwd_flag", "string"),
    ("payment_type", "int"),
    ("pu_zone", "string"),
    ("rate_code_id", "bigint"),
    ("total_amount", "double"),
    ("tip_amount", "double"),
    ("mta_tax", "double"),
    ("data_zone", "string"),
    ("airport_fee", "double"),
    ("is_short_trip", "tinyint"),
    ("tpep_pickup_datetime", "timestamp_ntz"),
    ("do_locationid", "int"),
]
