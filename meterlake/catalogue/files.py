"""Landing files, sinks and row-level features; file queries read back what they wrote to
the shared scratch folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types

from meterlake import schemas as S
from meterlake.catalogue import query
from meterlake.catalogue.lake import golden_trips
from meterlake.catalogue.sqltext import bigint, dollars, sql
from meterlake.functions import features as X
from meterlake.functions import times
from meterlake.functions.casts import safe_amount, safe_whole
from meterlake.functions.exact import exact_sum
from meterlake.jobs import relational_layout
from meterlake.operators import rejects, tables
from meterlake.plans import lake as plans_lake
from meterlake.session import scratch_path
from meterlake.sinks import lake as sinks
from meterlake.sources import lake, landing
from meterlake.sources import testtables as T

TRIP_COLUMNS = [f.name for f in S.TRIP_SCHEMA.fields]
STAGED_SCHEMA = types.StructType(
    [
        types.StructField("o_orderkey", types.LongType()),
        types.StructField("o_orderstatus", types.StringType()),
        types.StructField("day", types.DateType()),
        types.StructField("note", types.StringType()),
    ]
)
BULK_SCHEMA = types.StructType(
    [
        types.StructField("o_orderkey", types.LongType()),
        types.StructField("o_orderstatus", types.StringType()),
        types.StructField("o_custkey", types.LongType()),
    ]
)

PER_VENDOR = f"""SELECT CAST(vendorid AS BIGINT) AS vendorid, count(*) AS n_trips, {dollars('sum(total_c)')} AS revenue,
  CAST(max(tpep_dropoff_datetime) AS VARCHAR) AS last_dropoff FROM trips GROUP BY 1"""


def per_vendor(trips: DataFrame) -> DataFrame:
    return trips.groupBy("vendorid").agg(
        F.count(F.lit(1)).alias("n_trips"),
        exact_sum("total_amount").alias("revenue"),
        F.max("tpep_dropoff_datetime").alias("last_dropoff"),
    )


def land(spark: SparkSession, sf_dir: str) -> str:
    """Trips as headered CSV in a tree that also holds the zone lookup."""
    root = scratch_path(spark, "landing")
    trips = T.trips(spark, sf_dir).select(*TRIP_COLUMNS)
    options = {"header": True, "timestampNTZFormat": landing.TIME_FORMAT}
    trips.write.options(**options).csv(f"{root}/2024/trips")
    T.zones(spark, sf_dir).write.options(**options).csv(f"{root}/zone_lookup")
    return root


@query("src_csv_dir", sql("trips", PER_VENDOR))
def src_csv_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A recursive read of the tree that must not take zone rows for trips."""
    return per_vendor(landing.trips_csv(spark, land(spark, sf_dir), exclude="/zone_lookup/"))


@query("src_csv_zone", sql("zones", "SELECT CAST(locationid AS BIGINT) AS locationid, borough, zone, service_zone FROM zones"))
def src_csv_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.zones_csv(spark, f"{land(spark, sf_dir)}/zone_lookup")


def _partitioned_root(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_path(spark, "validated")
    silver = plans_lake.featurise(plans_lake.validate(T.trips(spark, sf_dir)))
    sinks.write_partitioned(silver, root, sort=["pulocationid"])
    return root


PER_DAY = f"""SELECT {bigint('pickup_year pickup_month pickup_day')}, count(*) AS n_trips, {dollars('sum(fare_c)')} AS fares
  FROM (SELECT *, year(tpep_pickup_datetime) AS pickup_year, month(tpep_pickup_datetime) AS pickup_month,
    day(tpep_pickup_datetime) AS pickup_day FROM valid) GROUP BY ALL"""


def per_day(trips: DataFrame) -> DataFrame:
    return trips.groupBy(*sinks.DAY).agg(F.count(F.lit(1)).alias("n_trips"), exact_sum("fare_amount").alias("fares"))


@query("snk_pq_part", sql("valid", PER_DAY))
def snk_pq_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written by day and read back with partition discovery."""
    return per_day(lake.partitioned(spark, _partitioned_root(spark, sf_dir)))


@query("src_path_part", sql("valid", PER_DAY))
def src_path_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read file by file, with the day recovered from each path."""
    return per_day(lake.partitioned_from_paths(spark, _partitioned_root(spark, sf_dir)))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as order exports: every 50th is blank, every 40th has a field too many."""
    text = F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus", F.round(F.col("o_totalprice") * 100).cast("bigint"))
    k = F.col("o_orderkey")
    return T.table(spark, sf_dir, "orders").select(
        F.when(k % 50 == 0, "").when(k % 40 == 1, F.concat(text, F.lit(",extra"))).otherwise(text).alias("value")
    )


@query(
    "src_arity",
    """SELECT o_orderkey, o_custkey, o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders
       WHERE o_orderkey % 50 <> 0 AND o_orderkey % 40 <> 1""",
)
def src_arity(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "lines")
    _lines(spark, sf_dir).write.text(path)
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, cents bigint"
    kept = landing.lines_of_arity(spark.read.text(path), 4)
    return kept.select(F.from_csv("value", schema).alias("r")).select("r.*")


@query(
    "src_bulk",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_custkey END AS o_custkey FROM orders WHERE o_orderkey % 30 <> 7""",
)
def src_bulk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank and empty fields load as NULL; rows with text in a number are set aside."""
    path = scratch_path(spark, "bulk")
    k = F.col("o_orderkey")
    lines = T.table(spark, sf_dir, "orders").select(
        F.when(k % 30 == 7, F.concat(F.lit("bad"), k.cast("string"))).otherwise(k.cast("string")).alias("o_orderkey"),
        F.when(k % 9 == 0, F.lit("  ")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(k % 11 == 0, F.lit("")).otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
    )
    lines.write.option("header", True).csv(path)
    rows, _ = landing.bulk_load(spark, path, BULK_SCHEMA)
    return rows


STAGED = """SELECT o_orderkey, CASE WHEN k % 9 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day,
    'caf? ' || k AS note, false AS rejected FROM (SELECT *, o_orderkey AS k FROM orders) WHERE k % 997 <> 7 AND k % 1009 <> 3
  UNION ALL SELECT NULL, CASE WHEN k % 997 = 7 THEN 'bad' ELSE '' END || k, NULL, CASE WHEN k % 997 = 7 THEN NULL ELSE 'caf? ' || k END, true
    FROM (SELECT o_orderkey AS k FROM orders) WHERE k % 997 = 7 OR k % 1009 = 3"""


@query("src_bulk_staged", STAGED)
def src_bulk_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with dates in four formats, bytes that are no UTF-8, texts in a number and quoted surplus fields: loaded and set aside
    in one pass, within a budget of rejected rows. A second load over its budget leaves the table as it was."""
    source, target = scratch_path(spark, "staged-lines"), scratch_path(spark, "staged")
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    formats = ["yyyy-MM-dd", "MM/dd/yyyy", "yyyyMMdd", "MM/dd/yyyy HH:mm:ss"]
    date = F.coalesce(*[F.when(k % 4 == i, F.date_format(day, f)) for i, f in enumerate(formats)])
    lines = T.table(spark, sf_dir, "orders").select(
        F.when(k % 997 == 7, F.concat(F.lit("bad"), k.cast("string"))).otherwise(k.cast("string")).alias("o_orderkey"),
        F.when(k % 9 == 0, F.lit("  ")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        date.alias("day"),
        F.concat(F.lit("café "), k.cast("string")).alias("note"),
        F.lit("one, two").alias("surplus"),
        ((k % 1009 == 3) & (k % 997 != 7)).alias("wide"),
    )
    plain = {"header": True, "encoding": "ISO-8859-1"}
    lines.filter("NOT wide").drop("surplus", "wide").write.options(**plain).csv(source)
    lines.filter("wide").drop("wide").write.mode("append").options(**plain).csv(source)
    landing.staged_load(spark, source, STAGED_SCHEMA, target, most=1000, share=0.01)
    try:
        landing.staged_load(spark, source, STAGED_SCHEMA, target, most=0)
    except landing.TooManyBadRows:
        pass
    rows = landing.loaded(spark, target, STAGED_SCHEMA).select("o_orderkey", "o_orderstatus", F.col("day").cast("string").alias("day"), "note", F.lit(False).alias("rejected"))
    aside = landing.loaded(spark, target, STAGED_SCHEMA, rejected=True)
    numbered = F.when(F.col("o_orderkey").startswith("bad"), F.lit(None)).otherwise(F.col("note"))
    return rows.unionByName(aside.select(F.lit(None).cast("bigint").alias("o_orderkey"), F.col("o_orderkey").alias("o_orderstatus"), F.lit(None).cast("string").alias("day"), numbered.alias("note"), F.lit(True).alias("rejected")))


@query("snk_csv_split", sql("trips", PER_VENDOR))
def snk_csv_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exported as compressed files of at most 3,000 rows and read back."""
    path = scratch_path(spark, "export")
    sinks.export_csv(T.trips(spark, sf_dir).select(*TRIP_COLUMNS), path, rows_per_file=3000)
    return per_vendor(landing.trips_csv(spark, path))


@query(
    "snk_mapped_table",
    sql(
        "golden",
        f"""SELECT {bigint('pulocationid dolocationid')}, CAST(pulocationid AS BIGINT) AS pu_locationid,
          CAST(dolocationid AS BIGINT) AS do_locationid, CAST(ratecodeid AS BIGINT) AS rate_code_id,
          CAST(year(tpep_pickup_datetime) AS VARCHAR) AS pickup_year, CAST(day(tpep_pickup_datetime) AS VARCHAR) AS pickup_day,
          CAST(CASE WHEN dist_c > 2000 THEN 1 ELSE 0 END AS BIGINT) AS is_long_trip,
          CAST(high_tip_flag AS BIGINT) AS high_tip_flag, {dollars('total_c')} AS total_amount, pu_zone, do_borough,
          CAST(tpep_pickup_datetime AS VARCHAR) AS tpep_pickup_datetime, CAST(44 AS BIGINT) AS n_columns FROM golden""",
    ),
)
def snk_mapped_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "relational")
    sinks.write_table(relational_layout(golden_trips(spark, sf_dir)), path)
    back = spark.read.parquet(path)
    return back.select(
        "pulocationid",
        "dolocationid",
        "pu_locationid",
        "do_locationid",
        "rate_code_id",
        "pickup_year",
        "pickup_day",
        "is_long_trip",
        "high_tip_flag",
        "total_amount",
        "pu_zone",
        "do_borough",
        "tpep_pickup_datetime",
        F.lit(len(back.columns)).alias("n_columns"),
    )


@query(
    "src_union_products",
    sql(
        "trips",
        """SELECT CAST(cab_type_id AS BIGINT) AS cab_type_id, count(*) AS n_trips, count(vendor_id) AS with_vendor,
          count(base) AS with_base FROM (
            SELECT 1 AS cab_type_id, vendorid AS vendor_id, NULL AS base FROM trips WHERE cab_type_id = 1
            UNION ALL SELECT 2, vendorid, NULL FROM trips WHERE cab_type_id = 2
            UNION ALL SELECT 3, NULL, 'B' || trip_id % 7 FROM trips WHERE trip_id % 3 = 0) GROUP BY 1""",
    ),
)
def src_union_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yellow, green and for-hire trips, each with its own column names."""
    trips = T.trips(spark, sf_dir)
    yellow = trips.filter("cab_type_id = 1").select("vendorid", "tpep_pickup_datetime", "fare_amount")
    green = trips.filter("cab_type_id = 2").selectExpr(
        "vendorid", "tpep_pickup_datetime AS lpep_pickup_datetime", "fare_amount", "0.0D AS ehail_fee"
    )
    hired = trips.filter("trip_id % 3 = 0").selectExpr(
        "concat('B', trip_id % 7) AS dispatching_base_num", "tpep_pickup_datetime AS pickup_datetime"
    )
    together = lake.union_products(
        {
            "yellow": (yellow, {"vendorid": "vendor_id", "tpep_pickup_datetime": "pickup_datetime"}),
            "green": (green, {"vendorid": "vendor_id", "lpep_pickup_datetime": "pickup_datetime"}),
            "fhv": (hired, {}),
        },
        {"yellow": 1, "green": 2, "fhv": 3},
    )
    return together.groupBy("cab_type_id").agg(
        F.count(F.lit(1)).alias("n_trips"),
        F.count("vendor_id").alias("with_vendor"),
        F.count("dispatching_base_num").alias("with_base"),
    )


@query(
    "flt_bad_rows",
    sql(
        "trips",
        """SELECT count(*) AS total_rows, CAST(0 AS BIGINT) AS missing_location,
          count(*) FILTER (WHERE fare_c < 0) AS negative_fare,
          count(*) FILTER (WHERE secs IS NULL OR secs <= 0 OR secs > 86400) AS impossible_duration,
          count(*) FILTER (WHERE vendorid IS NULL) AS corrupted_fields,
          count(*) FILTER (WHERE fare_c >= 0 AND secs > 0 AND secs <= 86400 AND vendorid IS NOT NULL) AS kept_rows FROM trips""",
    ),
)
def flt_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejects.reject_counts(T.trips(spark, sf_dir), rejects.trip_rules())


@query(
    "fea_durations",
    sql(
        "trips",
        """SELECT trip_id, round(secs / 60.0, 4) AS fractional_minutes,
          date_diff('minute', tpep_pickup_datetime, tpep_dropoff_datetime) AS boundary_minutes,
          date_sub('minute', tpep_pickup_datetime, tpep_dropoff_datetime) AS whole_minutes FROM trips""",
    ),
)
def fea_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    pickup, dropoff = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    return T.trips(spark, sf_dir).select(
        "trip_id",
        F.round(times.fractional_minutes(pickup, dropoff).cast("double"), 4).alias("fractional_minutes"),
        times.minute_boundaries(pickup, dropoff).alias("boundary_minutes"),
        times.whole_minutes(pickup, dropoff).alias("whole_minutes"),
    )


@query(
    "prj_safe_cast",
    """SELECT event_id, CASE event_id % 5 WHEN 0 THEN event_id WHEN 1 THEN event_id END AS whole_or_null,
         CASE event_id % 5 WHEN 0 THEN event_id WHEN 1 THEN event_id ELSE 0 END AS whole_or_zero,
         CASE WHEN event_id % 5 IN (0, 1) THEN CAST(event_id AS DOUBLE) WHEN event_id % 5 = 2 THEN event_id + 0.5 ELSE 0.0 END AS amount,
         CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(date_trunc('second', ts) AS VARCHAR) END AS parsed FROM events""",
)
def prj_safe_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers and times arriving as text, some of them broken."""
    raw = T.table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "CASE event_id % 5 WHEN 0 THEN cast(event_id AS string) WHEN 1 THEN concat(event_id, '.0')"
        " WHEN 2 THEN concat(event_id, '.5') WHEN 3 THEN 'abc' ELSE '' END AS number",
        "if(event_id % 4 = 0, 'not a time', date_format(ts, 'yyyy-MM-dd HH:mm:ss')) AS moment",
    )
    return raw.select(
        "event_id",
        safe_whole(F.col("number")).alias("whole_or_null"),
        safe_whole(F.col("number"), 0).alias("whole_or_zero"),
        safe_amount(F.col("number")).alias("amount"),
        times.text_timestamp(F.col("moment")).alias("parsed"),
    )


@query(
    "prj_mask",
    """SELECT o_orderkey, CAST((CAST(round(o_totalprice * 100) AS BIGINT) * 2 + 1000) // 2000 AS DOUBLE) * 10 AS price_rounded
       FROM orders""",
)
def prj_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.table(spark, sf_dir, "orders").select(
        "o_orderkey", X.nearest(F.col("o_totalprice"), 10).alias("price_rounded")
    )


# --- tables that are stored, appended to and read back -------------------------------------------------


def _supplier_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.table(spark, sf_dir, "supplier").selectExpr("s_suppkey", "s_name")


@query("src_pq_master", "SELECT s_suppkey, s_name FROM supplier")
def src_pq_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "master")
    sinks.write_table(_supplier_names(spark, sf_dir), path)
    return lake.master(spark, path)


@query("src_catalog", "SELECT s_suppkey, s_name FROM supplier")
def src_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "catalogued")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    sinks.save_table(_supplier_names(spark, sf_dir), name, path)
    return lake.catalog_table(spark, name)


@query(
    "src_weather",
    "SELECT CAST(ts AS DATE)::VARCHAR AS date, count(*) / 100.0 AS precipitation, CAST(max(event_id % 40) AS BIGINT) AS max_temperature"
    " FROM events GROUP BY 1",
)
def src_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily observations derived from the events, stored as CSV folders and read with the declared columns."""
    path = f"{scratch_path(spark, 'weather')}/daily.csv"
    days = T.table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("date"))
    observed = days.agg(
        (F.count(F.lit(1)) / 100).alias("precipitation"),
        F.lit(None).cast("double").alias("snow_depth"),
        F.lit(None).cast("double").alias("snowfall"),
        F.max(F.col("event_id") % 40).alias("max_temperature"),
        F.lit(None).cast("int").alias("min_temperature"),
        F.lit(None).cast("double").alias("average_wind_speed"),
    )
    observed.write.option("header", True).csv(path)
    return lake.weather(spark, path).select("date", "precipitation", "max_temperature")


@query(
    "snk_insert_select",
    "SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey % 2 = 0 UNION ALL SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey % 3 = 0",
)
def snk_insert_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Selected rows appended to a stored table."""
    path = scratch_path(spark, "appended")
    names = _supplier_names(spark, sf_dir)
    sinks.write_table(names.filter("s_suppkey % 2 = 0"), path)
    sinks.append(names.filter("s_suppkey % 3 = 0"), path)
    return spark.read.parquet(path)


@query("snk_clear", "SELECT count(*) AS before_rows, CAST(0 AS BIGINT) AS after_rows FROM supplier")
def snk_clear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging emptied after a merge: the columns stay, the rows go."""
    path, empty = scratch_path(spark, "staging"), scratch_path(spark, "cleared")
    sinks.write_table(_supplier_names(spark, sf_dir), path)
    sinks.write_table(tables.cleared(spark.read.parquet(path)), empty)
    schema = "s_suppkey bigint, s_name string"
    both = spark.read.parquet(path).withColumn("cleared", F.lit(False)).unionByName(
        spark.read.schema(schema).parquet(empty).withColumn("cleared", F.lit(True))
    )
    return both.agg(F.count_if(~F.col("cleared")).alias("before_rows"), F.count_if("cleared").alias("after_rows"))


@query(
    "flt_bad_coordinates",
    """SELECT count(*) AS total_rows, count_if(bad) AS invalid_coordinates, count_if(NOT bad) AS kept_rows
       FROM (SELECT l_orderkey % 11 = 0 OR l_partkey % 180 - 90 NOT BETWEEN -80 AND 80 OR l_suppkey % 90 NOT BETWEEN 10 AND 85 AS bad FROM lineitem)""",
)
def flt_bad_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates derived from line items, some missing and some outside the city."""
    ends = T.table(spark, sf_dir, "lineitem").selectExpr(
        "if(l_orderkey % 11 = 0, NULL, l_partkey % 180 - 90D) AS pickup_longitude",
        "cast(l_suppkey % 90 AS double) AS pickup_latitude",
        "0D AS dropoff_longitude",
        "50D AS dropoff_latitude",
    )
    return rejects.reject_counts(ends, rejects.coordinate_rules((-80.0, 10.0, 80.0, 85.0)))


@query(
    "dq_current_counts",
    """SELECT 'customer' AS table_name, count(*) AS total_rows, count_if(c_custkey % 4 <> 1) AS current_rows FROM customer
       UNION ALL SELECT 'supplier', count(*), count_if(s_suppkey % 4 <> 1) FROM supplier""",
)
def dq_current_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All and current rows of versioned tables."""
    parts = []
    for name, key in (("customer", "c_custkey"), ("supplier", "s_suppkey")):
        versioned = T.table(spark, sf_dir, name).withColumn("is_current", F.col(key) % 4 != 1)
        counts = versioned.agg(F.count(F.lit(1)).alias("total_rows"), F.count_if("is_current").alias("current_rows"))
        parts.append(counts.select(F.lit(name).alias("table_name"), "total_rows", "current_rows"))
    return parts[0].unionByName(parts[1])
