"""Data-quality checks over the trips, summaries and masters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake import jobs
from meterlake.catalogue import query
from meterlake.catalogue.sqltext import rdiv, sql
from meterlake.catalogue.summaries import daily, vendor_masters, zone_masters
from meterlake.functions.exact import exact_sum
from meterlake.operators import joins
from meterlake.operators import quality as Q
from meterlake.session import scratch_path, stored
from meterlake.sinks import lake as sinks
from meterlake.sources import governed
from meterlake.sources import testtables as T

PICKUP, DROPOFF = "tpep_pickup_datetime", "tpep_dropoff_datetime"
COMPONENTS = [
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "airport_fee",
]


def graded_sql(count: str, what: str) -> str:
    return (
        f"CASE WHEN {count} > 100 THEN 'FAIL: ' || {count} || ' {what}'"
        f" WHEN {count} > 0 THEN 'WARNING: ' || {count} || ' {what}' ELSE 'PASS' END"
    )


def pass_sql(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 'PASS' ELSE 'FAIL' END"


def ratecode_masters(spark: SparkSession) -> DataFrame:
    """Rate codes known to governance; code 6 is missing on purpose."""
    return governed.ratecode_masters(spark).filter("source_ratecode_id <> 6")


@query(
    "dq_fresh_summary",
    sql(
        "trips",
        """SELECT count(*) AS total_records, count(tpep_dropoff_datetime) AS valid_datetime_count,
          CAST(max(tpep_dropoff_datetime) AS VARCHAR) AS latest_valid_trip FROM trips""",
    ),
)
def dq_fresh_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.fresh_summary(T.trips(spark, sf_dir), DROPOFF)


@query(
    "dq_datetime",
    sql(
        "trips",
        """SELECT count(*) AS total_records, count(*) - count(tpep_dropoff_datetime) AS null_datetime,
          CASE WHEN null_datetime > 100 THEN 'FAIL: Too many invalid datetime values'
               WHEN null_datetime > 0 THEN 'WARNING: Some invalid datetime values detected' ELSE 'PASS' END AS status
        FROM trips""",
    ),
)
def dq_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.datetime_check(T.trips(spark, sf_dir), DROPOFF)


@query(
    "dq_critical",
    sql(
        "trips",
        """SELECT count(*) AS total_records, CAST(0 AS BIGINT) AS null_trip_id,
          count(*) - count(vendorid) AS null_vendorid, CAST(0 AS BIGINT) AS null_total_amount,
          CAST(0 AS BIGINT) AS null_fare_amount, CAST(0 AS BIGINT) AS null_trip_distance,
          count(*) - count(ratecodeid) AS null_ratecodeid,
          CASE WHEN count(*) > count(vendorid)
            THEN 'FAIL: ' || (count(*) - count(vendorid)) || ' records with NULL critical fields' ELSE 'PASS' END AS status
        FROM trips WHERE tpep_pickup_datetime >= TIMESTAMP '2024-01-31' - INTERVAL 20 DAY""",
    ),
)
def dq_critical(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = Q.recent(T.trips(spark, sf_dir), PICKUP, T.TRIPS_AS_OF, 20)
    fields = ["trip_id", "vendorid", "total_amount", "fare_amount", "trip_distance", "ratecodeid"]
    return Q.critical_fields(trips, fields, ["trip_id", "vendorid", "total_amount"])


@query(
    "dq_negative",
    sql(
        "trips",
        f"""SELECT count(*) FILTER (WHERE total_c < 0 OR fare_c < 0 OR dist_c < 0) AS total_violations,
          count(*) FILTER (WHERE total_c < 0) AS negative_total_amount,
          count(*) FILTER (WHERE fare_c < 0) AS negative_fare_amount,
          count(*) FILTER (WHERE dist_c < 0) AS negative_trip_distance,
          {graded_sql('total_violations', 'records with negative amounts')} AS status FROM trips""",
    ),
)
def dq_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = Q.recent(T.trips(spark, sf_dir), PICKUP, T.TRIPS_AS_OF, 90)
    return Q.negative_amounts(trips, ["total_amount", "fare_amount", "trip_distance"])


@query(
    "dq_temporal",
    sql(
        "trips",
        f"""SELECT count(*) FILTER (WHERE secs <= 0) AS invalid_time_records,
          {graded_sql('invalid_time_records', 'trips with invalid time order')} AS status FROM trips""",
    ),
)
def dq_temporal(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = Q.recent(T.trips(spark, sf_dir), PICKUP, T.TRIPS_AS_OF, 90)
    return Q.temporal_order(trips, PICKUP, DROPOFF)


@query(
    "dq_master_active",
    """SELECT (SELECT count(*) FROM supplier WHERE s_suppkey % 7 <> 3 AND s_suppkey % 11 <> 5) AS active_vendors,
         (SELECT count(*) FROM nation WHERE n_nationkey NOT IN (11, 23)) AS active_zones,
         CAST(0 AS BIGINT) AS active_ratecodes, 'FAIL: No active ratecodes' AS status""",
)
def dq_master_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = governed.ratecode_masters(spark, proposed=(1, 2, 3, 4, 5, 6, 99))
    return Q.masters_active(
        {
            "vendors": T.master_vendors(spark, sf_dir),
            "zones": zone_masters(spark, sf_dir),
            "ratecodes": rates,
        }
    )


@query(
    "dq_null_key",
    sql("trips", f"SELECT count(*) FILTER (WHERE ratecodeid IS NULL) AS null_count, {pass_sql('null_count = 0')} AS status FROM trips"),
)
def dq_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.null_key(T.trips(spark, sf_dir), "ratecodeid")


@query(
    "dq_date_range",
    sql(
        "trips",
        f"""SELECT count(*) FILTER (WHERE secs < 0 OR tpep_pickup_datetime > TIMESTAMP '2024-01-29 12:00:00'
            OR tpep_dropoff_datetime > TIMESTAMP '2024-01-29 12:00:00') AS violation_count,
          {pass_sql('violation_count = 0')} AS status FROM trips""",
    ),
)
def dq_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.date_range(T.trips(spark, sf_dir), PICKUP, DROPOFF, "2024-01-29 12:00:00")


@query(
    "dq_dup_key",
    f"""SELECT count(*) - count(DISTINCT l_orderkey) AS duplicate_count, {pass_sql('duplicate_count = 0')} AS status
        FROM lineitem""",
)
def dq_dup_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.duplicate_key(T.table(spark, sf_dir, "lineitem"), "l_orderkey")


@query(
    "dq_ref_int",
    sql(
        "trips mvendors",
        f"""SELECT count(*) AS orphan_count, {pass_sql('orphan_count = 0')} AS status FROM trips
        WHERE vendorid IS NOT NULL
          AND vendorid NOT IN (SELECT source_vendor_id FROM mvendors WHERE lifecycle_state = 'ACTIVE')""",
    ),
)
def dq_ref_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    active = vendor_masters(spark).filter("lifecycle_state = 'ACTIVE'")
    return Q.orphans(T.trips(spark, sf_dir), "vendorid", active, "source_vendor_id")


@query(
    "dq_revenue",
    sql(
        "trips",
        """SELECT CAST(abs(sum(fare_c + extra_c + 50 + tip_c + tolls_c + 100 + 250 + airport_c) - sum(total_c)) AS DOUBLE)
            / 100 AS variance, CASE WHEN variance <= 0.01 THEN 'PASS' ELSE 'FAIL' END AS status
        FROM trips WHERE tpep_pickup_datetime >= TIMESTAMP '2024-01-24'""",
    ),
)
def dq_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = Q.recent(T.trips(spark, sf_dir), PICKUP, T.TRIPS_AS_OF, 7)
    return Q.revenue(trips, COMPONENTS, "total_amount")


@query(
    "dq_duration",
    sql(
        "trips",
        f"""SELECT count(*) FILTER (WHERE secs <= -60 OR secs >= 1441 * 60) AS invalid_count,
          {pass_sql('invalid_count = 0')} AS status FROM trips""",
    ),
)
def dq_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.duration(T.trips(spark, sf_dir), PICKUP, DROPOFF)


def _trip_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = Q.recent(T.trips(spark, sf_dir), PICKUP, T.TRIPS_AS_OF, 7)
    return trips.groupBy(F.to_date(PICKUP).alias("day")).agg(
        F.count(F.lit(1)).alias("trip_count"), exact_sum("total_amount").alias("revenue")
    )


def _summary_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = daily(spark, sf_dir).filter("summary_date >= date'2024-01-24' AND summary_date <> date'2024-01-26'")
    return summary.groupBy(F.col("summary_date").alias("day")).agg(
        F.sum("total_trips").alias("trip_count"), exact_sum("total_revenue").alias("revenue")
    )


RECONCILE = """, a AS (SELECT CAST(tpep_pickup_datetime AS DATE) AS day, count(*) AS n, sum(total_c) AS c FROM trips
     WHERE tpep_pickup_datetime >= TIMESTAMP '2024-01-24' GROUP BY 1),
   b AS (SELECT summary_date AS day, CAST(sum(total_trips) AS BIGINT) AS n, sum(revenue_c) AS c FROM daily
     WHERE summary_date >= DATE '2024-01-24' AND summary_date <> DATE '2024-01-26' GROUP BY 1),
   d AS (SELECT a.day, a.n AS n1, b.n AS n2, a.c AS c1, b.c AS c2 FROM a LEFT JOIN b ON a.day = b.day
     WHERE b.n IS NULL OR a.n <> b.n OR abs(a.c - b.c) > 1)"""


@query(
    "jn_reconcile",
    sql(
        "trips daily",
        f"""{RECONCILE} SELECT CAST(day AS VARCHAR) AS day, n1 AS trip_count_source, n2 AS trip_count_target,
          CAST(c1 AS DOUBLE) / 100 AS revenue_source, CAST(c2 AS DOUBLE) / 100 AS revenue_target FROM d""",
    ),
)
def jn_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days on which trips and summary disagree; one day is missing from the summary."""
    measures = {"trip_count": 0, "revenue": 0.01}
    return joins.reconcile(_trip_days(spark, sf_dir), _summary_days(spark, sf_dir), "day", measures)


@query(
    "dq_reconcile",
    sql("trips daily", f"{RECONCILE} SELECT count(*) AS mismatch_count, {pass_sql('mismatch_count = 0')} AS status FROM d"),
)
def dq_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    differing = jn_reconcile(spark, sf_dir)
    return differing.agg(F.count(F.lit(1)).alias("mismatch_count")).withColumn(
        "status", Q.pass_if(F.col("mismatch_count") == 0)
    )


@query(
    "dq_complete_rows",
    sql(
        "trips",
        """SELECT 100.0 * count(*) FILTER (WHERE vendorid IS NOT NULL AND ratecodeid IS NOT NULL) / count(*)
            AS completeness_pct, CASE WHEN completeness_pct >= 99.9 THEN 'PASS' ELSE 'FAIL' END AS status FROM trips""",
    ),
)
def dq_complete_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.complete_rows(T.trips(spark, sf_dir), ["vendorid", "ratecodeid"])


@query(
    "dq_score_thresh",
    sql(
        "daily",
        """SELECT CAST(sum(CAST(round(data_quality_score * 100) AS BIGINT)) AS DOUBLE) / (100 * count(data_quality_score))
            AS avg_score, min(data_quality_score) AS min_score,
          CASE WHEN min_score >= 95 THEN 'PASS' WHEN min_score >= 90 THEN 'WARNING' ELSE 'FAIL' END AS status FROM daily""",
    ),
)
def dq_score_thresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.score_threshold(daily(spark, sf_dir), "data_quality_score")


@query(
    "dq_orphan_summary",
    sql(
        "daily mvendors",
        f"""SELECT count(*) AS orphan_count, {pass_sql('orphan_count = 0')} AS status FROM daily
        WHERE vendor_id NOT IN (SELECT source_vendor_id FROM mvendors)""",
    ),
)
def dq_orphan_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.orphans(daily(spark, sf_dir), "vendor_id", vendor_masters(spark), "source_vendor_id")


@query(
    "dq_idempotent",
    sql("daily", "SELECT count(*) AS initial_rows, count(*) AS final_rows, true AS same_content, 'PASS' AS status FROM daily"),
)
def dq_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stored runs of the summary; sums that depended on the order of rows would differ."""
    once, again = scratch_path(spark, "refreshed"), scratch_path(spark, "refreshed")
    sinks.write_table(daily(spark, sf_dir), once)
    sinks.write_table(daily(spark, sf_dir).repartition(3), again)
    return Q.same_content(spark.read.parquet(once), spark.read.parquet(again))


@query(
    "dq_idempotent_refresh",
    sql("routes", "SELECT count(*) AS initial_rows, count(*) AS final_rows, true AS same_content, 'PASS' AS status FROM routes"),
)
def dq_idempotent_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored refresh of the route summary run twice: what the second leaves on disk is what the first left."""
    target, log = scratch_path(spark, "routes"), scratch_path(spark, "routes-log")
    trips = T.trips(spark, sf_dir)
    jobs.refresh_route_patterns(spark, trips, target, log, T.TRIPS_AS_OF)
    before = stored(spark.read.parquet(target).drop("last_updated"), "routes-before")
    jobs.refresh_route_patterns(spark, trips, target, log, T.TRIPS_AS_OF)
    return Q.same_content(before, spark.read.parquet(target).drop("last_updated"))


@query(
    "dq_dup_name",
    f"""SELECT count(*) AS duplicate_groups, {pass_sql('duplicate_groups = 0')} AS status FROM (
          SELECT lower(p_name) FROM part WHERE p_size % 3 <> 0 GROUP BY 1 HAVING count(*) > 1)""",
)
def dq_dup_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.duplicate_names(named_parts(spark, sf_dir), "part_name")


def named_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as masters: their few names repeat often, some in other letter case."""
    return T.table(spark, sf_dir, "part").selectExpr(
        "p_partkey + 1 AS part_id",
        "if(p_partkey % 2 = 0, p_name, upper(p_name)) AS part_name",
        "if(p_size % 3 = 0, 'PROPOSED', 'ACTIVE') AS lifecycle_state",
    )


@query(
    "dq_zone_complete",
    f"""SELECT count(*) FILTER (WHERE n_nationkey % 8 = 3) AS incomplete_records, {pass_sql('incomplete_records = 0')} AS status
        FROM nation WHERE n_nationkey NOT IN (11, 23)""",
)
def dq_zone_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = zone_masters(spark, sf_dir)
    holes = F.when(F.col("source_zone_id") % 8 != 3, F.col("zone_name")).when(F.col("source_zone_id") == 3, F.lit(""))
    return Q.unnamed(zones.withColumn("zone_name", holes), "zone_name")


DUPLICATES = """WITH a AS (SELECT p_partkey + 1 AS id, CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE upper(p_name) END AS part_name
    FROM part WHERE p_size % 3 <> 0),
  g AS (SELECT part_name, count(*) AS duplicate_count FROM a GROUP BY 1 HAVING count(*) > 1)
SELECT part_name, duplicate_count, CAST(id // 1000 AS BIGINT) AS id_block, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS ids
FROM a JOIN g USING (part_name) GROUP BY 1, 2, 3"""


@query("dq_dup_vendors", DUPLICATES)
def dq_dup_vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.duplicate_listing(named_parts(spark, sf_dir), "part_name", "part_id")


@query(
    "dq_orphan_trips",
    sql(
        "trips mvendors mrates",
        """SELECT 'VENDOR' AS entity_type, count(*) AS orphaned_count FROM trips
          WHERE vendorid IS NOT NULL AND vendorid NOT IN (SELECT source_vendor_id FROM mvendors)
        UNION ALL SELECT 'RATECODE', count(*) FROM trips
          WHERE ratecodeid IS NOT NULL AND ratecodeid NOT IN (SELECT source_ratecode_id FROM mrates)""",
    ),
)
def dq_orphan_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.orphan_trips(
        T.trips(spark, sf_dir),
        {
            "VENDOR": ("vendorid", vendor_masters(spark), "source_vendor_id"),
            "RATECODE": ("ratecodeid", ratecode_masters(spark), "source_ratecode_id"),
        },
    )


@query(
    "dq_audit_complete",
    """SELECT 'VENDOR' AS entity_type, count(*) AS total_records,
         count(*) FILTER (WHERE s_suppkey % 13 = 1) AS missing_approver,
         count(*) FILTER (WHERE s_suppkey % 17 = 2) AS missing_change_id
       FROM supplier WHERE s_suppkey % 7 <> 3 AND s_suppkey % 11 <> 5
       UNION ALL SELECT 'ZONE', count(*), 0, 0 FROM nation WHERE n_nationkey NOT IN (11, 23)""",
)
def dq_audit_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.audit_completeness(
        {"VENDOR": T.master_vendors(spark, sf_dir), "ZONE": zone_masters(spark, sf_dir)}
    )


@query("dq_completeness", sql("trips", f"SELECT {rdiv('100 * count(ratecodeid)', 'count(*)', 2)} AS completeness_pct FROM trips"))
def dq_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.completeness(T.trips(spark, sf_dir), "ratecodeid")


@query(
    "dq_dup_rate",
    f"SELECT {rdiv('100 * (count(*) - count(DISTINCT l_partkey))', 'count(*)', 2)} AS duplicate_rate_pct FROM lineitem",
)
def dq_dup_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.duplicate_rate(T.table(spark, sf_dir, "lineitem"), "l_partkey")


@query(
    "dq_freshness",
    """SELECT CASE WHEN date_diff('day', CAST(max(l_shipdate) AS DATE), DATE '2001-11-05') <= 7
         THEN 'FRESH' ELSE 'STALE' END AS freshness_status FROM lineitem""",
)
def dq_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.freshness(T.table(spark, sf_dir, "lineitem"), "l_shipdate", 7, T.LINES_AS_OF)


def suite(spark: SparkSession, sf_dir: str) -> list[Q.Check]:
    """Checks of three suites. Those on trips share one scan, or one grouping by trip id; two cannot be answered."""
    trips = T.trips(spark, sf_dir)
    active = vendor_masters(spark).filter("lifecycle_state = 'ACTIVE'")

    def on_trips(suite: str, name: str, measure: Q.Measure, expected: str = "PASS", column: str = "status") -> Q.Check:
        return Q.Check(suite, name, "unit", None, expected, column, trips, measure)

    no_number = F.sum(F.col("store_and_fwd_flag").cast("int"))
    return [
        on_trips("source", "NULL_CHECK_TRIP_ID", Q.null_key_measure("trip_id")),
        on_trips("source", "DATE_RANGE_CHECK", Q.date_range_measure(PICKUP, DROPOFF, T.TRIPS_AS_OF)),
        on_trips("source", "DUPLICATE_TRIP_ID_CHECK", Q.duplicate_key_measure("trip_id")),
        Q.Check(
            "source",
            "VENDOR_REFERENTIAL_INTEGRITY",
            "integration",
            lambda: Q.orphans(trips, "vendorid", active, "source_vendor_id"),
        ),
        on_trips("source", "FLAG_AS_NUMBER", Q.Measure({"total": no_number}, {"status": lambda c: Q.pass_if(c("total") >= 0)})),
        on_trips("transformation", "TRIP_DURATION_CHECK", Q.duration_measure(PICKUP, DROPOFF)),
        on_trips("transformation", "DUPLICATE_COUNT", Q.duplicate_key_measure("trip_id"), "0", "duplicate_count"),
        Q.Check("masters", "MISSING_TABLE", "unit", lambda: Q.null_key({"trips": trips}["missing"], "id")),
    ]


_LOGS: dict[tuple[str, str], str] = {}


def _log(spark: SparkSession, sf_dir: str, again: bool = False) -> DataFrame:
    """The stored check log; the checks run once per session and the reports read it."""
    run = (spark.sparkContext.applicationId, sf_dir)
    if again or run not in _LOGS:
        path = scratch_path(spark, "check-log")
        sinks.append(Q.completed_checks(suite(spark, sf_dir), T.TRIPS_AS_OF), path)
        _LOGS[run] = path
    return spark.read.parquet(_LOGS[run])


LOG_SQL = sql(
    "trips mvendors",
    """, c AS (SELECT 'source' AS test_suite, 'NULL_CHECK_TRIP_ID' AS test_name, 'unit' AS test_category,
         'PASS' AS expected_result, CASE WHEN count(*) = count(trip_id) THEN 'PASS' ELSE 'FAIL' END AS actual_result FROM trips
       UNION ALL SELECT 'source', 'DATE_RANGE_CHECK', 'unit', 'PASS', CASE WHEN count(*) FILTER (WHERE secs < 0
         OR tpep_pickup_datetime > '2024-01-31' OR tpep_dropoff_datetime > '2024-01-31') = 0 THEN 'PASS' ELSE 'FAIL' END FROM trips
       UNION ALL SELECT 'source', 'DUPLICATE_TRIP_ID_CHECK', 'unit', 'PASS',
         CASE WHEN count(*) = count(DISTINCT trip_id) THEN 'PASS' ELSE 'FAIL' END FROM trips
       UNION ALL SELECT 'source', 'VENDOR_REFERENTIAL_INTEGRITY', 'integration', 'PASS',
         CASE WHEN count(*) FILTER (WHERE vendorid NOT IN (1, 2, 7)) = 0 THEN 'PASS' ELSE 'FAIL' END FROM trips
       UNION ALL SELECT 'transformation', 'TRIP_DURATION_CHECK', 'unit', 'PASS',
         CASE WHEN count(*) FILTER (WHERE secs <= -60 OR secs >= 86460) = 0 THEN 'PASS' ELSE 'FAIL' END FROM trips
       UNION ALL SELECT 'transformation', 'DUPLICATE_COUNT', 'unit', '0',
         CAST(count(*) - count(DISTINCT trip_id) AS VARCHAR) FROM trips
       UNION ALL SELECT 'source', 'FLAG_AS_NUMBER', 'unit', 'PASS', NULL
       UNION ALL SELECT 'masters', 'MISSING_TABLE', 'unit', 'PASS', NULL),
     log AS (SELECT *, CASE WHEN actual_result IS NULL THEN 'ERROR' WHEN actual_result = expected_result THEN 'PASS'
       ELSE 'FAIL' END AS test_status FROM c)""",
)


@query(
    "dq_run",
    f"""{LOG_SQL} SELECT test_suite, test_name, test_category, test_status, expected_result, actual_result,
      '2024-01-31 00:00:00' AS executed_at, 'test_framework' AS executed_by, true AS timed, test_status = 'ERROR' AS explained FROM log""",
)
def dq_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed, explained = F.col("execution_time_ms") >= 0, F.col("error_message").isNotNull()
    log = _log(spark, sf_dir, again=True).withColumns({"timed": timed, "explained": explained})
    return log.drop("error_message", "execution_time_ms")


@query(
    "dq_report",
    f"""{LOG_SQL} SELECT test_suite, count(*) AS total_tests, count(*) FILTER (WHERE test_status = 'PASS') AS passed,
      count(*) FILTER (WHERE test_status = 'FAIL') AS failed, count(*) FILTER (WHERE test_status = 'ERROR') AS errors
      FROM log GROUP BY 1""",
)
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.report_by_suite(_log(spark, sf_dir))


@query(
    "dq_report_overall",
    f"""{LOG_SQL} SELECT count(*) AS total_tests, count(*) FILTER (WHERE test_status = 'PASS') AS total_passed,
      count(*) FILTER (WHERE test_status = 'FAIL') AS total_failed,
      count(*) FILTER (WHERE test_status = 'ERROR') AS total_errors,
      round(100.0 * count(*) FILTER (WHERE test_status = 'PASS') / count(*), 2) AS pass_rate FROM log""",
)
def dq_report_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.report_overall(_log(spark, sf_dir))


@query(
    "dq_report_failures",
    f"""{LOG_SQL} SELECT test_suite, test_name, test_status, expected_result, actual_result
      FROM log WHERE test_status <> 'PASS'""",
)
def dq_report_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.report_failures(_log(spark, sf_dir)).drop("error_message")


@query(
    "dq_report_by_day",
    f"""{LOG_SQL} SELECT '2024-01-31' AS test_date, count(*) AS total_tests,
      count(*) FILTER (WHERE test_status = 'PASS') AS passed, count(*) FILTER (WHERE test_status = 'FAIL') AS failed,
      round(100.0 * count(*) FILTER (WHERE test_status = 'PASS') / count(*), 2) AS pass_rate FROM log""",
)
def dq_report_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.report_by_day(_log(spark, sf_dir))


@query(
    "dq_month_counts",
    """SELECT CAST(year(o_orderdate) AS BIGINT) AS year, CAST(month(o_orderdate) AS BIGINT) AS month,
         count(*) AS total_records FROM orders
       WHERE o_orderdate BETWEEN TIMESTAMP '1996-02-10' AND TIMESTAMP '1999-07-04' GROUP BY 1, 2""",
)
def dq_month_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = T.table(spark, sf_dir, "orders").filter(
        "o_orderdate BETWEEN timestamp_ntz'1996-02-10 00:00:00' AND timestamp_ntz'1999-07-04 00:00:00'"
    )
    return orders.groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")).agg(
        F.count(F.lit(1)).alias("total_records")
    )
