"""Slowly changing dimensions over suppliers and customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.catalogue import query
from meterlake.functions.times import at
from meterlake.operators import scd
from meterlake.sources import testtables as T

AS_OF = "2001-11-05 00:00:00"

# --- versioned vendors ------------------------------------------------------------------------

VENDOR_ATTRIBUTES = ["vendor_name", "vendor_code", "vendor_status", "contact_email", "contact_phone"]
VENDOR_TRACKED = ["vendor_id", "vendor_name", "vendor_code"]


def base_vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS vendor_id",
        "s_name AS vendor_name",
        "concat('S', s_suppkey % 100) AS vendor_code",
        "'ACTIVE' AS vendor_status",
    )


def seeded_vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.scd2_init(base_vendors(spark, sf_dir), "vendor_id", VENDOR_TRACKED, "vendor_sk")


def staged_vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Renamed, resubmitted, status-only and new vendors; some are submitted twice."""
    submitted = T.table(spark, sf_dir, "supplier").selectExpr(
        "inline(array(struct(s_suppkey AS k, 1 AS seq), struct(s_suppkey AS k, 2 AS seq)))", "s_name"
    )
    rows = submitted.filter("k % 10 IN (0, 1, 2) OR k % 20 = 4").selectExpr(
        "if(k % 20 = 4, 1000000 + k, k) AS vendor_id",
        "CASE WHEN k % 20 = 4 THEN concat('New ', s_name) WHEN k % 10 = 0 AND seq = 2 THEN concat(s_name, ' renamed')"
        " ELSE s_name END AS vendor_name",
        "concat('S', k % 100) AS vendor_code",
        "if(k % 10 = 2, 'SUSPENDED', 'ACTIVE') AS vendor_status",
        "concat('contact', k, '@example.com') AS contact_email",
        "if(k % 3 = 0, NULL, concat('555-', k)) AS contact_phone",
        "'admin' AS updated_by",
        "'Name correction' AS change_reason",
        "seq",
    )
    return scd.latest_staged(rows, "vendor_id", "seq").drop("seq")


def merged_vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.scd2(
        seeded_vendors(spark, sf_dir),
        staged_vendors(spark, sf_dir),
        "vendor_id",
        VENDOR_ATTRIBUTES,
        VENDOR_TRACKED,
        AS_OF,
        "vendor_sk",
        previous="vendor_name",
    )


OPEN = "'9999-12-31 23:59:59'"

# the merged dimension, written independently of the merge
MERGED = f"""WITH base AS (SELECT s_suppkey AS k, s_name, 'S' || (s_suppkey % 100) AS code,
    row_number() OVER (ORDER BY s_suppkey) AS sk FROM supplier),
  n AS (SELECT count(*) AS n FROM supplier),
  first AS (SELECT k AS vendor_id, s_name AS vendor_name, code AS vendor_code, 'ACTIVE' AS vendor_status,
      CAST(NULL AS VARCHAR) AS contact_email, CAST(NULL AS VARCHAR) AS contact_phone, sk AS vendor_sk, 1 AS version_number,
      '1900-01-01 00:00:00' AS effective_start_date,
      CASE WHEN k % 10 = 0 THEN '{AS_OF}' ELSE {OPEN} END AS effective_end_date, k % 10 <> 0 AS is_current,
      CAST(NULL AS VARCHAR) AS previous_vendor_name, 'INITIAL_LOAD' AS created_by,
      'Initial SCD2 migration' AS change_reason,
      CASE WHEN k % 10 = 0 THEN 'SCD2_PROCESS' END AS updated_by, CASE WHEN k % 10 = 0 THEN '{AS_OF}' END AS updated_at
    FROM base),
  added AS (SELECT CASE WHEN k % 10 = 0 THEN k ELSE 1000000 + k END AS vendor_id,
      CASE WHEN k % 10 = 0 THEN s_name || ' renamed' ELSE 'New ' || s_name END AS vendor_name, code AS vendor_code,
      'ACTIVE' AS vendor_status, 'contact' || k || '@example.com' AS contact_email,
      CASE WHEN k % 3 = 0 THEN NULL ELSE '555-' || k END AS contact_phone, k, s_name FROM base
    WHERE k % 10 = 0 OR k % 20 = 4),
  second AS (SELECT vendor_id, vendor_name, vendor_code, vendor_status, contact_email, contact_phone,
      n + row_number() OVER (ORDER BY vendor_id) AS vendor_sk, CASE WHEN k % 10 = 0 THEN 2 ELSE 1 END AS version_number,
      '{AS_OF}' AS effective_start_date, {OPEN} AS effective_end_date, true AS is_current,
      CASE WHEN k % 10 = 0 THEN s_name END AS previous_vendor_name, 'admin' AS created_by,
      CASE WHEN k % 10 = 0 THEN 'Name correction' ELSE 'New member added' END AS change_reason,
      CAST(NULL AS VARCHAR) AS updated_by, CAST(NULL AS VARCHAR) AS updated_at FROM added, n),
  merged AS (SELECT *, md5(vendor_id || '|' || vendor_name || '|' || vendor_code) AS row_hash
    FROM (SELECT * FROM first UNION ALL SELECT * FROM second))"""
MERGED_SELECT = (
    f"{MERGED} SELECT * REPLACE (CAST(vendor_sk AS BIGINT) AS vendor_sk,"
    " CAST(version_number AS BIGINT) AS version_number) FROM merged"
)


@query("dm_scd2_hash", MERGED_SELECT)
def dm_scd2_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merged_vendors(spark, sf_dir)


@query("dm_scd2_twice", MERGED_SELECT)
def dm_scd2_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batch merged a day later changes nothing."""
    return scd.scd2(
        merged_vendors(spark, sf_dir),
        staged_vendors(spark, sf_dir),
        "vendor_id",
        VENDOR_ATTRIBUTES,
        VENDOR_TRACKED,
        "2001-11-06 00:00:00",
        "vendor_sk",
        previous="vendor_name",
    )


@query(
    "dm_scd2_init",
    f"""SELECT s_suppkey AS vendor_id, s_name AS vendor_name, 'S' || (s_suppkey % 100) AS vendor_code,
         'ACTIVE' AS vendor_status, row_number() OVER (ORDER BY s_suppkey) AS vendor_sk,
         '1900-01-01 00:00:00' AS effective_start_date, {OPEN} AS effective_end_date, true AS is_current,
         CAST(1 AS BIGINT) AS version_number, 'INITIAL_LOAD' AS created_by, 'Initial SCD2 migration' AS change_reason,
         md5(s_suppkey || '|' || s_name || '|' || 'S' || (s_suppkey % 100)) AS row_hash FROM supplier""",
)
def dm_scd2_init(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seeded_vendors(spark, sf_dir)


@query(
    "dm_scd2_row",
    f"""WITH base AS (SELECT *, row_number() OVER (ORDER BY s_suppkey) AS sk FROM supplier), n AS (SELECT count(*) AS n FROM supplier),
      c AS (SELECT *, s_suppkey % 10 = 0 OR s_suppkey % 10 = 3 AS changed FROM base)
      SELECT s_suppkey AS source_vendor_id, sk AS vendor_sk, s_name AS vendor_name, 'PROPOSED' AS lifecycle_state,
        CAST(1 AS BIGINT) AS version_number, '2000-01-01 00:00:00' AS effective_start_date,
        CASE WHEN changed THEN '{AS_OF}' ELSE {OPEN} END AS effective_end_date, NOT changed AS is_current,
        CAST(NULL AS VARCHAR) AS previous_vendor_name FROM c
      UNION ALL SELECT s_suppkey, n + row_number() OVER (ORDER BY s_suppkey),
        CASE WHEN s_suppkey % 10 = 0 THEN s_name || ' two' ELSE s_name END,
        CASE WHEN s_suppkey % 10 = 3 THEN 'ACTIVE' ELSE 'PROPOSED' END, 2, '{AS_OF}', {OPEN}, true, s_name
      FROM c, n WHERE changed""",
)
def dm_scd2_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions by comparing name and state instead of a digest."""
    base = T.table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS source_vendor_id", "s_name AS vendor_name", "'PROPOSED' AS lifecycle_state"
    )
    dim = scd.scd2_init(base, "source_vendor_id", ["vendor_name"], "vendor_sk", "2000-01-01 00:00:00").drop("row_hash")
    staged = base.filter("source_vendor_id % 10 IN (0, 1, 3)").selectExpr(
        "source_vendor_id",
        "if(source_vendor_id % 10 = 0, concat(vendor_name, ' two'), vendor_name) AS vendor_name",
        "if(source_vendor_id % 10 = 3, 'ACTIVE', lifecycle_state) AS lifecycle_state",
        "'admin' AS updated_by",
        "'correction' AS change_reason",
    )
    tracked = ["vendor_name", "lifecycle_state"]
    merged = scd.scd2(
        dim, staged, "source_vendor_id", tracked, tracked, AS_OF, "vendor_sk", previous="vendor_name", hashed=False
    )
    return merged.select(
        "source_vendor_id",
        "vendor_sk",
        "vendor_name",
        "lifecycle_state",
        "version_number",
        "effective_start_date",
        "effective_end_date",
        "is_current",
        "previous_vendor_name",
    )


@query(
    "dm_current",
    f"""{MERGED} SELECT CAST(vendor_sk AS BIGINT) AS vendor_sk, vendor_id, vendor_name, vendor_code, vendor_status,
      contact_email, contact_phone FROM merged WHERE is_current""",
)
def dm_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.current_only(merged_vendors(spark, sf_dir)).select("vendor_sk", "vendor_id", *VENDOR_ATTRIBUTES)


@query(
    "dm_asof_row",
    f"""{MERGED} SELECT vendor_id, vendor_name, CAST(version_number AS BIGINT) AS version_number FROM merged
      WHERE effective_start_date <= '2001-11-05 00:00:00' AND '2001-11-05 00:00:00' < effective_end_date""",
)
def dm_asof_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At the very instant of the change the new version holds, and only that one."""
    return scd.as_of(merged_vendors(spark, sf_dir), AS_OF).select("vendor_id", "vendor_name", "version_number")


@query(
    "dm_history",
    f"""{MERGED} SELECT vendor_id, vendor_name, previous_vendor_name, vendor_status,
      CAST(version_number AS BIGINT) AS version_number, effective_start_date, effective_end_date, is_current,
      change_reason, created_by FROM merged""",
)
def dm_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.history(merged_vendors(spark, sf_dir), "vendor_id").select(
        "vendor_id",
        "vendor_name",
        "previous_vendor_name",
        "vendor_status",
        "version_number",
        "effective_start_date",
        "effective_end_date",
        "is_current",
        "change_reason",
        "created_by",
    )


@query(
    "dm_audit_trail",
    f"""{MERGED} SELECT vendor_id, CAST(version_number AS BIGINT) AS version_number,
      date_diff('day', CAST(effective_start_date AS DATE), CASE WHEN effective_end_date = {OPEN} THEN DATE '2001-12-31'
        ELSE CAST(effective_end_date AS DATE) END) AS days_active FROM merged""",
)
def dm_audit_trail(spark: SparkSession, sf_dir: str) -> DataFrame:
    trail = scd.audit_trail(merged_vendors(spark, sf_dir), "2001-12-31 00:00:00")
    return trail.select("vendor_id", "version_number", "days_active")


@query(
    "dm_scd6",
    f"""{MERGED} SELECT a.vendor_id, a.vendor_name, CAST(a.version_number AS BIGINT) AS version_number,
      a.previous_vendor_name, b.vendor_name AS current_vendor_name
      FROM merged a JOIN merged b ON a.vendor_id = b.vendor_id AND b.is_current""",
)
def dm_scd6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.scd6(merged_vendors(spark, sf_dir), "vendor_id", "vendor_name").select(
        "vendor_id", "vendor_name", "version_number", "previous_vendor_name", "current_vendor_name"
    )


def _rolled_back(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    keys = T.table(spark, sf_dir, "supplier").selectExpr("if(s_suppkey % 5 = 4, -s_suppkey, s_suppkey) AS vendor_id")
    asked = keys.filter("vendor_id % 20 = 0 OR vendor_id % 20 = 1 OR vendor_id < 0")
    return scd.rollback_version(
        merged_vendors(spark, sf_dir),
        asked,
        "vendor_id",
        [*VENDOR_ATTRIBUTES, "row_hash"],
        "2001-12-01 00:00:00",
        "admin",
        "Incorrect change",
        "vendor_sk",
        previous="vendor_name",
    )


@query(
    "dm_rollback_ver",
    f"""{MERGED} SELECT vendor_id, vendor_name, CAST(version_number AS BIGINT) AS version_number, effective_start_date,
        CASE WHEN vendor_id < 1000000 AND vendor_id % 20 = 0 AND version_number = 2 THEN '2001-12-01 00:00:00'
          ELSE effective_end_date END AS effective_end_date,
        is_current AND NOT (vendor_id < 1000000 AND vendor_id % 20 = 0) AS is_current, previous_vendor_name, created_by, change_reason,
        CAST(vendor_sk AS BIGINT) AS vendor_sk FROM merged
      UNION ALL SELECT vendor_id, vendor_name, 3, '2001-12-01 00:00:00', {OPEN}, true, vendor_name || ' renamed', 'admin',
        'ROLLBACK: Incorrect change', (SELECT max(vendor_sk) FROM merged) + row_number() OVER (ORDER BY vendor_id)
      FROM merged WHERE vendor_id % 20 = 0 AND vendor_id < 1000000 AND version_number = 1""",
)
def dm_rollback_ver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rolled_back(spark, sf_dir)[0].select(
        "vendor_id",
        "vendor_name",
        "version_number",
        "effective_start_date",
        "effective_end_date",
        "is_current",
        "previous_vendor_name",
        "created_by",
        "change_reason",
        "vendor_sk",
    )


@query(
    "dm_rollback_ver_status",
    """SELECT CASE WHEN s_suppkey % 5 = 4 THEN -s_suppkey ELSE s_suppkey END AS vendor_id, s_suppkey % 20 = 0 AS success,
        CASE WHEN s_suppkey % 20 = 0 THEN 'Rolled back to version 1'
             WHEN s_suppkey % 20 = 1 THEN 'Cannot rollback - this is the first version'
             ELSE 'Cannot rollback - key not found' END AS message
       FROM supplier WHERE s_suppkey % 20 IN (0, 1) OR s_suppkey % 5 = 4""",
)
def dm_rollback_ver_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rolled_back(spark, sf_dir)[1]


# --- overwriting types over customers -----------------------------------------------------------


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without every seventh one, as the table before a batch."""
    return T.table(spark, sf_dir, "customer").filter("c_custkey % 7 <> 5").selectExpr(
        "c_custkey + 1 AS customer_id", "c_custkey", "c_name", "c_mktsegment", "c_acctbal"
    )


def customer_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New customers, renamed ones, moved ones and unchanged ones."""
    return T.table(spark, sf_dir, "customer").filter("c_custkey % 7 = 5 OR c_custkey % 4 = 1").selectExpr(
        "c_custkey",
        "if(c_custkey % 8 = 1, concat(c_name, ' Ltd'), c_name) AS c_name",
        "if(c_custkey % 3 = 0, 'MOVED', c_mktsegment) AS c_mktsegment",
        "c_acctbal + 10 AS c_acctbal",
    )


CUSTOMERS = """WITH held AS (SELECT * FROM customer WHERE c_custkey % 7 <> 5),
  staged AS (SELECT c_custkey, CASE WHEN c_custkey % 8 = 1 THEN c_name || ' Ltd' ELSE c_name END AS c_name,
      CASE WHEN c_custkey % 3 = 0 THEN 'MOVED' ELSE c_mktsegment END AS c_mktsegment, c_acctbal + 10 AS c_acctbal
    FROM customer WHERE c_custkey % 7 = 5 OR c_custkey % 4 = 1),
  top AS (SELECT max(c_custkey) + 1 AS top FROM held),
  fresh AS (SELECT s.*, top + row_number() OVER (ORDER BY c_custkey) AS customer_id FROM staged s, top
    WHERE c_custkey NOT IN (SELECT c_custkey FROM held))"""


@query(
    "dm_scd0",
    f"""{CUSTOMERS} SELECT c_custkey, c_name, c_mktsegment FROM held
      UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM fresh""",
)
def dm_scd0(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["c_custkey", "c_name", "c_mktsegment"]
    return scd.scd0(
        customers(spark, sf_dir).select(*columns), customer_batch(spark, sf_dir).select(*columns), "c_custkey"
    )


@query(
    "dm_scd1",
    f"""{CUSTOMERS} SELECT h.c_custkey + 1 AS customer_id, h.c_custkey, coalesce(s.c_name, h.c_name) AS c_name,
        coalesce(s.c_acctbal, h.c_acctbal) AS c_acctbal,
        CASE WHEN s.c_custkey IS NOT NULL THEN '{AS_OF}' END AS updated_at,
        CASE WHEN s.c_custkey IS NOT NULL THEN 'UPDATE' END AS operation FROM held h LEFT JOIN staged s USING (c_custkey)
      UNION ALL SELECT customer_id, c_custkey, c_name, c_acctbal, '{AS_OF}', 'INSERT' FROM fresh""",
)
def dm_scd1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.scd1(
        customers(spark, sf_dir).drop("c_mktsegment"),
        customer_batch(spark, sf_dir).drop("c_mktsegment"),
        "c_custkey",
        ["c_name", "c_acctbal"],
        AS_OF,
        "customer_id",
    )


SCD3 = f"""{CUSTOMERS}, t AS (SELECT h.c_custkey + 1 AS customer_id, h.c_custkey, coalesce(s.c_name, h.c_name) AS c_name,
    coalesce(s.c_mktsegment, h.c_mktsegment) AS c_mktsegment,
    CASE WHEN s.c_name <> h.c_name THEN h.c_name END AS previous_c_name,
    CASE WHEN s.c_mktsegment <> h.c_mktsegment THEN h.c_mktsegment END AS previous_c_mktsegment,
    CASE WHEN s.c_name <> h.c_name THEN '{AS_OF}' END AS c_name_changed_date,
    CASE WHEN s.c_mktsegment <> h.c_mktsegment THEN '{AS_OF}' END AS c_mktsegment_changed_date,
    CASE WHEN s.c_custkey IS NULL THEN NULL WHEN s.c_name <> h.c_name OR s.c_mktsegment <> h.c_mktsegment THEN 'UPDATE'
      ELSE 'NO_CHANGE' END AS operation FROM held h LEFT JOIN staged s USING (c_custkey)
  UNION ALL SELECT customer_id, c_custkey, c_name, c_mktsegment, NULL, NULL, NULL, NULL, 'INSERT' FROM fresh)"""


@query(
    "dm_scd3",
    f"""{CUSTOMERS} SELECT h.c_custkey + 1 AS customer_id, h.c_custkey, coalesce(s.c_name, h.c_name) AS c_name,
        CASE WHEN s.c_name <> h.c_name THEN h.c_name END AS previous_c_name,
        CASE WHEN s.c_name <> h.c_name THEN '{AS_OF}' END AS c_name_changed_date,
        CASE WHEN s.c_custkey IS NULL THEN NULL WHEN s.c_name <> h.c_name THEN 'UPDATE' ELSE 'NO_CHANGE' END AS operation
      FROM held h LEFT JOIN staged s USING (c_custkey)
      UNION ALL SELECT customer_id, c_custkey, c_name, NULL, NULL, 'INSERT' FROM fresh""",
)
def dm_scd3(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = ["c_mktsegment", "c_acctbal"]
    return scd.scd3(
        customers(spark, sf_dir).drop(*kept),
        customer_batch(spark, sf_dir).drop(*kept),
        "c_custkey",
        ["c_name"],
        AS_OF,
        "customer_id",
    )


def _extended(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.scd3(
        customers(spark, sf_dir).drop("c_acctbal"),
        customer_batch(spark, sf_dir).drop("c_acctbal"),
        "c_custkey",
        ["c_name", "c_mktsegment"],
        AS_OF,
        "customer_id",
    )


@query("dm_scd3_ext", f"{SCD3} SELECT * FROM t")
def dm_scd3_ext(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extended(spark, sf_dir)


@query(
    "dm_hybrid13",
    f"""{CUSTOMERS} SELECT h.c_custkey + 1 AS customer_id, h.c_custkey, coalesce(s.c_name, h.c_name) AS c_name,
        coalesce(s.c_acctbal, h.c_acctbal) AS c_acctbal, CASE WHEN s.c_name <> h.c_name THEN h.c_name END AS previous_c_name,
        CASE WHEN s.c_name <> h.c_name THEN '{AS_OF}' END AS c_name_changed_date,
        CASE WHEN s.c_custkey IS NOT NULL THEN 'UPDATE' END AS operation FROM held h LEFT JOIN staged s USING (c_custkey)
      UNION ALL SELECT customer_id, c_custkey, c_name, c_acctbal, NULL, NULL, 'INSERT' FROM fresh""",
)
def dm_hybrid13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The balance is overwritten, the name keeps its previous value."""
    return scd.scd_policy(
        customers(spark, sf_dir).drop("c_mktsegment"),
        customer_batch(spark, sf_dir).drop("c_mktsegment"),
        "c_custkey",
        {"c_acctbal": 1, "c_name": 3},
        AS_OF,
        "customer_id",
    )


@query(
    "dm_t3_changes",
    f"""{SCD3} SELECT c_custkey, c_name AS current_name, previous_c_name AS previous_name,
      c_name_changed_date AS name_changed_date, CAST(56 AS BIGINT) AS days_since_change FROM t
      WHERE previous_c_name IS NOT NULL""",
)
def dm_t3_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.type3_changes(_extended(spark, sf_dir), "c_custkey", "c_name", "2001-12-31 00:00:00")


PROFILES = """WITH p AS (SELECT c_custkey, c_mktsegment, CASE WHEN c_acctbal < 0 THEN 'OVERDRAWN' WHEN c_acctbal < 5000
    THEN 'LOW' ELSE 'HIGH' END AS balance_band FROM customer)"""


def _profiles(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    members = T.table(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        "c_mktsegment",
        "CASE WHEN c_acctbal < 0 THEN 'OVERDRAWN' WHEN c_acctbal < 5000 THEN 'LOW' ELSE 'HIGH' END AS balance_band",
    )
    return scd.scd5(members, "c_custkey", ["c_mktsegment", "balance_band"])


@query("dm_scd5", f"{PROFILES} SELECT c_custkey, md5(c_mktsegment || '|' || balance_band) AS profile_key FROM p")
def dm_scd5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profiles(spark, sf_dir)[1]


@query(
    "dm_scd5_profiles",
    f"""{PROFILES} SELECT DISTINCT c_mktsegment, balance_band, md5(c_mktsegment || '|' || balance_band) AS profile_key
      FROM p""",
)
def dm_scd5_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profiles(spark, sf_dir)[0]


# --- current table with history table -------------------------------------------------------------


def _scd4(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    current = T.master_vendors(spark, sf_dir).drop("approved_by")
    history = current.filter("false").selectExpr(
        "change_id",
        "vendor_id",
        "vendor_name",
        "lifecycle_state",
        "match_confidence",
        "source_system",
        "created_by",
        "'' AS change_type",
        "'' AS change_reason",
        "created_at",
    )
    staged = T.table(spark, sf_dir, "supplier").filter("s_suppkey % 5 < 2").selectExpr(
        "if(s_suppkey % 10 = 1, 500000 + s_suppkey, s_suppkey) AS source_vendor_id",
        "if(s_suppkey % 10 = 5, concat(s_name, ' Group'), s_name) AS vendor_name",
        "'feed' AS source_system",
        "'etl' AS created_by",
        "cast(98.5 AS decimal(5,2)) AS match_confidence",
    )
    return scd.scd4(current, history, staged, "source_vendor_id", "vendor_id", "vendor_name", AS_OF, 7000)


SCD4 = """WITH m AS (SELECT s_suppkey AS k, s_suppkey + 1 AS vendor_id, s_name,
    CASE WHEN s_suppkey % 7 = 3 THEN 'PROPOSED' WHEN s_suppkey % 11 = 5 THEN 'REJECTED' ELSE 'ACTIVE' END AS state,
    90 + s_suppkey % 11 AS conf, CASE WHEN s_suppkey % 17 = 2 THEN NULL ELSE s_suppkey END AS change_id FROM supplier),
  new AS (SELECT 500000 + k AS k, (SELECT max(vendor_id) FROM m) + row_number() OVER (ORDER BY k) AS vendor_id, s_name FROM m
    WHERE k % 10 = 1),
  c AS (SELECT k, 'UPDATE' AS op FROM m WHERE k % 10 = 5 UNION ALL SELECT k, 'INSERT' FROM new),
  ids AS (SELECT k, op, 7000 + row_number() OVER (ORDER BY k) AS id FROM c)"""


@query(
    "dm_scd4",
    f"""{SCD4} SELECT m.k AS source_vendor_id, vendor_id, CASE WHEN id IS NULL THEN s_name ELSE s_name || ' Group' END AS vendor_name,
        CASE WHEN id IS NOT NULL AND state <> 'ACTIVE' THEN 'PROPOSED' ELSE state END AS lifecycle_state,
        CASE WHEN id IS NULL THEN CAST(conf AS DOUBLE) ELSE 98.5 END AS match_confidence, coalesce(id, change_id) AS change_id,
        CASE WHEN id IS NOT NULL THEN 'etl' END AS updated_by FROM m LEFT JOIN ids ON m.k = ids.k
      UNION ALL SELECT new.k, vendor_id, s_name, 'PROPOSED', 98.5, id, NULL FROM new JOIN ids ON new.k = ids.k""",
)
def dm_scd4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scd4(spark, sf_dir)[0].select(
        "source_vendor_id",
        "vendor_id",
        "vendor_name",
        "lifecycle_state",
        "match_confidence",
        "change_id",
        "updated_by",
    )


@query(
    "dm_scd4_history",
    f"""{SCD4} SELECT id AS change_id, vendor_id, s_name AS vendor_name, state AS lifecycle_state,
        CAST(conf AS DOUBLE) AS match_confidence, 'catalogue' AS source_system, 'initial_load' AS created_by, 'UPDATE' AS change_type,
        'Name changed from "' || s_name || '" to "' || s_name || ' Group"' AS change_reason,
        '{AS_OF}' AS created_at FROM m JOIN ids ON m.k = ids.k
      UNION ALL SELECT id, vendor_id, s_name, 'PROPOSED', 98.5, 'feed', 'etl', 'INSERT', 'New record added', '{AS_OF}'
      FROM new JOIN ids ON new.k = ids.k""",
)
def dm_scd4_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scd4(spark, sf_dir)[1]


@query(
    "dm_scd4_ops",
    f"""{SCD4} SELECT k AS source_vendor_id, op AS operation FROM ids
      UNION ALL SELECT k, 'NO_CHANGE' FROM m WHERE k % 10 IN (0, 6)""",
)
def dm_scd4_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scd4(spark, sf_dir)[2]


def _history_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two archived states of every third vendor, 100 and 200 days before the current one."""
    return T.master_vendors(spark, sf_dir).filter("source_vendor_id % 3 = 0").selectExpr(
        "inline(array(struct(100 AS back), struct(200 AS back)))", "*"
    ).selectExpr(
        "vendor_id",
        "concat(vendor_name, ' ', back) AS vendor_name",
        "'PROPOSED' AS lifecycle_state",
        "cast(50 AS decimal(5,2)) AS match_confidence",
        "created_at - make_dt_interval(back, 0, 0, 0) AS created_at",
        "if(back = 100, 900, 901) AS change_id",
    )


@query(
    "dm_asof_hist",
    """WITH m AS (SELECT s_suppkey + 1 AS vendor_id, s_name, s_suppkey AS k,
        TIMESTAMP '2000-01-01' + to_days(CAST(s_suppkey % 600 AS INTEGER)) AS c FROM supplier),
      h AS (SELECT vendor_id, s_name || ' ' || b AS s_name, c - to_days(CAST(b AS INTEGER)) AS c FROM m, (VALUES (100), (200)) AS v(b) WHERE k % 3 = 0)
      SELECT vendor_id, s_name AS vendor_name, CAST(c AS VARCHAR) AS created_at, 'CURRENT' AS source FROM m WHERE c <= TIMESTAMP '2000-01-31'
      UNION ALL SELECT vendor_id, s_name, CAST(c AS VARCHAR), 'HISTORY' FROM h
        WHERE c <= TIMESTAMP '2000-01-31' AND vendor_id NOT IN (SELECT vendor_id FROM m WHERE c <= TIMESTAMP '2000-01-31')
        QUALIFY row_number() OVER (PARTITION BY vendor_id ORDER BY c DESC) = 1""",
)
def dm_asof_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.as_of_history(
        T.master_vendors(spark, sf_dir),
        _history_rows(spark, sf_dir),
        "vendor_id",
        "created_at",
        "2000-01-31 00:00:00",
        ["vendor_name"],
    )


@query(
    "wn_latest",
    """WITH h AS (SELECT o_custkey, o_orderkey, o_orderdate FROM orders WHERE o_orderdate <= TIMESTAMP '1998-06-30')
      SELECT o_custkey, o_orderkey, CAST(o_orderdate AS VARCHAR) AS o_orderdate FROM h
      QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def wn_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's last order by a date: a partial maximum, not a sorted window."""
    orders = T.table(spark, sf_dir, "orders").filter(F.col("o_orderdate") <= at("1998-06-30 00:00:00"))
    best = F.max(F.struct("o_orderdate", "o_orderkey")).alias("last")
    return orders.groupBy("o_custkey").agg(best).select("o_custkey", "last.o_orderkey", "last.o_orderdate")


def _rolled_change(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return scd.rollback_change(
        T.master_vendors(spark, sf_dir),
        _history_rows(spark, sf_dir),
        901,
        "vendor_id",
        ["vendor_name", "lifecycle_state", "match_confidence"],
        AS_OF,
        "steward",
    )


@query(
    "dm_rollback_chg",
    f"""SELECT s_suppkey + 1 AS vendor_id, CASE WHEN s_suppkey % 3 = 0 THEN s_name || ' 200' ELSE s_name END AS vendor_name,
        CASE WHEN s_suppkey % 3 = 0 OR s_suppkey % 7 = 3 THEN 'PROPOSED' WHEN s_suppkey % 11 = 5 THEN 'REJECTED' ELSE 'ACTIVE' END
          AS lifecycle_state,
        CAST(CASE WHEN s_suppkey % 3 = 0 THEN 50 ELSE 90 + s_suppkey % 11 END AS DOUBLE) AS match_confidence,
        CASE WHEN s_suppkey % 3 = 0 THEN 'ROLLBACK_steward' END AS updated_by,
        CASE WHEN s_suppkey % 3 = 0 THEN '{AS_OF}' END AS updated_at FROM supplier""",
)
def dm_rollback_chg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rolled_change(spark, sf_dir)[0].select(
        "vendor_id", "vendor_name", "lifecycle_state", "match_confidence", "updated_by", "updated_at"
    )


@query(
    "dm_rollback_chg_count",
    """SELECT count(*) AS records, 'Rolled back ' || count(*) || ' records' AS result FROM supplier WHERE s_suppkey % 3 = 0""",
)
def dm_rollback_chg_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rolled_change(spark, sf_dir)[1]


# --- two time axes -----------------------------------------------------------------------------------


def _bitemporal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier versions recorded on 2000-06-01; every tenth first version corrected on 2001-02-01."""
    recorded = T.versioned_suppliers(spark, sf_dir).selectExpr(
        "s_suppkey AS source_vendor_id",
        "supplier_name AS vendor_name",
        "effective_start_date AS valid_from",
        "effective_end_date AS valid_to",
        "timestamp_ntz'2000-06-01 00:00:00' AS transaction_from",
        "timestamp_ntz'9999-12-31 23:59:59' AS transaction_to",
    )
    wrong = recorded.filter("source_vendor_id % 10 = 0 AND valid_from = timestamp_ntz'1900-01-01 00:00:00'")
    fixed = wrong.withColumn("vendor_name", F.concat(F.col("vendor_name"), F.lit(" (corrected)")))
    return scd.bitemporal_correct(recorded, fixed, "source_vendor_id", ["vendor_name"], "2001-02-01 00:00:00")


def _bitemporal_sql(known: str) -> str:
    corrected = "CASE WHEN s_suppkey % 10 = 0 THEN s_name || ' (corrected)' ELSE s_name END" if known > "2001-02" else "s_name"
    return f"""SELECT s_suppkey AS source_vendor_id, {corrected} AS vendor_name, '1900-01-01 00:00:00' AS valid_from,
      CASE WHEN s_suppkey % 10 = 0 THEN '1998-01-01 00:00:00' ELSE {OPEN} END AS valid_to FROM supplier"""


@query("dm_bitemporal", _bitemporal_sql("2001-03-01"))
def dm_bitemporal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is believed after the correction to have held in 1995."""
    view = scd.bitemporal_as_of(_bitemporal(spark, sf_dir), "1995-01-01 00:00:00", "2001-03-01 00:00:00")
    return view.drop("transaction_from", "transaction_to")


@query("dm_bitemporal_before", _bitemporal_sql("2000-12-01"))
def dm_bitemporal_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was believed before it."""
    view = scd.bitemporal_as_of(_bitemporal(spark, sf_dir), "1995-01-01 00:00:00", "2000-12-01 00:00:00")
    return view.drop("transaction_from", "transaction_to")
