"""Master-data governance over trips, suppliers and part names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.catalogue import query
from meterlake.catalogue.quality import named_parts, ratecode_masters
from meterlake.catalogue.sqltext import bigint, sql
from meterlake.catalogue.summaries import vendor_masters, zone_masters
from meterlake.operators import matching
from meterlake.plans import governance as G
from meterlake.session import stored
from meterlake.sources import governed
from meterlake.sources import testtables as T

AS_OF = T.TRIPS_AS_OF


def masters(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "VENDOR": vendor_masters(spark),
        "ZONE": zone_masters(spark, sf_dir),
        "RATECODE": ratecode_masters(spark),
    }


@query(
    "md_seed",
    """SELECT n_nationkey + 1 AS zone_id, CAST(n_nationkey AS BIGINT) AS source_zone_id, n_name AS zone_name,
         'ACTIVE' AS lifecycle_state, CAST(100 AS DOUBLE) AS match_confidence, 'initial_load' AS source_system,
         'admin' AS created_by, 'admin' AS approved_by, CAST(n_nationkey AS BIGINT) AS change_id FROM nation""".replace(
        "n_nationkey + 1 AS", "CAST(n_nationkey + 1 AS BIGINT) AS"
    ),
)
def md_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return governed.zone_masters(T.zones(spark, sf_dir))


REFS = """, r AS (SELECT 'VENDOR' AS entity_type, vendorid AS source_id FROM trips
  UNION ALL SELECT 'ZONE', pulocationid FROM trips UNION ALL SELECT 'ZONE', dolocationid FROM trips
  UNION ALL SELECT 'RATECODE', ratecodeid FROM trips)"""


@query(
    "md_extract",
    sql(
        "trips mvendors mzones mrates",
        f"""{REFS} SELECT entity_type, CAST(source_id AS BIGINT) AS source_id, count(*) AS n_references FROM r
        WHERE source_id IS NOT NULL AND NOT (entity_type = 'VENDOR' AND source_id IN (SELECT source_vendor_id FROM mvendors))
          AND NOT (entity_type = 'ZONE' AND source_id IN (SELECT source_zone_id FROM mzones))
          AND NOT (entity_type = 'RATECODE' AND source_id IN (SELECT source_ratecode_id FROM mrates)) GROUP BY 1, 2""",
    ),
)
def md_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.missing_references(T.trips(spark, sf_dir), masters(spark, sf_dir))


# --- matching ---------------------------------------------------------------------------------------


def name_masters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct part names, less a few, as vendor masters."""
    return (
        T.table(spark, sf_dir, "part")
        .groupBy(F.col("p_name").alias("vendor_name"))
        .agg(F.min("p_partkey").alias("source_vendor_id"))
        .filter("source_vendor_id % 5 <> 0")
        .selectExpr(
            "source_vendor_id + 1 AS vendor_id",
            "source_vendor_id",
            "vendor_name",
            "'ACTIVE' AS lifecycle_state",
            "cast(100 AS decimal(5,2)) AS match_confidence",
            "'steward' AS approved_by",
        )
    )


def proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names as they might be misspelt; the key is disjoint from the masters'."""
    return T.table(spark, sf_dir, "part").selectExpr(
        "1000000 + p_partkey AS proposal_id",
        "CASE p_partkey % 6 WHEN 0 THEN p_name WHEN 1 THEN upper(concat(p_name, ', Inc.'))"
        " WHEN 2 THEN concat(substring(p_name, 1, 2), substring(p_name, 4))"
        " WHEN 3 THEN concat(substring(p_name, 1, 3), substring(p_name, 3))"
        " WHEN 4 THEN concat('zq', p_name, 'xy') ELSE concat(substring(p_name, 1, 4), 'q', substring(p_name, 6)) END"
        " AS proposed_name",
    )


NORM = (
    r"trim(regexp_replace(trim(regexp_replace(strip_accents(lower({c})), '[^\p{{L}}\p{{N}}]+', ' ', 'g')),"
    r" '( (llc|inc|corp|corporation|ltd|co))+$', ''))"
)

MATCH = f"""WITH gm AS (SELECT min(p_partkey) AS k, p_name FROM part GROUP BY 2 HAVING min(p_partkey) % 5 <> 0),
  m AS (SELECT min(k + 1) AS id, {NORM.format(c='p_name')} AS norm FROM gm GROUP BY 2),
  p AS (SELECT 1000000 + p_partkey AS proposal_id, CASE p_partkey % 6 WHEN 0 THEN p_name WHEN 1 THEN upper(p_name || ', Inc.')
      WHEN 2 THEN substring(p_name, 1, 2) || substring(p_name, 4) WHEN 3 THEN substring(p_name, 1, 3) || substring(p_name, 3)
      WHEN 4 THEN 'zq' || p_name || 'xy' ELSE substring(p_name, 1, 4) || 'q' || substring(p_name, 6) END AS proposed_name FROM part),
  pn AS (SELECT *, {NORM.format(c='proposed_name')} AS norm FROM p),
  c AS (SELECT a.norm, id, greatest(length(a.norm), length(m.norm)) AS l, levenshtein(a.norm, m.norm) AS d
    FROM (SELECT DISTINCT norm FROM pn) a, m),
  e AS (SELECT norm, id, CAST(((l - d) * 20000 + l) // (2 * l) AS DOUBLE) / 100 AS score FROM c),
  s AS (SELECT * FROM e WHERE score >= 80),
  b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY norm ORDER BY score DESC, id) = 1),
  matched AS (SELECT proposal_id, proposed_name, b.id AS golden_id, coalesce(score, 0.0) AS match_confidence
    FROM pn LEFT JOIN b USING (norm))"""


def _matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.match(
        proposals(spark, sf_dir), name_masters(spark, sf_dir), "proposed_name", "vendor_id", "vendor_name"
    )


@query("md_match", f"{MATCH} SELECT * FROM matched")
def md_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _matches(spark, sf_dir)


ROUTE = """CASE WHEN match_confidence >= 95 THEN 'AUTO_APPROVE' WHEN match_confidence >= 80 THEN 'STEWARD_REVIEW'
  ELSE 'MANUAL_RESOLUTION' END"""


@query(
    "md_route",
    f"""{MATCH} SELECT 'run-1' AS pipeline_run_id, 'VENDOR' AS entity_type, CAST(proposal_id AS VARCHAR) AS source_id,
      proposed_name, golden_id, match_confidence, CASE WHEN match_confidence >= 95 THEN 'ACTIVE' ELSE 'PROPOSED' END AS lifecycle_state,
      match_confidence >= 95 AS auto_approved, match_confidence >= 80 AND match_confidence < 95 AS dedup_queued,
      {ROUTE} AS decision FROM matched""",
)
def md_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.match_temp(_matches(spark, sf_dir), "run-1", "VENDOR", "proposal_id", "proposed_name")


@query(
    "md_propose",
    f"""{MATCH}, n AS (SELECT proposal_id, proposed_name, match_confidence, (SELECT max(k + 1) FROM gm)
      + row_number() OVER (ORDER BY proposal_id) AS vendor_id FROM matched WHERE match_confidence < 95)
    SELECT k + 1 AS vendor_id, k AS source_vendor_id, p_name AS vendor_name, 'ACTIVE' AS lifecycle_state,
      CAST(100 AS DOUBLE) AS match_confidence, 'steward' AS approved_by, NULL AS source_system, NULL AS created_at,
      NULL AS created_by FROM gm
    UNION ALL SELECT vendor_id, proposal_id, proposed_name, 'PROPOSED', match_confidence, NULL, 'feed', '{AS_OF}', 'etl' FROM n""",
)
def md_propose(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.propose(
        name_masters(spark, sf_dir),
        matching.routed(_matches(spark, sf_dir)),
        "VENDOR",
        "proposal_id",
        "proposed_name",
        AS_OF,
        "etl",
        "feed",
    )


CLUSTERS = f"""WITH RECURSIVE a AS (SELECT p_partkey + 1 AS id, {NORM.format(c='p_name')} AS norm FROM part),
  f AS (SELECT norm, min(id) AS id FROM a GROUP BY 1),
  pairs AS (SELECT x.id AS x, y.id AS y, CAST(((greatest(length(x.norm), length(y.norm)) - levenshtein(x.norm, y.norm)) * 20000
      + greatest(length(x.norm), length(y.norm))) // (2 * greatest(length(x.norm), length(y.norm))) AS DOUBLE) / 100 AS score FROM f x, f y),
  links AS (SELECT x, y FROM pairs WHERE score >= 80),
  reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
  cluster AS (SELECT x AS id, min(y) AS cluster_id FROM reach GROUP BY 1),
  members AS (SELECT cluster_id, a.id AS record_id, score AS match_score
    FROM a JOIN f USING (norm) JOIN cluster c ON c.id = f.id JOIN pairs ON x = cluster_id AND y = f.id
    QUALIFY count(*) OVER (PARTITION BY cluster_id) > 1)"""
LEVEL = "CASE WHEN {s} >= 95 THEN 'HIGH' WHEN {s} >= 80 THEN 'MEDIUM' ELSE 'LOW' END AS confidence_level"


@query(
    "md_dedup_queue",
    f"""WITH a AS (SELECT p_partkey + 1 AS id, {NORM.format(c='p_name')} AS norm FROM part),
      f AS (SELECT norm, min(id) AS id FROM a GROUP BY 1),
      q AS (SELECT f.id AS id_1, a.id AS id_2, CAST(100 AS DOUBLE) AS match_score FROM a JOIN f USING (norm) WHERE a.id <> f.id
        UNION ALL SELECT * FROM (
          SELECT x.id AS id_1, y.id AS id_2, CAST(((greatest(length(x.norm), length(y.norm)) - levenshtein(x.norm, y.norm)) * 20000
            + greatest(length(x.norm), length(y.norm))) // (2 * greatest(length(x.norm), length(y.norm))) AS DOUBLE) / 100 AS match_score
          FROM f x JOIN f y ON x.id < y.id) WHERE match_score >= 80)
      SELECT *, CASE WHEN match_score >= 95 THEN 'HIGH' WHEN match_score >= 80 THEN 'MEDIUM' ELSE 'LOW' END AS confidence_level FROM q""",
)
def md_dedup_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.dedup_pairs(named_parts(spark, sf_dir), "part_id", "part_name")


@query("md_dedup_members", f"{CLUSTERS} SELECT * FROM members")
def md_dedup_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.dedup_members(named_parts(spark, sf_dir), "part_id", "part_name")


@query(
    "md_dedup_clusters",
    f"""{CLUSTERS} SELECT cluster_id, count(*) AS n_records, min(match_score) AS lowest_score,
      {LEVEL.format(s='min(match_score)')}, min(match_score) >= 95 AS auto_merge FROM members GROUP BY 1""",
)
def md_dedup_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.dedup_clusters(matching.dedup_members(named_parts(spark, sf_dir), "part_id", "part_name"))


# --- approval -----------------------------------------------------------------------------------------

SUPPLIERS = """WITH m AS (SELECT s_suppkey + 1 AS vendor_id, s_suppkey AS k, s_name,
    CASE WHEN s_suppkey % 7 = 3 THEN 'PROPOSED' WHEN s_suppkey % 11 = 5 THEN 'REJECTED' ELSE 'ACTIVE' END AS state,
    CASE WHEN s_suppkey % 7 = 3 OR s_suppkey % 13 = 1 THEN NULL ELSE 'steward' END AS approver FROM supplier)"""


@query(
    "md_approve_keys",
    f"""{SUPPLIERS} SELECT k AS source_vendor_id, CASE WHEN k % 4 = 2 THEN 'ACTIVE' ELSE state END AS lifecycle_state,
      CASE WHEN k % 4 = 2 THEN '{AS_OF}' END AS approved_at, CASE WHEN k % 4 = 2 THEN 'steward_test' ELSE approver END AS approved_by
    FROM m""",
)
def md_approve_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    vendors = T.master_vendors(spark, sf_dir)
    chosen = vendors.filter("source_vendor_id % 4 = 2")
    return G.approve(vendors, chosen, "source_vendor_id", "steward_test", AS_OF).select(
        "source_vendor_id", "lifecycle_state", "approved_at", "approved_by"
    )


@query(
    "md_approve_batch",
    f"""{SUPPLIERS}, b AS (SELECT k FROM m WHERE state = 'PROPOSED' ORDER BY k LIMIT 10)
    SELECT k AS source_vendor_id, CASE WHEN k IN (FROM b) THEN 'ACTIVE' ELSE state END AS lifecycle_state,
      CASE WHEN k IN (FROM b) THEN '{AS_OF}' END AS approved_at,
      CASE WHEN k IN (FROM b) THEN 'data_steward' ELSE approver END AS approved_by FROM m""",
)
def md_approve_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.approve_batch(T.master_vendors(spark, sf_dir), "source_vendor_id", 10, "data_steward", AS_OF).select(
        "source_vendor_id", "lifecycle_state", "approved_at", "approved_by"
    )


@query(
    "md_status",
    f"""{SUPPLIERS} SELECT 'VENDOR' AS entity_type, count(*) FILTER (WHERE state = 'PROPOSED') AS pending,
        count(*) FILTER (WHERE state = 'ACTIVE') AS approved, count(*) FILTER (WHERE state = 'REJECTED') AS rejected,
        pending = 0 AS all_approved FROM m
      UNION ALL SELECT 'ZONE', count(*) FILTER (WHERE n_nationkey IN (11, 23)), count(*) FILTER (WHERE n_nationkey NOT IN (11, 23)), 0,
        count(*) FILTER (WHERE n_nationkey IN (11, 23)) = 0 FROM nation""",
)
def md_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.approval_status(
        {"VENDOR": T.master_vendors(spark, sf_dir), "ZONE": zone_masters(spark, sf_dir)}
    )


# --- golden ids ------------------------------------------------------------------------------------------

GOLDEN_IDS = """SELECT trip_id, CAST(v.source_vendor_id + 1 AS BIGINT) AS vendor_golden_id,
    CAST(p.zone_id AS BIGINT) AS pu_zone_golden_id, CAST(d.zone_id AS BIGINT) AS do_zone_golden_id,
    CAST(r.ratecode_id AS BIGINT) AS ratecode_golden_id
  FROM trips LEFT JOIN mvendors v ON vendorid = v.source_vendor_id AND v.lifecycle_state = 'ACTIVE'
  LEFT JOIN mzones p ON pulocationid = p.source_zone_id AND p.lifecycle_state = 'ACTIVE'
  LEFT JOIN mzones d ON dolocationid = d.source_zone_id AND d.lifecycle_state = 'ACTIVE'
  LEFT JOIN mrates r ON ratecodeid = source_ratecode_id"""
GOLDEN_COLUMNS = ["trip_id", "vendor_golden_id", "pu_zone_golden_id", "do_zone_golden_id", "ratecode_golden_id"]


@query("md_enrich", sql("trips mvendors mzones mrates", GOLDEN_IDS))
def md_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.attach_golden_ids(T.trips(spark, sf_dir), masters(spark, sf_dir)).select(*GOLDEN_COLUMNS)


@query(
    "md_reenrich",
    sql(
        "trips mvendors mzones mrates",
        f"""{GOLDEN_IDS.replace("mzones p ON pulocationid = p.source_zone_id AND p.lifecycle_state = 'ACTIVE'",
                                "mzones p ON pulocationid = p.source_zone_id")
               .replace("mzones d ON dolocationid = d.source_zone_id AND d.lifecycle_state = 'ACTIVE'",
                        "mzones d ON dolocationid = d.source_zone_id")}
        WHERE pulocationid IN (11, 23) OR dolocationid IN (11, 23)""",
    ),
)
def md_reenrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pending zones are approved; only trips that touch them are enriched again."""
    held = masters(spark, sf_dir)
    pending = held["ZONE"].filter("lifecycle_state = 'PROPOSED'")
    held["ZONE"] = G.approve(held["ZONE"], pending, "source_zone_id", "steward", AS_OF)
    approved = pending.selectExpr("'ZONE' AS entity_type", "source_zone_id AS source_id")
    return G.reenrich(T.trips(spark, sf_dir), approved, held).select(*GOLDEN_COLUMNS)


@query(
    "md_batch",
    sql("trips", "SELECT trip_id, CAST(vendorid AS BIGINT) AS vendorid FROM trips WHERE trip_id % 3 <> 1 ORDER BY trip_id LIMIT 400"),
)
def md_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = T.trips(spark, sf_dir).select("trip_id", "vendorid")
    tracker = trips.filter("trip_id % 3 = 1").select("trip_id")
    return G.next_batch(trips, tracker, 400)


@query(
    "md_unprocessed",
    sql("trips", "SELECT trip_id, CAST(vendorid AS BIGINT) AS vendorid FROM trips WHERE trip_id % 3 <> 1"),
)
def md_unprocessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = T.trips(spark, sf_dir).select("trip_id", "vendorid")
    return G.unprocessed(trips, trips.filter("trip_id % 3 = 1").select("trip_id"))


@query(
    "md_tracker",
    sql(
        "trips",
        """, d AS (SELECT DISTINCT trip_id AS i FROM trips WHERE trip_id % 1000 < 700 OR trip_id BETWEEN 2500 AND 4200),
        r AS (SELECT i, i - row_number() OVER (PARTITION BY i >> 20 ORDER BY i) AS run FROM d)
        SELECT i >> 20 AS block, min(i) AS first_id, max(i) AS last_id FROM r GROUP BY i >> 20, run""",
    ),
)
def md_tracker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What three runs have processed: one with gaps, one that fills some, and the first again."""
    ids = T.trips(spark, sf_dir).select("trip_id")
    first, second = ids.filter("trip_id % 1000 < 700"), ids.filter("trip_id BETWEEN 2500 AND 4200")
    tracker = None
    for run in (first, second, first):
        tracker = stored(G.track(tracker, run), "tracker")
    return tracker


@query(
    "md_unprocessed_ranges",
    sql("trips", "SELECT trip_id, CAST(vendorid AS BIGINT) AS vendorid FROM trips WHERE trip_id % 1000 >= 700"),
)
def md_unprocessed_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = T.trips(spark, sf_dir).select("trip_id", "vendorid")
    return G.unprocessed(trips, stored(G.track(None, trips.filter("trip_id % 1000 < 700")), "tracker"))


@query(
    "md_audit",
    sql(
        "trips mvendors mzones mrates",
        f""", g AS ({GOLDEN_IDS}) SELECT 'run-1' AS pipeline_run_id, 'scheduler' AS triggered_by, 'TRIP' AS entity_type,
          count(*) AS records_processed, count(*) FILTER (WHERE vendor_golden_id IS NOT NULL AND pu_zone_golden_id IS NOT NULL
            AND do_zone_golden_id IS NOT NULL AND ratecode_golden_id IS NOT NULL) AS records_approved,
          CAST((2 * 10000 * records_approved + records_processed) // (2 * records_processed) AS DOUBLE) / 100 AS quality_score,
          'SUCCESS' AS status, '2024-01-31 00:00:00' AS run_start, '2024-01-31 00:10:00' AS run_end FROM g""",
    ),
)
def md_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    enriched = G.attach_golden_ids(T.trips(spark, sf_dir), masters(spark, sf_dir))
    return G.audit_record(enriched, "run-1", "TRIP", "scheduler", AS_OF, "2024-01-31 00:10:00")


@query(
    "md_verify",
    f"""{SUPPLIERS} SELECT 'VENDOR' AS type, vendor_id AS id, s_name AS name, 'ACTIVE' AS lifecycle_state, 'steward_test' AS approved_by
        FROM m WHERE k % 9 = 4
      UNION ALL SELECT 'ZONE', n_nationkey + 1, n_name, 'ACTIVE', 'steward_test' FROM nation WHERE n_nationkey IN (11, 23)""",
)
def md_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    vendors, zones = T.master_vendors(spark, sf_dir), zone_masters(spark, sf_dir)
    chosen = {
        "VENDOR": vendors.filter("source_vendor_id % 9 = 4").select("source_vendor_id"),
        "ZONE": zones.filter("lifecycle_state = 'PROPOSED'").select("source_zone_id"),
    }
    done = {
        "VENDOR": G.approve(vendors, chosen["VENDOR"], "source_vendor_id", "steward_test", AS_OF),
        "ZONE": G.approve(zones, chosen["ZONE"], "source_zone_id", "steward_test", AS_OF),
    }
    return G.listed(done, chosen)


@query(
    "so_argmax_row",
    sql("trips", f"SELECT trip_id, {bigint('vendorid pulocationid')} FROM trips WHERE trip_id = (SELECT max(trip_id) FROM trips)"),
)
def so_argmax_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trip with the highest id, by a partial maximum of whole rows."""
    trips = T.trips(spark, sf_dir).select("trip_id", "vendorid", "pulocationid")
    return trips.agg(F.max_by(F.struct(*trips.columns), "trip_id").alias("row")).select("row.*")
