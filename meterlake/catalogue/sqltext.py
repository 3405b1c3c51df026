"""Building blocks for the independent SQL statements (DuckDB dialect).

Amounts are whole cents (``*_c``) until one final division.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from meterlake import schemas as S


def rdiv(num: str, den: str, digits: int) -> str:
    """Half-away-from-zero rounding of a quotient of whole numbers."""
    p = 10**digits
    return (
        f"(CASE WHEN ({den}) = 0 THEN NULL ELSE CAST(sign({num}) * ((2 * abs(CAST({num} AS HUGEINT)) * {p}"
        f" + ({den})) // (2 * ({den}))) AS DOUBLE) / {p} END)"
    )


def dollars(c: str) -> str:
    return f"CAST({c} AS DOUBLE) / 100"


def ratio(num: str, den: str) -> str:
    return f"CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE)"


def rows(values: Sequence[Sequence[Any]]) -> str:
    def lit(v: Any) -> str:
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return "true" if v else "false"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return str(v)

    return ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in values)


def _pairs(name: str, columns: str, values: Sequence[Sequence[Any]]) -> str:
    return f"SELECT * FROM (VALUES {rows(values)}) AS {name}_v({columns})"


# name -> (names it needs, body)
TABLES: dict[str, tuple[list[str], str]] = {
    "fares": (
        [],
        """SELECT event_id AS k, user_id AS u, date_trunc('second', ts) AS pickup,
          CASE WHEN event_id % 211 = 5 THEN -CAST(round(value * 100) AS BIGINT)
               ELSE CAST(round(value * 100) AS BIGINT) END AS fare_c,
          CASE WHEN event_type IN ('click', 'purchase') THEN 1 WHEN event_type = 'view' THEN 2
               WHEN event_type = 'signup' THEN 3 ELSE 4 END AS payment_type,
          CASE WHEN event_id % 10 = 0 THEN 694 ELSE 0 END AS tolls_c,
          (event_id % 3) * 50 AS extra_c,
          CASE WHEN event_id % 13 = 0 THEN 175 ELSE 0 END AS airport_c
        FROM events""",
    ),
    "tipped": (
        ["fares"],
        """SELECT *, CASE WHEN payment_type = 1 THEN fare_c * (k % 6) * 5 // 100 ELSE 0 END AS tip_c
        FROM fares""",
    ),
    "trips": (
        ["tipped"],
        """SELECT k AS trip_id,
          CASE WHEN k % 1000 = 11 THEN NULL WHEN k % 500 = 3 THEN 3
               ELSE [1, 2, 6, 7][k % 4 + 1] END AS vendorid,
          pickup AS tpep_pickup_datetime,
          CASE WHEN k % 701 = 9 THEN NULL
               ELSE pickup + to_seconds((k * 131) % 5400 - 60) END AS tpep_dropoff_datetime,
          k % 7 AS passengers, (k * 37) % 2500 AS dist_c,
          CASE k % 41 WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 2 THEN 4 WHEN 3 THEN 5 WHEN 4 THEN 6
               WHEN 5 THEN 99 WHEN 6 THEN NULL ELSE 1 END AS ratecodeid,
          CASE WHEN k % 50 = 0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
          CASE WHEN k % 400 = 7 THEN 265 ELSE u % 25 END AS pulocationid,
          (u + k) % 25 AS dolocationid, payment_type,
          fare_c, extra_c, tip_c, tolls_c, airport_c, 1 + k % 2 AS cab_type_id,
          fare_c + extra_c + 50 + tip_c + tolls_c + 100 + 250 + airport_c
            + CASE WHEN k % 997 = 1 THEN 1 ELSE 0 END AS total_c,
          CASE WHEN k % 701 = 9 THEN NULL ELSE (k * 131) % 5400 - 60 END AS secs
        FROM tipped""",
    ),
    "zones": (
        [],
        """SELECT n_nationkey AS locationid, r_name AS borough, n_name AS zone,
          CASE n_nationkey % 5 WHEN 0 THEN 'Airports' WHEN 1 THEN 'Yellow Zone'
               ELSE 'Boro Zone' END AS service_zone
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    ),
    "vendors": (
        [],
        _pairs("vendors", "vendor_id, vendor_name", [v[:2] for v in S.VENDORS if v[0]]),
    ),
    "rates": ([], _pairs("rates", "rate_code_id, rate_code_desc", S.LAKE_RATE_CODES)),
    "valid": (
        ["trips"],
        """SELECT * FROM trips WHERE passengers > 0 AND dist_c > 0 AND fare_c > 0 AND total_c > 0
          AND tpep_dropoff_datetime IS NOT NULL AND vendorid IS NOT NULL AND ratecodeid IS NOT NULL
          AND pulocationid IS NOT NULL AND dolocationid IS NOT NULL""",
    ),
    "golden": (
        ["valid", "vendors", "rates", "zones"],
        """SELECT t.*, v.vendor_name, r.rate_code_desc, p.zone AS pu_zone, p.borough AS pu_borough,
          p.service_zone AS pu_service_zone, d.zone AS do_zone, d.borough AS do_borough,
          d.service_zone AS do_service_zone,
          CASE WHEN fare_c > 0 THEN tip_c * 100.0 / fare_c ELSE 0 END AS tip_pct,
          CASE WHEN fare_c > 0 AND tip_c * 100 > fare_c * 20 THEN 1 ELSE 0 END AS high_tip_flag
        FROM valid t JOIN vendors v ON t.vendorid = v.vendor_id
        JOIN rates r ON t.ratecodeid = r.rate_code_id
        JOIN zones p ON t.pulocationid = p.locationid JOIN zones d ON t.dolocationid = d.locationid""",
    ),
}


def needs(names: Sequence[str]) -> list[str]:
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for need in TABLES[name][0]:
            visit(need)
        ordered.append(name)

    for name in names:
        visit(name)
    return ordered


def sql(names: str, body: str) -> str:
    """A statement over named tables: their definitions, then the body.

    A body that starts with ``, name AS (`` adds definitions of its own.
    """
    ordered = needs(names.split())
    if not ordered:
        return body
    text = ",\n".join(f"{n} AS ({TABLES[n][1]})" for n in ordered)
    return f"WITH {text}\n{body}"

TABLES.update(
    {
        "dvendor": (
            [],
            _pairs("dvendor", "vendor_sk, vendor_id, vendor_name, vendor_code", [(i, *v) for i, v in enumerate(S.VENDORS, 1)]),
        ),
        "drate": (
            [],
            _pairs(
                "drate",
                "ratecode_sk, ratecode_id, rate_code_name, rate_description, is_flat_rate, is_negotiated",
                [(i, *r) for i, r in enumerate(S.RATE_CODES, 1)],
            ),
        ),
        "dpay": (
            [],
            _pairs(
                "dpay",
                "payment_sk, payment_type_id, payment_type_name, payment_category, allows_tip_record",
                [(i, *p) for i, p in enumerate(S.PAYMENTS, 1)],
            ),
        ),
        "dzone": (
            ["zones"],
            """SELECT locationid + 2 AS zone_sk, locationid AS location_id, borough, zone AS zone_name,
              service_zone, service_zone = 'Airports' AS is_airport, borough = 'ASIA' AS is_manhattan,
              service_zone = 'Yellow Zone' AS is_yellow_zone,
              CASE WHEN service_zone = 'Airports' THEN 'Airport'
                   WHEN service_zone = 'Yellow Zone' THEN 'ASIA Core'
                   WHEN borough = 'ASIA' THEN 'ASIA Other' ELSE 'Outer Borough' END AS zone_category
            FROM zones UNION ALL
            SELECT 1, -1, 'Unknown', 'Unknown', 'Unknown', false, false, false, 'Outer Borough'""",
        ),
        "dtime": (
            [],
            f"""SELECT h AS time_sk, h AS hour_24, (h + 11) % 12 + 1 AS hour_12,
              CASE WHEN h < 12 THEN 'AM' ELSE 'PM' END AS am_pm,
              CASE {' '.join(f"WHEN h BETWEEN {a} AND {b} THEN '{n}'" for a, b, n in S.TIME_PERIODS)} END AS time_period,
              h IN (7, 8, 9, 17, 18, 19) AS rush_hour_flag,
              CASE {' '.join(f"WHEN h BETWEEN {a} AND {b} THEN '{n}'" for a, b, n in S.DAY_PARTS)} END AS day_part,
              h BETWEEN 9 AND 17 AS business_hour FROM range(24) AS r(h)""",
        ),
        "ddate": (
            [],
            """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_sk, d AS full_date, dayofweek(d) AS day_of_week,
              dayname(d) AS day_of_week_name, day(d) AS day_of_month, dayofyear(d) AS day_of_year,
              weekofyear(d) AS week_of_year, month(d) AS month_number, monthname(d) AS month_name,
              left(monthname(d), 3) AS month_short, quarter(d) AS quarter, 'Q' || quarter(d) AS quarter_name,
              year(d) AS year, strftime(d, '%Y-%m') AS year_month, dayofweek(d) IN (0, 6) AS is_weekend,
              false AS is_holiday
            FROM (SELECT DATE '2020-01-01' + CAST(i AS INTEGER) AS d FROM range(4018) AS r(i))""",
        ),
        "staged": (
            ["trips"],
            """SELECT *, CAST(strftime(tpep_pickup_datetime, '%Y%m%d') AS INTEGER) AS pickup_date_sk,
              hour(tpep_pickup_datetime) AS pickup_time_sk,
              CAST(strftime(tpep_dropoff_datetime, '%Y%m%d') AS INTEGER) AS dropoff_date_sk,
              hour(tpep_dropoff_datetime) AS dropoff_time_sk,
              date_diff('minute', tpep_pickup_datetime, tpep_dropoff_datetime) AS minutes,
              CASE WHEN fare_c > 0 THEN (2 * tip_c * 10000 + fare_c) // (2 * fare_c) ELSE 0 END AS tip2,
              fare_c > 0 AND tip_c * 5 > fare_c AS is_high_tip, payment_type = 2 AS is_cash_trip,
              hour(tpep_pickup_datetime) IN (7, 8, 9, 17, 18, 19) AS is_rush_hour
            FROM trips WHERE tpep_dropoff_datetime IS NOT NULL""",
        ),
        "fact": (
            ["staged", "dvendor", "drate", "dpay", "dzone"],
            """SELECT s.*, coalesce(v.vendor_sk, 5) AS vendor_sk, coalesce(p.zone_sk, 1) AS pickup_zone_sk,
              coalesce(d.zone_sk, 1) AS dropoff_zone_sk, coalesce(r.ratecode_sk, 7) AS ratecode_sk,
              coalesce(y.payment_sk, 5) AS payment_sk,
              coalesce(p.is_airport, false) OR coalesce(d.is_airport, false) AS is_airport_trip
            FROM staged s LEFT JOIN dvendor v ON s.vendorid = v.vendor_id
            LEFT JOIN dzone p ON s.pulocationid = p.location_id
            LEFT JOIN dzone d ON s.dolocationid = d.location_id
            LEFT JOIN drate r ON coalesce(s.ratecodeid, 99) = r.ratecode_id
            LEFT JOIN dpay y ON coalesce(s.payment_type, 0) = y.payment_type_id""",
        ),
    }
)


def bigint(columns: str) -> str:
    return ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in columns.replace(",", " ").split())


FACT_SELECT = f"""SELECT trip_id AS trip_sk, {bigint('pickup_date_sk pickup_time_sk dropoff_date_sk dropoff_time_sk')},
  {bigint('vendor_sk pickup_zone_sk dropoff_zone_sk ratecode_sk payment_sk')}, store_and_fwd_flag,
  CAST(passengers AS BIGINT) AS passenger_count, {dollars('dist_c')} AS trip_distance,
  {dollars('fare_c')} AS fare_amount, {dollars('extra_c')} AS extra_amount, CAST(0.5 AS DOUBLE) AS mta_tax,
  {dollars('tip_c')} AS tip_amount, {dollars('tolls_c')} AS tolls_amount,
  CAST(1 AS DOUBLE) AS improvement_surcharge, CAST(2.5 AS DOUBLE) AS congestion_surcharge,
  {dollars('airport_c')} AS airport_fee, CAST(0 AS DOUBLE) AS cbd_congestion_fee,
  {dollars('total_c')} AS total_amount, CAST(minutes AS BIGINT) AS trip_duration_minutes,
  {dollars('tip2')} AS tip_percentage, dist_c > 1000 AS is_long_trip, dist_c < 100 AS is_short_trip,
  is_high_tip, is_cash_trip, is_airport_trip, is_rush_hour FROM"""

# vendor masters with vendor 6 still waiting for approval; zones with 11 and 23 waiting
TABLES.update(
    {
        "mvendors": (
            [],
            "SELECT *, CASE WHEN source_vendor_id = 6 THEN 'PROPOSED' ELSE 'ACTIVE' END AS lifecycle_state"
            " FROM (VALUES " + rows([v[:2] for v in S.VENDORS if v[0]]) + ") AS m(source_vendor_id, vendor_name)",
        ),
        "mzones": (
            [],
            """SELECT n_nationkey AS source_zone_id, n_nationkey + 1 AS zone_id, n_name AS zone_name,
              CASE WHEN n_nationkey IN (11, 23) THEN 'PROPOSED' ELSE 'ACTIVE' END AS lifecycle_state FROM nation""",
        ),
        "mrates": (
            [],
            "SELECT *, source_ratecode_id + 1 AS ratecode_id FROM (VALUES "
            + rows([r for r in S.LAKE_RATE_CODES if r[0] != 6])
            + ") AS m(source_ratecode_id, rate_code_desc)",
        ),
        "enriched": (
            ["trips", "zones"],
            """SELECT t.*, p.zone AS pu_zone, p.borough AS pu_borough, d.zone AS do_zone, d.borough AS do_borough,
              CASE WHEN fare_c > 0 AND tip_c * 5 > fare_c THEN 1 ELSE 0 END AS high_tip_flag,
              CASE WHEN fare_c > 0 THEN (2 * tip_c * 10000 + fare_c) // (2 * fare_c) ELSE 0 END AS tip2,
              CASE WHEN fare_c > 0 THEN tip_c * 100.0 / fare_c ELSE 0 END AS tip_pct,
              CASE WHEN secs >= 0 THEN secs // 60 ELSE -((-secs) // 60) END AS whole_min
            FROM trips t LEFT JOIN zones p ON t.pulocationid = p.locationid
            LEFT JOIN zones d ON t.dolocationid = d.locationid""",
        ),
        "scored": (
            ["enriched"],
            """SELECT *, CASE WHEN secs IS NULL THEN 0
                ELSE CAST(sign(secs) * ((abs(secs) * 200 + 60) // 120) AS BIGINT) END AS dur2,
              10 * (CAST(total_c >= 0 AS INT) + CAST(fare_c >= 0 AS INT) + 1 + CAST(secs > 0 AS INT)
                + CAST(CASE WHEN secs IS NULL THEN false ELSE dur2 BETWEEN 100 AND 144000 END AS INT)
                + CAST(passengers BETWEEN 1 AND 8 AS INT) + 1 + 1 + CAST(vendorid IS NOT NULL AS INT) + 1) AS score
            FROM enriched""",
        ),
        "daily": (
            ["scored", "mvendors"],
            f"""SELECT CAST(tpep_pickup_datetime AS DATE) AS summary_date, vendorid AS vendor_id,
              coalesce(v.vendor_name, 'Unknown Vendor') AS vendor_name, pulocationid AS pickup_zone_id,
              coalesce(pu_zone, 'Unknown') AS pickup_zone_name, coalesce(pu_borough, 'Unknown') AS pickup_borough,
              dolocationid AS dropoff_zone_id, coalesce(do_zone, 'Unknown') AS dropoff_zone_name,
              coalesce(do_borough, 'Unknown') AS dropoff_borough, count(*) AS total_trips,
              CAST(sum(passengers) AS BIGINT) AS total_passengers, sum(total_c) AS revenue_c,
              {dollars('sum(total_c)')} AS total_revenue, {dollars('sum(fare_c)')} AS total_fare,
              {dollars('sum(tip_c)')} AS total_tips, {dollars('sum(tolls_c)')} AS total_tolls,
              {dollars('sum(250 + airport_c)')} AS total_surcharges, {dollars('sum(dist_c)')} AS total_distance,
              {rdiv('sum(dist_c)', '100 * count(*)', 2)} AS avg_distance,
              {rdiv('sum(dur2)', '100 * count(*)', 2)} AS avg_trip_duration,
              {rdiv('sum(fare_c)', '100 * count(*)', 2)} AS avg_fare,
              {rdiv('sum(tip_c)', '100 * count(*)', 2)} AS avg_tip,
              {rdiv('sum(total_c)', '100 * count(*)', 2)} AS avg_total_amount,
              CAST(count_if(tip_c > 0) AS BIGINT) AS trips_with_tips,
              {rdiv('100 * count_if(tip_c > 0)', 'count(*)', 2)} AS tip_percentage,
              {rdiv('sum(tip2)', '100 * count(*)', 2)} AS avg_tip_pct,
              CAST(count_if(dist_c > 2000) AS BIGINT) AS long_trips,
              CAST(count_if(dist_c < 100) AS BIGINT) AS short_trips,
              CAST(sum(high_tip_flag) AS BIGINT) AS high_tip_trips,
              count(*) FILTER (WHERE ratecodeid = 1) AS standard_rate_trips,
              count(*) FILTER (WHERE ratecodeid IN (2, 3)) AS airport_trips,
              count(*) FILTER (WHERE ratecodeid = 5) AS negotiated_trips,
              {rdiv('sum(score)', 'count(score)', 2)} AS data_quality_score, count(*) AS source_row_count
            FROM scored LEFT JOIN mvendors v ON vendorid = source_vendor_id AND v.lifecycle_state = 'ACTIVE'
            WHERE vendorid IS NOT NULL GROUP BY ALL""",
        ),
        "vendor_day": (
            ["enriched", "mvendors"],
            f"""SELECT vendorid AS vendor_id, v.vendor_name, CAST(tpep_pickup_datetime AS DATE) AS metric_date,
              count(*) AS total_trips, {dollars('sum(total_c)')} AS total_revenue,
              {dollars('sum(dist_c)')} AS total_distance, {rdiv('sum(whole_min)', 'count(whole_min)', 2)} AS avg_trip_duration,
              {rdiv('sum(fare_c)', '100 * count(*)', 2)} AS avg_fare, round(avg(tip_pct), 2) AS avg_tip_pct,
              count(*) AS source_row_count
            FROM enriched LEFT JOIN mvendors v ON vendorid = source_vendor_id AND v.lifecycle_state = 'ACTIVE'
            WHERE vendorid IS NOT NULL GROUP BY 1, 2, 3""",
        ),
        "hours": (
            ["enriched"],
            """SELECT pulocationid AS pickup_zone_id, dolocationid AS dropoff_zone_id,
              CAST(tpep_pickup_datetime AS DATE) AS metric_date, hour(tpep_pickup_datetime) AS h, count(*) AS n
            FROM enriched GROUP BY ALL""",
        ),
        "peaks": (
            ["hours"],
            """SELECT * FROM hours QUALIFY row_number() OVER (
              PARTITION BY pickup_zone_id, dropoff_zone_id, metric_date ORDER BY n DESC, h) = 1""",
        ),
        "routes": (
            ["enriched", "peaks"],
            f"""SELECT pickup_zone_id, dropoff_zone_id, metric_date, h AS peak_hour, r.* EXCLUDE (a, b, c) FROM peaks
            JOIN (SELECT pulocationid AS a, dolocationid AS b, CAST(tpep_pickup_datetime AS DATE) AS c,
              count(*) AS trip_count, {rdiv('sum(fare_c)', '100 * count(*)', 2)} AS avg_fare,
              {rdiv('sum(dist_c)', '100 * count(*)', 2)} AS avg_distance,
              {rdiv('sum(whole_min)', 'count(whole_min)', 2)} AS avg_duration FROM enriched GROUP BY 1, 2, 3) r
            ON pickup_zone_id = a AND dropoff_zone_id = b AND metric_date = c""",
        ),
    }
)

DAILY_SELECT = f"""SELECT * EXCLUDE (revenue_c) REPLACE (CAST(summary_date AS VARCHAR) AS summary_date,
  CAST(vendor_id AS BIGINT) AS vendor_id, CAST(pickup_zone_id AS BIGINT) AS pickup_zone_id,
  CAST(dropoff_zone_id AS BIGINT) AS dropoff_zone_id) FROM daily"""

VENDOR_DAY_COLUMNS = """CAST(vendor_id AS BIGINT) AS vendor_id, vendor_name, total_trips, total_revenue,
  total_distance, avg_trip_duration, avg_fare, avg_tip_pct, source_row_count"""
