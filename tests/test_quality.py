"""Checks, metrics, features and casts on small known inputs."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from meterlake.functions import features as X
from meterlake.functions import names as N
from meterlake.functions import times
from meterlake.functions.casts import safe_amount, safe_whole
from meterlake.functions.exact import round_half_away, rounded_avg, rounded_sum
from meterlake.functions.rules import within_month
from meterlake.operators import quality as Q
from meterlake.plans import lake, warehouse

AS_OF = "2024-01-31 00:00:00"


def value(df, expression):
    return df.select(expression.alias("v")).first()["v"]


@pytest.fixture(scope="module")
def one_row(spark):
    return spark.range(1)


def test_completeness_duplicates_freshness(spark):
    df = spark.createDataFrame(
        [("a", 1, datetime(2024, 1, 24)), ("a", 2, None), ("b", None, None), (None, 3, None)], "k string, v int, t timestamp_ntz"
    )
    assert Q.completeness(df, "v").first()[0] == 75.0
    assert Q.duplicate_rate(df, "k").first()[0] == 50.0
    assert Q.freshness(df, "t", 7, AS_OF).first()[0] == "FRESH"
    assert Q.freshness(df, "t", 7, "2024-02-01 00:00:00").first()[0] == "STALE"
    empty = df.filter("false")
    assert Q.freshness(empty, "t", 7, AS_OF).first()[0] == "STALE"
    assert Q.completeness(empty, "v").first()[0] == 0.0
    assert Q.duplicate_rate(empty, "k").first()[0] == 0.0
    assert Q.duplicate_key(empty, "k").first()["duplicate_count"] == 0


def test_quality_score(spark):
    df = spark.createDataFrame([(1.0, 1), (1.0, 0), (None, 1)], "total double, passengers int")
    rules = [F.col("total") >= 0, F.col("passengers").between(1, 8)]
    assert [r[0] for r in df.select(X.quality_score(rules)).collect()] == [100, 50, None]


def test_masked_amounts(spark):
    df = spark.createDataFrame([(14.9, 2.4), (15.0, 2.5), (95.0, -2.5)], "fare double, tip double")
    rows = df.select(X.nearest(F.col("fare"), 10), X.nearest(F.col("tip"), 5)).collect()
    assert [tuple(r) for r in rows] == [(10.0, 0.0), (20.0, 5.0), (100.0, -5.0)]


def test_three_durations(one_row):
    a, b = times.at("2024-01-01 00:00:59"), times.at("2024-01-01 00:02:58")
    assert str(value(one_row, times.fractional_minutes(a, b))) == "1.983333"
    assert value(one_row, times.minute_boundaries(a, b)) == 2
    assert value(one_row, times.whole_minutes(a, b)) == 1
    assert value(one_row, times.whole_minutes(b, a)) == -1


def test_durations_ignore_the_session_zone(spark, one_row):
    zone = spark.conf.get("spark.sql.session.timeZone")
    a, b = times.at("2024-03-10 01:30:00"), times.at("2024-03-10 03:30:00")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert value(one_row, times.elapsed_seconds(a, b)) == 7200
        assert value(one_row, times.minute_boundaries(a, b)) == 120
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize(
    ("text", "whole", "amount"),
    [("1", 1, 1.0), ("1.0", 1, 1.0), ("abc", 0, 0.0), ("", 0, 0.0), (None, 0, 0.0), ("-2", 0, -2.0), ("1.005", 0, 1.0), ("NaN", 0, 0.0)],
)
def test_numbers_from_text(spark, text, whole, amount):
    df = spark.createDataFrame([(text,)], "c string")
    assert value(df, safe_whole(F.col("c"), 0)) == whole
    assert value(df, safe_amount(F.col("c"))) == pytest.approx(amount, abs=0.0051)


def test_sums_do_not_depend_on_order(spark):
    values = [0.1, 0.2, 0.3, 1e7, -1e7, 12.34] * 50
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {df.repartition(n).agg(rounded_sum("v"), rounded_avg("v")).first() for n in (1, 3, 7)}
    assert len(got) == 1
    assert got.pop()[0] == 647.0


def test_rounding_halves_away_from_zero(spark):
    df = spark.createDataFrame([(5, 2), (-5, 2), (7, 3), (-7, 3)], "n long, d long")
    assert [r[0] for r in df.select(round_half_away(F.col("n"), F.col("d"))).collect()] == [3, -3, 2, -2]


def test_month_is_a_range(spark):
    df = spark.createDataFrame([(datetime(2024, 12, 31, 23, 59, 59),), (datetime(2025, 1, 1),)], "t timestamp_ntz")
    assert df.filter(within_month(F.col("t"), 2024, 12)).count() == 1


def test_rush_hours_differ_by_layer(spark):
    df = spark.range(24).select(F.col("id").cast("int").alias("h"))
    lake_hours = [r[0] for r in df.filter(X.in_windows(F.col("h"), X.LAKE_RUSH)).collect()]
    house = [r[0] for r in df.filter(X.in_windows(F.col("h"), X.WAREHOUSE_RUSH)).collect()]
    assert lake_hours == [7, 8, 9, 10, 16, 17, 18, 19] and house == [7, 8, 9, 17, 18, 19]


def test_calendar(spark):
    days = warehouse.dim_date(spark)
    assert days.count() == 4018
    assert str(days.agg(F.max("full_date")).first()[0]) == "2030-12-31"
    leap = days.filter("date_sk = 20240229").first()
    assert leap["day_of_week_name"] == "Thursday" and leap["quarter_name"] == "Q1"
    weekend = {r[0] for r in days.filter("is_weekend").select("day_of_week").distinct().collect()}
    assert weekend == {0, 6}
    assert days.filter("date_sk = 20270101").first()["week_of_year"] == 53


def test_hours(spark):
    rows = {r["hour_24"]: r for r in warehouse.dim_time(spark).collect()}
    assert len(rows) == 24 and rows[0]["hour_12"] == 12 and rows[13]["hour_12"] == 1
    assert rows[17]["time_period"] == "Evening Rush" and rows[17]["business_hour"]
    assert rows[9]["rush_hour_flag"] and not rows[10]["rush_hour_flag"]


def test_unknown_members_are_found_by_natural_key():
    assert (warehouse.VENDOR_UNKNOWN_SK, warehouse.RATECODE_UNKNOWN_SK, warehouse.PAYMENT_UNKNOWN_SK) == (5, 7, 5)


def test_gate(spark):
    schema = "vendorid int, ratecodeid int, pulocationid int, dolocationid int"
    vendors = spark.createDataFrame([(1, "one")], "vendor_id int, vendor_name string")
    rates = spark.createDataFrame([(1, "std")], "rate_code_id int, rate_code_desc string")
    zones = spark.createDataFrame([(5, "b", "z", "s")], "locationid int, borough string, zone string, service_zone string")

    def report(rows):
        return lake.gate_report(spark.createDataFrame(rows, schema), vendors, rates, zones)

    good = [(1, 1, 5, 5)] * 99
    assert report([*good, (2, 1, 5, 5)]).first()["resolved_ratio"] == 0.99
    lake.gate(report([*good, (2, 1, 5, 5)]))
    with pytest.raises(lake.GateFailure):
        lake.gate(report([*good, (2, 1, 5, 5), (1, 9, 5, 5)]))
    with pytest.raises(lake.GateFailure, match="no trips"):
        lake.gate(report([]))


def test_check_runner(spark):
    ids = spark.createDataFrame([(1,), (1,), (None,)], "id int")
    log = Q.run_checks(
        [
            Q.Check("s", "nulls", "unit", lambda: Q.null_key(ids, "id")),
            Q.Check("s", "count", "unit", lambda: Q.duplicate_key(ids, "id"), "2", "duplicate_count"),
            Q.Check("s", "broken", "unit", lambda: Q.null_key({}["gone"], "id")),
        ],
        AS_OF,
    )
    assert {r["test_name"]: r["test_status"] for r in log.collect()} == {"nulls": "FAIL", "count": "PASS", "broken": "ERROR"}
    assert Q.report_failures(log).count() == 2


def test_checks_on_one_table_share_a_scan_and_one_failure_spares_the_others(spark, tmp_path):
    rows = [(1, "2024-01-01", "Y"), (1, "2024-01-02", None), (None, "2024-01-03", "5")]
    spark.createDataFrame(rows, "id int, day string, flag string").write.parquet(f"{tmp_path}/rows")
    df = spark.read.parquet(f"{tmp_path}/rows")

    def on(name, measure, expected="PASS", column="status"):
        return Q.Check("s", name, "unit", None, expected, column, df, measure)

    plain = [
        on("nulls", Q.null_key_measure("id"), "1", "null_count"),
        on("no day", Q.null_key_measure("day")),
        on("whole", Q.complete_rows_measure(["id", "flag"])),
        on("no column", Q.null_key_measure("gone")),
    ]
    good, failed = Q._split(plain)
    plans = Q.compiled(good)
    assert [c.name for c, _ in failed] == ["no column"] and len(plans) == 1
    plan = plans[0][1]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and plan.count("Aggregate") == 1
    keyed = [on("twice", Q.duplicate_key_measure("id"), "2", "duplicate_count"), on("unique", Q.duplicate_key_measure("id"))]
    assert len(Q.compiled(plain[:3] + keyed)) == 2
    breaks = on("number", Q.Measure({"t": F.sum(F.col("flag").cast("int"))}, {"status": lambda c: Q.pass_if(c("t") > 0)}))
    log = {r["test_name"]: r for r in Q.completed_checks([*plain, breaks, *keyed], AS_OF).collect()}
    assert {k: r["test_status"] for k, r in log.items()} == {
        "nulls": "PASS", "no day": "PASS", "whole": "FAIL", "no column": "ERROR", "number": "ERROR", "twice": "PASS", "unique": "FAIL"
    }
    assert log["number"]["error_message"] and log["nulls"]["error_message"] is None and log["nulls"]["execution_time_ms"] >= 0
    assert Q.completed_checks([], AS_OF).count() == 0 and Q.run_checks([], AS_OF).count() == 0


def test_idempotence_sees_a_changed_row(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(2, "y"), (1, "x")], "k int, v string")
    c = spark.createDataFrame([(2, "y"), (1, "z")], "k int, v string")
    assert Q.same_content(a, b).first()["status"] == "PASS"
    assert Q.same_content(a, c).first()["status"] == "FAIL"


def test_duplicate_listing_in_blocks(spark):
    rows = [(i, "same" if i % 2 else f"n{i}", "ACTIVE") for i in range(50)]
    df = spark.createDataFrame(rows, "id int, name string, lifecycle_state string")
    out = Q.duplicate_listing(df, "name", "id", block=10).orderBy("id_block").collect()
    assert [r["duplicate_count"] for r in out] == [25] * 5
    assert ",".join(r["ids"] for r in out) == ",".join(str(i) for i in range(50) if i % 2)


@pytest.mark.parametrize(("score", "path"), [(95.0, "AUTO_APPROVE"), (94.99, "STEWARD_REVIEW"), (80.0, "STEWARD_REVIEW"), (79.99, "MANUAL_RESOLUTION")])
def test_routing_bands(one_row, score, path):
    assert value(one_row, N.route(F.lit(score))) == path
