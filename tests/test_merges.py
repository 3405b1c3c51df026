"""Merges in a row over different keys, bitemporal corrections, and landing files that must lose nothing."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.functions.exact import cents, exact_sum, long_sum, rounded_sum, scaled, units_sum
from meterlake.operators import quality, scd
from meterlake.schemas import OPEN_END, TRIP_SCHEMA
from meterlake.sources import landing


def settled(df):
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def test_a_second_overwrite_keeps_the_stamps_of_other_rows(spark):
    table = spark.createDataFrame([(1, 1, "a"), (2, 2, "b")], "sk bigint, k int, name string")

    def merge(current, key, name, as_of):
        staged = spark.createDataFrame([(key, name)], "k int, name string")
        return settled(scd.scd1(current, staged, "k", ["name"], as_of, "sk").drop("operation"))

    twice = merge(merge(table, 1, "a2", "2025-01-01 00:00:00"), 2, "b2", "2025-02-01 00:00:00")
    assert {r["k"]: (r["name"], r["updated_at"]) for r in twice.collect()} == {1: ("a2", datetime(2025, 1, 1)), 2: ("b2", datetime(2025, 2, 1))}


def test_archiving_keeps_stamps_approvals_and_reasons(spark):
    kinds = "sk bigint, k int, name string, lifecycle_state string, match_confidence double, source_system string, created_by string, created_at timestamp_ntz, change_id bigint, approved_by string, approved_at timestamp_ntz"
    when = datetime(2024, 1, 1)
    current = spark.createDataFrame([(1, 1, "a", "ACTIVE", 90.0, "s", "c", when, 1, "boss", when), (2, 2, None, "ACTIVE", 90.0, "s", "c", when, 2, None, None)], kinds)
    history = current.filter("false").select("sk", "name", "change_id", "approved_by", "approved_at").withColumn("change_reason", F.lit(""))
    batch = "k int, created_by string, match_confidence double, source_system string, name string"
    now, log = current, history
    for key, name, as_of in ((1, "a2", "2025-01-01 00:00:00"), (2, "b2", "2025-02-01 00:00:00")):
        staged = spark.createDataFrame([(key, f"by{key}", 80.0, "s", name)], batch)
        now, log, _ = (settled(x) for x in scd.scd4(now, log, staged, "k", "sk", "name", as_of, 10 + key))
    stamps = {r["k"]: (r["updated_by"], r["updated_at"]) for r in now.collect()}
    assert stamps == {1: ("by1", datetime(2025, 1, 1)), 2: ("by2", datetime(2025, 2, 1))}
    rows = {r["sk"]: r for r in log.collect()}
    assert rows[1]["approved_by"] == "boss" and rows[1]["approved_at"] == when
    assert rows[2]["change_reason"] == 'Name changed from "" to "b2"'
    back, _ = scd.rollback_change(now, log, rows[2]["change_id"], "sk", ["name"], "2025-03-01 00:00:00", "x")
    assert {r["k"]: r["updated_by"] for r in back.collect()} == {1: "by1", 2: "ROLLBACK_x"}


def test_corrections_split_intervals_and_add_keys(spark):
    day = [datetime(2024, 1, 1 + i) for i in range(30)]
    end = datetime(9999, 12, 31, 23, 59, 59)
    kinds = "k int, name string, note string, valid_from timestamp_ntz, valid_to timestamp_ntz, transaction_from timestamp_ntz, transaction_to timestamp_ntz"
    table = spark.createDataFrame([(1, "old", "n1", day[0], day[20], day[0], end), (1, "late", "n2", day[20], end, day[0], end), (2, "two", "n3", day[0], end, day[0], end)], kinds)
    fixes = [(1, "mid", day[5], day[8]), (1, "open", day[12], None), (3, "new", day[2], None), (2, "two!", day[0], None)]
    corrections = spark.createDataFrame(fixes, "k int, name string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    out = scd.bitemporal_correct(table, corrections, "k", ["name"], "2025-01-01 00:00:00")
    assert str(end) == OPEN_END

    def believed(at):
        rows = out.filter(F.lit(at).cast("timestamp_ntz") >= F.col("transaction_from")).filter(F.lit(at).cast("timestamp_ntz") < F.col("transaction_to"))
        return sorted((r["k"], r["valid_from"], r["valid_to"], r["name"], r["note"]) for r in rows.collect())

    assert believed("2024-06-01 00:00:00") == [(1, day[0], day[20], "old", "n1"), (1, day[20], end, "late", "n2"), (2, day[0], end, "two", "n3")]
    now = believed("2025-06-01 00:00:00")
    assert [r[:4] for r in now] == [
        (1, day[0], day[5], "old"),
        (1, day[5], day[8], "mid"),
        (1, day[8], day[12], "old"),
        (1, day[12], day[20], "open"),
        (1, day[20], end, "late"),
        (2, day[0], end, "two!"),
        (3, day[2], end, "new"),
    ]
    assert [r[4] for r in now] == ["n1", "n1", "n1", "n1", "n2", "n3", None]


def test_bulk_load_counts_fields_and_reads_several_formats(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('id,at,note\n1,2024-01-02 03:04:05,"a,b"\n2,01/02/2024 03:04,x\n4,20240102,,lost\n5,20240102,,,lost\n6,never,x\n7,01/02/2024 11:04:05 PM\n')
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("at", T.TimestampNTZType()), T.StructField("note", T.StringType())])
    rows, rejected = landing.bulk_load(spark, str(path), schema)
    assert [tuple(r) for r in rows.orderBy("id").collect()] == [
        (1, datetime(2024, 1, 2, 3, 4, 5), "a,b"),
        (2, datetime(2024, 1, 2, 3, 4), "x"),
        (7, datetime(2024, 1, 2, 23, 4, 5), None),
    ]
    assert sorted(r["id"] for r in rejected.collect()) == ["4", "5", "6"]
    with pytest.raises(landing.TooManyBadRows):
        landing.bulk_load(spark, str(path), schema, most=2)


def test_a_file_with_other_columns_fails_loudly(spark, tmp_path):
    names = [f.name for f in TRIP_SCHEMA.fields]
    (tmp_path / "a.csv").write_text(",".join([names[1], names[0], *names[2:]]) + "\n" + "1," * (len(names) - 1) + "1\n")
    with pytest.raises(Exception, match="header"):
        landing.trips_csv(spark, str(tmp_path)).collect()


def test_halves_round_away_from_zero(spark):
    df = spark.createDataFrame([(-0.005,), (0.005,), (-1.5,), (None,)], "x double")
    assert [r[0] for r in df.select(cents("x")).collect()] == [-1, 1, -150, None]
    assert [r[0] for r in df.select(scaled("x", 1)).collect()] == [0, 0, -2, None]


def test_checks_that_cannot_be_planned_or_fail_while_running_become_errors(spark):
    def check(name, build):
        return quality.Check("s", name, "unit", build)

    def missing():
        return spark.range(1).select("nothing")

    def fails():
        return spark.range(1).selectExpr("cast(raise_error('broken') AS string) AS status")

    def fine():
        return spark.range(1).selectExpr("'PASS' AS status")

    rows = {r["test_name"]: r for r in quality.completed_checks([check("a", missing), check("b", fails), check("c", fine)], "2025-01-01 00:00:00").collect()}
    assert {k: r["test_status"] for k, r in rows.items()} == {"a": "ERROR", "b": "ERROR", "c": "PASS"}
    assert rows["a"]["error_message"] and rows["b"]["error_message"] and rows["c"]["error_message"] is None
    assert all(r["execution_time_ms"] >= 0 for r in rows.values())


def test_sums_have_room_for_corrupt_amounts(spark):
    """Two limbs: sums beyond BIGINT, halves away from zero, negatives, NULLs, and whole numbers near the limits."""
    rows = [(1, 1e15, 2**62), (1, 1e15, 2**62), (1, 0.01, 5), (2, -1e15, -(2**63)), (2, -1e15, -1), (2, -0.005, 1), (3, None, None), (4, 0.00005, -7), (4, -0.00005, 7), (5, 1e19, 3)]
    df = spark.createDataFrame(rows, "k int, amount double, n bigint")
    got = {r["k"]: r for r in df.groupBy("k").agg(units_sum("amount", 100).alias("u"), long_sum("n").alias("n"), exact_sum("amount").alias("s"), rounded_sum("amount").alias("r")).collect()}
    assert [got[k]["u"] for k in (1, 2, 3, 4)] == [2 * 10**17 + 1, -(2 * 10**17) - 1, None, 0]
    assert [got[k]["n"] for k in (1, 2, 3, 4)] == [2**63 + 5, -(2**63), None, 0]
    assert got[1]["s"] == 2e15 + 0.01 and got[4]["s"] == 0.0 and got[3]["s"] is None and got[5]["s"] == 1e19
    plain = spark.range(5000).selectExpr("(id * 7919 % 100003) / 100.0 - 300 AS x")
    one = plain.agg(F.sum(scaled("x")), units_sum("x")).first()
    assert int(one[1]) == one[0]
    trips = spark.createDataFrame([(1, 1e15), (1, 1e15), (2, 3.25)], "vendorid int, total_amount double")
    assert trips.agg(exact_sum("total_amount")).first()[0] == 2e15 + 3.25


def test_corrections_leave_other_keys_alone_and_must_not_overlap(spark, tmp_path):
    """Equal rows stay as many as they are, other keys and closed rows pass without a shuffle, overlapping corrections are refused."""
    day = [datetime(2024, 1, 1 + i) for i in range(30)]
    end = datetime(9999, 12, 31, 23, 59, 59)
    kinds = "k int, name string, valid_from timestamp_ntz, valid_to timestamp_ntz, transaction_from timestamp_ntz, transaction_to timestamp_ntz"
    twice = [(1, "a", day[0], end, day[0], end)] * 2 + [(2, "b", day[0], end, day[0], end)] * 3 + [(1, "older", day[0], end, day[0], day[1]), (None, "no key", day[0], end, day[0], end)]
    spark.createDataFrame(twice, kinds).write.parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    fix = "k int, name string, valid_from timestamp_ntz, valid_to timestamp_ntz"
    out = scd.bitemporal_correct(table, spark.createDataFrame([(1, "x", day[5], day[9])], fix), "k", ["name"], "2025-01-01 00:00:00")
    rows = [tuple(r)[:4] for r in out.collect()]
    assert sorted(r for r in rows if r[0] == 2) == [(2, "b", day[0], end)] * 3 and (None, "no key", day[0], end) in rows
    assert sorted(r for r in rows if r[0] == 1) == sorted([(1, "a", day[0], end)] * 2 + [(1, "a", day[0], day[5])] * 2 + [(1, "a", day[9], end)] * 2 + [(1, "older", day[0], end), (1, "x", day[5], day[9])])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Distinct" not in plan and "name#" in plan and "hashpartitioning(k" not in out._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="1 corrections overlap"):
        clash = spark.createDataFrame([(1, "x", day[5], day[9]), (1, "y", day[8], day[12]), (2, "z", day[5], day[9])], fix)
        scd.bitemporal_correct(table, clash, "k", ["name"], "2025-01-01 00:00:00")
