"""Slowly changing dimensions: the scenarios a user of the platform walks through."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from meterlake.operators import scd
from meterlake.plans.warehouse import dim_vendor
from meterlake.schemas import OPEN_END

T1, T2, T3 = "2025-08-15 10:00:00", "2025-09-01 00:00:00", "2025-10-01 00:00:00"
STAGE = (
    "vendor_id int, vendor_name string, vendor_code string, vendor_status string, contact_email string,"
    " contact_phone string, updated_by string, change_reason string"
)
ATTRIBUTES = ["vendor_name", "vendor_code", "vendor_status", "contact_email", "contact_phone"]
TRACKED = ["vendor_id", "vendor_name", "vendor_code"]


def one(df, condition):
    rows = df.filter(condition).collect()
    assert len(rows) == 1, rows
    return rows[0]


def settled(df):
    """The table as the next step would read it back."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def merge(dim, staged, as_of):
    return scd.scd2(dim, staged, "vendor_id", ATTRIBUTES, TRACKED, as_of, "vendor_sk", previous="vendor_name")


@pytest.fixture
def seeded(spark):
    base = dim_vendor(spark).drop("vendor_sk")
    return settled(scd.scd2_init(base, "vendor_id", TRACKED, "vendor_sk"))


@pytest.fixture
def renamed(spark, seeded):
    staged = spark.createDataFrame(
        [(2, "Curb Mobility LLC - Updated", "CURB", "ACTIVE", "contact@curb.com", "555-1234", "admin", "Name correction")], STAGE
    )
    return settled(merge(seeded, staged, T1)), staged


def test_hash_merge_closes_and_opens(renamed, seeded):
    dim, _ = renamed
    old = one(dim, "vendor_id = 2 AND version_number = 1")
    new = one(dim, "vendor_id = 2 AND is_current")
    assert old["effective_end_date"] == new["effective_start_date"] == datetime(2025, 8, 15, 10)
    assert not old["is_current"] and old["updated_by"] == "SCD2_PROCESS"
    assert new["version_number"] == 2 and new["previous_vendor_name"] == "Curb Mobility, LLC"
    assert dim.count() == seeded.count() + 1
    assert dim.filter("vendor_id <> 2 AND is_current").count() == 4


def test_new_and_unchanged_keys(spark, seeded):
    staged = spark.createDataFrame(
        [
            (9, "Ninth", "N", "ACTIVE", None, None, "admin", "x"),
            (7, "Helix", "HELIX", "SUSPENDED", "new@helix.com", None, "admin", "x"),
        ],
        STAGE,
    )
    dim = settled(merge(seeded, staged, T1))
    assert one(dim, "vendor_id = 9")["version_number"] == 1
    assert one(dim, "vendor_id = 7")["vendor_status"] is None
    assert dim.agg(F.count_distinct("vendor_sk")).first()[0] == dim.count()


def test_merging_twice_changes_nothing(renamed):
    dim, staged = renamed
    again = merge(dim, staged, T2)
    assert sorted(map(repr, again.select(*dim.columns).collect())) == sorted(map(repr, dim.collect()))


def test_one_version_at_every_instant(renamed):
    dim, _ = renamed
    for moment in ("2000-01-01 00:00:00", "2025-08-15 09:59:59", T1, "2025-08-15 10:00:01", "2030-01-01 00:00:00"):
        assert scd.as_of(dim, moment).filter("vendor_id = 2").count() == 1
    assert scd.as_of(dim, T1).filter("vendor_id = 2").first()["version_number"] == 2


def test_intervals_are_disjoint_and_without_gaps(spark, renamed):
    dim, _ = renamed
    staged = spark.createDataFrame([(2, "Third name", "CURB", None, None, None, "a", "r")], STAGE)
    dim = settled(merge(dim, staged, T3))
    rows = dim.filter("vendor_id = 2").orderBy("version_number").collect()
    assert [r["version_number"] for r in rows] == [1, 2, 3]
    for a, b in zip(rows, rows[1:], strict=False):
        assert a["effective_end_date"] == b["effective_start_date"]
    assert str(rows[-1]["effective_end_date"]) == OPEN_END
    assert [r["is_current"] for r in rows] == [False, False, True]


def test_rollback(spark, renamed):
    dim, _ = renamed
    keys = spark.createDataFrame([(2,), (1,), (77,)], "vendor_id int")
    new, status = scd.rollback_version(
        dim, keys, "vendor_id", [*ATTRIBUTES, "row_hash"], T2, "admin", "Incorrect change", "vendor_sk", "vendor_name"
    )
    new = settled(new)
    outcome = {r["vendor_id"]: (r["success"], r["message"]) for r in status.collect()}
    assert outcome == {
        2: (True, "Rolled back to version 1"),
        1: (False, "Cannot rollback - this is the first version"),
        77: (False, "Cannot rollback - key not found"),
    }
    now = one(new, "vendor_id = 2 AND is_current")
    assert now["version_number"] == 3 and now["vendor_name"] == "Curb Mobility, LLC"
    assert now["change_reason"] == "ROLLBACK: Incorrect change"
    assert now["previous_vendor_name"] == "Curb Mobility LLC - Updated"
    assert scd.as_of(new, T2).filter("vendor_id = 2").count() == 1


def test_type_1_overwrites(spark):
    schema = "vendor_id long, source_vendor_id int, vendor_name string"
    table = spark.createDataFrame([], schema)

    def step(table, key, name):
        staged = spark.createDataFrame([(key, name)], "source_vendor_id int, vendor_name string")
        out = scd.scd1(table, staged, "source_vendor_id", ["vendor_name"], T1, "vendor_id")
        out = settled(out)
        return out.drop("operation", "updated_at"), one(out, F.col("source_vendor_id") == key)["operation"]

    table, first = step(table, 1, "Creative Mobile Technologies, LLC")
    table, second = step(table, 1, "Creative Mobile Technologies LLC")
    table, third = step(table, 60000, "New Platform Vendor")
    assert [first, second, third] == ["INSERT", "UPDATE", "INSERT"]
    assert {r["vendor_name"] for r in table.collect()} == {"Creative Mobile Technologies LLC", "New Platform Vendor"}
    assert {r["vendor_id"] for r in table.collect()} == {1, 2}


def test_type_3_keeps_the_previous_value(spark):
    table = spark.createDataFrame([], "vendor_id long, source_vendor_id int, vendor_name string")
    operations = []
    for name in ("Myle Tech Inc", "Myle Technologies Inc", "Myle Technologies Inc"):
        staged = spark.createDataFrame([(999, name)], "source_vendor_id int, vendor_name string")
        out = scd.scd3(table, staged, "source_vendor_id", ["vendor_name"], T1, "vendor_id")
        out = settled(out)
        operations.append(out.first()["operation"])
        table = out.drop("operation")
    row = table.first()
    assert operations == ["INSERT", "UPDATE", "NO_CHANGE"]
    assert row["previous_vendor_name"] == "Myle Tech Inc" and row["vendor_name_changed_date"] is not None
    days = scd.type3_changes(table, "source_vendor_id", "vendor_name", "2025-08-20 00:00:00").first()
    assert days["days_since_change"] == 5


def test_type_3_per_attribute(spark):
    columns = "source_vendor_id int, vendor_name string, contact_email string, service_area string"
    table = spark.createDataFrame([], f"vendor_id long, {columns}")
    steps = [
        (888, "Myle Tech Inc", "contact@myletech.com", "Manhattan"),
        (888, "Myle Tech Inc", "support@myletech.com", "Manhattan"),
        (888, "Myle Technologies Inc", "support@myletech.com", "New York Metro"),
    ]
    for staged, when in zip(steps, (T1, T2, T3), strict=True):
        batch = spark.createDataFrame([staged], columns)
        tracked = ["vendor_name", "contact_email", "service_area"]
        out = scd.scd3(table, batch, "source_vendor_id", tracked, when, "vendor_id")
        table = settled(out.drop("operation"))
    row = table.first()
    assert row["previous_contact_email"] == "contact@myletech.com"
    assert row["previous_vendor_name"] == "Myle Tech Inc"
    assert row["previous_service_area"] == "Manhattan"
    assert str(row["contact_email_changed_date"]) == T2
    assert str(row["vendor_name_changed_date"]) == str(row["service_area_changed_date"]) == T3


def test_hybrid_tracks_only_the_type_3_columns(spark):
    columns = "source_vendor_id int, vendor_status string, compliance_flag boolean, vendor_name string, contact_email string"
    table = spark.createDataFrame([(1, 55555, "ACTIVE", True, "Creative Mobile", "a@x.com")], f"vendor_id long, {columns}")
    policy = {"vendor_status": 1, "compliance_flag": 1, "vendor_name": 3, "contact_email": 3}
    batch = spark.createDataFrame([(55555, "SUSPENDED", False, "Creative Mobility", "b@x.com")], columns)
    row = scd.scd_policy(table, batch, "source_vendor_id", policy, T1, "vendor_id").first()
    assert (row["vendor_status"], row["compliance_flag"]) == ("SUSPENDED", False)
    assert (row["previous_vendor_name"], row["previous_contact_email"]) == ("Creative Mobile", "a@x.com")
    assert "previous_vendor_status" not in row.asDict()


CURRENT = (
    "vendor_id long, source_vendor_id int, vendor_name string, lifecycle_state string, match_confidence decimal(5,2),"
    " source_system string, created_at timestamp_ntz, created_by string, change_id long"
)
HISTORY = (
    "change_id long, vendor_id long, vendor_name string, lifecycle_state string, match_confidence decimal(5,2),"
    " source_system string, created_by string, change_type string, change_reason string, created_at timestamp_ntz"
)


def test_history_table_walk(spark):
    current, history, last, seen = spark.createDataFrame([], CURRENT), spark.createDataFrame([], HISTORY), 0, []
    for name in ("Creative Mobile Tech LLC", "Creative Mobile Technologies LLC", "Creative Mobile Technologies LLC"):
        staged = spark.createDataFrame(
            [(989, name, "feed", "etl_pipeline", 98.5)],
            "source_vendor_id int, vendor_name string, source_system string, created_by string, match_confidence double",
        ).withColumn("match_confidence", F.col("match_confidence").cast("decimal(5,2)"))
        current, history, ops = scd.scd4(
            current, history, staged, "source_vendor_id", "vendor_id", "vendor_name", T1, last
        )
        seen.append(ops.first()["operation"])
        current, history = settled(current.select(*CURRENT_COLUMNS)), settled(history)
        last = history.agg(F.max("change_id")).first()[0]
    assert seen == ["INSERT", "UPDATE", "NO_CHANGE"] and last == 2
    row = current.first()
    assert row["vendor_name"] == "Creative Mobile Technologies LLC" and row["lifecycle_state"] == "PROPOSED"
    reasons = [r["change_reason"] for r in history.orderBy("change_id").collect()]
    assert reasons == [
        "New record added",
        'Name changed from "Creative Mobile Tech LLC" to "Creative Mobile Technologies LLC"',
    ]
    back, message = scd.rollback_change(
        current, history, 2, "vendor_id", ["vendor_name", "lifecycle_state", "match_confidence"], T2, "steward"
    )
    assert back.first()["vendor_name"] == "Creative Mobile Tech LLC"
    assert message.first()["result"] == "Rolled back 1 records"
    _, nothing = scd.rollback_change(current, history, 12345, "vendor_id", ["vendor_name"], T2, "steward")
    assert nothing.first()["result"] == "No changes found for this change_id"


CURRENT_COLUMNS = [c.split()[0] for c in CURRENT.replace("decimal(5,2)", "decimal").split(", ")]


def test_last_submission_wins(spark):
    rows = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (1, "c", 2), (2, "d", 1)], "k int, name string, seq int")
    assert {r["k"]: r["name"] for r in scd.latest_staged(rows, "k", "seq").collect()} == {1: "b", 2: "d"}


def test_originals_are_kept(spark):
    table = spark.createDataFrame([(1, "a")], "k int, name string")
    staged = spark.createDataFrame([(1, "changed"), (2, "b")], "k int, name string")
    assert {r["k"]: r["name"] for r in scd.scd0(table, staged, "k").collect()} == {1: "a", 2: "b"}


def test_large_batches_give_the_same(spark, renamed, monkeypatch):
    """Merge and rollback with both sides shuffled."""
    dim, _ = renamed
    staged = spark.createDataFrame(
        [(2, "Third name", "CURB", None, None, None, "a", "r"), (9, "Ninth", "N", None, None, None, "a", "r")], STAGE
    )
    keys = spark.createDataFrame([(2,), (77,)], "vendor_id int")

    def both():
        merged = settled(merge(dim, staged, T3))
        back, status = scd.rollback_version(
            merged, keys, "vendor_id", [*ATTRIBUTES, "row_hash"], "2025-11-01 00:00:00", "admin", "x", "vendor_sk", "vendor_name"
        )
        return [sorted(map(repr, df.collect())) for df in (merged, back, status)]

    small = both()
    monkeypatch.setattr(scd, "fits_broadcast", lambda df: False)
    assert both() == small
