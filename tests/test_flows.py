"""Governance, matching, summaries, files and the streaming refresh end to end."""

from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from meterlake import jobs
from meterlake import schemas as S
from meterlake.catalogue.lake import golden_trips
from meterlake.functions.names import confidence, deletion_variants, normalise
from meterlake.operators import matching, quality, rejects, tables
from meterlake.plans import governance as G
from meterlake.plans import lake as lake_plans
from meterlake.plans import summaries as M
from meterlake.sinks import lake as sinks
from meterlake.sources import governed, lake, landing
from meterlake.sources import testtables as T
from meterlake.streaming import refresh


def edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_variants_cover_every_close_pair(spark):
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("ab c") for _ in range(rng.randrange(1, 7))) for _ in range(120)})
    df = spark.createDataFrame([(w,) for w in words], "w string")
    found = {r["w"]: set(r["v"]) for r in df.select("w", deletion_variants(F.col("w"), 2).alias("v")).collect()}
    for a in words:
        for b in words:
            if edits(a, b) <= 2:
                assert found[a] & found[b], (a, b)


def test_matching_equals_comparing_all_pairs(spark):
    rng = random.Random(9)
    names = [f"{rng.choice(['north', 'south', 'east'])} {rng.choice(['cab', 'taxi', 'ride'])} {i % 30}" for i in range(60)]
    masters = spark.createDataFrame(list(enumerate(names)), "id int, name string")
    texts = [n.replace("o", "0", rng.randrange(2)) + rng.choice(["", " Inc", "x", "xyz"]) for n in names] + ["zzzzzz"] * 40
    proposals = spark.createDataFrame(list(enumerate(texts)), "p int, text string")
    got = {r["p"]: (r["golden_id"], r["match_confidence"]) for r in matching.match(proposals, masters, "text", "id", "name").collect()}

    def clean(text):
        words = "".join(c if c.isalnum() else " " for c in text.lower()).split()
        while words and words[-1] in SUFFIXES and len(words) > 1:
            words.pop()
        return " ".join(words)

    for p, text in enumerate(texts):
        best = (0, None)
        for i, n in enumerate(names):
            a, b = clean(text), clean(n)
            d, longest = edits(a, b), max(len(a), len(b))
            score = ((longest - d) * 20000 + longest) // (2 * longest)
            if score >= 8000 and score > best[0]:
                best = (score, i)
        assert got[p] == (best[1], best[0] / 100), text


SUFFIXES = {"llc", "inc", "corp", "corporation", "ltd", "co"}


def test_names_and_confidence(spark):
    df = spark.createDataFrame([("Creative Mobile Technologies, LLC", "creative mobile technologies")], "a string, b string")
    row = df.select(normalise(F.col("a")), confidence(normalise(F.col("a")), F.col("b"))).first()
    assert tuple(row) == ("creative mobile technologies", 100.0)


def test_equal_names_form_a_star(spark):
    masters = spark.createDataFrame([(i, "Same Name") for i in range(40)] + [(99, "Same Nome")], "id int, name string")
    queue = matching.dedup_queue(masters, "id", "name").collect()
    assert len(queue) == 40
    assert {r["id_1"] for r in queue} == {0}
    assert {r["id_2"]: r["match_score"] for r in queue}[99] < 100


def test_steward_approval_by_id(spark):
    vendors = governed.vendor_masters(spark, proposed=(2, 6))
    done = G.approve(vendors, spark.createDataFrame([(6,)], "source_vendor_id int"), "source_vendor_id", "steward_test", "2024-01-31 00:00:00")
    states = {r["source_vendor_id"]: (r["lifecycle_state"], r["approved_by"]) for r in done.collect()}
    assert states == {1: ("ACTIVE", "admin"), 2: ("PROPOSED", None), 6: ("ACTIVE", "steward_test"), 7: ("ACTIVE", "admin")}
    all_done = G.approve_batch(vendors, "source_vendor_id", 100, "data_steward", "2024-01-31 00:00:00")
    assert all_done.filter("lifecycle_state = 'ACTIVE'").count() == 4
    one = G.approve_batch(vendors, "source_vendor_id", 1, "data_steward", "2024-01-31 00:00:00")
    assert one.filter("lifecycle_state = 'PROPOSED'").first()["source_vendor_id"] == 6


def test_summary_totals_equal_trip_totals(spark, sf_dir):
    trips = T.trips(spark, sf_dir).filter("vendorid IS NOT NULL")
    summary = M.vendor_performance(trips, governed.vendor_masters(spark))
    a = summary.agg(F.sum("total_trips"), F.round(F.sum("total_revenue"), 2)).first()
    b = trips.agg(F.count("*"), F.round(F.sum("total_amount"), 2)).first()
    assert tuple(a) == tuple(b)


def test_peak_hour_tie_takes_the_earlier(spark):
    rows = [(1, 2, datetime(2024, 1, 30, h), datetime(2024, 1, 30, h, 10), 5.0, 1.0) for h in (17, 8, 17, 8, 12)]
    trips = spark.createDataFrame(
        rows,
        "pulocationid int, dolocationid int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz,"
        " fare_amount double, trip_distance double",
    )
    row = M.route_patterns(trips, "2024-01-31 00:00:00").first()
    assert (row["peak_hour"], row["trip_count"], row["avg_duration"]) == (8, 5, 10.0)


def test_partial_day_refresh_equals_full(spark, sf_dir):
    trips, vendors = T.trips(spark, sf_dir), governed.vendor_masters(spark)
    old = M.vendor_performance(trips.filter("tpep_pickup_datetime < timestamp_ntz'2024-01-29 10:00:00'"), vendors)
    new = M.refresh_vendors_incremental(old, trips, vendors, "2024-01-30 09:00:00").drop("refresh_type")
    full = M.vendor_performance(trips, vendors).drop("refresh_type")
    assert new.exceptAll(full).count() == 0 and full.exceptAll(new).count() == 0


def test_clear_update_retain(spark):
    table = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    assert tables.cleared(table).count() == 0
    out = tables.update(table, F.col("v") == "a", {"v": F.lit("b")})
    assert {r["k"]: r["v"] for r in out.collect()} == {1: "b", 2: None}


def test_rerun_replaces_only_its_days(spark, tmp_path):
    path = str(tmp_path / "t")
    days = spark.createDataFrame([(1, "a"), (2, "b")], "day int, v string")
    sinks.write_partitioned(days, path, ["day"])
    sinks.write_partitioned(spark.createDataFrame([(2, "c")], "day int, v string"), path, ["day"])
    assert {(r["day"], r["v"]) for r in spark.read.parquet(path).collect()} == {(1, "a"), (2, "c")}
    assert "PartitionFilters: [isnotnull(day" in lake.partitioned(spark, path).filter("day = 2")._jdf.queryExecution().toString()


def test_bulk_load_and_its_budget(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("id,name,amount\n1, a ,2.5\nx,b,1\n3,,\n4,   ,7\n5,e,1,2\n6,f\n")
    schema = S.T.StructType(
        [
            S.T.StructField("id", S.T.IntegerType()),
            S.T.StructField("name", S.T.StringType()),
            S.T.StructField("amount", S.T.DoubleType()),
        ]
    )
    rows, rejected = landing.bulk_load(spark, str(path), schema)
    assert [tuple(r) for r in rows.orderBy("id").collect()] == [(1, "a", 2.5), (3, None, None), (4, None, 7.0), (6, "f", None)]
    assert rows.select("name").count() == rows.count() == 4
    assert {r["id"] for r in rejected.collect()} == {"x", "5"}
    assert landing.within_budget(rejected, 2) == 2
    with pytest.raises(landing.TooManyBadRows):
        landing.within_budget(rejected, 1)


def test_lines_of_arity(spark, tmp_path):
    (tmp_path / "raw.csv").write_text("a,b,c\n\n1,2\n1,2,3,4\n1,,3\n")
    lines = spark.read.text(str(tmp_path / "raw.csv"))
    assert [r[0] for r in landing.lines_of_arity(lines, 3).collect()] == ["a,b,c", "1,,3"]


def test_landing_tree_without_the_zone_file(spark, tmp_path):
    (tmp_path / "2024").mkdir()
    header = ",".join(f.name for f in S.TRIP_SCHEMA.fields)
    (tmp_path / "2024" / "yellow_tripdata.csv").write_text(f"{header}\n1,2024-01-01 00:00:00,2024-01-01 00:10:00,1,2.5,1,N,4,5,1" + ",1" * 10 + "\n")
    (tmp_path / "taxi_zone_lookup.csv").write_text("LocationID,Borough,Zone,service_zone\n1,EWR,Newark,EWR\n")
    trips = landing.trips_csv(spark, str(tmp_path), glob="*tripdata*.csv")
    assert trips.count() == 1 and trips.first()["tpep_dropoff_datetime"] == datetime(2024, 1, 1, 0, 10)
    assert landing.trips_csv(spark, str(tmp_path), exclude="zone_lookup").count() == 1
    assert "trip_distance" in landing.trips_csv(spark, str(tmp_path), schema=None, glob="*tripdata*.csv").columns
    assert landing.zones_csv(spark, str(tmp_path / "taxi_zone_lookup.csv")).first()["zone"] == "Newark"


def test_mapped_copy_has_all_columns(spark, sf_dir):
    copy = jobs.relational_layout(golden_trips(spark, sf_dir))
    assert len(copy.columns) == 44
    assert dict(copy.dtypes)["is_long_trip"] == "tinyint"
    narrow = spark.createDataFrame([(300,), (5,)], "n int")
    assert [r[0] for r in sinks.apply_mapping(narrow, [("n", "m", "tinyint")]).collect()] == [None, 5]


def test_export_splits_files(spark, tmp_path):
    sinks.export_csv(spark.range(1, 101, 1, 1).withColumnRenamed("id", "k"), str(tmp_path / "x"), rows_per_file=30)
    assert len(list((tmp_path / "x").glob("*.csv.gz"))) == 4


def test_bad_coordinates(spark):
    df = spark.createDataFrame(
        [(-73.9, 40.7, -73.8, 40.8), (0.0, 0.0, -73.8, 40.8), (None, 40.7, -73.8, 40.8)],
        "pickup_longitude double, pickup_latitude double, dropoff_longitude double, dropoff_latitude double",
    )
    rules = rejects.coordinate_rules((-74.3, 40.4, -73.6, 41.0))
    assert rejects.good_rows(df, rules).count() == 1
    assert rejects.reject_counts(df, rules).first()["invalid_coordinates"] == 2


def test_streaming_refresh_equals_batch(spark, sf_dir, tmp_path):
    """Trips arrive in three files, days split across them; the result equals one batch."""
    trips, vendors = T.trips(spark, sf_dir).drop("cab_type_id"), governed.vendor_masters(spark)
    landed, store, summary, mark = (str(tmp_path / n) for n in ("in", "store", "summary", "mark"))

    def run():
        stream = refresh.trip_stream(spark, landed, trips.schema, files_per_batch=1)
        refresh.start_vendor_refresh(stream, store, summary, vendors, mark, available_now=True).awaitTermination()

    trips.filter("trip_id % 3 = 0").coalesce(1).write.parquet(f"{landed}/a")
    trips.filter("trip_id % 3 = 1").coalesce(1).write.parquet(f"{landed}/b")
    run()
    trips.filter("trip_id % 3 = 2").coalesce(1).write.parquet(f"{landed}/c")
    run()
    got = spark.read.parquet(summary).select("vendor_id", "metric_date", "total_trips", "total_revenue")
    full = M.vendor_performance(trips, vendors).select(*got.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, full.collect()))


def test_lake_jobs_from_landing_to_kpis(spark, sf_dir, tmp_path):
    """CSV files in, partitioned zones out; equal to the same flow in memory."""
    landed, silver, root, gold = (str(tmp_path / n) for n in ("landing", "validated", "master", "curated"))
    trips = T.trips(spark, sf_dir).select(*[f.name for f in S.TRIP_SCHEMA.fields])
    options = {"header": True, "timestampNTZFormat": landing.TIME_FORMAT}
    trips.write.options(**options).csv(f"{landed}/2024")
    T.zones(spark, sf_dir).write.options(**options).csv(f"{landed}/zone_lookup")

    jobs.create_masters(spark, f"{landed}/zone_lookup", root)
    jobs.raw_to_validated(spark, landed, silver, exclude="/zone_lookup/")
    jobs.validated_to_curated(spark, silver, root, gold, "2024-01-31 00:00:00")
    jobs.copy_golden(spark, f"{gold}/trip_level", str(tmp_path / "copy"))

    kpis = spark.read.parquet(f"{gold}/kpis")
    golden = golden_trips(spark, sf_dir)
    expected = lake_plans.kpis(golden, T.zones(spark, sf_dir), "2024-01-31 00:00:00")
    columns = ["pickup_day", "pickup_hour", "pulocationid", "dolocationid", "total_rides", "total_revenue", "pu_zone"]
    assert sorted(map(tuple, kpis.select(*columns).collect())) == sorted(map(tuple, expected.select(*columns).collect()))
    assert spark.read.parquet(str(tmp_path / "copy")).count() == golden.count()

    stored = spark.read.parquet(f"{gold}/trip_level")
    late = lake.days_from(stored, F.lit("2024-01-29 08:00:00").cast("timestamp_ntz"))
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "pickup_day" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {r[0] for r in late.select("pickup_day").distinct().collect()} == {29, 30}

    n_kpis = kpis.count()
    with pytest.raises(lake_plans.GateFailure):
        jobs.validated_to_curated(spark, silver, root, gold, "2024-01-31 00:00:00", threshold=1.0)
    one_day = lambda t: t.filter("pickup_day = 3")
    jobs.validated_to_curated(spark, silver, root, gold, "2024-02-01 00:00:00", 0.9, one_day)
    again = spark.read.parquet(f"{gold}/kpis")
    assert again.count() == n_kpis
    assert [r[0] for r in again.filter("aggregated_at > timestamp_ntz'2024-01-31 12:00:00'").select("pickup_day").distinct().collect()] == [3]


def test_summary_job_and_logs(spark, sf_dir, tmp_path):
    target, log, checks = (str(tmp_path / n) for n in ("summary", "log", "checks"))
    trips, vendors = T.trips(spark, sf_dir), governed.vendor_masters(spark)
    jobs.refresh_vendor_summary(spark, trips, vendors, target, log, "2024-01-29 12:00:00")
    jobs.refresh_vendor_summary(spark, trips, vendors, target, log, "2024-01-30 12:00:00", hours=24)
    full = M.vendor_performance(trips, vendors)
    stored = spark.read.parquet(target)
    assert stored.count() == full.count()
    assert stored.filter("refresh_type = 'INCREMENTAL'").agg(F.min("metric_date")).first()[0].day == 29
    logged = {r["transformation_name"]: r["rows_processed"] for r in spark.read.parquet(log).collect()}
    assert logged["vendor_performance_full"] == full.count()
    assert 0 < logged["vendor_performance_incremental"] < full.count()
    check = quality.Check("source", "ids", "unit", lambda: quality.null_key(trips, "trip_id"))
    jobs.run_quality([check], checks, "2024-01-30 00:00:00")
    jobs.run_quality([check], checks, "2024-01-31 00:00:00")
    assert [r["pass_rate"] for r in quality.report_by_day(spark.read.parquet(checks)).collect()] == [100.0, 100.0]


def test_weather_and_catalog_sources(spark, tmp_path):
    (tmp_path / "w.csv").write_text(
        "date,precipitation,snow_depth,snowfall,max_temperature,min_temperature,average_wind_speed\n2024-01-01,0.3,0,0,40,30,5.5\n"
    )
    row = lake.weather(spark, str(tmp_path / "w.csv")).first()
    assert str(row["date"]) == "2024-01-01" and row["max_temperature"] == 40
    zones = sinks.apply_mapping(
        spark.createDataFrame([(1, "Newark"), (2**40, "far")], "locationid long, zone string"),
        [("locationid", "source_zone_id", "int"), ("zone", "zone_name", "string")],
    )
    sinks.save_table(zones, "zone_copy", str(tmp_path / "zones"))
    sinks.save_table(zones, "zone_copy", str(tmp_path / "zones"), mode="append")
    stored = lake.catalog_table(spark, "zone_copy")
    assert stored.columns == ["source_zone_id", "zone_name"] and stored.count() == 4
    assert stored.filter("source_zone_id IS NULL").count() == 2
    spark.sql("DROP TABLE zone_copy")


def test_staged_load_reads_once_and_publishes_within_its_budget(spark, tmp_path):
    schema = T.StructType.fromDDL("id int, day date, note string")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_bytes(
        b"id,day,note\n1,2024-01-05,plain\n2,01/06/2024,caf\xe9\nx,2024-01-07,bad id\n3,20240108,\n4,2024-01-09,\"a, b\"\n5,2024-01-10,c,\"d, e\"\n6\n"
    )
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    record = landing.staged_load(spark, source, schema, target, most=2)
    assert (record["n_rows"], record["n_rejected"]) == (7, 2)
    rows = {r["id"]: (str(r["day"]), r["note"]) for r in landing.loaded(spark, target, schema).collect()}
    assert rows == {1: ("2024-01-05", "plain"), 2: ("2024-01-06", "caf?"), 3: ("2024-01-08", None), 4: ("2024-01-09", "a, b"), 6: ("None", None)}
    aside = landing.loaded(spark, target, schema, rejected=True).collect()
    assert {r["id"] for r in aside} == {"x", "5"}
    with pytest.raises(landing.TooManyBadRows, match="2 rows"):
        landing.staged_load(spark, source, schema, target, most=1)
    assert landing.loaded(spark, target, schema).count() == 5
    landing.staged_load(spark, source, schema, target, most=0, share=0.5)
    assert landing.loaded(spark, target, schema).count() == 10


def test_headers_are_bound_by_name(spark, tmp_path):
    (tmp_path / "z.csv").write_text('Zone,"LocationID",Borough,Other\nNewark,1,EWR,x\n"",2, Queens ,y\nQ,bad,B,z\n')
    got = landing.zones_csv(spark, str(tmp_path / "z.csv")).collect()
    assert [tuple(r) for r in got] == [(1, "EWR", "Newark", None), (2, "Queens", None, None), (None, "B", "Q", None)]


def test_stream_state_stays_small_and_counts_nothing_twice(spark, sf_dir, tmp_path):
    """Batches with late trips, a repeated batch, trips without a time, merges in between: equal to one batch over all."""
    trips, vendors = T.trips(spark, sf_dir).drop("cab_type_id"), governed.vendor_masters(spark)
    store, summary = str(tmp_path / "store"), str(tmp_path / "summary")
    parts = [trips.filter(f"trip_id % 7 = {k}") for k in range(7)]
    parts[2] = parts[2].unionByName(parts[2].limit(3).withColumn("tpep_pickup_datetime", F.lit(None).cast("timestamp_ntz")))

    def handle(batch, batch_id, merge):
        refresh.store_batch(batch, batch_id, store, keep=2)
        refresh.refresh_days(spark, batch_id, store, vendors, summary)
        if merge:
            refresh.merge_days(spark, store, batch_id, keep=2)

    for k, part in enumerate(parts):
        handle(part, k, k % 2 == 1)
        if k in (2, 3):
            handle(part, k, k == 3)
    got = spark.read.parquet(summary).drop("refresh_type", "refresh_time")
    full = M.vendor_performance(trips, vendors).select(*got.columns)
    assert got.exceptAll(full).count() == 0 and full.exceptAll(got).count() == 0
    assert refresh.undated(spark, store) == 3
    assert len(list((tmp_path / "store" / "deltas").glob("slot=*"))) <= 4
    for day in (tmp_path / "store" / "days").glob("metric_date=*"):
        assert len(list(day.glob("*.parquet"))) == 1
