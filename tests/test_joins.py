"""Joins under skew and beyond the broadcast size, against brute force."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from meterlake.operators import joins
from meterlake.operators.keys import numbered, row_hash
from meterlake.operators.spatial import clipped_cells, locate

T0 = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def versioned(spark):
    """Key 1 holds most facts and most versions; there is a gap and an unknown key."""
    rng = random.Random(7)
    versions = []
    for key, n in ((1, 300), (2, 3), (3, 1)):
        cuts = sorted(rng.sample(range(0, 60 * 24 * 90), n))
        ends = [*cuts[1:], 60 * 24 * 200]
        for i, (a, b) in enumerate(zip(cuts, ends, strict=True)):
            if key == 2 and i == 1:
                continue
            versions.append((key, i, T0 + timedelta(minutes=a), T0 + timedelta(minutes=b)))
    facts = []
    for i in range(2000):
        key = 1 if rng.random() < 0.7 else rng.choice([2, 3, 4, None])
        at = None if i % 97 == 0 else T0 + timedelta(minutes=rng.randrange(-1000, 60 * 24 * 120))
        facts.append((i, key, at))
    facts.append((9999, 1, versions[5][2]))
    f = spark.createDataFrame(facts, "id int, k int, at timestamp_ntz")
    v = spark.createDataFrame(versions, "key int, version int, start timestamp_ntz, stop timestamp_ntz")
    expected = {}
    for i, key, at in facts:
        found = [n for k, n, a, b in versions if k == key and at is not None and a <= at < b]
        assert len(found) <= 1
        expected[i] = found[0] if found else None
    return f, v, expected


@pytest.mark.parametrize("small", [True, False])
def test_asof_matches_brute_force(versioned, small):
    facts, versions, expected = versioned
    joined = joins.asof_join(facts, versions, [("k", "key")], "at", "start", "stop", small, 86_400 * 5, 4)
    assert {r["id"]: r["version"] for r in joined.collect()} == expected
    assert joined.count() == facts.count()


def test_many_versions_per_key_are_not_paired(versioned):
    _, versions, _ = versioned
    assert not joins.few_versions(versions, ["key"])


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_plain(spark, how):
    facts = spark.range(3000).selectExpr("id", "if(id % 3 = 0, 7, id % 50) AS k")
    dim = spark.range(40).selectExpr("id AS d", "id * 10 AS v")
    plain = joins.lookup_join(facts, dim, [("k", "d")], how, small=True)
    salted = joins.lookup_join(facts, dim, [("k", "d")], how, small=False, salts=5)
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, salted.collect()))
    assert salted.columns == plain.columns


def test_hot_keys_are_found_and_only_they_are_copied(spark):
    facts = spark.range(9000).selectExpr("id", "if(id % 3 = 0, 7, if(id % 3 = 1, NULL, id)) AS k")
    dim = spark.range(9000).selectExpr("id AS d", "id * 10 AS v")
    hot = joins.hot_keys(facts, ["k"])
    assert len(hot) == 2
    copies = dim.withColumn("s", joins._copy_salts(dim, ["d"], hot, 5))
    assert copies.count() == 9000 + 4
    spread = facts.withColumn("s", joins._fact_salt(facts, ["k"], hot, 5))
    assert spread.filter("k = 7").select("s").distinct().count() == 5
    assert spread.filter("k <> 7").select("s").distinct().count() == 1


def test_keys_of_different_width_meet(spark):
    facts = spark.range(3000).selectExpr("id", "cast(if(id % 2 = 0, 7, id % 50) AS int) AS k")
    dim = spark.range(40).selectExpr("id AS d", "id * 10 AS v")
    joined = joins.lookup_join(facts, dim, [("k", "d")], "inner", small=False, salts=4)
    assert joined.count() == facts.filter("k < 40").count()
    texts = facts.selectExpr("id", "concat('0', k) AS k")
    assert joins.lookup_join(texts, dim, [("k", "d")], "inner", small=False).count() == joined.count()


def test_size_check(spark):
    assert joins.fits_broadcast(spark.range(10))
    long = spark.range(80_000).withColumn("text", F.lit("x"))
    assert not joins.fits_broadcast(long, rows=1000)
    wide = spark.range(500).withColumn("text", F.explode(F.array_repeat(F.repeat(F.lit("x"), 500), 2)))
    assert not joins.fits_broadcast(wide, max_bytes=100_000)
    assert joins.fits_broadcast(wide)
    product = spark.range(3000).join(spark.range(3000).withColumnRenamed("id", "b"), F.expr("id = b"))
    assert joins.plan_bytes(product) is None
    assert joins.fits_broadcast(product, max_bytes=1_000_000)


def test_null_keys_never_match(spark):
    facts = spark.createDataFrame([(1, None), (2, 5)], "id int, k int")
    dim = spark.createDataFrame([(None, "a"), (5, "b")], "d int, v string")
    rows = joins.lookup_join(facts, dim, [("k", "d")]).collect()
    assert {r["id"]: r["v"] for r in rows} == {1: None, 2: "b"}
    assert joins.unmatched(facts, dim, [("k", "d")]).count() == 0


def test_reconcile_reports_missing_days(spark):
    a = spark.createDataFrame([(1, 10, 5.0), (2, 10, 5.0), (3, 1, 1.0)], "day int, n int, r double")
    b = spark.createDataFrame([(1, 10, 5.005), (2, 11, 5.0), (4, 1, 1.0)], "day int, n int, r double")
    days = {r["day"] for r in joins.reconcile(a, b, "day", {"n": 0, "r": 0.01}).collect()}
    assert days == {2, 3, 4}


def test_numbering_in_buckets_equals_global_order(spark):
    df = spark.range(1000).selectExpr("id * id % 7919 + if(id < 600, 0, 1000000) * id AS k").distinct()
    ranked = numbered(df, "k", "n", start=11, rows_per_bucket=90)
    got = [(r["k"], r["n"]) for r in ranked.orderBy("k").collect()]
    assert got == [(k, i + 11) for i, (k, _) in enumerate(got)]


def test_hash_tells_null_from_empty(spark):
    df = spark.createDataFrame([(1, None), (1, "")], "a int, b string")
    assert df.select(row_hash(["a", "b"])).distinct().count() == 2


def _crosses(x, y, ring):
    hit = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
        if (y1 <= y) != (y2 <= y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
            hit = not hit
    return hit


@pytest.mark.parametrize("small", [True, False])
def test_point_in_polygon_matches_brute_force(spark, small):
    rings = {
        "concave": [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 1.5), (0.0, 4.0)],
        "diamond": [(7.0, 1.0), (9.0, 3.0), (7.0, 5.0), (5.0, 3.0)],
        "far": [(-3.0, -3.0), (-1.0, -3.0), (-1.0, -1.0)],
    }
    rng = random.Random(3)
    points = [(i, rng.uniform(-4, 10), rng.uniform(-4, 6)) for i in range(800)]
    points += [(i + 1000, 1.0, 1.0 + i / 1000) for i in range(400)]
    polygons = spark.createDataFrame(
        [(n, [{"x": x, "y": y} for x, y in r]) for n, r in rings.items()], "name string, ring array<struct<x double, y double>>"
    )
    df = spark.createDataFrame(points, "id int, x double, y double")
    got = {r["id"]: r["name"] for r in locate(df, polygons, 1.0, small).collect()}
    expected = {i: next((n for n, r in rings.items() if _crosses(x, y, r)), None) for i, x, y in points}
    assert got == expected


def test_shared_boundary_belongs_to_one_polygon(spark):
    squares = [(f"{i}{j}", [{"x": float(a), "y": float(b)} for a, b in ((i, j), (i + 1, j), (i + 1, j + 1), (i, j + 1))]) for i in range(2) for j in range(2)]
    polygons = spark.createDataFrame(squares, "name string, ring array<struct<x double, y double>>")
    points = spark.createDataFrame([(1, 1.0, 0.5), (2, 0.5, 1.0), (3, 1.0, 1.0)], "id int, x double, y double")
    rows = locate(points, polygons, 1.0).collect()
    assert {r["id"]: r["name"] for r in rows} == {1: "10", 2: "01", 3: "11"}
    assert len(rows) == 3


def test_many_buckets_and_text_keys_are_numbered(spark):
    df = spark.range(20_000).selectExpr("concat('k', lpad(cast(id * 7919 % 20011 AS string), 6, '0')) AS k", "id")
    got = [(r["k"], r["n"]) for r in numbered(df, "k", "n", rows_per_bucket=5).orderBy("k").collect()]
    assert got == [(k, i + 1) for i, (k, _) in enumerate(got)]


def test_measuring_never_moves_rows_to_one_task(spark):
    joined = spark.range(3000).join(spark.range(3000).withColumnRenamed("id", "b"), F.expr("id = b"))
    assert not joins.fits_broadcast(spark.range(10_000_000), max_bytes=1_000_000)
    assert joins.fits_broadcast(joined)


def test_hot_keys_are_spread_by_their_share(spark):
    facts = spark.range(16_000).selectExpr("id", "if(id % 2 = 0, 7, if(id % 4 = 1, 9, id)) AS k")
    hot = joins.hot_keys(facts, ["k"])
    assert len(hot) == 2 and max(hot.values()) > min(hot.values()) >= 2
    dim = spark.range(20).selectExpr("id AS d", "id * 10 AS v")
    plain = joins.lookup_join(facts, dim, [("k", "d")], small=True)
    spread = joins.lookup_join(facts, dim, [("k", "d")], small=False)
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, spread.collect()))


def test_four_hundred_hot_keys_are_all_found(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1000")
        assert len(joins.hot_keys(spark.range(40_000).selectExpr("id % 400 AS k"), ["k"])) == 400
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_overlaps_ties_and_gaps_give_the_same_rows_in_both_plans(spark):
    day = [T0 + timedelta(days=i) for i in range(40)]
    versions = [(1, 1, day[0], day[20]), (1, 2, day[5], day[9]), (1, 3, day[15], day[30]), (1, 4, day[15], day[25]), (2, 1, day[3], None), (3, 1, day[1], day[2])]
    dim = spark.createDataFrame(versions, "key int, version int, start timestamp_ntz, stop timestamp_ntz")
    facts = spark.createDataFrame([(i * 100 + k, k, day[i]) for i in range(40) for k in (1, 2, 3, 4)], "id int, k int, at timestamp_ntz")
    rows = {}
    for small in (True, False):
        joined = joins.asof_join(facts, dim, [("k", "key")], "at", "start", "stop", small, 86_400 * 3)
        rows[small] = {r["id"]: r["version"] for r in joined.collect()}
        assert joined.count() == facts.count()
    assert rows[True] == rows[False]
    at_one = [rows[True][i * 100 + 1] for i in range(40)]
    assert at_one == [1] * 5 + [2] * 4 + [None] * 6 + [3] * 15 + [None] * 10


def test_large_asof_reads_facts_once_and_keeps_versions_few(spark, tmp_path):
    """Few changes over a long time for most keys, many for one; open ends, facts outside all versions."""
    rng = random.Random(4)
    low, high = datetime(1900, 1, 1), datetime(9999, 12, 31, 23, 59, 59)
    versions = []
    for key in range(60):
        cuts = sorted(rng.sample(range(1000, 400_000), 900 if key == 7 else rng.randrange(0, 4)))
        starts = [low, *[T0 + timedelta(minutes=c) for c in cuts]]
        versions += [(key, i, a, b) for i, (a, b) in enumerate(zip(starts, [*starts[1:], high], strict=True))]
    rows = [(i, 7 if i % 3 else rng.choice([None, *range(64)]), T0 + timedelta(minutes=rng.randrange(-9000, 500_000))) for i in range(3000)]
    rows += [(9000, 5, None), (9001, None, None), (9002, 7, datetime(1850, 1, 1))]
    spark.createDataFrame(rows, "id int, k int, at timestamp_ntz").write.parquet(f"{tmp_path}/facts")
    facts = spark.read.parquet(f"{tmp_path}/facts")
    dim = spark.createDataFrame(versions, "key int, version int, start timestamp_ntz, stop timestamp_ntz")
    want = {i: next((n for key, n, a, b in versions if key == k and at is not None and a <= at < b), None) for i, k, at in rows}
    joined = joins.asof_join(facts, dim, [("k", "key")], "at", "start", "stop", False)
    assert {r["id"]: r["version"] for r in joined.collect()} == want and joined.count() == len(rows)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("at#") and "Window" not in plan and plan.count("Join ") == 1
    buckets = joins.TimeBuckets(dim, ["key"], "start", "stop", None)
    copies = dim.select(F.size(F.sequence(buckets.of(dim, ["key"], "start"), buckets.of(dim, ["key"], "stop"))).alias("n"))
    assert copies.agg(F.sum("n")).first()[0] < 6 * len(versions)
    many = spark.range(30_000).selectExpr("if(id < 27000, 1, id) AS key", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, id) AS start")
    many = joins.cut_versions(many.withColumn("stop", F.lit(high).cast("timestamp_ntz")), ["key"], "start", "stop")
    dense = joins.TimeBuckets(many, ["key"], "start", "stop", None)
    inside = many.withColumn("b", F.explode(F.sequence(dense.of(many, ["key"], "start"), dense.of(many, ["key"], "stop"))))
    assert len(dense.finer) == 1 and inside.groupBy("key", "b").count().agg(F.max("count")).first()[0] <= 2 * joins.BROADCAST_VERSIONS
    empty = joins.asof_join(facts, dim.limit(0), [("k", "key")], "at", "start", "stop", False)
    assert empty.count() == len(rows) and empty.filter("version IS NOT NULL").count() == 0


@pytest.mark.parametrize("small", [True, False])
def test_large_outlines_are_cut_up_by_cells(spark, small):
    """A jagged disc of 10,000 corners, the frame around it, and squares along the grid lines: every point in its one zone."""
    import math

    rng = random.Random(8)
    disc = [(20 + (9 + rng.random() * 0.4) * math.cos(a), 20 + (9 + rng.random() * 0.4) * math.sin(a)) for a in (2 * math.pi * k / 10_000 for k in range(10_000))]
    shapes = {
        "disc": disc,
        "south": [(0.0, 20.0), disc[5000], *disc[5001:], disc[0], (40.0, 20.0), (40.0, 0.0), (0.0, 0.0)],
        "square": [(50.0, 0.0), (52.0, 0.0), (52.0, 2.0), (50.0, 2.0)],
        "beside": [(52.0, 0.0), (54.0, 0.0), (54.0, 2.0), (52.0, 2.0)],
        "triangle": [(60.0, 0.0), (75.0, 0.0), (60.0, 15.0)],
    }

    def within(x, y, ring):
        odd = False
        for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]], strict=True):
            if (y1 <= y) != (y2 <= y) and x < x1 + (y - y1) * ((x2 - x1) / (y2 - y1)):
                odd = not odd
        return odd

    points = [(rng.uniform(-1, 41), rng.uniform(-1, 41)) for _ in range(250)] + [(rng.uniform(49, 76), rng.uniform(-1, 16)) for _ in range(150)]
    points += [(float(a), float(b)) for a in range(50, 55) for b in range(0, 3)] + [(51.5, 2.0), (52.0, 1.0), (52.0, 0.5), disc[17], disc[5000], (20.0, 20.0)]
    want = {k: next((n for n, ring in shapes.items() if within(x, y, ring)), None) for k, (x, y) in enumerate(points)}
    df = spark.createDataFrame([(k, x, y) for k, (x, y) in enumerate(points)], "id int, x double, y double")
    rings = spark.createDataFrame([(n, [{"x": x, "y": y} for x, y in ring]) for n, ring in shapes.items()], "name string, ring array<struct<x:double,y:double>>")
    located = locate(df, rings, 0.5, small)
    assert {r["id"]: r["name"] for r in located.collect()} == want and located.columns == ["id", "x", "y", "name"]
    if small:
        cells = clipped_cells(rings, 0.5).filter("name = 'disc'").selectExpr("size(_edges) AS n")
        inner, most, total = cells.agg(F.count_if(F.col("n") == 0), F.max("n"), F.count(F.lit(1))).first()
        assert inner > 800 and most < 1500 and total < 1500
