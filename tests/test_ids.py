"""Distinct counts as bitmaps and processed ids as ranges, against plain Python."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from meterlake.operators import distinct, ranges
from meterlake.operators import quality as Q


@pytest.mark.parametrize("bitmaps", [True, False, None])
def test_distinct_keys_are_exact(spark, bitmaps):
    rng = random.Random(1)
    keys = [0, -1, 1, 32767, 32768, 32769, -32768, -32769, 2**40, -(2**40), None]
    rows = [(rng.choice(["a", "b", None]), rng.choice(keys) if rng.random() < 0.5 else rng.randrange(-70_000, 70_000), str(rng.randrange(5))) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, k bigint, s string").repartition(5)
    got = {r["g"]: (r["n"], r["n_k"], r["n_s"] if "n_s" in r else None) for r in distinct.distinct_counts(df, ["k"], ["g"], bitmaps).collect()}
    want = {g: (sum(x == g for x, _, _ in rows), len({k for x, k, _ in rows if x == g and k is not None}), None) for g in ("a", "b", None)}
    assert got == want
    whole = distinct.key_blocks(df, "k", (), bitmaps).agg(F.sum("n"), F.sum("d")).first()
    assert tuple(whole) == (3000, len({k for _, k, _ in rows if k is not None}))
    assert Q.duplicate_key(df, "k").first()["duplicate_count"] == whole[0] - whole[1]


def test_bitmaps_only_where_keys_lie_together(spark):
    close = spark.range(400_000).selectExpr("id AS k")
    assert distinct.bitmaps_pay(close, "k")
    plan = distinct.key_blocks(close, "k").agg(F.sum("d"))._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and not any("_key" in line or "(id" in line for line in exchanges)
    apart = spark.range(20_000).selectExpr("xxhash64(id) AS k")
    assert not distinct.bitmaps_pay(apart, "k") and not distinct.bitmaps_pay(spark.range(5).selectExpr("string(id) AS k"), "k")
    assert Q.duplicate_key(apart.unionAll(apart), "k").first()["duplicate_count"] == 20_000
    empty = spark.createDataFrame([], "k bigint")
    assert Q.duplicate_key(empty, "k").first()["duplicate_count"] == 0 and Q.duplicate_rate(empty, "k").first()[0] == 0.0


def test_ranges_hold_exactly_the_ids(spark):
    rng = random.Random(6)
    runs = [[rng.randrange(-300, 900) for _ in range(n)] for n in (400, 50, 1, 300)] + [list(range(200, 600)), [5, 5, None]]
    tracker, seen = None, set()
    for run in runs:
        new = ranges.id_ranges(spark.createDataFrame([(i,) for i in run], "id bigint"), "id", bits=6)
        tracker = new if tracker is None else ranges.merge_ranges(tracker, new)
        tracker = spark.createDataFrame(tracker.collect(), "block bigint, first_id bigint, last_id bigint")
        seen |= {i for i in run if i is not None}
        rows = sorted(map(tuple, tracker.collect()))
        assert {i for _, a, b in rows for i in range(a, b + 1)} == seen
        assert all(a >> 6 == b >> 6 == block for block, a, b in rows)
        assert all(x[2] + 1 < y[1] for x, y in zip(rows, rows[1:], strict=False) if x[0] == y[0])
    df = spark.createDataFrame([(i,) for i in [*range(-400, 1000), None]], "id bigint")
    for small in (True, False):
        left = {r["id"] for r in ranges.outside(df, "id", tracker, bits=6, small=small).collect()}
        assert left == {i for i in [*range(-400, 1000), None] if i not in seen}
    assert ranges.id_ranges(df.limit(0), "id").count() == 0
    done = ranges.id_ranges(spark.range(3 << 20), "id")
    assert done.count() == 3
