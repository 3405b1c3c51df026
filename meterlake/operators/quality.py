"""Data-quality checks.

Every check is a one-row DataFrame; a catalogue of them becomes one result table. Counts are
plain aggregates with partial results per task, and lookups count per key before they join.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.functions.exact import WIDE, cents, round_ratio, units_sum
from meterlake.functions.rules import blank, some
from meterlake.functions.times import at, days_before, whole_minutes
from meterlake.operators.distinct import key_blocks
from meterlake.operators.joins import lookup_join, unmatched



def _n(predicate: Column) -> Column:
    return F.count_if(F.coalesce(predicate, F.lit(False)))


def graded(count: Column, what: str, limit: int = 100) -> Column:
    """PASS at 0, WARNING up to the limit, FAIL beyond, with the count in the text."""
    text = F.concat(count.cast("string"), F.lit(f" {what}"))
    return (
        F.when(count > limit, F.concat(F.lit("FAIL: "), text))
        .when(count > 0, F.concat(F.lit("WARNING: "), text))
        .otherwise("PASS")
    )


def pass_if(ok: Column) -> Column:
    return F.when(ok, "PASS").otherwise("FAIL")


def recent(df: DataFrame, ts: str, as_of: str, days: int) -> DataFrame:
    return df.filter(F.col(ts) >= days_before(at(as_of), days))


Field = Callable[[str], Column]


@dataclass(frozen=True)
class Measure:
    """What a check counts on a table and what it makes of the counts.

    Measures on one table run as one aggregate, whatever their number: see :func:`compiled`. With a ``key``, the counts are taken
    over rows ``n, d`` whose sums are the rows and the distinct keys; measures on the same key share them.
    """

    counts: dict[str, Column]
    results: dict[str, Callable[[Field], Column]]
    key: str | None = None

    def rows(self, df: DataFrame) -> DataFrame:
        return df if self.key is None else key_blocks(df, self.key)

    def of(self, df: DataFrame) -> DataFrame:
        counted = self.rows(df).agg(*[c.alias(name) for name, c in self.counts.items()])
        return counted.withColumns({name: made(F.col) for name, made in self.results.items()})


def _passes(ok: Callable[[Field], Column]) -> dict[str, Callable[[Field], Column]]:
    return {"status": lambda c: pass_if(F.coalesce(ok(c), F.lit(False)))}


# --- before a load ------------------------------------------------------------------------


def fresh_summary(trips: DataFrame, ts: str = "tpep_pickup_datetime") -> DataFrame:
    return trips.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count(ts).alias("valid_datetime_count"),
        F.max(ts).alias("latest_valid_trip"),
    )


def datetime_check(trips: DataFrame, ts: str, limit: int = 100) -> DataFrame:
    missing = F.col("null_datetime")
    return trips.agg(
        F.count(F.lit(1)).alias("total_records"), _n(F.col(ts).isNull()).alias("null_datetime")
    ).withColumn(
        "status",
        F.when(missing > limit, "FAIL: Too many invalid datetime values")
        .when(missing > 0, "WARNING: Some invalid datetime values detected")
        .otherwise("PASS"),
    )


def critical_fields(trips: DataFrame, fields: list[str], critical: list[str]) -> DataFrame:
    """NULL count per field and whether any critical one is missing."""
    bad = some([F.col(c).isNull() for c in critical])
    n_bad = F.col("_bad")
    return (
        trips.agg(
            F.count(F.lit(1)).alias("total_records"),
            *[_n(F.col(c).isNull()).alias(f"null_{c}") for c in fields],
            _n(bad).alias("_bad"),
        )
        .withColumn(
            "status",
            F.when(
                n_bad > 0,
                F.concat(F.lit("FAIL: "), n_bad.cast("string"), F.lit(" records with NULL critical fields")),
            ).otherwise("PASS"),
        )
        .drop("_bad")
    )


def negative_amounts(trips: DataFrame, columns: list[str]) -> DataFrame:
    checks = {c: F.col(c).try_cast("double") < 0 for c in columns}
    return trips.agg(
        _n(some([F.coalesce(p, F.lit(False)) for p in checks.values()])).alias("total_violations"),
        *[_n(p).alias(f"negative_{c}") for c, p in checks.items()],
    ).withColumn("status", graded(F.col("total_violations"), "records with negative amounts"))


def temporal_order_measure(start: str, end: str) -> Measure:
    return Measure(
        {"invalid_time_records": _n(F.col(start) >= F.col(end))},
        {"status": lambda c: graded(c("invalid_time_records"), "trips with invalid time order")},
    )


def temporal_order(trips: DataFrame, start: str, end: str) -> DataFrame:
    return temporal_order_measure(start, end).of(trips)


def masters_active(masters: dict[str, DataFrame]) -> DataFrame:
    """Active records per entity; the first entity without any is named. One aggregate
    over the stacked states, no join of single values."""
    stacked = reduce(
        DataFrame.unionByName,
        [df.select(F.lit(name).alias("entity"), "lifecycle_state") for name, df in masters.items()],
    )
    counts = stacked.agg(
        *[
            _n((F.col("entity") == name) & (F.col("lifecycle_state") == "ACTIVE")).alias(f"active_{name}")
            for name in masters
        ]
    )
    status = F.lit("PASS")
    for name in reversed(masters):
        status = F.when(F.col(f"active_{name}") == 0, f"FAIL: No active {name}").otherwise(status)
    return counts.withColumn("status", status)


# --- on trips and summaries ----------------------------------------------------------------


def null_key_measure(key: str) -> Measure:
    return Measure({"null_count": _n(F.col(key).isNull())}, _passes(lambda c: c("null_count") == 0))


def null_key(df: DataFrame, key: str) -> DataFrame:
    return null_key_measure(key).of(df)


def date_range_measure(start: str, end: str, as_of: str) -> Measure:
    now = at(as_of)
    bad = some([F.coalesce(p, F.lit(False)) for p in (F.col(start) > F.col(end), F.col(start) > now, F.col(end) > now)])
    return Measure({"violation_count": _n(bad)}, _passes(lambda c: c("violation_count") == 0))


def date_range(trips: DataFrame, start: str, end: str, as_of: str) -> DataFrame:
    return date_range_measure(start, end, as_of).of(trips)


def duplicate_key_measure(key: str) -> Measure:
    """Rows beyond the first per key, NULL keys included. Whole-number keys that lie close together are counted as bitmaps, others by
    grouping, so a key that holds many rows shrinks before it is shuffled."""
    return Measure(
        {"duplicate_count": F.coalesce(F.sum("n") - F.sum("d"), F.lit(0))}, _passes(lambda c: c("duplicate_count") == 0), key
    )


def duplicate_key(df: DataFrame, key: str) -> DataFrame:
    return duplicate_key_measure(key).of(df)


def orphans(df: DataFrame, key: str, masters: DataFrame, master_key: str) -> DataFrame:
    """Rows whose key is set but not among the masters, counted per key before the join."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    missing = unmatched(per_key, masters, [(key, master_key)])
    return missing.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_count")).withColumn(
        "status", pass_if(F.col("orphan_count") == 0)
    )


def revenue_measure(parts: list[str], total: str, tolerance: float = 0.01) -> Measure:
    summed = reduce(lambda a, b: a + b, [F.coalesce(units_sum(p, 100), F.lit(0).cast(WIDE)) for p in parts])
    gap = F.abs(summed - units_sum(total, 100))
    return Measure({"variance": gap.cast("double") / F.lit(100.0)}, _passes(lambda c: c("variance") <= tolerance))


def revenue(trips: DataFrame, parts: list[str], total: str, tolerance: float = 0.01) -> DataFrame:
    """Sum of the components against the sum of the totals."""
    return revenue_measure(parts, total, tolerance).of(trips)


def duration_measure(start: str, end: str, longest: int = 1440) -> Measure:
    minutes = whole_minutes(F.col(start), F.col(end))
    return Measure({"invalid_count": _n((minutes < 0) | (minutes > longest))}, _passes(lambda c: c("invalid_count") == 0))


def duration(trips: DataFrame, start: str, end: str, longest: int = 1440) -> DataFrame:
    return duration_measure(start, end, longest).of(trips)


def complete_rows_measure(keys: list[str], needed: float = 99.9) -> Measure:
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    pct = F.try_divide(_n(whole) * 100.0, F.count(F.lit(1)).cast("double"))
    return Measure({"completeness_pct": pct}, _passes(lambda c: c("completeness_pct") >= needed))


def complete_rows(df: DataFrame, keys: list[str], needed: float = 99.9) -> DataFrame:
    return complete_rows_measure(keys, needed).of(df)


def score_threshold(summary: DataFrame, score: str, good: float = 95.0, fair: float = 90.0) -> DataFrame:
    lowest = F.col("min_score")
    return summary.agg(
        F.try_divide(F.sum(cents(score)).cast("double"), F.count(score) * F.lit(100.0)).alias("avg_score"),
        F.min(score).cast("double").alias("min_score"),
    ).withColumn("status", F.when(lowest >= good, "PASS").when(lowest >= fair, "WARNING").otherwise("FAIL"))


def same_content(first: DataFrame, second: DataFrame) -> DataFrame:
    """Whether two runs gave the same rows: counts and an order-free content hash."""

    def digest(df: DataFrame, run: str) -> DataFrame:
        row = F.xxhash64(*[F.col(c) for c in sorted(df.columns)])
        return df.agg(
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(row.cast("decimal(20,0)")), F.lit(0)).alias("hash"),
        ).withColumn("run", F.lit(run))

    runs = digest(first, "initial").unionByName(digest(second, "final"))
    return runs.agg(
        F.max(F.when(F.col("run") == "initial", F.col("rows"))).alias("initial_rows"),
        F.max(F.when(F.col("run") == "final", F.col("rows"))).alias("final_rows"),
        (F.min("hash") == F.max("hash")).alias("same_content"),
    ).withColumn(
        "status", pass_if((F.col("initial_rows") == F.col("final_rows")) & F.col("same_content"))
    )


# --- on masters ----------------------------------------------------------------------------


def duplicate_names(masters: DataFrame, name: str) -> DataFrame:
    """Groups of active records that share a name, letter case aside."""
    groups = (
        masters.filter(F.col("lifecycle_state") == "ACTIVE")
        .groupBy(F.lower(name).alias("normalized_name"))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
    )
    return groups.agg(F.count(F.lit(1)).alias("duplicate_groups")).withColumn(
        "status", pass_if(F.col("duplicate_groups") == 0)
    )


def unnamed(masters: DataFrame, name: str) -> DataFrame:
    active = masters.filter(F.col("lifecycle_state") == "ACTIVE")
    return active.agg(_n(blank(F.col(name))).alias("incomplete_records")).withColumn(
        "status", pass_if(F.col("incomplete_records") == 0)
    )


def duplicate_listing(masters: DataFrame, name: str, key: str, block: int = 1000) -> DataFrame:
    """Shared names with the ids that carry them.

    Ids are unique, so the ids of one name inside a block of ``block`` consecutive ids form
    a short list however often the name occurs; a name with ids in several blocks has
    several rows, in id order by ``id_block``.
    """
    active = masters.filter(F.col("lifecycle_state") == "ACTIVE")
    blocks = active.groupBy(name, F.call_function("div", F.col(key), F.lit(block)).alias("id_block")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.col(key).cast("bigint"))), lambda v: v.cast("string")), ","
        ).alias("ids"),
    )
    totals = (
        active.groupBy(F.col(name).alias("_name"))
        .agg(F.count(F.lit(1)).alias("duplicate_count"))
        .filter(F.col("duplicate_count") > 1)
    )
    return lookup_join(blocks, totals, [(name, "_name")], "inner").select(
        name, "duplicate_count", "id_block", "ids"
    )


def orphan_trips(trips: DataFrame, lookups: dict[str, tuple[str, DataFrame, str]]) -> DataFrame:
    """Orphaned trips per entity type: {entity: (trip column, masters, master key)}."""
    parts = [
        orphans(trips, column, masters, key).select(
            F.lit(entity).alias("entity_type"), F.col("orphan_count").alias("orphaned_count")
        )
        for entity, (column, masters, key) in lookups.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def audit_completeness(masters: dict[str, DataFrame]) -> DataFrame:
    """Active records without approver or change id, per entity."""
    parts = [
        df.filter(F.col("lifecycle_state") == "ACTIVE").select(
            F.lit(entity).alias("entity_type"), "approved_by", "change_id"
        )
        for entity, df in masters.items()
    ]
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("entity_type")
        .agg(
            F.count(F.lit(1)).alias("total_records"),
            _n(F.col("approved_by").isNull()).alias("missing_approver"),
            _n(F.col("change_id").isNull()).alias("missing_change_id"),
        )
    )


# --- generic metrics -------------------------------------------------------------------------


def completeness(df: DataFrame, column: str) -> DataFrame:
    """Share of non-NULL values in percent; 0 for an empty table."""
    pct = round_ratio(F.count(column) * 100, F.count(F.lit(1)), 2)
    return df.agg(F.coalesce(pct, F.lit(0.0)).alias("completeness_pct"))


def duplicate_rate(df: DataFrame, key: str) -> DataFrame:
    """Share of rows beyond the first per key in percent; NULL keys count as duplicates."""
    pct = round_ratio((F.sum("n") - F.sum("d")) * 100, F.sum("n"), 2)
    return key_blocks(df, key).agg(F.coalesce(pct, F.lit(0.0)).alias("duplicate_rate_pct"))


def freshness(df: DataFrame, ts: str, max_days: int, as_of: str) -> DataFrame:
    age = F.datediff(at(as_of), F.max(ts))
    return df.agg(F.when(age <= max_days, "FRESH").otherwise("STALE").alias("freshness_status"))


# --- running checks --------------------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    """A named check with the text it should give. ``build`` makes its one-row DataFrame; a check declared by ``table`` and ``measure`` instead
    shares one scan with all others on that table."""

    suite: str
    name: str
    category: str
    build: Callable[[], DataFrame] | None = None
    expected: str = "PASS"
    column: str = "status"
    table: DataFrame | None = None
    measure: Measure | None = None


def _told(check: Check, actual: Column) -> Column:
    return F.struct(
        F.lit(check.suite).alias("test_suite"),
        F.lit(check.name).alias("test_name"),
        F.lit(check.category).alias("test_category"),
        F.lit(check.expected).alias("expected_result"),
        actual.cast("string").alias("actual_result"),
    )


def _planned(check: Check) -> DataFrame | Exception:
    """The check by itself, or why it cannot be planned."""
    try:
        alone = check.build() if check.measure is None else check.measure.of(check.table)
        return alone.select(F.inline(F.array(_told(check, F.col(check.column)))))
    except Exception as failure:
        return failure


def compiled(checks: list[Check]) -> list[tuple[list[Check], DataFrame]]:
    """Plans for checks that can be planned: all measures on one table (and key) are one aggregate, which gives one row for each of
    them. Checks that build their own DataFrame stay apart."""
    groups: dict[tuple, list[Check]] = {}
    for k, check in enumerate(checks):
        shared = (id(check.table), check.measure.key) if check.measure is not None else (k,)
        groups.setdefault(shared, []).append(check)
    plans = []
    for some in groups.values():
        if some[0].measure is None or len(some) == 1:
            plans += [(list(some), _planned(some[0]))]
            continue
        counts = [F.struct(*[c.alias(n) for n, c in check.measure.counts.items()]).alias(f"_{k}") for k, check in enumerate(some)]
        row = some[0].measure.rows(some[0].table).agg(*counts)
        told = []
        for k, check in enumerate(some):
            own = f"_{k}"
            made = check.measure.results.get(check.column, lambda c, name=check.column: c(name))
            told.append(_told(check, made(lambda name, own=own: F.col(own).getField(name))))
        plans.append((list(some), row.select(F.inline(F.array(*told)))))
    return plans


def _logged(rows: DataFrame, executed_at: str, executed_by: str) -> DataFrame:
    status = F.when(F.col("error_message").isNotNull(), "ERROR").when(F.col("actual_result") == F.col("expected_result"), "PASS")
    return rows.select(
        "test_suite",
        "test_name",
        "test_category",
        status.otherwise("FAIL").alias("test_status"),
        "expected_result",
        "actual_result",
        "error_message",
        at(executed_at).alias("executed_at"),
        F.lit(executed_by).alias("executed_by"),
        *[c for c in rows.columns if c == "execution_time_ms"],
    )


def _errors(failed: list[tuple[Check, Exception]]) -> DataFrame:
    rows = [(c.suite, c.name, c.category, c.expected, None, str(e).splitlines()[0] if str(e) else type(e).__name__) for c, e in failed]
    kinds = "test_suite string, test_name string, test_category string, expected_result string, actual_result string, error_message string"
    return SparkSession.active().createDataFrame(rows, kinds)


def _split(checks: list[Check]) -> tuple[list[Check], list[tuple[Check, Exception]]]:
    """Checks that can be planned, and the others with the reason. Nothing runs."""
    planned = [(c, _planned(c)) for c in checks]
    return [c for c, p in planned if not isinstance(p, Exception)], [(c, p) for c, p in planned if isinstance(p, Exception)]


def run_checks(checks: list[Check], executed_at: str, executed_by: str = "test_framework") -> DataFrame:
    """One log row per check: PASS or FAIL against the expected text, ERROR when the check
    cannot be planned. The checks run together as one job."""
    good, failed = _split(checks)
    rows = _errors(failed)
    for _, plan in compiled(good):
        rows = rows.unionByName(plan.withColumn("error_message", F.lit(None).cast("string")))
    return _logged(rows, executed_at, executed_by)


def completed_checks(checks: list[Check], executed_at: str, executed_by: str = "test_framework") -> DataFrame:
    """The log rows of checks that have run, with ``execution_time_ms`` of the job that gave them. All run as one job. If that fails, the checks of each
    aggregate run by themselves, and where one fails it is halved until the failing check stands alone and becomes an ERROR row; the
    others keep their results. One row per check passes through the driver."""
    spark = SparkSession.active()
    good, failed = _split(checks)
    found: list[tuple] = []

    def collected(plans: list[DataFrame]) -> None:
        began = time.monotonic()
        rows = reduce(DataFrame.unionByName, plans).collect()
        took = int(1000 * (time.monotonic() - began))
        found.extend((*r, None, took) for r in rows)

    def halved(some: list[Check]) -> None:
        try:
            collected([plan for _, plan in compiled(some)])
        except Exception as failure:
            if len(some) == 1:
                failed.append((some[0], failure))
            else:
                halved(some[: len(some) // 2])
                halved(some[len(some) // 2 :])

    plans = compiled(good)
    try:
        if plans:
            collected([plan for _, plan in plans])
    except Exception:
        for some, _ in plans:
            halved(some)
    kinds = "test_suite string, test_name string, test_category string, expected_result string, actual_result string, error_message string"
    rows = spark.createDataFrame(found, f"{kinds}, execution_time_ms bigint").unionByName(
        _errors(failed).withColumn("execution_time_ms", F.lit(0).cast("bigint"))
    )
    return _logged(rows, executed_at, executed_by)


def report_by_suite(log: DataFrame) -> DataFrame:
    status = F.col("test_status")
    return (
        log.groupBy("test_suite")
        .agg(
            F.count(F.lit(1)).alias("total_tests"),
            _n(status == "PASS").alias("passed"),
            _n(status == "FAIL").alias("failed"),
            _n(status == "ERROR").alias("errors"),
        )
        .orderBy("test_suite")
    )


def report_overall(log: DataFrame) -> DataFrame:
    status = F.col("test_status")
    return log.agg(
        F.count(F.lit(1)).alias("total_tests"),
        _n(status == "PASS").alias("total_passed"),
        _n(status == "FAIL").alias("total_failed"),
        _n(status == "ERROR").alias("total_errors"),
        round_ratio(_n(status == "PASS") * 100, F.count(F.lit(1)), 2).alias("pass_rate"),
    )


def report_failures(log: DataFrame) -> DataFrame:
    return (
        log.filter(F.col("test_status").isin("FAIL", "ERROR"))
        .select("test_suite", "test_name", "test_status", "expected_result", "actual_result", "error_message")
        .orderBy("test_suite", "test_name")
    )


def report_by_day(log: DataFrame) -> DataFrame:
    status = F.col("test_status")
    return (
        log.groupBy(F.to_date("executed_at").alias("test_date"))
        .agg(
            F.count(F.lit(1)).alias("total_tests"),
            _n(status == "PASS").alias("passed"),
            _n(status == "FAIL").alias("failed"),
            round_ratio(_n(status == "PASS") * 100, F.count(F.lit(1)), 2).alias("pass_rate"),
        )
        .orderBy(F.desc("test_date"))
    )
