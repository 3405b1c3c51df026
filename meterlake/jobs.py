"""The platform's jobs, path to path. Each stage writes its result and the next one reads it
back, so no stage is computed twice and a lost executor repeats only its own tasks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from meterlake.functions.casts import cast_if_present
from meterlake.functions.features import LAKE_RUSH
from meterlake.functions.times import at, days_before, hours_before
from meterlake.operators import quality
from meterlake.plans import lake, summaries
from meterlake.schemas import GOLDEN_COLUMNS
from meterlake.sinks import lake as sinks
from meterlake.sources import lake as tables
from meterlake.sources import landing, masters


def create_masters(spark: SparkSession, zone_csv: str, root: str) -> None:
    """Zone, vendor and rate-code masters."""
    zones = landing.zones_csv(spark, zone_csv)
    for name, df in masters.masters(spark, zones).items():
        sinks.write_table(df, f"{root}/{name}")


def load_masters(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(tables.master(spark, f"{root}/{name}") for name in ("vendor", "rate_code", "taxi_zone"))


def raw_to_validated(spark: SparkSession, source: str, target: str, **reader: str) -> None:
    """Landing CSV to the validated zone, by pickup day."""
    raw = landing.trips_csv(spark, source, **reader)
    silver = lake.featurise(lake.validate(raw))
    sinks.write_partitioned(silver, target, sort=["pulocationid", "dolocationid"])


def validated_to_curated(
    spark: SparkSession,
    source: str,
    master_root: str,
    target: str,
    as_of: str,
    threshold: float = 0.99,
    days: Callable[[DataFrame], DataFrame] = lambda trips: trips,
) -> None:
    """Validated trips to golden trips and hourly KPIs; stops when too few trips resolve.

    ``days`` may restrict a rerun to some partitions. The gate reads four columns; the
    golden trips are joined once, written, and the KPIs are computed from what was written.
    """
    vendors, rates, zones = load_masters(spark, master_root)
    trips = cast_if_present(days(tables.partitioned(spark, source)), lake.MASTER_KEYS, "int")
    lake.gate(lake.gate_report(trips, vendors, rates, zones, threshold=threshold))
    golden = lake.golden(lake.enrich(trips, vendors, rates, zones))
    sinks.write_partitioned(golden, f"{target}/trip_level", sort=["pulocationid", "dolocationid"])
    written = days(tables.partitioned(spark, f"{target}/trip_level"))
    sinks.write_partitioned(lake.kpis(written, zones, as_of, LAKE_RUSH), f"{target}/kpis")


def relational_layout(golden: DataFrame) -> DataFrame:
    """Golden trips under the names and types of the relational copy."""
    keys = {
        "pu_locationid": F.col("pulocationid"),
        "do_locationid": F.col("dolocationid"),
        "rate_code_id": F.col("ratecodeid"),
    }
    return sinks.apply_mapping(golden.withColumns(keys), [(n, n, kind) for n, kind in GOLDEN_COLUMNS])


def copy_golden(spark: SparkSession, source: str, target: str) -> None:
    sinks.write_table(relational_layout(tables.partitioned(spark, source)), target)


def refresh_vendor_summary(
    spark: SparkSession, trips: DataFrame, vendors: DataFrame, target: str, log: str, as_of: str, hours: int | None = None
) -> None:
    """Vendor-day summary partitions by date: the last year in full, which replaces the whole table, so expired days and days
    without trips go; or with ``hours`` just the days touched since then, which replaces only those. The row count for the
    log is observed by the write itself."""
    if hours is None:
        since = F.to_date(days_before(at(as_of), 365)).cast("timestamp_ntz")
        folders = tables.days_from(trips, since)
        recent, kind = folders.filter(F.col("tpep_pickup_datetime") >= since), "FULL"
    else:
        folders = tables.days_from(trips, hours_before(at(as_of), hours))
        recent, kind = summaries.whole_days_since(folders, as_of, hours), "INCREMENTAL"
    result = summaries.vendor_performance(recent, vendors, refresh_type=kind)
    _store_summary(result, target, log, f"vendor_performance_{kind.lower()}", as_of, replace_all=hours is None)


def refresh_route_patterns(spark: SparkSession, trips: DataFrame, target: str, log: str, as_of: str, keep_days: int = 90) -> None:
    """Route-day partitions by date within the horizon; the table is replaced, so expired days and days that lost their trips go."""
    since = F.to_date(days_before(at(as_of), keep_days)).cast("timestamp_ntz")
    result = summaries.route_patterns(tables.days_from(trips, since), as_of, keep_days)
    _store_summary(result, target, log, "zone_trip_patterns_full", as_of, replace_all=True)


def _store_summary(result: DataFrame, target: str, log: str, name: str, as_of: str, replace_all: bool) -> None:
    seen = Observation()
    stamped = result.withColumn("last_updated", at(as_of)).observe(seen, F.count(F.lit(1)).alias("rows_processed"))
    sinks.write_partitioned(stamped, target, ("metric_date",), replace_all=replace_all)
    row = result.sparkSession.range(1).select(
        F.lit(name).alias("transformation_name"),
        F.lit("1.0.0").alias("version"),
        at(as_of).alias("execution_start"),
        F.lit("SUCCESS").alias("status"),
        F.lit(seen.get["rows_processed"]).cast("long").alias("rows_processed"),
    )
    sinks.append(row, log)


def run_quality(checks: list[quality.Check], log: str, executed_at: str) -> None:
    """Run checks and append their results, failures included, to the log."""
    sinks.append(quality.completed_checks(checks, executed_at), log)
