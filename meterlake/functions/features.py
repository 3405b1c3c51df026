"""Trip-level derived columns. Lake and warehouse define some of them differently,
so thresholds and hour windows are parameters with one default per layer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterlake.functions.exact import cents, round_half_away

LAKE_RUSH = ((7, 10), (16, 19))
WAREHOUSE_RUSH = ((7, 9), (17, 19))


def tip_percent(tip: Column, fare: Column) -> Column:
    """Tip as a percentage of the fare, unrounded; 0 unless the fare is positive."""
    return F.when(fare > 0, cents(tip) * F.lit(100.0) / cents(fare)).otherwise(F.lit(0.0))


def tip_hundredths(tip: Column, fare: Column) -> Column:
    """The same as whole hundredths of a percent, for amounts in whole cents."""
    return F.when(fare > 0, round_half_away(tip * 10000, fare)).otherwise(F.lit(0).cast("bigint"))


def tip_percent_2dp(tip: Column, fare: Column) -> Column:
    """The same rounded to hundredths, exactly."""
    return tip_hundredths(cents(tip), cents(fare)) / F.lit(100.0)


def tip_share_above(tip: Column, fare: Column, percent: int) -> Column:
    """Whether the tip exceeds a percentage of a positive fare, decided in whole cents."""
    return F.coalesce((fare > 0) & (cents(tip) * 100 > cents(fare) * percent), F.lit(False))


def flag(predicate: Column) -> Column:
    """1 when true, 0 when false or unknown."""
    return F.when(predicate, F.lit(1)).otherwise(F.lit(0))


def is_true(predicate: Column) -> Column:
    return F.coalesce(predicate, F.lit(False))


def in_windows(hour: Column, windows: tuple[tuple[int, int], ...]) -> Column:
    """Whether an hour falls into any of the closed windows."""
    hit = F.lit(False)
    for first, last in windows:
        hit = hit | hour.between(first, last)
    return hit


def quality_score(rules: list[Column]) -> Column:
    """Share of satisfied rules in whole percent; NULL as soon as one rule is unknown."""
    passed = F.lit(0)
    for rule in rules:
        passed = passed + rule.cast("int")
    return F.call_function("div", passed * 100, F.lit(len(rules)))


def zone_category(borough: Column, service_zone: Column, core_borough: str) -> Column:
    return (
        F.when(service_zone == "Airports", "Airport")
        .when(service_zone == "Yellow Zone", f"{core_borough} Core")
        .when(borough == core_borough, f"{core_borough} Other")
        .otherwise("Outer Borough")
    )


def guarded_ratio(num: Column, den: Column) -> Column:
    """num / den when den is positive, else 0."""
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def nearest(amount: Column, step: int) -> Column:
    """An amount generalised to the nearest multiple of ``step``, halves away from zero."""
    return round_half_away(cents(amount), F.lit(step * 100)) * F.lit(float(step))
