"""Vendor, zone and rate-code masters with governance columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake import schemas as S
from meterlake.sources.masters import values

GOVERNANCE = [
    "lifecycle_state string",
    "match_confidence decimal(5,2)",
    "source_system string",
    "created_by string",
    "approved_by string",
    "change_id bigint",
]


def seeded(masters: DataFrame, key: str, name: str, entity: str) -> DataFrame:
    """Master rows entering as ACTIVE with full confidence."""
    return masters.select(
        (F.col(key) + 1).alias(f"{entity}_id"),
        F.col(key).alias(f"source_{entity}_id"),
        F.col(name),
        F.lit("ACTIVE").alias("lifecycle_state"),
        F.lit("100.00").cast("decimal(5,2)").alias("match_confidence"),
        F.lit("initial_load").alias("source_system"),
        F.lit("admin").alias("created_by"),
        F.lit("admin").alias("approved_by"),
        F.col(key).cast("bigint").alias("change_id"),
    )


def vendor_masters(spark: SparkSession, proposed: tuple[int, ...] = ()) -> DataFrame:
    rows = [(i, n) for i, n, _ in S.VENDORS if i != S.UNKNOWN_VENDOR]
    base = seeded(values(spark, ["id int", "vendor_name string"], rows), "id", "vendor_name", "vendor")
    return _proposed(base, "source_vendor_id", proposed)


def ratecode_masters(spark: SparkSession, proposed: tuple[int, ...] = ()) -> DataFrame:
    base = values(spark, ["id int", "rate_code_desc string"], S.LAKE_RATE_CODES)
    return _proposed(seeded(base, "id", "rate_code_desc", "ratecode"), "source_ratecode_id", proposed)


def zone_masters(zones: DataFrame, proposed: tuple[int, ...] = ()) -> DataFrame:
    base = zones.select(F.col("locationid").alias("id"), F.col("zone").alias("zone_name"))
    return _proposed(seeded(base, "id", "zone_name", "zone"), "source_zone_id", proposed)


def _proposed(masters: DataFrame, key: str, ids: tuple[int, ...]) -> DataFrame:
    if not ids:
        return masters
    waiting = F.col(key).isin(*ids)
    return masters.withColumns(
        {
            "lifecycle_state": F.when(waiting, "PROPOSED").otherwise(F.col("lifecycle_state")),
            "approved_by": F.when(~waiting, F.col("approved_by")),
        }
    )
