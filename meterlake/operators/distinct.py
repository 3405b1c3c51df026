"""Exact distinct counts of whole-number keys as bitmaps.

Keys are cut into buckets of 32,768 consecutive numbers. Every task sets one bit per key in a bitmap of its bucket, and bitmaps of one bucket are
united: no single key is shuffled. That is worth it where keys lie close together in the files, as running numbers do; whether they do is
measured first, by one aggregate over the key column. Otherwise, and for other types, keys are grouped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITMAP_BYTES = 4096
# what a grouped key costs in a shuffle, about
KEY_BYTES = 12
INTEGERS = {"tinyint", "smallint", "int", "bigint"}


def bitmaps_pay(df: DataFrame, key: str, by: Sequence[str] = ()) -> bool:
    """Whether the bitmaps that tasks would send are smaller than the keys. Approximate on purpose: it chooses the way, not the result."""
    if dict(df.dtypes)[key] not in INTEGERS:
        return False
    bucket = F.bitmap_bucket_number(F.col(f"`{key}`").cast("bigint"))
    placed = df.select(F.struct(F.spark_partition_id().alias("task"), bucket.alias("bucket"), *[F.col(f"`{c}`") for c in by]).alias("at"), F.col(f"`{key}`").alias("key"))
    found = placed.agg(F.approx_count_distinct("at").alias("bitmaps"), F.count("key").alias("keys")).first()
    return found["bitmaps"] * BITMAP_BYTES <= max(found["keys"], 1) * KEY_BYTES or found["bitmaps"] <= 64


def key_blocks(df: DataFrame, key: str, by: Sequence[str] = (), bitmaps: bool | None = None) -> DataFrame:
    """``by, n, d``: several rows per ``by``, whose sums are the rows and the distinct keys, NULL not counted as a key."""
    groups = [F.col(f"`{c}`") for c in by]
    number = F.col(f"`{key}`")
    if bitmaps_pay(df, key, by) if bitmaps is None else bitmaps:
        rows = df.select(*groups, number.cast("bigint").alias("_key"))
        marked = rows.groupBy(*groups, F.bitmap_bucket_number("_key").alias("_bucket")).agg(
            F.count(F.lit(1)).alias("n"), F.bitmap_construct_agg(F.bitmap_bit_position("_key")).alias("_bits")
        )
        return marked.select(*groups, "n", F.when(F.col("_bucket").isNull(), 0).otherwise(F.bitmap_count("_bits")).alias("d"))
    counted = df.groupBy(*groups, number.alias("_key")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(*groups, "n", F.col("_key").isNotNull().cast("bigint").alias("d"))


def distinct_counts(df: DataFrame, keys: Sequence[str], by: Sequence[str], bitmaps: bool | None = None) -> DataFrame:
    """``by, n`` and ``n_<key>`` for each key: rows and exact distinct keys per group. NULL is a group of its own and no key."""
    out = None
    for k in keys:
        one = key_blocks(df, k, by, bitmaps).groupBy(*[F.col(f"`{c}`") for c in by]).agg(F.sum("n").alias("n"), F.sum("d").alias(f"n_{k}"))
        if out is None:
            out = one
            continue
        other = one.drop("n").withColumnsRenamed({c: f"_{c}" for c in by})
        same = F.lit(True)
        for c in by:
            same = same & F.col(f"`{c}`").eqNullSafe(F.col(f"`_{c}`"))
        out = out.join(other, same).drop(*[f"_{c}" for c in by])
    return out
