"""Sets of processed ids as ranges.

Ids are cut into blocks of 2^``bits`` consecutive numbers, and a range never crosses a block: a block that is done is one row,
so the tracker follows the number of blocks and gaps, not the number of ids. The block is an equality key: ids are looked up by it,
with the range as residual, and a merge touches the blocks of the new ids only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.operators.joins import lookup_join

BLOCK_BITS = 20


def _block(key: Column, bits: int) -> Column:
    return F.shiftright(key.cast("bigint"), bits)


def id_ranges(ids: DataFrame, key: str, bits: int = BLOCK_BITS) -> DataFrame:
    """``block, first_id, last_id``: the runs of consecutive ids, in any order, repeated or not. NULL is no id."""
    rows = ids.select(F.col(f"`{key}`").cast("bigint").alias("id")).filter(F.col("id").isNotNull()).withColumn("block", _block(F.col("id"), bits))
    run = F.col("id") - F.dense_rank().over(Window.partitionBy("block").orderBy("id"))
    return rows.withColumn("run", run).groupBy("block", "run").agg(F.min("id").alias("first_id"), F.max("id").alias("last_id")).drop("run")


def merge_ranges(tracker: DataFrame, new: DataFrame) -> DataFrame:
    """Both sets as disjoint ranges, neighbours joined. Blocks without new ids stay as they are."""
    touched = new.select("block").distinct()
    untouched = tracker.join(touched, "block", "left_anti")
    both = tracker.join(touched, "block", "left_semi").unionByName(new)
    along = Window.partitionBy("block").orderBy("first_id", "last_id")
    before = F.max("last_id").over(along.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.when(before.isNull() | (F.col("first_id") > before + 1), 1).otherwise(0)
    part = F.sum("starts").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    numbered = both.withColumn("starts", starts).withColumn("part", part)
    merged = numbered.groupBy("block", "part").agg(F.min("first_id").alias("first_id"), F.max("last_id").alias("last_id"))
    return untouched.unionByName(merged.drop("part"))


def outside(df: DataFrame, key: str, tracker: DataFrame, bits: int = BLOCK_BITS, small: bool | None = None) -> DataFrame:
    """The rows whose id is in no range; those without an id are in none."""
    rows = df.withColumn("_block", _block(F.col(f"`{key}`"), bits))
    ranges = tracker.select(F.col("block").alias("_of_block"), F.col("first_id").alias("_first"), F.col("last_id").alias("_last"))
    within = F.col(f"`{key}`").between(F.col("_first"), F.col("_last"))
    return lookup_join(rows, ranges, [("_block", "_of_block")], "left_anti", within, small).drop("_block")
