"""Joins with an explicit size check and a skew-safe way beyond it."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.functions.times import elapsed_seconds
from meterlake.session import stored

TRUSTED_BYTES = 1 << 20
BROADCAST_BYTES = 32 << 20
BROADCAST_ROWS = 200_000
BROADCAST_VERSIONS = 64
COPIES = 2
MOST_DENSE = 1_000
NO_BUCKETS = 4_096

Keys = list[tuple[str, str]]


def plan_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate where it can be relied on: files, constants or number
    ranges that are filtered and projected. None for plans that may multiply rows."""
    plan = df._jdf.queryExecution().optimizedPlan()
    text = plan.toString()
    if any(node in text for node in ("Generate ", "Join ", "Expand ")):
        return None
    return int(plan.stats().sizeInBytes())


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a table is proven small enough to ship to every executor.

    The optimizer's estimate decides where it can be relied on and is far below the limit, or above it: files are
    compressed, so their rows take more. Otherwise the rows are measured by an aggregate, which sends one row per task on.
    """
    estimate = plan_bytes(df)
    if estimate is not None and estimate <= min(TRUSTED_BYTES, max_bytes):
        return True
    if estimate is not None and estimate > max_bytes:
        return False
    width = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))) + 16
    measured = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("bytes")).first()
    return measured["n"] <= rows and (measured["bytes"] or 0) <= max_bytes


INTEGERS = {"tinyint", "smallint", "int", "bigint"}


def _item(df: DataFrame, columns: list[str]) -> Column:
    """One number per key value, equal for equal keys of any integer width."""
    kinds = dict(df.dtypes)
    return F.xxhash64(*[F.col(c).cast("bigint") if kinds[c] in INTEGERS else F.col(c) for c in columns])


def _comparable(facts: DataFrame, dim: DataFrame, keys: Keys) -> bool:
    left, right = dict(facts.dtypes), dict(dim.dtypes)
    return all(left[f] == right[d] or {left[f], right[d]} <= INTEGERS for f, d in keys)


def hot_keys(facts: DataFrame, columns: list[str], most: int | None = None) -> dict[int, int]:
    """Keys with more rows than half a shuffle partition should hold, and over how many tasks to spread each so that it
    holds no more. One pass over the key columns. Approximate on purpose: it decides where rows go, never which rows match.
    No more keys than twice the number of shuffle partitions can be hot; so many numbers reach the driver at most."""
    partitions = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = max(200, 2 * partitions) if most is None else most
    found = (
        facts.select(_item(facts, columns).alias("k"))
        .agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(k, {most}, {max(10_000, 10 * most)})").alias("top"))
        .first()
    )
    limit = found["n"] / (2 * partitions)
    return {t["item"]: ceil(t["count"] / limit) for t in found["top"] if t["count"] > limit}


def _is_hot(df: DataFrame, columns: list[str], hot: dict[int, int]) -> Column:
    return _item(df, columns).isin(list(hot)) if hot else F.lit(False)


def _tasks(df: DataFrame, columns: list[str], hot: dict[int, int], salts: int | None) -> Column:
    """Over how many tasks a row's key is spread: ``salts``, or else by the key's share in powers of two."""
    if salts is not None:
        return F.when(_is_hot(df, columns, hot), salts).otherwise(F.lit(1))
    classes: dict[int, list[int]] = {}
    for item, wanted in hot.items():
        classes.setdefault(1 << (wanted - 1).bit_length(), []).append(item)
    spread = F.lit(1)
    for size, items in classes.items():
        spread = F.when(_item(df, columns).isin(items), size).otherwise(spread)
    return spread


def _fact_salt(facts: DataFrame, columns: list[str], hot: dict[int, int], salts: int | None) -> Column:
    """A task number for rows of hot keys, 0 for all others. It is a hash of the row, so a
    repeated task places its rows as before."""
    number = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in facts.columns]), _tasks(facts, columns, hot, salts))
    return F.when(_is_hot(facts, columns, hot), number.cast("int")).otherwise(F.lit(0))


def _copy_salts(dim: DataFrame, columns: list[str], hot: dict[int, int], salts: int | None) -> Column:
    """Where the counterpart of a key is needed: in all tasks of a hot key, else once."""
    return F.explode(F.sequence(F.lit(0), _tasks(dim, columns, hot, salts) - 1))


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    keys: Keys,
    how: str = "left",
    also: Column | None = None,
    small: bool | None = None,
    salts: int | None = None,
) -> DataFrame:
    """Attach a dimension to a large table.

    A dimension of proven size is broadcast and the facts never move. A larger one is
    shuffled with the facts. Rows of hot keys, NULL included, are spread over tasks by their
    share, or over ``salts`` tasks, and only the dimension rows of those keys are copied. ``also`` is a further
    condition of the match itself, not a filter on the result. Fact and dimension column
    names must differ.
    """
    condition = F.lit(True) if also is None else also
    for f, d in keys:
        condition = (F.col(f) == F.col(d)) & condition
    if fits_broadcast(dim) if small is None else small:
        return facts.join(F.broadcast(dim), condition, how)
    fact_keys, dim_keys = [f for f, _ in keys], [d for _, d in keys]
    hot = hot_keys(facts, fact_keys) if _comparable(facts, dim, keys) else {}
    if not hot:
        return facts.join(dim, condition, how)
    salted = facts.withColumn("_fact_salt", _fact_salt(facts, fact_keys, hot, salts))
    copies = dim.withColumn("_dim_salt", _copy_salts(dim, dim_keys, hot, salts))
    joined = salted.join(copies, (F.col("_fact_salt") == F.col("_dim_salt")) & condition, how)
    return joined.drop("_fact_salt", "_dim_salt")


def unmatched(facts: DataFrame, dim: DataFrame, keys: Keys) -> DataFrame:
    """Facts whose key is present but has no counterpart."""
    present = facts
    for f, _ in keys:
        present = present.filter(F.col(f).isNotNull())
    distinct_keys = dim.select(*[F.col(d).alias(f"_k_{d}") for _, d in keys]).distinct()
    return lookup_join(present, distinct_keys, [(f, f"_k_{d}") for f, d in keys], "left_anti")


def asof_join(
    facts: DataFrame,
    dim: DataFrame,
    keys: Keys,
    at: str,
    start: str,
    end: str,
    small: bool | None = None,
    bucket_seconds: int | None = None,
    salts: int | None = None,
    cut: bool = False,
) -> DataFrame:
    """Left join to the version valid at a time: ``start <= at < end``.

    Of overlapping versions of a key the one that starts last counts, of equal starts the one that ends last (then the largest
    row): versions are cut at the next start before either plan, so both give the same rows; ``cut`` says that
    :func:`cut_versions` has done so already. With few versions per key and a dimension of proven size this is a broadcast
    equality join with the range as residual. Otherwise versions and facts meet in time buckets, see :func:`bucket_join`.
    """
    if not cut:
        dim = stored(cut_versions(dim, [d for _, d in keys], start, end), "versions")
    if small is None:
        small = few_versions(dim, [d for _, d in keys])
    if small:
        within = (F.col(at) >= F.col(start)) & (F.col(at) < F.col(end))
        return lookup_join(facts, dim, keys, "left", within, small=True)
    return bucket_join(facts, dim, keys, at, start, end, bucket_seconds, salts)


def cut_versions(dim: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """One version per key and start, each ending at the next start at the latest. The columns keep their order."""
    rest = [c for c in dim.columns if c not in (*keys, start, end)]
    best = F.max(F.struct(end, *rest)).alias("_best")
    one = dim.filter(F.col(start).isNotNull()).groupBy(*keys, start).agg(best).select(*keys, start, "_best.*")
    later = F.lead(start).over(Window.partitionBy(*keys).orderBy(start))
    return one.withColumn(end, F.least(F.col(end), later)).select(*dim.columns)


def few_versions(dim: DataFrame, keys: list[str]) -> bool:
    """Whether a versioned dimension fits a broadcast and no key has many versions."""
    if not fits_broadcast(dim):
        return False
    most = dim.groupBy(*keys).count().agg(F.max("count")).first()[0]
    return most is None or most <= BROADCAST_VERSIONS


class TimeBuckets:
    """How time is cut for a versioned dimension. All that is needed comes from the dimension.

    Versions change between the first end and the last start; all time before is one bucket, all time behind another. There are
    ``COPIES`` times as many buckets as versions per key on average, so the versions, copied into each bucket they
    touch, stay within (1 + ``COPIES``) times their number. Keys with very many versions have finer buckets of their own, the
    ``MOST_DENSE`` densest of them; the others only compare a fact with more versions.
    """

    def __init__(self, dim: DataFrame, keys: list[str], start: str, end: str, seconds: int | None):
        counts = dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(end).alias("first"), F.max(start).alias("last"))
        found = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("keys"), F.min("first").alias("first"), F.max("last").alias("last")).first()
        self.first = found["first"]
        span = int((found["last"] - found["first"]).total_seconds()) if found["n"] and found["first"] else 0
        wanted = -(-COPIES * found["n"] // found["keys"]) if found["n"] else 1
        self.seconds = seconds or max(1, -(-span // wanted))
        self.top = max(0, -(-span // self.seconds))
        self.finer: dict[int, list[int]] = {}
        most = BROADCAST_VERSIONS * (self.top + 1)
        if found["n"]:
            dense = counts.filter(F.col("n") > most).select(_item(dim, keys).alias("item"), "n").orderBy(F.desc("n"), "item").limit(MOST_DENSE)
            for row in dense.collect():
                self.finer.setdefault(1 << (row["n"] // most).bit_length(), []).append(row["item"])

    def of(self, df: DataFrame, columns: list[str], ts: str) -> Column:
        """The bucket of a time, -1 before the first change."""
        if self.first is None:
            return F.lit(-1).cast("bigint")
        finer = F.lit(1)
        for times, items in self.finer.items():
            finer = F.when(_item(df, columns).isin(items), times).otherwise(finer)
        passed = elapsed_seconds(F.lit(self.first).cast("timestamp_ntz"), F.col(ts).cast("timestamp_ntz"))
        return F.when(passed < 0, F.lit(-1)).otherwise(F.least(F.floor(passed * finer / self.seconds), F.lit(self.top).cast("bigint") * finer))


def bucket_join(
    facts: DataFrame,
    dim: DataFrame,
    keys: Keys,
    at: str,
    start: str,
    end: str,
    bucket_seconds: int | None = None,
    salts: int | None = None,
) -> DataFrame:
    """As-of join of facts with cut versions by an equality join on (key, time bucket), the range as residual.

    Each version is copied into the buckets it touches, see :class:`TimeBuckets`. Facts are read once and moved once, without a sort in
    time or a window; run-time skew handling splits a hot (key, bucket), or ``salts`` tasks share each hot key. Facts without key or time match nothing and
    are spread over buckets that no version is in.
    """
    fact_keys, dim_keys = [f for f, _ in keys], [d for _, d in keys]
    comparable = _comparable(facts, dim, keys)
    dim = dim.filter(F.col(end) > F.col(start))
    buckets = TimeBuckets(dim, dim_keys, start, end, bucket_seconds)
    if not comparable:
        buckets.finer = {}
    copies = dim.withColumn("_in", F.explode(F.sequence(buckets.of(dim, dim_keys, start), buckets.of(dim, dim_keys, end))))
    present = F.col(at).isNotNull()
    for f in fact_keys:
        present = present & F.col(f).isNotNull()
    nowhere = -2 - F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in facts.columns]), F.lit(NO_BUCKETS))
    rows = facts.withColumn("_bucket", F.when(present, buckets.of(facts, fact_keys, at)).otherwise(nowhere))
    condition = (F.col("_bucket") == F.col("_in")) & (F.col(at) >= F.col(start)) & (F.col(at) < F.col(end))
    for f, d in keys:
        condition = (F.col(f) == F.col(d)) & condition
    if salts is not None and comparable:
        hot = hot_keys(facts, fact_keys)
        rows = rows.withColumn("_fact_salt", _fact_salt(facts, fact_keys, hot, salts))
        copies = copies.withColumn("_dim_salt", _copy_salts(dim, dim_keys, hot, salts))
        condition = (F.col("_fact_salt") == F.col("_dim_salt")) & condition
    return rows.join(copies, condition, "left").select(*[F.col(f"`{c}`") for c in (*facts.columns, *dim.columns)])


def reconcile(
    left: DataFrame, right: DataFrame, key: str, measures: dict[str, float]
) -> DataFrame:
    """Keys whose measures differ by more than the tolerance, or that one side lacks."""
    l_side = left.select(key, *[F.col(m).alias(f"{m}_source") for m in measures])
    r_side = right.select(key, *[F.col(m).alias(f"{m}_target") for m in measures])
    both = l_side.join(r_side, key, "full_outer")
    differs = F.lit(False)
    for m, tolerance in measures.items():
        source, target = F.col(f"{m}_source"), F.col(f"{m}_target")
        differs = differs | source.isNull() | target.isNull() | (F.abs(source - target) > tolerance)
    return both.filter(differs)
