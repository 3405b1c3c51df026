"""Mixing sources to target token shares by entropy balancing.

A document's rate is the least change from one copy each (in relative entropy) under which every source
meets its token target and no rate exceeds the limit. The solution is exponentially tilted:
``rate = min(limit, exp(lambda_source * size / unit_source))``. Each lambda solves a convex dual by Newton's method, all sources at once: an
iteration is one aggregation. Rates depend on source and size only, so the documents are first counted into (source, size)
cells, and iterations run over that table, which a hot source makes no longer than its number of different sizes.

Rates become whole copies by cumulative rounding in the order of falling size, inside cells split into parts of bounded size,
so that no task sees a large group of equal documents and a source misses its target by about half a document.
Which document of a part gets the extra copy depends on a hash of its id alone: reruns agree.

NULL text has size 0. NULL is a source like any other, last in order. Sources of size 0 have target 0. Rows with equal ids
are separate documents. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.common import stored, words
from meterlake.operators.keys import numbered

WEIGHTS = (5.0, 2.0, 1.0)
LIMIT = 3
PART = 4096
TOLERANCE = 1e-9
MAX_STEPS = 100


def sized(docs: DataFrame, text: str, source: str, keep: list[str], draw: list[str]) -> DataFrame:
    """Narrow stored rows: a row number, the source, the size, the columns asked for, and a number drawn from the columns ``draw``."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("_rid"),
        F.struct(*[F.col(f"`{c}`") for c in keep], F.lit(0).alias("_")).alias("_row"),
        F.col(f"`{source}`").alias("source"),
        F.size(words(F.col(f"`{text}`"))).cast("long").alias("size"),
        F.xxhash64(*[F.col(f"`{c}`") for c in draw]).alias("_draw"),
    )
    return stored(rows, "mix-sizes")


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """Adds ``weight`` and ``target`` to ``source, source_size``.

    All tokens are shared by weight; a share stops at ``limit`` times the source's size and the excess is shared again
    among the others, which is one common factor: ``min(limit * size, factor * weight)``. Each round is one aggregate.
    """
    named = sources.filter(F.col("source").isNotNull())
    ranked = numbered(named, "source", "rank", 0)
    last = named.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    ranked = ranked.unionByName(sources.filter(F.col("source").isNull()).withColumn("rank", F.lit(last).cast("long")))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = stored(ranked.withColumn("weight", weight).drop("rank"), "mix-sources")
    most = F.col("source_size") * F.lit(limit)
    factor = 0.0
    while True:
        capped = most <= F.lit(factor) * F.col("weight")
        sums = ranked.agg(
            F.sum("source_size").alias("total"),
            F.sum(F.when(capped, most).otherwise(0)).alias("used"),
            F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if not sums["total"] or not sums["open"]:
            break
        again = (sums["total"] - sums["used"]) / sums["open"]
        if again <= factor:
            break
        factor = again
    return ranked.withColumn("target", F.least(most.cast("double"), F.lit(factor) * F.col("weight")))


def tilted(cells: DataFrame, wanted: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Adds ``target, source_size`` and the ``rate`` of each (source, size) cell.

    Newton's method on the dual of every source; the step is kept inside the bracket that earlier steps proved, so it
    cannot diverge. Sources whose target is the full ``limit`` need no iteration.
    """
    facts = wanted.select(F.col("source").alias("_source"), "target", "source_size")
    base = cells.join(facts, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    unit = base.groupBy("source", "target", "source_size").agg(
        F.try_divide(F.sum(F.col("n") * F.col("size") * F.col("size")), F.sum(F.col("n") * F.col("size"))).alias("unit")
    )
    duals = unit.withColumns(
        {
            "l": F.lit(0.0),
            "low": F.when(F.col("target") >= F.col("source_size"), F.lit(0.0)),
            "high": F.when(F.col("target") <= F.col("source_size"), F.lit(0.0)),
            "done": (F.col("source_size") == 0) | (F.col("target") >= F.lit(limit) * F.col("source_size")),
        }
    )
    duals = stored(duals, "mix-duals")
    for _ in range(MAX_STEPS):
        if not duals.filter(~F.col("done")).take(1):
            break
        duals = stored(_newton(cells, duals, limit), "mix-duals")
    final = duals.select(
        F.col("source").alias("_source"), "l", "unit", "target", "source_size", (F.col("target") >= F.lit(limit) * F.col("source_size")).alias("_full")
    )
    joined = cells.join(final, F.col("source").eqNullSafe(F.col("_source")), "left")
    rate = F.least(F.lit(float(limit)), F.exp(F.col("l") * F.col("size") / F.col("unit")))
    rate = F.when(F.col("_full"), F.lit(float(limit))).otherwise(rate)
    return joined.withColumn("rate", F.when(F.col("size") == 0, F.lit(1.0)).otherwise(rate)).drop("_source", "l", "unit", "_full")


def _newton(cells: DataFrame, duals: DataFrame, limit: int) -> DataFrame:
    """One step for every open source: value and slope of the dual's gradient by one aggregation."""
    open_ = duals.filter(~F.col("done")).select(F.col("source").alias("_source"), "l", "unit")
    x = F.col("size") / F.col("unit")
    rate = F.exp(F.col("l") * x)
    mass = F.col("n") * F.col("size")
    sums = (
        cells.join(open_, F.col("source").eqNullSafe(F.col("_source")))
        .groupBy("_source")
        .agg(
            F.sum(mass * F.least(F.lit(float(limit)), rate)).alias("got"),
            F.sum(F.when(rate < limit, mass * x * rate).otherwise(F.lit(0.0))).alias("slope"),
        )
    )
    both = duals.join(sums, duals["source"].eqNullSafe(sums["_source"]), "left").drop("_source")
    miss = F.col("got") - F.col("target")
    low = F.when(miss < 0, F.greatest("low", "l")).otherwise(F.col("low"))
    high = F.when(miss > 0, F.least("high", "l")).otherwise(F.col("high"))
    step = F.when(F.col("slope") > 0, F.col("l") - miss / F.col("slope"))
    both = both.withColumns({"low": F.when(~F.col("done"), low).otherwise(F.col("low")), "high": F.when(~F.col("done"), high).otherwise(F.col("high")), "_step": step})
    inside = (
        F.col("_step").isNotNull()
        & (F.col("low").isNull() | (F.col("_step") > F.col("low")))
        & (F.col("high").isNull() | (F.col("_step") < F.col("high")))
    )
    # outside the bracket: halve it, or double away from the proven side
    halved = (
        F.when(F.col("low").isNotNull() & F.col("high").isNotNull(), (F.col("low") + F.col("high")) / 2)
        .when(F.col("low").isNotNull(), F.col("low") * 2 + 0.1)
        .otherwise(F.col("high") * 2 - 0.1)
    )
    near = F.abs(miss) <= F.lit(TOLERANCE) * F.greatest(F.col("target"), F.lit(1.0))
    stuck = F.col("low").isNotNull() & F.col("high").isNotNull() & (F.col("high") - F.col("low") <= F.lit(1e-14) * (1 + F.abs("high")))
    settled = F.coalesce(near | stuck, F.lit(True))
    moved = F.when(F.col("done") | settled, F.col("l")).when(inside, F.col("_step")).otherwise(halved)
    return both.withColumns({"l": moved, "done": F.col("done") | settled}).select(
        "source", "target", "source_size", "unit", "l", "low", "high", "done"
    )


def mix(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    keep: list[str] | None = None,
    weights: tuple[float, ...] = WEIGHTS,
    limit: int = LIMIT,
    part: int = PART,
    draw: list[str] | None = None,
) -> DataFrame:
    """One row per document: the columns ``keep``, ``size, source_size, target, rate, copies, taken``. Which of several rows of one size are taken
    is drawn from the columns ``draw``, or else ``keep``."""
    keep = ["doc_id"] if keep is None else keep
    rows = sized(docs, text, source, keep, keep if draw is None else draw)
    cells = stored(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-cells")
    sources = cells.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    wanted = stored(targets(sources, weights, limit), "mix-targets")
    rated = stored(tilted(cells, wanted, limit), "mix-rates")

    # whole copies per cell: rounded running sums, so errors cancel along the sizes of a source
    falling = Window.partitionBy("source").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = F.sum(F.col("n") * F.col("rate")).over(falling)
    upto = F.floor(run + 0.5)
    down = Window.partitionBy("source").orderBy(F.desc("size"))
    planned = rated.withColumn("_upto", upto)
    planned = planned.withColumn("_copies", F.col("_upto") - F.coalesce(F.lag("_upto").over(down), F.lit(0)))
    planned = planned.withColumn("_copies", F.least(F.greatest(F.col("_copies"), F.lit(0)), F.lit(limit) * F.col("n")))
    planned = planned.withColumns(
        {
            "_each": F.floor(F.col("_copies") / F.col("n")),
            "_extra": F.col("_copies") % F.col("n"),
            "_parts": F.ceil(F.col("n") / F.lit(part)),
        }
    )
    cell = planned.select(F.col("source").alias("_source"), F.col("size").alias("_size"), "source_size", "target", "rate", "_each", "_extra", "_parts", F.col("n").alias("_n"))
    placed = rows.join(cell, F.col("source").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size"))).drop("_source", "_size")
    placed = placed.withColumn("_part", F.pmod(F.col("_draw"), F.col("_parts")))
    # extra copies over the parts of a cell: again rounded running sums, over part counts only
    parts = placed.groupBy("source", "size", "_part").agg(
        F.count(F.lit(1)).alias("_in"), F.first("_extra").alias("_extra"), F.first("_n").alias("_n")
    )
    along = Window.partitionBy("source", "size").orderBy("_part")
    whole = F.sum("_in").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    parts = parts.withColumn("_to", F.floor(whole * F.col("_extra") / F.col("_n")))
    parts = parts.withColumn("_share", F.col("_to") - F.coalesce(F.lag("_to").over(along), F.lit(0)))
    share = parts.select(
        F.col("source").alias("_source"), F.col("size").alias("_size"), F.col("_part").alias("_p"), "_share"
    )
    order = F.row_number().over(Window.partitionBy("source", "size", "_part").orderBy("_draw", "_rid"))
    drawn = placed.withColumn("_order", order).join(
        share,
        F.col("source").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size")) & (F.col("_part") == F.col("_p")),
    )
    copies = F.col("_each") + F.when(F.col("_order") <= F.col("_share"), 1).otherwise(0)
    drawn = drawn.withColumn("copies", copies.cast("long")).drop("_source")
    return drawn.select(
        *[F.col(f"_row.`{c}`").alias(c) for c in keep],
        "size",
        "source_size",
        "target",
        "rate",
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )
