"""Point in polygon: which zone a coordinate falls into."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.operators.joins import lookup_join
from meterlake.session import stored

# outlines of up to so many corners go whole into the cells of their bounding box
WHOLE_CORNERS = 32
# cells are widened by this share of their size wherever rounding could decide
SLACK = 1e-6


def edges(ring: Column) -> Column:
    """Consecutive corner pairs of a ring, closed."""
    following = F.concat(F.slice(ring, 2, F.size(ring) - 1), F.slice(ring, 1, 1))
    return F.transform(
        F.arrays_zip(ring.alias("p"), following.alias("q")),
        lambda e: F.struct(
            e["p"]["x"].alias("x1"), e["p"]["y"].alias("y1"), e["q"]["x"].alias("x2"), e["q"]["y"].alias("y2")
        ),
    )


def crossings(x: Column, y: Column, some: Column) -> Column:
    """How many edges a ray to the right crosses. Edges count their lower end and not their upper one, so a point on a shared boundary
    belongs to one polygon only."""
    return F.size(
        F.filter(
            some,
            lambda e: ((e["y1"] <= y) != (e["y2"] <= y))
            & (x < e["x1"] + (y - e["y1"]) * F.try_divide(e["x2"] - e["x1"], e["y2"] - e["y1"])),
        )
    )


def inside(x: Column, y: Column, polygon_edges: Column) -> Column:
    """Whether a ray to the right crosses the outline an odd number of times."""
    return crossings(x, y, polygon_edges) % 2 == 1


def cells_of(polygons: DataFrame, cell: float) -> DataFrame:
    """Each polygon once per grid cell its bounding box touches."""

    def span(axis: str) -> Column:
        values = F.transform("ring", lambda p: p[axis])
        low = F.floor(F.array_min(values) / cell)
        high = F.floor(F.array_max(values) / cell)
        return F.sequence(low, high)

    rows = polygons.withColumn("_edges", edges(F.col("ring"))).withColumn("_cx", F.explode(span("x")))
    return rows.withColumn("_cy", F.explode(span("y"))).drop("ring")


def clipped_cells(polygons: DataFrame, cell: float) -> DataFrame:
    """``_cx, _cy, _odd, _edges`` and the columns of the polygons but the ring: the grid cells that can hold points of a polygon, each with
    the part of the outline that matters there.

    * A cell that no edge touches lies inside or outside as a whole. Inside cells are found row by row from the crossings at the height of their
      centres; they need no test.
    * A cell on the outline keeps the edges that meet its row and do not lie to its left. Edges to its right that pass the whole row cross every ray
      from the cell; only their number counts, as ``_odd``.

    So an outline of many corners is cut up and not copied into every cell.
    """
    own = [c for c in polygons.columns if c != "ring"]
    known = stored(polygons.withColumn("_pid", F.monotonically_increasing_id()), "outlines")
    lines = known.select("_pid", F.explode(edges(F.col("ring"))).alias("e")).select("_pid", "e", "e.*")
    low_x, high_x = F.least("x1", "x2"), F.greatest("x1", "x2")
    low_y, high_y = F.least("y1", "y2"), F.greatest("y1", "y2")

    def number(value: Column, widen: float) -> Column:
        return F.floor(value / cell + widen)

    # cells that an edge touches, borders included
    met = lines.withColumn("_cx", F.explode(F.sequence(number(low_x, -SLACK), number(high_x, SLACK))))
    met = met.withColumn("_cy", F.explode(F.sequence(number(low_y, -SLACK), number(high_y, SLACK))))
    corners = [((F.col("_cx") + dx) * cell, (F.col("_cy") + dy) * cell) for dx in (-SLACK, 1 + SLACK) for dy in (-SLACK, 1 + SLACK)]
    sides = [(F.col("x2") - F.col("x1")) * (y - F.col("y1")) - (F.col("y2") - F.col("y1")) * (x - F.col("x1")) for x, y in corners]
    border = met.filter((F.least(*sides) <= 0) & (F.greatest(*sides) >= 0)).select("_pid", "_cx", "_cy").distinct()
    border = stored(border, "border-cells")

    # edges by the rows they meet; level ones cross no ray
    strips = lines.filter("y1 <> y2").withColumn("_cy", F.explode(F.sequence(number(low_y, -SLACK), number(high_y, SLACK))))
    strips = stored(strips, "outline-rows")
    left, right = (F.col("_cx") - SLACK) * cell, (F.col("_cx") + 1 + SLACK) * cell
    bottom, top = (F.col("_cy") - SLACK) * cell, (F.col("_cy") + 1 + SLACK) * cell
    far = (low_x > right) & (low_y <= bottom) & (high_y >= top)
    near = border.join(strips, ["_pid", "_cy"], "left").withColumn("_far", F.coalesce(far, F.lit(False)))
    kept = (~F.col("_far")) & (high_x >= left)
    border_cells = near.groupBy("_pid", "_cx", "_cy").agg(
        (F.count_if("_far") % 2).cast("int").alias("_odd"), F.collect_list(F.when(kept, F.col("e"))).alias("_edges")
    )

    middle = (F.col("_cy") + 0.5) * cell
    crossed = strips.filter((F.col("y1") <= middle) != (F.col("y2") <= middle))
    at = F.col("x1") + (middle - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    runs = crossed.select("_pid", "_cy", at.alias("x")).groupBy("_pid", "_cy").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    pairs = F.transform(F.sequence(F.lit(1), F.size("xs"), F.lit(2)), lambda i: F.struct(F.element_at("xs", i).alias("a"), F.element_at("xs", i + 1).alias("b")))
    spans = runs.select("_pid", "_cy", F.explode(pairs).alias("p"))
    first, last = F.ceil(F.col("p.a") / cell - 0.5), F.ceil(F.col("p.b") / cell - 0.5) - 1
    inner = spans.withColumns({"_f": first, "_l": last}).filter("_f <= _l").select("_pid", F.explode(F.sequence("_f", "_l")).alias("_cx"), "_cy")
    inner = inner.join(border, ["_pid", "_cx", "_cy"], "left_anti")
    none = F.array().cast(border_cells.schema["_edges"].dataType)
    cells = border_cells.unionByName(inner.withColumns({"_odd": F.lit(1), "_edges": none}))
    return cells.join(known.select("_pid", *own), "_pid").drop("_pid")


def locate(points: DataFrame, polygons: DataFrame, cell: float, small: bool | None = None) -> DataFrame:
    """Left join of points (x, y) to polygons (ring: array of x, y) that do not overlap.

    A point meets only the polygons of its grid cell, and the exact test is part of the
    join condition, so an unmatched point stays and no row per edge of a small outline is ever made. Outlines of many corners are cut up by
    cells first, see :func:`clipped_cells`.
    """
    gridded = points.withColumns(
        {"_px": F.floor(F.col("x") / cell), "_py": F.floor(F.col("y") / cell)}
    )
    most = polygons.agg(F.max(F.size("ring"))).first()[0] or 0
    if most <= WHOLE_CORNERS:
        candidates = cells_of(polygons, cell).withColumn("_odd", F.lit(0))
    else:
        candidates = clipped_cells(polygons, cell)
    x, y = F.col("x"), F.col("y")
    candidates = stored(candidates, "zone-cells")
    joined = lookup_join(
        gridded,
        candidates,
        [("_px", "_cx"), ("_py", "_cy")],
        "left",
        (crossings(x, y, F.col("_edges")) + F.col("_odd")) % 2 == 1,
        small,
    )
    return joined.drop("_px", "_py", "_cx", "_cy", "_edges", "_odd")
