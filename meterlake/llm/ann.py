"""Largest inner products by collision-counting hashing.

Each vector is projected on fixed random directions, and every projection is kept as a sorted array. Around a query's own projection a window opens;
rehashing is virtual: a larger radius only widens the windows, which are ranges of ranks in the sorted arrays. The first radius comes from the block's
sample, the next ones grow in small steps. A vector that collides in
enough projections is verified by its exact inner product. The search for a query ends when its k-th verified vector is nearer than the radius that
the windows stand for, so all that near were counted with high probability. As soon as k are verified, the windows go to the k-th one's distance at once: between the first
radius and that one, most queries count once more instead of at every step, and their windows are never narrower than step by step.

Inner products become distances by one more coordinate: vectors are scaled by the largest norm and filled up to length one, queries to length one.

The index is cut into blocks of rows, each with its own sorted arrays, and the stated queries into blocks too. A task handles one pair of blocks,
and the nearest of all blocks are merged. Work is queries times rows, as the exact answer to a query set that grows with the table demands; memory is one
pair of blocks.

Vectors that are NULL, zero, of another length than most, or hold NULL or non-finite components take no part. Rows with equal ids are separate
candidates; only the query's own row is left out. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.common import stored

PROJECTIONS = 128
BLOCK_ROWS = 8192
BLOCK_QUERIES = 1024
NEAREST = 20
# collision probability 2 * Phi(1) - 1 = 0.683 of a vector at the radius, less a standard deviation and a third at 128 projections
COLLISIONS = 0.63
# fine steps where distances between unit vectors of many dimensions lie: at a radius a little too wide most vectors collide
RADII = np.concatenate([[0.0], np.geomspace(0.05, 0.6, 27)[:-1], 0.6 * 1.03 ** np.arange(45)])
SAMPLE = 512
OPENING = 0.93
ROUNDING = 1e-9
STEP_QUERIES = 64


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """Stored rows ``rid, id, v, norm`` of the vectors that take part."""
    v = F.col(f"`{vector}`").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    rows = vectors.select(
        F.monotonically_increasing_id().alias("rid"), F.col(f"`{vec_id}`").cast("long").alias("id"), v.alias("v"), norm.alias("norm")
    ).filter(F.coalesce(finite, F.lit(False)))
    rows = rows.filter(F.col("id").isNotNull() & (F.col("norm") > 0) & (F.col("norm") < float("inf")))
    rows = stored(rows, "ann-vectors")
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return rows.filter(F.size("v") == common[0]["d"]) if common else rows


class Index:
    """Sorted arrays of one block of rows, kept as the rank of each row in each projection: a window is a range of ranks."""

    def __init__(self, vectors: np.ndarray, most: float, directions: np.ndarray):
        scaled = vectors / most
        fill = np.sqrt(np.maximum(0.0, 1.0 - (scaled * scaled).sum(axis=1)))
        projected = (np.column_stack([scaled, fill]) @ directions).T
        order = np.argsort(projected, axis=1)
        self.sorted = np.take_along_axis(projected, order, axis=1)
        kind = np.uint16 if len(vectors) < 1 << 16 else np.uint32
        self.rank = np.empty(order.shape, dtype=kind)
        np.put_along_axis(self.rank, order, np.arange(len(vectors), dtype=kind)[None, :], axis=1)
        self.vectors, self.most, self.directions = vectors, most, directions
        self.sample = np.random.default_rng(11).permutation(len(vectors))[:SAMPLE]

    def windows(self, projected: np.ndarray, radii: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First rank and width of each window, by query and projection: around each query's projections, at its radius."""
        low = np.empty(projected.shape, dtype=self.rank.dtype)
        wide = np.empty_like(low)
        for j, own in enumerate(self.sorted):
            first = np.searchsorted(own, projected[:, j] - radii, "left")
            low[:, j], wide[:, j] = first, np.searchsorted(own, projected[:, j] + radii, "right") - first
        return low, wide

    def nearest(self, queries: np.ndarray, own: list[int], k: int):
        """Positions and inner products of each query's nearest verified rows; ``own`` is the row to leave out, or -1."""
        n = len(self.vectors)
        norms = np.linalg.norm(queries, axis=1)
        enough = int(np.ceil(COLLISIONS * len(self.rank)))
        # a rank below the window wraps round to a large number
        shifted, inside = np.empty_like(self.rank), np.empty(self.rank.shape, dtype=bool)
        for first in range(0, len(queries), STEP_QUERIES):
            part = queries[first : first + STEP_QUERIES]
            unit = self.most * norms[first : first + STEP_QUERIES]
            projected = np.column_stack([part / norms[first : first + STEP_QUERIES, None], np.zeros(len(part))]) @ self.directions
            guesses = self.vectors[self.sample] @ part.T
            pending = np.ones((len(part), n), dtype=bool)
            for q in range(len(part)):
                if own[first + q] >= 0:
                    pending[q, own[first + q]] = False
            radius = np.array([self.opening(guesses[:, q], pending[q], unit[q], k) for q in range(len(part))])
            found, scores = [[] for _ in part], [[] for _ in part]
            asking = np.arange(len(part))
            # the queries of a step widen together, each at its own radius
            while len(asking):
                low, wide = self.windows(projected[asking], RADII[radius[asking]])
                for at, q in enumerate(asking):
                    np.subtract(self.rank, low[at, :, None], out=shifted)
                    np.less(shifted, wide[at, :, None], out=inside)
                    counts = np.add.reduce(inside.view(np.uint8), axis=0, dtype=np.uint8)
                    fresh = np.flatnonzero((counts >= enough) & pending[q])
                    if len(fresh):
                        pending[q, fresh] = False
                        found[q].append(fresh)
                        scores[q].append(self.vectors.take(fresh, axis=0) @ part[q])
                    radius[q] = self.following(radius[q], scores[q], unit[q], k)
                asking = asking[radius[asking] < len(RADII)]
            for q in range(len(part)):
                if sum(map(len, found[q])) < min(k, n):
                    # too few collided even at the widest window: the rest is verified as well
                    rest = np.flatnonzero(pending[q])
                    found[q].append(rest)
                    scores[q].append(self.vectors[rest] @ part[q])
                yield self.best(part[q], np.concatenate(found[q]), np.concatenate(scores[q]), k)

    def following(self, r: int, scores: list[np.ndarray], unit: float, k: int) -> int:
        """The next radius, or one beyond the last where the search ends. With ``k`` rows verified it ends at the distance of the k-th
        at the latest, so the windows go there at once."""
        last = 0
        if sum(map(len, scores)) >= k:
            score = np.concatenate(scores)
            kth = np.partition(score, len(score) - k)[len(score) - k]
            last = int(np.searchsorted(RADII, np.sqrt(max(0.0, 2.0 - 2.0 * kth / unit)), "left"))
            if last <= r:
                return len(RADII)
        return len(RADII) if r >= len(RADII) - 1 else max(r + 1, min(last, len(RADII) - 1))

    def best(self, query: np.ndarray, at: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The rows that can be among the ``k`` best, with products summed in one fixed order."""
        if len(at) > k:
            kth = np.partition(score, len(score) - k)[len(score) - k]
            at = at[score >= kth - ROUNDING * (1.0 + abs(kth))]
        return at, (self.vectors[at] * query).sum(axis=1)

    def opening(self, guesses: np.ndarray, pending: np.ndarray, unit: float, k: int) -> int:
        """The first radius: a little less than where the k-th nearest lies by the block's sample."""
        there = guesses[pending[self.sample]]
        place = max(1, round(k * len(there) / max(1, len(pending))))
        if len(there) < place:
            return 0
        near = np.partition(there, len(there) - place)[len(there) - place]
        return int(np.searchsorted(RADII, OPENING * np.sqrt(max(0.0, 2.0 - 2.0 * near / unit)), "right")) - 1


def nearest(
    vectors: DataFrame,
    queries: DataFrame | None = None,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    every: int = 20,
    k: int = NEAREST,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: per query the ``k`` rows of largest inner product found, ties to the smaller id.

    The queries are the rows whose id is divisible by ``every``, or those of another table with the same columns.
    """
    rows = usable(vectors, vec_id, vector)
    asked = rows.filter(F.col("id") % every == 0) if queries is None else usable(queries, vec_id, vector).withColumn("rid", F.lit(-1).cast("long"))
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("most"), F.max(F.size("v")).alias("d")).first()
    n_asked = asked.count()
    most, width = facts["most"] or 1.0, facts["d"] or 1
    n_rows, n_queries = max(1, -(-facts["n"] // block_rows)), max(1, -(-n_asked // BLOCK_QUERIES))
    directions = np.random.default_rng(7).standard_normal((width + 1, PROJECTIONS))
    have = rows.select(
        F.pmod(F.xxhash64("rid"), F.lit(n_rows)).alias("r"), F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1))).alias("q"), "rid", "id", "v"
    )
    ask = asked.select(
        F.explode(F.expr(f"sequence(0L, {n_rows - 1}L)")).alias("_r"),
        F.pmod(F.xxhash64("id", "rid"), F.lit(n_queries)).cast("int").alias("_q"),
        F.col("rid").alias("_rid"),
        F.col("id").alias("_id"),
        F.col("v").alias("_v"),
    )
    # one number per query row that is the same for all of its copies
    ask = ask.withColumn("_uid", F.xxhash64("_id", "_rid", "_v"))

    def search(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asked) and len(held):
            held = held.sort_values("rid")
            ids, rids = held["id"].to_numpy(), held["rid"].to_numpy()
            index = Index(np.stack(held["v"].to_numpy()), most, directions)
            place = {r: p for p, r in enumerate(rids.tolist())}
            own = [place.get(r, -1) for r in asked["_rid"].tolist()]
            found = index.nearest(np.stack(asked["_v"].to_numpy()), own, k)
            for uid, query, (at, score) in zip(asked["_uid"].tolist(), asked["_id"].tolist(), found, strict=True):
                best = np.lexsort((ids[at], -score))[:k]
                out.extend((uid, query, int(ids[p]), float(s)) for p, s in zip(at[best], score[best], strict=True))
        return pd.DataFrame(out, columns=["uid", "query_id", "vec_id", "score"]).astype(
            {"uid": "int64", "query_id": "int64", "vec_id": "int64", "score": "float64"}
        )

    best = ask.groupBy("_r", "_q").cogroup(have.groupBy("r", "q")).applyInPandas(search, "uid long, query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id", "uid").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
