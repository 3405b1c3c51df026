"""Conversations as a trie of shared beginnings, over a minimal-perfect-hash node table.

1. A conversation's turns are ordered by turn (NULL first; rows of one turn by the digest of role and text), hashed, and its beginning may
   be taken from another conversation. Texts stay where they are: only digests and word counts move. The digest of a prefix
   chains the digests of its turns.
2. Weights: the rows at or below a prefix, summed by digest. Prefixes over a limit are heavy: at most ``MOST_HEAVY`` of them, by the
   choice of the limit. The subtree below the first light prefix of a path has at most ``limit`` rows, so it fits one shard, and a first turn
   that a third of all conversations share is spread over many.
3. Shard: its distinct prefix digests get slots of a minimal perfect hash, built level by level; a lookup compares the digest in the
   slot, so a foreign digest is told apart. Counts are scattered into flat arrays by slot, and subtree sums run through the array of parent
   slots from the deepest level up.
4. The heavy prefixes form one small shard of the same kind; light subtrees enter it as sums per heavy parent.
5. The ids that end at a node are joined in blocks of 4,096 consecutive ids and hashed in order as a stream.

NULL roles and texts count as empty. Rows without a conversation id belong to no conversation and are left out. Repeated rows are repeated turns. A conversation is one
row here, whatever its length; conversations of equal content are members of the same nodes. Columns of other names are ignored.
An empty table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.common import mapped, packed, stored, unpacked, words, write_file
from meterlake.session import scratch_path

MOST_HEAVY = 1_000_000
LEAST_LIMIT = 256
ROWS_PER_SHARD = 1_000_000
ID_BLOCK_BITS = 12
LEVELS = 64
TOP = -1

NODE = "hi bigint, lo bigint, above_hi bigint, above_lo bigint, depth int, n_words bigint, conv_id bigint, n bigint"
TOLD = (
    "hi bigint, lo bigint, above_hi bigint, above_lo bigint, depth int, conv_id bigint, parent_conv_id bigint, "
    "n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint"
)


def mixed(hi: np.ndarray, lo: np.ndarray, seed: int) -> np.ndarray:
    x = hi.view(np.uint64) ^ (lo.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed * 0xD1B54A32D192ED03 % (1 << 64)))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Slots:
    """A minimal perfect hash of distinct digests. On each level the keys that meet no other take a slot, the rest go on."""

    def __init__(self, hi: np.ndarray, lo: np.ndarray):
        n = len(hi)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.hi, self.lo = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
        self.own = np.empty(n, dtype=np.int64)
        left, taken = np.arange(n), 0
        while len(left):
            if len(self.levels) == LEVELS:
                raise ValueError("digests are not distinct")
            size = 64 + 2 * len(left)
            at = (mixed(hi[left], lo[left], len(self.levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            rank = taken + np.cumsum(alone) - 1
            self.levels.append((alone, rank))
            fits = alone[at]
            self.own[left[fits]] = rank[at[fits]]
            taken += int(fits.sum())
            left = left[~fits]
        self.hi[self.own], self.lo[self.own] = hi, lo

    def of(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """The slots of digests, -1 for those that have none."""
        out = np.full(len(hi), -1, dtype=np.int64)
        left = np.arange(len(hi))
        for k, (alone, rank) in enumerate(self.levels):
            at = (mixed(hi[left], lo[left], k) % np.uint64(len(alone))).astype(np.int64)
            met = alone[at]
            out[left[met]] = rank[at[met]]
            left = left[~met]
        found = out >= 0
        same = (self.hi[out[found]] == hi[found]) & (self.lo[out[found]] == lo[found])
        out[np.flatnonzero(found)[~same]] = -1
        return out


def summed_up(nodes: dict[str, np.ndarray], below: dict[str, np.ndarray] | None = None) -> dict[str, np.ndarray]:
    """The finished node table of one shard. ``nodes`` may name a digest several times; ``below`` adds sums of subtrees kept elsewhere,
    by the digest of the node above them."""
    order = np.lexsort((nodes["lo"], nodes["hi"]))
    hi, lo = nodes["hi"][order], nodes["lo"][order]
    first = np.flatnonzero(np.concatenate([[True], (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])])) if len(hi) else np.zeros(0, dtype=np.int64)
    slots = Slots(hi[first], lo[first])
    size = len(first)

    def scattered(values: np.ndarray) -> np.ndarray:
        out = np.zeros(size, dtype=np.int64)
        out[slots.own] = values
        return out

    def named(column: str) -> np.ndarray:
        return scattered(nodes[column][order][first])

    out = {"hi": slots.hi, "lo": slots.lo, "above_hi": named("above_hi"), "above_lo": named("above_lo"), "depth": named("depth")}
    out["n_convs"] = scattered(np.add.reduceat(nodes["n"][order], first) if size else first)
    out["conv_id"] = scattered(np.minimum.reduceat(nodes["conv_id"][order], first) if size else first)
    above = slots.of(out["above_hi"], out["above_lo"])
    above[out["depth"] == 0] = -1
    children = np.bincount(above[above >= 0], minlength=size).astype(np.int64)
    leaves, saved = np.zeros(size, dtype=np.int64), (out["n_convs"] - 1) * named("n_words")
    if below is not None:
        at = slots.of(below["hi"], below["lo"])
        if (at < 0).any():
            raise ValueError("a subtree hangs off a node that is not here")
        for target, column in ((children, "n_children"), (leaves, "n_leaves"), (saved, "saved_tokens")):
            np.add.at(target, at, below[column])
    leaves[children == 0] = 1
    by_depth = np.argsort(-out["depth"], kind="stable")
    by_depth = by_depth[above[by_depth] >= 0]
    cuts = np.flatnonzero(np.diff(out["depth"][by_depth])) + 1
    for level in np.split(by_depth, cuts):
        np.add.at(leaves, above[level], leaves[level])
        np.add.at(saved, above[level], saved[level])
    out |= {"above": above, "n_children": children, "n_leaves": leaves, "saved_tokens": saved}
    return out


def told(found: dict[str, np.ndarray]) -> pa.RecordBatch:
    known = found["above"] >= 0
    parent = np.where(known, found["conv_id"][found["above"]], 0) if len(known) else found["conv_id"]
    # what lies above is told only where it is not in this shard
    outside = ~known & (found["depth"] > 0)
    columns = {
        "hi": pa.array(found["hi"], pa.int64()),
        "lo": pa.array(found["lo"], pa.int64()),
        "above_hi": pa.array(found["above_hi"], pa.int64(), mask=~outside),
        "above_lo": pa.array(found["above_lo"], pa.int64(), mask=~outside),
        "depth": pa.array(found["depth"], pa.int32()),
        "conv_id": pa.array(found["conv_id"], pa.int64()),
        "parent_conv_id": pa.array(parent, pa.int64(), mask=~known),
    }
    for c in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
        columns[c] = pa.array(found[c], pa.int64())
    return pa.RecordBatch.from_pydict(columns)


def arrays(batch: pa.Table, columns: list[str]) -> dict[str, np.ndarray]:
    return {c: batch.column(c).to_numpy().astype(np.int64) for c in columns}


def rebuilt(conversations: DataFrame, group: int, borrowed: Callable[[Column], Column]) -> DataFrame:
    """``conv_id, hi, lo, n_words``: the chained prefix digests of every conversation, as arrays by depth from 1.

    The first ``borrowed(conv_id)`` turns, at most 3, come from the conversation whose id is the multiple of ``group`` at or before it in size.
    """
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.md5(F.concat(F.md5(F.coalesce("role", F.lit(""))), F.md5(F.coalesce("text", F.lit(""))))).alias("digest"),
        F.size(words(F.col("text"))).cast("long").alias("n_words"),
    )
    rows = rows.withColumn("base", F.col("conv_id") - F.col("conv_id") % group)
    # at most 2 * group - 1 conversations have a base, so one shuffle by it serves the grouping and the borrowing
    own = rows.repartition("base").groupBy("base", "conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "digest", "n_words"))).alias("turns"))
    lender = F.when(F.col("conv_id") == F.col("base"), F.slice("turns", 1, 3))
    both = own.withColumn("head", F.max(lender).over(Window.partitionBy("base")))
    h = borrowed(F.col("conv_id")).cast("int")
    head = F.coalesce(F.slice("head", F.lit(1), h), F.slice("turns", 1, 0))
    tail = F.slice("turns", h + 1, F.size("turns"))
    turns = both.select("conv_id", F.concat(head, tail).alias("turns")).select(
        "conv_id", F.col("turns.digest").alias("digest"), F.col("turns.n_words").alias("n_words")
    )

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hi, lo = [], []
            for own in batch.column("digest").to_pylist():
                path, last = [], b""
                for digest in own:
                    last = hashlib.blake2b(last + digest.encode(), digest_size=16).digest()
                    path.append(last)
                both = np.frombuffer(b"".join(path), dtype="<i8")
                hi.append(both[0::2])
                lo.append(both[1::2])
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_pydict(
                {"conv_id": batch.column("conv_id"), "hi": pa.array(hi, kind), "lo": pa.array(lo, kind), "n_words": batch.column("n_words").cast(kind)}
            )

    schema = "conv_id bigint, hi array<bigint>, lo array<bigint>, n_words array<bigint>"
    return stored(turns.mapInArrow(chain, schema), "trie-conversations")


class Paths:
    """The prefixes of a batch of conversations, one after another."""

    def __init__(self, batch: pa.RecordBatch):
        hi = batch.column("hi")
        self.hi, self.lo, self.n_words = (batch.column(c).flatten().to_numpy() for c in ("hi", "lo", "n_words"))
        self.sizes = np.diff(hi.offsets.to_numpy()).astype(np.int64)
        self.start = np.cumsum(self.sizes) - self.sizes
        self.conv = np.repeat(batch.column("conv_id").to_numpy(), self.sizes)
        self.depth = np.arange(len(self.hi)) - np.repeat(self.start, self.sizes) + 1


def weights(paths: DataFrame) -> DataFrame:
    """``hi, lo, weight``: the rows at or below each prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = Paths(batch)
            yield pa.RecordBatch.from_pydict({"hi": own.hi, "lo": own.lo, "weight": np.repeat(own.sizes, own.sizes) - own.depth + 1})

    return paths.select("conv_id", "hi", "lo", "n_words").mapInArrow(run, "hi bigint, lo bigint, weight bigint").groupBy("hi", "lo").agg(F.sum("weight").alias("weight"))


def end_digests(paths: DataFrame) -> DataFrame:
    """``hi, lo, ends_sha256``: the ids of the conversations that end at a node, ascending, joined by commas and hashed."""
    tips = paths.withColumn("some", F.size("hi") > 0).select(
        *[F.when(F.col("some"), F.try_element_at(c, F.lit(-1))).otherwise(F.lit(0)).alias(c) for c in ("hi", "lo")], "conv_id"
    )
    blocks = (
        tips.groupBy("hi", "lo", F.shiftright("conv_id", ID_BLOCK_BITS).alias("block"))
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
        .repartition("hi", "lo")
        .sortWithinPartitions("hi", "lo", "block")
        .select("hi", "lo", "ids")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest = None, None
        for batch in batches:
            done: list[tuple[int, int, str]] = []
            for hi, lo, ids in zip(*(batch.column(c).to_pylist() for c in ("hi", "lo", "ids")), strict=True):
                if at == (hi, lo):
                    digest.update(b"," + ids.encode())
                    continue
                if at is not None:
                    done.append((*at, digest.hexdigest()))
                at, digest = (hi, lo), hashlib.sha256(ids.encode())
            yield ended(done)
        if at is not None:
            yield ended([(*at, digest.hexdigest())])

    def ended(done: list[tuple[int, int, str]]) -> pa.RecordBatch:
        hi, lo, ends = ([x[k] for x in done] for k in range(3))
        return pa.RecordBatch.from_pydict({"hi": pa.array(hi, pa.int64()), "lo": pa.array(lo, pa.int64()), "ends_sha256": pa.array(ends, pa.string())})

    return blocks.mapInArrow(run, "hi bigint, lo bigint, ends_sha256 string")


def trie(paths: DataFrame, least_limit: int = LEAST_LIMIT) -> DataFrame:
    """One row per node: ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    ``paths`` are the conversations of :func:`rebuilt`, read several times.
    """
    spark = paths.sparkSession
    size = F.size("hi").cast("decimal(20,0)")
    total = paths.agg(F.sum(size * (size + 1) / 2).cast("decimal(38,0)").alias("w"), F.sum(size).cast("long").alias("n")).first()
    # the weights add up to w, so no more than w / limit of them are over the limit
    limit = max(least_limit, int(total["w"] or 0) // MOST_HEAVY)
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(total["n"] or 0) // ROWS_PER_SHARD)
    heavy = weights(paths).filter(F.col("weight") > limit).select("hi", "lo").toArrow()
    file = f"{scratch_path(spark, 'trie-heavy')}/heavy.bin"
    # the root, the empty prefix, counts as heavy
    write_file(file, packed({c: np.append(heavy.column(c).to_numpy(), 0).astype(np.int64) for c in ("hi", "lo")}))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = unpacked(mapped(file))
        slots = Slots(known["hi"], known["lo"])
        for batch in batches:
            own = Paths(batch)
            top = slots.of(own.hi, own.lo) >= 0
            # the first light prefix of each path heads its subtree
            depth_light = np.add.reduceat(np.append(top, False).astype(np.int64), np.minimum(own.start, len(top))) * (own.sizes > 0) if len(own.sizes) else own.sizes
            head = np.repeat(own.start + np.minimum(depth_light, np.maximum(own.sizes - 1, 0)), own.sizes)
            shard = (mixed(own.hi[head], own.lo[head], LEVELS) % np.uint64(shards)).astype(np.int64)
            shard[top] = TOP
            first = own.depth == 1
            above_hi, above_lo = (np.where(first, 0, np.concatenate([[0], x[:-1]])) if len(x) else x for x in (own.hi, own.lo))
            rows = {
                "shard": shard,
                "hi": own.hi,
                "lo": own.lo,
                "above_hi": above_hi,
                "above_lo": above_lo,
                "depth": own.depth,
                "n_words": own.n_words,
                "conv_id": own.conv,
                "n": np.ones(len(shard), dtype=np.int64),
            }
            convs = batch.column("conv_id").to_numpy()
            if len(convs):
                root = {c: np.zeros(1, dtype=np.int64) for c in rows} | {
                    "shard": np.array([TOP]),
                    "conv_id": convs.min(keepdims=True),
                    "n": np.array([len(convs)]),
                }
                yield rows_of({c: np.append(rows[c], root[c]) for c in rows})

    def rows_of(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
        """Repeated prefixes of a batch move once."""
        order = np.lexsort((rows["lo"], rows["hi"], rows["shard"]))
        rows = {c: x[order] for c, x in rows.items()}
        new = np.any([np.diff(rows[c]) != 0 for c in ("shard", "hi", "lo")], axis=0)
        first = np.flatnonzero(np.concatenate([[True], new]))
        out = {c: x[first] for c, x in rows.items()}
        out["conv_id"], out["n"] = np.minimum.reduceat(rows["conv_id"], first), np.add.reduceat(rows["n"], first)
        return pa.RecordBatch.from_pydict({c: pa.array(x, pa.int32() if c in ("shard", "depth") else pa.int64()) for c, x in out.items()})

    rows = stored(paths.select("conv_id", "hi", "lo", "n_words").mapInArrow(dealt, f"shard int, {NODE}"), "trie-rows")
    columns = ["hi", "lo", "above_hi", "above_lo", "depth", "n_words", "conv_id", "n"]

    def shard_nodes(part: pa.Table) -> pa.Table:
        return pa.Table.from_batches([told(summed_up(arrays(part, columns)))])

    light = stored(rows.filter(F.col("shard") != TOP).groupBy("shard").applyInArrow(shard_nodes, TOLD), "trie-light")

    sums = [F.min(c).alias(c) for c in ("above_hi", "above_lo", "depth", "n_words", "conv_id")]
    top = rows.filter(F.col("shard") == TOP).groupBy("hi", "lo").agg(*sums, F.sum("n").alias("n"))
    hanging = (
        light.filter(F.col("above_hi").isNotNull())
        .groupBy(F.col("above_hi").alias("hi"), F.col("above_lo").alias("lo"))
        .agg(F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    )
    none = F.lit(None).cast("long")
    kinds = top.select("hi", "lo", *columns[2:], none.alias("n_children"), none.alias("n_leaves"), none.alias("saved_tokens")).unionByName(
        hanging.select("hi", "lo", *[F.lit(0).cast(rows.schema[c].dataType).alias(c) for c in columns[2:]], "n_children", "n_leaves", "saved_tokens")
    )

    def top_nodes(part: pa.Table) -> pa.Table:
        own = part.column("n_children").is_null().to_numpy()
        nodes = arrays(part.filter(pa.array(own)), columns)
        below = arrays(part.filter(pa.array(~own)), ["hi", "lo", "n_children", "n_leaves", "saved_tokens"])
        return pa.Table.from_batches([told(summed_up(nodes, below))])

    # at most two rows per heavy prefix, MOST_HEAVY of them and the root
    peak = stored(kinds.groupBy(F.lit(0).alias("_one")).applyInArrow(top_nodes, TOLD), "trie-top")
    owners = peak.select(F.col("hi").alias("above_hi"), F.col("lo").alias("above_lo"), F.col("conv_id").alias("_owner"))
    lower = light.join(F.broadcast(owners), ["above_hi", "above_lo"], "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_owner"))
    nodes = lower.select(*peak.columns).unionByName(peak)
    ends = end_digests(paths)
    return nodes.join(ends, ["hi", "lo"], "left").select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
