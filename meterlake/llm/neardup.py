"""Near-duplicate groups by b-bit MinHash.

1. Every document's set of word shingles gives ``BANDS * ROWS`` minima. Only the two low bits of each minimum are kept, packed into four numbers;
   groups of four minima make one band key each. Documents with equal sets form one class, and one of each class goes on.
2. Classes that share a band key are candidates. The bit counts of two packed signatures estimate the similarity, corrected for bits that agree by chance;
   pairs far below the limit, or whose sizes exclude it, are passed over. All others are confirmed on their full sets.
3. First each class is tried against the smallest that shares a bucket with it, a star. Confirmed links make components. Buckets that still hold several components
   are searched further: members outside the bucket's largest component are compared with all others, block by block and cell by cell, in arrays of
   packed signatures, and each sends its few most similar untested partners of other components on.
4. Buckets that are still open carry their members' whole sets into the cells, as 32-bit hashes. There every pair across components whose estimate passes
   is counted on these sets, in the first bucket that the two share; pairs that collisions of hashes could not lift over the limit end there, and of the others
   one for each two components goes on to be confirmed. Rounds end when all that went on were links. So pairs that only come close to the limit never become
   rows, a group of near copies costs a few confirmations per member, and no link that joins components is lost.

At 28 bands of 4 rows a pair of similarity 0.8 shares a band with probability 1 - 4e-7. A hot bucket is cut into cells; nothing is collected but counts.

Words are split at ASCII blanks after lower-casing A-Z. A text of fewer words than a shingle is one shingle; NULL and empty texts have none and link with
nothing. Component ids ignore NULL ids where another member has one. Repeated rows belong to one class. An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.llm.common import stored
from meterlake.session import scratch_path

BANDS, ROWS = 28, 4
SHINGLE = 5
SIMILAR_PCT = 80
# four and a half standard deviations of the two-bit estimate at 0.8 below it
SLACK = 0.2
CELL = 2048
CELL_BYTES = 1 << 24
# probes that visit a cell together, in cells
BLOCK = 2
GROUP_ROWS = 30_000
SET_GROUP_ROWS = 4_000
FIRST_ROUND = 2
COUNTED = 64
CHUNK_WORDS = 200_000
_RNG = np.random.default_rng(20240131)
FACTORS = _RNG.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
SHIFTS = _RNG.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32)
ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text."""
    words = [(t or "").encode().lower().split() for t in texts]
    coded = pa.array([w for own in words for w in own], pa.binary()).dictionary_encode()
    by_word = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], dtype=np.uint64)
    h = by_word[coded.indices.to_numpy()] if len(by_word) else np.zeros(0, dtype=np.uint64)
    m = max(0, len(h) - width + 1)
    rolled = np.zeros(m, dtype=np.uint64)
    for k in range(width):
        rolled = rolled * ODD + h[k : k + m]
    rolled = mixed(rolled)
    out, at = [], 0
    for own in words:
        n = len(own)
        if n >= width:
            out.append(np.unique(rolled[at : at + n - width + 1]))
        elif n:
            out.append(np.array([xxhash.xxh64_intdigest(b" ".join(own))], dtype=np.uint64))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
        at += n
    return out


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ``BANDS * ROWS`` minima per non-empty set."""
    sizes = np.array([len(s) for s in sets])
    h = np.concatenate(sets).astype(np.uint32)
    starts = np.cumsum(sizes) - sizes
    out = np.empty((len(sets), len(FACTORS)), dtype=np.uint32)
    buffer = np.empty_like(h)
    for k, (a, b) in enumerate(zip(FACTORS, SHIFTS, strict=True)):
        np.multiply(h, a, out=buffer)
        np.add(buffer, b, out=buffer)
        out[:, k] = np.minimum.reduceat(buffer, starts)
    return out


def packed_bits(minimum: np.ndarray) -> np.ndarray:
    """The two low bits of each minimum: two numbers of low bits, two of high bits."""
    wide = np.zeros((len(minimum), 2, 128), dtype=np.uint8)
    wide[:, 0, : minimum.shape[1]] = minimum & 1
    wide[:, 1, : minimum.shape[1]] = (minimum >> 1) & 1
    return np.packbits(wide.reshape(len(minimum), -1), axis=1, bitorder="little").view("<i8")


def band_keys(minimum: np.ndarray) -> np.ndarray:
    grouped = minimum.reshape(len(minimum), BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * np.uint64(0x81DADEF4BC2DD44D)
    for r in range(ROWS):
        key = mixed(key ^ grouped[:, :, r]) * ODD
    return key.view(np.int64)


def estimated(a: list[Column], b: list[Column]) -> Column:
    """Similarity from packed two-bit signatures: agreeing positions, less those that agree by chance."""
    n = BANDS * ROWS
    apart = sum(F.bit_count(a[k].bitwiseXOR(b[k]).bitwiseOR(a[k + 2].bitwiseXOR(b[k + 2]))) for k in (0, 1))
    return (F.lit(1.0) - apart / F.lit(float(n)) - F.lit(0.25)) / F.lit(0.75)


def features(docs: DataFrame, text: str, doc_id: str, keep: list[str], width: int) -> DataFrame:
    """Narrow stored rows: number, kept columns, id, text hash, set size, set digest, band keys, signature."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        F.struct(*[F.col(f"`{c}`") for c in keep], F.lit(0).alias("_")).alias("_row"),
        F.col(f"`{doc_id}`").cast("long").alias("id"),
        F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("hash"),
        F.col(f"`{text}`").alias("text"),
    )
    schema = T.StructType(
        [
            *rows.schema.fields[:-1],
            T.StructField("n", T.LongType()),
            T.StructField("digest", T.BinaryType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
            T.StructField("sig", T.ArrayType(T.LongType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            a = 0
            while a < len(texts):
                b, chars = a, 0
                while b < len(texts) and (b == a or chars + len(texts[b] or "") < 6 * CHUNK_WORDS):
                    chars += len(texts[b] or "")
                    b += 1
                sets = shingle_sets(texts[a:b], width)
                full = [k for k, s in enumerate(sets) if len(s)]
                digest, bands, sig = [b""] * (b - a), [None] * (b - a), [None] * (b - a)
                if full:
                    minimum = minima([sets[k] for k in full])
                    for k, keys, bits in zip(full, band_keys(minimum).tolist(), packed_bits(minimum).tolist(), strict=True):
                        digest[k], bands[k], sig[k] = xxhash.xxh3_128_digest(sets[k].tobytes()), keys, bits
                made = [
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(digest, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(sig, pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns[:-1], *made], schema.names)
                a = b

    return stored(rows.mapInArrow(run, schema), "neardup-features")


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for links ``a, b``: the smallest number reachable. In each pass every node moves to its smallest neighbour and the
    links follow; those inside one component vanish, so the passes shrink."""
    edges = stored(_between(links.select("a", "b")), "links")
    labels = links.select(F.col("a").alias("node"), F.col("a").alias("component")).limit(0)
    first = True
    while edges.take(1):
        ends = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
        parents = stored(ends.groupBy("node").agg(F.least("node", F.min("other")).alias("parent")), "parents")
        if first:
            labels, first = parents.select("node", F.col("parent").alias("component")), False
        else:
            moved = parents.select(F.col("node").alias("component"), "parent")
            labels = labels.join(moved, "component", "left").select("node", F.coalesce("parent", "component").alias("component"))
            labels = stored(labels, "labels")
        left = parents.select(F.col("node").alias("a"), F.col("parent").alias("_a"))
        right = parents.select(F.col("node").alias("b"), F.col("parent").alias("_b"))
        followed = edges.join(left, "a").join(right, "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
        edges = stored(_between(followed), "links")
    return labels


def _between(links: DataFrame) -> DataFrame:
    """Distinct links of different nodes, the smaller first."""
    ends = links.filter(F.col("a") != F.col("b"))
    return ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, similar_pct: int) -> DataFrame:
    """Adds ``linked`` to the pairs ``a, b``: whether their full sets reach the limit, in whole numbers."""
    left = texts.select(F.col("rid").alias("a"), F.col("text").alias("_left"))
    right = texts.select(F.col("rid").alias("b"), F.col("text").alias("_right"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "_left", "_right")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 200):
                part = batch.slice(at, 200)
                sides = [part.column(c).to_pylist() for c in ("_left", "_right")]
                distinct = {t: k for k, t in enumerate(dict.fromkeys([*sides[0], *sides[1]]))}
                sets = shingle_sets(list(distinct), width)
                linked = []
                for x, y in zip(*sides, strict=True):
                    one, two = sets[distinct[x]], sets[distinct[y]]
                    common = len(np.intersect1d(one, two, assume_unique=True))
                    linked.append(100 * common >= similar_pct * (len(one) + len(two) - common) and common > 0)
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(linked)], ["a", "b", "linked"])

    return stored(both.mapInArrow(run, "a long, b long, linked boolean"), "neardup-confirmed")


def bucketed(df: DataFrame, key: str, name: str) -> str:
    """A table stored in buckets of a key, by its name: later joins on it leave these rows where they are."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(n, key).write.bucketBy(n, key).option("path", path).saveAsTable(table)
    return table


def agreeing(probe: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Estimated similarity of one packed signature with many."""
    n = BANDS * ROWS
    x = probe[None, :] ^ targets
    apart = np.bitwise_count((x[:, :2] | x[:, 2:]).view(np.uint64)).sum(axis=1)
    return (1 - apart / n - 0.25) / 0.75


def _parts(rows: Column, words: Column, cells: int) -> Column:
    """Into how many parts of at most so many cells' size ``rows`` of together ``words`` shingles are cut."""
    return F.ceil(F.greatest(rows / F.lit(cells * CELL), 4 * words / F.lit(cells * CELL_BYTES))).cast("int")


def _every(number: str) -> Column:
    """One row for each number below that of a column."""
    return F.explode(F.sequence(F.lit(0), F.col(number) - 1))


def opened(members: DataFrame) -> DataFrame:
    """The rows of buckets that hold several components, stored, with the largest of these as ``major``, the number of ``cells`` to cut each into
    and that of ``blocks`` for the rows outside ``major``: one where there is one cell."""
    sizes = members.groupBy("key", "component").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("n"))
    several = (
        sizes.groupBy("key")
        .agg(F.sum("m").alias("m"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("c"), F.max(F.struct("m", "component", "n")).alias("most"))
        .filter(F.col("c") > 1)
        .select(
            "key",
            F.col("most.component").alias("major"),
            _parts(F.col("m"), F.col("n"), 1).alias("cells"),
            _parts(F.col("m") - F.col("most.m"), F.col("n") - F.col("most.n"), BLOCK).alias("blocks"),
        )
    )
    return stored(members.join(several, "key"), "neardup-open")


def further_pairs(inside: DataFrame, tested: DataFrame, most: int, similar_pct: int) -> DataFrame:
    """Untested pairs ``a, b`` across components inside the buckets, at most ``most`` per probe and cell, best first; ``cut`` where a probe had more.

    ``inside``: rows of :func:`opened`. Members outside the largest component are the probes;
    all members are dealt into cells, the probes into blocks, and every block visits each cell of its bucket. Many small cells share one call.
    """
    visits = F.col("blocks") + F.when(F.col("component") != F.col("major"), F.col("cells")).otherwise(0)
    calls = max(1, (inside.agg(F.sum(F.when(F.col("cells") > 1, visits).otherwise(1))).first()[0] or 0) // GROUP_ROWS)
    cell = F.pmod(F.xxhash64("rid"), F.col("cells")).cast("int")
    block = F.pmod(F.xxhash64("rid", F.lit(1)), F.col("blocks")).cast("int")
    call = F.pmod(F.xxhash64("key", "cell", "block"), F.lit(calls))
    targets = inside.withColumn("cell", cell).withColumn("block", _every("blocks"))
    targets = targets.select(call.alias("call"), "key", "cell", "block", "rid", "n", "sig", "component")
    sides = tested.select("a", "b").union(tested.select(F.col("b").alias("a"), F.col("a").alias("b")))
    probes = inside.filter(F.col("component") != F.col("major"))
    done = sides.join(probes.select(F.col("rid").alias("a")).distinct(), "a").groupBy(F.col("a").alias("rid")).agg(F.collect_set("b").alias("done"))
    probes = probes.join(done, "rid", "left").withColumn("block", block).withColumn("cell", _every("cells")).withColumn("call", call)
    seen = F.coalesce("done", F.array().cast("array<bigint>")).alias("done")
    probes = probes.select(*[F.col(c).alias(f"_{c}") for c in ("call", "key", "cell", "block", "rid", "n", "sig", "component")], seen)
    limit, slack = similar_pct, SLACK

    def search(ask: pd.DataFrame, have: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, bool]] = []
        if len(ask) and len(have):
            have = have.sort_values(["key", "cell", "block"], kind="stable")
            sigs = np.stack(have["sig"].to_numpy()).astype(np.int64)
            rid, n, comp = (have[c].to_numpy() for c in ("rid", "n", "component"))
            key, cell, block = (have[c].to_numpy() for c in ("key", "cell", "block"))
            edge = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (cell[1:] != cell[:-1]) | (block[1:] != block[:-1])]))
            ranges = {(key[x], cell[x], block[x]): (x, y) for x, y in zip(edge.tolist(), [*edge[1:].tolist(), len(key)], strict=True)}
            columns = (ask[c] for c in ("_key", "_cell", "_block", "_rid", "_n", "_sig", "_component", "done"))
            for k, c, b, r, size, sig, own, known in zip(*columns, strict=True):
                if (k, c, b) not in ranges:
                    continue
                x, y = ranges[k, c, b]
                near = agreeing(np.asarray(sig, dtype=np.int64), sigs[x:y])
                there = n[x:y]
                good = (comp[x:y] != own) & (near >= limit / 100 - slack) & (100 * np.minimum(there, size) >= limit * np.maximum(there, size))
                if len(known):
                    good &= ~np.isin(rid[x:y], np.asarray(known))
                at = np.flatnonzero(good)
                cut = len(at) > most
                at = at[np.argsort(-near[at], kind="stable")][:most]
                out.extend((min(r, z), max(r, z), cut) for z in rid[x:y][at].tolist())
        return pd.DataFrame(out, columns=["a", "b", "cut"]).astype({"a": "int64", "b": "int64", "cut": "bool"})

    found = probes.groupBy("_call").cogroup(targets.groupBy("call")).applyInPandas(search, "a long, b long, cut boolean")
    return stored(found.groupBy("a", "b").agg(F.bool_or("cut").alias("cut")), "neardup-pairs")


def packed_sets(texts: DataFrame, width: int) -> DataFrame:
    """``rid``, ``words`` (the set of ``text`` as sorted 32-bit hashes) and ``lost`` (how many hashes fell together), beside the columns ``bands``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 200):
                part = batch.slice(at, 200)
                sets = shingle_sets(part.column("text").to_pylist(), width)
                short = [np.unique(x.astype(np.uint32)) for x in sets]
                made = [pa.array([x.tobytes() for x in short], pa.binary()), pa.array([len(x) - len(y) for x, y in zip(sets, short, strict=True)], pa.int64())]
                yield pa.RecordBatch.from_arrays([part.column("rid"), part.column("bands"), *made], ["rid", "bands", "words", "lost"])

    return stored(texts.select("rid", "bands", "text").mapInArrow(run, "rid long, bands array<long>, words binary, lost long"), "neardup-sets")


def linkable(inside: DataFrame, sets: DataFrame, refused: DataFrame, similar_pct: int) -> DataFrame:
    """Pairs ``a, b`` across components inside the buckets that reach the limit on their 32-bit sets, with all hashes that fell together counted as common.

    Every pair that shares a bucket and passes on estimate and size is counted, unless ``refused`` holds it: in the bucket of the first band the two
    share, by the probe of smaller number. Pairs found join their components for the rest of the block's visit, so at most one goes on for each two
    components there.
    """
    # rows that carry their sets: targets once for each block, probes once for each cell of several
    visits = F.col("blocks") + F.when((F.col("component") != F.col("major")) & (F.col("cells") > 1), F.col("cells")).otherwise(0)
    size = inside.agg(F.sum(visits), F.sum(visits * F.col("n"))).first()
    calls = max(1, (size[0] or 0) // SET_GROUP_ROWS, 4 * (size[1] or 0) // CELL_BYTES)
    cell = F.pmod(F.xxhash64("rid"), F.col("cells")).cast("int")
    block = F.pmod(F.xxhash64("rid", F.lit(1)), F.col("blocks")).cast("int")
    call = F.pmod(F.xxhash64("key", "cell", "block"), F.lit(calls))
    targets = inside.join(sets, "rid").withColumn("cell", cell).withColumn("block", _every("blocks"))
    targets = targets.select(call.alias("call"), "key", "cell", "block", "rid", "n", "sig", "component", "bands", "words", "lost")
    probes = inside.filter(F.col("component") != F.col("major"))
    # the probes of a bucket of one cell find their sets there
    one = probes.filter(F.col("cells") == 1)
    for c in sets.columns[1:]:
        one = one.withColumn(c, F.lit(None).cast(sets.schema[c].dataType))
    probes = one.unionByName(probes.filter(F.col("cells") > 1).join(sets, "rid"))
    sides = refused.select("a", "b").union(refused.select(F.col("b").alias("a"), F.col("a").alias("b")))
    done = sides.groupBy(F.col("a").alias("rid")).agg(F.collect_set("b").alias("done"))
    probes = probes.join(done, "rid", "left").withColumn("block", block).withColumn("cell", _every("cells")).withColumn("call", call)
    seen = F.coalesce("done", F.array().cast("array<bigint>")).alias("done")
    columns = ("call", "key", "cell", "block", "rid", "n", "sig", "component", "major", "bands", "words", "lost")
    probes = probes.select(*[F.col(c).alias(f"_{c}") for c in columns], seen)
    limit, slack, counted = similar_pct, SLACK, COUNTED

    def search(ask: pd.DataFrame, have: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int]] = []
        for (k, c, b), held in have.groupby(["key", "cell", "block"], sort=False) if len(ask) and len(have) else []:
            asked = ask[(ask["_key"] == k) & (ask["_cell"] == c) & (ask["_block"] == b)]
            if not len(asked):
                continue
            sigs, bands = (np.stack(held[x].to_numpy()).astype(np.int64) for x in ("sig", "bands"))
            rid, n, comp, lost = (held[x].to_numpy() for x in ("rid", "n", "component", "lost"))
            words = [np.frombuffer(w, dtype=np.uint32) for w in held["words"]]
            place = {r: p for p, r in enumerate(rid.tolist())}
            merged, joined = comp.copy(), {}
            names = ("_rid", "_n", "_sig", "_component", "_major", "_bands", "_words", "_lost", "done")
            for r, size, sig, own, major, keys, text, short, known in zip(*(asked[x] for x in names), strict=True):
                if text is None:
                    at = place[r]
                    keys, text, short = bands[at], words[at], lost[at]
                else:
                    # numbers beside the NULLs of other buckets come as floats
                    keys, text, short = np.asarray(keys, dtype=np.int64), np.frombuffer(text, dtype=np.uint32), int(short)
                while own in joined:
                    own = joined[own]
                near = agreeing(np.asarray(sig, dtype=np.int64), sigs)
                good = (merged != own) & (near >= limit / 100 - slack) & (100 * np.minimum(n, size) >= limit * np.maximum(n, size))
                good &= (comp == major) | (rid > r)
                if len(known):
                    good &= ~np.isin(rid, np.asarray(known))
                at = np.flatnonzero(good)
                at = at[keys[np.argmax(bands[at] == keys[None, :], axis=1)] == k] if len(at) else at
                at = at[np.argsort(-near[at], kind="stable")]
                while len(at):
                    now, at = at[:counted], at[counted:]
                    flat = np.concatenate([words[p] for p in now])
                    sizes = np.array([len(words[p]) for p in now])
                    found = text[np.minimum(np.searchsorted(text, flat), len(text) - 1)] == flat
                    common = np.add.reduceat(found, np.cumsum(sizes) - sizes, dtype=np.int64)
                    common += np.minimum(lost[now], short)
                    for p in now[100 * common >= limit * (n[now] + size - common)].tolist():
                        if merged[p] != own:
                            out.append((min(r, rid[p]), max(r, rid[p])))
                            joined[merged[p]] = own
                            merged[merged == merged[p]] = own
                    at = at[merged[at] != own]
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    found = probes.groupBy("_call").cogroup(targets.groupBy("call")).applyInPandas(search, "a long, b long")
    return stored(found.distinct(), "neardup-pairs")


def grouped(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    keep: list[str] | None = None,
    width: int = SHINGLE,
    similar_pct: int = SIMILAR_PCT,
) -> DataFrame:
    """One row per document: the columns ``keep``, ``n_shingles``, ``class_id`` (smallest id with the same set), ``component_id`` and ``kept``."""
    keep = [doc_id] if keep is None else keep
    rows = features(docs, text, doc_id, keep, width)
    same = rows.filter(F.col("n") > 0).groupBy("digest").agg(
        F.min("id").alias("first_id"),
        F.min_by(F.struct("rid", "id", "hash", "n", "bands", "sig"), "rid").alias("own"),
    )
    nodes = stored(same.select("digest", "first_id", "own.*"), "neardup-classes")

    spread = nodes.select("rid", F.explode("bands").alias("key"))
    buckets = spread.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("rid").alias("pivot")).filter(F.col("m") > 1)
    shared = stored(spread.join(buckets.select("key", "pivot"), "key"), "neardup-buckets")
    facts = nodes.select("rid", "n", "sig")

    wanted = shared.select("rid").distinct().join(nodes.select("rid", "id", "hash"), "rid")
    source = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("id"),
        F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("hash"),
        F.col(f"`{text}`").alias("text"),
    )
    fetched = source.join(wanted.withColumnsRenamed({"id": "_id", "hash": "_hash"}), F.col("id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash")))
    texts_table = bucketed(fetched.select("rid", "text").dropDuplicates(["rid"]), "rid", "neardup_texts")
    texts = docs.sparkSession.table(texts_table)

    star = shared.groupBy(F.col("rid").alias("b")).agg(F.min("pivot").alias("a")).filter(F.col("a") != F.col("b"))
    told = star.join(facts.select(F.col("rid").alias("a"), F.col("n").alias("_n"), F.col("sig").alias("_s")), "a").join(
        facts.select(F.col("rid").alias("b"), "n", "sig"), "b"
    )
    near = estimated([F.col("_s")[k] for k in range(4)], [F.col("sig")[k] for k in range(4)]) >= similar_pct / 100 - SLACK
    sized = 100 * F.least("n", "_n") >= similar_pct * F.greatest("n", "_n")
    tested = confirmed(told.filter(near & sized).select("a", "b"), texts, width, similar_pct)
    def open_rows(labels: DataFrame) -> DataFrame:
        held = shared.select("key", "rid").join(labels.withColumnRenamed("node", "rid"), "rid", "left")
        return opened(held.withColumn("component", F.coalesce("component", "rid")).join(facts, "rid"))

    labels = components(tested.filter("linked"))
    more = further_pairs(open_rows(labels), tested, FIRST_ROUND, similar_pct)
    if more.take(1):
        tested = stored(tested.union(confirmed(more, texts, width, similar_pct)), "neardup-tested")
        labels = components(tested.filter("linked"))
    if more.filter("cut").take(1):
        inside = open_rows(labels)
        fetch = inside.select("rid").distinct().join(nodes.select("rid", "bands"), "rid").join(texts, "rid")
        sets = packed_sets(fetch, width)
        refused = tested.limit(0)
        while True:
            checked = confirmed(linkable(inside, sets, refused, similar_pct), texts, width, similar_pct)
            tested = stored(tested.union(checked), "neardup-tested")
            labels = components(tested.filter("linked"))
            if not checked.filter("NOT linked").take(1):
                # every pair across components has been counted
                break
            refused = stored(refused.union(checked.filter("NOT linked")), "neardup-refused")
            inside = open_rows(labels)

    # nothing below reads the table; its files stay in the scratch folder
    docs.sparkSession.sql(f"DROP TABLE IF EXISTS {texts_table}")

    named = nodes.join(labels.withColumnRenamed("node", "rid"), "rid", "left").withColumn("component", F.coalesce("component", "rid"))
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    joined = named.join(smallest, "component").select(F.col("digest").alias("_digest"), F.col("first_id").alias("class_id"), "component_id")
    out = rows.join(joined, (F.col("digest") == F.col("_digest")) & (F.col("n") > 0), "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    out = out.withColumn("component_id", own).withColumn("class_id", F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("id")))
    return out.select(
        *[F.col(f"_row.`{c}`").alias(c) for c in keep],
        F.col("n").alias("n_shingles"),
        "class_id",
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
