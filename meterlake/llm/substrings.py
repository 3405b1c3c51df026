"""Removing repeated word windows, with a count-min prefilter.

A window of ``width`` words is removed from a document when the same words also start in a document with a smaller id.

1. Documents are packed into blocks of a few MB, written once. Every pass reads the same blocks; texts are never shuffled.
2. Sketch: every block sends its windows' cells of one wide count-min row. The row is cut into shards by the leading hash bits; a shard
   merges the cells of all blocks (a cell counts once per document, at most twice per block) and answers each block with one bit per window: count of
   two or more, or not. Merging only ever overestimates, so no repeated window is lost. A window costs about three bytes here.
3. Exact: only windows estimated repeated are sent with their full 128-bit hash and smallest id, combined per block before they move, and grouped
   exactly. The answer is again one bit per window.
4. Each block removes what the answers and its own documents tell.

A passage shared by a third of all documents reaches its shard once per block. Nothing is collected; the answers lie in the shared
folder by block, and tasks read only their own.

NULL and empty texts have no words and keep none. NULL ids count as larger than any other and not as smaller than each other. Rows with equal ids do not
shorten each other. An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.llm.common import filesystem
from meterlake.session import scratch_path

WIDTH = 13
BLOCK_BYTES = 4 << 20
CELL_BITS = 32
MIN_SHARDS = 64
WINDOWS_PER_SHARD = 2_000_000
NO_ID = np.iinfo(np.int64).max
FIRST, SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread a polynomial hash over all bits."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Block:
    """The windows of a block's documents: hashes, positions, and one entry per distinct window."""

    def __init__(self, ids: np.ndarray, texts: list[str | None], width: int):
        self.ids, self.width = ids, width
        self.words = [(t or "").encode().split() for t in texts]
        self.sizes = np.array([len(w) for w in self.words], dtype=np.int64)
        n = int(self.sizes.sum())
        owner = np.repeat(np.arange(len(ids)), self.sizes)
        m = max(0, n - width + 1)
        first, second = np.zeros(m, dtype=np.uint64), np.zeros(m, dtype=np.uint64)
        if m:
            coded = pa.array([w for own in self.words for w in own], pa.binary()).dictionary_encode()
            by_word = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], dtype=np.uint64)
            h = by_word[coded.indices.to_numpy()]
            for k in range(width):
                first = first * FIRST + h[k : k + m]
                second = second * SECOND + h[k : k + m]
        whole = owner[:m] == owner[width - 1 : width - 1 + m]
        self.at = np.flatnonzero(whole)
        first = mixed(first[whole])
        order = np.argsort(first, kind="stable")
        run = first[order]
        self.starts = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]])) if len(run) else np.zeros(0, dtype=np.int64)
        self.first = run[self.starts]
        self.second = mixed(second[whole])[order[self.starts]] if len(run) else run
        # the entry of each window, in order of position
        self.entry = np.empty(len(run), dtype=np.int64)
        self.entry[order] = np.repeat(np.arange(len(self.starts)), np.diff(np.append(self.starts, len(run))))
        self.own_id = ids[owner[self.at]]
        by_entry = self.own_id[order]
        self.low = np.minimum.reduceat(by_entry, self.starts) if len(run) else by_entry
        high = np.maximum.reduceat(by_entry, self.starts) if len(run) else by_entry
        self.several = high > self.low

    def sketched(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Shard and cell of each distinct window, both in rising order."""
        shift = np.uint64(64 - bits)
        return (self.first >> shift).astype(np.int64), ((self.first << np.uint64(bits)) >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def squeezed(values: np.ndarray) -> bytes:
    """Rising numbers below 2**32 as differences of the fewest whole bytes."""
    steps = np.diff(values, prepend=0).astype("<u4")
    wide = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(steps) else 1
    return bytes([wide]) + np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4)[:, :wide]).tobytes()


def unsqueezed(data: bytes) -> np.ndarray:
    wide = data[0]
    raw = np.frombuffer(data, dtype=np.uint8, offset=1).reshape(-1, wide)
    steps = np.zeros((len(raw), 4), dtype=np.uint8)
    steps[:, :wide] = raw
    return np.cumsum(steps.view("<u4").ravel().astype(np.int64))


def blocks_of(docs: DataFrame, text: str, doc_id: str, keep: list[str], block_bytes: int) -> DataFrame:
    """One row per block: its number and the lists of rows, ids and whole texts."""
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep], F.lit(0).alias("_")).alias("row"),
        F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(int(NO_ID))).alias("id"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    lists = [T.StructField(f.name + "s", T.ArrayType(f.dataType)) for f in rows.schema]
    schema = T.StructType([T.StructField("block", T.LongType()), *lists])
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        for batch in batches:
            upto = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False), dtype=np.int64)
            group = np.concatenate([[0], upto[:-1]]) // block_bytes if len(upto) else upto
            cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                part = batch.slice(a, b - a)
                columns = [
                    pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), pa.concat_arrays([part.column(name)])) for name in names
                ]
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *columns], schema.names)
                number += 1

    packed = rows.mapInArrow(run, schema)
    path = scratch_path(docs.sparkSession, "substring-blocks")
    packed.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


def each_block(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[int, int, pa.Array, Block]]:
    for batch in batches:
        for k in range(len(batch)):
            texts = batch.column("texts")[k].values.to_pylist()
            ids = batch.column("ids")[k].values.to_numpy()
            part = batch.column("part")[k].as_py() if "part" in batch.schema.names else 0
            yield batch.column("block")[k].as_py(), part, batch.column("rows")[k].values if "rows" in batch.schema.names else None, Block(ids, texts, width)


def answers(path: str, part: int, block: int, n: int) -> np.ndarray:
    """The bits that all shards gave a block, as one mask over its entries."""
    import pyarrow.dataset as ds

    # a part whose blocks asked nothing has no folder
    if n == 0:
        return np.zeros(0, dtype=bool)
    system, place = filesystem(path)
    data = ds.dataset(f"{place}/part={part}", filesystem=system, format="parquet", exclude_invalid_files=False)
    rows = data.to_table(filter=pc.field("block") == block).sort_by("shard")
    pieces = [
        np.unpackbits(np.frombuffer(bits, dtype=np.uint8), count=size)
        for bits, size in zip(rows["bits"].to_pylist(), rows["size"].to_pylist(), strict=True)
    ]
    found = np.concatenate(pieces).astype(bool) if pieces else np.zeros(0, dtype=bool)
    if len(found) != n:
        raise ValueError(f"block {block}: {len(found)} answers for {n} windows")
    return found


ANSWER = "block long, part int, shard int, size int, bits binary"


def stored_answers(rows: DataFrame) -> str:
    path = scratch_path(rows.sparkSession, "substring-answers")
    rows.repartition("part").write.partitionBy("part").parquet(path)
    return path


def repeated_cells(pdf: pd.DataFrame) -> pd.DataFrame:
    """Merge a shard's cells of all blocks; answer which of each block's cells count two or more."""
    sent = [unsqueezed(c) for c in pdf["cells"]]
    merged = np.sort(np.concatenate(sent))
    repeated = np.unique(merged[1:][merged[1:] == merged[:-1]])
    out = []
    for cells, packed_mask in zip(sent, pdf["own"], strict=True):
        # a cell is sent twice if the block has it in several documents or windows
        mask = np.unpackbits(np.frombuffer(packed_mask, dtype=np.uint8), count=len(cells)).astype(bool)
        mine = cells[mask]
        at = np.minimum(np.searchsorted(repeated, mine), max(0, len(repeated) - 1))
        hit = repeated[at] == mine if len(repeated) else np.zeros(len(mine), dtype=bool)
        out.append((len(mine), np.packbits(hit).tobytes()))
    return pd.DataFrame({"block": pdf["block"], "part": pdf["part"], "shard": pdf["shard"], "size": [n for n, _ in out], "bits": [b for _, b in out]})


def later_windows(pdf: pd.DataFrame) -> pd.DataFrame:
    """Group a shard's windows exactly; answer which of each block's have a smaller id elsewhere."""
    sizes = [len(x) // 8 for x in pdf["ids"]]
    first, second = (np.frombuffer(b"".join(pdf[c]), dtype="<u8") for c in ("first", "second"))
    ids = np.frombuffer(b"".join(pdf["ids"]), dtype="<i8")
    order = np.lexsort((second, first))
    f, s = first[order], second[order]
    starts = np.flatnonzero(np.concatenate([[True], (f[1:] != f[:-1]) | (s[1:] != s[:-1])])) if len(f) else np.zeros(0, dtype=np.int64)
    low = np.minimum.reduceat(ids[order], starts) if len(f) else ids
    least = np.empty(len(f), dtype=np.int64)
    least[order] = np.repeat(low, np.diff(np.append(starts, len(f))))
    late, at, bits = least < ids, 0, []
    for n in sizes:
        bits.append(np.packbits(late[at : at + n]).tobytes())
        at += n
    return pd.DataFrame({"block": pdf["block"], "part": pdf["part"], "shard": pdf["shard"], "size": sizes, "bits": bits})


def deduplicated(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    keep: list[str] | None = None,
    width: int = WIDTH,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document: the columns ``keep``, ``n_words``, ``n_removed`` and ``kept_text``, the kept words joined by one space."""
    keep = [doc_id] if keep is None else keep
    blocks = blocks_of(docs, text, doc_id, keep, block_bytes)
    n_blocks = max(1, blocks.select("block").count())
    shards = max(MIN_SHARDS, n_blocks * block_bytes // 6 // WINDOWS_PER_SHARD)
    bits = int(shards - 1).bit_length()
    parts = max(1, n_blocks // 16)
    blocks = blocks.withColumn("part", F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int"))
    narrow = blocks.select("block", "part", "ids", "texts")

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, part, _, own in each_block(batches, width):
            shard, cell = own.sketched(bits)
            times = np.where(own.several, 2, 1)
            many = np.repeat(np.arange(len(cell)), times)
            mask = np.concatenate([[True], many[1:] != many[:-1]]) if len(many) else np.zeros(0, dtype=bool)
            ends = np.searchsorted(shard[many], np.arange((1 << bits) + 1))
            filled = [k for k in range(1 << bits) if ends[k] < ends[k + 1]]
            sent = cell[many]
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array(filled, pa.int32()),
                    "block": pa.array([block] * len(filled), pa.int64()),
                    "part": pa.array([part] * len(filled), pa.int32()),
                    "cells": pa.array([squeezed(sent[ends[k] : ends[k + 1]]) for k in filled], pa.binary()),
                    "own": pa.array([np.packbits(mask[ends[k] : ends[k + 1]]).tobytes() for k in filled], pa.binary()),
                }
            )

    cells = narrow.mapInArrow(sketch, "shard int, block long, part int, cells binary, own binary")
    estimated = stored_answers(cells.groupBy("shard").applyInPandas(repeated_cells, ANSWER))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, part, _, own in each_block(batches, width):
            chosen = answers(estimated, part, block, len(own.first))
            shard = own.sketched(bits)[0][chosen]
            first, second, ids = own.first[chosen], own.second[chosen], own.low[chosen]
            ends = np.searchsorted(shard, np.arange((1 << bits) + 1))
            filled = [k for k in range(1 << bits) if ends[k] < ends[k + 1]]

            def cut(values: np.ndarray, kind: str, ends=ends, filled=filled) -> pa.Array:
                return pa.array([values[ends[k] : ends[k + 1]].astype(kind).tobytes() for k in filled], pa.binary())

            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array(filled, pa.int32()),
                    "block": pa.array([block] * len(filled), pa.int64()),
                    "part": pa.array([part] * len(filled), pa.int32()),
                    "first": cut(first, "<u8"),
                    "second": cut(second, "<u8"),
                    "ids": cut(ids, "<i8"),
                }
            )

    sent = narrow.mapInArrow(exact, "shard int, block long, part int, first binary, second binary, ids binary")
    later = stored_answers(sent.groupBy("shard").applyInPandas(later_windows, ANSWER))

    row = blocks.schema["rows"].dataType.elementType
    schema = T.StructType(
        [
            T.StructField("_row", row),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("kept_text", T.StringType()),
        ]
    )

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, part, rows, own in each_block(batches, width):
            chosen = answers(estimated, part, block, len(own.first))
            late = np.zeros(len(own.first), dtype=bool)
            late[chosen] = answers(later, part, block, int(chosen.sum()))
            gone = late[own.entry] | (own.own_id > own.low[own.entry])
            n = int(own.sizes.sum())
            change = np.zeros(n + 1, dtype=np.int32)
            np.add.at(change, own.at[gone], 1)
            np.add.at(change, own.at[gone] + width, -1)
            covered = np.cumsum(change[:n]) > 0
            ends = np.cumsum(own.sizes)
            removed, kept = [], []
            for words, end in zip(own.words, ends.tolist(), strict=True):
                mask = covered[end - len(words) : end]
                k = int(mask.sum())
                removed.append(k)
                left = words if k == 0 else [w for w, out in zip(words, mask.tolist(), strict=True) if not out]
                kept.append(b" ".join(left).decode())
            yield pa.RecordBatch.from_arrays(
                [rows, pa.array(own.sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], schema.names
            )

    done = blocks.select("block", "part", "rows", "ids", "texts").mapInArrow(remove, schema)
    return done.select(*[F.col(f"_row.`{c}`").alias(c) for c in keep], "n_words", "n_removed", "kept_text")
