"""Interpolated modified Kneser-Ney model of order 2 or 3, counted in Spark and memory-mapped by workers.

1. Words are counted: tasks send sorted 64-bit word hashes with counts, packed, to shards by the leading hash bits. Each shard writes one sorted
   array. A word's number is its place in the order of all shards.
2. Bigrams are counted: tasks send the sorted numbers of their distinct word pairs as differences, with counts. Each shard writes its pairs as a
   sorted array of hashes with counts, and reports counts of counts and, per word, how many different words follow it once, twice or more often and how many
   precede it.
3. Those per-word figures are summed by word shard and written beside the words.
4. For order 3, word triples are counted before the pairs, in shards by their first two words. A shard writes each context with its figures and, as one run, the
   words behind it with counts; it sends on how many different words precede each pair. Pairs then carry these continuation counts; pairs at the beginning of a
   text, which nothing precedes, keep their own counts.
5. Texts are scored where they lie: workers map the files and look up their distinct words and pairs, sorted.

Every step grows with the corpus and is divided by hash, so a word in a third of all places costs one entry per task. Only totals reach the driver.
The files lie in the shared folder under names that a repeated task writes again with the same content. Word numbers fill half of a pair's
64 bits: at most 2**31 different words.

The model: ``p(w | v) = max(c(vw) - D, 0) / c(v) + g(v) * p1(w)`` with three discounts from counts of counts; ``p1`` is the same over the number of
different words before ``w``, down to one share in ``V + 1`` for the unknown word. A text starts behind a mark that is no token.
With order 3, ``p(w | uv)`` is the same over triples with ``p(w | v)`` below it, which then uses continuation counts; the first token of a text has ``v`` alone.

NULL and empty texts are one end token. Documents with a NULL id belong to the training part. Repeated rows count each time. With no training
documents every word is unknown and has probability 1; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.llm.common import mapped, packed, stored, unpacked, write_file
from meterlake.llm.substrings import mixed, squeezed, unsqueezed
from meterlake.session import scratch_path

# fixed values: hashes of the marks before and after a text
START, END = np.uint64(0x5A17), np.uint64(0xE2D)
CHUNK_CHARS = 3_000_000
# triples are counted in steps of so many bytes of text, which bounds what a worker holds
STEP_CHARS = 4_000_000
# word shards: one per so many bytes of text, between 2**5 and 2**16
BYTES_PER_WORD_SHARD = 128 << 20
WORD_BITS = (5, 16)
PAIRS_PER_SHARD = 4_000_000
MIN_PAIR_BITS = 5
TRIPLES_PER_SHARD = 2_000_000
LOW = np.int64(0xFFFFFFFF)
SHORT_RUN = 4


def token_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's words and its end mark, one after the other, and the number of tokens per text."""
    hashes, sizes = [], []
    a = 0
    while a < len(texts):
        b, chars = a, 0
        while b < len(texts) and (b == a or chars + len(texts[b] or "") < CHUNK_CHARS):
            chars += len(texts[b] or "")
            b += 1
        words = [(t or "").encode().lower().split() for t in texts[a:b]]
        coded = pa.array([w for own in words for w in own], pa.binary()).dictionary_encode()
        # the marks' small numbers are kept free
        by_word = np.array([xxhash.xxh64_intdigest(w) | (1 << 20) for w in coded.dictionary.to_pylist()], dtype=np.uint64)
        own = by_word[coded.indices.to_numpy()] if len(by_word) else np.zeros(0, dtype=np.uint64)
        n = np.array([len(w) for w in words], dtype=np.int64)
        hashes.append(np.insert(own, np.cumsum(n), END))
        sizes.append(n + 1)
        a = b
    if not sizes:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    return np.concatenate(hashes), np.concatenate(sizes)


def before(tokens: np.ndarray, sizes: np.ndarray, mark) -> np.ndarray:
    """The token in front of each, the start mark at the beginning of a text."""
    out = np.empty_like(tokens)
    out[1:] = tokens[:-1]
    out[np.cumsum(sizes) - sizes] = mark
    return out


def sealed(data: bytes) -> bytes:
    """Packed numbers as they travel: entropy coding takes the unused bits of the leading bytes, which Spark's own codec leaves."""
    return zstandard.ZstdCompressor(level=1).compress(data)


def opened(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def counts_to_bytes(counts: np.ndarray) -> bytes:
    """Small counts as one byte, larger ones behind a mark."""
    small = np.minimum(counts, 255).astype(np.uint8)
    return small.tobytes() + counts[counts >= 255].astype("<i8").tobytes()


def counts_from_bytes(data: bytes, n: int) -> np.ndarray:
    out = np.frombuffer(data, dtype=np.uint8, count=n).astype(np.int64)
    out[out == 255] = np.frombuffer(data, dtype="<i8", offset=n)
    return out


def text_steps(texts: pa.Array, chars: int) -> Iterator[list[str | None]]:
    """The texts of a batch in steps of about so many bytes; a longer text is a step of its own."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    group = (np.cumsum(sizes) - sizes) // chars
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if a < b:
            yield texts.slice(a, b - a).to_pylist()


def triples_of(texts: list[str | None], lexicon, first: dict[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context (two words), word and count of each distinct triple, in order. Two marks stand before the first token of a text."""
    tokens, sizes = token_hashes(texts)
    known, code = np.unique(np.append(tokens, START), return_inverse=True)
    number = lexicon.places(known, first)[code]
    own, start = number[:-1], number[-1]
    front = before(own, sizes, start)
    contexts, code = np.unique(before(front, sizes, start) << np.int64(32) | front, return_inverse=True)
    triples, counts = np.unique(code << np.int64(32) | own, return_counts=True)
    return contexts[triples >> np.int64(32)], (triples & LOW).astype(np.uint32), counts.astype(np.uint32)


def merged_triples(steps: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if len(steps) == 1:
        return (*steps[0][:2], steps[0][2].astype(np.int64))
    if not steps:
        return (np.zeros(0, dtype=np.int64),) * 3
    left, right, counts = (np.concatenate([step[k] for step in steps]) for k in range(3))
    steps.clear()
    order = np.lexsort((right, left))
    left, right, counts = left[order], right[order], counts[order]
    fresh = np.flatnonzero(np.concatenate([[True], (left[1:] != left[:-1]) | (right[1:] != right[:-1])]))
    return left[fresh], right[fresh], np.add.reduceat(counts, fresh, dtype=np.int64)


def cut_points(shards: np.ndarray, n: int) -> tuple[list[int], np.ndarray]:
    ends = np.searchsorted(shards, np.arange(n + 1))
    return [k for k in range(n) if ends[k] < ends[k + 1]], ends


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with summed counts."""
    every, times = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(every, kind="stable")
    every, times = every[order], times[order]
    starts = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
    return every[starts], np.add.reduceat(times, starts)


def trimmed(values: np.ndarray, wide: int) -> bytes:
    """Numbers below 2**32 in so many bytes each."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :wide]).tobytes()


def widened(data: bytes, wide: int) -> np.ndarray:
    raw = np.frombuffer(data, dtype=np.uint8).reshape(-1, wide)
    out = np.zeros((len(raw), 4), dtype=np.uint8)
    out[:, :wide] = raw
    return out.view("<u4").ravel().astype(np.int64)


def escaped(name: str, values: np.ndarray) -> dict[str, np.ndarray]:
    """Small values as one byte, larger ones by their places."""
    large = np.flatnonzero(values >= 255)
    return {name: np.minimum(values, 255).astype(np.uint8), f"{name}_at": large.astype(np.int64), f"{name}_large": values[large].astype(np.int64)}


def run_figures(table: dict, at: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[np.ndarray]:
    """What the counts of the runs ``at``, from ``low`` to ``high``, sum to, and how many are one and two; zero for empty runs. Only long runs have them stored."""
    size = high - low
    far = np.flatnonzero(size > SHORT_RUN)
    out = [np.zeros(len(at), dtype=np.int64) for _ in range(3)]
    for length in range(1, SHORT_RUN + 1):
        own = np.flatnonzero(size == length)
        counts = looked_up(table, "count", (low[own][:, None] + np.arange(length)).ravel()).reshape(-1, length)
        for values, part in zip(out, (counts, counts == 1, counts == 2), strict=True):
            values[own] = part.sum(axis=1) if length > 1 else part[:, 0]
    if len(far):
        stored_at = np.searchsorted(table["long"], at[far])
        for values, name in zip(out, ("after", "once", "twice"), strict=True):
            values[far] = looked_up(table, name, stored_at)
    return out


def looked_up(table: dict, name: str, at: np.ndarray) -> np.ndarray:
    out = table[name][at].astype(np.int64)
    big = np.flatnonzero(out == 255)
    if len(big):
        out[big] = table[f"{name}_large"][np.searchsorted(table[f"{name}_at"], at[big])]
    return out


def place_in_run(values: np.ndarray, low: np.ndarray, high: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """The place of each asked value in its own rising run ``low`` to ``high``, -1 if it is not there."""
    a, b, last = low.copy(), high.copy(), max(0, len(values) - 1)
    while (a < b).any():
        mid = (a + b) // 2
        below = (a < b) & (values[np.minimum(mid, last)] < asked)
        b = np.where((a < b) & ~below, mid, b)
        a = np.where(below, mid + 1, a)
    return np.where((a < high) & (values[np.minimum(a, last)] == asked), a, -1) if len(values) else np.full(len(asked), -1)


class Words:
    """The word shards of a model, opened when needed; with ``figures`` also what is known of each word."""

    def __init__(self, folder: str, bits: int, shards: list[int], figures: bool = False):
        self.folder, self.bits, self.shards, self.figures = folder, np.uint64(bits), shards, figures
        self.listed, self.opened = set(shards), {}

    def table(self, k: int) -> dict:
        if k not in self.opened:
            self.opened[k] = unpacked(mapped(f"{self.folder}/words-{k}.bin"))
            if self.figures:
                self.opened[k] |= unpacked(mapped(f"{self.folder}/figures-{k}.bin"))
        return self.opened[k]

    def places(self, hashes: np.ndarray, first: dict[int, int]) -> np.ndarray:
        """The number of each of some sorted distinct hashes, -1 for unknown ones."""
        out = np.full(len(hashes), -1, dtype=np.int64)
        filled, ends = cut_points((hashes >> (np.uint64(64) - self.bits)).astype(np.int64), 1 << int(self.bits))
        for k in filled:
            if k in self.listed:
                known, own = self.table(k)["hash"], hashes[ends[k] : ends[k + 1]]
                at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                out[ends[k] : ends[k + 1]] = np.where(known[at] == own, at + first[k], -1)
        return out

    def columns(self, names: list[str], places: np.ndarray, first: dict[int, int]) -> list[np.ndarray]:
        """Figures of words by their rising numbers, 0 for unknown ones."""
        out = [np.zeros(len(places), dtype=np.float64) for _ in names]
        known = np.flatnonzero(places >= 0)
        own = places[known]
        edges = np.searchsorted(own, [first[k] for k in self.shards] + [1 << 62])
        for k, a, b in zip(self.shards, edges, edges[1:], strict=False):
            if a < b:
                for values, name in zip(out, names, strict=True):
                    values[known[a:b]] = self.table(k)[name][own[a:b] - first[k]]
        return out


def train(docs: DataFrame, text: str = "text", word_bits: int | None = None, order: int = 2) -> dict:
    """Count a model of all rows; returns its description: the folder and totals."""
    if order not in (2, 3):
        raise ValueError(f"order {order}: 2 and 3 are built")
    spark = docs.sparkSession
    folder = scratch_path(spark, "kneser-ney")
    texts = docs.select(F.col(f"`{text}`").alias("text"))
    if word_bits is None:
        size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        word_bits = min(max(WORD_BITS[0], (size // BYTES_PER_WORD_SHARD).bit_length()), WORD_BITS[1])
    n_words = 1 << word_bits

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, sizes = token_hashes(batch.column("text").to_pylist())
            if not len(tokens):
                continue
            hashes, counts = np.unique(np.append(tokens, np.repeat(START, 1)), return_counts=True)
            counts[hashes == START] = len(sizes)
            filled, ends = cut_points((hashes >> np.uint64(64 - word_bits)).astype(np.int64), n_words)
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array(filled, pa.int32()),
                    "hashes": pa.array([hashes[ends[k] : ends[k + 1]].tobytes() for k in filled], pa.binary()),
                    "counts": pa.array([counts_to_bytes(counts[ends[k] : ends[k + 1]]) for k in filled], pa.binary()),
                }
            )

    def write_words(pdf: pd.DataFrame) -> pd.DataFrame:
        shard = int(pdf["shard"].iloc[0])
        keys = [np.frombuffer(h, dtype=np.uint64) for h in pdf["hashes"]]
        hashes, counts = merged(keys, [counts_from_bytes(c, len(k)) for c, k in zip(pdf["counts"], keys, strict=True)])
        write_file(f"{folder}/words-{shard}.bin", packed({"hash": hashes, "count": counts}))
        return pd.DataFrame({"shard": [shard], "n": [len(hashes)], "tokens": [int(counts[hashes != START].sum())]})

    words = stored(
        texts.mapInArrow(count_words, "shard int, hashes binary, counts binary")
        .groupBy("shard")
        .applyInPandas(write_words, "shard int, n long, tokens long"),
        "lm-words",
    )
    # at most one row per word shard
    sizes = {r["shard"]: r["n"] for r in words.collect()}
    tokens = words.agg(F.sum("tokens")).first()[0] or 0
    shards = sorted(sizes)
    first, n = {}, 0
    for k in shards:
        first[k] = n
        n += sizes[k]
    pair_bits = max(MIN_PAIR_BITS, int(tokens // PAIRS_PER_SHARD).bit_length())
    model = {"folder": folder, "word_bits": word_bits, "pair_bits": pair_bits, "shards": shards, "first": first, "tokens": tokens, "types": max(0, n - 1), "order": order}
    n_pairs = 1 << pair_bits

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Words(folder, word_bits, shards)
        for batch in batches:
            tokens, sizes = token_hashes(batch.column("text").to_pylist())
            if not len(tokens):
                continue
            known, code = np.unique(np.append(tokens, START), return_inverse=True)
            number = lexicon.places(known, first)[code]
            own, start = number[:-1], number[-1]
            keys, counts = np.unique(before(own, sizes, start) << np.int64(32) | own, return_counts=True)
            shard = pair_shard(keys, pair_bits)
            order = np.argsort(shard, kind="stable")
            filled, ends = cut_points(shard[order], n_pairs)
            keys, counts = keys[order], counts[order]
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array(filled, pa.int32()),
                    "keys": pa.array([sealed(squeezed_keys(keys[ends[k] : ends[k + 1]])) for k in filled], pa.binary()),
                    "counts": pa.array([sealed(counts_to_bytes(counts[ends[k] : ends[k + 1]])) for k in filled], pa.binary()),
                }
            )

    triple_bits = max(MIN_PAIR_BITS, int(tokens // TRIPLES_PER_SHARD).bit_length())
    wide = max(1, (int(n).bit_length() + 7) // 8)

    def count_triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Words(folder, word_bits, shards)
        for batch in batches:
            steps = [triples_of(texts, lexicon, first) for texts in text_steps(batch.column("text"), STEP_CHARS)]
            left, right, counts = merged_triples(steps)
            if not len(left):
                continue
            fresh = np.flatnonzero(np.concatenate([[True], left[1:] != left[:-1]]))
            contexts, followers = left[fresh], np.diff(np.append(fresh, len(left)))
            shard = pair_shard(contexts, triple_bits)
            order = np.argsort(shard, kind="stable")
            of_triples = np.argsort(np.repeat(shard, followers), kind="stable")
            right, counts = right[of_triples], counts[of_triples]
            contexts, followers = contexts[order], followers[order]
            filled, ends = cut_points(shard[order], 1 << triple_bits)
            at = np.concatenate([[0], np.cumsum(followers)])[ends]
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array(filled, pa.int32()),
                    "contexts": pa.array([sealed(squeezed_keys(contexts[ends[k] : ends[k + 1]])) for k in filled], pa.binary()),
                    "followers": pa.array([sealed(counts_to_bytes(followers[ends[k] : ends[k + 1]])) for k in filled], pa.binary()),
                    "words": pa.array([sealed(trimmed(right[at[k] : at[k + 1]], wide)) for k in filled], pa.binary()),
                    "counts": pa.array([sealed(counts_to_bytes(counts[at[k] : at[k + 1]])) for k in filled], pa.binary()),
                }
            )

    def write_triples(pdf: pd.DataFrame) -> pd.DataFrame:
        shard = int(pdf["shard"].iloc[0])
        start = Words(folder, word_bits, shards).places(np.array([START]), first)[0]
        left, right, times = [], [], []
        for row in zip(pdf["contexts"], pdf["followers"], pdf["words"], pdf["counts"], strict=True):
            c, f, w, k = map(opened, row)
            keys, words = unsqueezed_keys(c), widened(w, wide)
            left.append(np.repeat(keys, counts_from_bytes(f, len(keys))))
            right.append(words)
            times.append(counts_from_bytes(k, len(words)))
        left, right, times = np.concatenate(left), np.concatenate(right), np.concatenate(times)
        order = np.lexsort((right, left))
        left, right, times = left[order], right[order], times[order]
        fresh = np.flatnonzero(np.concatenate([[True], (left[1:] != left[:-1]) | (right[1:] != right[:-1])]))
        left, right, counts = left[fresh], right[fresh], np.add.reduceat(times, fresh)
        # behind two marks stand the pairs that begin a text
        begins = (left & LOW) == start
        first_pairs, first_counts = left[begins] << np.int64(32) | right[begins], counts[begins]
        left, right, counts = left[~begins], right[~begins], counts[~begins]
        runs = np.flatnonzero(np.concatenate([[True], left[1:] != left[:-1]])) if len(left) else np.zeros(0, dtype=np.int64)
        summed = {"after": counts, "once": (counts == 1).astype(np.int64), "twice": (counts == 2).astype(np.int64)}
        table = {"key": left[runs], "start": np.append(runs, len(left)).astype(np.uint32), "word": right.astype(np.uint32)} | escaped("count", counts)
        # short runs are summed when they are asked for
        long = np.flatnonzero(np.diff(np.append(runs, len(left))) > SHORT_RUN)
        table["long"] = long.astype(np.uint32)
        for name, values in summed.items():
            table |= escaped(name, np.add.reduceat(values, runs)[long] if len(runs) else values)
        write_file(f"{folder}/triples-{shard}.bin", packed(table))
        pairs, preceded = np.unique((left & LOW) << np.int64(32) | right, return_counts=True)
        pairs, preceded = np.append(pairs, first_pairs), np.append(preceded, first_counts)
        at = pair_shard(pairs, pair_bits)
        order = np.lexsort((pairs, at))
        pairs, preceded = pairs[order], preceded[order]
        filled, ends = cut_points(at[order], n_pairs)
        rows = [(k, sealed(squeezed_keys(pairs[ends[k] : ends[k + 1]])), sealed(counts_to_bytes(preceded[ends[k] : ends[k + 1]])), None) for k in filled]
        rows.append((-1, None, None, [len(counts), *(int((counts == k).sum()) for k in (1, 2, 3, 4))]))
        return pd.DataFrame(rows, columns=["shard", "keys", "counts", "totals"])

    def write_pairs(pdf: pd.DataFrame) -> pd.DataFrame:
        shard = int(pdf["shard"].iloc[0])
        sent = [unsqueezed_keys(opened(k)) for k in pdf["keys"]]
        keys, counts = merged(sent, [counts_from_bytes(opened(c), len(k)) for c, k in zip(pdf["counts"], sent, strict=True)])
        hashes = mixed(keys.view(np.uint64))
        ranked = np.argsort(hashes, kind="stable")
        large = np.flatnonzero(counts[ranked] >= 255)
        write_file(
            f"{folder}/pairs-{shard}.bin",
            packed(
                {
                    "hash": hashes[ranked],
                    "count": np.minimum(counts[ranked], 255).astype(np.uint8),
                    "large": large.astype(np.int64),
                    "large_count": counts[ranked][large],
                }
            ),
        )
        left, right = keys >> np.int64(32), keys & np.int64(0xFFFFFFFF)
        rows = []
        for kind, own, marked in (("left", left, np.minimum(counts, 3)), ("right", right, np.ones(len(keys), dtype=np.int64))):
            values, where = np.unique(own, return_inverse=True)
            figures = [np.bincount(where, weights=marked == k, minlength=len(values)).astype(np.int64) for k in ((1, 2, 3) if kind == "left" else (1,))]
            if kind == "left" and order > 2:
                figures.append(np.bincount(where, weights=counts, minlength=len(values)).astype(np.int64))
            ranges = np.searchsorted(values, [first[k] for k in shards] + [1 << 62])
            for k, a, b in zip(shards, ranges, ranges[1:], strict=False):
                if a < b:
                    rows.append((k, kind, squeezed(values[a:b] - first[k]), [counts_to_bytes(f[a:b]) for f in figures], None))
        of_counts = [int((counts == k).sum()) for k in (1, 2, 3, 4)]
        rows.append((-1, "totals", None, None, [len(keys), *of_counts]))
        return pd.DataFrame(rows, columns=["shard", "kind", "words", "figures", "totals"])

    if order > 2:
        sent = texts.mapInArrow(count_triples, "shard int, contexts binary, followers binary, words binary, counts binary")
        # stored in between, so that the shuffle of the triples may go before that of the pairs begins
        counted = stored(sent.groupBy("shard").applyInPandas(write_triples, "shard int, keys binary, counts binary, totals array<long>"), "lm-triples")
        model |= {"triple_bits": triple_bits, "triples": _summed(counted.filter("shard < 0"), 5)}
        pairs = counted.filter("shard >= 0").select("shard", "keys", "counts")
        del sent
    else:
        pairs = texts.mapInArrow(count_pairs, "shard int, keys binary, counts binary")
    figures = stored(
        pairs.groupBy("shard")
        .applyInPandas(write_pairs, "shard int, kind string, words binary, figures array<binary>, totals array<long>"),
        "lm-figures",
    )
    model["pairs"] = _summed(figures.filter("kind = 'totals'"), 5)

    def write_figures(pdf: pd.DataFrame) -> pd.DataFrame:
        shard = int(pdf["shard"].iloc[0])
        of_left = ("once", "twice", "more", "after") if order > 2 else ("once", "twice", "more")
        out = {name: np.zeros(sizes[shard], dtype=np.int64) for name in (*of_left, "preceded")}
        for kind, own, parts in zip(pdf["kind"], pdf["words"], pdf["figures"], strict=True):
            at = unsqueezed(own)
            for name, part in zip(of_left if kind == "left" else ("preceded",), parts, strict=True):
                out[name][at] += counts_from_bytes(part, len(at))
        write_file(f"{folder}/figures-{shard}.bin", packed({k: v.astype(np.uint32) if v.max() < 1 << 32 else v for k, v in out.items()}))
        return pd.DataFrame({"totals": [[int(out["preceded"].sum()), *(int((out["preceded"] == k).sum()) for k in (1, 2, 3, 4)), int((out["preceded"] > 0).sum())]]})

    summed = stored(
        figures.filter("shard >= 0").groupBy("shard").applyInPandas(write_figures, "totals array<long>"), "lm-totals"
    )
    model["preceded"] = _summed(summed, 6)
    return model


def _summed(rows: DataFrame, n: int) -> list[int]:
    """The sums of the places of an array column over a few rows."""
    got = rows.agg(*[F.sum(F.col("totals")[k]).alias(f"t{k}") for k in range(n)]).first()
    return [int(x or 0) for x in got]


def pair_shard(keys: np.ndarray, bits: int) -> np.ndarray:
    return (mixed(keys.view(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)


def squeezed_keys(keys: np.ndarray) -> bytes:
    """Rising 64-bit numbers as differences of the fewest whole bytes that most need; larger ones behind."""
    steps = np.diff(keys, prepend=0)
    steps[0] = 0
    wide = max(1, (int(np.quantile(steps, 0.999)).bit_length() + 7) // 8)
    limit = np.int64(1 << (8 * wide - 1)) if wide < 8 else np.int64(1 << 62)
    large = np.flatnonzero(steps >= limit)
    kept = steps.copy()
    kept[large] = 0
    body = np.ascontiguousarray(kept.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :wide]).tobytes()
    head = np.array([len(keys), len(large), keys[0]], dtype="<i8").tobytes()
    return bytes([wide]) + head + large.astype("<i8").tobytes() + steps[large].astype("<i8").tobytes() + body


def unsqueezed_keys(data: bytes) -> np.ndarray:
    wide = data[0]
    n, k, start = np.frombuffer(data, dtype="<i8", count=3, offset=1)
    large = np.frombuffer(data, dtype="<i8", count=k, offset=25)
    jumps = np.frombuffer(data, dtype="<i8", count=k, offset=25 + 8 * k)
    raw = np.frombuffer(data, dtype=np.uint8, offset=25 + 16 * k).reshape(n, wide)
    steps = np.zeros((n, 8), dtype=np.uint8)
    steps[:, :wide] = raw
    steps = steps.view("<i8").ravel().copy()
    steps[large] = jumps
    steps[0] = start
    return np.cumsum(steps)


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """The three modified Kneser-Ney discounts for counts 0, 1, 2, 3 and more, kept between 0 and the count. Where the counts of counts do not give
    one, half of the first count is taken off."""
    if not (n1 and n2 and n3):
        return np.array([0.0, 0.5, 0.5, 0.5])
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.array([0.0, *(min(max(d, 0.0), k) for k, d in enumerate(found, 1))])


class Model:
    """A worker's view of a model."""

    def __init__(self, model: dict):
        self.m = model
        self.words = Words(model["folder"], model["word_bits"], model["shards"], figures=True)
        self.pairs: dict[int, dict] = {}
        self.of_pair = discounts(*model["pairs"][1:5])
        self.of_word = discounts(*model["preceded"][1:5])
        if model["order"] > 2:
            self.triples: dict[int, dict] = {}
            self.of_triple = discounts(*model["triples"][1:5])

    def pair_counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of distinct word pairs, 0 for unseen ones."""
        hashes = mixed(keys.view(np.uint64))
        order = np.argsort(hashes, kind="stable")
        ranked = hashes[order]
        bits = self.m["pair_bits"]
        found = np.zeros(len(keys), dtype=np.int64)
        filled, ends = cut_points((ranked >> np.uint64(64 - bits)).astype(np.int64), 1 << bits)
        for k in filled:
            if k not in self.pairs:
                try:
                    self.pairs[k] = unpacked(mapped(f"{self.m['folder']}/pairs-{k}.bin"))
                except FileNotFoundError:
                    # no pair fell into this shard
                    self.pairs[k] = {"hash": np.zeros(0, dtype=np.uint64)}
            table = self.pairs[k]
            if not len(table["hash"]):
                continue
            own = ranked[ends[k] : ends[k + 1]]
            at = np.minimum(np.searchsorted(table["hash"], own), len(table["hash"]) - 1)
            count = table["count"][at].astype(np.int64)
            big = np.flatnonzero(count == 255)
            if len(big):
                count[big] = table["large_count"][np.searchsorted(table["large"], at[big])]
            found[ends[k] : ends[k + 1]] = np.where(table["hash"][at] == own, count, 0)
        out = np.empty_like(found)
        out[order] = found
        return out

    def triple_figures(self, contexts: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per place in a text: the sum of counts behind its context and how many words follow that once, twice and more often; the count of its triple."""
        known, code = np.unique(contexts, return_inverse=True)
        bits = self.m["triple_bits"]
        shard = pair_shard(known, bits)
        order = np.argsort(shard, kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        triples, where = np.unique(rank[code] << np.int64(32) | words & LOW, return_inverse=True)
        owner, asked = triples >> np.int64(32), triples & LOW
        figures, seen = np.zeros((4, len(known)), dtype=np.int64), np.zeros(len(triples), dtype=np.int64)
        filled, ends = cut_points(shard[order], 1 << bits)
        for k in filled:
            if k not in self.triples:
                try:
                    self.triples[k] = unpacked(mapped(f"{self.m['folder']}/triples-{k}.bin"))
                except FileNotFoundError:
                    # no context fell into this shard
                    self.triples[k] = {"key": np.zeros(0, dtype=np.int64)}
            table, a, b = self.triples[k], ends[k], ends[k + 1]
            if not len(table["key"]):
                continue
            own = known[order[a:b]]
            at = np.minimum(np.searchsorted(table["key"], own), len(table["key"]) - 1)
            hit = table["key"][at] == own
            low = table["start"][at].astype(np.int64)
            high = np.where(hit, table["start"][at + 1].astype(np.int64), low)
            after, once, twice = run_figures(table, at, low, high)
            figures[:, a:b] = after, once, twice, high - low - once - twice
            c, d = np.searchsorted(owner, [a, b])
            run = owner[c:d] - a
            place = place_in_run(table["word"], low[run], high[run], asked[c:d])
            seen[c:d] = np.where(place >= 0, looked_up(table, "count", np.maximum(place, 0)), 0)
        figures[3, figures[0] == 0] = 0
        return figures[:, rank[code]], seen[where]

    def scores(self, texts: list[str | None]) -> dict[str, np.ndarray]:
        tokens, sizes = token_hashes(texts)
        first = self.m["first"]
        known, code = np.unique(np.append(tokens, START), return_inverse=True)
        place = self.words.places(known, first)
        count, preceded, once, twice, more = self.words.columns(["count", "preceded", "once", "twice", "more"], place, first)
        types, n = self.m["types"], self.m["tokens"]

        total, n1, n2, n3, n4, kinds = self.m["preceded"]
        d = self.of_word
        if total:
            rest = (d[1] * n1 + d[2] * n2 + d[3] * (kinds - n1 - n2)) / total
            alone = np.maximum(preceded - d[np.minimum(preceded, 3).astype(int)], 0) / total + rest / (types + 1)
        else:
            alone = np.ones(len(known))
        # what the counts of the pairs behind a word sum to
        after = self.words.columns(["after"], place, first)[0] if self.m["order"] > 2 else count
        d = self.of_pair
        with np.errstate(divide="ignore", invalid="ignore"):
            left_over = np.where(after > 0, (d[1] * once + d[2] * twice + d[3] * more) / after, 1.0)

        own = code[:-1]
        front = before(own, sizes, code[-1])
        both = np.flatnonzero((place[own] >= 0) & (place[front] >= 0))
        seen = np.zeros(len(own), dtype=np.int64)
        if len(both):
            keys, where = np.unique(place[front[both]] << np.int64(32) | place[own[both]], return_inverse=True)
            seen[both] = self.pair_counts(keys)[where]
        with np.errstate(divide="ignore", invalid="ignore"):
            direct = np.where(seen > 0, np.maximum(seen - d[np.minimum(seen, 3)], 0) / after[front], 0.0)
        p = direct + left_over[front] * alone[own]
        starts = np.cumsum(sizes) - sizes
        if self.m["order"] > 2:
            far = before(front, sizes, code[-1])
            inner = (place[far] >= 0) & (place[front] >= 0)
            inner[starts] = False
            at = np.flatnonzero(inner)
            if len(at):
                (total, n1, n2, n3), seen = self.triple_figures(place[far[at]] << np.int64(32) | place[front[at]], place[own[at]])
                d = self.of_triple
                met = total > 0
                at, total, seen = at[met], total[met], seen[met]
                left_over = (d[1] * n1[met] + d[2] * n2[met] + d[3] * n3[met]) / total
                p[at] = np.maximum(seen - d[np.minimum(seen, 3)], 0) / total + left_over * p[at]
        base = np.log10((count + 1) / (n + (types + 1)))
        return {
            "n_tokens": sizes,
            "n_known": np.add.reduceat((count[own] > 0).astype(np.int64), starts),
            "base_score": np.add.reduceat(base[own], starts),
            "score": np.add.reduceat(np.log10(p), starts),
        }


def score(docs: DataFrame, model: dict, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep``, ``n_tokens, n_known, base_score, score`` and ``perplexity`` of each whole text."""
    keep = [] if keep is None else keep
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep], F.lit(0).alias("_")).alias("_row"), F.col(f"`{text}`").alias("_text"))
    told = [T.StructField(c, t) for c, t in (("n_tokens", T.LongType()), ("n_known", T.LongType()), ("base_score", T.DoubleType()), ("score", T.DoubleType()))]
    schema = T.StructType([rows.schema["_row"], *told])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(model)
        for batch in batches:
            texts, a = batch.column("_text").to_pylist(), 0
            while a < len(texts):
                b, chars = a, 0
                while b < len(texts) and (b == a or chars + len(texts[b] or "") < 2 * CHUNK_CHARS):
                    chars += len(texts[b] or "")
                    b += 1
                found = own.scores(texts[a:b])
                made = [pa.array(found["n_tokens"], pa.int64()), pa.array(found["n_known"], pa.int64())]
                made += [pa.array(found[c], pa.float64()) for c in ("base_score", "score")]
                yield pa.RecordBatch.from_arrays([batch.column("_row").slice(a, b - a), *made], schema.names)
                a = b

    scored = rows.mapInArrow(run, schema)
    perplexity = F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))
    return scored.select(*[F.col(f"_row.`{c}`").alias(c) for c in keep], *[f.name for f in told], perplexity.alias("perplexity"))
