"""Collocations from suffix subtrees, after vertical partitioning by word prefixes.

1. Words: ASCII capitals lowered, texts cut into pieces at punctuation and line ends, pieces into words. Spark counts the words of each language.
2. Vertical partitioning: the suffixes that start with one word belong together. A word with more occurrences than a share of the memory budget
   is extended to prefixes of two words, one with very many to three. Prefixes are dealt to groups by hash, as many groups as the budget asks for.
   Only the words to be extended are named: ``MOST_EXTENDED`` at most.
3. A block of texts sends every group its suffixes, cut after ``DEPTH`` words or at the end of the piece. Equal ones go once, with a count, so
   a passage in a third of all texts is one entry per block.
4. Each group builds its depth-truncated subtree on its own: distinct suffixes in order are the leaves, a node's count is the total of the
   leaves below it. Nodes with ``least`` occurrences are phrases. Nodes above the end of an extended prefix have leaves in several groups;
   their parts are added up afterwards.
5. A candidate's parts occur at least as often as itself, so they are phrases too: their counts come by equality joins. Ranking keeps
   the best of each (language, hash) first, then the best of each language.

Arithmetic is exact: counts are BIGINT, products decimals of 38 digits. NULL texts are empty, NULL languages are ``und``. Repeated rows count again. Pieces of one
word give words only. Extra columns are ignored. An empty table gives no phrase.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.common import mapped, packed, stored, unpacked, write_file
from meterlake.session import scratch_path

DEPTH = 4
LEAST = 30
CONTAINED_PCT = 80
TOP = 2_000
BUDGET = 1_000_000
MOST_EXTENDED = 100_000
VERY_MANY = 64
BLOCK_BYTES = 2 << 20
RANK_PARTS = 32

# a full stop cannot be in a word: it stands for the end of a piece
END = b"."
CUTS = bytes(ord(".") if chr(c) in ".,;:!?\n\x0b\x0c\r" else c for c in range(256))


def blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[str, pa.DictionaryArray]]:
    """The words of each language in steps of about ``size`` bytes, pieces ended by :data:`END`. A longer text is a step of its own."""
    for batch in batches:
        texts, langs = batch.column("text"), batch.column("lang").to_pylist()
        for lang in dict.fromkeys(langs):
            held, used = [], 0
            for k in [k for k, own in enumerate(langs) if own == lang]:
                text = texts[k].as_buffer()
                if text is None:
                    continue
                held.append(text.to_pybytes())
                used += len(held[-1])
                if used >= size:
                    yield lang, coded(held)
                    held, used = [], 0
            if held:
                yield lang, coded(held)


def coded(texts: list[bytes]) -> pa.DictionaryArray:
    whole = b"\n".join(texts).lower().translate(CUTS).replace(END, b" . ")
    return pa.array([END, *whole.split(), END], pa.binary()).dictionary_encode()


def rows_of(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(f"`{lang}`"), F.lit("und")).alias("lang"), F.col(f"`{text}`").alias("text"))


def word_counts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """``lang, word, n`` of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, own in blocks(batches, BLOCK_BYTES):
            n = np.bincount(own.indices.to_numpy(), minlength=len(own.dictionary))[1:]
            words = own.dictionary.slice(1)
            yield pa.RecordBatch.from_pydict(
                {"lang": pa.array([lang] * len(words), pa.string()), "word": words.cast(pa.string()), "n": pa.array(n, pa.int64())}
            )

    counted = rows_of(docs, text, lang).mapInArrow(run, "lang string, word string, n bigint")
    return stored(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")), "phrase-words")


def word_key(lang: str, word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, xxhash.xxh32_intdigest(lang.encode()))


def spread(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def narrow(values: np.ndarray) -> bytes:
    """Numbers in as few bytes as the largest needs, the width first."""
    top = int(values.max()) if len(values) else 0
    kind = next(k for k in ("u1", "<u2", "<u4", "<u8") if top <= np.iinfo(k).max)
    return bytes([np.dtype(kind).itemsize]) + values.astype(kind).tobytes()


def widened(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=f"<u{data[0]}", offset=1).astype(np.int64)


def windows(w: np.ndarray) -> np.ndarray:
    """A row of ``DEPTH`` codes for every word: itself and those after it; the code 0 from the end of the piece on."""
    n = len(w) - 1
    out = np.zeros((n, DEPTH), dtype=np.int64)
    alive = np.ones(n, dtype=bool)
    for k in range(DEPTH):
        own = np.zeros(n, dtype=np.int64)
        own[: n - k] = w[k:n]
        alive &= own != 0
        out[:, k] = own * alive
    return out[out[:, 0] != 0]


def ordered(rows: np.ndarray, counts: np.ndarray, types: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in order, with the sums of their counts."""
    if not len(rows):
        return rows, counts
    pairs, key = np.unique(rows[:, 0] * types + rows[:, 1], return_inverse=True)
    rest, low = np.unique(rows[:, 2] * types + rows[:, 3], return_inverse=True)
    key = key * len(rest) + low
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return rows[order[first]], np.add.reduceat(counts[order], first)


def suffixes(docs: DataFrame, text: str, lang: str, n_groups: int, extended: str) -> DataFrame:
    """``group, lang, words, codes, counts``: what each block has for each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named = unpacked(mapped(extended))
        for lang, own in blocks(batches, BLOCK_BYTES):
            types = len(own.dictionary)
            w = windows(own.indices.to_numpy().astype(np.int64))
            rows, counts = ordered(w, np.ones(len(w), dtype=np.int64), types)
            if not len(rows):
                continue
            listed = own.dictionary.to_pylist()
            keys = np.array([word_key(lang, x) for x in listed], dtype=np.uint64)
            at = np.searchsorted(named["key"], keys)
            at[at == len(named["key"])] = 0
            length = np.where(named["key"][at] == keys, named["length"][at], 1) if len(named["key"]) else np.ones(types, dtype=np.int64)
            prefix = keys[rows[:, 0]]
            for k in (1, 2):
                longer = length[rows[:, 0]] > k
                prefix = np.where(longer, spread(prefix) + keys[rows[:, k]], prefix)
            group = (spread(prefix) % np.uint64(n_groups)).astype(np.int64)
            order = np.argsort(group, kind="stable")
            cuts = np.flatnonzero(np.diff(group[order])) + 1
            out: dict[str, list] = {c: [] for c in ("group", "lang", "words", "codes", "counts")}
            for part in np.split(order, cuts):
                used, code = np.unique(rows[part], return_inverse=True)
                # the code 0 is the end of a piece in every block
                if used[0] != 0:
                    used, code = np.append(0, used), code + 1
                out["group"].append(int(group[part[0]]))
                out["lang"].append(lang)
                out["words"].append([listed[k] for k in used[1:].tolist()])
                out["codes"].append(narrow(code.reshape(-1)))
                out["counts"].append(narrow(counts[part]))
            kinds = {"group": pa.int32(), "lang": pa.string(), "words": pa.list_(pa.binary()), "codes": pa.binary(), "counts": pa.binary()}
            yield pa.RecordBatch.from_pydict({c: pa.array(x, kinds[c]) for c, x in out.items()})

    schema = "group int, lang string, words array<binary>, codes binary, counts binary"
    return rows_of(docs, text, lang).mapInArrow(run, schema)


def subtree(part: pa.Table, least: int, length_of: dict) -> Iterator[pa.RecordBatch]:
    """The phrases of one language in one group: ``lang, size, phrase, n, whole``; the counts of nodes above the end of an extended
    prefix are parts and not held against ``least``."""
    lang = part.column("lang")[0].as_py()
    lists = part.column("words").combine_chunks()
    merged = pa.concat_arrays([pa.array([END], pa.binary()), lists.flatten().cast(pa.binary())]).dictionary_encode()
    codes, words = merged.indices.to_numpy()[1:].astype(np.int64), merged.dictionary
    types = len(words)
    sizes = pc.list_value_length(lists).to_numpy()
    ends = np.cumsum(sizes)
    blocks, counts = [], []
    for a, b, own, n in zip(ends - sizes, ends, part.column("codes").to_pylist(), part.column("counts").to_pylist(), strict=True):
        blocks.append(np.append(0, codes[a:b])[widened(own)].reshape(-1, DEPTH))
        counts.append(widened(n))
    rows, counts = ordered(np.concatenate(blocks), np.concatenate(counts), types)
    keys = np.array([word_key(lang, x) for x in words.to_pylist()], dtype=np.uint64)
    at = np.searchsorted(length_of["key"], keys)
    at[at == len(length_of["key"])] = 0
    known = length_of["key"][at] == keys if len(length_of["key"]) else np.zeros(types, dtype=bool)
    length = np.where(known, length_of["length"][at] if len(length_of["key"]) else 1, 1)
    new = np.zeros(len(rows), dtype=bool)
    new[0] = True
    for k in range(DEPTH):
        new[1:] |= rows[1:, k] != rows[:-1, k]
        first = np.flatnonzero(new)
        total = np.add.reduceat(counts, first)
        top = rows[first]
        whole = length[top[:, 0]] <= k + 1
        kept = (top[:, k] != 0) & (~whole | (total >= least))
        top, total, whole = top[kept], total[kept], whole[kept]
        phrase = words.take(pa.array(top[:, 0]))
        for j in range(1, k + 1):
            phrase = pc.binary_join_element_wise(phrase, words.take(pa.array(top[:, j])), pa.scalar(b" ", pa.binary()))
        yield pa.RecordBatch.from_pydict(
            {
                "lang": pa.array([lang] * len(top), pa.string()),
                "size": pa.array(np.full(len(top), k + 1), pa.int32()),
                "phrase": phrase.cast(pa.string()),
                "n": pa.array(total, pa.int64()),
                "whole": pa.array(whole, pa.bool_()),
            }
        )


def phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, budget: int = BUDGET) -> tuple[DataFrame, DataFrame]:
    """``lang, size, phrase, n`` of all phrases of 1 to ``DEPTH`` words with ``least`` occurrences, and the word counts ``lang, word, n``."""
    spark = docs.sparkSession
    words = word_counts(docs, text, lang)
    total = words.agg(F.sum("n")).first()[0] or 0
    n_groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // budget))
    # the counts add up to total, so at most MOST_EXTENDED words are over this limit
    limit = max(total // n_groups // 8, total // MOST_EXTENDED, 1)
    named = words.filter(F.col("n") > limit).collect()
    keys = np.array([word_key(r["lang"], r["word"].encode()) for r in named], dtype=np.uint64)
    length = np.array([3 if r["n"] > VERY_MANY * limit else 2 for r in named], dtype=np.int64)
    order = np.argsort(keys)
    extended = f"{scratch_path(spark, 'phrase-prefixes')}/extended.bin"
    write_file(extended, packed({"key": keys[order], "length": length[order]}))

    def grow(part: pa.Table) -> pa.Table:
        length_of = unpacked(mapped(extended))
        made = []
        for own in pc.unique(part.column("lang")):
            made += subtree(part.filter(pc.equal(part.column("lang"), own)), least, length_of)
        return pa.Table.from_batches(made)

    found = suffixes(docs, text, lang, n_groups, extended).groupBy("group").applyInArrow(grow, "lang string, size int, phrase string, n bigint, whole boolean")
    found = stored(found, "phrase-nodes")
    parts = found.filter(~F.col("whole")).groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    return found.filter("whole").drop("whole").unionByName(parts), words


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    contained_pct: int = CONTAINED_PCT,
    top: int = TOP,
    budget: int = BUDGET,
) -> DataFrame:
    """Each language's best phrases of 2 to ``DEPTH`` words: ``lang, rank, phrase, a, l, r, n, score``.

    A phrase is scored at its weakest cut into two parts, and dropped where one longer phrase with ``contained_pct`` percent of its
    occurrences contains it.
    """
    known, words = phrases(docs, text, lang, least, budget)
    known = stored(known, "phrase-known")
    candidates = known.filter(F.col("size") > 1).withColumn("w", F.split("phrase", " "))

    def cut_from(start, size):
        return F.array_join(F.slice("w", start, size), " ")

    # every way to cut a candidate, and every shorter phrase of two words or more inside it
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", F.col("n").alias("a"), "k", cut_from(F.lit(1), F.col("k")).alias("left"), cut_from(F.col("k") + 1, F.col("size") - F.col("k")).alias("right")
    )
    counts = known.select(F.col("lang").alias("of_lang"), F.col("phrase").alias("of"), F.col("n").alias("of_n"))

    def counted(df: DataFrame, part: str, name: str) -> DataFrame:
        same = (F.col("lang") == F.col("of_lang")) & (F.col(part) == F.col("of"))
        return df.join(counts, same).drop("of_lang", "of").withColumnRenamed("of_n", name)

    both = counted(counted(cuts, "left", "l"), "right", "r")
    wide = "decimal(38,0)"
    ratio = F.call_function("div", F.col("a").cast(wide) * F.lit(2_000_000).cast(wide), F.col("l").cast(wide) + F.col("r").cast(wide))
    weakest = both.withColumn("score", ratio.cast("long")).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    inner = candidates.filter(F.col("size") > 2).withColumn("m", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    inner = inner.withColumn("s", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)))
    longest = inner.select("lang", cut_from(F.col("s"), F.col("m")).alias("phrase"), "n").groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    left = weakest.join(longest, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.col("longer").cast(wide) * 100 < F.col("a").cast(wide) * contained_pct)
    )
    rows = left.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # few rows of a language go on from each of a fixed number of parts
    rows = rows.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    rows = rows.withColumn("_near", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*best))).filter(F.col("_near") <= top)
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).filter(F.col("rank") <= top)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n")).withColumnRenamed("lang", "of_lang")
    return ranked.join(totals, F.col("lang") == F.col("of_lang")).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
