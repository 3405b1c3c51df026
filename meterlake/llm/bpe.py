"""Byte-level BPE encoding and decoding with a transducer lexicon.

The frequent pre-tokens of the corpus, counted over all documents, are compiled into a minimal acyclic
automaton whose suffixes are shared. The numbers on its arcs add up to a word's place in a table of id sequences, so a walk maps bytes to
token ids. The automaton, the merge table and the token bytes form one file in the shared folder, which workers
memory-map. Words outside the lexicon are merged exactly, so the lexicon decides speed and never results.

Texts stay in their partition. A worker handles a few MB of text at a time; its cache of known words is bounded. Only the most
frequent ``lexicon_words`` entries reach the driver.

NULL text is encoded as empty: no ids. Strings of special tokens in a text become their ids, as the tokenizers library
does by default. Repeated rows are encoded alike; an empty table stays empty; extra columns are packed into ``_row``.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.llm.common import mapped, packed, stored, unpacked, write_file
from meterlake.session import scratch_path

LEXICON_WORDS = 65_536
CACHED_WORDS = 200_000
CHUNK_CHARS = 2_000_000
LONG_WORD = 48
NEVER = np.int64(1 << 40)

# fixed value: the pre-token pattern of the vocabulary, white space as Unicode defines it
SPACE = r"\t-\r \x85\xa0  -     　"
PATTERN = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
# the same for the JVM, where it only chooses words for the lexicon
JVM_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable Latin-1 characters for themselves, the
    others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


def tokenizer_tables(path: str) -> dict:
    """Arrays of a byte-level BPE vocabulary file: merges sorted by pair, first ids, token bytes, special tokens."""
    with open(path, encoding="utf-8") as handle:
        spec = json.load(handle)
    vocab, letters = spec["model"]["vocab"], byte_letters()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    size = max([*vocab.values(), *special.values()]) + 1
    content = [b""] * size
    for token, i in vocab.items():
        content[i] = bytes(letters[c] for c in token)
    for token, i in special.items():
        content[i] = token.encode()
    merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
    keys = np.array([vocab[a] * size + vocab[b] for a, b in merges], dtype=np.int64)
    made = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
    order = np.argsort(keys, kind="stable")
    first = np.zeros(256, dtype=np.int64)
    for letter, b in letters.items():
        first[b] = vocab[letter]
    ends = np.cumsum([len(c) for c in content])
    names = sorted(special, key=lambda t: (-len(t), t))
    return {
        "pair": keys[order],
        "rank": order.astype(np.int64),
        "made": made[order],
        "first": first,
        "bytes": np.frombuffer(b"".join(content), dtype=np.uint8),
        "ends": ends.astype(np.int64),
        "special_ids": np.array([special[t] for t in names], dtype=np.int64),
        "special": np.frombuffer("\0".join(names).encode(), dtype=np.uint8),
    }


class Merger:
    """Exact merges: many short words at once, long ones with a queue."""

    def __init__(self, tables: dict):
        self.pair, self.rank, self.made, self.first = (tables[k] for k in ("pair", "rank", "made", "first"))
        self.size = np.int64(len(tables["ends"]))

    def ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and product of neighbouring tokens; ``NEVER`` where they do not merge."""
        key = np.where((left < 0) | (right < 0), -1, left * self.size + right)
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        hit = self.pair[at] == key
        return np.where(hit, self.rank[at], NEVER), np.where(hit, self.made[at], -1)

    def merge(self, words: list[bytes]) -> list[tuple[int, ...]]:
        out: list = [None] * len(words)
        by_length: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            by_length.setdefault(len(w), []).append(k)
        for n, own in by_length.items():
            if n > LONG_WORD:
                for k in own:
                    out[k] = self._long(words[k])
                continue
            grid = self.first[np.frombuffer(b"".join(words[k] for k in own), dtype=np.uint8).reshape(-1, n)]
            for k, ids in zip(own, self._grid(grid), strict=True):
                out[k] = ids
        return out

    def _grid(self, ids: np.ndarray) -> list[tuple[int, ...]]:
        """Words of one length, one row each: in every round the lowest-ranked, leftmost pair of each row merges."""
        rows, n = ids.shape
        length = np.full(rows, n)
        if n > 1:
            rank, made = self.ranks(ids[:, :-1], ids[:, 1:])
            open_ = np.flatnonzero(rank.min(axis=1) < NEVER)
            column = np.arange(n)
            while len(open_):
                r, m, t = rank[open_], made[open_], ids[open_]
                at = r.argmin(axis=1)
                each = np.arange(len(open_))
                # shift everything right of the merged pair one place to the left
                take = column[None, :] + (column[None, :] > at[:, None])
                t = np.take_along_axis(np.pad(t, ((0, 0), (0, 1)), constant_values=-1), take, axis=1)
                t[each, at] = m[each, at]
                shift = column[None, :-1] + (column[None, :-1] >= at[:, None])
                r = np.take_along_axis(np.pad(r, ((0, 0), (0, 1)), constant_values=NEVER), shift, axis=1)
                m = np.take_along_axis(np.pad(m, ((0, 0), (0, 1)), constant_values=-1), shift, axis=1)
                length[open_] -= 1
                right = np.minimum(at + 1, n - 1)
                new_r, new_m = self.ranks(t[each, at], np.where(at + 1 < n, t[each, right], -1))
                inside = at < n - 1
                r[each[inside], at[inside]], m[each[inside], at[inside]] = new_r[inside], new_m[inside]
                has_left = at > 0
                left = np.maximum(at - 1, 0)
                new_r, new_m = self.ranks(t[each, left], t[each, at])
                r[each[has_left], left[has_left]], m[each[has_left], left[has_left]] = new_r[has_left], new_m[has_left]
                rank[open_], made[open_], ids[open_] = r, m, t
                open_ = open_[r.min(axis=1) < NEVER]
        return [tuple(row[:k]) for row, k in zip(ids.tolist(), length.tolist(), strict=True)]

    def _long(self, word: bytes) -> tuple[int, ...]:
        import heapq

        ids = self.first[np.frombuffer(word, dtype=np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank, made = (x.tolist() for x in self.ranks(np.array(ids[:-1]), np.array(ids[1:])))
        queue = [(rank[i], i, ids[i], ids[i + 1], made[i]) for i in range(n - 1) if rank[i] < NEVER]
        heapq.heapify(queue)
        known: dict[tuple[int, int], tuple[int, int]] = {}

        def look(a: int, b: int) -> tuple[int, int]:
            if (a, b) not in known:
                r, m = self.ranks(np.array([a]), np.array([b]))
                known[a, b] = int(r[0]), int(m[0])
            return known[a, b]

        while queue:
            _, i, a, b, new = heapq.heappop(queue)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = new, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
                r, m = look(new, ids[after[i]])
                if r < NEVER:
                    heapq.heappush(queue, (r, i, new, ids[after[i]], m))
            if before[i] >= 0:
                p = before[i]
                r, m = look(ids[p], new)
                if r < NEVER:
                    heapq.heappush(queue, (r, p, ids[p], new, m))
        return tuple(i for i in ids if i >= 0)


def automaton(words: list[bytes]) -> dict:
    """A minimal acyclic automaton of sorted, distinct, non-empty words with numbered arcs.

    States are made from the longest suffix on: once a word's end can no longer change, equal states are
    shared. ``arc`` holds ``state * 256 + byte`` in order, ``to`` its target, ``add`` the number of words that sort before
    those through the arc; ``final`` marks ends of words.
    """
    register: dict[tuple, int] = {}
    frozen: list[tuple[bool, tuple]] = []
    path: list[list] = [[False, []]]
    last = b""

    def freeze(depth: int) -> None:
        while len(path) - 1 > depth:
            final, arcs = path.pop()
            key = (final, tuple(arcs))
            state = register.get(key)
            if state is None:
                state = register[key] = len(frozen)
                frozen.append(key)
            path[-1][1][-1] = (path[-1][1][-1][0], state)

    for word in words:
        shared = 0
        while shared < min(len(word), len(last)) and word[shared] == last[shared]:
            shared += 1
        freeze(shared)
        for b in word[shared:]:
            path[-1][1].append((b, -1))
            path.append([False, []])
        path[-1][0] = True
        last = word
    freeze(0)
    root = len(frozen)
    frozen.append((path[0][0], tuple(path[0][1])))
    # targets always have smaller numbers than their sources
    reach = np.zeros(len(frozen), dtype=np.int64)
    arc, to, add = [], [], []
    for state, (final, arcs) in enumerate(frozen):
        n = int(final)
        for b, target in arcs:
            arc.append(state * 256 + b)
            to.append(target)
            add.append(n)
            n += int(reach[target])
        reach[state] = n
    return {
        "arc": np.array(arc, dtype=np.int64),
        "to": np.array(to, dtype=np.int64),
        "add": np.array(add, dtype=np.int64),
        "final": np.array([f for f, _ in frozen], dtype=np.uint8),
        "root": np.array([root], dtype=np.int64),
    }


def walk(tables: dict, words: list[bytes]) -> np.ndarray:
    """Each word's number in the automaton, -1 if it is not in it. All words step together."""
    n = len(words)
    out = np.full(n, -1, dtype=np.int64)
    if not n or not len(tables["arc"]):
        return out
    lengths = np.array([len(w) for w in words])
    data = np.frombuffer(b"".join(words), dtype=np.uint8)
    starts = np.cumsum(lengths) - lengths
    state = np.full(n, tables["root"][0])
    total = np.zeros(n, dtype=np.int64)
    live = np.flatnonzero(lengths > 0)
    step = 0
    while len(live):
        key = state[live] * 256 + data[starts[live] + step]
        at = np.minimum(np.searchsorted(tables["arc"], key), len(tables["arc"]) - 1)
        hit = tables["arc"][at] == key
        live, at = live[hit], at[hit]
        state[live] = tables["to"][at]
        total[live] += tables["add"][at]
        step += 1
        ended = lengths[live] == step
        done = live[ended]
        accepted = done[tables["final"][state[done]] == 1]
        out[accepted] = total[accepted]
        live = live[~ended]
    return out


def frequent_words(docs: DataFrame, text: str, most: int) -> list[str]:
    """The most frequent pre-tokens of all documents, at most ``most``. A histogram over steps of the count's logarithm gives the least
    count at which they are so few, so the driver receives no more than those."""
    each = docs.select(F.explode(F.regexp_extract_all(F.col(f"`{text}`"), F.lit(JVM_PATTERN), 0)).alias("w"))
    counted = each.groupBy("w").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    counted = stored(counted.withColumn("step", F.floor(F.log2("n") * 16).cast("int")), "bpe-counts")
    sizes = counted.groupBy("step").agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("step")).collect()
    least, total = None, 0
    for row in sizes:
        total += row["k"]
        if total > most:
            break
        least = row["step"]
    if least is None:
        return []
    return [r["w"] for r in counted.filter(F.col("step") >= least).select("w").collect()]


def compile_lexicon(docs: DataFrame, text: str, tokenizer: str, most: int = LEXICON_WORDS) -> str:
    """Write the lexicon file of a corpus and return its place in the shared folder."""
    tables = tokenizer_tables(tokenizer)
    words = sorted({w.encode() for w in frequent_words(docs, text, most)} - {b""})
    ids = Merger(tables).merge(words)
    tables |= automaton(words)
    tables["word_ends"] = np.cumsum([len(i) for i in ids]).astype(np.int64)
    tables["word_ids"] = np.array([i for own in ids for i in own], dtype=np.int64)
    path = f"{scratch_path(docs.sparkSession, 'bpe-lexicon')}/lexicon.bin"
    write_file(path, packed(tables))
    return path


class Coder:
    """A worker's view of the lexicon file. ``known`` holds the ids of words, or with ``shown`` their ids as text and their bytes."""

    def __init__(self, path: str, shown: bool = False):
        self.tables = t = unpacked(mapped(path))
        self.merger = Merger(t)
        names = bytes(t["special"]).decode().split("\0") if len(t["special"]) else []
        self.special = dict(zip(names, t["special_ids"].tolist(), strict=True))
        self.cut = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        ends, raw = t["ends"].tolist(), bytes(t["bytes"])
        self.content = [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        self.numerals = [str(i) for i in range(len(ends))]
        self.form = self.as_shown if shown else tuple
        self.word_ends, self.word_ids = t["word_ends"].tolist(), t["word_ids"].tolist()
        self.known: dict[str, tuple[int, ...]] = {}

    def as_shown(self, ids: tuple[int, ...]) -> tuple[str, bytes]:
        return ",".join([self.numerals[i] for i in ids]), b"".join([self.content[i] for i in ids])

    def pieces(self, text: str) -> list[str]:
        if self.cut is None or not any(s in text for s in self.special):
            return PATTERN.findall(text)
        out: list[str] = []
        for k, part in enumerate(self.cut.split(text)):
            if k % 2:
                out.append(part)
            else:
                out.extend(PATTERN.findall(part))
        return out

    def learn(self, words: set[str]) -> None:
        """Put the ids of new words into the cache: from the automaton, or else by merging."""
        if len(self.known) + len(words) > CACHED_WORDS:
            self.known = {}
        fresh = [w for w in words if w not in self.known]
        if not fresh:
            return
        raw = [w.encode() for w in fresh]
        places = walk(self.tables, raw)
        ends, ids, known, form = self.word_ends, self.word_ids, self.known, self.form
        unseen = []
        for k, p in enumerate(places.tolist()):
            if fresh[k] in self.special:
                known[fresh[k]] = form((self.special[fresh[k]],))
            elif p >= 0:
                known[fresh[k]] = form(ids[ends[p - 1] if p else 0 : ends[p]])
            else:
                unseen.append(k)
        for k, found in zip(unseen, self.merger.merge([raw[k] for k in unseen]), strict=True):
            known[fresh[k]] = form(found)

    def batches(self, texts: list[str | None]) -> Iterator[list[list[str]]]:
        """The pieces of a few MB of texts at a time, all of them known."""
        group: list[list[str]] = []
        chars = 0
        for text in texts:
            group.append(self.pieces(text or ""))
            chars += len(text or "")
            if chars > CHUNK_CHARS:
                self.learn({w for pieces in group for w in pieces})
                yield group
                group, chars = [], 0
        if group:
            self.learn({w for pieces in group for w in pieces})
            yield group


@lru_cache(maxsize=1)
def coder_of(path: str, shown: bool = False) -> Coder:
    """One per worker process, which keeps its known words from task to task."""
    return Coder(path, shown)


def encode(docs: DataFrame, lexicon: str, text: str = "text") -> DataFrame:
    """Packs each row into ``_row`` and adds ``ids``, the token ids of the whole text."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{text}`").alias("_text"))
    schema = T.StructType([rows.schema["_row"], T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(lexicon)
        for batch in batches:
            texts, at = batch.column("_text").to_pylist(), 0
            for group in coder.batches(texts):
                known = coder.known
                ids = [[i for w in pieces for i in known[w]] for pieces in group]
                part = batch.column("_row").slice(at, len(group))
                at += len(group)
                yield pa.RecordBatch.from_arrays([part, pa.array(ids, pa.list_(pa.int32()))], ["_row", "ids"])

    return rows.mapInArrow(run, schema)


def decode(coded: DataFrame, lexicon: str, ids: str = "ids") -> DataFrame:
    """Adds ``decoded``, the text of the ids; bytes that are not UTF-8 become replacement characters."""
    schema = T.StructType([*coded.schema.fields, T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        content = np.array(coder_of(lexicon).content, dtype=object)
        for batch in batches:
            lists = batch.column(ids)
            texts = [b"".join(content[own.values.to_numpy()].tolist()).decode(errors="replace") if own.is_valid else "" for own in lists]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])

    return coded.mapInArrow(run, schema)


def digests(docs: DataFrame, lexicon: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Encode and decode without handing the ids back to the JVM: ``keep``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``."""
    keep = [] if keep is None else keep
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("_text"))
    told = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    schema = T.StructType([*rows.schema.fields[:-1], *told])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(lexicon, shown=True)
        for batch in batches:
            counts, of_ids, of_text = [], [], []
            for group in coder.batches(batch.column("_text").to_pylist()):
                known = coder.known
                for pieces in group:
                    own = [known[w] for w in pieces]
                    listed = ",".join([x for x, _ in own])
                    back = b"".join([x for _, x in own]).decode(errors="replace")
                    counts.append(listed.count(",") + 1 if listed else 0)
                    of_ids.append(hashlib.sha256(listed.encode()).hexdigest())
                    of_text.append(hashlib.sha256(back.encode()).hexdigest())
            made = [pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], schema.names)

    return rows.mapInArrow(run, schema)
