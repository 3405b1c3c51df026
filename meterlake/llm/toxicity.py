"""Toxicity from the nearest labelled examples.

1. Examples: of each label at most ``EXAMPLES`` distinct texts, those whose ids have the smallest hashes. Only this fitting
   sample is bounded; every other step covers all rows.
2. Terms: runs of letters, lower-cased, and the first ``STEMS`` letters of longer ones, so that endings not seen before still count.
   Spark counts for each term in how many toxic and clean examples it stands; a term is kept when its log odds differ by
   ``LEAST_ODDS`` and ``LEAST_Z`` standard errors from even at least, the ``TERMS`` furthest. Their document frequencies, for the
   inverse weights, are counted over all documents.
3. Index: examples as unit TF-IDF vectors in postings per term, cut into blocks of examples, with the largest weight of each
   (term, block). It is one bounded file in the shared folder, memory-mapped by workers.
4. Search: the sum of query weight times block maximum bounds every cosine in a block. Blocks are opened from the highest
   bound down until the bound falls below the k-th cosine found, so the k nearest are exact; ties go to the smaller id.
5. Votes: the k nearest vote with 1 / (distance + ``SOFT``), weighted back to the labels' shares among all labelled rows. Votes of the
   examples themselves, each without itself, are pooled into a rising curve that turns a vote into a rate. The nearest
   examples with cosine and label are the evidence.

Scores depend on the text alone. NULL and empty texts, and texts without a kept term, have no neighbours: they get the toxic rate of
the examples without one. Rows with equal texts get equal scores. NULL ids or labels teach nothing; an id labelled several times
counts as toxic if any of its labels says so, and so does a text carried by several ids. Without any labelled row, every score is ``NO_RATE``. Rows pass through with all their columns, in one struct, so
extra columns cannot clash. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.llm.common import mapped, packed, stored, unpacked, write_file
from meterlake.session import scratch_path

EXAMPLES = 8_192
TERMS = 4_096
LEAST_DOCS = 4
LEAST_Z = 4.0
LEAST_ODDS = 1.5
BLOCK = 64
NEAREST = 25
SOFT = 0.05
NO_RATE = 0.01
SLACK = 1e-9

LETTERS = re.compile(r"[^\W\d_]+")
STEMS = (4, 5, 6)
EVIDENCE = "array<struct<doc_id:bigint,cosine:double,label:int>>"


def words_of(text: str | None) -> list[str]:
    return LETTERS.findall(text.lower()) if text else []


def terms_of(word: str) -> list[str]:
    return [word, *[f"{word[:k]}*" for k in STEMS if len(word) > k]]


class Vocabulary:
    """The places of kept terms. A word is cut into terms only if its first letters begin a kept one."""

    def __init__(self, terms: list[str]):
        self.place = {t: k for k, t in enumerate(terms)}
        self.heads = {t.rstrip("*")[: STEMS[0]] for t in terms}

    def places(self, words: Iterable[str]) -> list[int]:
        heads, place, head = self.heads, self.place, STEMS[0]
        return [place[t] for w in words if w[:head] in heads for t in terms_of(w) if t in place]


def sampled(docs: DataFrame, labels: DataFrame, text: str, doc_id: str, label: str, most: int) -> tuple[DataFrame, dict[int, int]]:
    """``id, label, text`` of the fitting sample, and how many ids carry each label in all."""
    marks = (
        labels.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{label}`").cast("int").alias("label"))
        .filter(F.col("id").isNotNull() & F.col("label").isin(0, 1))
        .groupBy("id")
        .agg(F.max("label").alias("label"))
    )
    totals = {r["label"]: r["n"] for r in marks.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    one, zero = (marks.filter(F.col("label") == k).orderBy(F.xxhash64("id"), "id").limit(most) for k in (1, 0))
    # at most two rows times ``most``: small enough to send to every task
    chosen = F.broadcast(stored(one.unionByName(zero), "toxic-chosen"))
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text")).join(chosen, "id")
    distinct = rows.groupBy(F.coalesce(F.sha2("text", 256), F.lit("")).alias("digest")).agg(
        F.min("id").alias("id"), F.max("label").alias("label"), F.min("text").alias("text")
    )
    distinct = distinct.orderBy("digest").limit(2 * most)
    return stored(distinct.select("id", "label", "text"), "toxic-examples"), totals


def telling_terms(examples: DataFrame, most: int) -> list[str]:
    """The terms whose presence tells the labels apart, the most telling first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist(), strict=True):
                seen[label].update({t for w in set(words_of(text)) for t in terms_of(w)})
        for label in (0, 1):
            if seen[label]:
                yield pa.RecordBatch.from_pydict(
                    {
                        "term": pa.array(list(seen[label].keys()), pa.string()),
                        "label": pa.array([label] * len(seen[label]), pa.int32()),
                        "n": pa.array(list(seen[label].values()), pa.int64()),
                    }
                )

    sizes = {r["label"]: r["n"] for r in examples.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return []
    share = [F.sum(F.when(F.col("label") == k, F.col("n")).otherwise(0)) for k in (0, 1)]
    per = examples.select("label", "text").mapInArrow(count, "term string, label int, n bigint").groupBy("term").agg(share[0].alias("n0"), share[1].alias("n1"))
    cells = [F.col("n1") + 0.5, sizes[1] - F.col("n1") + 0.5, F.col("n0") + 0.5, sizes[0] - F.col("n0") + 0.5]
    odds = F.log(cells[0] / cells[1]) - F.log(cells[2] / cells[3])
    error = F.sqrt(sum((1 / c for c in cells), F.lit(0.0)))
    known = per.filter(F.col("n0") + F.col("n1") >= LEAST_DOCS).withColumns({"odds": F.abs(odds), "z": F.abs(odds / error)})
    kept = known.filter((F.col("z") >= LEAST_Z) & (F.col("odds") >= LEAST_ODDS))
    return [r["term"] for r in kept.orderBy(F.desc("z"), "term").limit(most).select("term").collect()]


def document_frequencies(docs: DataFrame, text: str, terms: list[str]) -> tuple[np.ndarray, int]:
    """In how many of all documents each term stands, and the number of documents."""
    vocabulary = Vocabulary(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(len(terms), dtype=np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for own in batch.column("text").to_pylist():
                seen[list(set(vocabulary.places(set(words_of(own)))))] += 1
        filled = np.flatnonzero(seen)
        yield pa.RecordBatch.from_pydict(
            {"place": pa.array(np.append(filled, -1), pa.int32()), "n": pa.array(np.append(seen[filled], n), pa.int64())}
        )

    counted = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(count, "place int, n bigint").groupBy("place").agg(F.sum("n").alias("n"))
    out, n = np.zeros(len(terms), dtype=np.int64), 0
    for row in counted.collect():  # one row per kept term
        if row["place"] < 0:
            n = row["n"]
        else:
            out[row["place"]] = row["n"]
    return out, n


class Weigher:
    """Texts to unit TF-IDF vectors over the kept terms."""

    def __init__(self, terms: list[str], idf: np.ndarray):
        self.vocabulary, self.idf = Vocabulary(terms), idf

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        found = Counter(self.vocabulary.places(words_of(text)))
        at = np.array(sorted(found), dtype=np.int64)
        w = (1 + np.log(np.array([found[k] for k in at.tolist()], dtype=np.float64))) * self.idf[at]
        return at, w / np.sqrt((w * w).sum()) if len(w) else w


def indexed(ids: np.ndarray, labels: np.ndarray, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int) -> dict:
    """Arrays of the inverted index. Examples with the same heaviest term lie together, which keeps block maxima low elsewhere."""
    heaviest = [int(at[w.argmax()]) for at, w in vectors]
    order = np.lexsort((ids, heaviest)) if len(ids) else np.zeros(0, dtype=np.int64)
    ids, labels = ids[order], labels[order]
    sizes = np.array([len(vectors[k][0]) for k in order], dtype=np.int64)
    row = np.repeat(np.arange(len(order)), sizes)
    term = np.concatenate([vectors[k][0] for k in order]) if len(order) else np.zeros(0, dtype=np.int64)
    weight = np.concatenate([vectors[k][1] for k in order]) if len(order) else np.zeros(0)
    by_term = np.lexsort((row, term))
    row, term, weight = row[by_term], term[by_term], weight[by_term]
    n_blocks = -(-len(order) // BLOCK)
    start = np.searchsorted(term * max(1, n_blocks) + row // BLOCK, np.arange(n_terms * n_blocks + 1))
    highest = np.zeros(n_terms * n_blocks)
    np.maximum.at(highest, term * max(1, n_blocks) + row // BLOCK, weight)
    return {"ids": ids, "labels": labels.astype(np.int64), "row": row, "weight": weight, "start": start.astype(np.int64), "highest": highest}


class Index:
    """The k nearest examples of a vector, exactly, opening as few blocks as their maxima allow."""

    def __init__(self, arrays: dict, n_terms: int):
        self.ids, self.labels, self.row, self.weight = (arrays[c] for c in ("ids", "labels", "row", "weight"))
        self.n_blocks = -(-len(self.ids) // BLOCK)
        self.start = arrays["start"]
        self.highest = arrays["highest"].reshape(n_terms, self.n_blocks)

    def nearest(self, at: np.ndarray, w: np.ndarray, k: int, without: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines, nearest first; only cosines over 0."""
        if not len(at) or not self.n_blocks:
            return np.zeros(0, dtype=np.int64), np.zeros(0)
        bound = w @ self.highest[at]
        order = np.argsort(-bound, kind="stable")
        bound = bound[order]
        n = int(np.searchsorted(-bound, 0.0))  # blocks with any shared term
        cosine = np.zeros(len(self.ids))
        seen, step, least = 0, 2 * (1 + k // BLOCK), 0.0
        while seen < n and bound[seen] >= least - SLACK:
            upto = min(n, seen + step)
            cell = (at[:, None] * self.n_blocks + order[seen:upto]).ravel()
            a = self.start[cell]
            size = self.start[cell + 1] - a
            ends = np.cumsum(size)
            place = np.repeat(a - ends + size, size) + np.arange(ends[-1])
            share = np.repeat(np.repeat(w, upto - seen), size) * self.weight[place]
            cosine += np.bincount(self.row[place], share, len(cosine))
            if without is not None:
                cosine[self.ids == without] = 0.0
            seen, step = upto, 2 * step
            met = cosine[cosine > 0]
            if len(met) >= k:
                least = float(np.partition(met, len(met) - k)[len(met) - k])
        near = np.flatnonzero(cosine >= max(least - SLACK, SLACK))
        # cosines are compared to the ninth digit, so that sums in another order tie alike
        near = near[np.lexsort((self.ids[near], -np.round(cosine[near], 9)))][:k]
        return near, np.minimum(cosine[near], 1.0)


class Judge:
    """Votes and scores of texts."""

    def __init__(self, model: dict):
        self.model = model
        self.weigh = Weigher(model["terms"], np.array(model["idf"], dtype=np.float64))
        self.index = Index(unpacked(mapped(model["file"])), len(model["terms"]))
        self.curve = (np.array(model["votes"]), np.array(model["rates"])) if "votes" in model else None

    def vote(self, text: str | None, without: int | None = None) -> tuple[float | None, np.ndarray, np.ndarray]:
        """The weighted share of toxic votes, none without neighbours; places and cosines of the voters."""
        near, cosine = self.index.nearest(*self.weigh.vector(text), self.model["nearest"], without)
        if not len(near):
            return None, near, cosine
        label = self.index.labels[near]
        w = np.where(label == 1, self.model["shares"][1], self.model["shares"][0]) / (1 - cosine + SOFT)
        return float((w * label).sum() / w.sum()), near, cosine

    def score(self, vote: float | None) -> float:
        if vote is None or not len(self.curve[0]):
            return self.model["empty_rate"]
        return float(np.interp(vote, *self.curve))


def rising(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[list[float], list[float]]:
    """The least-squares rising curve from votes to rates: pooled neighbours, each pool at its mean vote."""
    pools: list[list[float]] = []
    order = np.lexsort((labels, votes))
    values, first = np.unique(votes[order], return_index=True)
    w = np.add.reduceat(weights[order], first) if len(order) else weights
    y = np.add.reduceat((weights * labels)[order], first) if len(order) else weights
    for x, total, toxic in zip(values.tolist(), w.tolist(), y.tolist(), strict=True):
        pools.append([x * total, total, toxic])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    rate = sum(p[2] for p in pools) / sum(p[1] for p in pools) if pools else 0.0
    # one example's weight of the overall rate keeps small pools off 0 and 1
    one = float(weights.mean()) if len(weights) else 1.0
    return [p[0] / p[1] for p in pools], [(p[2] + one * rate) / (p[1] + one) for p in pools]


def learn(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    label: str = "toxic",
    examples: int = EXAMPLES,
    terms: int = TERMS,
    nearest: int = NEAREST,
) -> dict:
    """Fit on ``labels`` (rows to learn from); returns the model's description."""
    spark = docs.sparkSession
    chosen, totals = sampled(docs, labels, text, doc_id, label, examples)
    kept = telling_terms(chosen, terms)
    frequency, n_docs = document_frequencies(docs, text, kept) if kept else (np.zeros(0, dtype=np.int64), 0)
    idf = np.log((1 + n_docs) / (1 + frequency)) + 1
    model: dict = {"terms": kept, "idf": idf.tolist(), "nearest": nearest, "file": f"{scratch_path(spark, 'toxic-index')}/index.bin"}

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weigh = Weigher(kept, idf)
        for batch in batches:
            found = [weigh.vector(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {
                    "id": batch.column("id"),
                    "label": batch.column("label"),
                    "at": pa.array([a.tolist() for a, _ in found], pa.list_(pa.int64())),
                    "w": pa.array([w.tolist() for _, w in found], pa.list_(pa.float64())),
                }
            )

    # the sample's vectors: at most twice ``examples`` rows of at most ``terms`` numbers
    rows = chosen.mapInArrow(vectors, "id bigint, label int, at array<bigint>, w array<double>").collect()
    held = {k: sum(r["label"] == k for r in rows) for k in (0, 1)}
    model["shares"] = [totals.get(k, 0) / held[k] if held[k] else 0.0 for k in (0, 1)]
    full = [r for r in rows if r["at"]]
    arrays = indexed(
        np.array([r["id"] for r in full], dtype=np.int64),
        np.array([r["label"] for r in full], dtype=np.int64),
        [(np.array(r["at"], dtype=np.int64), np.array(r["w"])) for r in full],
        len(kept),
    )
    write_file(model["file"], packed(arrays))
    weight = np.array([model["shares"][r["label"]] for r in rows if not r["at"]])
    toxic = sum(model["shares"][r["label"]] * r["label"] for r in rows if not r["at"])
    rate = totals.get(1, 0) / sum(totals.values()) if totals else NO_RATE
    model["empty_rate"] = float((toxic + rate) / (weight.sum() + 1))

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(model)
        for batch in batches:
            own = [judge.vote(t, i)[0] for i, t in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_pydict({"vote": pa.array(own, pa.float64()), "label": batch.column("label")})

    told = chosen.mapInArrow(votes, "vote double, label int").filter(F.col("vote").isNotNull()).collect()
    y = np.array([r["label"] for r in told], dtype=np.float64)
    w = np.where(y == 1, model["shares"][1], model["shares"][0])
    model["votes"], model["rates"] = rising(np.array([r["vote"] for r in told], dtype=np.float64), y, w)
    return model


def score(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """``_row`` (all columns), ``score`` (0 to 1), ``vote`` (NULL without neighbours) and ``evidence``, the nearest examples."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{text}`").alias("_text"))
    told = T.StructType().add("score", "double").add("vote", "double").add("evidence", T.DataType.fromDDL(EVIDENCE))
    schema = T.StructType([rows.schema["_row"], *told.fields])
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("label", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(model)
        ids, labels = judge.index.ids.tolist(), judge.index.labels.tolist()
        for batch in batches:
            scores, votes, evidence = [], [], []
            for own in batch.column("_text"):
                vote, near, cosine = judge.vote(own.as_py())
                scores.append(judge.score(vote))
                votes.append(vote)
                evidence.append([{"doc_id": ids[k], "cosine": c, "label": labels[k]} for k, c in zip(near.tolist(), cosine.tolist(), strict=True)])
            made = [pa.array(scores, pa.float64()), pa.array(votes, pa.float64()), pa.array(evidence, kind)]
            yield pa.RecordBatch.from_arrays([batch.column("_row"), *made], schema.names)

    return rows.mapInArrow(run, schema)
