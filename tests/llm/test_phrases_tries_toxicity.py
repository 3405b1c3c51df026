"""Collocations, the conversation trie and toxicity against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterlake.llm import collocations, prefix_trie, toxicity

RNG = random.Random(23)


# --- collocations -------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def spoken():
    names = ["New York", "terms of service", "as soon as possible", "the the", "Été", "日本 語", "a b c d e"]
    plain = [f"w{k}" for k in range(25)] + ["the"] * 20
    rows = []
    for i in range(160):
        said = [RNG.choice(names) if RNG.random() < 0.25 else RNG.choice(plain) for _ in range(RNG.randrange(0, 40))]
        text = "".join(w + RNG.choice([" ", " ", " ", "\t", "  ", ". ", "\n", ";", "\x0b", "\x1c "]) for w in said)
        rows.append((i, text, RNG.choice(["en", "en", "en", "de", None])))
    rows += [(500 + i, "hot phrase of copies, " * 3, "en") for i in range(60)]
    rows += [(900, None, "en"), (901, "", "xx"), (902, " ... ;;", "yy"), (None, "New York new york", "en"), (1, rows[1][1], rows[1][2])]
    rows += [(903, " ".join(f"long{k % 50}" for k in range(5000)), "en")]
    return rows


def best_phrases(rows, least, pct, top):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", low):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in range(1, 5):
                for i in range(len(ws) - k + 1):
                    f[lang, tuple(ws[i : i + k])] += 1
    cand = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    found = defaultdict(list)
    for (lang, p), a in cand.items():
        inside = [b for (m, q), b in cand.items() if m == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
        if any(100 * b >= pct * a for b in inside):
            continue
        cut = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
        score, k = cut
        found[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    out = set()
    for lang, rows_ in found.items():
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows_)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return out


@pytest.mark.parametrize(("budget", "top"), [(1_000_000, 2000), (40, 7)])
def test_collocations_match_brute_force(spark, spoken, budget, top):
    docs = spark.createDataFrame([(*r, "x") for r in spoken], "doc_id bigint, text string, lang string, word string").repartition(3)
    got = collocations.collocations(docs, least=5, top=top, budget=budget).collect()
    assert {tuple(r) for r in got} == best_phrases(spoken, 5, 80, top)
    assert len(got) > 10


def test_prefixes_are_extended_and_their_parts_added_up(spark, spoken, monkeypatch):
    """With tiny groups, words are split by two and three words; counts stay whole."""
    docs = spark.createDataFrame(spoken, "doc_id bigint, text string, lang string")
    plain = {tuple(r) for r in collocations.phrases(docs, least=4)[0].collect()}
    monkeypatch.setattr(collocations, "VERY_MANY", 2)
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 500)
    split = {tuple(r) for r in collocations.phrases(docs, least=4, budget=20)[0].collect()}
    assert plain == split and len({r[1] for r in plain}) == 4


def test_collocations_of_nothing(spark):
    for rows in ([], [(1, None, None)], [(1, "", "en"), (2, "one two", "en")]):
        docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
        assert collocations.collocations(docs).count() == 0


# --- trie ---------------------------------------------------------------------------------------------


def crc4(c):
    return zlib.crc32(str(c).encode()) % 4


def plain_trie(rows):
    said = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            digest = hashlib.md5((hashlib.md5((role or "").encode()).hexdigest() + hashlib.md5((text or "").encode()).hexdigest()).encode()).hexdigest()
            said[c].append(((turn is not None, turn or 0), digest, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in said.items()}
    built = {}
    for c, turns in own.items():
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        built[c] = own.get(base, [])[: crc4(c)] + turns[crc4(c) :]
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, own_members in members.items():
        tokens = (len(own_members) - 1) * len((p[-1][1] if p else "").encode().split())
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += tokens
    out = set()
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(built[c]) == len(p)))
        above = min(members[p[:-1]]) if p else None
        out.add((min(m), len(p), above, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return out


@pytest.fixture(scope="module")
def talks():
    rows = []
    for c in [*range(0, 130), 4095, 4096, 9000, -7, -20, -21]:
        for turn in range(RNG.randrange(1, 7)):
            rows.append((c, turn, RNG.choice(["user", "assistant", None]), RNG.choice(["hello there", "how are you", None, "", f"only {c}"])))
    hot = [("user", "the same first words"), ("assistant", "and the same reply"), ("user", None)]
    rows += [(200 + c, turn, r, t) for c in range(90) for turn, (r, t) in enumerate(hot)]
    rows += [(300, None, "user", "null turn"), (300, 1, "b", "tie"), (300, 1, "a", "tie"), (300, 1, "a", "tie"), (None, 1, "user", "no id"), (321, 0, "x", "short")]
    rows += [(400, k, "user", f"turn {k}") for k in range(300)]
    return rows


@pytest.mark.parametrize("limit", [8, 256, 10**9])
def test_trie_matches_plain_python(spark, talks, limit):
    table = spark.createDataFrame([(*r, "x") for r in talks], "conv_id bigint, turn int, role string, text string, hi string").repartition(4)
    paths = prefix_trie.rebuilt(table, 20, lambda c: F.crc32(c.cast("string").cast("binary")) % 4)
    got = [tuple(r) for r in prefix_trie.trie(paths, least_limit=limit).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_trie(talks)


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    schema = "conv_id bigint, turn int, role string, text string"

    def trie(rows):
        paths = prefix_trie.rebuilt(spark.createDataFrame(rows, schema), 20, lambda c: F.crc32(c.cast("string").cast("binary")) % 4)
        return {tuple(r) for r in prefix_trie.trie(paths).collect()}

    assert trie([]) == set() and trie([(None, 1, "a", "b")]) == set()
    alone = next(c for c in range(1, 20) if crc4(c) > 0)
    rows = [(alone, 1, "user", "gone with the missing beginning")]
    assert trie(rows) == plain_trie(rows) and len(trie(rows)) == 1


def test_slots_are_minimal_and_verified():
    rng = np.random.default_rng(1)
    hi, lo = rng.integers(-(2**62), 2**62, 5000), rng.integers(-(2**62), 2**62, 5000)
    slots = prefix_trie.Slots(hi, lo)
    assert sorted(slots.of(hi, lo)) == list(range(5000))
    assert (slots.of(hi, lo + 1) == -1).all() and (slots.hi[slots.own] == hi).all()
    with pytest.raises(ValueError):
        prefix_trie.Slots(np.append(hi, hi[0]), np.append(lo, lo[0]))


# --- toxicity -----------------------------------------------------------------------------------------


def test_nearest_examples_are_exact():
    rng = np.random.default_rng(5)
    vectors = []
    for _ in range(700):
        at = np.sort(rng.choice(40, rng.integers(1, 6), replace=False))
        w = rng.integers(1, 4, len(at)).astype(float)
        vectors.append((at, w / np.sqrt((w * w).sum())))
    ids, labels = rng.permutation(10_000)[:700], rng.integers(0, 2, 700)
    index = toxicity.Index(toxicity.indexed(ids, labels, vectors, 40), 40)
    dense = np.zeros((700, 40))
    for k, (at, w) in enumerate(vectors):
        dense[k, at] = w
    for k in range(0, 700, 7):
        near, cosine = index.nearest(*vectors[k], 25, without=int(ids[k]))
        every = np.round(dense @ dense[k], 9)
        want = sorted((-c, i) for c, i in zip(every.tolist(), ids.tolist(), strict=True) if c > 0 and i != ids[k])[:25]
        assert [(-c, i) for c, i in zip(np.round(cosine, 9).tolist(), index.ids[near].tolist(), strict=True)] == want


def test_rising_curve_pools_violators():
    x, y = toxicity.rising(np.array([0.1, 0.2, 0.3, 0.9]), np.array([0.0, 1.0, 0.0, 1.0]), np.ones(4))
    assert x == [0.1, 0.25, 0.9] and y == sorted(y) and 0 < y[0] < y[-1] < 1


@pytest.fixture(scope="module")
def judged(spark):
    rng = random.Random(2)
    calm = [f"word{''.join(rng.choices('abcdefghij', k=3))}" for _ in range(300)] + ["sun", "rain", "road"]
    bad = ["idiot", "moronic", "scumbag", "verflixt"]
    rows, labels = [], []
    for i in range(1500):
        toxic = int(rng.random() < 0.15)
        words = rng.choices(calm, k=rng.randrange(5, 60))
        for _ in range(rng.randrange(1, 4) if toxic else 0):
            words.insert(rng.randrange(len(words) + 1), rng.choice(bad) + rng.choice(["", "s", "esque", "!!", "$$$"]))
        rows.append((i, " ".join(words), "x", "y"))
        labels.append((i, toxic))
    rows += [(2000, None, "x", "y"), (2001, "", "x", "y"), (None, "an idiot speaks", "x", "y"), (2002, "... 123", None, None), (2003, "idiot " * 20000, "x", "y")]
    labels += [(None, 1), (5, None), (77, 0), (9999, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score string, _row string").repartition(3)
    return docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"), dict(labels[:1500]), {r[0]: r[1] for r in rows}


def test_held_out_documents_are_told_apart(judged):
    docs, labels, truth, _ = judged
    model = toxicity.learn(docs, labels.filter("doc_id % 5 <> 0 OR doc_id IS NULL"))
    rows = toxicity.score(docs, model).select("_row.doc_id", "_row.score", "score", "vote", "evidence").toDF("doc_id", "kept", "score", "vote", "evidence").collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows) and {r["kept"] for r in rows} == {"x", None}
    held = [r for r in rows if r["doc_id"] is not None and r["doc_id"] < 1500 and r["doc_id"] % 5 == 0]
    right = sum((r["score"] >= 0.5) == bool(truth[r["doc_id"]]) for r in held)
    assert right / len(held) > 0.95
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[2000]["score"] == by_id[2001]["score"] == by_id[2002]["score"] < 0.5 and by_id[2000]["vote"] is None and by_id[2000]["evidence"] == []
    assert by_id[2003]["score"] > 0.5 and by_id[None]["score"] > 0.5
    for r in held:
        near = [(-round(e["cosine"], 9), e["doc_id"]) for e in r["evidence"]]
        assert near == sorted(near) and all(e["doc_id"] % 5 for e in r["evidence"]) and len(near) <= toxicity.NEAREST


def test_bounded_sample_and_missing_labels(spark, judged):
    docs, labels, truth, _ = judged
    small = toxicity.learn(docs, labels, examples=60)
    rows = toxicity.score(docs, small).select("_row.doc_id", "score").collect()
    right = [(r["score"] >= 0.5) == bool(truth[r["doc_id"]]) for r in rows if r["doc_id"] in truth]
    assert sum(right) / len(right) > 0.85
    none = toxicity.learn(docs, labels.limit(0))
    assert {r["score"] for r in toxicity.score(docs, none).select("score").collect()} == {toxicity.NO_RATE}
    one = toxicity.learn(docs, labels.filter("toxic = 0"))
    assert max(r["score"] for r in toxicity.score(docs, one).select("score").collect()) < 0.5
    assert toxicity.score(docs.limit(0), small).count() == 0
    empty = toxicity.learn(docs.limit(0), labels)
    assert toxicity.score(docs.limit(2), empty).count() == 2
