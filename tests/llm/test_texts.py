"""Substring removal, near-duplicates, BPE and the language model against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterlake.llm import bpe, lm, neardup, queries, substrings

RNG = random.Random(11)
VOCAB = [f"word{i}" for i in range(400)] + ["Été", "日本", "x\x1cy", "a b"]


def prose(n: int) -> list[str]:
    return [RNG.choice(VOCAB) for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    passage = prose(60)
    rows = [(i, " ".join(prose(RNG.randrange(1, 120))), "s") for i in range(60)]
    rows += [(100 + i, " ".join(prose(20) + passage[: 13 + i] + prose(15)), "s") for i in range(12)]
    rows += [(200 + i, "  \n".join(passage), "t") for i in range(5)]
    base = prose(100)
    for i in range(40):
        near = list(base)
        for _ in range(i % 4):
            near[RNG.randrange(100)] = "changed"
        rows.append((300 + i, " ".join(near).upper() if i % 5 == 0 else " ".join(near), None))
    rows += [(400, None, "s"), (401, "", "s"), (402, " \t\n", "s"), (403, "two words", "s"), (404, "Two  WORDS", "s")]
    rows += [(None, " ".join(passage), "s"), (None, None, None), (7, rows[7][1], "s"), (7, rows[7][1], "s")]
    rows += [(500, " ".join(f"long{i % 3001}" for i in range(40000)), "s"), (501, "z" * 50000, "s")]
    return rows


def split(text):
    return [w.decode() for w in (text or "").encode().split()]


def test_substrings_match_brute_force(docs_of, corpus):
    least: dict = {}
    for i, t, _ in corpus:
        w = split(t)
        for k in range(len(w) - 12):
            key = tuple(w[k : k + 13])
            least[key] = min(least.get(key, math.inf), math.inf if i is None else i)
    want = Counter()
    for i, t, _ in corpus:
        w = split(t)
        gone = {p for k in range(len(w) - 12) if least[tuple(w[k : k + 13])] < (math.inf if i is None else i) for p in range(k, k + 13)}
        want[i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)] += 1
    for block_bytes in (1 << 22, 3000):
        got = substrings.deduplicated(docs_of(corpus).repartition(3), keep=["doc_id", "size"], block_bytes=block_bytes).collect()
        assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in got) == want
    assert substrings.deduplicated(docs_of([])).count() == 0


@pytest.mark.parametrize("words", [40, 12, 0])
def test_texts_without_repeats_or_windows_stay_whole(docs_of, words):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(words)), "s") for i in range(40)] + [(None, None, "s")]
    want = sorted((i is None, i, len((t or "").split()), 0, t or "") for i, t, _ in rows)
    for block_bytes in (1 << 20, 300):
        got = substrings.deduplicated(docs_of(rows).repartition(3), block_bytes=block_bytes).collect()
        assert sorted((r["doc_id"] is None, r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in got) == want


def test_packed_numbers_come_back():
    for values in ([0], [5, 5, 6, 1 << 31], list(range(0, 1 << 20, 977))):
        assert substrings.unsqueezed(substrings.squeezed(np.array(values))).tolist() == values
    for values in ([0], [3, 1 << 61], sorted(RNG.randrange(1 << 60) for _ in range(5000)), list(range(3000)) + [1 << 60]):
        assert lm.unsqueezed_keys(lm.squeezed_keys(np.array(values, dtype=np.int64))).tolist() == values


def groups(rows, width, pct):
    sets = []
    for _, t, _ in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= pct * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    least: dict = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), math.inf), i)
    return Counter((i, len(sets[k]), least.get(find(k), i) if sets[k] else i) for k, (i, _, _) in enumerate(rows))


def test_neardup_groups_match_brute_force(docs_of, corpus):
    for width in (4, 5):
        got = neardup.grouped(docs_of(corpus), width=width, keep=["doc_id", "size"]).collect()
        assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == groups(corpus, width, 80)
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert neardup.grouped(docs_of([])).count() == 0


def test_neardup_searches_beyond_the_star(docs_of, monkeypatch):
    """A chain in one bucket: each text is like its neighbours only, and cells and rounds are small."""
    monkeypatch.setattr(neardup, "CELL", 8)
    monkeypatch.setattr(neardup, "FIRST_ROUND", 1)
    words = [f"c{i}" for i in range(600)]
    rows = [(i, " ".join(words[8 * i : 8 * i + 200]), "s") for i in RNG.sample(range(40), 40)]
    got = neardup.grouped(docs_of(rows), width=4).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == groups(rows, 4, 80)


def nearly_linked(n: int) -> list[tuple]:
    """Copies of one text with four other words each, at a similarity of 0.64 and more to each other, and some with one, that are linked."""
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(n):
        words = list(base)
        for at in RNG.sample(range(2, 148, 7), 1 if i % 40 == 0 else 4):
            words[at] = f"x{i}y{at}"
        rows.append((i, " ".join(words), "s"))
    return rows


def test_neardup_pairs_that_come_close_are_no_rows(docs_of, monkeypatch):
    """In a group of copies just below the limit the pairs confirmed grow with the documents, not with their pairs."""
    rows, sent, real = nearly_linked(400), [], neardup.confirmed

    def counted(pairs, *rest):
        sent.append(pairs.count())
        return real(pairs, *rest)

    monkeypatch.setattr(neardup, "confirmed", counted)
    got = neardup.grouped(docs_of(rows), width=4).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == groups(rows, 4, 80)
    assert sum(sent) <= len(rows) * (neardup.FIRST_ROUND * neardup.BANDS + 2)


def test_neardup_goes_on_where_hashes_fell_together(docs_of, monkeypatch):
    """Sets of which nothing is known but their sizes: every pair goes on, is refused, and the rest is counted in further rounds."""
    monkeypatch.setattr(neardup, "FIRST_ROUND", 1)
    monkeypatch.setattr(neardup, "CELL", 5)
    real = neardup.packed_sets
    unknown = {"words": F.lit(bytes(4)), "lost": F.lit(1_000_000).cast("long")}
    monkeypatch.setattr(neardup, "packed_sets", lambda texts, width: real(texts, width).withColumns(unknown))
    rows = nearly_linked(14) + [(100, nearly_linked(1)[0][1] + " end", "s")]
    got = neardup.grouped(docs_of(rows), width=4).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == groups(rows, 4, 80)


def test_estimates_are_near_the_true_similarity():
    one = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 4000).astype(np.uint64))
    for share in (0.5, 0.8, 0.95):
        cut = int(len(one) * share)
        two = np.unique(np.concatenate([one[:cut], np.random.default_rng(2).integers(0, 1 << 63, len(one) - cut).astype(np.uint64)]))
        true = cut / (2 * len(one) - cut)
        bits = neardup.packed_bits(neardup.minima([one, two]))
        assert abs(neardup.agreeing(bits[0], bits[1:])[0] - true) < neardup.SLACK


@pytest.fixture(scope="module")
def library():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(queries.tokenizer())
    t.no_truncation()
    t.no_padding()
    return t


def test_bpe_matches_the_library(docs_of, corpus, library):
    pool = [chr(c) for c in [*range(0x250), 0x2028, 0x3000, 0x200B, 0xFEFF, 0x1F600, 0x660, 0x4E2D, 0x301]]
    rows = list(corpus) + [(1000 + k, "".join(RNG.choice(pool) for _ in range(50)), "s") for k in range(200)]
    rows += [(2000, "a<|endoftext|>b <|endoftext|>", "s"), (2001, "I'll don't 've  x   \n\n y", "s"), (2002, "ab" * 5000, "s")]
    docs = docs_of(rows)
    lexicon = bpe.compile_lexicon(docs, "text", queries.tokenizer(), most=300)
    coded = bpe.encode(docs, lexicon)
    want = Counter()
    digests = Counter()
    for i, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want[i, tuple(ids), back] += 1
        digests[i, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), back))] += 1
    got = bpe.decode(coded, lexicon).select("_row.doc_id", "ids", "decoded").collect()
    assert Counter((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in got) == want
    assert Counter(tuple(r) for r in bpe.digests(docs, lexicon, keep=["doc_id"]).collect()) == digests
    none = docs_of([])
    assert bpe.encode(none, bpe.compile_lexicon(none, "text", queries.tokenizer())).count() == 0


def test_automaton_is_minimal_and_numbers_words():
    words = sorted(w.encode() for w in ("tap", "taps", "top", "tops", "stop", "stops", "é"))
    table = bpe.automaton(words)
    asked = words + [b"", b"ta", b"tapss", b"x"]
    assert bpe.walk(table, asked).tolist() == [*range(len(words)), -1, -1, -1, -1]
    # suffixes are shared: "ps" of tap, top and stop leads to the same states
    assert len(table["final"]) < sum(map(len, words)) / 2
    assert bpe.walk(bpe.automaton([]), [b"a"]).tolist() == [-1]


def scores(rows, train):
    tok = [(t or "").encode().lower().split() + [None] for _, t, _ in rows]
    c, pairs = Counter(), Counter()
    for k in train:
        c.update(tok[k])
        pairs.update(zip(["<s>", *tok[k][:-1]], tok[k], strict=True))
    n, v = sum(c.values()), len(c)

    def discounts(counts):
        m = [sum(1 for x in counts if x == k) for k in (1, 2, 3, 4)]
        return lm.discounts(*m)

    before = Counter(w for _, w in pairs)
    d2, d1, total = discounts(pairs.values()), discounts(before.values()), len(pairs)
    after, kinds = Counter(), defaultdict(lambda: [0, 0, 0, 0])
    for (u, _), k in pairs.items():
        after[u] += k
        kinds[u][min(k, 3)] += 1
    rest = sum(d1[min(k, 3)] for k in before.values()) / total if total else 0

    def alone(w):
        return max(before[w] - d1[min(before[w], 3)], 0) / total + rest / (v + 1) if total else 1.0

    def p(u, w):
        if not after[u]:
            return alone(w)
        k = pairs[u, w]
        return max(k - d2[min(k, 3)], 0) / after[u] + sum(d2[j] * kinds[u][j] for j in (1, 2, 3)) / after[u] * alone(w)

    assert not total or abs(sum(alone(w) for w in c) + rest / (v + 1) - 1) < 1e-9
    for own in tok:
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in own)
        yield len(own), sum(c[w] > 0 for w in own), base, sum(math.log10(p(u, w)) for u, w in zip(["<s>", *own[:-1]], own, strict=True))


def test_language_model_matches_brute_force(docs_of, corpus):
    rows = [r for r in corpus if r[0] is not None]
    train = [k for k, (i, _, _) in enumerate(rows) if zlib.crc32(str(i).encode()) % 7 != 2]
    docs = docs_of(rows)
    model = lm.train(docs.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2))
    got = sorted(tuple(r) for r in lm.score(docs, model, keep=["doc_id"]).drop("perplexity").collect())
    want = sorted((i, *s) for (i, _, _), s in zip(rows, scores(rows, train), strict=True))
    for a, b in zip(got, want, strict=True):
        assert a[:3] == b[:3]
        assert a[3] == pytest.approx(b[3], rel=1e-9) and a[4] == pytest.approx(b[4], rel=1e-9)


def test_language_model_without_training_texts(docs_of, corpus):
    model = lm.train(docs_of([]))
    got = lm.score(docs_of(corpus[:3]), model, keep=["doc_id"]).collect()
    assert [r["n_known"] for r in got] == [0, 0, 0] and all(r["score"] == 0 for r in got)
    assert lm.score(docs_of([]), model).count() == 0


def trigram_scores(rows, train):
    """Every text's score by dictionaries: own counts for triples, continuation counts below, own counts at the beginning of a text."""
    triples, pairs, before = Counter(), Counter(), Counter()
    for _, t, _ in train:
        own = ["<s>", *(t or "").encode().lower().split(), None]
        pairs["<s>", own[1]] += 1
        triples.update(zip(own, own[1:], own[2:], strict=False))
    for _, v, w in triples:
        pairs[v, w] += 1
    before.update(w for _, w in pairs)
    d3, d2, d1 = (lm.discounts(*(sum(c == k for c in counts.values()) for k in (1, 2, 3, 4))) for counts in (triples, pairs, before))
    behind = defaultdict(dict)
    for (*context, w), k in [*triples.items(), *pairs.items()]:
        behind[tuple(context)][w] = k

    def level(context, w, d, lower):
        known = behind.get(context)
        if not known:
            return lower
        k, total = known.get(w, 0), sum(known.values())
        return (max(k - d[min(k, 3)], 0) + sum(d[min(c, 3)] for c in known.values()) * lower) / total

    def p(u, v, w):
        lower = (max(before[w] - d1[min(before[w], 3)], 0) + sum(d1[min(c, 3)] for c in before.values()) / (len(before) + 1)) / len(pairs)
        lower = level((v,), w, d2, lower)
        return lower if u is None else level((u, v), w, d3, lower)

    for _, t, _ in rows:
        own = ["<s>", *(t or "").encode().lower().split(), None]
        yield sum(math.log10(p(own[k - 2] if k > 1 else None, own[k - 1], own[k])) for k in range(1, len(own)))


def test_trigram_model_matches_plain_python(docs_of, corpus):
    rows = [r for r in corpus if r[0] is not None and len(r[1] or "") < 5000] + [(5000 + k, "w " * 300 + f"w{k}", "s") for k in range(9)]
    seen = [r for r in rows if r[0] % 4]
    docs = docs_of(rows).repartition(3)
    model = lm.train(docs_of(seen).repartition(3), order=3)
    got = sorted((r["doc_id"], r["score"]) for r in lm.score(docs, model, keep=["doc_id"]).collect())
    want = sorted((r[0], s) for r, s in zip(rows, trigram_scores(rows, seen), strict=True))
    for a, b in zip(got, want, strict=True):
        assert a[0] == b[0] and a[1] == pytest.approx(b[1], rel=1e-9)
    none = lm.train(docs_of([]), order=3)
    assert all(r["score"] == 0 for r in lm.score(docs_of(rows[:3]), none).collect())


def test_third_word_of_context_counts(docs_of):
    # both texts are made of the same kinds of pairs, all seen in training
    train = docs_of([(k, "x a b c y" if k % 2 else "x d b e y", "s") for k in range(6)])
    texts = docs_of([(1, "x a b c y", "s"), (2, "x a b e y", "s")])
    for order in (2, 3):
        score = {r["doc_id"]: r["score"] for r in lm.score(texts, lm.train(train, order=order), keep=["doc_id"]).collect()}
        assert (score[1] - score[2] > 0.5) == (order == 3)


def test_neardup_buckets_of_one_cell_and_of_several_share_a_call(docs_of, monkeypatch):
    """Large groups of copies just below the limit, cut into cells and blocks, are counted beside small ones that lie in one cell."""
    monkeypatch.setattr(neardup, "FIRST_ROUND", 1)
    monkeypatch.setattr(neardup, "CELL", 5)
    monkeypatch.setattr(neardup, "BLOCK", 1)
    seen, real = [], neardup.linkable

    def counted(inside, *rest):
        seen.extend(tuple(r) for r in inside.select("cells", "blocks").distinct().collect())
        return real(inside, *rest)

    monkeypatch.setattr(neardup, "linkable", counted)
    rows = nearly_linked(44)
    rows += [(100 + k, text.replace("b", "small"), "s") for k, (_, text, _) in enumerate(nearly_linked(4))]
    got = neardup.grouped(docs_of(rows), width=4).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == groups(rows, 4, 80)
    assert (1, 1) in seen and any(cells > 1 and blocks > 1 for cells, blocks in seen)
