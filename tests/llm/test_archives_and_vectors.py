"""Salvage of damaged archives; recall of the vector search against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from meterlake.llm import ann, warc
from tests.compare import difference
from meterlake.llm import queries


def page(i: int, payload: bytes, refers_to=None) -> bytes:
    return warc.member(warc.record(i, f"http://h/{i}", payload, hashlib.sha256(payload).hexdigest(), refers_to))


def told(data: bytes) -> tuple[list, list]:
    found, gaps = [], []
    for start, stop, headers, block, reason in warc.salvage(data):
        if headers is None:
            gaps.append((start, stop, reason))
        else:
            found.append(warc.page_of(headers["warc-record-id"]))
    return found, gaps


def test_salvage_recovers_later_records_and_logs_gaps():
    rng = random.Random(3)
    members = [page(i, bytes(rng.randrange(97, 123) for _ in range(300))) for i in range(6)]
    starts = np.cumsum([0, *map(len, members)]).tolist()
    whole = b"".join(members)
    assert told(whole) == ([0, 1, 2, 3, 4, 5], [])

    hurt = bytearray(whole)
    hurt[starts[2] + 40] ^= 0xFF
    found, gaps = told(bytes(hurt))
    assert found == [0, 1, 3, 4, 5] and [g[:2] for g in gaps] == [(starts[2], starts[3])]

    found, gaps = told(whole[: starts[4] + 10])
    assert found == [0, 1, 2, 3] and gaps[0][:2] == (starts[4], starts[4] + 10)

    junk = b"junk\x1f\x8b\x08junk WARC/1.1 no"
    found, gaps = told(members[0] + junk + members[1])
    assert found == [0, 1] and gaps[0][:2] == (starts[1], starts[1] + len(junk))

    # an uncompressed record between members, and one whose block digest is wrong
    plain = warc.record(9, None, b"y" * 50, "d", None)
    bad = plain.replace(b"yyyy", b"zzzz", 1)
    found, gaps = told(members[0] + bad + plain + members[1])
    assert found == [0, 9, 1] and gaps == [(starts[1], starts[1] + len(bad), "block digest")]
    assert told(b"") == ([], [])
    assert told(b"nothing here")[1] == [(0, 12, "no version line")]


def test_salvage_inside_members():
    rng = random.Random(5)

    def plain(i: int) -> bytes:
        payload = bytes(rng.randrange(256) for _ in range(60000))
        return warc.record(i, None, payload, hashlib.sha256(payload).hexdigest(), None)

    records = [plain(i) for i in range(6)]
    assert told(warc.member(b"".join(records))) == ([0, 1, 2, 3, 4, 5], [])
    bad = bytearray(records[2])
    bad[-10] ^= 0xFF
    content = records[0] + records[1] + bytes(bad) + b"".join(records[3:])
    a = len(records[0] + records[1])
    found, gaps = told(warc.member(content) + page(9, b"z" * 300))
    assert found == [0, 1, 3, 4, 5, 9]
    assert gaps == [(0, len(warc.member(content)), f"block digest, inflated bytes {a} to {a + len(bad)}")]
    # a truncated tail, and a damaged trailer before another member
    whole = warc.member(b"".join(records))
    found, gaps = told(whole[: len(whole) * 2 // 3])
    assert found == [0, 1, 2] and [g[:2] for g in gaps] == [(0, len(whole) * 2 // 3)]
    hurt = bytearray(whole)
    hurt[-6] ^= 0xFF
    found, gaps = told(bytes(hurt) + page(9, b"z" * 300))
    assert found == [0, 1, 2, 3, 4, 5, 9] and [g[:2] for g in gaps] == [(0, len(whole))]


def test_long_headers_are_read():
    assert told(warc.member(warc.record(3, "u" * (2 << 20), b"x", "d", None))) == ([3], [])


def test_archives_round_trip(spark):
    same = "<p>" + "é" * 200
    rows = [(5, "http://a/\r\n b", same), (3, "u", same), (9, None, same), (1, "u", None), (2, "u", ""), (4, "u", "short"), (6, "u", "short"), (None, "u", same), (3, "u", same), (7, "u", "x" * 300000)]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id bigint, url string, html string, payload string")
    archives = warc.write(warc.roles(pages.repartition(3)), archive_bytes=500)
    assert archives.count() > 3
    got = warc.read(archives).collect()
    assert all(r["gap"] is None for r in got) and len(got) == len(rows)
    want = []
    for i, _, html in rows:
        raw = (html or "").encode()
        refers = 3 if html == same and i != 3 else None
        want.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if refers else "response", refers))
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted([(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got], key=key) == sorted(want, key=key)
    none = warc.write(warc.roles(pages.limit(0)))
    assert warc.read(none).count() == 0


def test_recall_of_the_search(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids = np.array([r["vec_id"] for r in rows])
    vectors = np.array([r["embedding"] for r in rows], dtype=np.float32).astype(np.float64)
    got = ann.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), block_rows=200).collect()
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        score = vectors @ vectors[q]
        order = [k for k in np.lexsort((ids, -score)) if k != q][:20]
        own = sorted((r for r in got if r["query_id"] == ids[q]), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 21))
        assert all(abs(r["score"] - vectors[q] @ vectors[np.flatnonzero(ids == r["vec_id"])[0]]) < 1e-12 for r in own)
        assert all((a["score"], -a["vec_id"]) > (b["score"], -b["vec_id"]) for a, b in zip(own, own[1:], strict=False))
        hits += len({r["vec_id"] for r in own} & {int(ids[k]) for k in order})
        total += 20
    assert hits / total >= 0.9


def test_vectors_that_take_no_part_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [3.0, 0.0]), (2, [3.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, None]), (8, [1.0]), (20, [-1.0, 2.0]), (None, [1.0, 1.0]), (0, [1.0, 0.0])]
    vectors = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id bigint, embedding array<float>, score int")
    got = ann.nearest(vectors, k=3).orderBy("query_id", "rank").collect()
    zero = [(r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == 0]
    assert sorted(zero) == sorted([(1, 1, 3.0), (2, 2, 3.0), (3, 0, 1.0)] * 2)
    assert [(r["vec_id"], r["score"]) for r in got if r["query_id"] == 20] == [(0, -1.0), (0, -1.0), (1, -3.0)]
    assert ann.nearest(vectors.limit(0)).count() == 0


def test_queries_match_their_sql(spark, sf_dir, duck):
    for name, sql in queries.SQL.items():
        if sql is not None:
            assert difference(queries.QUERIES[name](spark, sf_dir), duck, sql) is None, name


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("_row", F.lit("extra"))
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), "test-stage")
        assert docs.count() > 0, name
        if name != "encoding":
            assert docs.columns == columns
        if name in ("quality rules", "near-duplicates"):
            assert docs.count() < n
            n = docs.count()
    empty = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, sf_dir)
        assert empty.count() == 0


def test_windows_go_to_the_last_radius_at_once(monkeypatch):
    """Radii ten times finer cost no more counts, and the nearest are found."""
    monkeypatch.setattr(ann, "RADII", np.concatenate([[0.0], 0.05 * 1.003 ** np.arange(1300)]))
    rng = np.random.default_rng(5)
    vectors = rng.standard_normal((2000, 48))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    index, counts, real = ann.Index(vectors, 1.0, rng.standard_normal((49, ann.PROJECTIONS))), [], ann.Index.following
    monkeypatch.setattr(ann.Index, "following", lambda self, *args: counts.append(1) or real(self, *args))
    asked = list(range(0, 2000, 20))
    hit = 0
    for q, (at, _) in zip(asked, index.nearest(vectors[asked], asked, 20), strict=True):
        products = vectors @ vectors[q]
        products[q] = -2
        hit += len(set(np.argsort(-products)[:20].tolist()) & set(at.tolist()))
    assert hit >= 0.95 * 20 * len(asked)
    assert len(counts) <= 15 * len(asked)
