"""The named queries of these operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm import ann, bpe, collocations, licences, lm, mixing, neardup, prefix_trie, quality_rules, secrets, substrings, toxicity, warc
from meterlake.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

def tokenizer() -> str:
    """The public vocabulary file; it is on every machine and never part of the repository."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register


_W = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"


def _license_sql() -> str:
    known = ", ".join(f"('{i}', '{s}')" for i, s in licences.SENTENCES.items())
    line = "'|' || array_to_string(ids, '||') || '|'"
    for k, (_, parts) in enumerate(licences.RULES):
        line = f"replace({line}, '{''.join(f'|{p}|' for p in parts)}', '<{k}>')"
    names = ", ".join(
        f"CASE WHEN contains(line, '<{k}>') THEN '{name}' END" for k, (name, _) in enumerate(licences.RULES)
    )
    first = ", ".join(f"'{n}'" for n in dict.fromkeys(n for n, _ in licences.RULES))
    return rf"""
WITH known(id, sentence) AS (VALUES {known}),
pieces AS (
  SELECT doc_id, unnest(p) AS s, generate_subscripts(p, 1) AS pos
  FROM (SELECT doc_id, regexp_split_to_array(coalesce(text, ''), '\n|[.!?;:][\x20\x09-\x0D]+') AS p FROM documents)),
hits AS (
  SELECT doc_id, pos, id
  FROM (SELECT doc_id, pos, trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g')) AS n FROM pieces)
  JOIN known ON n = sentence),
rows AS (
  SELECT d.doc_id, coalesce(h.ids, []) AS ids
  FROM documents d LEFT JOIN (SELECT doc_id, list(id ORDER BY pos) AS ids FROM hits GROUP BY doc_id) h USING (doc_id)),
matched AS (SELECT doc_id, ids, CASE WHEN len(ids) = 0 THEN '' ELSE {line} END AS line FROM rows),
named AS (SELECT doc_id, ids, [{names}] AS found FROM matched)
SELECT doc_id, len(ids)::BIGINT AS n_sentences, array_to_string(ids, ',') AS sentence_ids,
  array_to_string(list_filter([{first}], lambda n: list_contains(found, n)), ',') AS licences
FROM named"""


WARC_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN first_id END AS refers_to
FROM f"""


@query("op1_warc_salvage", WARC_SQL)
def warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write(warc.roles(table(spark, sf_dir, "pages")))
    records = warc.read(archives, with_payload=False).filter(F.col("gap").isNull())
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op2_license_sentences", _license_sql())
def license_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.licences(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("_row.doc_id").alias("doc_id"),
        F.size("sentence_ids").cast("long").alias("n_sentences"),
        F.array_join("sentence_ids", ",").alias("sentence_ids"),
        F.array_join("licences", ",").alias("licences"),
    )


@query("op3_collision_counting")
def collision_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


QUALITY_SQL = rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, {_W.format("coalesce(text, '')")} AS ws FROM documents),
lines AS (
  SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM w),
judged AS (
  SELECT doc_id, l, {_W.format("l")} AS lw FROM lines),
filled AS (
  SELECT doc_id, l, lw, len(lw) AS n,
    len(regexp_extract_all(l, '(?:[!?]{{2}}|[#*$%&|<>]{{2}})(?:\s|$)')) AS doubled,
    len(regexp_extract_all(l, '[|»›>•·]')) AS seps,
    regexp_matches(l, '[.,;:!?…。！？]') AS marked,
    regexp_matches(lower(l), '{"|".join(quality_rules.BOILERPLATE)}') OR regexp_matches(l, '[{{}}]|</?[a-zA-Z]+[^>]*>') AS phrase
  FROM judged WHERE len(lw) > 0),
faults AS (
  SELECT doc_id, l, lw, CASE
    WHEN 3 * doubled >= n THEN 1 WHEN n >= 8 AND NOT marked THEN 1 WHEN seps >= 2 AND 4 * seps >= n THEN 1
    WHEN phrase OR (n >= 10 AND 3 * len(list_distinct(lw)) <= n) THEN 1 ELSE 0 END AS bad
  FROM filled),
per AS (
  SELECT doc_id, count(*) - count(DISTINCT l) AS n_dup_lines, sum(bad) AS n_bad_lines,
    sum(CASE WHEN bad = 1 THEN length(array_to_string(lw, '')) ELSE 0 END) AS lost_chars
  FROM faults GROUP BY doc_id),
win AS (
  SELECT doc_id, unnest(range(1, len(ws) - 6)) AS i, ws FROM w WHERE len(ws) >= 8),
seq AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS s FROM win),
rep AS (
  SELECT doc_id, i FROM seq QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
cov AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM rep) GROUP BY doc_id),
base AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    coalesce(n_bad_lines, 0)::BIGINT AS n_bad_lines, coalesce(lost_chars, 0)::BIGINT AS lost_chars
  FROM w LEFT JOIN per USING (doc_id) LEFT JOIN cov USING (doc_id))
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND NOT (100 * lost_chars > 30 * word_chars) AS kept
FROM base"""


@query("op4_line_first_cleaning", QUALITY_SQL)
def line_first_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.clean_lines(table(spark, sf_dir, "documents"))
    return judged.select(
        F.col("_row.doc_id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "n_bad_lines",
        "lost_chars",
        "base_failed",
        "kept",
    )


@query("op5_entropy_balancing")
def entropy_balancing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("rate")


SUBSTRING_SQL = rf"""
WITH w AS (SELECT doc_id, {_W.format("coalesce(text, '')")} AS ws FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13)),
gone AS (SELECT doc_id, i FROM win QUALIFY doc_id > min(doc_id) OVER (PARTITION BY s)),
cov AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM gone),
removed AS (SELECT doc_id, list(p) AS ps FROM cov GROUP BY doc_id),
kept AS (
  SELECT w.doc_id, len(ws) AS n, len(ps) AS k,
    list_filter(list_transform(range(1, len(ws) + 1), lambda i: CASE WHEN ps IS NULL OR NOT list_contains(ps, i) THEN ws[i] END),
      lambda x: x IS NOT NULL) AS left_words
  FROM w LEFT JOIN removed USING (doc_id))
SELECT doc_id, n::BIGINT AS n_words, coalesce(k, 0)::BIGINT AS n_removed, sha256(array_to_string(left_words, ' ')) AS kept_sha256
FROM kept"""


@query("op6_count_min_substrings", SUBSTRING_SQL)
def count_min_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substrings.deduplicated(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op7_transducer_bpe")
def transducer_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lexicon = bpe.compile_lexicon(docs, "text", tokenizer())
    return bpe.digests(docs, lexicon, keep=["doc_id"])


@query("op8_secret_ownership")
def secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(
        table(spark, sf_dir, "documents"), repository=["source", "lang"], owner="source", keep=["doc_id"], **secrets.WIDELY
    )
    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(secrets.joined(base), 256).alias("base_sha256"),
        secrets.joined(F.col("spans")).alias("spans"),
        "n_live",
        "n_shared",
    )


NEARDUP_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b
  FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id
  JOIN n p ON p.doc_id = x.doc_id JOIN n q ON q.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(r.b) AS component_id, d.doc_id = min(r.b) AS kept
FROM documents d JOIN reach r ON r.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
GROUP BY d.doc_id, n.n"""


@query("op9_bbit_minhash", NEARDUP_SQL)
def bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.grouped(table(spark, sf_dir, "documents"), width=4, similar_pct=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op10_kneser_ney")
def kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(part == 2, F.lit(False)))
    model = lm.train(docs.filter(~F.col("held_out")), order=3)
    scored = lm.score(docs, model, keep=["doc_id", "held_out"])
    return scored.withColumn("train_tokens", F.lit(model["tokens"]).cast("long"))


PHRASE_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
said AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
grams AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM said, range(1, 5) t(k))),
f AS (SELECT lang, k, phrase, count(*) AS n FROM grams GROUP BY ALL),
total AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND n >= 30),
cuts AS (
  SELECT lang, phrase, a, j, array_to_string(ws[1:j], ' ') AS lp, array_to_string(ws[j + 1:], ' ') AS rp
  FROM (SELECT *, unnest(range(1, k)) AS j FROM cand)),
scored AS (
  SELECT c.lang, c.phrase, c.a, x.n AS l, y.n AS r, ((2000000::HUGEINT * c.a) // (x.n + y.n))::BIGINT AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.lp JOIN f y ON y.lang = c.lang AND y.phrase = c.rp
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, c.j) = 1),
inner_of AS (
  SELECT lang, array_to_string(ws[s:s + m - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT lang, ws, k, a, m, unnest(range(1, k - m + 2)) AS s FROM (SELECT *, unnest(range(2, k)) AS m FROM cand)) GROUP BY ALL),
kept AS (
  SELECT s.* FROM scored s LEFT JOIN inner_of i USING (lang, phrase) WHERE i.longer IS NULL OR 100 * i.longer < 80 * s.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, t.n, score FROM ranked JOIN total t USING (lang) WHERE rank <= 2000"""


@query("op11_collocations", PHRASE_SQL)
def best_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


TRIE_SQL = rf"""
WITH tab AS (
  SELECT list(v ORDER BY i) AS crc
  FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v FROM range(256) r(i))),
said AS (
  SELECT conv_id AS c, turn, {{'r': coalesce(role, ''), 't': coalesce(text, '')}} AS s, md5(md5(coalesce(role, '')) || md5(coalesce(text, ''))) AS m
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT c, list(s ORDER BY turn NULLS FIRST, m) AS ts,
    [4294967295] || list_transform(range(1, length(c::VARCHAR) + 1), lambda i: ord(substr(c::VARCHAR, i, 1))::BIGINT) AS bytes
  FROM said GROUP BY c),
borrow AS (
  SELECT c, ts, xor(list_reduce(bytes, lambda x, b: xor(x // 256, crc[1 + xor(x, b) % 256])), 4294967295) % 4 AS h FROM own, tab),
conv AS (
  SELECT a.c, list_concat(coalesce(b.ts[1:a.h], []), a.ts[a.h + 1:]) AS ts FROM borrow a LEFT JOIN borrow b ON b.c = a.c - a.c % 20),
member AS (SELECT c, d, ts[1:d] AS p, len(ts) = d AS ends FROM (SELECT c, ts, unnest(range(0, len(ts) + 1)) AS d FROM conv)),
node AS (
  SELECT d, p, min(c) AS conv_id, count(*) AS n, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM member GROUP BY d, p),
parent AS (SELECT x.*, a.conv_id AS parent_conv_id FROM node x LEFT JOIN node a ON a.d = x.d - 1 AND a.p = x.p[1:x.d - 1]),
kids AS (SELECT parent_conv_id AS conv_id, d - 1 AS d, count(*) AS n_children FROM parent WHERE d > 0 GROUP BY ALL),
full_node AS (
  SELECT x.*, coalesce(k.n_children, 0) AS n_children,
    CASE WHEN x.d = 0 THEN 0 ELSE (x.n - 1) * len({_W.format("x.p[x.d].t")}) END AS saved
  FROM parent x LEFT JOIN kids k ON k.conv_id = x.conv_id AND k.d = x.d),
below AS (
  SELECT k AS d, path[1:k] AS p, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT unnest(range(0, d + 1)) AS k, p AS path, n_children, saved FROM full_node) GROUP BY ALL)
SELECT f.conv_id::BIGINT AS conv_id, f.d::BIGINT AS depth, f.parent_conv_id::BIGINT AS parent_conv_id, f.n::BIGINT AS n_convs,
  f.n_children::BIGINT AS n_children, b.n_leaves::BIGINT AS n_leaves, b.saved_tokens::BIGINT AS saved_tokens, f.ends_sha256
FROM full_node f JOIN below b ON b.d = f.d AND b.p = f.p"""


@query("op12_prefix_trie", TRIE_SQL)
def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = prefix_trie.rebuilt(
        table(spark, sf_dir, "conversations"), group=20, borrowed=lambda c: F.crc32(c.cast("string").cast("binary")) % 4
    )
    return prefix_trie.trie(paths)


@query("op13_nearest_toxic")
def nearest_toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    def held_out(doc_id: Column) -> Column:
        return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))

    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id"))))
    return toxicity.score(docs, model).select(
        F.col("_row.doc_id").alias("doc_id"),
        held_out(F.col("_row.doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "vote",
        "evidence",
    )


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the stages lie beside the package; all other queries work without them
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
