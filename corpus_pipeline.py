"""From raw documents to token ids: quality rules, near-duplicates, secrets, source mix, encoding.

Each stage is one operator over all that the stage before it kept. Its result is written as Parquet in the shared scratch folder and
read again, so a lost executor costs a re-read. All stages but the last return the columns of ``documents``.

NULL texts are rejected by the first stage. Rows are kept, masked and repeated by their place in the table, never by their id: rows with equal or
NULL ids are separate documents, of which the second stage keeps one per group of like texts. Columns beyond those of ``documents`` are carried along
in one struct, whatever their names. Empty tables stay empty.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm import bpe, mixing, neardup, quality_rules, secrets
from meterlake.llm.common import stored, table


def tokenizer() -> str:
    """The public vocabulary file; it is on every machine and never part of the repository."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _replaced(docs: DataFrame, row: str, text: str) -> DataFrame:
    """The columns of ``docs`` from a packed row, with another text and its length."""
    new = {"text": F.col(text), "n_chars": F.length(text).cast("long")}
    return docs.select(*[new.get(c, F.col(f"{row}.`{c}`")).alias(c) for c in docs.select(f"{row}.*").columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop rejected documents and the failing lines of the others."""
    kept = quality_rules.clean_lines(docs).filter("kept")
    return _replaced(kept.select("_row", "cleaned"), "_row", "cleaned")


def _rows(docs: DataFrame) -> DataFrame:
    """``row`` (all columns) and ``n``, a number per row that is the same however often the table is read: the ordinal of its file and its place
    there. A table that is not read from files is written first."""
    packed = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    try:
        placed = docs.select(packed, docs.metadataColumn("_metadata").alias("_at"))
        placed = placed.select("row", F.col("_at.file_path").alias("_file"), F.col("_at.row_index").alias("_place"))
    except AnalysisException:
        return _rows(stored(docs, "pipeline-rows"))
    # one row per file reaches the driver
    files = sorted(r[0] for r in placed.select("_file").distinct().collect())
    ordinal = docs.sparkSession.createDataFrame(list(zip(files, range(len(files)), strict=True)), "_file string, _ordinal bigint")
    number = F.shiftleft(F.col("_ordinal"), 36) + F.col("_place")
    return placed.join(F.broadcast(ordinal), "_file").select("row", number.alias("n"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group: the one with the smallest id, NULL last."""
    rows = _rows(docs)
    groups = neardup.grouped(rows.select(F.col("n").alias("doc_id"), F.col("row.text").alias("text"))).select(F.col("doc_id").alias("n"), "component_id")
    ranked = F.struct(F.col("row.doc_id").isNull().alias("none"), F.col("row.doc_id").alias("id"), "n").alias("rank")
    members = groups.join(rows.select("n", ranked), "n")
    best = members.groupBy("component_id").agg(F.min("rank").alias("best"), F.count(F.lit(1)).alias("size")).filter(F.col("size") > 1)
    gone = members.join(best, "component_id").filter(F.col("n") != F.col("best.n")).select("n")
    return rows.join(gone, "n", "left_anti").select("row.*")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask every span that is not a widely copied example."""
    rows = _rows(docs)
    read = rows.select("n", *[F.col(f"row.{c}").alias(c) for c in ("text", "source", "lang")])
    found = secrets.scan(read, repository=["source", "lang"], owner="source", keep=["n"], **secrets.WIDELY)
    live = F.filter("spans", lambda s: ~s["example"]).alias("spans")
    marked = found.select("n", live).filter(F.size("spans") > 0)
    both = rows.join(marked, "n", "left")
    text = F.col("row.text")
    clean = F.when(F.col("spans").isNotNull(), secrets.masked(text, F.col("spans"))).otherwise(text)
    return _replaced(both.select("row", clean.alias("clean")), "row", "clean")


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it. Which of several documents of one size are taken depends on their ids and texts alone."""
    rows = _rows(docs)
    read = rows.select("n", *[F.col(f"row.{c}").alias(c) for c in ("doc_id", "text", "source")])
    taken = mixing.mix(read, keep=["n"], draw=["doc_id", "text"]).select("n", "copies").filter(F.col("copies") > 0)
    again = rows.join(taken, "n").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return again.select("row.*")


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    lexicon = bpe.compile_lexicon(docs, "text", tokenizer())
    coded = bpe.encode(docs, lexicon)
    return coded.select(
        F.col("_row.doc_id").alias("doc_id"),
        F.col("_row.source").alias("source"),
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
    )


STAGES = [
    ("quality rules", quality),
    ("near-duplicates", near_duplicates),
    ("secret scan", secret_scan),
    ("source mix", source_mix),
    ("encoding", encoding),
]

# cleaning, masking, mixing and merging go beyond one statement; tests compare with plain Python
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
