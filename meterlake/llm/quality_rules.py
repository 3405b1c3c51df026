"""Line-first cleaning: rules per line, then a verdict per document.

Every line is judged by itself: punctuation (words carrying doubled marks, long lines without
any mark), navigation (separators between short items) and boilerplate (site phrases, markup,
one word over and over). Failing lines are removed. A document that loses too large a share of its letters,
or that fails the base counts, is rejected.

All built-in column functions inside one projection: no shuffle, so a hot source or a group of
copies makes no difference. Memory is one text's word list. NULL and empty texts have no words,
fail the base and are rejected; repeated rows are judged alike; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import words

WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PCT = 30
MAX_LOST_PCT = 30

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_bad_lines")
# fixed values: phrases that mark site furniture rather than prose, in lower case
BOILERPLATE = (
    "all rights reserved",
    "accept cookies",
    "cookie policy",
    "enable javascript",
    "javascript is disabled",
    "lorem ipsum",
    "privacy policy",
    "sign up for our newsletter",
    "skip to content",
    "terms of service",
    "terms of use",
)
SYMBOLS = r"[#*$%&|<>]"
# a word's end of two or more marks that prose does not double
DOUBLED = r"(?:[!?]{2}|[#*$%&|<>]{2})(?=\s|$)"
SEPARATOR = r"[|»›>•·]"
MARK = r"[.,;:!?…。！？]"
BLANK_LINE = r"^[\x20\x09-\x0D]*$"


def letters(text: Column) -> Column:
    """Code points outside blanks."""
    return F.length(F.array_join(words(text), ""))


def line_fault(line: Column) -> Column:
    """The rule a line breaks, NULL if none. Blank lines pass."""
    n = F.size(words(line))
    doubled = F.size(F.regexp_extract_all(line, F.lit(DOUBLED), 0))
    separators = F.size(F.regexp_extract_all(line, F.lit(SEPARATOR), 0))
    marked = line.rlike(MARK)
    phrase = F.lower(line).rlike("|".join(BOILERPLATE)) | line.rlike(r"[{}]|</?[a-zA-Z]+[^>]*>")
    # one word over and over: at most a third of a long line's words are different
    monotone = (n >= 10) & (3 * F.size(F.array_distinct(words(line))) <= n)
    return (
        F.when((n > 0) & (3 * doubled >= n), "punctuation")
        .when((n >= 8) & ~marked, "punctuation")
        .when((separators >= 2) & (4 * separators >= n), "navigation")
        .when(phrase | monotone, "boilerplate")
    )


def with_counts(docs: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """Adds the base counts ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``."""
    t = F.coalesce(F.col(text), F.lit(""))
    step = docs.withColumns(
        {
            "_words": words(F.col(text)),
            "_lines": F.split(t, "\n"),
            "n_symbols": (F.length(t) - F.length(F.regexp_replace(t, SYMBOLS, ""))).cast("long"),
        }
    )
    step = step.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "_hash": F.transform("_words", lambda w: F.xxhash64(w)),
            "_filled": F.filter("_lines", lambda line: ~line.rlike(BLANK_LINE)),
        }
    ).drop("_words")
    starts = F.sequence(F.lit(1), F.col("n_words").cast("int") - (window - 1))
    hashed = F.transform(starts, lambda i: F.xxhash64(*[F.element_at("_hash", i + k) for k in range(window)]))
    step = step.withColumns(
        {
            "_windows": F.when(F.col("n_words") >= window, hashed).otherwise(F.array().cast("array<bigint>")),
            "n_dup_lines": (F.size("_filled") - F.size(F.array_distinct("_filled"))).cast("long"),
        }
    ).drop("_hash", "_filled")
    step = step.withColumn("_repeats", F.size(F.array_distinct("_windows")) < F.size("_windows"))
    # only texts with a repeat pay for sorting; equal hashes end up side by side
    pairs = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    step = step.withColumn("_pairs", F.when(F.col("_repeats"), pairs)).drop("_windows")
    before = F.concat(F.array(F.lit(None).cast("struct<h:bigint,i:int>")), F.slice("_pairs", 1, F.size("_pairs") - 1))
    after = F.concat(F.slice("_pairs", 2, F.size("_pairs") - 1), F.array(F.lit(None).cast("struct<h:bigint,i:int>")))
    near = F.arrays_zip(F.col("_pairs").alias("own"), before.alias("before"), after.alias("after"))
    found = F.filter(
        near,
        lambda p: F.coalesce(p["own"]["h"] == p["before"]["h"], F.lit(False))
        | F.coalesce(p["own"]["h"] == p["after"]["h"], F.lit(False)),
    )
    step = step.withColumn("_at", F.sort_array(F.transform(found, lambda p: p["own"]["i"]))).drop("_pairs")
    # a window covers its width, less what the one before it covered already
    covered = F.aggregate(
        "_at",
        F.struct(F.lit(0).alias("n"), F.lit(-window).alias("last")),
        lambda s, i: F.struct((s["n"] + F.least(F.lit(window), i - s["last"])).alias("n"), i.alias("last")),
        lambda s: s["n"],
    )
    return step.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("_at", "_repeats")


def clean_lines(
    docs: DataFrame,
    text: str = "text",
    min_words: int = MIN_WORDS,
    max_repeated_pct: int = MAX_REPEATED_PCT,
    max_lost_pct: int = MAX_LOST_PCT,
) -> DataFrame:
    """Adds base counts, ``n_bad_lines``, ``lost_chars``, ``cleaned`` (the text without failing lines), ``base_failed`` and ``kept``."""
    own = [F.col(f"`{c}`") for c in docs.columns]
    packed = docs.select(F.struct(*own).alias("_row"), F.col(f"`{text}`").alias("_text"))
    step = with_counts(packed, "_text")
    judged = F.transform("_lines", lambda line: F.struct(line.alias("line"), line_fault(line).alias("fault")))
    step = step.withColumn("_judged", judged).drop("_lines")
    passed = F.transform(F.filter("_judged", lambda j: j["fault"].isNull()), lambda j: j["line"])
    step = step.withColumns(
        {
            "_passed": passed,
            "n_bad_lines": F.size(F.filter("_judged", lambda j: j["fault"].isNotNull())).cast("long"),
        }
    ).drop("_judged")
    cleaned = F.when(F.col("n_bad_lines") == 0, F.col("_text")).otherwise(F.array_join("_passed", "\n"))
    step = step.withColumn("cleaned", cleaned).drop("_passed")
    lost_chars = F.when(F.col("n_bad_lines") == 0, F.lit(0)).otherwise(F.col("word_chars") - letters(F.col("cleaned")))
    told = F.struct(*COUNTS, lost_chars.cast("long").alias("lost_chars"), "cleaned")
    # one generated row per document: a later filter is not pushed below it, where its condition would repeat all of this
    step = step.select("_row", F.explode(F.array(told)).alias("_told")).select("_row", "_told.*")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeated_pct * F.col("n_words"))
    lost = 100 * F.col("lost_chars") > max_lost_pct * F.col("word_chars")
    return step.withColumn("base_failed", failed).withColumn("kept", ~failed & ~lost)
