"""Name normalisation and similarity for master-data matching."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Company suffixes that do not distinguish one master from another.
LEGAL_SUFFIXES = "llc|inc|corp|corporation|ltd|co"


def _plain_letters() -> tuple[str, str]:
    """Accented Latin letters and the letters without their accents."""
    letters = [chr(c) for c in range(0xC0, 0x250)]
    bare = {c: unicodedata.normalize("NFD", c)[0] for c in letters}
    changed = [c for c in letters if bare[c] != c]
    return "".join(changed), "".join(bare[c] for c in changed)


ACCENTED, BARE = _plain_letters()
COMBINING = "[\u0300-\u036f]+"


def normalise(name: Column) -> Column:
    """Lower case, accents dropped, everything but letters and digits of any script to blanks, legal suffix dropped,
    blanks collapsed. Where nothing would be left, the trimmed name itself."""
    folded = F.regexp_replace(F.translate(F.lower(name), ACCENTED, BARE), COMBINING, "")
    trimmed = F.trim(F.regexp_replace(folded, r"[^\p{L}\p{N}\p{M}]+", " "))
    short = F.trim(F.regexp_replace(trimmed, f"( ({LEGAL_SUFFIXES}))+$", ""))
    return F.when(short == "", F.trim(F.lower(name))).otherwise(short)


def confidence(a: Column, b: Column) -> Column:
    """100 for equal names, falling with the share of edited letters; hundredths."""
    longest = F.greatest(F.length(a), F.length(b))
    hundredths = F.call_function(
        "div",
        (longest - F.levenshtein(a, b)).cast("bigint") * 20000 + longest,
        longest.cast("bigint") * 2,
    )
    return F.when(longest == 0, F.lit(100.0)).otherwise(hundredths / F.lit(100.0))


def deletion_variants(name: Column, edits: int) -> Column:
    """The name and every text left after deleting up to ``edits`` letters.

    Two names within ``edits`` edits of each other always share a variant, which turns
    an approximate comparison into an equality join. A variant is shared by a bounded
    number of distinct names, however many names there are.
    """
    variants = F.array(name)
    for _ in range(edits):
        shorter = F.flatten(
            F.transform(
                variants,
                lambda v: F.transform(
                    F.when(F.length(v) > 0, F.sequence(F.lit(1), F.length(v))).otherwise(
                        F.array().cast("array<int>")
                    ),
                    lambda i: F.concat(
                        F.substring(v, F.lit(1), i - 1),
                        F.substring(v, i + 1, F.length(v)),
                    ),
                ),
            )
        )
        variants = F.array_distinct(F.concat(variants, shorter))
    return variants


def route(score: Column, auto: float = 95.0, steward: float = 80.0) -> Column:
    """Who decides on a match of this confidence (0 to 100)."""
    return (
        F.when(score >= auto, "AUTO_APPROVE")
        .when(score >= steward, "STEWARD_REVIEW")
        .otherwise("MANUAL_RESOLUTION")
    )


def confidence_level(score: Column, auto: float = 95.0, steward: float = 80.0) -> Column:
    return F.when(score >= auto, "HIGH").when(score >= steward, "MEDIUM").otherwise("LOW")
