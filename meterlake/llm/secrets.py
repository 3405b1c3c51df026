"""Secret scan with corpus-wide ownership frequency.

Candidates are found in every text by fixed patterns. The digest of each candidate's value is counted
over the whole corpus by distinct repositories and owners: a value beyond both limits is a widely
copied example, any other value that looks random is a live-looking credential. With ``by_text`` all rows of one text
count as one carrier, whose repository and owner are the smallest ones: a leaked document does not become an example by being copied.

Positions come from cutting the text at the matches: the pieces between and the matches themselves give every
start by running sums, in code points. Candidates are exploded only for texts that have any; texts never move.
Counting distinct (value, text or row owner, repository) aggregates before each shuffle, so a value copied into a third of all
texts is one row per task.

NULL and empty texts have no spans. NULL repository or owner counts as a name of its own. Repeated rows
each get their spans; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import stored

# fixed values: base kinds in their order, pattern, and the group whose length decides
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# runs are greedy and maximal, so asking for the least length gives the same spans as dropping short ones
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
# the method's own kind: long runs that mix letters and digits
RANDOM = r"[A-Za-z0-9+/_-]{32,}"
KINDS = ("assign", "access", "hex", "random")
LEAST_ASSIGN = 6
# widely copied: different texts in at least eight repositories of at least five owners
WIDELY = {"max_owners": 4, "max_repositories": 7, "by_text": True}
SPAN = "array<struct<kind:string,rank:int,start:int,stop:int,value:string>>"


def spans_of(text: Column, pattern: str, kind: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches with code-point positions; empty where nothing matches."""
    pieces = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), 0)
    values = F.regexp_extract_all(text, F.lit(pattern), group)
    both = F.zip_with(F.slice(pieces, 1, F.size(matches)), F.arrays_zip(matches.alias("m"), values.alias("v")), lambda p, m: F.struct(p.alias("p"), m["m"].alias("m"), m["v"].alias("v")))
    start = F.struct(F.lit(0).alias("at"), F.lit(None).cast(SPAN).alias("out"))

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + F.length(x["p"])
        stop = begin + F.length(x["m"])
        span = F.struct(
            F.lit(kind).alias("kind"),
            F.lit(KINDS.index(kind)).alias("rank"),
            begin.alias("start"),
            stop.alias("stop"),
            x["v"].alias("value"),
        )
        out = F.concat(F.coalesce(state["out"], F.array().cast(SPAN)), F.array(span).cast(SPAN))
        return F.struct(stop.alias("at"), out.alias("out"))

    found = F.aggregate(both, start, step, lambda s: F.coalesce(s["out"], F.array().cast(SPAN)))
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(SPAN))


def candidates(text: Column) -> Column:
    """All candidate spans of a text, by start and kind."""
    t = F.coalesce(text, F.lit(""))
    assign = F.filter(spans_of(t, ASSIGN, "assign", 2), lambda s: F.length(s["value"]) >= LEAST_ASSIGN)
    mixed = F.filter(
        spans_of(t, RANDOM, "random"),
        lambda s: s["value"].rlike("[A-Za-z]") & s["value"].rlike("[0-9]"),
    )
    every = F.concat(assign, spans_of(t, ACCESS, "access"), spans_of(t, HEX, "hex"), mixed)
    ordered = F.sort_array(F.transform(every, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["stop"].alias("stop"), s["kind"].alias("kind"), s["value"].alias("value"))))
    return ordered


def looks_random(value: Column) -> Column:
    """Many different characters, with letters and digits: not a word, not one key held down."""
    different = F.size(F.array_distinct(F.split(value, "")))
    return (different >= 8) & value.rlike("[A-Za-z]") & value.rlike("[0-9]")


def ownership(found: DataFrame, max_owners: int = 1, max_repositories: int = 1) -> DataFrame:
    """Per value digest: distinct repositories and owners, whether it is a widely copied example, and whether it is a live-looking credential.
    A column ``carrier`` names the text of a row; its rows count once."""
    if "carrier" in found.columns:
        place = F.min(F.struct("owner", "repository")).alias("place")
        found = found.groupBy("digest", "random", "carrier").agg(place).select("digest", "random", "place.*")
    seen = found.select("digest", "random", "repository", "owner").distinct()
    by_owner = seen.groupBy("digest", "random", "owner").agg(F.count(F.lit(1)).alias("n"))
    owners = by_owner.groupBy("digest").agg(
        F.sum("n").alias("n_repositories"),
        F.count(F.lit(1)).alias("n_owners"),
        F.bool_or("random").alias("random"),
    )
    owners = owners.withColumn("example", (F.col("n_owners") > max_owners) & (F.col("n_repositories") > max_repositories))
    return owners.withColumn("live", ~F.col("example") & F.col("random")).drop("random")


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def scan(
    docs: DataFrame,
    text: str = "text",
    repository: list[str] | None = None,
    owner: str = "source",
    keep: list[str] | None = None,
    max_owners: int = 1,
    max_repositories: int = 1,
    by_text: bool = False,
) -> DataFrame:
    """One row per document: the columns ``keep``, ``n_assign, n_access, n_hex``, ``spans`` (array of start, rank,
    stop, kind, value, live, n_owners, n_repositories, example), ``n_live`` and ``n_shared``.

    Spans are all base spans, plus ``random`` ones that are live-looking. The candidate table is narrow and stored
    once, with a number per row, so rows with equal ids stay apart.
    """
    repository = [owner] if repository is None else repository
    keep = [] if keep is None else keep
    rows = stored(
        docs.select(
            F.monotonically_increasing_id().alias("_rid"),
            F.struct(*[F.col(f"`{c}`") for c in keep], F.lit(0).alias("_")).alias("_row"),
            F.struct(*[F.col(f"`{c}`") for c in repository]).cast("string").alias("_repository"),
            F.col(f"`{owner}`").cast("string").alias("_owner"),
            candidates(F.col(f"`{text}`")).alias("_found"),
            *([F.sha2(F.col(f"`{text}`"), 256).alias("_carrier")] if by_text else []),
        ),
        "secret-candidates",
    )
    hits = rows.filter(F.size("_found") > 0)
    each = hits.select("_rid", F.col("_repository").alias("repository"), F.col("_owner").alias("owner"), *([F.col("_carrier").alias("carrier")] if by_text else []), F.explode("_found").alias("s"))
    each = each.withColumns({"digest": F.sha2("s.value", 256), "random": looks_random(F.col("s.value"))})
    verdicts = ownership(each, max_owners, max_repositories)
    judged = each.select("_rid", "s", "digest").join(verdicts, "digest")
    told = F.struct("s.start", "s.rank", "s.stop", "s.kind", "s.value", "live", "n_owners", "n_repositories", "example")
    spans = (
        judged.filter((F.col("s.kind") != "random") | F.col("live"))
        .groupBy("_rid")
        .agg(F.sort_array(F.collect_list(told)).alias("spans"))
    )
    out = rows.drop("_found", "_carrier").join(spans, "_rid", "left")
    none = F.array().cast(dict(spans.dtypes)["spans"])
    out = out.withColumn("spans", F.coalesce("spans", none))
    kinds = F.transform("spans", lambda s: s["kind"])
    count = {f"n_{k}": (F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long") for k in KINDS[:3]}
    count["n_live"] = F.size(F.filter("spans", lambda s: s["live"])).cast("long")
    count["n_shared"] = F.size(F.filter("spans", lambda s: ~s["live"])).cast("long")
    out = out.withColumns(count)
    return out.select(*[F.col(f"_row.`{c}`").alias(c) for c in keep], *count, "spans")


def masked(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with the given spans, in order of their start, replaced by a mark; overlapping spans share one."""
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        between = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        out = F.when(fresh, F.concat(state["out"], between, F.lit(mark))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], s["stop"]).alias("at"), out.alias("out"))

    done = F.aggregate(spans, begin, step)
    return F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))
