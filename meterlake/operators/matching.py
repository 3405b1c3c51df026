"""Approximate matching of names against master records.

Names are compared once per distinct normalised form, however many rows carry it. Two names match from a least confidence
on, so the number of edits between them is bounded by their length alone. The nearest names are found first: those one edit apart share
a text with one letter left out, which is an equality join whose groups do not grow with the masters. For what is left, the
shorter name is cut into two segments more than that many edits can touch: two at least stand unchanged in the longer name, near their
own places. An equality join on (length, segment number, segment) counts them, and only pairs with enough are compared in full.

Duplicates form clusters, found by connected components. Names of one cluster are not compared with each other again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.functions.names import confidence, confidence_level, deletion_variants, normalise, route
from meterlake.operators.clusters import components
from meterlake.operators.joins import lookup_join
from meterlake.session import stored

LEAST_CONFIDENCE = 80.0


def distinct_names(df: DataFrame, key: str, name: str) -> DataFrame:
    """One row per normalised name with the lowest id that carries it."""
    return (
        df.select(normalise(F.col(name)).alias("norm"), F.col(key).alias("_key"))
        .filter(F.col("norm") != "")
        .groupBy("norm")
        .agg(F.min("_key").alias("first_id"))
    )


def _edited_share(least: float) -> float:
    """The largest share of the longer name's letters that may be edited; confidence is rounded to hundredths."""
    return (100.0 - least + 0.005) / 100.0


def _edits(length: Column, least: float) -> Column:
    """The most edits that a match of a name of this length with a longer or equal one may have."""
    share = _edited_share(least)
    return F.floor(length * F.lit(share / (1 - share))).cast("int")


def _cuts(length: Column, least: float) -> Column:
    """Two segments more than there may be edits, so that two stand unchanged; short names have one per letter."""
    return F.least(_edits(length, least) + 2, length)


def _segment(length: Column, count: Column, i: Column) -> tuple[Column, Column]:
    """Start and width of a segment: even cuts, the longer ones last."""
    base, short = F.floor(length / count).cast("int"), count - length % count
    start = 1 + (i - 1) * base + F.greatest(F.lit(0), i - 1 - short)
    return start, base + F.when(i > short, 1).otherwise(0)


def _key(piece: Column) -> Column:
    """One number for a segment's length class, number and text. Two that fall together only add a candidate."""
    return F.xxhash64("length", "i", piece).alias("key")


def _indexed(names: DataFrame, least: float, carry: list[str]) -> DataFrame:
    """``key, need`` and the columns ``carry`` for every segment of every name; ``need`` segments of a name stand in each of its matches."""
    cut = names.select(F.col("norm").alias("_text"), F.length("norm").alias("length"), *carry)
    cut = cut.withColumn("_m", _cuts(F.col("length"), least))
    cut = cut.withColumn("need", F.greatest(F.lit(1), F.col("_m") - _edits(F.col("length"), least)))
    cut = cut.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("_m"))))
    start, width = _segment(F.col("length"), F.col("_m"), F.col("i"))
    return cut.select(_key(F.substring("_text", start, width)), "need", *carry)


def _probes(names: DataFrame, least: float, carry: list[str]) -> DataFrame:
    """``key`` and ``carry`` of every text of a longer name where a segment of a shorter one can stand: earlier segments shift it by as many letters
    as edits fit before it, later ones by as many as fit behind it."""
    longest = F.col("_long")
    each = names.select(F.col("norm").alias("_text"), F.length("norm").alias("_long"), *carry)
    shortest = F.greatest(F.lit(1), F.ceil(longest * F.lit(1 - _edited_share(least))).cast("int"))
    each = each.withColumn("length", F.explode(F.sequence(shortest, longest)))
    each = each.withColumn("_m", _cuts(F.col("length"), least)).withColumn("_k", _edits(F.col("length"), least))
    each = each.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("_m"))))
    start, width = _segment(F.col("length"), F.col("_m"), F.col("i"))
    # a letter of shift costs an edit, in front of the segment and again behind it
    grown, k = longest - F.col("length"), F.least(F.col("_k"), F.floor(longest * F.lit(_edited_share(least))).cast("int"))
    spare = F.floor((k - grown) / 2).cast("int")
    first, last = F.greatest(F.lit(1), start - spare), F.least(longest - width + 1, start + grown + spare)
    each = each.withColumns({"_width": width, "_first": first, "_last": last}).filter((F.col("_k") >= grown) & (F.col("_first") <= F.col("_last")))
    each = each.withColumn("_p", F.explode(F.sequence("_first", "_last")))
    return each.select(_key(F.substring("_text", F.col("_p"), F.col("_width"))), *carry).distinct()


def candidates(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """``norm, m_norm``: pairs in which as many segments of the shorter name stand in the longer one as a match must have."""
    pairs = []
    for short, long, names in ((left, right, ("norm", "m_norm")), (right, left, ("m_norm", "norm"))):
        one = _indexed(short.withColumn("short", F.col("norm")), least, ["short"])
        two = _probes(long.withColumn("long", F.col("norm")), least, ["long"])
        met = one.join(two, "key").groupBy("short", "long").agg(F.count(F.lit(1)).alias("n"), F.min("need").alias("need"))
        met = met.filter(F.col("n") >= F.col("need"))
        pairs.append(met.select(F.col("short").alias(names[0]), F.col("long").alias(names[1])))
    return pairs[0].unionByName(pairs[1]).distinct()


def close_names(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """``norm, m_norm, score``: all pairs of a left and a right name whose confidence is at least ``least``."""
    pairs = candidates(left, right, least)
    return pairs.withColumn("score", confidence(F.col("norm"), F.col("m_norm"))).filter(F.col("score") >= least)


def _variants(names: DataFrame, *columns: Column | str) -> DataFrame:
    """``variant`` (a number) and ``columns`` of each name and each text with one letter left out."""
    return names.select(F.explode(F.array_distinct(F.transform(deletion_variants(F.col("norm"), 1), lambda v: F.xxhash64(v)))).alias("variant"), *columns)


def within_one_edit(left: DataFrame, right: DataFrame) -> DataFrame:
    """``norm, m_norm``: all pairs of a left and a right name with one edit at most between them, by an equality join on what is left
    after leaving out one letter. Names that share such a text differ in one letter each, so a group holds few names whatever the
    masters look like."""
    one, two = _variants(left, "norm"), _variants(right, F.col("norm").alias("m_norm"))
    return one.join(two, "variant").select("norm", "m_norm").distinct().filter(F.levenshtein("norm", "m_norm") <= 1)


def match(
    proposals: DataFrame,
    masters: DataFrame,
    proposal_name: str,
    master_key: str,
    master_name: str,
    least: float = LEAST_CONFIDENCE,
) -> DataFrame:
    """Every proposal with its best master: ``golden_id`` and ``match_confidence`` (0 to 100).

    Best is the highest confidence, then the lowest master id. A proposal that reaches ``least`` with
    no master has no golden id and confidence 0. The matches
    are joined back without measuring them, which would compute them twice.
    """
    wanted = proposals.select(normalise(F.col(proposal_name)).alias("norm")).filter(F.col("norm") != "").distinct()
    known = distinct_names(masters, master_key, master_name)
    near = within_one_edit(wanted, known.select("norm")).withColumn("score", confidence(F.col("norm"), F.col("m_norm")))
    near = stored(near.filter(F.col("score") >= least), "near-names")
    # with one edit or none, no other master can be closer; rounding could hide that in names beyond a thousand letters
    settled = near.filter(F.length("norm").between(3, 1000)).select("norm").distinct()
    far = close_names(wanted.join(settled, "norm", "left_anti"), known.select("norm"), least)
    close = near.unionByName(far)
    close = close.join(known.select(F.col("norm").alias("m_norm"), F.col("first_id").alias("golden")), "m_norm")
    best = (
        close.select("norm", "score", "golden")
        .groupBy("norm")
        .agg(F.max_by(F.struct("golden", "score"), F.struct(F.col("score"), -F.col("golden"))).alias("best"))
        .select("norm", F.col("best.golden").alias("golden_id"), F.col("best.score").alias("match_confidence"))
    )
    rows = proposals.withColumn("_norm", normalise(F.col(proposal_name)))
    return (
        lookup_join(rows, best, [("_norm", "norm")], small=False)
        .drop("_norm", "norm")
        .withColumn("match_confidence", F.coalesce("match_confidence", F.lit(0.0)))
    )


def routed(matches: DataFrame, auto: float = 95.0, steward: float = 80.0) -> DataFrame:
    """Matches with the decision path their confidence calls for."""
    score = F.col("match_confidence")
    return matches.withColumns(
        {
            "decision": route(score, auto, steward),
            "auto_approved": score >= auto,
            "dedup_queued": (score < auto) & (score >= steward),
        }
    )


def _name_clusters(names: DataFrame, least: float) -> DataFrame:
    """``first_id, cluster_id`` of the distinct names ``norm, first_id``: the smallest id that close names lead to.

    Names one edit apart are linked first, through the smallest of each group that shares a text with one letter left out. Of the
    remaining pairs only those across the clusters found so far are compared: where all names with a segment are of one
    cluster already, the segment is skipped, so a long series of names costs no pairs.
    """
    first = Window.partitionBy("variant")
    stars = _variants(names, "norm", "first_id").withColumn("hub", F.min(F.struct("first_id", "norm")).over(first))
    stars = stars.filter(F.col("hub.first_id") != F.col("first_id")).select("norm", "first_id", "hub").distinct()
    near = stars.filter(confidence(F.col("norm"), F.col("hub.norm")) >= least)
    close = components(near.select("first_id", F.col("hub.first_id").alias("other")), "first_id", "other")
    known = names.join(close.withColumnRenamed("node", "first_id"), "first_id", "left").withColumn("component", F.coalesce("component", "first_id"))
    known = stored(known.select("norm", "first_id", "component"), "name-clusters")

    index = _indexed(known.withColumn("short", F.struct("norm", "component")), least, ["short"])
    probes = _probes(known.withColumn("long", F.struct("norm", "component")), least, ["long"])
    owners = index.groupBy("key").agg(F.min("short.component").alias("lowest"), F.max("short.component").alias("highest"))
    own = F.col("long.component")
    live = probes.join(owners, "key").filter((F.col("lowest") != own) | (F.col("highest") != own)).select("key", "long")
    met = live.join(index, "key").filter(F.col("long.component") != F.col("short.component"))
    met = met.groupBy("short", "long").agg(F.count(F.lit(1)).alias("n"), F.min("need").alias("need")).filter(F.col("n") >= F.col("need"))
    met = met.filter(confidence(F.col("short.norm"), F.col("long.norm")) >= least)
    across = components(met.select(F.col("short.component").alias("a"), F.col("long.component").alias("b")), "a", "b")
    merged = known.join(across.select(F.col("node").alias("component"), F.col("component").alias("cluster_id")), "component", "left")
    return merged.select("norm", "first_id", F.coalesce("cluster_id", "component").alias("cluster_id"))


def dedup_members(masters: DataFrame, key: str, name: str, least: float = LEAST_CONFIDENCE) -> DataFrame:
    """``cluster_id, record_id, match_score``: every record that has a duplicate, with the smallest id of its cluster.

    Two records belong together if a chain of names, each at least ``least`` close to the next, leads from one to the other. The score compares a
    record with the one that names its cluster, so it may lie below ``least`` where others stand between them. Records without a name have no duplicates.
    """
    known = stored(distinct_names(masters, key, name), "names")
    names = stored(_name_clusters(known, least), "names")
    heads = names.filter(F.col("first_id") == F.col("cluster_id")).select(F.col("cluster_id").alias("_cluster"), F.col("norm").alias("_head"))
    scored = lookup_join(names, heads, [("cluster_id", "_cluster")], "inner", small=False)
    scored = scored.select("norm", "cluster_id", confidence(F.col("norm"), F.col("_head")).alias("match_score"))
    rows = masters.select(F.col(key).alias("record_id"), normalise(F.col(name)).alias("_norm"))
    members = lookup_join(rows, scored, [("_norm", "norm")], "inner", small=False).select("cluster_id", "record_id", "match_score")
    others = members.filter(F.col("record_id") != F.col("cluster_id"))
    shared = others.select("cluster_id").distinct().withColumnRenamed("cluster_id", "record_id")
    return others.unionByName(shared.select(F.col("record_id").alias("cluster_id"), "record_id", F.lit(100.0).alias("match_score")))


def dedup_queue(masters: DataFrame, key: str, name: str, auto: float = 95.0, steward: float = LEAST_CONFIDENCE) -> DataFrame:
    """One pair per record that has a duplicate: the record that names its cluster and itself, with score and confidence level.

    A cluster of n records takes n - 1 decisions, however many of its pairs are close. Members that only others link to the head are LOW.
    """
    members = dedup_members(masters, key, name, steward).filter(F.col("record_id") != F.col("cluster_id"))
    return members.select(F.col("cluster_id").alias("id_1"), F.col("record_id").alias("id_2"), "match_score").withColumn(
        "confidence_level", confidence_level(F.col("match_score"), auto, steward)
    )


def dedup_pairs(masters: DataFrame, key: str, name: str, auto: float = 95.0, steward: float = LEAST_CONFIDENCE) -> DataFrame:
    """Every pair of close records, lower id first, with score and confidence level.

    Each two different names at least ``steward`` close are paired through the first records that carry them, also where others already link
    them; further records of a name are each paired with the first. Records without a name have no pairs.
    """
    known = stored(distinct_names(masters, key, name), "names")
    rows = masters.select(F.col(key).alias("id_2"), normalise(F.col(name)).alias("_norm"))
    same = lookup_join(rows, known, [("_norm", "norm")], "inner", small=False).filter(F.col("id_2") != F.col("first_id"))
    same = same.select(F.col("first_id").alias("id_1"), "id_2", F.lit(100.0).alias("match_score"))
    index = _indexed(known.withColumn("short", F.struct("norm", "first_id")), steward, ["short"])
    probes = _probes(known.withColumn("long", F.struct("norm", "first_id")), steward, ["long"])
    short, long = F.struct(F.length("short.norm"), "short.first_id"), F.struct(F.length("long.norm"), "long.first_id")
    met = index.join(probes, "key").filter(short < long)
    met = met.groupBy("short", "long").agg(F.count(F.lit(1)).alias("n"), F.min("need").alias("need")).filter(F.col("n") >= F.col("need"))
    ids = [F.col("short.first_id"), F.col("long.first_id")]
    score = confidence(F.col("short.norm"), F.col("long.norm"))
    different = met.select(F.least(*ids).alias("id_1"), F.greatest(*ids).alias("id_2"), score.alias("match_score"))
    different = different.filter(F.col("match_score") >= steward)
    return same.unionByName(different).withColumn("confidence_level", confidence_level(F.col("match_score"), auto, steward))


def dedup_clusters(members: DataFrame, auto: float = 95.0, steward: float = LEAST_CONFIDENCE) -> DataFrame:
    """Per cluster of :func:`dedup_members`: its records, its lowest score against the head, and whether it can be merged without a steward."""
    per = members.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n_records"), F.min("match_score").alias("lowest_score"))
    return per.withColumn("confidence_level", confidence_level(F.col("lowest_score"), auto, steward)).withColumn("auto_merge", F.col("lowest_score") >= auto)
