"""Master-data governance: missing references, proposals, approvals, golden ids, audit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.functions.exact import round_ratio
from meterlake.functions.times import at
from meterlake.operators import matching
from meterlake.operators.joins import fits_broadcast, lookup_join, unmatched
from meterlake.operators.keys import highest, numbered
from meterlake.operators.ranges import id_ranges, merge_ranges, outside
from meterlake.operators.scd import keyed_join
from meterlake.operators.tables import first_rows, without_keys

# entity -> trip columns that refer to it
REFERENCES = {
    "VENDOR": ["vendorid"],
    "ZONE": ["pulocationid", "dolocationid"],
    "RATECODE": ["ratecodeid"],
}
SOURCE_KEYS = {"VENDOR": "source_vendor_id", "ZONE": "source_zone_id", "RATECODE": "source_ratecode_id"}
IDS = {"VENDOR": "vendor_id", "ZONE": "zone_id", "RATECODE": "ratecode_id"}
NAMES = {"VENDOR": "vendor_name", "ZONE": "zone_name", "RATECODE": "rate_code_desc"}


def references(trips: DataFrame) -> DataFrame:
    """How often trips refer to each (entity, source id), from one scan: the four keys of a
    trip are unfolded and counted where they lie before anything is shuffled."""
    refs = F.array(
        *[
            F.struct(F.lit(entity).alias("entity_type"), F.col(c).cast("bigint").alias("source_id"))
            for entity, columns in REFERENCES.items()
            for c in columns
        ]
    )
    return (
        trips.select(F.inline(refs))
        .filter(F.col("source_id").isNotNull())
        .groupBy("entity_type", "source_id")
        .agg(F.count(F.lit(1)).alias("n_references"))
    )


def master_ids(masters: dict[str, DataFrame]) -> DataFrame:
    """Source ids of all masters, stacked."""
    parts = [
        df.select(F.lit(e).alias("entity"), F.col(SOURCE_KEYS[e]).cast("bigint").alias("known_id"))
        for e, df in masters.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def missing_references(trips: DataFrame, masters: dict[str, DataFrame]) -> DataFrame:
    """References in trips that no master covers."""
    return unmatched(
        references(trips), master_ids(masters), [("entity_type", "entity"), ("source_id", "known_id")]
    )


def propose(
    masters: DataFrame,
    routed: DataFrame,
    entity: str,
    proposal_key: str,
    proposal_name: str,
    as_of: str,
    by: str,
    source_system: str,
) -> DataFrame:
    """Masters plus, as PROPOSED, every proposal that was not matched automatically."""
    key, name, surrogate = SOURCE_KEYS[entity], NAMES[entity], IDS[entity]
    new = routed.filter(~F.col("auto_approved")).select(
        F.col(proposal_key).alias(key), F.col(proposal_name).alias(name), "match_confidence"
    )
    fresh = numbered(without_keys(new, masters, [key]), key, surrogate, highest(masters, surrogate) + 1)
    return masters.unionByName(
        fresh.withColumns(
            {
                "match_confidence": F.col("match_confidence").cast("decimal(5,2)"),
                "lifecycle_state": F.lit("PROPOSED"),
                "source_system": F.lit(source_system),
                "created_at": at(as_of),
                "created_by": F.lit(by),
            }
        ),
        allowMissingColumns=True,
    )


def approve(masters: DataFrame, chosen: DataFrame, key: str, by: str, as_of: str) -> DataFrame:
    """Activate the records whose key is listed, with approver and time."""
    if "approved_at" not in masters.columns:
        masters = masters.withColumn("approved_at", F.lit(None).cast("timestamp_ntz"))
    listed = chosen.select(F.col(key).alias("_chosen")).distinct()
    marked = keyed_join(masters, listed, F.col(key) == F.col("_chosen"), "left")
    hit = F.col("_chosen").isNotNull()
    return marked.withColumns(
        {
            "lifecycle_state": F.when(hit, "ACTIVE").otherwise(F.col("lifecycle_state")),
            "approved_at": F.when(hit, at(as_of)).otherwise(F.col("approved_at")),
            "approved_by": F.when(hit, F.lit(by)).otherwise(F.col("approved_by")),
        }
    ).drop("_chosen")


def approve_batch(masters: DataFrame, key: str, n: int, by: str, as_of: str) -> DataFrame:
    """Activate at most ``n`` pending records, lowest keys first."""
    waiting = F.col("lifecycle_state") == "PROPOSED"
    return approve(masters, first_rows(masters, waiting, key, n, key), key, by, as_of)


def approval_status(masters: dict[str, DataFrame]) -> DataFrame:
    """Pending, approved and rejected records per entity and whether none is pending."""
    stacked = reduce(
        DataFrame.unionByName,
        [df.select(F.lit(e).alias("entity_type"), "lifecycle_state") for e, df in masters.items()],
    )
    state = F.col("lifecycle_state")
    return (
        stacked.groupBy("entity_type")
        .agg(
            F.count_if(state == "PROPOSED").alias("pending"),
            F.count_if(state == "ACTIVE").alias("approved"),
            F.count_if(state == "REJECTED").alias("rejected"),
        )
        .withColumn("all_approved", F.col("pending") == 0)
    )


def _active(masters: DataFrame, entity: str, alias: str) -> DataFrame:
    return masters.filter(F.col("lifecycle_state") == "ACTIVE").select(
        F.col(SOURCE_KEYS[entity]).alias(f"_{alias}"), F.col(IDS[entity]).alias(f"{alias}_golden_id")
    )


def attach_golden_ids(trips: DataFrame, masters: dict[str, DataFrame]) -> DataFrame:
    """Trips with the ids of their active masters; NULL where none is in force."""
    out = trips
    small = {e: fits_broadcast(_active(df, e, "m")) for e, df in masters.items()}
    for entity, column, alias in (
        ("VENDOR", "vendorid", "vendor"),
        ("ZONE", "pulocationid", "pu_zone"),
        ("ZONE", "dolocationid", "do_zone"),
        ("RATECODE", "ratecodeid", "ratecode"),
    ):
        ids = _active(masters[entity], entity, alias)
        out = lookup_join(out, ids, [(column, f"_{alias}")], small=small[entity]).drop(f"_{alias}")
    return out


def reenrich(trips: DataFrame, approved: DataFrame, masters: dict[str, DataFrame]) -> DataFrame:
    """Golden ids for just those trips that refer to a newly approved (entity_type, source_id)."""
    touched = F.lit(False)
    out = trips
    for i, (entity, column) in enumerate((e, c) for e, cs in REFERENCES.items() for c in cs):
        keys = approved.filter(F.col("entity_type") == entity).select(F.col("source_id").alias(f"_a{i}")).distinct()
        out = lookup_join(out, keys, [(column, f"_a{i}")])
        touched = touched | F.col(f"_a{i}").isNotNull()
    waiting = out.filter(touched).select(*trips.columns)
    return attach_golden_ids(waiting, masters)


def next_batch(trips: DataFrame, tracker: DataFrame, size: int, key: str = "trip_id") -> DataFrame:
    """The next unprocessed trips in key order. A set-based run takes all of them at once,
    see :func:`unprocessed`; this is for a caller that wants one batch."""
    return unprocessed(trips, tracker, key).orderBy(key).limit(size)


def unprocessed(trips: DataFrame, tracker: DataFrame, key: str = "trip_id") -> DataFrame:
    """Trips that the tracker does not name. It lists ids, or ranges of them as :func:`track` keeps them, which are looked up
    without moving the trips."""
    if {"block", "first_id", "last_id"} <= set(tracker.columns):
        return outside(trips, key, tracker)
    seen = tracker.select(F.col(key).alias("_seen"))
    return keyed_join(trips, seen, F.col(key) == F.col("_seen"), "left_anti")


def track(tracker: DataFrame | None, done: DataFrame, key: str = "trip_id") -> DataFrame:
    """The tracker after a run: the ranges of all ids processed so far. A run repeated in part changes nothing."""
    new = id_ranges(done, key)
    return new if tracker is None else merge_ranges(tracker, new)


def audit_record(
    enriched: DataFrame, run_id: str, entity: str, triggered_by: str, started: str, ended: str
) -> DataFrame:
    """One row about a run: trips processed, fully resolved, and their share."""
    golden = [c for c in enriched.columns if c.endswith("_golden_id")]
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in golden])
    approved = F.count_if(whole)
    return enriched.agg(
        F.count(F.lit(1)).alias("records_processed"),
        approved.alias("records_approved"),
        F.coalesce(round_ratio(approved * 100, F.count(F.lit(1)), 2), F.lit(0.0)).alias("quality_score"),
    ).select(
        F.lit(run_id).alias("pipeline_run_id"),
        F.lit(triggered_by).alias("triggered_by"),
        F.lit(entity).alias("entity_type"),
        "*",
        F.when(F.col("records_processed") > 0, "SUCCESS").otherwise("NO_DATA").alias("status"),
        at(started).alias("run_start"),
        at(ended).alias("run_end"),
    )


def listed(masters: dict[str, DataFrame], only: dict[str, DataFrame]) -> DataFrame:
    """Chosen records of all entities under common column names."""
    parts = []
    for entity, df in masters.items():
        if entity not in only:
            continue
        key = SOURCE_KEYS[entity]
        chosen = only[entity].select(F.col(key).alias("_chosen")).distinct()
        parts.append(
            keyed_join(df, chosen, F.col(key) == F.col("_chosen"), "left_semi").select(
                F.lit(entity).alias("type"),
                F.col(IDS[entity]).cast("bigint").alias("id"),
                F.col(NAMES[entity]).alias("name"),
                "lifecycle_state",
                "approved_by",
            )
        )
    return reduce(DataFrame.unionByName, parts)


def match_temp(
    matches: DataFrame, run_id: str, entity: str, proposal_key: str, proposal_name: str
) -> DataFrame:
    """Match candidates in the layout of the staging table."""
    return matching.routed(matches).select(
        F.lit(run_id).alias("pipeline_run_id"),
        F.lit(entity).alias("entity_type"),
        F.col(proposal_key).cast("string").alias("source_id"),
        F.col(proposal_name).alias("proposed_name"),
        "golden_id",
        "match_confidence",
        F.when(F.col("auto_approved"), "ACTIVE").otherwise("PROPOSED").alias("lifecycle_state"),
        "auto_approved",
        "dedup_queued",
        "decision",
    )
