"""Slowly changing dimensions as whole-table functions.

A merge takes the table, a batch of staged rows (one per key, see :func:`latest_staged`) and
the time of the change. Tables and batches have unique keys among current rows, so these
joins cannot skew; a small batch is broadcast and the table is not moved.

A merge reads the table more than once. Write its result and read it back before the next
merge, as a daily job does; chaining merges in memory multiplies the work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.functions.times import at
from meterlake.operators.joins import fits_broadcast, lookup_join
from meterlake.operators.keys import highest, numbered, row_hash
from meterlake.schemas import BEGINNING, OPEN_END
from meterlake.session import stored

NEW = "_new_"
ROW = "_row_number"
MATCHED = "_matched"


def latest_staged(staged: DataFrame, key: str, order_by: str) -> DataFrame:
    """The last submission per key."""
    row = F.struct(*[F.col(c) for c in staged.columns])
    return staged.groupBy(F.col(key).alias("_key")).agg(F.max_by(row, order_by).alias("_row")).select("_row.*")


def keyed_join(
    left: DataFrame, right: DataFrame, condition: Column, how: str, small: bool | None = None
) -> DataFrame:
    """Join of tables with unique keys: the right side is broadcast when it provably fits.

    ``small`` passes on what is known already: rows derived one to one from a measured batch
    need no measuring of their own.
    """
    fits = fits_broadcast(right) if small is None else small
    return left.join(F.broadcast(right) if fits else right, condition, how)


def prefixed(staged: DataFrame) -> DataFrame:
    return staged.select(*[F.col(c).alias(NEW + c) for c in staged.columns])


def absent(staged: DataFrame, table: DataFrame, key: str, small: bool | None = None) -> DataFrame:
    """Staged rows whose key the table does not know. The table is reduced to the staged
    keys first, so only those move."""
    wanted = staged.select(F.col(key).alias("_wanted"))
    small = fits_broadcast(staged) if small is None else small
    # a versioned table may hold many rows of one key
    known = lookup_join(table.select(key), wanted, [(key, "_wanted")], "left_semi", small=small).distinct()
    known = known.select(F.col(key).alias("_known"))
    return keyed_join(staged, known, F.col(key) == F.col("_known"), "left_anti", small)


def _pair(table: DataFrame, staged: DataFrame, key: str, small: bool, where: Column | None = None) -> DataFrame:
    """Table rows beside their staged row, if any (``_new_`` columns)."""
    condition = F.col(key) == F.col(NEW + key)
    if where is not None:
        condition = condition & where
    paired = keyed_join(table, prefixed(staged), condition, "left", small)
    return paired.withColumn(MATCHED, F.col(NEW + key).isNotNull())


def _without_new(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(NEW)], MATCHED)


def differs(columns: list[str]) -> Column:
    """Whether any column differs from its staged value; NULL equals NULL."""
    out = F.lit(False)
    for c in columns:
        out = out | ~F.col(c).eqNullSafe(F.col(NEW + c))
    return out


# --- overwriting types ---------------------------------------------------------------------


def scd0(current: DataFrame, staged: DataFrame, key: str) -> DataFrame:
    """Originals are kept: only unknown keys are added."""
    return current.unionByName(absent(staged, current, key), allowMissingColumns=True)


def held_value(table: DataFrame, column: str, kind: str) -> Column:
    """A stamp that rows outside a batch keep; NULL in a table that has none yet."""
    return F.col(column) if column in table.columns else F.lit(None).cast(kind)


def scd1(
    current: DataFrame, staged: DataFrame, key: str, columns: list[str], as_of: str, surrogate: str
) -> DataFrame:
    """Overwrite without history. ``operation`` is INSERT, UPDATE, or NULL where nothing was staged."""
    small, hit = fits_broadcast(staged), F.col(MATCHED)
    held = _without_new(
        _pair(current, staged, key, small).withColumns(
            {
                **{c: F.when(hit, F.col(NEW + c)).otherwise(F.col(c)) for c in columns},
                "updated_at": F.when(hit, at(as_of)).otherwise(held_value(current, "updated_at", "timestamp_ntz")),
                "operation": F.when(hit, F.lit("UPDATE")),
            }
        )
    )
    fresh = numbered(
        absent(staged, current, key, small).select(key, *columns), key, surrogate, highest(current, surrogate) + 1
    ).withColumns({"updated_at": at(as_of), "operation": F.lit("INSERT")})
    return held.unionByName(fresh, allowMissingColumns=True)


def scd_policy(
    current: DataFrame,
    staged: DataFrame,
    key: str,
    policy: dict[str, int],
    as_of: str,
    surrogate: str,
) -> DataFrame:
    """Per attribute: 1 overwrites, 3 also keeps the previous value and the change date.

    ``operation`` is INSERT, UPDATE, NO_CHANGE, or NULL where nothing was staged.
    """
    small, hit = fits_broadcast(staged), F.col(MATCHED)
    tracked = [c for c, kind in policy.items() if kind == 3]
    for c in tracked:
        for extra, kind in ((f"previous_{c}", "string"), (f"{c}_changed_date", "timestamp_ntz")):
            if extra not in current.columns:
                current = current.withColumn(extra, F.lit(None).cast(kind))
    paired = _pair(current, staged, key, small)
    changes: dict[str, Column] = {}
    for c, kind in policy.items():
        if kind == 3:
            moved = hit & differs([c])
            changes[f"previous_{c}"] = F.when(moved, F.col(c).cast("string")).otherwise(F.col(f"previous_{c}"))
            changes[f"{c}_changed_date"] = F.when(moved, at(as_of)).otherwise(F.col(f"{c}_changed_date"))
        changes[c] = F.when(hit, F.col(NEW + c)).otherwise(F.col(c))
    changes["operation"] = F.when(
        hit, F.when(differs(list(policy)), "UPDATE").otherwise("NO_CHANGE")
    )
    held = _without_new(paired.withColumns(changes))
    fresh = numbered(
        absent(staged, current, key, small).select(key, *policy), key, surrogate, highest(current, surrogate) + 1
    ).withColumn("operation", F.lit("INSERT"))
    return held.unionByName(fresh, allowMissingColumns=True)


def scd3(
    current: DataFrame, staged: DataFrame, key: str, tracked: list[str], as_of: str, surrogate: str
) -> DataFrame:
    """Current and previous value side by side, for one or several attributes."""
    return scd_policy(current, staged, key, dict.fromkeys(tracked, 3), as_of, surrogate)


def type3_changes(table: DataFrame, key: str, column: str, as_of: str) -> DataFrame:
    """Rows with a previous value and the days since it was replaced."""
    changed = F.col(f"{column}_changed_date")
    return (
        table.filter(F.col(f"previous_{column}").isNotNull())
        .select(
            key,
            F.col(column).alias("current_name"),
            F.col(f"previous_{column}").alias("previous_name"),
            changed.alias("name_changed_date"),
            F.datediff(at(as_of), changed).alias("days_since_change"),
        )
        .orderBy(F.desc("name_changed_date"), key)
    )


# --- versioned rows --------------------------------------------------------------------------


def scd2_init(
    masters: DataFrame,
    key: str,
    hashed: list[str],
    surrogate: str,
    start: str | Column = BEGINNING,
    created_by: str = "INITIAL_LOAD",
    reason: str = "Initial SCD2 migration",
) -> DataFrame:
    """First version of every member, valid from a low sentinel so that older facts match."""
    begin = at(start) if isinstance(start, str) else start
    return numbered(masters, key, surrogate).withColumns(
        {
            "effective_start_date": begin,
            "effective_end_date": at(OPEN_END),
            "is_current": F.lit(True),
            "version_number": F.lit(1),
            "created_by": F.lit(created_by),
            "change_reason": F.lit(reason),
            "row_hash": row_hash(hashed),
        }
    )


def scd2(
    dim: DataFrame,
    staged: DataFrame,
    key: str,
    attributes: list[str],
    tracked: list[str],
    as_of: str,
    surrogate: str,
    previous: str | None = None,
    hashed: bool = True,
    process: str = "SCD2_PROCESS",
) -> DataFrame:
    """Close changed versions and open new ones; unchanged keys stay as they are.

    A change is a different digest of ``tracked`` or, with ``hashed`` off, a different value
    in one of them. A version ends at the instant the next one starts, so every time has
    exactly one. ``previous`` names an attribute whose old value the new version keeps. The
    batch carries ``updated_by`` and ``change_reason``.
    """
    batch = staged.withColumn("row_hash", row_hash(tracked)) if hashed else staged
    # columns a seeded dimension does not have yet
    missing = dict(batch.dtypes)
    dim = dim.withColumns(
        {c: F.lit(None).cast(missing[c]) for c in attributes if c not in dim.columns}
    )
    for extra, kind in (("updated_by", "string"), ("updated_at", "timestamp_ntz")):
        if extra not in dim.columns:
            dim = dim.withColumn(extra, F.lit(None).cast(kind))
    if previous and f"previous_{previous}" not in dim.columns:
        dim = dim.withColumn(f"previous_{previous}", F.lit(None).cast("string"))

    small = fits_broadcast(batch)
    # beside a small batch one pass over all versions is cheapest; when both sides must be
    # shuffled, closed versions stay where they are and no key has more than one row
    now, past = (dim, None) if small else (dim.filter("is_current"), dim.filter("NOT is_current"))
    paired = _pair(now, batch, key, small, F.col("is_current"))
    changed = F.col(MATCHED) & differs(["row_hash"] if hashed else tracked)
    marked = paired.withColumn("_changed", changed)
    closed = _without_new(
        marked.withColumns(
            {
                "effective_end_date": F.when(F.col("_changed"), at(as_of)).otherwise(F.col("effective_end_date")),
                "updated_at": F.when(F.col("_changed"), at(as_of)).otherwise(F.col("updated_at")),
                "updated_by": F.when(F.col("_changed"), F.lit(process)).otherwise(F.col("updated_by")),
                "is_current": F.col("is_current") & ~F.col("_changed"),
            }
        )
    ).drop("_changed")
    if past is not None:
        closed = closed.unionByName(past)
    opened = {
        "effective_start_date": at(as_of),
        "effective_end_date": at(OPEN_END),
        "is_current": F.lit(True),
    }
    carried = [key, *attributes] + (["row_hash"] if hashed else [])
    versions = marked.filter("_changed").select(
        *[F.col(NEW + c).alias(c) for c in carried],
        (F.col("version_number") + 1).alias("version_number"),
        F.col(NEW + "updated_by").alias("created_by"),
        F.col(NEW + "change_reason").alias("change_reason"),
        *([F.col(previous).alias(f"previous_{previous}")] if previous else []),
    )
    fresh = absent(batch, dim, key, small).select(
        *carried,
        F.lit(1).alias("version_number"),
        F.col("updated_by").alias("created_by"),
        F.lit("New member added").alias("change_reason"),
    )
    added = versions.unionByName(fresh, allowMissingColumns=True).withColumns(opened)
    keyed = numbered(added, key, surrogate, highest(dim, surrogate) + 1)
    return closed.unionByName(keyed, allowMissingColumns=True)


def scd5(
    members: DataFrame, key: str, profile: list[str], profile_key: str = "profile_key"
) -> tuple[DataFrame, DataFrame]:
    """Fast-changing attributes moved to a mini-dimension; members keep a type 1 pointer.

    The profile key is a digest of its attributes: known without a lookup or a running number.
    """
    digest = row_hash(profile)
    mini = members.select(*profile).distinct().withColumn(profile_key, digest)
    outrigger = members.withColumn(profile_key, digest).drop(*profile)
    return mini, outrigger


def scd6(dim: DataFrame, key: str, column: str) -> DataFrame:
    """Every version also shows today's value of an attribute."""
    today = dim.filter("is_current").select(F.col(key).alias("_key"), F.col(column).alias(f"current_{column}"))
    return lookup_join(dim, today, [(key, "_key")]).drop("_key")


# --- current table with history table ----------------------------------------------------------


def scd4(
    current: DataFrame,
    history: DataFrame,
    staged: DataFrame,
    key: str,
    surrogate: str,
    name: str,
    as_of: str,
    last_change_id: int = 0,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Upsert with the replaced values archived.

    The batch carries ``source_system``, ``created_by`` and ``match_confidence``. Returns the
    new current table, the new history and one operation per staged key. A change id is
    used up by actual changes only.
    """
    wanted = ["created_by", "match_confidence", "source_system", name]
    small = fits_broadcast(staged)
    paired_all = _pair(current, staged, key, small)
    paired = paired_all.filter(MATCHED)
    renamed = paired.filter(differs([name]))
    fresh = absent(staged, current, key, small).select(key, *wanted)
    fresh = numbered(fresh, key, surrogate, highest(current, surrogate) + 1)
    changes = renamed.select(F.col(key).alias("_key"), F.lit("UPDATE").alias("_type")).unionByName(
        fresh.select(F.col(key).alias("_key"), F.lit("INSERT").alias("_type"))
    )
    ids = numbered(changes, "_key", "_change_id", last_change_id + 1)

    staged_ids = ids.select("_key", "_change_id")
    with_ids = keyed_join(paired_all, staged_ids, F.col(key) == F.col("_key"), "left", small)
    moved = F.col("_change_id").isNotNull()
    held = _without_new(
        with_ids.withColumns(
            {
                "match_confidence": F.when(moved, F.col(NEW + "match_confidence")).otherwise(F.col("match_confidence")),
                "updated_by": F.when(moved, F.col(NEW + "created_by")).otherwise(held_value(current, "updated_by", "string")),
                "updated_at": F.when(moved, at(as_of)).otherwise(held_value(current, "updated_at", "timestamp_ntz")),
                "change_id": F.when(moved, F.col("_change_id")).otherwise(F.col("change_id")),
                "lifecycle_state": F.when(
                    moved & (F.col("lifecycle_state") != "ACTIVE"), "PROPOSED"
                ).otherwise(F.col("lifecycle_state")),
                name: F.when(moved, F.col(NEW + name)).otherwise(F.col(name)),
            }
        )
    ).drop("_key", "_change_id")
    fresh_ids = keyed_join(fresh, staged_ids, F.col(key) == F.col("_key"), "inner", small)
    inserted = fresh_ids.select(
        surrogate,
        key,
        *wanted,
        F.lit("PROPOSED").alias("lifecycle_state"),
        at(as_of).alias("created_at"),
        F.col("_change_id").alias("change_id"),
    )
    new_current = held.unionByName(inserted, allowMissingColumns=True)

    archived = keyed_join(renamed, staged_ids, F.col(key) == F.col("_key"), "inner", small).select(
        F.col("_change_id").alias("change_id"),
        surrogate,
        name,
        "lifecycle_state",
        "match_confidence",
        "source_system",
        "created_by",
        F.lit("UPDATE").alias("change_type"),
        F.concat(
            F.lit('Name changed from "'),
            F.coalesce(name, F.lit("")),
            F.lit('" to "'),
            F.coalesce(NEW + name, F.lit("")),
            F.lit('"'),
        ).alias("change_reason"),
        at(as_of).alias("created_at"),
        *[F.col(c) for c in ("approved_by", "approved_at") if c in current.columns and c in history.columns],
    )
    logged = inserted.select(
        "change_id",
        surrogate,
        name,
        "lifecycle_state",
        "match_confidence",
        "source_system",
        "created_by",
        F.lit("INSERT").alias("change_type"),
        F.lit("New record added").alias("change_reason"),
        "created_at",
    )
    new_history = history.unionByName(archived, allowMissingColumns=True).unionByName(
        logged, allowMissingColumns=True
    )
    unchanged = paired.filter(~differs([name])).select(key, F.lit("NO_CHANGE").alias("operation"))
    operations = unchanged.unionByName(
        ids.select(F.col("_key").alias(key), F.col("_type").alias("operation"))
    )
    return new_current, new_history, operations


# --- reading versions ----------------------------------------------------------------------------


def as_of(dim: DataFrame, moment: str) -> DataFrame:
    """The version of every member valid at an instant."""
    t = at(moment)
    return dim.filter((F.col("effective_start_date") <= t) & (t < F.col("effective_end_date")))


def as_of_history(
    current: DataFrame, history: DataFrame, key: str, created: str, moment: str, columns: list[str]
) -> DataFrame:
    """The current row if it existed by then, else the latest history row by then.

    A current row is returned with today's values even if they changed later; the
    versioned table answers exactly.
    """
    t = at(moment)
    now = current.filter(F.col(created) <= t).select(key, *columns, created, F.lit("CURRENT").alias("source"))
    row = F.struct(*[F.col(c) for c in (key, *columns, created)])
    latest = (
        history.filter(F.col(created) <= t)
        .groupBy(F.col(key).alias("_key"))
        .agg(F.max_by(row, created).alias("_row"))
        .select("_row.*", F.lit("HISTORY").alias("source"))
    )
    have = now.select(F.col(key).alias("_have"))
    return now.unionByName(keyed_join(latest, have, F.col(key) == F.col("_have"), "left_anti"))


def history(dim: DataFrame, key: str, only: Column | None = None) -> DataFrame:
    """All versions in order."""
    wanted = dim if only is None else dim.filter(only)
    return wanted.orderBy(key, "version_number")


def audit_trail(dim: DataFrame, as_of_time: str) -> DataFrame:
    """Days each version was or has been in force."""
    open_ended = F.col("effective_end_date") == at(OPEN_END)
    end = F.when(open_ended, at(as_of_time)).otherwise(F.col("effective_end_date"))
    return dim.withColumn("days_active", F.datediff(end, F.col("effective_start_date")))


def current_only(dim: DataFrame) -> DataFrame:
    return dim.filter("is_current")


def rollback_version(
    dim: DataFrame,
    keys: DataFrame,
    key: str,
    restored: list[str],
    as_of_time: str,
    by: str,
    reason: str,
    surrogate: str,
    previous: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Reopen the version before the current one as a new version.

    Returns the new dimension and one status per requested key; a first version cannot be
    rolled back, an unknown key is reported.
    """
    asked = keys.select(F.col(key).alias("_asked")).distinct()
    small = fits_broadcast(asked)
    now = keyed_join(dim.filter("is_current"), asked, F.col(key) == F.col("_asked"), "inner", small)
    now = now.select(
        "_asked",
        F.col("version_number").alias("_version"),
        *([F.col(previous).alias("_previous")] if previous else []),
    )
    known = now.select(F.col("_asked").alias("_found"), "_version")
    success = F.col("_version") > 1
    status = keyed_join(asked, known, F.col("_asked") == F.col("_found"), "left", small).select(
        F.col("_asked").alias(key),
        F.coalesce(success, F.lit(False)).alias("success"),
        F.when(F.col("_version").isNull(), "Cannot rollback - key not found")
        .when(~success, "Cannot rollback - this is the first version")
        .otherwise(F.concat(F.lit("Rolled back to version "), (F.col("_version") - 1).cast("string")))
        .alias("message"),
    )
    going = now.filter(success)
    earlier = (F.col(key) == F.col("_asked")) & (F.col("version_number") == F.col("_version") - 1)
    before = keyed_join(dim, going, earlier, "inner", small)
    reopened = before.select(
        key,
        *restored,
        at(as_of_time).alias("effective_start_date"),
        at(OPEN_END).alias("effective_end_date"),
        F.lit(True).alias("is_current"),
        (F.col("_version") + 1).alias("version_number"),
        F.lit(by).alias("created_by"),
        F.lit(f"ROLLBACK: {reason}").alias("change_reason"),
        *([F.col("_previous").alias(f"previous_{previous}")] if previous else []),
    )
    reopened = numbered(reopened, key, surrogate, highest(dim, surrogate) + 1)
    held, past = (dim, None) if small else (dim.filter("is_current"), dim.filter("NOT is_current"))
    ending = keyed_join(
        held, going.select("_asked"), (F.col(key) == F.col("_asked")) & F.col("is_current"), "left", small
    )
    over = F.col("_asked").isNotNull()
    closed = ending.withColumns(
        {
            "effective_end_date": F.when(over, at(as_of_time)).otherwise(F.col("effective_end_date")),
            "is_current": F.col("is_current") & ~over,
        }
    ).drop("_asked")
    if past is not None:
        closed = closed.unionByName(past)
    return closed.unionByName(reopened, allowMissingColumns=True), status


def rollback_change(
    current: DataFrame, history_table: DataFrame, change_id: int, key: str, restored: list[str], as_of_time: str, by: str
) -> tuple[DataFrame, DataFrame]:
    """Restore the values archived under a change id; also a one-row result message."""
    archived = history_table.filter(F.col("change_id") == change_id).select(
        F.col(key).alias("_key"), *[F.col(c).alias(f"_old_{c}") for c in restored]
    )
    small = fits_broadcast(archived)
    paired = keyed_join(current, archived, F.col(key) == F.col("_key"), "left", small)
    hit = F.col("_key").isNotNull()
    values = {c: F.when(hit, F.col(f"_old_{c}")).otherwise(F.col(c)) for c in restored}
    marks = {
        "updated_by": F.when(hit, F.lit(f"ROLLBACK_{by}")).otherwise(held_value(current, "updated_by", "string")),
        "updated_at": F.when(hit, at(as_of_time)).otherwise(held_value(current, "updated_at", "timestamp_ntz")),
    }
    table = paired.withColumns({**values, **marks}).drop("_key", *[f"_old_{c}" for c in restored])
    n = F.count(F.lit(1))
    touched = keyed_join(current.select(key), archived, F.col(key) == F.col("_key"), "inner", small)
    message = touched.agg(n.alias("records")).withColumn(
        "result",
        F.when(
            F.col("records") > 0, F.concat(F.lit("Rolled back "), F.col("records").cast("string"), F.lit(" records"))
        ).otherwise("No changes found for this change_id"),
    )
    return table, message


# --- two time axes ---------------------------------------------------------------------------------


def bitemporal_as_of(table: DataFrame, valid_at: str, known_at: str) -> DataFrame:
    """What was believed at ``known_at`` to hold at ``valid_at``."""
    v, k = at(valid_at), at(known_at)
    return table.filter(
        (F.col("valid_from") <= v)
        & (v < F.col("valid_to"))
        & (F.col("transaction_from") <= k)
        & (k < F.col("transaction_to"))
    )


def bitemporal_correct(
    table: DataFrame, corrections: DataFrame, key: str, columns: list[str], recorded_at: str
) -> DataFrame:
    """Replace what is currently believed from a correction's ``valid_from`` on.

    A correction holds until its ``valid_to`` where the batch has one, else to the end of the believed interval it starts in, or
    of time. Believed intervals that it overlaps are closed on the transaction axis; what it leaves of them before and
    after is believed anew. Corrections for new keys and later starts are added. Corrections of one key
    that overlap each other are refused: which of them holds would be a guess.

    Only believed rows of corrected keys are taken apart, each under a number of its own, so equal rows stay as many as they are. All others
    pass as they lie, without a shuffle where the corrected keys are few.
    """
    ends = F.col("valid_to") if "valid_to" in corrections.columns else F.lit(None).cast("timestamp_ntz")
    new = stored(prefixed(corrections.select(key, "valid_from", ends.alias("valid_to"), *columns)), "corrections")
    believed = F.coalesce(F.col("transaction_to") == at(OPEN_END), F.lit(False))
    wanted = new.select(NEW + key).distinct()
    few = fits_broadcast(wanted)
    same = F.col(key) == F.col(NEW + key)
    untouched = table.filter(~believed).unionByName(keyed_join(table.filter(believed), wanted, same, "left_anti", few))
    touched = keyed_join(table.filter(believed), wanted, same, "left_semi", few)
    touched = stored(touched.withColumn(ROW, F.monotonically_increasing_id()), "corrected-keys")

    start, stop = F.col(NEW + "valid_from"), F.col(NEW + "valid_to")
    holds = same & (F.col("valid_from") <= start) & (start < F.col("valid_to"))
    # a correction, its end, and the interval it starts in; of equal intervals the first
    inside = keyed_join(new.withColumn(NEW + ROW, F.monotonically_increasing_id()), touched, holds, "left")
    own = F.struct(*[F.col(c) for c in (ROW, *table.columns)])
    found = inside.groupBy(*[c for c in new.columns], NEW + ROW).agg(F.min_by(own, ROW).alias("_base"))
    whole = stored(found.withColumn(NEW + "valid_to", F.coalesce(stop, F.col("_base.valid_to"), at(OPEN_END))), "corrections")
    following = F.lead(start).over(Window.partitionBy(NEW + key).orderBy(start, stop))
    clashing = whole.withColumn("_next", following).filter(F.col("_next") < stop).count()
    if clashing:
        raise ValueError(f"{clashing} corrections overlap the next one of their key")

    overlaps = same & (start < F.col("valid_to")) & (F.col("valid_from") < stop)
    met = keyed_join(touched.select(ROW, key, "valid_from", "valid_to"), whole.select(NEW + key, start, stop), overlaps, "inner")
    cuts = met.groupBy(ROW).agg(F.sort_array(F.collect_set(F.struct(start.alias("f"), stop.alias("t")))).alias("_cuts"))
    swept = touched.join(cuts, ROW, "left")
    hit = F.col("_cuts").isNotNull()
    closed = swept.withColumn("transaction_to", F.when(hit, at(recorded_at)).otherwise(F.col("transaction_to"))).select(*table.columns)
    # what is left of an interval lies between neighbouring corrections
    froms = F.concat(F.array("valid_from"), F.transform("_cuts", lambda c: c["t"]))
    tos = F.concat(F.transform("_cuts", lambda c: c["f"]), F.array("valid_to"))
    gaps = F.explode(F.arrays_zip(froms.alias("f"), tos.alias("t"))).alias("_gap")
    left = swept.filter(hit).select(*table.columns, gaps).filter(F.col("_gap.f") < F.col("_gap.t"))
    fresh = {"transaction_from": at(recorded_at), "transaction_to": at(OPEN_END)}
    rest = left.withColumns({"valid_from": F.col("_gap.f"), "valid_to": F.col("_gap.t"), **fresh}).select(*table.columns)
    # columns outside the correction come from the interval it starts in
    said = {key: F.col(NEW + key), "valid_from": start, "valid_to": stop, **{c: F.col(NEW + c) for c in columns}, **fresh}
    corrected = whole.select(*[said.get(c, F.col(f"_base.`{c}`")).alias(c) for c in table.columns])
    return untouched.unionByName(closed).unionByName(rest).unionByName(corrected)
