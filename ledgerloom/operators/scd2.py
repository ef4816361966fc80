"""Type 2 history for a dimension: new state of all versions from old state and a batch.

The old state is never changed in place. The set of changed keys is therefore
always computed from the state before anything was closed, and rerunning a day
gives the same versions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.calendar import EPOCH, or_epoch
from ledgerloom.operators.running import number_dense
from ledgerloom.operators.shaping import any_distinct, current_versions
from ledgerloom.operators.temporal import VALID_FROM, VALID_TO
from ledgerloom.session import settle

CURRENT, CREATED, UPDATED = "vigente", "criado_em", "atualizado_em"
CONTROL = [VALID_FROM, VALID_TO, CURRENT, CREATED, UPDATED]

CHANGED, MISSING, SAME = "changed", "missing", "same"

#: Column that places a stored version: open ones together, closed ones by the day of their end.
SLICE, OPEN = "fatia", "aberta"


def batch_status(dim: DataFrame, batch: DataFrame, key: str, monitored: Sequence[str]) -> DataFrame:
    """Batch rows with their ``__status``: changed, missing (no current version) or same."""
    old = current_versions(dim).select(
        F.col(key).alias("__old_key"), *(F.col(name).alias(f"__old_{name}") for name in monitored)
    )
    differs = any_distinct((F.col(name), F.col(f"__old_{name}")) for name in monitored)
    status = F.when(F.col("__old_key").isNull(), MISSING).when(differs, CHANGED).otherwise(SAME)
    joined = batch.filter(F.col(key).isNotNull()).join(old, batch[key] == old["__old_key"], "left")
    return joined.withColumn("__status", status).select(*batch.columns, "__status")


def changed_keys(dim: DataFrame, batch: DataFrame, key: str, monitored: Sequence[str]) -> DataFrame:
    """Keys whose current version differs from the batch in a monitored column."""
    return batch_status(dim, batch, key, monitored).filter(F.col("__status") == CHANGED).select(key)


def keys_without_current(dim: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Batch keys that have no current version, brand-new ones and stranded ones alike."""
    return batch.select(key).join(current_versions(dim).select(key), key, "left_anti").filter(F.col(key).isNotNull())


def keys_to_open(dim: DataFrame, batch: DataFrame, key: str, monitored: Sequence[str]) -> DataFrame:
    """Distinct keys that get a new current version."""
    return changed_keys(dim, batch, key, monitored).union(keys_without_current(dim, batch, key)).distinct()


def last_end(dim: DataFrame, key: str) -> DataFrame:
    """Latest known end of each key's versions; open ends do not count."""
    return dim.groupBy(key).agg(F.max(VALID_TO).alias("last_end"))


def close_versions(dim: DataFrame, keys: DataFrame, key: str, reference: date, now: datetime) -> DataFrame:
    """State of all versions after the current ones of the given keys were closed."""
    hits = keys.select(F.col(key).alias("__hit"))
    closing = F.col(CURRENT) & F.col("__hit").isNotNull()
    return (
        dim.join(hits, dim[key] == hits["__hit"], "left")
        .withColumns(
            {
                VALID_TO: F.when(closing, F.lit(reference)).otherwise(F.col(VALID_TO)),
                UPDATED: F.when(closing, F.lit(now)).otherwise(F.col(UPDATED)),
                CURRENT: F.when(closing, F.lit(False)).otherwise(F.col(CURRENT)),
            }
        )
        .drop("__hit")
    )


def refresh_versions(
    dim: DataFrame, batch: DataFrame, key: str, monitored: Sequence[str], now: datetime
) -> DataFrame:
    """Current versions of unchanged keys with the batch's unmonitored columns, no new version."""
    plain = [name for name in batch.columns if name != key and name not in monitored]
    status = batch_status(dim, batch, key, monitored).filter(F.col("__status") == SAME)
    fresh = status.select(F.col(key).alias("__hit"), *(F.col(name).alias(f"__new_{name}") for name in plain))
    hit = F.col(CURRENT) & F.col("__hit").isNotNull()
    values = {name: F.when(hit, F.col(f"__new_{name}")).otherwise(F.col(name)) for name in plain}
    values[UPDATED] = F.when(hit, F.lit(now)).otherwise(F.col(UPDATED))
    return dim.join(fresh, dim[key] == fresh["__hit"], "left").withColumns(values).select(*dim.columns)


def first_versions(batch: DataFrame, key: str, surrogate: str, now: datetime) -> DataFrame:
    """The dimension after its first load: one open version per row, valid from the start of history."""
    opened = batch.withColumns(
        {
            VALID_FROM: F.lit(EPOCH),
            VALID_TO: F.lit(None).cast("date"),
            CURRENT: F.lit(True),
            CREATED: F.lit(now),
            UPDATED: F.lit(now),
        }
    )
    return number_dense(opened, [key], surrogate, F.lit(0).cast("bigint"))


def highest_key(dim: DataFrame, surrogate: str) -> Column:
    """The largest surrogate key so far, 0 without any."""
    return dim.agg(F.coalesce(F.max(surrogate), F.lit(0)).cast("bigint")).scalar()


def apply_batch(
    dim: DataFrame,
    batch: DataFrame,
    key: str,
    monitored: Sequence[str],
    reference: date,
    surrogate: str,
    now: datetime,
    highest: Column | None = None,
) -> DataFrame:
    """All versions after the batch was applied. The key must be unique in the batch.

    A changed key closes its current version on the reference day and opens a new
    one; a key without a current version opens one where its last version ended,
    or at the start of history; an unchanged key only refreshes its unmonitored
    columns; keys absent from the batch stay as they are. A version that would
    start on a day on which the key already has one is reopened in place and
    keeps its surrogate key.

    The batch, which is small, is joined to narrow slices of the dimension to
    plan the work; the wide dimension is joined once.
    """
    attributes = [name for name in batch.columns if name != key]
    plain = [name for name in attributes if name not in monitored]
    added = [name for name in attributes if name not in dim.columns]
    dim = dim.withColumns({name: F.lit(None).cast(batch.schema[name].dataType) for name in added})
    dim = dim.withColumns(
        {name: F.lit(None).cast("timestamp") for name in (CREATED, UPDATED) if name not in dim.columns}
    )

    ends = last_end(dim, key).withColumnRenamed(key, "__end_key")
    status = batch_status(dim, batch, key, monitored)
    closing_day = F.when(F.col("__status") == CHANGED, F.lit(reference))
    plan = (
        status.join(ends, status[key] == ends["__end_key"], "left")
        .withColumn("__start", or_epoch(F.greatest(F.col("last_end"), closing_day)))
        .drop("__end_key", "last_end")
    )

    # Wide parts are SQL text over three flags: one expression per column, and small plans.
    planned = plan.selectExpr(
        f"`{key}` AS __hit", "__status", "__start", *(f"`{name}` AS `__new_{name}`" for name in attributes)
    )
    opens = F.col("__status").isin(CHANGED, MISSING)
    is_current, status_is = F.col(CURRENT), lambda name: F.col("__status") == name
    flagged = dim.join(planned, dim[key] == planned["__hit"], "left").withColumns(
        {
            "__reopened": F.coalesce(opens & (F.col(VALID_FROM) == F.col("__start")), F.lit(False)),
            "__ended": F.coalesce(is_current & status_is(CHANGED), F.lit(False)),
            "__same": F.coalesce(is_current & status_is(SAME), F.lit(False)) if plain else F.lit(False),
        }
    )
    backwards = f"reference day {reference} lies before the start of a current version"
    rules = {name: f"CASE WHEN __reopened THEN `__new_{name}` ELSE `{name}` END" for name in attributes}
    rules |= {name: f"CASE WHEN __reopened OR __same THEN `__new_{name}` ELSE `{name}` END" for name in plain}
    rules[VALID_TO] = (
        f"CASE WHEN __reopened THEN NULL WHEN __ended AND {VALID_FROM} > DATE '{reference}' "
        f"THEN CAST(raise_error('{backwards}') AS DATE) WHEN __ended THEN DATE '{reference}' ELSE {VALID_TO} END"
    )
    rules[CURRENT] = f"CASE WHEN __reopened THEN true WHEN __ended THEN false ELSE {CURRENT} END"
    rules[UPDATED] = f"CASE WHEN __reopened OR __ended OR __same THEN __now ELSE {UPDATED} END"
    stamp = F.lit(now).cast(dim.schema[UPDATED].dataType)
    kept = flagged.withColumn("__now", stamp).selectExpr(
        *(f"{rules[name]} AS `{name}`" if name in rules else f"`{name}`" for name in dim.columns)
    )

    starts = dim.select(F.col(key).alias("__key"), F.col(VALID_FROM).alias("__from"))
    to_open = plan.filter(opens)
    opened = to_open.join(
        starts, (to_open[key] == starts["__key"]) & (to_open["__start"] == starts["__from"]), "left_anti"
    ).select(
        *batch.columns,
        F.col("__start").alias(VALID_FROM),
        F.lit(None).cast("date").alias(VALID_TO),
        F.lit(True).alias(CURRENT),
        F.lit(now).cast(dim.schema[CREATED].dataType).alias(CREATED),
        F.lit(now).cast(dim.schema[UPDATED].dataType).alias(UPDATED),
    )
    if highest is None:
        highest = highest_key(dim, surrogate)
    numbered = number_dense(opened, [key], surrogate, highest)
    return kept.unionByName(numbered, allowMissingColumns=True).select(*dim.columns)


def with_slice(versions: DataFrame) -> DataFrame:
    """Versions with the slice they are stored in."""
    closed = F.coalesce(F.date_format(VALID_TO, "yyyy-MM-dd"), F.lit("sem-fim"))
    return versions.withColumn(SLICE, F.when(F.col(CURRENT), F.lit(OPEN)).otherwise(closed))


@dataclass(frozen=True)
class SliceChanges:
    """What a load leaves of the slices it touches: first ``closed`` is to be written, then ``opened``."""

    closed: DataFrame | None
    closed_slices: list[str]
    opened: DataFrame


def apply_to_slices(
    stored: DataFrame,
    batch: DataFrame,
    key: str,
    monitored: Sequence[str],
    reference: date,
    surrogate: str,
    now: datetime,
) -> SliceChanges:
    """``apply_batch`` over versions stored by slice, rewriting only the open slice and that of the reference day.

    Of closed versions only key, start, end and surrogate key are read, and those are kept of the keys that get a new
    version, for the end of their last one. A closed version is changed in one case only: it has no day of its
    own and its key comes back on that day; then its slice is rewritten as well. Written in the order closed, open, a
    load that stops in between can be run again: a closing that is there already is not added twice.
    """
    current = stored.filter(F.col(SLICE) == OPEN)
    closed = stored.filter(F.col(SLICE) != OPEN)
    keys = settle(keys_to_open(current, batch, key, monitored), "keys-to-open")
    narrow = closed.select(key, VALID_FROM, VALID_TO, surrogate, SLICE).join(keys, key, "left_semi")
    past = settle(narrow.withColumn(CURRENT, F.lit(False)), "past-versions")
    empty = F.col(VALID_TO) <= F.col(VALID_FROM)
    # Days on which versions of these keys began and ended at once: as a rule none.
    days = [row[0] for row in past.filter(empty).select(SLICE).distinct().collect()]
    whole = closed.filter(F.col(SLICE).isin(days) & empty).join(keys, key, "left_semi")
    stubs = past.filter(~F.coalesce(empty, F.lit(False))).withColumn(SLICE, F.lit(None).cast("string"))
    before = current.unionByName(whole).unionByName(stubs, allowMissingColumns=True).withColumn("__known", F.lit(True))

    state = apply_batch(before, batch, key, monitored, reference, surrogate, now, highest_key(stored, surrogate))
    state = state.withColumnRenamed(SLICE, "__from_slice").filter("__known is null or __from_slice is not null")
    state = settle(with_slice(state).drop("__known"), "versions")
    moved = state.filter((F.col("__from_slice") != F.col(SLICE)) & F.col("__from_slice").isNotNull())
    touched = {row[0] for row in moved.select(F.explode(F.array("__from_slice", SLICE))).distinct().collect()} - {OPEN}
    opened = state.filter(F.col(SLICE) == OPEN).drop("__from_slice")
    if not touched:
        return SliceChanges(None, [], opened)
    stay = closed.filter(F.col(SLICE).isin(sorted(touched))).join(moved.select(surrogate), surrogate, "left_anti")
    closings = moved.filter(F.col(SLICE) != OPEN).drop("__from_slice")
    return SliceChanges(stay.unionByName(closings, allowMissingColumns=True), sorted(touched), opened)
