"""Data-quality checks. Reports are frames; guards act on a report and raise."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.calendar import hours_since
from ledgerloom.session import fresh_path

# Limits of the guards.
DROP_LIMIT = 0.3
MAX_AGE_HOURS = 26


class LoadRefused(RuntimeError):
    """A guard stopped a load."""


def row_count(df: DataFrame, condition: Column | None = None) -> DataFrame:
    """Number of rows, or of rows that meet the condition."""
    counted = df if condition is None else df.filter(condition)
    return counted.agg(F.count("*").alias("row_count"))


def drop_ratio(current: Column, previous: Column) -> Column:
    """Share of rows lost, in doubles; null when there was nothing before."""
    return F.when(previous != 0, F.lit(1.0) - current / previous)


def abnormal_drop(current: Column, previous: Column, limit: float = DROP_LIMIT) -> Column:
    """True when more than the limit was lost. Exactly 30 percent is more, by double rounding."""
    return F.coalesce(drop_ratio(current, previous) > limit, F.lit(False))


def refuse_abnormal_drop(current: int, previous: int, entity: str, limit: float = DROP_LIMIT) -> None:
    if previous != 0 and 1 - current / previous > limit:
        raise LoadRefused(f"rows of '{entity}' fell from {previous} to {current}, more than {limit:.0%}")


def coverage_diff(known: DataFrame, incoming: DataFrame, code: str, description: str) -> DataFrame:
    """Codes that were added to or removed from a code list, compared as text."""

    def texts(df: DataFrame, side: str) -> DataFrame:
        return df.groupBy(F.col(code).cast("string").alias("code")).agg(F.max(description).alias(side))

    old, new = texts(known, "__old").withColumn("__had", F.lit(1)), texts(incoming, "__new").withColumn("__got", F.lit(1))
    both = old.join(new, "code", "full_outer").filter("__had is null or __got is null")
    change = F.when(F.col("__had").isNull(), "added").otherwise("removed")
    return both.select("code", F.coalesce("__new", "__old").alias("description"), change.alias("change"))


def failed_slices(status: DataFrame, slice_column: str, error: str) -> DataFrame:
    """Slices that failed, in order. An empty result is no failure."""
    return status.filter(F.col(error).isNotNull()).select(slice_column, error).orderBy(slice_column)


def refuse_incomplete(status: DataFrame, slice_column: str, error: str, entity: str, shown: int = 100) -> None:
    """Raise if any slice failed. All failures are written as a table, which the message names with their number.

    The message itself shows the first of them.
    """
    path = fresh_path(status.sparkSession, f"{entity}-failures")
    failed_slices(status, slice_column, error).write.parquet(path)
    failures = status.sparkSession.read.schema(f"`{slice_column}` {status.schema[slice_column].dataType.simpleString()}, `{error}` string").parquet(path)
    total = failures.count()
    if total:
        detail = "; ".join(f"{row[0]}: {row[1]}" for row in failures.orderBy(slice_column).take(shown))
        raise LoadRefused(f"{total} slice(s) of '{entity}' failed, refusing to write it; all are listed in {path}: {detail}")


def table_ages(tables: Mapping[str, tuple[DataFrame, str]], now: datetime) -> DataFrame:
    """Hours since the last write of each table, null if never written."""
    frames = [
        df.agg(F.max(stamp).alias("last_write")).select(
            F.lit(name).alias("table_name"), hours_since(F.col("last_write"), now).alias("age_hours")
        )
        for name, (df, stamp) in sorted(tables.items())
    ]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def stale(ages: DataFrame, limit: float = MAX_AGE_HOURS) -> DataFrame:
    """Tables never written or older than the limit; exactly the limit is fresh."""
    return ages.filter(F.col("age_hours").isNull() | (F.col("age_hours") > limit))


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("occurrences")).filter("occurrences > 1")


def null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a null in any key column."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return df.filter(missing)


def key_summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: number of rows, of rows with a null key and of occurrences of the most frequent key."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    counted = df.groupBy(*keys).agg(F.count("*").alias("occurrences"))
    occurrences = F.col("occurrences")
    return counted.agg(
        F.coalesce(F.sum(occurrences), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(missing, occurrences)), F.lit(0)).alias("null_keys"),
        F.coalesce(F.max(F.when(~missing, occurrences)), F.lit(0)).alias("most_frequent"),
    )


def refuse_repeated_keys(df: DataFrame, keys: Sequence[str], entity: str, nulls: bool = False) -> int:
    """Raise unless the keys are unique and, unless allowed, never null. Gives the number of rows."""
    summary = key_summary(df, keys).first()
    if summary.most_frequent > 1:
        sample = repeated_keys(df, keys).take(1)
        raise LoadRefused(f"'{entity}' repeats keys {list(keys)}, such as {[tuple(row)[:-1] for row in sample]}")
    if summary.null_keys and not nulls:
        raise LoadRefused(f"'{entity}' has {summary.null_keys} row(s) with null keys {list(keys)}")
    return summary.row_count


def orphans(child: DataFrame, foreign_key: str, parent: DataFrame, key: str) -> DataFrame:
    """Foreign keys without a parent row and how often they occur; null passes.

    Counted before the join, so a hot foreign key is one row by then.
    """
    used = child.filter(F.col(foreign_key).isNotNull()).groupBy(foreign_key).agg(F.count("*").alias("occurrences"))
    parents = parent.select(F.col(key).alias("__parent"))
    return used.join(parents, used[foreign_key] == parents["__parent"], "left_anti")


def allocation_faults(
    bridge: DataFrame, invoices: DataFrame, invoice: str, share: str, value: str, tolerance: float = 0.01
) -> DataFrame:
    """Invoices whose allocated parts do not add up to their value."""
    totals = bridge.groupBy(invoice).agg(F.sum(share).alias("allocated"))
    joined = totals.join(invoices.select(invoice, value), invoice)
    return joined.filter(F.abs(F.col("allocated") - F.col(value)) >= tolerance)
