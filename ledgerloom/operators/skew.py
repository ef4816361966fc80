"""Joins in which a few keys may own a large part of all rows.

A runtime skew join splits a hot key only on the side that an outer join lets it
split, and only where nothing later relies on the partitioning. Where that does
not hold, hot keys are looked up first and their rows are spread explicitly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.session import settle

TASK_ROWS = 5_000_000

#: No key is hot.
NONE_HOT = None


def hot_keys(df: DataFrame, key: str, task_rows: int = TASK_ROWS) -> DataFrame | None:
    """Columns ``hot_key``, ``parts``: the keys with more rows than one task should hold, null among them.

    The limit is a number of rows, whatever the size of the frame, so the list is about as long as the frame has
    tasks. Counting aggregates partially first. The list is settled, so the planner knows its size; it is none if
    there are no such keys, so that joins need not be prepared for them.
    """
    counts = df.groupBy(F.col(key).alias("hot_key")).agg(F.count(F.lit(1)).alias("__rows")).filter(F.col("__rows") > task_rows)
    found = settle(counts.select("hot_key", F.ceil(F.col("__rows") / task_rows).cast("int").alias("parts")), "hot-keys")
    return NONE_HOT if found.isEmpty() else found


def _with_parts(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """The frame with ``__parts``: into how many its key is split, one for a key that is not hot.

    A left join, of which the runtime may split the left side.
    """
    joined = df.join(hot, df[key].eqNullSafe(hot["hot_key"]), "left")
    return joined.select(*(df[f"`{c}`"] for c in df.columns), F.coalesce("parts", F.lit(1)).alias("__parts"))


def _salt() -> Column:
    """Salts by position, so that rows that are equal in all columns are spread too.

    Positions repeat as long as the frame is read from files; settle it before if it comes out of a shuffle.
    """
    return F.pmod(F.monotonically_increasing_id(), F.col("__parts")).cast("int")


def _every_salt() -> Column:
    return F.explode(F.sequence(F.lit(0), F.col("__parts") - 1))


def spread_left(left: DataFrame, right: DataFrame, left_key: str, right_key: str, hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with a ``__salt`` to join on as well, for hot keys on the left.

    Rows of a hot key get one of its salts. The few right rows of a hot key are
    repeated once per salt, so every left row still meets each of them once.
    """
    salted = _with_parts(left, left_key, hot).withColumn("__salt", _salt()).drop("__parts")
    known = _with_parts(right.filter(F.col(right_key).isNotNull()), right_key, hot)
    return salted, known.select("*", _every_salt().alias("__right_salt")).drop("__parts")


def left_join_hot_right(left: DataFrame, right: DataFrame, key: str, hot: DataFrame | None) -> DataFrame:
    """Left join for hot keys on the right.

    The left rows of a hot key are repeated once per salt. A repeated left row that met nothing is a surplus copy,
    unless it is the first and its key has no right rows at all.
    """
    if hot is None:
        return left.join(right, key, "left")
    salted = _with_parts(right.filter(F.col(key).isNotNull()), key, hot).withColumn("__salt", _salt()).drop("__parts")
    salted = salted.withColumn("__met", F.lit(True))
    there = right.select(key).join(hot.filter("hot_key is not null"), right[key] == hot["hot_key"], "left_semi").distinct()
    sure = hot.join(there, hot["hot_key"] == there[key], "left_semi")
    repeated = _with_parts(left, key, sure).select("*", _every_salt().alias("__salt"))
    joined = repeated.join(salted, [key, "__salt"], "left").filter("__parts = 1 or __met")
    return joined.drop("__salt", "__parts", "__met")
