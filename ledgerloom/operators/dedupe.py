"""One row per key.

``row_number() = 1`` is what Spark turns into a group limit: each map task keeps
only its best row of a key before the shuffle, so a key that owns a third of the
table arrives as one row per map task and not as one giant group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def _best_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(window)).filter("__rank = 1").drop("__rank")


#: Wide rows that a task may sort, some 200 MB of them.
TASK_ROWS = 100_000


def dealt(df: DataFrame, keys: Sequence[str], task_rows: int = TASK_ROWS) -> DataFrame:
    """The frame dealt by key over as many tasks as its rows need, for a dedupe of wide rows.

    The group limit sorts whole rows before they are sent, in as many tasks as the input has files, which for a small
    file of rows that grow wide afterwards is one. Dealt first, rows are sorted once, behind the shuffle. If a key has
    more rows than a task should hold, the frame stays as it is and the group limit thins them out. One narrow pass counts.
    """
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n"), F.max("n"))
    rows, largest = (value or 0 for value in sizes.first())
    if largest > task_rows:
        return df
    many = in_tasks(df, keys, rows, task_rows)
    return df.repartition(*keys) if many is df else many


def in_tasks(df: DataFrame, keys: Sequence[str], rows: int, task_rows: int = TASK_ROWS) -> DataFrame:
    """The frame dealt by keys that do not repeat, if so many rows need more tasks than the session's; else as it is.

    What is joined to it by these keys follows, so that tasks sort as many wide rows however large the frame is.
    """
    tasks = -(-rows // task_rows)
    return df.repartition(tasks, *keys) if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Earliest row per key in ingest order; null keys form one group."""
    return _best_row(df, keys, [F.col(name).asc() for name in order])


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Latest row per key in ingest order; null keys form one group."""
    return _best_row(df, keys, [F.col(name).desc() for name in order])


def with_group_count(df: DataFrame, keys: Sequence[str], counted: str, out: str) -> DataFrame:
    """Number of non-null values of a column in each group, on every row of the group.

    Counted with partial aggregation and joined back, since a window would send
    each whole group to one task. The counts hold one row per key, so a hot key
    makes only the left side large, which is the side a skew join splits.
    """
    matched = {f"__key_{i}": F.col(key) for i, key in enumerate(keys)}
    counts = df.groupBy(*keys).agg(F.count(counted).alias(out))
    counts = counts.select(out, *(value.alias(name) for name, value in matched.items()))
    same = [df[key].eqNullSafe(counts[name]) for key, name in zip(keys, matched)]
    return df.join(counts, same, "left").drop(*matched)
