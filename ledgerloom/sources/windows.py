"""Incremental reads: overlapping day windows over three date columns, in one scan."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from ledgerloom.operators.dedupe import keep_last

# Window name, days before today, days after today, in rising rank.
WINDOWS = [("NEW", -7, -1), ("PAID", -30, 0), ("DUE", -30, 30)]


def incremental_windows(df: DataFrame, today: date, emission: str, payment: str, due: str) -> DataFrame:
    """A row for each window an invoice falls into, with the window's name and rank.

    NEW goes by emission, PAID by payment and DUE by due day; both ends count.
    The three windows are tested in one scan and the day filter reaches it.
    """
    hits, any_hit = [], F.lit(False)
    for rank, ((name, first, last), column) in enumerate(zip(WINDOWS, (emission, payment, due))):
        inside = F.col(column).between(F.date_add(F.lit(today), first), F.date_add(F.lit(today), last))
        hits.append(F.when(inside, F.struct(F.lit(name).alias("window"), F.lit(rank).alias("window_rank"))))
        any_hit = any_hit | inside
    found = F.filter(F.array(*hits), lambda hit: hit.isNotNull())
    exploded = df.filter(any_hit).select(*df.columns, F.explode(found).alias("__hit"))
    return exploded.select(*df.columns, "__hit.window", "__hit.window_rank")


def merge_windows(windows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One record per key: the highest window wins, inside it the latest record."""
    return keep_last(windows, [key], ["window_rank", *order])
