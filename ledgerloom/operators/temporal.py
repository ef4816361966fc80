"""Dimension versions over time: point-in-time keys and interval checks.

Intervals are half open: valid from ``valido_de`` up to, not including,
``valido_ate``; a null end is open.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.operators.dedupe import keep_last
from ledgerloom.operators.skew import NONE_HOT, spread_left

VALID_FROM, VALID_TO = "valido_de", "valido_ate"


def dimension_versions(dim: DataFrame, key: str, surrogate: str) -> DataFrame:
    """Only the columns a point-in-time lookup needs."""
    return dim.select(key, surrogate, VALID_FROM, VALID_TO)


def covers(day: Column, start: Column, end: Column) -> Column:
    """The half-open interval contains the day."""
    return (day >= start) & (end.isNull() | (day < end))


def attach_version(
    facts: DataFrame,
    versions: DataFrame,
    fact_key: str,
    fact_day: str,
    key: str,
    columns: Sequence[str],
    hot: DataFrame | None = NONE_HOT,
) -> DataFrame:
    """Columns of the version that was valid on the fact's own day, null where there is none.

    One equi join on the key with the interval as residual condition: Spark picks
    a hash join when the versions are known to be small and a sort-merge join
    otherwise. A key has at most one version per day, so its side of the join
    stays short. Fact keys found to be hot are spread over several tasks.
    """
    slim = versions.select(
        F.col(key).alias("__key"),
        F.col(VALID_FROM).alias("__from"),
        F.col(VALID_TO).alias("__to"),
        *columns,
    )
    extra = F.lit(True)
    if hot is not None:
        facts, slim = spread_left(facts, slim, fact_key, "__key", hot)
        extra = facts["__salt"] == slim["__right_salt"]
    condition = (facts[fact_key] == slim["__key"]) & covers(facts[fact_day], slim["__from"], slim["__to"])
    return facts.join(slim, condition & extra, "left").drop("__key", "__from", "__to", "__salt", "__right_salt")


def point_in_time_key(
    facts: DataFrame,
    versions: DataFrame | None,
    fact_key: str,
    fact_day: str,
    key: str,
    surrogate: str,
    hot: DataFrame | None = NONE_HOT,
) -> DataFrame:
    """Surrogate key of the version valid on the fact's day; all null without a dimension."""
    if versions is None:
        return facts.withColumn(surrogate, F.lit(None).cast("bigint"))
    return attach_version(facts, versions, fact_key, fact_day, key, [surrogate], hot)


def point_in_time_key_once(
    facts: DataFrame,
    versions: DataFrame,
    fact_id: Sequence[str],
    fact_key: str,
    fact_day: str,
    key: str,
    surrogate: str,
    hot: DataFrame | None = NONE_HOT,
) -> DataFrame:
    """As ``point_in_time_key`` for a dimension whose versions may overlap: the latest start wins."""
    starts = versions.withColumn("__start", F.col(VALID_FROM))
    matched = attach_version(facts, starts, fact_key, fact_day, key, [surrogate, "__start"], hot)
    return keep_last(matched, fact_id, ["__start", surrogate]).drop("__start")


def versions_from_changes(changes: DataFrame, key: str, day: str) -> DataFrame:
    """Intervals from dated states, one state per key and day: each lasts until the next one.

    The window holds one row per key and calendar day at most.
    """
    following = F.lead(day).over(Window.partitionBy(key).orderBy(day))
    return changes.withColumn(VALID_TO, following).withColumnRenamed(day, VALID_FROM)


def interval_faults(dim: DataFrame, key: str, flag: str = "vigente") -> DataFrame:
    """Keys whose versions overlap, leave a gap, run backwards or have no or several current ones.

    Starts count +1 and ends -1. They are summed per key and day first, so the
    running depth only sees one row per key and calendar day however many
    versions a key has. Depth above one is an overlap; depth zero before the last
    day is a gap. Zero-length versions cancel out and are legal. Versions are read
    once: what is counted of each travels with its start.
    """
    inverted = F.when(F.col(VALID_TO) < F.col(VALID_FROM), 1).otherwise(0)
    start = F.struct(
        F.col(VALID_FROM).alias("day"), F.lit(1).alias("step"), inverted.alias("inverted"),
        F.when(F.col(flag), 1).otherwise(0).alias("current"),
    )
    end = F.struct(F.col(VALID_TO).alias("day"), F.lit(-1).alias("step"), F.lit(0).alias("inverted"), F.lit(0).alias("current"))
    edges = dim.select(F.col(key), F.explode(F.array(start, end)).alias("edge")).select(key, "edge.*")
    # A start without a day is only counted, and no day of a null key tells of a key's intervals.
    step = F.when(F.col("day").isNotNull() & F.col(key).isNotNull(), F.col("step")).otherwise(0)
    days = edges.filter("day is not null or step = 1").groupBy(key, "day").agg(
        F.sum(step).alias("step"), F.sum("inverted").alias("inverted"), F.sum("current").alias("current")
    )
    running = Window.partitionBy(key).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    moved, depth = F.col("step") != 0, F.col("depth")
    # The last day that moves the depth leaves it at the sum of all steps; it is no gap.
    closed = F.when((F.count(F.when(moved, 1)) > 0) & (F.sum("step") <= 0), 1).otherwise(0)
    sweep = days.withColumn("depth", F.sum("step").over(running)).groupBy(key).agg(
        F.sum("inverted").alias("inverted"),
        F.sum("current").alias("current_versions"),
        F.sum(F.when(moved & (depth > 1), 1).otherwise(0)).alias("overlaps"),
        (F.sum(F.when(moved & (depth <= 0), 1).otherwise(0)) - closed).alias("gaps"),
    )
    return sweep.filter("overlaps > 0 or gaps > 0 or inverted > 0 or current_versions <> 1")
