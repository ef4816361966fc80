"""As-of merge: facts and dimension versions in one order, the last version carried forward.

A join over time lets every fact meet all versions of its key. Here facts and versions are one series by key and day,
so the cost is facts plus versions however many versions a key has. A key's series is cut into buckets of days, which
are worked on apart; what a bucket needs from before is one version, carried in from a small table of bucket ends.

Prefer ``temporal.point_in_time_key`` where keys have few versions and the dimension is small enough to be
broadcast, as facts are not shuffled then.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.operators.dedupe import keep_last
from ledgerloom.operators.skew import NONE_HOT, _every_salt, _salt, _with_parts
from ledgerloom.operators.temporal import VALID_FROM, VALID_TO, covers, point_in_time_key, point_in_time_key_once
from ledgerloom.session import settle

#: Days of a bucket. A key's rows are ordered, and its versions repeated once at most, for each.
BUCKET_DAYS = 64
#: Versions of a key up to which a fact may meet them all: fewer rows than a second shuffle would move.
SHORT_LIST = 64
#: Into how many buckets facts without key or day are dealt, as they need no version.
LOOSE = 4096


def _bucket(day: Column) -> Column:
    return F.floor(F.unix_date(day.cast("date")) / BUCKET_DAYS).cast("bigint")


def as_of(
    facts: DataFrame,
    versions: DataFrame,
    fact_key: str,
    fact_day: str,
    key: str,
    columns: Sequence[str],
    hot: DataFrame | None = NONE_HOT,
) -> DataFrame:
    """Every fact with the columns of the version that started last on or before its day, if that still covers it.

    One row for each fact, in any order; null columns without such a version, key or day. Versions with no day of
    their own (an end on or before the start) are passed over; of versions that start on one day the one with the largest
    values in ``columns`` counts. For versions that overlap see ``as_of_once``. Facts of keys in ``hot`` are dealt
    over several tasks, each of which gets the key's versions.
    """
    state = F.struct(F.col(VALID_FROM).alias("from"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)], F.col(VALID_TO).alias("to"))
    lasting = F.col(key).isNotNull() & F.col(VALID_FROM).isNotNull() & (F.col(VALID_TO).isNull() | (F.col(VALID_TO) > F.col(VALID_FROM)))
    states = versions.filter(lasting).select(F.col(key).alias("__k"), _bucket(F.col(VALID_FROM)).alias("__b"), state.alias("__state"))

    loose = F.col(fact_key).isNull() | F.col(fact_day).isNull()
    place = F.when(loose, -(1 << 40) - F.pmod(F.monotonically_increasing_id(), F.lit(LOOSE))).otherwise(_bucket(F.col(fact_day)))
    fact = F.struct(*[F.col(f"`{name}`").alias(f"f{i}") for i, name in enumerate(facts.columns)])
    rows = facts.select(F.col(fact_key).alias("__k"), place.alias("__b"), F.col(fact_day).alias("__day"), fact.alias("__fact"))

    # The last version of each bucket, and the buckets that hold facts: as many rows of a key as there are buckets.
    wanted = facts.filter(~loose).select(F.col(fact_key).alias("__k"), _bucket(F.col(fact_day)).alias("__b")).distinct()
    ends = states.groupBy("__k", "__b").agg(F.max("__state").alias("__end"))
    steps = wanted.withColumn("__wanted", F.lit(True)).join(ends, ["__k", "__b"], "full")
    before = Window.partitionBy("__k").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    carried = steps.withColumn("__state", F.last("__end", ignorenulls=True).over(before))
    carried = carried.filter("__wanted and __state is not null").select("__k", "__b", "__state")

    known = states.unionByName(carried)
    if hot is not None:
        known = _with_parts(known, "__k", hot).select("*", _every_salt().alias("__salt")).drop("__parts")
        rows = _with_parts(rows, "__k", hot).withColumn("__salt", _salt()).drop("__parts")
    else:
        known, rows = known.withColumn("__salt", F.lit(0)), rows.withColumn("__salt", F.lit(0))
    # A version comes before the facts of its first day; a carried one starts before all that its bucket holds.
    known = known.withColumn("__day", F.col("__state.from"))
    series = known.unionByName(rows, allowMissingColumns=True)
    order = Window.partitionBy("__k", "__b", "__salt").orderBy("__day", F.col("__fact").isNotNull(), "__state")
    merged = series.withColumn("__state", F.last("__state", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    valid = covers(F.col("__day"), F.col("__state.from"), F.col("__state.to"))
    shown = [F.col(f"__fact.f{i}").alias(name) for i, name in enumerate(facts.columns)]
    shown += [F.when(valid, F.col(f"__state.c{i}")).alias(name) for i, name in enumerate(columns)]
    return merged.filter("__fact is not null").select(*shown)


def as_of_key(
    facts: DataFrame, versions: DataFrame, fact_key: str, fact_day: str, key: str, surrogate: str, hot: DataFrame | None = NONE_HOT
) -> DataFrame:
    """As ``temporal.point_in_time_key``, by the merge, for versions that do not overlap."""
    return as_of(facts, versions, fact_key, fact_day, key, [surrogate], hot)


def longest_list(versions: DataFrame, key: str) -> int:
    """Versions of the key that has most."""
    return versions.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).agg(F.max("__n")).first()[0] or 0


def version_key(
    facts: DataFrame, versions: DataFrame, fact_key: str, fact_day: str, key: str, surrogate: str, hot: DataFrame | None = NONE_HOT
) -> DataFrame:
    """The join while every key has few versions, the merge from ``SHORT_LIST`` on. For versions that do not overlap both give the same rows."""
    way = point_in_time_key if longest_list(versions, key) <= SHORT_LIST else as_of_key
    return way(facts, versions, fact_key, fact_day, key, surrogate, hot)


def outlived(versions: DataFrame, key: str) -> DataFrame:
    """Keys with a version that ends before one that started earlier does: there the last start may be over already."""
    start = Window.partitionBy(key).orderBy(VALID_FROM)
    forever = F.lit("9999-12-31").cast("date")
    end = F.coalesce(F.col(VALID_TO), forever)
    longest = F.max(end).over(start.rangeBetween(Window.unboundedPreceding, 0))
    return versions.filter(F.col(key).isNotNull()).select(key, (longest > end).alias("__over")).filter("__over").select(key).distinct()


def as_of_once(
    facts: DataFrame,
    versions: DataFrame,
    fact_id: Sequence[str],
    fact_key: str,
    fact_day: str,
    key: str,
    surrogate: str,
    hot: DataFrame | None = NONE_HOT,
) -> DataFrame:
    """As ``temporal.point_in_time_key_once``: of the versions that cover a fact the latest start wins, then the largest key.

    The merge gives that unless a version ends before an earlier one does. Keys with such versions, which are few, take
    the join; facts of one ``fact_id`` are one row either way.
    """
    nested = settle(outlived(versions, key), "outlived").select(F.col(key).alias("__nested"))
    if nested.isEmpty():
        return keep_last(as_of(facts, versions, fact_key, fact_day, key, [surrogate, VALID_FROM], hot), fact_id, [VALID_FROM, surrogate]).drop(VALID_FROM)
    apart = facts.join(nested, facts[fact_key] == nested["__nested"], "left_semi")
    rest = facts.join(nested, facts[fact_key] == nested["__nested"], "left_anti")
    merged = as_of(rest, versions, fact_key, fact_day, key, [surrogate, VALID_FROM], hot)
    joined = point_in_time_key_once(apart, versions, fact_id, fact_key, fact_day, key, surrogate, hot)
    return keep_last(merged, fact_id, [VALID_FROM, surrogate]).drop(VALID_FROM).unionByName(joined)
