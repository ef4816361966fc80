"""What the operators share: the query registry, row-wise Arrow maps, tiles for hot groups, components."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import settle

BATCH_BYTES, SPARKS_OWN = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"
#: Rows of an Arrow batch that stand as Python objects at once, and about how many bytes of output wait for a batch.
ROWS_AT_ONCE, OUTPUT_BYTES = 128, 4_000_000

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under a name, with the SQL that must give the same rows, if SQL can."""

    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def with_row_id(df: DataFrame, name: str) -> DataFrame:
    """A number for each row; ids in the data may repeat or be null.

    It depends on how the scan is split, so it holds for one reading: settle the rows, or take the number along in the
    plan, where a second reading must find the same numbers.
    """
    return df.withColumn(name, F.monotonically_increasing_id())


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A setting of the session while an action runs or a stream starts; what the session had comes back."""
    own = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if own is None else spark.conf.set(key, own)


def in_arrow(df: DataFrame, function: Callable, schema) -> DataFrame:
    """``mapInArrow`` with batches that suit texts of any length.

    Spark's own limit of 64 MB for a batch, held on both sides of two Python workers and on the way back, is more
    than a small executor has to spare. A limit that the session has set is left as it is.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_BYTES, None) == SPARKS_OWN:
        conf.set(BATCH_BYTES, "4194304b")
    return df.mapInArrow(function, schema)


class PerTask:
    """Wraps a function without arguments that each task calls once, to make the function for its rows."""

    def __init__(self, make: Callable[[], Callable]):
        self.make = make


def map_rows(df: DataFrame, function: Callable[..., Iterable[tuple]] | PerTask, schema: str) -> DataFrame:
    """``function`` takes the columns of a row and gives its output rows. Holds an Arrow batch and little more."""

    def run(batches):
        names = [field.split()[0] for field in schema.split(", ")]
        make = function.make() if isinstance(function, PerTask) else function
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                for row in zip(*(column.to_pylist() for column in batch.slice(start, ROWS_AT_ONCE).columns)):
                    for out in make(*row):
                        rows.append(out)
                        size += 64 + sum(len(x) for x in out if isinstance(x, (str, bytes, list)))
                    if size > OUTPUT_BYTES:
                        yield to_batch(rows, names, types)
                        rows, size = [], 0
            if rows:
                yield to_batch(rows, names, types)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    types = to_arrow_schema(StructType.fromDDL(schema)).types
    return in_arrow(df, run, schema)


def to_batch(rows: Sequence[tuple], names: Sequence[str], types: Sequence[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], names=list(names))


def tiled(keys: DataFrame, key: str, row: Column, tile_rows: int) -> DataFrame:
    """The rows of each key in tiles that one task can hold, such that any two rows of a key meet in a tile.

    Adds ``gid`` (the group to compare), ``part`` (which side of the tile) and ``cross`` (whether only rows of
    different sides are to be compared). A key with up to ``tile_rows`` rows is one tile. A larger one is dealt
    into c parts by the hash of ``row`` and each part goes to the c tiles it takes part in.
    """
    hot = keys.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > tile_rows)
    hot = hot.select(key, F.ceil(F.col("_n") * 1.25 / tile_rows).cast("int").alias("_c"))
    parts = keys.join(hot, key, "left").withColumn("_c", F.coalesce("_c", F.lit(1)))
    parts = parts.withColumn("part", F.pmod(F.xxhash64(row, F.lit("tile")), F.col("_c")).cast("int"))
    other = F.when(F.col("_c") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("_c") - 1))
    dealt = parts.withColumn("_o", F.explode(other))
    low, high = F.least("part", "_o"), F.greatest("part", "_o")
    return dealt.withColumn("gid", F.xxhash64(key, low, high)).withColumn("cross", low != high).drop("_c", "_o")


def by_group(batches, order: str = "gid") -> Iterator[pa.RecordBatch]:
    """Batches of rows sorted by ``order``, regrouped so that no group is cut; holds one group and one batch at most."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        gids = batch.column(batch.schema.get_field_index(order)).to_numpy(zero_copy_only=False)
        last = int(np.searchsorted(gids, gids[-1], side="left"))
        if last == 0 and rest and rest[-1].column(rest[-1].schema.get_field_index(order))[-1].as_py() == gids[0]:
            rest.append(batch)
            continue
        done = pa.Table.from_batches([*rest, batch.slice(0, last)] if last else rest).combine_chunks() if rest or last else None
        if done is not None and done.num_rows:
            yield done.to_batches()[0]
        rest = [batch.slice(last)]
    if rest:
        yield pa.Table.from_batches(rest).combine_chunks().to_batches()[0]


def group_roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For nodes 0 to n-1 and links both ways round, sorted by ``left``: the smallest node reachable from each."""
    roots = np.arange(n)
    if not len(left):
        return roots
    starts = np.flatnonzero(np.r_[True, left[1:] != left[:-1]])
    nodes = left[starts]
    while True:
        least = np.minimum(roots[nodes], np.minimum.reduceat(roots[right], starts))
        new = roots.copy()
        new[nodes] = least
        new = new[new]
        if np.array_equal(new, roots):
            return roots
        roots = new


def components(edges: DataFrame) -> DataFrame:
    """Columns ``node``, ``root`` (smallest node reachable) of every node with an edge, from edges ``a``, ``b`` (long).

    Alternating large-star and small-star steps: each node hands its larger, then its smaller neighbours to its
    smallest. A step is an aggregation and a join on the node, so a star with a third of all nodes is dealt
    out by partial aggregation and by the planner's skew join. Each round is written to the shared folder.
    Rounds grow with the logarithm of the longest path. Null and self edges say nothing and are left out.
    """
    e = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    e = settle(e.distinct(), "edges")
    before = None
    while True:
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        e = settle(small.where("a != b").distinct(), "edges")
    ends = e.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return ends.unionByName(ends.select(F.col("root").alias("node"), "root").distinct())
