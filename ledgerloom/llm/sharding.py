"""Sharding by jump consistent hashing, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.common import query, table
from ledgerloom.session import settle

# The multiplier 2862933555777941757 of the published algorithm in limbs of 22, 22 and 20 bits: products of limbs
# stay far inside a long, so the arithmetic modulo 2^64 neither overflows nor depends on ANSI mode.
MULTIPLIER = 2862933555777941757
BITS = 22
MASK = (1 << BITS) - 1
TOP = (1 << (64 - 2 * BITS)) - 1
EAGER_STEPS = 24


def _step(state: Column, shards: int) -> Column:
    """One jump: the state holds the generator's limbs, the shard so far and the next candidate."""
    c0, c1, c2 = MULTIPLIER & MASK, (MULTIPLIER >> BITS) & MASK, MULTIPLIER >> (2 * BITS)
    a0, a1, a2, at, to = (state[x] for x in ("a0", "a1", "a2", "at", "to"))
    t0 = a0 * F.lit(c0) + F.lit(1)
    t1 = F.shiftright(t0, BITS) + a0 * F.lit(c1) + a1 * F.lit(c0)
    t2 = F.shiftright(t1, BITS) + a0 * F.lit(c2) + a1 * F.lit(c1) + a2 * F.lit(c0)
    mid, top = t1.bitwiseAND(F.lit(MASK)), t2.bitwiseAND(F.lit(TOP))
    drawn = (top * F.lit(1 << (2 * BITS - 33)) + F.shiftright(mid, 33 - BITS) + F.lit(1)).cast("double")
    following = F.floor((to + F.lit(1)).cast("double") * (F.lit(float(1 << 31)) / drawn)).cast("long")
    moved = F.struct(t0.bitwiseAND(F.lit(MASK)).alias("a0"), mid.alias("a1"), top.alias("a2"), to.alias("at"), following.alias("to"))
    return F.when(to < F.lit(shards), moved).otherwise(state)


def jump_hash(key: Column, shards: int) -> Column:
    """Shard 0 to ``shards`` - 1 of a long key; null keys go where key 0 goes.

    Every jump moves on by one shard at least, so ``shards`` steps always end. About ln(shards) are needed; the
    few rows not done after the first steps go on, the others skip that branch.
    """
    k = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    state = F.struct(
        k.bitwiseAND(F.lit(MASK).cast("long")).alias("a0"), F.shiftrightunsigned(k, BITS).bitwiseAND(F.lit(MASK)).alias("a1"), F.shiftrightunsigned(k, 2 * BITS).alias("a2"),
        F.lit(-1).cast("long").alias("at"), F.lit(0).cast("long").alias("to"),
    )
    first = F.aggregate(F.sequence(F.lit(1), F.lit(min(shards, EAGER_STEPS))), state, lambda s, _: _step(s, shards))
    if shards <= EAGER_STEPS:
        return first["at"].cast("int")
    rest = F.sequence(F.lit(1), F.lit(shards - EAGER_STEPS))
    return F.transform(F.array(first), lambda s: F.when(s["to"] >= shards, s).otherwise(F.aggregate(rest, s, lambda t, _: _step(t, shards))))[0]["at"].cast("int")


def shard(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", blocks: int | None = None) -> DataFrame:
    """Shard, gapless slot within the shard, and the shard if one more is appended, for every row.

    Columns: doc_id, size (UTF-8 bytes plus 1), text_crc32 (null text as empty: 0), law ``key``, shard, slot,
    grown_shard. The law needs no table of shards, and with one more shard rows only move into that one. Slots
    follow (doc_id, text_crc32, size), null ids first; rows equal in these get neighbouring slots in any order.
    Numbering never sorts a shard in one task: rows are range-partitioned, counted per shard and block, and
    numbered within blocks from the sum of the blocks before. The row number in the range key splits an id that a
    third of all rows share. An empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    blocks = blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text).cast("long") + F.lit(1)).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row"),
    ).withColumns({"shard": jump_hash(F.col("doc_id"), shards), "grown_shard": jump_hash(F.col("doc_id"), shards + 1)})
    order = ["doc_id", "text_crc32", "size", "row"]
    rows = settle(rows.repartitionByRange(blocks, *order).withColumn("block", F.spark_partition_id()), "shards")
    counts = rows.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))  # shards x blocks rows
    before = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = rows.withColumn("at", F.row_number().over(Window.partitionBy("shard", "block").orderBy(*order)))
    numbered = numbered.join(counts.select("shard", "block", before.alias("before")), ["shard", "block"])
    slot = (F.col("before") + F.col("at") - F.lit(1)).cast("long").alias("slot")
    return numbered.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", slot, "grown_shard")


@query("op6_sharding")
def op6_sharding(spark, sf_dir):
    return shard(table(spark, sf_dir, "documents", "doc_id", "text"))
