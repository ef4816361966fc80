import binascii

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm.sharding import jump_hash, op6_sharding, shard

SCHEMA = "doc_id long, text string, shard string, row int"


def jump(key: int, shards: int) -> int:
    key, at, to = key % 2**64, -1, 0
    while to < shards:
        at = to
        key = (key * 2862933555777941757 + 1) % 2**64
        to = int((at + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return at


@pytest.mark.parametrize("shards", [1, 2, 8, 9, 200])
def test_jump_hash_is_the_published_one(spark, shards):
    keys = [0, 1, -1, 7, 2**63 - 1, -(2**63), 123456789012345, *range(500, 700)]
    rows = spark.createDataFrame([(k,) for k in keys], "k long").select("k", jump_hash(F.col("k"), shards).alias("s")).collect()
    assert {r.k: r.s for r in rows} == {k: jump(k, shards) for k in keys}


def check(rows):
    slots = {}
    for r in rows:
        assert r.law == "key"
        assert r.shard == jump(r.doc_id or 0, 8)
        assert r.grown_shard == jump(r.doc_id or 0, 9)
        assert r.grown_shard in (r.shard, 8)
        slots.setdefault(r.shard, []).append(r.slot)
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))


def test_nulls_empties_repeats_and_clashing_columns(spark):
    texts = [(None, "a"), (None, None), (3, ""), (3, "é" * 5), (5, "x" * 300_000)] + [(9, "same")] * 40
    rows = shard(spark.createDataFrame([(i, t, "clash", 1) for i, t in texts], SCHEMA), blocks=4).collect()
    assert len(rows) == 45
    check(rows)
    got = {(r.doc_id, r["size"], r.text_crc32) for r in rows}
    assert got == {(i, len((t or "").encode()) + 1, binascii.crc32((t or "").encode())) for i, t in texts}


def test_empty_table(spark):
    assert shard(spark.createDataFrame([], SCHEMA)).count() == 0


def test_whole_table(spark):
    rows = op6_sharding(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    check(rows)
