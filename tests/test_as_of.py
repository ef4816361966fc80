"""The as-of merge against plain loops, against the join, and on keys with very many versions."""

import random
import time
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.as_of import as_of_key, as_of_once, longest_list, outlived, version_key
from ledgerloom.operators.skew import hot_keys
from ledgerloom.operators.temporal import point_in_time_key

FACTS, VERSIONS = "id int, code string, day date, valido_de int", "key string, sk bigint, valido_de date, valido_ate date, vigente boolean"
DAY0 = date(2019, 12, 1)


def day(n):
    return None if n is None else DAY0 + timedelta(days=n)


def disjoint(rng, keys):
    out = []
    for key in keys:
        at = rng.randrange(-200, 400)
        for _ in range(rng.randrange(0, 9)):
            length = rng.choice([0, 1, 3, 64, 200, 900])
            out.append((key, len(out) + 1, day(at), day(at + length), False))
            at += length + rng.choice([0, 0, 0, 5, 130])
        if rng.random() < 0.6:
            out.append((key, len(out) + 1, day(at), None, True))
    return out + [(None, 999, day(0), None, True), ("k1", 998, None, day(9), False)]


def facts_of(rng, keys, n):
    rows = [(i, rng.choice([*keys, None, "never"]), day(rng.choice([None, *range(-300, 2500)])), 7) for i in range(n)]
    return rows + rows[:20]  # repeated rows stay


def covering(versions, code, at):
    found = [v for v in versions if code is not None and at is not None and v[0] == code and v[2] and v[2] <= at and (v[3] is None or at < v[3])]
    return max(found, key=lambda v: (v[2], v[1]))[1] if found else None


@pytest.mark.parametrize("seed, limit", [(1, None), (2, 20), (3, 1)])
def test_the_version_of_the_day(spark, seed, limit):
    rng = random.Random(seed)
    keys = [f"k{i}" for i in range(8)]
    versions, facts = disjoint(rng, keys), facts_of(rng, keys, 600)
    df, dim = spark.createDataFrame(facts, FACTS), spark.createDataFrame(versions, VERSIONS)
    hot = None if limit is None else hot_keys(df, "code", limit)
    got = as_of_key(df, dim, "code", "day", "key", "sk", hot)
    assert got.columns == ["id", "code", "day", "valido_de", "sk"] and dict(got.dtypes)["sk"] == "bigint"
    assert sorted(map(tuple, got.collect()), key=str) == sorted(((*f, covering(versions, f[1], f[2])) for f in facts), key=str)


@pytest.mark.parametrize("seed", [4, 5])
def test_overlapping_versions_and_the_latest_start(spark, seed):
    rng = random.Random(seed)
    keys = [f"k{i}" for i in range(6)]
    versions = []
    for key in keys:
        for _ in range(rng.randrange(1, 8)):
            start = rng.randrange(-100, 1500)
            versions.append((key, len(versions), day(start), rng.choice([None, day(start + rng.randrange(0, 500))]), True))
    versions += [("k0", 700, day(30), None, True), ("k0", 701, day(30), day(60), False)]
    versions += [("calm", 500, day(0), day(90), True), ("calm", 501, day(50), None, True)]
    facts = [f for f in facts_of(rng, [*keys, "calm"], 400)][:400]
    df, dim = spark.createDataFrame(facts, FACTS).drop("valido_de"), spark.createDataFrame(versions, VERSIONS)
    nested = {r.key for r in outlived(dim, "key").collect()}
    assert nested and "calm" not in nested
    got = as_of_once(df, dim, ["id"], "code", "day", "key", "sk")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(((*f[:3], covering(versions, f[1], f[2])) for f in facts), key=str)
    calm = dim.filter("key = 'calm'")
    once = as_of_once(df, calm, ["id"], "code", "day", "key", "sk").filter("sk is not null")
    assert {(r.day >= day(50), r.sk) for r in once.collect()} <= {(True, 501), (False, 500)}


def test_empty_sides(spark):
    facts, dim = spark.createDataFrame([(1, "a", day(3), 0)], FACTS), spark.createDataFrame([("a", 1, day(0), None, True)], VERSIONS)
    assert as_of_key(facts.limit(0), dim, "code", "day", "key", "sk").count() == 0
    assert [tuple(r) for r in as_of_key(facts, dim.limit(0), "code", "day", "key", "sk").collect()] == [(1, "a", day(3), 0, None)]


def test_ten_thousand_versions_of_one_key_that_holds_most_facts(spark):
    versions = spark.range(10_000).select(
        F.lit("hot").alias("key"), F.col("id").alias("sk"), F.date_add(F.lit(DAY0), F.col("id").cast("int")).alias("valido_de"),
        F.date_add(F.lit(DAY0), F.col("id").cast("int") + 1).alias("valido_ate"),
    )
    facts = spark.range(200_000).select("id", F.when(F.col("id") % 10 > 0, "hot").otherwise("cold").alias("code"), F.date_add(F.lit(DAY0), (F.col("id") % 9_973).cast("int")).alias("day"))
    start = time.time()
    got = as_of_key(facts, versions, "code", "day", "key", "sk", hot_keys(facts, "code", 20_000))
    wrong = got.filter((F.col("code") == "hot") & ~F.col("sk").eqNullSafe(F.col("id") % 9_973) | (F.col("code") == "cold") & F.col("sk").isNotNull())
    assert wrong.count() == 0 and got.count() == 200_000
    assert time.time() - start < 60  # the join has two thousand million pairs to look at
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_agrees_with_the_join(spark):
    rng = random.Random(9)
    keys = [f"k{i}" for i in range(5)]
    versions = [v for v in disjoint(rng, keys) if v[3] != v[2]]
    df, dim = spark.createDataFrame(facts_of(rng, keys, 300), FACTS), spark.createDataFrame(versions, VERSIONS)
    args = (df.drop("valido_de"), dim, "code", "day", "key", "sk")
    assert sorted(map(str, as_of_key(*args).collect())) == sorted(map(str, point_in_time_key(*args).collect()))
    assert sorted(map(str, version_key(*args).collect())) == sorted(map(str, as_of_key(*args).collect()))
    assert longest_list(dim, "key") == max(sum(v[0] == k for v in versions) for k in keys) and longest_list(dim.limit(0), "key") == 0
