"""One array per file, cut anywhere, against a reading of the whole file."""

import json
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.running import number_dense
from ledgerloom.sources import landed
from ledgerloom.sources.arrays import read_array

SCHEMA = "id bigint, text string, nested struct<a: array<struct<b: string>>, c: string>, tags array<string>"


def records(rng, n):
    odd = ['"', "\\", "}", "{", "[", "]", ",", "\\\\", '\\"', "é", "\n", "}}", '"}, {"', "", " "]
    word = lambda: "".join(rng.choice([*odd, "plain", "text"]) for _ in range(rng.randrange(6)))
    out = []
    for i in range(n):
        nested = {"a": [{"b": word()} for _ in range(rng.randrange(3))], "c": word()} if rng.random() < 0.7 else None
        out.append({"id": i, "text": word(), "nested": nested, "tags": [word() for _ in range(rng.randrange(4))]})
    return out


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("seed, indent", [(1, None), (2, 2)])
def test_the_same_records_as_in_one_piece(spark, tmp_path, small_splits, seed, indent):
    rng = random.Random(seed)
    for name, n in (("a.json", 300), ("b.json", 1), ("c.json", 0), ("d.json", 40)):
        body = json.dumps(records(rng, n), ensure_ascii=False, indent=indent)
        (tmp_path / name).write_text(body + rng.choice(["", "\n"]), encoding="utf-8")
    (tmp_path / "e.json").write_text("")
    assert spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() > 10
    got = read_array(spark, str(tmp_path), SCHEMA, ordered=True)
    whole = landed.read_records(spark, str(tmp_path), SCHEMA, one_array=True)
    assert sorted(map(str, got.select("id", "text", "nested", "tags").collect())) == sorted(map(str, whole.collect()))
    first = [r.id for r in got.filter(F.col("__file").endswith("a.json")).orderBy(*landed.INGEST_ORDER).collect()]
    assert first == list(range(300))


@pytest.mark.parametrize("body", ['{"id": 1}', '[{"id": 1}', '[{"id": 1} {"id": 2}]', '[{"id": 1}, 2]', '[1]', '[{"id": 1}] x', 'x [{"id": 1}]', '[{"id": 1}][{"id": 2}]', '[{"id": }]'])
def test_anything_but_an_array_of_objects_raises(spark, tmp_path, body):
    (tmp_path / "a.json").write_text(body)
    with pytest.raises(Exception, match="MALFORMED"):
        read_array(spark, str(tmp_path), "id bigint").collect()


def test_dense_numbers(spark):
    df = spark.range(3000).select((F.col("id") * 7 % 3000).alias("k"), F.lit(None).cast("string").alias("n")).repartition(5)
    numbered = number_dense(df, ["k"], "sk", F.lit(10).cast("bigint"))
    assert {r.k: r.sk for r in numbered.collect()} == {k: 11 + k for k in range(3000)}
    nulls = number_dense(df, ["n"], "sk", F.lit(0).cast("bigint"))
    assert sorted(r.sk for r in nulls.collect()) == list(range(1, 3001))
    assert nulls.groupBy("sk").count().filter("count > 1").count() == 0
    assert number_dense(df.limit(0), ["k"], "sk", F.lit(0).cast("bigint")).count() == 0
