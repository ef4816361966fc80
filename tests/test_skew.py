"""Hot keys: found exactly, spread over tasks, and no row lost or repeated."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import allocation, temporal, views
from ledgerloom.operators.skew import NONE_HOT, hot_keys, left_join_hot_right, spread_left


@pytest.fixture(scope="module")
def facts(spark):
    """A third of all rows has key 7 and another tenth has none."""
    place = F.col("id") % 30
    key = F.when(place < 10, F.lit(7)).when(place >= 13, F.col("id") % 1000).cast("bigint")
    return spark.range(30000).select("id", key.alias("k"), F.lit(date(2026, 1, 1)).alias("d"))


def parts(hot):
    return {r.hot_key: r.parts for r in hot.collect()}


def hot_frame(spark, **_parts):
    return spark.createDataFrame(_parts["rows"], "hot_key bigint, parts int")


def test_hot_keys(spark, facts):
    assert parts(hot_keys(facts, "k", task_rows=1000)) == {7: 11, None: 3}
    assert hot_keys(facts, "k", task_rows=30000) is NONE_HOT
    many = spark.range(200 * 50).select((F.col("id") % 200).alias("k"))
    assert parts(hot_keys(many, "k", task_rows=10)) == {k: 5 for k in range(200)}


def dimension(spark):
    return spark.range(1000).select(
        F.col("id").alias("key"), (F.col("id") + 5).alias("sk"),
        F.lit(date(1900, 1, 1)).alias("valido_de"), F.lit(None).cast("date").alias("valido_ate"),
    )


def test_point_in_time_key_with_hot_keys(spark, facts):
    hot = hot_keys(facts, "k", task_rows=1000)
    args = ("k", "d", "key", "sk")
    plain = temporal.point_in_time_key(facts, dimension(spark), *args)
    spread = temporal.point_in_time_key(facts, dimension(spark), *args, hot=hot)
    assert spread.columns == plain.columns
    assert sorted(map(tuple, spread.collect()), key=lambda r: r[0]) == sorted(map(tuple, plain.collect()), key=lambda r: r[0])


def test_hot_rows_are_spread(spark, facts):
    hot = hot_keys(facts, "k", task_rows=1000)
    salted, _ = spread_left(facts, dimension(spark), "k", "key", hot)
    largest = salted.groupBy("k", "__salt").count().agg(F.max("count")).first()[0]
    assert largest < 1300
    same = spark.range(5000, numPartitions=5).select(F.lit(7).cast("bigint").alias("k"), F.lit("equal").alias("v"))
    spread, _ = spread_left(same, dimension(spark), "k", "key", hot)
    sizes = [r["count"] for r in spread.groupBy("__salt").count().collect()]
    assert len(sizes) == 11 and max(sizes) <= 2 * min(sizes)
    assert salted.filter("k <> 7 and __salt <> 0").count() == 0


def test_left_join_with_hot_keys_on_the_right(spark):
    left = spark.createDataFrame([(7, "a"), (7, "b"), (8, "c"), (9, "d"), (None, "e")], "k bigint, l string")
    right = spark.range(3000).select(F.when(F.col("id") < 2990, 7).otherwise(8).cast("bigint").alias("k"), F.col("id").alias("r"))
    right = right.union(spark.createDataFrame([(None, -1)], "k bigint, r bigint"))
    hot = hot_keys(right, "k", task_rows=100)
    assert parts(hot) == {7: 30}
    order = lambda df: sorted(map(tuple, df.select("k", "l", "r").collect()), key=str)
    assert order(left_join_hot_right(left, right, "k", hot)) == order(left.join(right, "k", "left"))


def test_a_key_wrongly_taken_for_hot_changes_nothing(spark):
    left = spark.createDataFrame([(8, "c"), (9, "d")], "k bigint, l string")
    right = spark.createDataFrame([(8, 1)], "k bigint, r bigint")
    joined = left_join_hot_right(left, right, "k", hot_frame(spark, rows=[(8, 50), (9, 4)]))
    assert sorted(map(tuple, joined.select("k", "l", "r").collect())) == [(8, "c", 1), (9, "d", None)]


def test_allocation_and_views_with_hot_keys(spark):
    items = spark.range(3000).select(
        F.when(F.col("id") < 1500, 1).otherwise(F.col("id") % 50).alias("i"),
        F.when(F.col("id") % 3 == 0, 99).otherwise(F.col("id") % 700).alias("v"),
    )
    invoices = spark.range(60).select(F.col("id").alias("i"), (F.col("id") * 10.0).alias("value"))
    hot = hot_keys(items, "i", task_rows=200)
    assert set(parts(hot)) == {1}
    order = lambda df: sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)
    plain = allocation.allocate_items(items, invoices, "i", "v", "value")
    assert order(allocation.allocate_items(items, invoices, "i", "v", "value", hot=hot)) == order(plain)

    bridge = plain.withColumnRenamed("i", "codigo_boleto")
    snapshot = spark.range(60).select(
        F.col("id").alias("codigo_boleto"), F.lit(date(2026, 1, 1)).alias("dt_referencia"), F.lit(5.0).alias("valor_boleto"),
        *(F.lit(None).cast("string").alias(n) for n in ("data_emissao", "data_vencimento", "dias_em_atraso", "faixa_atraso", "pago")),
    )
    vehicles = spark.range(700).select(
        F.col("id").alias("codigo_veiculo"), F.col("id").alias("sk_vehicle"), F.lit(date(1900, 1, 1)).alias("valido_de"),
        F.lit(None).cast("date").alias("valido_ate"), F.lit(True).alias("vigente"),
        *(F.col("id").alias(n) for n in views.VEHICLE_COLUMNS),
    )
    hot = {"hot_invoices": hot_frame(spark, rows=[(1, 7)]), "hot_vehicles": hot_frame(spark, rows=[(99, 5), (None, 3)])}
    for view in (views.by_current_owner, views.by_owner_at_snapshot):
        assert order(view(snapshot, bridge, vehicles, **hot)) == order(view(snapshot, bridge, vehicles))
