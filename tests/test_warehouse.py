"""State that outlives a session, and batches that must not get in."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.checks import LoadRefused
from ledgerloom.plans.warehouse import Warehouse, id_range


@pytest.fixture
def two_sessions(spark, tmp_path):
    """The same folder as two sessions see it: the second one's catalog has never heard of the tables."""
    other = spark.newSession()
    name = tmp_path.name.replace("-", "_")
    root = str(tmp_path / "shared")
    return Warehouse(spark, root, f"one_{name}", range_size=10), Warehouse(other, root, f"two_{name}", range_size=10)


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_a_second_session_goes_on_with_the_tables(spark, two_sessions):
    one, two = two_sessions
    batch = lambda w, *data: w.spark.createDataFrame(list(data), "k bigint, v string")
    one.upsert_ranges("facts", batch(one, (1, "a"), (2, "b"), (55, "c")), ["k"])
    two.upsert_ranges("facts", batch(two, (2, "new"), (70, "d")), ["k"])
    assert rows(two.read("facts")) == [(1, "a"), (2, "new"), (55, "c"), (70, "d")]
    one.upsert("dim", batch(one, (1, "a"), (2, "b")), ["k"])
    two.upsert("dim", batch(two, (2, "new")), ["k"])
    assert rows(two.read("dim")) == [(1, "a"), (2, "new")]
    one.replace_slices("snapshot", batch(one, (1, "mon"), (2, "mon")), "v", ["k", "v"])
    two.replace_slices("snapshot", batch(two, (3, "tue")), "v", ["k", "v"])
    assert rows(two.read("snapshot").select("k", "v")) == [(1, "mon"), (2, "mon"), (3, "tue")]


def test_what_must_not_get_in_leaves_the_table_as_it_was(spark, two_sessions):
    one, _ = two_sessions
    first = spark.createDataFrame([(1, 5)], "k bigint, v bigint")
    one.upsert_ranges("facts", first, ["k"])
    one.upsert("dim", first, ["k"])
    for load, table in ((one.upsert_ranges, "facts"), (one.upsert, "dim")):
        with pytest.raises(LoadRefused, match="repeats"):
            load(table, first.union(first), ["k"])
        with pytest.raises(LoadRefused, match="arrived as double"):
            load(table, first.withColumn("v", F.lit(0.5)), ["k"])
        load(table, first.withColumn("v", F.lit(7)), ["k"])
        assert rows(one.read(table)) == [(1, 7)]
    with pytest.raises(LoadRefused, match="repeats"):
        one.upsert("new", first.union(first), ["k"])
    other_layout = Warehouse(spark, one.root, one.database, range_size=20)
    with pytest.raises(LoadRefused, match="laid out"):
        other_layout.upsert_ranges("facts", first, ["k"])
    first.write.parquet(f"{one.root}/stray/part")
    with pytest.raises(LoadRefused, match="never published"):
        one.upsert_ranges("stray", first, ["k"])


def test_superseded_versions_go_after_their_grace(spark, two_sessions):
    one, _ = two_sessions
    for v in (1, 2, 3):
        one.upsert("dim", spark.createDataFrame([(1, v)], "k bigint, v bigint"), ["k"])
    assert one.remove_superseded("dim") == 0
    assert one.remove_superseded("dim", hours=-1) == 2
    assert rows(one.read("dim")) == [(1, 3)]


def test_ranges_are_bounded(spark):
    ids = spark.createDataFrame([("7",), ("123456789012345678",), ("x",), ("-3",), (None,)], "k string")
    found = [r[0] for r in ids.select(id_range("k", 10)).collect()]
    assert found[0] == 0 and all(-64 <= f < 0 for f in found[1:])
