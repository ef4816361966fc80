"""What keeps loads within bounds as tables grow: tasks of a bounded size, one shuffle, nothing left behind."""

from datetime import date, datetime
from pathlib import Path

from pyspark.sql import functions as F

from ledgerloom import session
from ledgerloom.catalog import inputs as I, joins, loads
from ledgerloom.operators.dedupe import dealt
from ledgerloom.operators.temporal import interval_faults
from ledgerloom.plans import entities as E, jobs, transforms as T
from ledgerloom.sources import landed
from ledgerloom.streaming.landing import load_new_files

SF = "/root/testdata/sf0.001"
DAY = jobs.Run(date(2001, 8, 2), datetime(2001, 8, 2, 3))


def folders(spark, label):
    return set(Path(session.shared_dir(spark), "ledgerloom").glob(f"{label}-*"))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_are_dealt_over_as_many_tasks_as_they_need(spark):
    df = spark.range(1000).select("id", F.lit("x").alias("v"))
    parts = dealt(df, ["id"], 50).select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert dealt(df, ["v"], 50) is df  # a hot key is left to the group limit
    assert dealt(df.limit(0), ["id"]).count() == 0


def test_wide_rows_are_not_sorted_before_they_are_sent(spark):
    for base, entity in (("part", E.VEHICLES), ("customer", E.CUSTOMERS)):
        plan = plan_of(T.conform(I.raw_entity(spark, SF, base, entity), entity, ["__seq"]))
        assert plan.count("Exchange") == 1 and "Sort" not in plan.split("Exchange")[1]


def test_the_last_of_repeats_is_found_in_the_same_shuffle(spark):
    raw = I.raw_entity(spark, SF, "orders", E.INVOICES, loads._INVOICE_EXTRA).limit(1).drop("codigo_boleto", "nosso_numero", "__seq")
    rows = [(" 5", "a", 1), (" 5", "b", 2), ("5", "c", 3), ("6", "d", 1), (None, "e", 1), (None, "f", 2)]
    repeats = spark.createDataFrame(rows, "codigo_boleto string, nosso_numero string, __seq int").crossJoin(raw)
    shown = T.conform(repeats, E.INVOICES, ["__seq"], last_of_repeats=True)
    assert {(r.codigo_boleto, r.nosso_numero) for r in shown.collect()} == {("5", "b"), ("6", "d"), (None, "f")}
    large = I.raw_entity(spark, SF, "orders", E.INVOICES, loads._INVOICE_EXTRA)
    assert plan_of(T.conform(large, E.INVOICES, ["__seq"], last_of_repeats=True)).count("Exchange") == 1


def test_a_load_leaves_no_intermediate_files(spark):
    labels = ("initial-invoices", "initial-bridge", "keyed", "invoices", "delinquency", "bridge")
    before = {label: folders(spark, label) for label in labels}
    loads.initial_load(spark, SF).collect()
    loads.daily_run(spark, SF).collect()
    assert {label: folders(spark, label) for label in labels} == before


def test_shuffle_files_go_with_the_write(spark):
    seen = []
    with session.freeing_shuffles(spark):
        with session.freeing_shuffles(spark):
            seen.append(spark.conf.get(session.CLEANUP))
        seen.append(spark.conf.get(session.CLEANUP))
    assert seen == ["true", "true"] and spark.conf.get(session.CLEANUP, None) in (None, "false")


def test_landed_records_may_be_compressed(spark, tmp_path):
    landed.write_records(spark.range(25).coalesce(1), f"{tmp_path}/in/0", "gzip", 10)
    assert len(list(Path(tmp_path, "in/0").glob("*.json.gz"))) == 3
    got = []
    load_new_files(spark, f"{tmp_path}/in", "id long", f"{tmp_path}/progress", lambda df: got.extend(r.id for r in df.collect()))
    assert sorted(got) == list(range(25))
    assert not Path(tmp_path, "progress/arrived/0").exists()


def test_few_partitions_are_written_as_they_are(spark, warehouse):
    for n in (9, 200):  # one range, and more than a task keeps open
        batch = spark.range(n).select(F.col("id").cast("string").alias("k"), F.lit(n).alias("v"))
        warehouse.upsert_ranges("t", batch, ["k"])
        assert {(r.k, r.v) for r in warehouse.read("t").collect()} == {(str(i), n) for i in range(n)}


def test_interval_faults_read_versions_once(spark):
    day = lambda d: None if d is None else date(2020, 1, d)
    rows = [
        (1, 1, 5, False), (1, 5, None, True),
        (2, 1, 5, False), (2, 7, None, True),
        (3, 1, 9, False), (3, 5, None, True),
        (4, 5, 1, True),
        (5, None, 4, True), (5, None, None, False),
        (None, 1, 9, True), (None, 1, 9, True),
        (6, 1, 3, False), (6, 5, 7, False), (7, 3, 3, True),
    ]
    dim = spark.createDataFrame([(k, day(a), day(b), c) for k, a, b, c in rows], "k int, valido_de date, valido_ate date, vigente boolean")
    found = {r.k: (r.inverted, r.current_versions, r.overlaps, r.gaps) for r in interval_faults(dim, "k").collect()}
    assert found == {2: (0, 1, 0, 1), 3: (0, 1, 1, 0), 4: (1, 1, 0, 1), None: (0, 2, 0, 0), 6: (0, 0, 0, 1)}
    assert plan_of(interval_faults(I.table(spark, SF, "lineitem").selectExpr("l_partkey k", "date(l_shipdate) valido_de", "date(null) valido_ate", "true vigente"), "k")).count("FileScan") == 1


def test_a_long_history_is_dealt_over_more_tasks(spark, monkeypatch):
    whole = sorted(map(tuple, I.history(spark, SF).collect()), key=repr)
    monkeypatch.setattr(I, "TASK_LINES", 500)
    assert sorted(map(tuple, I.history(spark, SF).collect()), key=repr) == whole
    assert "REPARTITION_BY_NUM" in plan_of(I.history(spark, SF))


def test_views_look_for_no_hot_keys_and_settle_no_bridge(spark):
    before = folders(spark, "hot-keys"), folders(spark, "bridge")
    joins.view_historical_rows(spark, SF)
    assert len(folders(spark, "hot-keys") - before[0]) == 1  # those of the allocation itself
    assert folders(spark, "bridge") == before[1]
