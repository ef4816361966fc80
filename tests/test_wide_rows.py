"""What a load does with rows of some forty columns: how often they are sent and written, in how many tasks, how compiled."""

from contextlib import contextmanager
from datetime import date, datetime
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerloom import session
from ledgerloom.operators import dedupe
from ledgerloom.operators.checks import LoadRefused
from ledgerloom.operators.upsert import upsert, upsert_known
from ledgerloom.plans import jobs
from ledgerloom.sources import landed
from ledgerloom.streaming import landing

DAY = jobs.Run(date(2001, 8, 2), datetime(2001, 8, 2, 3))


def invoices(spark, rows):
    return spark.createDataFrame(
        [(k, c, date(2001, 7, d), 10.0, "x") for k, c, d in rows],
        "codigo_boleto string, codigo_associado string, data_emissao date, valor_boleto double, nosso_numero string",
    )


@pytest.fixture
def with_customers(spark, warehouse):
    early, late = (date(1900, 1, 1), date(2001, 7, 10), False), (date(2001, 7, 10), None, True)
    rows = [("c1", 1, *early), ("c1", 2, *late), ("c2", 3, date(2001, 7, 20), None, True)]
    columns = "codigo_associado string, sk_customer bigint, valido_de date, valido_ate date, vigente boolean"
    warehouse.replace("dim_customers", spark.createDataFrame(rows, columns))
    return warehouse


ROWS = [("1", "c1", 1), ("2", "c1", 15), ("3", "c2", 5), ("4", "c2", 25), ("5", None, 5), ("6", "c9", 5)]
KEYS = {"1": 1, "2": 2, "3": None, "4": 3, "5": None, "6": None}


def test_only_keys_customers_and_days_are_looked_up(spark, with_customers):
    batch, keyed = jobs._with_customer_key(with_customers, invoices(spark, ROWS), jobs.FACT_KEYS)
    assert keyed.columns == ["codigo_boleto", "sk_customer"]
    assert batch.columns == [*invoices(spark, ROWS).columns, "sk_customer"]
    assert {r.codigo_boleto: r.sk_customer for r in batch.collect()} == KEYS


def test_facts_and_snapshot_hold_the_version_of_the_day(spark, with_customers, monkeypatch):
    for limit in (dedupe.TASK_ROWS, 1):  # in the session's tasks, then a task for each row
        monkeypatch.setattr(jobs, "in_tasks", lambda df, keys, rows, limit=limit: dedupe.in_tasks(df, keys, rows, limit))
        jobs.load_facts(with_customers, invoices(spark, ROWS), DAY)
        jobs.load_snapshot(with_customers, invoices(spark, ROWS).withColumn("dt_referencia", F.lit(DAY.reference)), DAY)
        for table in (jobs.FACTS, jobs.SNAPSHOT):
            assert {r.codigo_boleto: r.sk_customer for r in with_customers.read(table).collect()} == KEYS


def test_repeated_and_null_keys_are_still_refused(spark, with_customers):
    for rows in ([*ROWS, ("1", "c2", 5)], [*ROWS, (None, "c1", 5)]):
        with pytest.raises(LoadRefused):
            jobs.load_facts(with_customers, invoices(spark, rows), DAY)
    overlap = with_customers.read("dim_customers")
    with_customers.replace("dim_customers", overlap.unionByName(overlap.limit(1)))
    with pytest.raises(LoadRefused):
        jobs.load_facts(with_customers, invoices(spark, ROWS), DAY)


def test_wide_rows_go_over_as_many_tasks_as_they_need(spark):
    wide = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    assert dedupe.in_tasks(wide, ["k"], 1000) is wide
    joined = dedupe.in_tasks(wide, ["k"], 1000, 50).join(wide.hint("merge"), "k")
    assert joined.select(F.spark_partition_id()).distinct().count() == 20


def test_stages_too_long_to_be_compiled_are_not_fused(spark):
    with session.writing(spark):
        assert spark.conf.get(session.METHOD_LIMIT) == "8000" and spark.conf.get(session.CLEANUP) == "true"
    assert spark.conf.get(session.METHOD_LIMIT, "65535") != "8000"


def test_records_are_landed_and_arrive_by_compiled_code(spark, tmp_path, monkeypatch):
    limits, compression = [], set()

    @contextmanager
    def seen(session_of):
        with session.writing(session_of):
            limits.append(session_of.conf.get(session.METHOD_LIMIT))
            yield

    def load(df):
        compression.update(pq.ParquetFile(f.removeprefix("file:")).metadata.row_group(0).column(0).compression for f in df.inputFiles())

    monkeypatch.setattr(landed, "writing", seen)
    monkeypatch.setattr(landing, "writing", seen)
    landed.write_records(spark.range(5), f"{tmp_path}/in/0")
    landing.load_new_files(spark, f"{tmp_path}/in", "id long", f"{tmp_path}/progress", load)
    assert limits == ["8000", "8000"] and compression == {"ZSTD"}


def test_tables_and_landed_frames_are_dense(spark, warehouse):
    warehouse.upsert_ranges("t", spark.range(9).select(F.col("id").cast("string").alias("k")), ["k"])
    landed = warehouse.land(spark.range(9).toDF("k"), "dense")
    files = [*Path(f"{warehouse.root}/t").rglob("*.parquet"), *(Path(f.removeprefix("file:")) for f in landed.inputFiles())]
    assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}


def test_invoices_and_delinquency_are_not_transformed_at_the_same_time(spark, warehouse, monkeypatch):
    def handed_over(tasks):
        raise LookupError(*sorted(tasks[""].args[0]), len(tasks))

    monkeypatch.setattr(jobs, "_together", handed_over)
    with pytest.raises(LookupError) as found:
        jobs.daily_run(warehouse, {}, spark.range(0), DAY, [])
    assert found.value.args == ("delinquency", "invoices", 8)


def test_an_upsert_by_known_keys_gives_the_same_state(spark):
    target = spark.createDataFrame(
        [("1", "a", 1, "x"), ("2", "b", 2, "y"), ("3", None, None, "z"), (None, "n", 4, "w")], "k string, v string, made int, only string"
    )
    batch = spark.createDataFrame([("2", None, 9, True), ("3", "c", 9, None), ("7", "d", 9, False)], "k string, v string, made int, new boolean")
    untouched = target.select("k").join(batch.select("k"), "k", "left_anti")
    want, got = upsert(target, batch, ["k"], ["made"]), upsert_known(target, batch, ["k"], ["made"], untouched)
    assert got.dtypes == want.dtypes and sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_old_facts_that_a_batch_replaces_are_read_by_what_it_leaves(spark, with_customers, monkeypatch):
    from ledgerloom.plans import warehouse as W

    states = []
    monkeypatch.setattr(W, "upsert_known", lambda *args: states.append(upsert_known(*args)) or states[-1])
    jobs.load_facts(with_customers, invoices(spark, ROWS[:4]).withColumn("gone", F.lit("kept")), DAY)
    later = jobs.Run(date(2001, 8, 3), datetime(2001, 8, 3, 3))
    jobs.load_facts(with_customers, invoices(spark, ROWS[2:]), later)
    rows = {r.codigo_boleto: r for r in with_customers.read(jobs.FACTS).collect()}
    assert {k: r.sk_customer for k, r in rows.items()} == KEYS
    assert {k: (r.criado_em.day, r.atualizado_em.day, r.gone) for k, r in rows.items()} == {
        "1": (2, 2, "kept"), "2": (2, 2, "kept"), "3": (2, 3, "kept"), "4": (2, 3, "kept"), "5": (3, 3, None), "6": (3, 3, None),
    }
    assert len(states) == 1
