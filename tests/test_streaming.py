"""Landed files are loaded once, and a day that failed goes on where it stopped."""

import time

import pytest

from ledgerloom.operators.checks import LoadRefused
from ledgerloom.plans import jobs
from ledgerloom.streaming.landing import load_new_files
from tests.test_jobs import DAY1, DAY2, sources


def land(path, name, lines):
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text("".join(f"{line}\n" for line in lines))
    time.sleep(0.01)


def test_each_file_is_given_once_and_again_after_a_failure(spark, tmp_path):
    landing, progress, seen = tmp_path / "landing", str(tmp_path / "progress"), []

    def load(batch):
        assert not batch.isStreaming and {"__file", "__block", "__row"} <= set(batch.columns)
        seen.append(sorted(r.id for r in batch.collect()))
        if seen[-1] == [3, 4]:
            seen[-1].append("failed")
            raise LoadRefused("not today")

    run = lambda: load_new_files(spark, str(landing), "id int", progress, load)
    land(landing, "a.json", ['{"id": 1}', '{"id": 2}'])
    assert run() == 1 and run() == 0 and seen == [[1, 2]]
    land(landing / "deeper", "b.json", ['{"id": 3}', '{"id": 4}'])
    with pytest.raises(LoadRefused, match="not today"):
        run()
    land(landing, "c.json", ['{"id": 5}'])
    load_all = lambda batch: seen.append(sorted(r.id for r in batch.collect()))
    assert load_new_files(spark, str(landing), "id int", progress, load_all) == 2
    assert seen == [[1, 2], [3, 4, "failed"], [3, 4], [5]] and run() == 0


def test_an_unreadable_record_stops_its_batch(spark, tmp_path):
    landing, seen = tmp_path / "landing", []
    land(landing, "a.json", ['{"id": 1}', "no json"])
    with pytest.raises(Exception, match="(?i)malformed"):
        load_new_files(spark, str(landing), "id int", str(tmp_path / "progress"), lambda batch: seen.append(batch.count()))
    assert seen == []


def test_a_failed_day_resumes_without_loading_anything_twice(spark, warehouse, tmp_path, monkeypatch):
    day = sources(spark, 1)
    for entity, df in day.items():
        df.coalesce(1).write.json(str(tmp_path / "landing" / entity / "day1"))
    lookup = spark.createDataFrame([("1", "Ativo")], "codigo_situacao string, descricao_situacao string")
    daily = lambda run: jobs.daily_pipeline(warehouse, str(tmp_path / "landing"), {entity: df.schema for entity, df in day.items()}, lookup, run)

    real = jobs.load_bridge
    monkeypatch.setattr(jobs, "load_bridge", lambda *a, **b: (_ for _ in ()).throw(OSError("lost the shared folder")))
    with pytest.raises(OSError, match="lost the shared folder"):
        daily(DAY1)
    assert warehouse.read("dim_customers").count() == 2 and not warehouse.exists(jobs.BRIDGE) and not warehouse.exists(jobs.SNAPSHOT)
    monkeypatch.setattr(jobs, "load_bridge", real)
    daily(DAY2)
    # Dimensions were loaded on the first day and had nothing new; the rest was made up for on the second.
    assert {r.atualizado_em for r in warehouse.read("dim_customers").collect()} == {DAY1.now}
    facts = {r.codigo_boleto: r for r in warehouse.read(jobs.FACTS).collect()}
    assert set(facts) == {"1", "25"} and {r.atualizado_em for r in facts.values()} == {DAY2.now}
    assert facts["1"].criado_em == DAY1.now  # the facts themselves had been written before the failure
    assert warehouse.read(jobs.BRIDGE).count() == 3
    assert [r.dt_referencia for r in warehouse.read(jobs.SNAPSHOT).collect()] == [DAY2.reference]
    before = {t: sorted(map(str, warehouse.read(t).collect())) for t in (jobs.FACTS, jobs.BRIDGE, "dim_vehicles")}
    daily(jobs.Run(DAY2.reference, DAY2.now.replace(hour=5)))
    assert before == {t: sorted(map(str, warehouse.read(t).collect())) for t in before}


def test_one_refused_dimension_keeps_its_files_for_the_next_run(spark, warehouse, tmp_path):
    day = sources(spark, 1)
    for entity, df in day.items():
        again = df.unionByName(df) if entity == "statuses" else df
        again.coalesce(1).write.json(str(tmp_path / "landing" / entity / "day1"))
    lookup = spark.createDataFrame([("1", "Ativo")], "codigo_situacao string, descricao_situacao string")
    schemas = {entity: df.schema for entity, df in day.items()}
    broken = {**schemas, "regionals": "codigo_regional string"}
    with pytest.raises(LoadRefused, match="regionals"):
        jobs.daily_pipeline(warehouse, str(tmp_path / "landing"), broken, lookup, DAY1)
    assert warehouse.exists("dim_vehicles") and not warehouse.exists("dim_regionals") and not warehouse.exists(jobs.FACTS)
    jobs.daily_pipeline(warehouse, str(tmp_path / "landing"), schemas, lookup, DAY1)
    assert warehouse.read("dim_regionals").count() == 1 and warehouse.read(jobs.FACTS).count() == 2
