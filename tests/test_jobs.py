"""Two days and a rerun through the whole load, on data."""

from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import checks
from ledgerloom.operators.temporal import interval_faults
from ledgerloom.plans import entities as E, jobs
from ledgerloom.plans.jobs import Run
from ledgerloom.plans.warehouse import Warehouse

DAY1 = Run(date(2026, 7, 1), datetime(2026, 7, 1, 3))
DAY2 = Run(date(2026, 7, 2), datetime(2026, 7, 2, 3))
ORDER = ["seq"]


def raw(spark, entity, rows, extra=""):
    """Raw records: every text column of the entity, empty unless given."""
    listed = [*entity.text, *entity.days, *entity.numbers]
    source = {new: old for old, new in entity.renamed.items()}
    names = [source.get(name, name) for name in listed] + [c.split()[0] for c in extra.split(", ") if c]
    kinds = ", ".join([f"{source.get(n, n)} string" for n in listed] + [c for c in extra.split(", ") if c] + ["seq int"])
    data = [tuple(row.get(name) for name in names) + (i,) for i, row in enumerate(rows)]
    return spark.createDataFrame(data, kinds)


def sources(spark, day):
    invoices = [
        {"codigo_boleto": "1", "pago": "N", "codigo_associado": "a1", "data_emissao": "2026-06-01", "data_vencimento": "2026-06-11",
         "valor_boleto": "300", "veiculo": ["V1", "V2"] if day == 1 else ["V2", "V3"], "beneficiario": ["joao"], "codigo_situacao": "2"},
        {"codigo_boleto": "25", "pago": "Y", "codigo_associado": "a2", "data_emissao": "2026-06-20", "data_vencimento": "2026-06-25",
         "valor_boleto": "100", "valor_pagamento": "80", "veiculo": ["V1"], "beneficiario": [], "codigo_situacao": "1"},
        {"codigo_boleto": "25", "pago": "N", "valor_boleto": "1", "veiculo": ["V9"], "codigo_situacao": "1"},
    ]
    extra = "veiculo array<string>, beneficiario array<string>"
    vehicles = [{"codigo_veiculo": "V1", "codigo_voluntario": "10" if day == 1 else "20", "nome_voluntario": "ana"},
                {"codigo_veiculo": "V2", "codigo_voluntario": "10", "nome_voluntario": "ana"}]
    return {
        "statuses": raw(spark, E.STATUSES, [{"codigo_situacao": "1", "descricao_situacao": "Ativo", "situacao": "ATIVO"}], "situacao string"),
        "invoice_statuses": raw(
            spark, E.INVOICE_STATUSES,
            [{"codigo_situacaoboleto": str(i), "descricao": "x", "pago": "SIM", "considerado_inadimplencia": "N"} for i in range(day)],
            "considerado_inadimplencia string, pago string",
        ),
        "volunteers": raw(spark, E.VOLUNTEERS, [{"codigo_voluntario": "10", "cooperativas": [{"codigo_cooperativa": "7"}, {"codigo_cooperativa": "8"}]}], "cooperativas array<struct<codigo_cooperativa:string>>"),
        "cooperatives": raw(spark, E.COOPERATIVES, [{"codigo_cooperativa": "7", "valor_pagamento": "x"}]),
        "regionals": raw(spark, E.REGIONALS, [{"codigo_regional": "3", "nome": " SUL "}]),
        "customers": raw(spark, E.CUSTOMERS, [{"codigo_associado": "A1", "codigo_situacao": "1", "data_nascimento": "2000-07-01", "codigo_regional": str(day)}, {"codigo_associado": "A2"}]),
        "vehicles": raw(spark, E.VEHICLES, vehicles),
        "invoices": raw(spark, E.INVOICES, invoices, extra),
        "delinquency": raw(spark, E.INVOICES, invoices[:1], extra),
    }


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """One warehouse after two days and a rerun; the tests that change it touch one table each."""
    root = tmp_path_factory.mktemp("loaded")
    warehouse = Warehouse(spark, str(root), "wh_loaded", range_size=10)
    lookup = spark.createDataFrame([("1", "Ativo")], "codigo_situacao string, descricao_situacao string")
    changes = [jobs.daily_run(warehouse, sources(spark, day), lookup, run, ORDER) for day, run in [(1, DAY1), (2, DAY2), (2, DAY2)]]
    return warehouse, changes


def test_days_and_rerun(spark, loaded):
    warehouse, changes = loaded
    assert changes[0] == {} and [tuple(r) for r in changes[1]["invoice_statuses"].collect()] == [("1", "x", "added")]
    assert changes[2]["invoice_statuses"].count() == 0

    facts = {r.codigo_boleto: r for r in warehouse.read(jobs.FACTS).collect()}
    assert set(facts) == {"1", "25"}
    assert (facts["1"].dias_em_atraso, facts["1"].faixa_atraso, facts["1"].status_pagamento) == (21, "0-30", "nao_pago")
    assert (facts["25"].dias_em_atraso, facts["25"].faixa_atraso, facts["25"].status_pagamento) == (None, None, "pago_a_menor")
    assert (facts["25"].diferenca_pagamento, facts["25"].veiculo, facts["1"].beneficiario) == (-20.0, "V1", "joao")
    assert facts["1"].criado_em == DAY1.now and facts["1"].atualizado_em == DAY2.now

    customers = warehouse.read("dim_customers")
    assert interval_faults(customers, "codigo_associado").count() == 0
    first = customers.filter("codigo_associado = 'a1' and valido_de = '1900-01-01'").first()
    assert (first.vigente, first.valido_ate, first.descricao_situacao, first.idade) == (False, DAY2.reference, "Ativo", 26)
    assert facts["1"].sk_customer == first.sk_customer
    assert customers.count() == 3 and customers.select("sk_customer").distinct().count() == 3

    bridge = {(r.codigo_boleto, r.codigo_veiculo): r for r in warehouse.read(jobs.BRIDGE).collect()}
    assert set(bridge) == {("1", "v1"), ("1", "v2"), ("1", "v3"), ("25", "v1")}
    assert bridge["1", "v2"].criado_em == DAY1.now and bridge["1", "v3"].criado_em == DAY2.now

    snapshot = warehouse.read(jobs.SNAPSHOT)
    assert sorted((r.codigo_boleto, r.dt_referencia) for r in snapshot.collect()) == [("1", DAY1.reference), ("1", DAY2.reference)]
    assert warehouse.read("dim_volunteers").first().cooperativas == "7,8"
    assert warehouse.read("dim_status").first().situacao_ativa is True
    assert warehouse.read("dim_regionals").first().nome == "sul"


def test_views(spark, loaded):
    warehouse, _ = loaded
    # The views stand since day 1 and show what was loaded on day 2.
    view = lambda name: spark.table(f"{warehouse.database}.{name}")
    current, then = view("vw_delinquency_by_vehicle_atual"), view("vw_delinquency_by_vehicle_historico")
    assert len(current.columns) == 16 and set(then.columns) - set(current.columns) == {"sk_vehicle"}
    owners = lambda df: {(r.dt_referencia, r.codigo_veiculo): r.codigo_voluntario for r in df.collect()}
    assert owners(current)[DAY1.reference, "v1"] == "20" and owners(current)[DAY2.reference, "v2"] == "10"
    assert owners(then)[DAY1.reference, "v1"] == "10"
    assert owners(then)[DAY2.reference, "v1"] == "20"
    from ledgerloom.operators.views import by_current_owner, by_owner_at_snapshot

    snapshot, vehicles, bridge = warehouse.read(jobs.SNAPSHOT), warehouse.read("dim_vehicles"), warehouse.read(jobs.BRIDGE)
    order = lambda df: sorted(map(str, df.select(*sorted(current.columns)).collect()))
    assert order(by_current_owner(snapshot, bridge, vehicles)) == order(current)
    assert order(by_owner_at_snapshot(snapshot, bridge, vehicles)) == order(then)
    before = view("dim_vehicles_current").count()
    warehouse.replace("dim_vehicles", vehicles.filter("codigo_veiculo <> 'v2'"))
    assert view("dim_vehicles_current").count() == before - 1
    warehouse.replace("dim_vehicles", vehicles)


def test_a_day_from_its_landing_folder(spark, warehouse, tmp_path):
    day = sources(spark, 1)
    for entity, df in day.items():
        df.coalesce(1).write.json(str(tmp_path / "landing" / entity))
    lookup = spark.createDataFrame([("1", "Ativo")], "codigo_situacao string, descricao_situacao string")
    jobs.daily_pipeline(warehouse, str(tmp_path / "landing"), {entity: df.schema for entity, df in day.items()}, lookup, DAY1)
    facts = {r.codigo_boleto: r for r in warehouse.read(jobs.FACTS).collect()}
    # The second record of invoice 25 has no day, so it is in no window.
    assert set(facts) == {"1", "25"} and facts["25"].valor_boleto == 100.0 and facts["1"].dias_em_atraso == 20
    assert {"__file", "__row", "window"} & set(warehouse.read(jobs.FACTS).columns) == set()
    late = Run(date(2026, 12, 1), datetime(2026, 12, 1, 3))
    assert jobs.invoices_of_the_day(day["invoices"], late, ORDER).count() == 0


def test_a_failed_slice_stops_the_day(spark, warehouse):
    status = {"vehicles": spark.createDataFrame([(1, None), (2, "ReadTimeout")], "slice int, error string")}
    with pytest.raises(checks.LoadRefused, match="1 slice.*2: ReadTimeout"):
        jobs.daily_run(warehouse, sources(spark, 1), spark.createDataFrame([("1", "x")], "a string, b string"), DAY1, ORDER, status)


def test_a_failing_code_comparison_does_not_stop_the_load(spark, warehouse):
    first = spark.createDataFrame([("1", "x")], "codigo_situacao_boleto string, descricao_situacao_boleto string")
    jobs.load_simple_dimension(warehouse, "invoice_statuses", first, DAY1)
    with pytest.warns(UserWarning, match="could not be compared"):
        assert jobs.load_simple_dimension(warehouse, "invoice_statuses", first.drop("descricao_situacao_boleto"), DAY2) is None
    assert warehouse.read("dim_status_invoice").count() == 1


def test_ages_and_backfill(spark, loaded):
    warehouse, _ = loaded
    ages = {r.table_name: r.age_hours for r in jobs.warehouse_ages(warehouse, datetime(2026, 7, 2, 13)).collect()}
    assert set(ages.values()) == {10.0} and len(ages) == 5
    jobs.backfill_bridge(warehouse, DAY2)
    assert warehouse.read(jobs.BRIDGE).count() == 4


def test_bridge_can_drop_vehicles_that_left(spark, loaded):
    warehouse, _ = loaded
    batch = spark.createDataFrame([("1", "v3", 1, 300.0)], "codigo_boleto string, codigo_veiculo string, qtd_veiculos_boleto bigint, valor_rateado double")
    jobs.load_bridge(warehouse, batch, DAY2, whole_parents=True)
    assert sorted((r.codigo_boleto, r.codigo_veiculo) for r in warehouse.read(jobs.BRIDGE).collect()) == [("1", "v3"), ("25", "v1")]


def test_empty_snapshot_clears_its_day(spark, loaded):
    warehouse, _ = loaded
    empty = warehouse.read(jobs.SNAPSHOT).limit(0).drop("sk_customer", "criado_em")
    jobs.load_snapshot(warehouse, empty, DAY2)
    assert [r.dt_referencia for r in warehouse.read(jobs.SNAPSHOT).collect()] == [DAY1.reference]


def test_untouched_ranges_are_not_rewritten(spark, loaded):
    warehouse, _ = loaded
    files = lambda: {str(p) for p in Path(warehouse.root, jobs.FACTS).rglob("*.parquet")}
    before = files()
    batch = warehouse.read(jobs.FACTS).filter("codigo_boleto = '25'").withColumn("novo", F.lit("x"))
    warehouse.upsert_ranges(jobs.FACTS, batch, ["codigo_boleto"])
    kept = {p for p in before & files()}
    assert kept and all("id_range=0" in p for p in kept)
    assert {r.codigo_boleto: r.novo for r in warehouse.read(jobs.FACTS).collect()} == {"1": None, "25": "x"}


def test_one_failing_entity_does_not_stop_the_others(spark, warehouse):
    day = sources(spark, 1)
    lookup = spark.createDataFrame([("1", "Ativo")], "codigo_situacao string, descricao_situacao string")
    from ledgerloom.plans import transforms as T

    batches = {
        "statuses": T.transform_statuses(day["statuses"], ORDER),
        "invoice_statuses": T.transform_invoice_statuses(day["invoice_statuses"], ORDER),
        "volunteers": T.transform_volunteers(day["volunteers"], ORDER),
        "cooperatives": None,
        "regionals": T.transform_regionals(day["regionals"], ORDER),
        "customers": T.transform_customers(day["customers"], lookup, DAY1.reference, ORDER),
        "vehicles": T.transform_vehicles(day["vehicles"], ORDER),
    }
    with pytest.raises(checks.LoadRefused, match="cooperatives"):
        jobs.load_dimensions(warehouse, batches, DAY1)
    assert not warehouse.exists("dim_cooperatives")
    assert all(warehouse.exists(t) for t in ["dim_status", "dim_status_invoice", "dim_volunteers", "dim_regionals", "dim_customers", "dim_vehicles"])


def test_guards_stop_a_dimension_load(spark, warehouse):
    many = spark.createDataFrame([(str(i), "x") for i in range(10)], "codigo_regional string, nome string")
    jobs.load_simple_dimension(warehouse, "regionals", many, DAY1)
    with pytest.raises(checks.LoadRefused, match="fell from 10 to 6"):
        jobs.load_simple_dimension(warehouse, "regionals", many.limit(6), DAY2)
    with pytest.raises(checks.LoadRefused, match="repeats"):
        jobs.load_simple_dimension(warehouse, "regionals", many.union(many), DAY2)
    assert warehouse.read("dim_regionals").count() == 10


def test_initial_load(spark, warehouse):
    jobs.initial_load(warehouse, sources(spark, 1)["invoices"], DAY1, ORDER)
    facts = {r.codigo_boleto: r for r in warehouse.read(jobs.FACTS).collect()}
    assert facts["25"].pago == "n" and facts["25"].valor_boleto == 1.0 and facts["1"].sk_customer is None
    assert "criado_em" not in facts["1"].asDict()
    assert warehouse.read(jobs.BRIDGE).count() == 3


def test_an_upsert_reads_only_the_ranges_it_touches(spark, loaded):
    warehouse, _ = loaded
    state = spark.table(warehouse.name(jobs.FACTS)).filter(F.col("id_range").isin([2])).select("codigo_boleto")
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "id_range" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_initial_load_by_slice_goes_on_where_it_stopped(spark, warehouse, tmp_path, monkeypatch):
    day = sources(spark, 1)["invoices"]
    moved = day.filter("codigo_boleto = '1'").withColumns({"veiculo": F.array(), "valor_boleto": F.lit("7"), "seq": F.lit(9)})
    other = day.filter("codigo_boleto = '1'").withColumns({"codigo_boleto": F.lit("31"), "seq": F.lit(10)})
    months = [day.withColumn("month", F.lit("2026-05")), moved.withColumn("month", F.lit("2026-06")), other.withColumn("month", F.lit("2026-07"))]
    history = months[0].unionByName(months[1]).unionByName(months[2])
    whole = Warehouse(spark, str(tmp_path / "whole"), "wh_whole_history", range_size=10)
    jobs.initial_load(whole, history.drop("month"), DAY1, ORDER)

    real, calls = jobs.load_bridge, []

    def stops(*args, **options):
        calls.append(1)
        if len(calls) == 2:
            raise OSError("killed")
        return real(*args, **options)

    load = lambda: jobs.initial_load_by_slice(warehouse, history, "month", DAY1, ORDER)
    monkeypatch.setattr(jobs, "load_bridge", stops)
    with pytest.raises(OSError):
        load()
    assert load() == 2 and load() == 0  # the month it stopped in, and the one behind it
    for table, columns in ((jobs.FACTS, ["codigo_boleto", "valor_boleto", "veiculo", "pago"]), (jobs.BRIDGE, ["codigo_boleto", "codigo_veiculo", "valor_rateado"])):
        state = lambda w: sorted(map(str, w.read(table).select(*columns).collect()))
        assert state(warehouse) == state(whole)
    assert {r.codigo_boleto for r in warehouse.read(jobs.BRIDGE).collect()} == {"25", "31"}
