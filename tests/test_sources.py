import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerloom.sources import landed, pages, windows

RECORD = "struct<id: bigint>"


def landed_pages(spark, bodies):
    rows = [(s, p, body if isinstance(body, str) or body is None else json.dumps(body)) for s, p, body in bodies]
    return spark.createDataFrame(rows, "slice string, page int, body string")


def flatten(spark, bodies, items_key="items"):
    records = pages.flatten_pages(landed_pages(spark, bodies), RECORD, items_key)
    assert records.columns == ["slice", "page", "position", "id"]
    return [(r.slice, r.id) for r in records.orderBy("slice", "page", "position").collect()]


def behind(spark, bodies, page_size, total_key=None):
    report = pages.pages_behind_stop(landed_pages(spark, bodies), RECORD, "items", page_size, total_key)
    return sorted(map(tuple, report.collect()))


def items(*ids):
    return [{"id": i} for i in ids]


def test_all_landed_pages_are_kept(spark):
    bodies = [("a", 0, {"items": items(1, 2)}), ("a", 1, items(3)), ("a", 2, {"items": [], "total": 2}), ("a", 3, {}), ("a", 4, {"items": items(4, 5)})]
    assert flatten(spark, bodies) == [("a", i) for i in range(1, 6)]
    assert flatten(spark, [("a", 0, {})]) == []


@pytest.mark.parametrize("bad", ['{"items": [{"id": 2}, {"id"', "", None, '{"items": [{"id": "x"}]}'])
def test_an_unreadable_page_raises(spark, bad):
    bodies = [("a", 0, {"items": items(1)}), ("a", 1, bad), ("a", 2, {"items": items(3)})]
    with pytest.raises(Exception, match="MALFORMED|landed page|CANNOT_PARSE"):
        flatten(spark, bodies)


def test_pages_behind_a_short_or_empty_page_are_reported(spark):
    short = [("a", 0, {"items": items(1, 2)}), ("a", 1, {"items": items(3)}), ("a", 2, {"items": items(4, 5)}), ("b", 0, items(6))]
    assert behind(spark, short, 2) == [("a", 1, 1, 2)]
    full = [("a", p, items(2 * p, 2 * p + 1)) for p in range(5)]
    assert behind(spark, full, 2) == []


def test_pages_behind_the_declared_total_are_reported(spark):
    body = lambda total, *ids: {"items": items(*ids), "total": total}
    beyond = [("a", 0, body(4, 1, 2)), ("a", 1, body(9, 3, 4)), ("a", 2, body(9, 5, 6)), ("b", 0, body(9, 7, 8))]
    assert behind(spark, beyond, 2, "total") == [("a", 1, 1, 2)]
    lists = [("a", 0, items(1, 2)), ("a", 1, items(3, 4)), ("a", 2, {"items": items(5, 6), "total": 4}), ("a", 3, items(7, 8))]
    assert behind(spark, lists, 2, "total") == [("a", 2, 1, 2)]
    assert behind(spark, lists[:2], 2, "total") == []


def test_total_shortfall(spark):
    df = landed_pages(spark, [("a", 0, items(1)), ("a", 1, {"items": items(1, 2), "total": 4}), ("b", 0, items(1))])
    report = pages.total_shortfall(df, RECORD, "items", "total").collect()
    assert [(r.slice, r.declared, r.received, r.complete) for r in report] == [("a", 4, 3, False)]


def test_a_bad_line_raises(spark, tmp_path):
    path = tmp_path / "bad.json"
    path.write_text('{"codigo": 1}\n{"codigo": \n{"codigo": 3}\n')
    with pytest.raises(Exception, match="MALFORMED"):
        landed.read_records(spark, str(path), "codigo int").collect()
    path.write_text('{"1": "ativo"')
    with pytest.raises(Exception, match="MALFORMED"):
        landed.read_lookup(spark, str(path), "c", "d").collect()


def test_records_round_trip(spark, tmp_path):
    path = str(tmp_path / "raw")
    df = spark.createDataFrame([(1, "Áña"), (2, "b")], "codigo int, nome string")
    landed.write_records(df.coalesce(1), path)
    back = landed.read_records(spark, path, df.schema, ordered=True)
    assert [r.nome for r in back.orderBy(*landed.INGEST_ORDER).collect()] == ["Áña", "b"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        landed.read_records(spark, str(tmp_path / "absent"), df.schema)


def test_array_file_and_lookup(spark, tmp_path):
    array, lookup = tmp_path / "a.json", tmp_path / "l.json"
    array.write_text('[{"codigo_associado": 1, "nome": "Ana", "livre": {"x": 1}}]', encoding="utf-8")
    lookup.write_text('{"1": "ativo", "2": "inativo"}', encoding="utf-8")
    df = landed.read_records(spark, str(array), "codigo_associado string, nome string, livre string", one_array=True)
    assert tuple(df.first()) == ("1", "Ana", '{"x": 1}')
    assert {tuple(r) for r in landed.read_lookup(spark, str(lookup), "c", "d").collect()} == {("1", "ativo"), ("2", "inativo")}
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        landed.read_lookup(spark, str(tmp_path / "absent.json"), "c", "d").collect()


def test_dated_tables(spark, tmp_path):
    path = str(tmp_path / "dated")
    df = spark.createDataFrame([(1, date(2026, 1, 1)), (2, date(2026, 1, 2))], "v int, dt date")
    landed.write_dated(df, path, "dt")
    landed.write_dated(df.filter("v = 2").withColumn("v", F.lit(5)), path, "dt")
    back = spark.read.parquet(path)
    assert sorted(r.v for r in back.collect()) == [1, 5]
    assert [r.v for r in landed.latest_slice(back, "dt").collect()] == [5]
    newest = landed.read_latest(spark, path, "dt")
    assert [(r.v, r.dt) for r in newest.collect()] == [(5, date(2026, 1, 2))]
    with pytest.raises(FileNotFoundError):
        landed.latest_slice(back.limit(0), "dt")
    with pytest.raises(FileNotFoundError):
        landed.read_latest(spark, str(tmp_path / "nothing"), "dt")


def test_slices(spark):
    df = spark.createDataFrame([(1,)], "v int")
    both = landed.union_slices({2: df, 1: df}, "codigo_situacao", "rank")
    assert [tuple(r) for r in both.orderBy("rank").collect()] == [(1, 2, 0), (1, 1, 1)]
    assert landed.open_invoices(both).count() == 1


def test_windows(spark):
    today, d = date(2026, 7, 31), lambda m, n: date(2026, m, n)
    data = [
        (1, d(7, 24), None, None), (2, d(7, 23), None, None), (3, d(7, 30), d(7, 1), d(8, 30)), (4, d(7, 31), None, d(8, 31)),
        (5, None, d(7, 31), None), (6, None, d(6, 30), None),
    ]
    df = spark.createDataFrame(data, "id int, e date, p date, v date")
    hits = windows.incremental_windows(df, today, "e", "p", "v")
    assert sorted((r.id, r.window) for r in hits.collect()) == [(1, "NEW"), (3, "DUE"), (3, "NEW"), (3, "PAID"), (5, "PAID")]
    merged = windows.merge_windows(hits, "id", ["e"])
    assert sorted((r.id, r.window) for r in merged.collect()) == [(1, "NEW"), (3, "DUE"), (5, "PAID")]


def test_window_days_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "invoices")
    data = [(1, date(2026, 7, 1), date(2026, 7, 1), date(2026, 7, 1), "unused")]
    spark.createDataFrame(data, "id int, e date, p date, v date, other string").write.parquet(path)
    hits = windows.incremental_windows(spark.read.parquet(path), date(2026, 7, 31), "e", "p", "v").select("id", "window")
    # Plans shorten long filter lists when printed; show them whole.
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = hits._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan.split("PushedFilters: [")[1].split("ReadSchema")[0]
    assert "2026-07-24" in pushed and "2026-08-30" in pushed and "other" not in plan.split("ReadSchema")[1]
