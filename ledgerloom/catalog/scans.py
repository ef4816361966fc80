"""Queries for reading and landing data."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ledgerloom.catalog import inputs as I
from ledgerloom.catalog.registry import query
from ledgerloom.functions import calendar
from ledgerloom.operators.allocation import stored_items
from ledgerloom.operators.temporal import dimension_versions
from ledgerloom.session import fresh_path
from ledgerloom.sources import arrays, landed, pages, windows


def _landed_json(spark, df, label):
    path = fresh_path(spark, label)
    landed.write_records(df, path)
    return landed.read_records(spark, path, df.schema)


@query("scan_raw_json", "SELECT event_id, user_id, event_type, value FROM events")
def scan_raw_json(spark, sf):
    return _landed_json(spark, I.table(spark, sf, "events").select("event_id", "user_id", "event_type", "value"), "raw-events")


@query("scan_json_array", "SELECT event_id, user_id, event_type, value FROM events")
def scan_json_array(spark, sf):
    """Files of one array each, of up to 2,000 records; a file of any size is read by as many tasks as it has splits."""
    path = fresh_path(spark, "arrays")
    events = I.table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    one = F.to_json(F.struct("event_id", "user_id", F.concat(F.col("event_type"), F.lit('"}, {"\\')).alias("event_type"), "value"))
    files = events.groupBy(F.floor(F.col("event_id") / 2000).alias("file")).agg(F.array_join(F.collect_list(one), ", ").alias("records"))
    files.select("file", F.concat(F.lit("[ "), F.col("records"), F.lit("]")).alias("value")).write.partitionBy("file").text(path)
    read = arrays.read_array(spark, path, events.schema)
    return read.withColumn("event_type", F.expr("left(event_type, length(event_type) - 7)"))


@query("scan_status_lookup", "SELECT CAST(s_suppkey AS VARCHAR) AS code, s_name AS description FROM supplier")
def scan_status_lookup(spark, sf):
    path = fresh_path(spark, "lookup")
    entry = F.to_json(F.create_map(F.col("s_suppkey").cast("string"), F.col("s_name")))
    I.table(spark, sf, "supplier").select(entry.alias("value")).write.text(path)
    return landed.read_lookup(spark, path, "code", "description", one_object=False)


@query("scan_parquet", "SELECT l_orderkey, l_partkey, l_extendedprice FROM lineitem")
def scan_parquet(spark, sf):
    return I.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")


@query("latest_slice", I.with_sql("invoices", "SELECT boleto, value, emission FROM invoices WHERE emission = (SELECT max(emission) FROM invoices)"))
def latest_slice(spark, sf):
    return landed.latest_slice(I.invoices(spark, sf).select("boleto", "value", "emission"), "emission")


@query("scan_dim_versions", I.with_sql("history", "SELECT part, sk, valido_de, valido_ate FROM history"))
def scan_dim_versions(spark, sf):
    return dimension_versions(I.history(spark, sf), "part", "sk")


@query("scan_with_predicate", I.with_sql("invoices stored", "SELECT boleto, items, value FROM stored WHERE items IS NOT NULL AND items <> ''"))
def scan_with_predicate(spark, sf):
    return stored_items(I.stored(spark, sf), "boleto", "items", "value")


_PAGES = I.with_sql("paged", "SELECT slice, page, position, id, user_id, value FROM paged")


def _flatten(spark, sf, bodies):
    records = pages.flatten_pages(I.paged(spark, sf, bodies), I.PAGE_RECORD, "items")
    return records.withColumn("position", F.col("position").cast("bigint"))


@query("pages_by_offset", _PAGES)
def pages_by_offset(spark, sf):
    return _flatten(spark, sf, "object")


@query("pages_by_number", _PAGES)
def pages_by_number(spark, sf):
    return _flatten(spark, sf, "list")


@query("pages_invoices", _PAGES)
def pages_invoices(spark, sf):
    return _flatten(spark, sf, "mixed")


@query("page_total_check", I.with_sql("paged", """
SELECT d.slice, total AS declared, count(*) AS received, count(*) >= total AS complete
FROM declared d JOIN paged r ON r.slice = d.slice GROUP BY d.slice, total"""))
def page_total_check(spark, sf):
    return pages.total_shortfall(I.paged(spark, sf, "object"), I.PAGE_RECORD, "items", "total")


@query("pages_behind_stop", I.with_sql("paged", """
SELECT c.slice, last_page, count(*) AS pages_behind, CAST(sum(n) AS BIGINT) AS records_behind
FROM counted c JOIN (SELECT c.slice, min(page) AS last_page FROM counted c JOIN declared d ON d.slice = c.slice
                     WHERE n < 120 OR seen >= total GROUP BY c.slice) s ON s.slice = c.slice AND page > last_page
GROUP BY c.slice, last_page"""))
def pages_behind_stop(spark, sf):
    return pages.pages_behind_stop(I.paged(spark, sf, "object"), I.PAGE_RECORD, "items", 120, "total")


@query("reference_list", "SELECT p_partkey, p_name, p_retailprice FROM part")
def reference_list(spark, sf):
    return _landed_json(spark, I.table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice"), "raw-parts")


@query("stamp_slice", "SELECT c_custkey, c_name, '7' AS c_mktsegment FROM customer")
def stamp_slice(spark, sf):
    return landed.stamp_slice(I.table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"), "c_mktsegment", "7")


@query("union_slices", I.with_sql("invoices", """
SELECT boleto, value, status AS slice, CASE status WHEN 'P' THEN 0 WHEN 'F' THEN 1 ELSE 2 END AS slice_rank FROM invoices"""))
def union_slices(spark, sf):
    invoices = I.invoices(spark, sf)
    slices = {code: invoices.filter(F.col("status") == code).select("boleto", "value") for code in ("P", "F", "O")}
    return landed.union_slices(slices, "slice", "slice_rank")


WINDOW_SQL = """
windows AS (
  SELECT boleto, status, value, 'NEW' AS "window", 0 AS window_rank FROM invoices WHERE emission BETWEEN DATE '2001-07-26' AND DATE '2001-08-01'
  UNION ALL SELECT boleto, status, value, 'PAID', 1 FROM invoices WHERE paid_on BETWEEN DATE '2001-07-03' AND DATE '2001-08-02'
  UNION ALL SELECT boleto, status, value, 'DUE', 2 FROM invoices WHERE due BETWEEN DATE '2001-07-03' AND DATE '2001-09-01')"""


def _windows(spark, sf):
    hits = windows.incremental_windows(I.invoices(spark, sf), I.REF, "emission", "paid_on", "due")
    return hits.select("boleto", "status", "value", "window", "window_rank")


@query("incremental_windows", f"WITH {I.CTES['invoices']}, {WINDOW_SQL} SELECT * FROM windows")
def incremental_windows(spark, sf):
    return _windows(spark, sf)


@query("merge_last_wins", f"""WITH {I.CTES['invoices']}, {WINDOW_SQL}
SELECT boleto, status, value, CASE max(window_rank) WHEN 0 THEN 'NEW' WHEN 1 THEN 'PAID' ELSE 'DUE' END AS "window",
       max(window_rank) AS window_rank FROM windows GROUP BY boleto, status, value""")
def merge_last_wins(spark, sf):
    return windows.merge_windows(_windows(spark, sf), "boleto", ["status"])


@query("month_ranges", I.with_sql("invoices", """
SELECT CAST(m AS DATE) AS first_day, last_day(CAST(m AS DATE)) AS last_day
FROM (SELECT unnest(generate_series(date_trunc('month', min(emission)), max(emission), INTERVAL 1 MONTH)) AS m FROM invoices)"""))
def month_ranges(spark, sf):
    span = I.invoices(spark, sf).agg(F.min("emission").alias("first"), F.max("emission").alias("last"))
    months = span.select(F.explode(calendar.months_between(F.col("first"), F.col("last"))).alias("first_day"))
    return months.select("first_day", F.last_day("first_day").alias("last_day"))


@query("open_invoices", "SELECT o_orderkey, 2 AS codigo_situacao FROM orders WHERE o_orderstatus = 'O'")
def open_invoices(spark, sf):
    code = F.when(F.col("o_orderstatus") == "O", 2).otherwise(1)
    return landed.open_invoices(I.table(spark, sf, "orders").select("o_orderkey", code.alias("codigo_situacao")))


@query("write_raw_json", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def write_raw_json(spark, sf):
    return _landed_json(spark, I.table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal"), "raw-customers")


@query("write_parquet", I.with_sql("invoices", "SELECT boleto, value, CAST(date_trunc('year', emission) AS DATE) AS dt FROM invoices"))
def write_parquet(spark, sf):
    path = fresh_path(spark, "dated")
    year = F.trunc("emission", "year").alias("dt")
    landed.write_dated(I.invoices(spark, sf).select("boleto", "value", year), path, "dt")
    return spark.read.schema("boleto bigint, value double, dt date").parquet(path)


@query("top1_by_name", I.with_sql("invoices", "SELECT max(CAST(emission AS VARCHAR)) AS newest FROM invoices"))
def top1_by_name(spark, sf):
    return I.invoices(spark, sf).agg(F.max(F.col("emission").cast("string")).alias("newest"))


@query("preview", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def preview(spark, sf):
    return I.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice").orderBy("o_orderkey").limit(5)
