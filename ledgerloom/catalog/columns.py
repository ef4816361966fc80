"""Queries for projections, scalar rules, dedupe and allocation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.catalog import inputs as I
from ledgerloom.catalog.registry import query
from ledgerloom.functions import billing, calendar, cleaning
from ledgerloom.operators import allocation, dedupe, shaping
from ledgerloom.operators.skew import hot_keys
from ledgerloom.plans import entities as E

SUPPLIER = "SELECT s_suppkey, s_name, s_acctbal FROM supplier"


@query("rename_columns", SUPPLIER)
def rename_columns(spark, sf):
    messy = I.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias(" S_SuppKey "), F.col("s_name").alias("S_NAME"), F.col("s_acctbal").alias("s_acctbal ")
    )
    return shaping.normalise_names(messy)


@query("rename_map", "SELECT s_suppkey AS code, s_name AS description, s_acctbal FROM supplier")
def rename_map(spark, sf):
    supplier = I.table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return shaping.rename(supplier, {"s_suppkey": "code", "s_name": "description", "absent": "x"})


@query("drop_columns", SUPPLIER)
def drop_columns(spark, sf):
    return shaping.drop(I.table(spark, sf, "supplier"), ["s_nationkey", "absent"])


_SPARSE = (
    "WITH " + I.CTES["invoices"] + """, sparse AS (
  SELECT paid_flag, CASE WHEN status <> 'P' THEN paid_value END AS paid_value,
         CASE WHEN priority = '1-URGENT' THEN boleto END AS boleto FROM invoices) SELECT * FROM sparse WHERE {}"""
)


def _sparse(spark, sf):
    return I.invoices(spark, sf).select(
        "paid_flag",
        F.when(F.col("status") != "P", F.col("paid_value")).alias("paid_value"),
        F.when(F.col("priority") == "1-URGENT", F.col("boleto")).alias("boleto"),
    )


@query("remove_empty_rows", _SPARSE.format("paid_flag IS NOT NULL OR paid_value IS NOT NULL OR boleto IS NOT NULL"))
def remove_empty_rows(spark, sf):
    return shaping.drop_empty_rows(_sparse(spark, sf))


@query("drop_null_subset", _SPARSE.format("paid_value IS NOT NULL AND boleto IS NOT NULL"))
def drop_null_subset(spark, sf):
    return shaping.drop_null_rows(_sparse(spark, sf), ["paid_value", "boleto"])


@query("conditional_null", I.with_sql("invoices", "SELECT boleto, CASE WHEN paid_flag = 'y' THEN NULL ELSE value END AS value FROM invoices"))
def conditional_null(spark, sf):
    return I.invoices(spark, sf).select(
        "boleto", shaping.null_where(F.col("value"), F.col("paid_flag") == "y").alias("value")
    )


@query("filter_current", I.with_sql("dim", "SELECT part, owner, valido_de FROM dim WHERE vigente"))
def filter_current(spark, sf):
    return shaping.current_versions(I.dim(spark, sf)).select("part", "owner", "valido_de")


@query("is_distinct_from", I.with_sql("invoices", """
SELECT boleto, paid_value IS DISTINCT FROM value OR paid_flag IS DISTINCT FROM 'y' AS differs FROM invoices"""))
def is_distinct_from(spark, sf):
    pairs = [(F.col("paid_value"), F.col("value")), (F.col("paid_flag"), F.lit("y"))]
    return I.invoices(spark, sf).select("boleto", shaping.any_distinct(pairs).alias("differs"))


@query("add_constant", "SELECT o_orderkey, DATE '2001-08-02' AS dt_referencia FROM orders")
def add_constant(spark, sf):
    return I.table(spark, sf, "orders").select("o_orderkey", F.lit(I.REF).alias("dt_referencia"))


@query("project_alias", "SELECT l_orderkey AS codigo_boleto, l_extendedprice / l_quantity AS valor_unitario FROM lineitem")
def project_alias(spark, sf):
    return I.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("codigo_boleto"),
        billing.share(F.col("l_extendedprice"), F.col("l_quantity")).alias("valor_unitario"),
    )


_MESSY_TEXT = "concat(chr(9), '  ', upper(c_name), ' ', c_mktsegment, chr(10))"


@query("cast_string", f"""
SELECT c_custkey, lower(regexp_replace(CASE WHEN c_acctbal >= 0 THEN {_MESSY_TEXT} END, '^\\s+|\\s+$', '', 'g')) AS text,
       CAST(c_nationkey AS VARCHAR) AS code FROM customer""")
def cast_string(spark, sf):
    messy = F.when(F.col("c_acctbal") >= 0, F.expr(_MESSY_TEXT))
    return I.table(spark, sf, "customer").select(
        "c_custkey", cleaning.clean_text(messy).alias("text"), cleaning.clean_text(F.col("c_nationkey")).alias("code")
    )


# Day texts of all kinds, by priority: plain, with time, with offset across midnight, unreadable, a bare year.
_DAY_TEXT = """CASE o_orderpriority WHEN '1-URGENT' THEN CAST(CAST(o_orderdate AS DATE) AS STRING)
  WHEN '2-HIGH' THEN concat(CAST(CAST(o_orderdate AS DATE) AS STRING), ' 23:30:00')
  WHEN '3-MEDIUM' THEN concat(CAST(CAST(o_orderdate AS DATE) AS STRING), 'T23:30:00-03:00')
  WHEN '5-LOW' THEN '0000-00-00' ELSE substr(CAST(o_orderdate AS STRING), 1, 4) END"""


@query("cast_date", """
SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN CAST(o_orderdate AS DATE)
  WHEN o_orderpriority = '3-MEDIUM' THEN CAST(o_orderdate AS DATE) + 1 END AS day FROM orders""")
def cast_date(spark, sf):
    return I.table(spark, sf, "orders").select("o_orderkey", cleaning.clean_date(F.expr(_DAY_TEXT)).alias("day"))


_NUMBER_TEXT = """CASE o_orderpriority WHEN '1-URGENT' THEN concat(' ', CAST(o_orderkey AS STRING), '.5 ') WHEN '2-HIGH' THEN 'abc'
  WHEN '3-MEDIUM' THEN concat(CAST(o_orderkey AS STRING), ',5') WHEN '5-LOW' THEN concat(CAST(o_orderkey AS STRING), 'd')
  ELSE CAST(o_orderkey AS STRING) END"""


@query("cast_numeric", """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN o_orderkey + 0.5 WHEN '4-NOT SPECIFIED' THEN CAST(o_orderkey AS DOUBLE) END AS number,
       CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN o_orderkey WHEN o_orderpriority = '1-URGENT' THEN o_orderkey + o_orderkey % 2 END AS whole
FROM orders""")
def cast_numeric(spark, sf):
    text = F.expr(_NUMBER_TEXT)
    return I.table(spark, sf, "orders").select(
        "o_orderkey", cleaning.clean_number(text).alias("number"), cleaning.clean_number(text, "bigint").alias("whole")
    )


@query("flatten_single", I.with_sql("invoices listed", "SELECT boleto, items[1] AS item FROM listed"))
def flatten_single(spark, sf):
    return I.listed(spark, sf).select("boleto", cleaning.first_of_list(F.col("items")).alias("item"))


@query("join_list", I.with_sql("invoices listed", """
SELECT boleto, CASE WHEN items IS NULL THEN NULL WHEN len(items) = 0 THEN ''
  ELSE array_to_string(list_transform(items, lambda x: COALESCE(CAST(x AS VARCHAR), 'None')), ',') END AS items FROM listed"""))
def join_list(spark, sf):
    return I.listed(spark, sf).select("boleto", cleaning.join_list(F.col("items")).alias("items"))


@query("extract_struct_field", I.with_sql("invoices listed", """
SELECT boleto, CASE WHEN items IS NULL THEN NULL WHEN len(items) = 0 THEN ''
  ELSE array_to_string(list_transform(items, lambda x: COALESCE(CAST(x AS VARCHAR), 'None')), ',') END AS codes FROM listed"""))
def extract_struct_field(spark, sf):
    structs = F.transform("items", lambda x: F.struct(x.alias("code"), (x * 2).alias("other")))
    return I.listed(spark, sf).select("boleto", cleaning.join_list(cleaning.field_of_each(structs, "code")).alias("codes"))


@query("split_text", I.with_sql("invoices stored", """
SELECT boleto, position, part FROM (SELECT boleto, unnest(string_split(items, ',')) AS part,
  unnest(range(len(string_split(items, ',')))) AS position FROM stored WHERE items IS NOT NULL)"""))
def split_text(spark, sf):
    parts = F.posexplode(cleaning.split_list(F.col("items"))).alias("position", "part")
    return I.stored(spark, sf).select("boleto", parts).withColumn("position", F.col("position").cast("bigint"))


@query("explode_list", I.with_sql("invoices listed", "SELECT boleto, item FROM (SELECT boleto, unnest(items) AS item FROM listed) WHERE item IS NOT NULL"))
def explode_list(spark, sf):
    return I.listed(spark, sf).select("boleto", F.explode("items").alias("item")).filter("item is not null")


@query("to_boolean", """
SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderstatus = 'F' END AS flag FROM orders""")
def to_boolean(spark, sf):
    word = F.when(F.col("o_orderstatus") == "F", " SIM").when(F.col("o_orderstatus") == "O", "NÃO").otherwise("")
    word = F.when(F.col("o_orderpriority") != "5-LOW", word)
    return I.table(spark, sf, "orders").select("o_orderkey", cleaning.to_flag(word, E.YES_WORDS).alias("flag"))


DAYS_SQL = "CASE WHEN status <> 'P' THEN GREATEST(DATE '2001-08-02' - due, 0) END"


def _days(reference=I.REF):
    return billing.days_overdue(F.when(F.col("status") != "P", F.col("due")), reference)


@query("days_overdue", I.with_sql("invoices", f"SELECT boleto, {DAYS_SQL} AS days FROM invoices"))
def days_overdue(spark, sf):
    return I.invoices(spark, sf).select("boleto", _days().alias("days"))


BUCKET_SQL = "CASE WHEN {0} IS NULL THEN NULL WHEN {0} <= 30 THEN '0-30' WHEN {0} <= 60 THEN '31-60' WHEN {0} <= 90 THEN '61-90' ELSE '90+' END"


@query("aging_bucket", I.with_sql("invoices", f"SELECT boleto, {BUCKET_SQL.format('days')} AS bucket FROM (SELECT boleto, {DAYS_SQL} AS days FROM invoices)"))
def aging_bucket(spark, sf):
    return I.invoices(spark, sf).select("boleto", billing.aging_bucket(_days()).alias("bucket"))


STATUS_SQL = """CASE WHEN {flag} IS DISTINCT FROM 'y' THEN 'nao_pago' WHEN abs({paid} - {billed}) < 0.01 THEN 'pago_integral'
  WHEN {paid} - {billed} < 0 THEN 'pago_a_menor' ELSE 'pago_a_maior' END"""


@query("payment_status", I.with_sql("invoices", f"SELECT boleto, {STATUS_SQL.format(flag='paid_flag', paid='paid_value', billed='value')} AS status_pagamento FROM invoices"))
def payment_status(spark, sf):
    status = billing.payment_status(F.col("paid_flag"), F.col("value"), F.col("paid_value"))
    return I.invoices(spark, sf).select("boleto", status.alias("status_pagamento"))


@query("payment_difference", I.with_sql("invoices", "SELECT boleto, paid_value - value AS difference FROM invoices"))
def payment_difference(spark, sf):
    return I.invoices(spark, sf).select("boleto", billing.payment_difference(F.col("value"), F.col("paid_value")).alias("difference"))


@query("age_years", """
SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN year(DATE '2001-08-02') - year(birth)
  - CASE WHEN strftime(DATE '2001-08-02', '%m%d') < strftime(birth, '%m%d') THEN 1 ELSE 0 END END AS age
FROM (SELECT *, DATE '1950-01-01' + CAST((c_custkey * 37) % 20000 AS INT) AS birth FROM customer)""")
def age_years(spark, sf):
    birth = F.expr("DATE '1950-01-01' + CAST((c_custkey * 37) % 20000 AS INT)")
    birth = F.when(F.col("c_acctbal") >= 0, birth)
    return I.table(spark, sf, "customer").select("c_custkey", billing.age_years(birth, I.REF).alias("age"))


@query("allocated_value", I.with_sql("invoices listed", "SELECT boleto, CASE WHEN len(items) > 0 THEN value / len(items) END AS share FROM listed"))
def allocated_value(spark, sf):
    parts = F.when(F.col("items").isNotNull(), F.size("items"))
    return I.listed(spark, sf).select("boleto", billing.share(F.col("value"), parts).alias("share"))


@query("tolerance_compare", I.with_sql("invoices", "SELECT boleto, abs(paid_value - value) < 0.01 AS same FROM invoices"))
def tolerance_compare(spark, sf):
    return I.invoices(spark, sf).select("boleto", billing.same_amount(F.col("paid_value"), F.col("value")).alias("same"))


@query("null_coalesce", I.with_sql("invoices", "SELECT boleto, COALESCE(paid_on, DATE '1900-01-01') AS day FROM invoices"))
def null_coalesce(spark, sf):
    return I.invoices(spark, sf).select("boleto", calendar.or_epoch(F.col("paid_on")).alias("day"))


@query("date_format", I.with_sql("invoices", "SELECT boleto, strftime(due, '%d/%m/%Y') AS due FROM invoices"))
def date_format(spark, sf):
    return I.invoices(spark, sf).select("boleto", calendar.render_day(F.col("due")).alias("due"))


@query("date_shift", I.with_sql("invoices", "SELECT boleto, emission - 7 AS before, emission + 30 AS after FROM invoices"))
def date_shift(spark, sf):
    day = F.col("emission")
    return I.invoices(spark, sf).select(
        "boleto", calendar.shift_days(day, -7).alias("before"), calendar.shift_days(day, 30).alias("after")
    )


# São Paulo kept UTC-3 all year in 2024.
@query("utc_to_local", """
SELECT event_id, strftime(ts - INTERVAL 3 HOUR, '%d/%m/%Y') AS day, strftime(ts - INTERVAL 3 HOUR, '%H:%M:%S') AS time FROM events""")
def utc_to_local(spark, sf):
    day, time = calendar.local_day_and_time(F.col("ts").cast("timestamp"))
    return I.table(spark, sf, "events").select("event_id", day.alias("day"), time.alias("time"))


@query("hours_since", """
SELECT event_id, round((epoch_us(TIMESTAMP '2024-03-01 00:00:00') - epoch_us(ts)) / 3.6e9, 6) AS hours FROM events""")
def hours_since(spark, sf):
    now = F.lit("2024-03-01 00:00:00").cast("timestamp")
    return I.table(spark, sf, "events").select("event_id", F.round(calendar.hours_since(F.col("ts"), now), 6).alias("hours"))


@query("json_parse", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k FROM events")
def json_parse(spark, sf):
    return I.table(spark, sf, "events").select("event_id", F.try_element_at(cleaning.parse_map(F.col("props")), F.lit("k")).alias("k"))


@query("dedupe_keep_first", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
  ORDER BY l_linenumber, l_partkey, l_suppkey) AS place FROM lineitem) WHERE place = 1""")
def dedupe_keep_first(spark, sf):
    lines = I.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    return dedupe.keep_first(lines, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"])


@query("dedupe_keep_last", """
SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place
  FROM events) WHERE place = 1""")
def dedupe_keep_last(spark, sf):
    events = I.table(spark, sf, "events").select("user_id", "event_id", "event_type", "ts")
    return dedupe.keep_last(events, ["user_id"], ["ts", "event_id"]).drop("ts")


@query("dedupe_composite", "SELECT l_orderkey, l_partkey, min(l_linenumber) AS l_linenumber FROM lineitem GROUP BY 1, 2")
def dedupe_composite(spark, sf):
    lines = I.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    return dedupe.keep_first(lines, ["l_orderkey", "l_partkey"], ["l_linenumber"])


@query("partition_count", "SELECT l_orderkey, l_partkey, l_linenumber, count(l_partkey) OVER (PARTITION BY l_orderkey) AS n FROM lineitem")
def partition_count(spark, sf):
    lines = I.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    return dedupe.with_group_count(lines, ["l_orderkey"], "l_partkey", "n")


NAMES = {"item_as": "item", "count_as": "n", "share_as": "share"}


def bridge(spark, sf):
    items, invoices = I.billed_items(spark, sf), I.invoices(spark, sf)
    hot = hot_keys(items, "boleto")
    return allocation.allocate_items(items, invoices, "boleto", "item", "value", **NAMES, hot=hot)


@query("allocate_value", I.with_sql("billed bridge", "SELECT * FROM bridge"))
def allocate_value(spark, sf):
    return bridge(spark, sf)


@query("allocate_listed", I.with_sql("invoices listed", """
SELECT boleto, item, count(*) OVER (PARTITION BY boleto) AS n, value / count(*) OVER (PARTITION BY boleto) AS share
FROM (SELECT DISTINCT boleto, value, unnest(items) AS item FROM listed) WHERE item IS NOT NULL"""))
def allocate_listed(spark, sf):
    return allocation.allocate_unique(I.listed(spark, sf), "boleto", "items", "value", **NAMES)


# Finished invoices come in a second record, with other items and another value: the first value of an item counts.
@query("allocate_repeated", I.with_sql("invoices listed", """
SELECT boleto, item, count(*) OVER (PARTITION BY boleto) AS n, value / count(*) OVER (PARTITION BY boleto) AS share
FROM (SELECT boleto, item, arg_min(value, copy) AS value FROM (
  SELECT boleto, 0 AS copy, value, unnest(items) AS item FROM listed
  UNION ALL SELECT boleto, 1, value * 2, unnest(items) + 1 FROM listed WHERE status = 'F') WHERE item IS NOT NULL GROUP BY 1, 2)"""))
def allocate_repeated(spark, sf):
    first = I.listed(spark, sf).select("boleto", "value", "items", "status", F.lit(0).alias("copy"))
    second = first.filter("status = 'F'").withColumns(
        {"items": F.transform("items", lambda item: item + 1), "value": F.col("value") * 2, "copy": F.lit(1)}
    )
    return allocation.allocate(first.unionByName(second), "boleto", "items", "value", ["copy"], **NAMES)


@query("bridge_backfill", I.with_sql("invoices stored", """
SELECT boleto, codigo_veiculo, count(*) OVER (PARTITION BY boleto) AS qtd_veiculos_boleto,
       value / count(*) OVER (PARTITION BY boleto) AS valor_rateado
FROM (SELECT DISTINCT boleto, value, unnest(string_split(items, ',')) AS codigo_veiculo FROM stored WHERE items IS NOT NULL AND items <> '')"""))
def bridge_backfill(spark, sf):
    return allocation.allocate_from_text(I.stored(spark, sf), "boleto", "items", "value")
