"""Queries for table maintenance, checks, entity transforms and whole loads."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from ledgerloom.catalog import inputs as I
from ledgerloom.catalog.columns import BUCKET_SQL, STATUS_SQL, bridge
from ledgerloom.catalog.registry import query
from ledgerloom.operators import checks, scd2, upsert
from ledgerloom.operators.running import number_dense, number_new_keys
from ledgerloom.operators.temporal import interval_faults
from ledgerloom.plans import entities as E, jobs, transforms as T
from ledgerloom.plans.jobs import Run
from ledgerloom.session import fresh_path, settle
from ledgerloom.sources import landed

ORDER = ["__seq"]
FIRST, NEXT = datetime(2001, 8, 1, 3, 0, 0), I.NOW

# --- table maintenance -------------------------------------------------------------------------


@query("create_table_first_load", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def create_table_first_load(spark, sf):
    warehouse = I.new_warehouse(spark, "first-load")
    warehouse.upsert("supplier", I.table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal"), ["s_suppkey"])
    return warehouse.read("supplier")


# Target: invoices up to 1999. Batch: invoices from 1999 on, with paid values, of which some are null.
UPSERT_SQL = """
target AS (SELECT boleto, value AS paid, priority AS note, TIMESTAMP '2001-08-01 03:00:00' AS criado_em FROM invoices WHERE emission < DATE '2000-01-01'),
fresh AS (SELECT boleto, paid_value AS paid, status AS mark, TIMESTAMP '2001-08-02 03:00:00' AS criado_em FROM invoices WHERE emission >= DATE '1999-01-01')"""
UPSERT_SELECT = """
SELECT COALESCE(t.boleto, f.boleto) AS boleto, CASE WHEN f.boleto IS NOT NULL THEN f.paid ELSE t.paid END AS paid, t.note,
       strftime({stamp}, '%Y-%m-%d %H:%M:%S') AS criado_em, f.mark
FROM target t FULL JOIN fresh f ON f.boleto = t.boleto"""


def _target_and_batch(spark, sf):
    all_of_them = I.invoices(spark, sf)
    target = all_of_them.filter(F.col("emission") < F.lit(date(2000, 1, 1))).select(
        "boleto", F.col("value").alias("paid"), F.col("priority").alias("note"), F.lit(FIRST).alias("criado_em")
    )
    fresh = all_of_them.filter(F.col("emission") >= F.lit(date(1999, 1, 1))).select(
        "boleto", F.col("paid_value").alias("paid"), F.col("status").alias("mark"), F.lit(NEXT).alias("criado_em")
    )
    return target, fresh


def _shown(state):
    return state.withColumn("criado_em", I.stamp_text("criado_em"))


@query("upsert_single_key", f"WITH {I.CTES['invoices']}, {UPSERT_SQL} " + UPSERT_SELECT.format(stamp="CASE WHEN f.boleto IS NOT NULL THEN f.criado_em ELSE t.criado_em END"))
def upsert_single_key(spark, sf):
    return _shown(upsert.upsert(*_target_and_batch(spark, sf), ["boleto"]))


@query("upsert_immutable", f"WITH {I.CTES['invoices']}, {UPSERT_SQL} " + UPSERT_SELECT.format(stamp="COALESCE(t.criado_em, f.criado_em)"))
def upsert_immutable(spark, sf):
    return _shown(upsert.upsert(*_target_and_batch(spark, sf), ["boleto"], ["criado_em"]))


LINE_STATE = "(SELECT l_orderkey AS boleto, l_partkey AS item, sum(l_quantity) AS quantity FROM lineitem WHERE {} GROUP BY 1, 2)"
OLD_LINES, NEW_LINES = "CAST(l_shipdate AS DATE) < DATE '1999-01-01'", "CAST(l_shipdate AS DATE) >= DATE '1998-01-01'"


def _line_states(spark, sf):
    states = []
    for condition in (OLD_LINES, NEW_LINES):
        lines = I.table(spark, sf, "lineitem").filter(condition)
        keys = [F.col("l_orderkey").alias("boleto"), F.col("l_partkey").alias("item")]
        states.append(lines.groupBy(*keys).agg(F.sum("l_quantity").alias("quantity")))
    return states


@query("upsert_composite_key", f"""
SELECT COALESCE(t.boleto, f.boleto) AS boleto, COALESCE(t.item, f.item) AS item, COALESCE(f.quantity, t.quantity) AS quantity
FROM {LINE_STATE.format(OLD_LINES)} t FULL JOIN {LINE_STATE.format(NEW_LINES)} f ON f.boleto = t.boleto AND f.item = t.item""")
def upsert_composite_key(spark, sf):
    warehouse = I.new_warehouse(spark, "composite")
    for state in _line_states(spark, sf):
        warehouse.upsert_ranges("lines", state, ["boleto", "item"])
    return warehouse.read("lines")


@query("scd2_apply", I.with_sql("dim batch plan", I.SCD2_SQL))
def scd2_apply(spark, sf):
    dim, batch = settle(I.dim(spark, sf), "dim"), settle(I.batch(spark, sf), "batch")
    state = scd2.apply_batch(dim, batch, "part", I.MONITORED, I.SPLIT, "sk", I.NOW)
    return state.select("part", "owner", "mark", "price", "quantity", "valido_de", "valido_ate", "vigente")


@query("scd2_slices", I.with_sql("dim batch plan", I.SCD2_SQL))
def scd2_slices(spark, sf):
    """As ``scd2_apply`` over a stored dimension, of which only the open slice and that of the day are rewritten."""
    warehouse = I.new_warehouse(spark, "slices")
    warehouse.replace_slices("dim", settle(scd2.with_slice(I.dim(spark, sf)), "dim"), scd2.SLICE, ["sk"])
    batch = settle(I.batch(spark, sf), "batch")
    jobs.apply_versions(warehouse, "dim", batch, "part", "sk", I.MONITORED, Run(I.SPLIT, I.NOW))
    return warehouse.read("dim").select("part", "owner", "mark", "price", "quantity", "valido_de", "valido_ate", "vigente")


@query("materialized_changed_set", I.with_sql("dim batch plan", """
SELECT p.part, count(d.part) AS closed FROM plan p JOIN dim d ON d.part = p.part AND d.vigente WHERE p.changed GROUP BY p.part"""))
def materialized_changed_set(spark, sf):
    dim, batch = I.dim(spark, sf), I.batch(spark, sf)
    changed = scd2.changed_keys(dim, batch, "part", I.MONITORED)
    closed = scd2.close_versions(dim, changed, "part", I.SPLIT, I.NOW).filter(F.col("valido_ate") == F.lit(I.SPLIT))
    return closed.groupBy("part").agg(F.count("*").alias("closed"))


@query("surrogate_key", "SELECT o_orderkey, 1000 + row_number() OVER (ORDER BY o_orderkey) AS sk FROM orders")
def surrogate_key(spark, sf):
    return number_dense(I.table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], "sk", F.lit(1000).cast("bigint"))


@query("surrogate_key_spread", "SELECT count(*) AS keys, count(DISTINCT o_orderkey) AS distinct_keys, true AS above_highest FROM orders")
def surrogate_key_spread(spark, sf):
    orders = I.table(spark, sf, "orders").select("o_orderkey")
    numbered = number_new_keys(orders, "o_orderkey", "sk", F.lit(1000).cast("bigint"))
    return numbered.agg(
        F.count("*").alias("keys"), F.countDistinct("sk").alias("distinct_keys"), (F.min("sk") > 1000).alias("above_highest")
    )


@query("snapshot_replace", I.with_sql("invoices", """
SELECT boleto, CASE WHEN emission >= DATE '2000-01-01' THEN paid_value ELSE value END AS value, CAST(date_trunc('year', emission) AS DATE) AS dt_referencia
FROM invoices WHERE NOT (emission >= DATE '2000-01-01' AND status = 'O')"""))
def snapshot_replace(spark, sf):
    warehouse = I.new_warehouse(spark, "snapshot")
    day = F.trunc("emission", "year").alias("dt_referencia")
    before = I.invoices(spark, sf).select("boleto", "value", day)
    again = I.invoices(spark, sf).filter("emission >= DATE '2000-01-01' and status <> 'O' or status is null")
    again = again.select("boleto", F.col("paid_value").alias("value"), day)
    for slices in (before, again):
        warehouse.replace_slices("snapshot", slices, "dt_referencia", ["boleto"])
    return warehouse.read("snapshot").select("boleto", "value", "dt_referencia")


@query("schema_sync", I.with_sql("invoices", """
SELECT boleto, value, CASE WHEN emission >= DATE '2000-01-01' THEN priority END AS priority FROM invoices"""))
def schema_sync(spark, sf):
    warehouse = I.new_warehouse(spark, "schema")
    all_of_them = I.invoices(spark, sf)
    warehouse.upsert_ranges("invoices", all_of_them.select("boleto", "value"), ["boleto"])
    late = all_of_them.filter("emission >= DATE '2000-01-01'").select("boleto", "value", "priority")
    warehouse.upsert_ranges("invoices", late, ["boleto"])
    return warehouse.read("invoices")


_TYPES = {"o_orderkey": "BIGINT", "o_custkey": "BIGINT", "o_orderstatus": "TEXT", "o_totalprice": "DOUBLE PRECISION", "o_orderdate": "TIMESTAMP", "o_orderpriority": "TEXT"}


@query("type_map", " UNION ALL ".join(f"SELECT '{c}' AS column_name, '{t}' AS column_type, count({c}) AS non_null FROM orders" for c, t in _TYPES.items()))
def type_map(spark, sf):
    return upsert.type_report(I.table(spark, sf, "orders"))


@query("audit_columns", """
SELECT o_orderkey, '2001-08-02 03:00:00' AS criado_em, '2001-08-02 03:00:00' AS atualizado_em, DATE '2001-08-02' AS data_referencia FROM orders""")
def audit_columns(spark, sf):
    stamped = upsert.audit_columns(I.table(spark, sf, "orders").select("o_orderkey"), I.NOW, I.REF)
    return stamped.select("o_orderkey", I.stamp_text("criado_em"), I.stamp_text("atualizado_em"), "data_referencia")


# --- counts and checks -------------------------------------------------------------------------


@query("row_count", I.with_sql("dim", "SELECT 'all' AS scope, count(*) AS row_count FROM dim UNION ALL SELECT 'current', count(*) FROM dim WHERE vigente"))
def row_count(spark, sf):
    dim = I.dim(spark, sf)
    every = checks.row_count(dim).select(F.lit("all").alias("scope"), "row_count")
    return every.unionByName(checks.row_count(dim, F.col("vigente")).select(F.lit("current").alias("scope"), "row_count"))


@query("max_write_time", """
SELECT 'events' AS table_name, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_write FROM events
UNION ALL SELECT 'orders', strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') FROM orders""")
def max_write_time(spark, sf):
    stamps = {"events": "ts", "orders": "o_orderdate"}
    frames = [
        I.table(spark, sf, name).agg(F.max(column).alias("last_write")).select(
            F.lit(name).alias("table_name"), I.stamp_text("last_write")
        )
        for name, column in stamps.items()
    ]
    return frames[0].unionByName(frames[1])


AGE_SQL = """
SELECT t AS table_name, round((epoch_us(TIMESTAMP '2024-02-01 12:00:00') - epoch_us(last)) / 3.6e9, 6) AS age_hours FROM (
  SELECT 'events' AS t, max(ts) AS last FROM events
  UNION ALL SELECT 'errors', max(ts) FROM events WHERE event_type = 'error' AND value > 1000000
  UNION ALL SELECT 'lines', max(l_shipdate) FROM lineitem UNION ALL SELECT 'orders', max(o_orderdate) FROM orders)"""


def _ages(spark, sf):
    events = I.table(spark, sf, "events")
    tables = {
        "events": (events, "ts"),
        "errors": (events.filter("event_type = 'error' and value > 1000000"), "ts"),
        "lines": (I.table(spark, sf, "lineitem"), "l_shipdate"),
        "orders": (I.table(spark, sf, "orders"), "o_orderdate"),
    }
    return checks.table_ages(tables, datetime(2024, 2, 1, 12)).withColumn("age_hours", F.round("age_hours", 6))


@query("freshness", f"SELECT *, age_hours IS NULL OR age_hours > 26 AS stale FROM ({AGE_SQL})")
def freshness(spark, sf):
    ages = _ages(spark, sf)
    old = checks.stale(ages).select(F.col("table_name").alias("t"))
    return ages.join(old, ages.table_name == old.t, "left").select(*ages.columns, F.col("t").isNotNull().alias("stale"))


@query("sorted_report", f"SELECT * FROM ({AGE_SQL}) WHERE age_hours IS NULL OR age_hours > 26 ORDER BY table_name")
def sorted_report(spark, sf):
    return checks.stale(_ages(spark, sf)).orderBy("table_name")


@query("allocation_check", I.with_sql("billed bridge", """
SELECT boleto, round(sum(share), 2) AS allocated FROM bridge GROUP BY boleto"""))
def allocation_check(spark, sf):
    return bridge(spark, sf).groupBy("boleto").agg(F.round(F.sum("share"), 2).alias("allocated"))


@query("allocation_faults", I.with_sql("billed bridge", """
SELECT b.boleto, round(sum(share), 2) AS allocated FROM bridge b JOIN orders ON o_orderkey = b.boleto
GROUP BY b.boleto, o_totalprice HAVING abs(sum(share) - o_totalprice * 0.9) >= 0.01"""))
def allocation_faults(spark, sf):
    """Invoices billed ten percent less than was allocated must all be found."""
    orders = I.table(spark, sf, "orders")
    billed = orders.select(F.col("o_orderkey").alias("boleto"), (F.col("o_totalprice") * 0.9).alias("billed"))
    faults = checks.allocation_faults(bridge(spark, sf), billed, "boleto", "share", "billed")
    return faults.select("boleto", F.round("allocated", 2).alias("allocated"))


@query("drop_guard", """
SELECT o_custkey, now_count, before_count, CASE WHEN before_count = 0 THEN false ELSE 1 - now_count / before_count > 0.3 END AS refused
FROM (SELECT o_custkey, count(*) FILTER (o_orderdate >= TIMESTAMP '1998-01-01') AS now_count,
             count(*) FILTER (o_orderdate < TIMESTAMP '1998-01-01') AS before_count FROM orders GROUP BY 1)""")
def drop_guard(spark, sf):
    late = F.to_date("o_orderdate") >= F.lit(date(1998, 1, 1))
    counts = I.table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count(F.when(late, 1)).alias("now_count"), F.count(F.when(~late, 1)).alias("before_count")
    )
    return counts.withColumn("refused", checks.abnormal_drop(F.col("now_count"), F.col("before_count")))


_CODES = """
known AS (SELECT DISTINCT l_suppkey AS code, 'S' || l_suppkey AS description FROM lineitem),
incoming AS (SELECT DISTINCT CASE WHEN l_suppkey % 9 = 0 THEN -l_suppkey ELSE l_suppkey END AS code, 'S' || l_suppkey AS description FROM lineitem)"""


def _codes(spark, sf):
    """All supplier codes, and the same with every ninth one renamed."""
    lines = I.table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("code"), F.expr("'S' || l_suppkey").alias("description")).distinct()
    return lines, lines.withColumn("code", F.expr("CASE WHEN code % 9 = 0 THEN -code ELSE code END"))


_DIFF = f"""WITH {_CODES}
SELECT CAST(COALESCE(k.code, i.code) AS VARCHAR) AS code, COALESCE(i.description, k.description) AS description,
       CASE WHEN k.code IS NULL THEN 'added' ELSE 'removed' END AS change
FROM known k FULL JOIN incoming i ON i.code = k.code WHERE k.code IS NULL OR i.code IS NULL"""


@query("coverage_diff", _DIFF)
def coverage_diff(spark, sf):
    return checks.coverage_diff(*_codes(spark, sf), "code", "description")


@query("added_removed", f"SELECT change, count(*) AS codes FROM ({_DIFF}) GROUP BY change")
def added_removed(spark, sf):
    diff = checks.coverage_diff(*_codes(spark, sf), "code", "description")
    return diff.groupBy("change").agg(F.count("*").alias("codes"))


@query("completeness_guard", """
SELECT user_id, 'error ' || max(event_id) AS error FROM events WHERE event_type = 'error' GROUP BY user_id""")
def completeness_guard(spark, sf):
    failed = F.max(F.when(F.col("event_type") == "error", F.col("event_id")))
    status = I.table(spark, sf, "events").groupBy("user_id").agg(failed.alias("failed"))
    return checks.failed_slices(status.select("user_id", F.expr("'error ' || failed").alias("error")), "user_id", "error")


@query("key_summary", """
SELECT CAST(sum(n) AS BIGINT) AS row_count, CAST(0 AS BIGINT) AS null_keys, max(n) AS most_frequent FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""")
def key_summary(spark, sf):
    return checks.key_summary(I.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("key_unique", "SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def key_unique(spark, sf):
    return checks.repeated_keys(I.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("fk_orphans", """
SELECT o_custkey, count(*) AS occurrences FROM orders WHERE o_custkey NOT IN (SELECT CASE WHEN c_acctbal < 0 THEN -c_custkey ELSE c_custkey END FROM customer) GROUP BY 1""")
def fk_orphans(spark, sf):
    known = I.table(spark, sf, "customer").select(F.expr("CASE WHEN c_acctbal < 0 THEN -c_custkey ELSE c_custkey END").alias("c_custkey"))
    return checks.orphans(I.table(spark, sf, "orders"), "o_custkey", known, "c_custkey")


# Each state lasts 60 days, whatever follows: neighbours overlap or leave gaps. The last one stays open.
@query("interval_health", "WITH " + I.CTES["history"] + """,
fixed AS (SELECT part, valido_de, CASE WHEN valido_ate IS NOT NULL THEN valido_de + 60 END AS valido_ate,
                 lead(valido_de) OVER (PARTITION BY part ORDER BY valido_de) AS next_start FROM history),
reach AS (SELECT *, max(COALESCE(valido_ate, DATE '9999-01-01')) OVER (PARTITION BY part ORDER BY valido_de) AS reached FROM fixed)
SELECT part, count(CASE WHEN next_start < reached THEN 1 END) > 0 AS overlapping, count(CASE WHEN next_start > reached THEN 1 END) AS gaps,
       CAST(0 AS BIGINT) AS inverted, CAST(CASE WHEN part % 7 = 0 THEN 0 ELSE 1 END AS BIGINT) AS current_versions
FROM reach GROUP BY part HAVING count(CASE WHEN next_start <> reached THEN 1 END) > 0 OR part % 7 = 0""")
def interval_health(spark, sf):
    last = F.col("valido_ate").isNull()
    fixed = I.history(spark, sf).select(
        "part", "valido_de", F.when(~last, F.date_add("valido_de", 60)).alias("valido_ate"),
        (last & (F.col("part") % 7 != 0)).alias("vigente"),
    )
    found = interval_faults(fixed, "part")
    return found.select("part", (F.col("overlaps") > 0).alias("overlapping"), "gaps", "inverted", "current_versions")


# --- entity transforms -------------------------------------------------------------------------


def _entity(name, base, entity, transform, extra=None, extra_sql=None, rest=""):
    """Register the transform of one entity over raw records made from one table."""
    columns = ", ".join([*entity.text, *entity.days, *entity.numbers])
    sql = "WITH " + I.clean_entity_sql(base, entity, extra) + f" SELECT {columns}{extra_sql or ''} FROM clean {rest}"
    query(name, sql)(lambda spark, sf: transform(spark, sf, I.raw_entity(spark, sf, base, entity, extra)))


_LOOKUP = "SELECT lower('COPY CODIGO_SITUACAO' || s_suppkey || '-' || copy) AS code, s_name AS description FROM supplier, (VALUES (0), (1)) v(copy)"


def _lookup(spark, sf):
    both = I.table(spark, sf, "supplier").select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("copy"))
    code = F.concat(F.lit("copy codigo_situacao"), F.col("s_suppkey"), F.lit("-"), F.col("copy"))
    return both.select(code.alias("codigo_situacao"), F.col("s_name").alias("descricao_situacao"))


_entity(
    "transform_customers", "customer", E.CUSTOMERS,
    lambda spark, sf, raw: T.transform_customers(raw, _lookup(spark, sf), I.REF, ORDER),
    extra_sql=""", description AS descricao_situacao, year(DATE '2001-08-02') - year(data_nascimento)
      - CASE WHEN strftime(DATE '2001-08-02', '%m%d') < strftime(data_nascimento, '%m%d') THEN 1 ELSE 0 END AS idade""",
    rest=f"LEFT JOIN ({_LOOKUP}) ON code = codigo_situacao",
)
_entity("transform_vehicles", "part", E.VEHICLES, lambda spark, sf, raw: T.transform_vehicles(raw, ORDER))
_entity(
    "transform_volunteers", "supplier", E.VOLUNTEERS,
    lambda spark, sf, raw: T.transform_volunteers(
        raw.withColumn("cooperativas", F.expr("array(named_struct('codigo_cooperativa', cooperativas), named_struct('codigo_cooperativa', '9'))")),
        ORDER,
    ),
    extra={"cooperativas": "CAST(s_nationkey AS STRING)"},
    extra_sql=", cooperativas || ',9' AS cooperativas",
)
_entity("transform_cooperatives", "supplier", E.COOPERATIVES, lambda spark, sf, raw: T.transform_cooperatives(raw, ORDER))
_entity("transform_regionals", "supplier", E.REGIONALS, lambda spark, sf, raw: T.transform_regionals(raw, ORDER))
_entity(
    "transform_statuses", "part", E.STATUSES, lambda spark, sf, raw: T.transform_statuses(raw, ORDER),
    extra={"situacao": "CASE p_type WHEN 'ECONOMY' THEN ' ATIVO ' WHEN 'SMALL' THEN 'INATIVO' END"},
    extra_sql=", CASE trim(situacao) WHEN 'ATIVO' THEN true WHEN 'INATIVO' THEN false END AS situacao_ativa",
)
_entity(
    "transform_invoice_statuses", "part", E.INVOICE_STATUSES,
    lambda spark, sf, raw: T.transform_invoice_statuses(raw, ORDER),
    extra={
        "considerado_inadimplencia": "CASE WHEN p_size < 20 THEN 'Y' WHEN p_size < 40 THEN 'N' END",
        "pago": "CASE WHEN p_type = 'ECONOMY' THEN 'Sim' ELSE 'NAO' END",
    },
    extra_sql=""", CASE considerado_inadimplencia WHEN 'Y' THEN true WHEN 'N' THEN false END AS considerado_inadimplencia,
       pago = 'Sim' AS pago""",
)

# Invoice records: the flag, the vehicles and the beneficiary need values of their own.
_INVOICE_RAW = {
    "pago": "CASE o_orderstatus WHEN 'F' THEN ' Y' WHEN 'O' THEN 'n ' END",
    "valor_pagamento": "CASE WHEN o_orderpriority = '3-MEDIUM' THEN CAST(o_totalprice AS STRING) ELSE CAST(CAST(round(o_totalprice) AS BIGINT) - 5 AS STRING) END",
    "data_vencimento": "CAST(CAST(o_orderdate AS DATE) + CAST(30 AS INT) AS STRING)",
}
_INVOICE_EXTRA = {**_INVOICE_RAW, "base_customer": "o_custkey", "base_status": "o_orderstatus"}


def _invoice_raw(spark, sf):
    raw = I.raw_entity(spark, sf, "orders", E.INVOICES, _INVOICE_EXTRA)
    customer, status = F.col("base_customer"), F.col("base_status")
    vehicles = F.when(status == "F", F.array(customer, customer + 1, customer)).when(status == "O", F.array(customer))
    vehicles = vehicles.otherwise(F.array().cast("array<bigint>")).cast("array<string>")
    owner = F.when(status == "F", F.array(F.lit("joao"))).otherwise(F.array().cast("array<string>"))
    return raw.withColumns({"veiculo": vehicles, "beneficiario": owner}).drop("base_customer", "base_status")


def _invoice_sql(body):
    """Clean invoices as SQL; the three special columns take their raw text from above."""
    columns = I._raw_columns("orders", E.INVOICES)
    sql = I.clean_entity_sql("orders", E.INVOICES, {"base_customer": "o_custkey", "base_status": "o_orderstatus"})
    for name, raw in _INVOICE_RAW.items():
        sql = sql.replace(f"{columns[name]} AS {name}", f"{raw} AS {name}")
    return f"WITH {sql} {body}"


_CLEAN_COLUMNS = ", ".join([*E.INVOICES.text, *E.INVOICES.days, *E.INVOICES.numbers])
_LISTS = """CASE base_status WHEN 'F' THEN concat(base_customer, ',', base_customer + 1, ',', base_customer) WHEN 'O' THEN CAST(base_customer AS VARCHAR) ELSE '' END AS veiculo,
  CASE base_status WHEN 'F' THEN 'joao' END AS beneficiario"""
_OVERDUE = "GREATEST(DATE '2001-08-02' - data_vencimento, 0)"


@query("transform_invoices", _invoice_sql(f"""SELECT *, {BUCKET_SQL.format('dias_em_atraso')} AS faixa_atraso,
  {STATUS_SQL.format(flag='pago', paid='valor_pagamento', billed='valor_boleto')} AS status_pagamento, valor_pagamento - valor_boleto AS diferenca_pagamento
FROM (SELECT {_CLEAN_COLUMNS}, {_LISTS}, CASE WHEN pago = 'y' THEN NULL ELSE {_OVERDUE} END AS dias_em_atraso FROM clean)"""))
def transform_invoices(spark, sf):
    return T.transform_invoices(_invoice_raw(spark, sf), I.REF, ORDER)[0]


_BRIDGE_ROWS = """
SELECT codigo_boleto, CAST(base_customer AS VARCHAR) AS codigo_veiculo, CAST(CASE base_status WHEN 'F' THEN 2 ELSE 1 END AS BIGINT) AS qtd_veiculos_boleto,
       valor_boleto / CASE base_status WHEN 'F' THEN 2 ELSE 1 END AS valor_rateado FROM clean WHERE base_status IN ('F', 'O')
UNION ALL SELECT codigo_boleto, CAST(base_customer + 1 AS VARCHAR), 2, valor_boleto / 2 FROM clean WHERE base_status = 'F'"""


@query("invoice_bridge", _invoice_sql(_BRIDGE_ROWS))
def invoice_bridge(spark, sf):
    return T.transform_invoices(_invoice_raw(spark, sf), I.REF, ORDER)[1]


@query("transform_delinquency", _invoice_sql(f"""SELECT *, {BUCKET_SQL.format('dias_em_atraso')} AS faixa_atraso
FROM (SELECT {_CLEAN_COLUMNS}, {_LISTS}, DATE '2001-08-02' AS dt_referencia, {_OVERDUE} AS dias_em_atraso FROM clean)"""))
def transform_delinquency(spark, sf):
    return T.transform_delinquency(_invoice_raw(spark, sf), I.REF, ORDER)


# --- loads -------------------------------------------------------------------------------------

DAY1, DAY2 = Run(date(2001, 8, 1), FIRST), Run(I.REF, NEXT)


def _customers_dim(spark, sf, warehouse):
    """A customer dimension with two versions per customer: before and from 1998."""
    customer = I.table(spark, sf, "customer").select(F.expr("concat('k', c_custkey)").alias("codigo_associado"), "c_custkey")
    split, epoch, never = F.lit(date(1998, 1, 1)), F.lit(date(1900, 1, 1)), F.lit(None).cast("date")
    old = customer.select("codigo_associado", (F.col("c_custkey") * 2).alias("sk_customer"), epoch.alias("valido_de"), split.alias("valido_ate"), F.lit(False).alias("vigente"))
    new = customer.select("codigo_associado", (F.col("c_custkey") * 2 + 1).alias("sk_customer"), split.alias("valido_de"), never.alias("valido_ate"), F.lit(True).alias("vigente"))
    warehouse.replace("dim_customers", old.unionByName(new))


def _loadable(spark, sf):
    """Invoices as the load sees them, with a known customer and emission day."""
    return I.invoices(spark, sf).select(
        F.col("boleto").cast("string").alias("codigo_boleto"),
        F.expr("concat('k', customer)").alias("codigo_associado"),
        F.col("emission").alias("data_emissao"),
        F.col("value").alias("valor_boleto"),
        F.when(F.col("status") != "P", F.expr("concat(customer, ',', customer + 1)")).alias("veiculo"),
        "priority",
        "paid_value",
    )


_SK = "customer * 2 + CASE WHEN emission >= DATE '1998-01-01' THEN 1 ELSE 0 END"
_OLD, _NEW = "data_emissao < DATE '2000-01-01'", "data_emissao >= DATE '1999-01-01'"


def _facts(spark, sf, label):
    warehouse = I.new_warehouse(spark, label)
    _customers_dim(spark, sf, warehouse)
    every = _loadable(spark, sf)
    jobs.load_facts(warehouse, every.filter(_OLD).drop("paid_value"), DAY1)
    changed = every.filter(_NEW).withColumn("valor_boleto", F.col("paid_value")).drop("paid_value", "priority")
    jobs.load_facts(warehouse, changed, DAY2)
    return warehouse


@query("load_facts", I.with_sql("invoices", f"""
SELECT CAST(boleto AS VARCHAR) AS codigo_boleto, CASE WHEN emission >= DATE '1999-01-01' THEN paid_value ELSE value END AS valor_boleto, {_SK} AS sk_customer,
       CASE WHEN emission < DATE '2000-01-01' THEN priority END AS priority,
       CASE WHEN emission < DATE '2000-01-01' THEN '2001-08-01 03:00:00' ELSE '2001-08-02 03:00:00' END AS criado_em,
       CASE WHEN emission < DATE '1999-01-01' THEN '2001-08-01 03:00:00' ELSE '2001-08-02 03:00:00' END AS atualizado_em FROM invoices"""))
def load_facts(spark, sf):
    facts = _facts(spark, sf, "facts").read(jobs.FACTS)
    return facts.select(
        "codigo_boleto", "valor_boleto", "sk_customer", "priority", I.stamp_text("criado_em"), I.stamp_text("atualizado_em")
    )


@query("load_bridge", I.with_sql("invoices", """
SELECT CAST(boleto AS VARCHAR) AS codigo_boleto, CAST(customer + step AS VARCHAR) AS codigo_veiculo, CAST(2 AS BIGINT) AS qtd_veiculos_boleto,
       CASE WHEN emission >= DATE '1999-01-01' THEN paid_value ELSE value END / 2 AS valor_rateado,
       CASE WHEN emission < DATE '2000-01-01' THEN '2001-08-01 03:00:00' ELSE '2001-08-02 03:00:00' END AS criado_em
FROM invoices, (VALUES (0), (1)) v(step) WHERE status <> 'P'"""))
def load_bridge(spark, sf):
    from ledgerloom.operators.allocation import allocate_from_text

    warehouse, every = I.new_warehouse(spark, "bridge"), _loadable(spark, sf)
    paid = every.withColumn("valor_boleto", F.col("paid_value"))
    for invoices, run in [(every.filter(_OLD), DAY1), (paid.filter(_NEW), DAY2)]:
        jobs.load_bridge(warehouse, allocate_from_text(invoices, "codigo_boleto", "veiculo", "valor_boleto"), run)
    return warehouse.read(jobs.BRIDGE).select(
        "codigo_boleto", "codigo_veiculo", "qtd_veiculos_boleto", "valor_rateado", I.stamp_text("criado_em")
    )


@query("load_snapshot", I.with_sql("invoices", f"""
SELECT CAST(boleto AS VARCHAR) AS codigo_boleto, day AS dt_referencia, {_SK} AS sk_customer, value AS valor_boleto
FROM invoices, (VALUES (DATE '2001-08-01'), (DATE '2001-08-02')) d(day) WHERE day = DATE '2001-08-01' OR status <> 'P'"""))
def load_snapshot(spark, sf):
    warehouse, every = I.new_warehouse(spark, "snapshots"), _loadable(spark, sf).drop("paid_value", "priority")
    _customers_dim(spark, sf, warehouse)
    still_open = every.filter("veiculo is not null")
    for invoices, run in [(every, DAY1), (every, DAY2), (still_open, DAY2)]:
        jobs.load_snapshot(warehouse, invoices.withColumn("dt_referencia", F.lit(run.reference)), run)
    return warehouse.read(jobs.SNAPSHOT).select("codigo_boleto", "dt_referencia", "sk_customer", "valor_boleto")


# Dimension batches: every entity's records from the tables, then a second day on which a tenth of
# the columns' text changes with the day mark.
def _dimension_batches(spark, sf, day):
    supplier = I.table(spark, sf, "supplier")
    part = I.table(spark, sf, "part")
    customer = I.table(spark, sf, "customer")
    mark = F.lit(str(day))

    def simple(df, key, source, *more):
        return df.select(F.col(source).cast("string").alias(key), mark.alias("mark"), *more)

    moved = F.when((F.col("c_acctbal") < 0) & (F.lit(day) == 2), "moved").otherwise("same")
    sold = F.when((F.col("p_size") < 10) & (F.lit(day) == 2), F.col("p_retailprice") + 1).otherwise(F.col("p_retailprice"))
    nothing = F.lit(None).cast("string")
    return {
        "cooperatives": simple(supplier, "codigo_cooperativa", "s_suppkey"),
        "regionals": simple(supplier, "codigo_regional", "s_suppkey"),
        "volunteers": simple(supplier, "codigo_voluntario", "s_suppkey"),
        "statuses": simple(supplier, "codigo_situacao", "s_suppkey", F.col("s_name").alias("descricao_situacao")),
        "invoice_statuses": simple(
            supplier, "codigo_situacao_boleto", "s_suppkey", F.col("s_name").alias("descricao_situacao_boleto")
        ),
        "customers": customer.select(
            F.col("c_custkey").cast("string").alias("codigo_associado"), mark.alias("mark"), moved.alias("codigo_regional"),
            *(nothing.alias(n) for n in ("codigo_situacao", "codigo_voluntario", "codigo_classificacao", "codigo_cooperativa")),
        ),
        "vehicles": part.select(
            F.col("p_partkey").cast("string").alias("codigo_veiculo"), mark.alias("mark"), sold.alias("valor_fixo"),
            *(nothing.alias(n) for n in ("codigo_situacao", "codigo_voluntario", "data_contrato", "codigo_classificacao",
                                         "codigo_regional", "codigo_cooperativa", "valor_fipe_protegido")),
        ),
    }


@query("load_dimensions", """
SELECT t AS table_name, CAST(s_suppkey AS VARCHAR) AS code, '2' AS mark, CAST(NULL AS DATE) AS valido_de, CAST(NULL AS DATE) AS valido_ate,
       '2001-08-01 03:00:00' AS criado_em, '2001-08-02 03:00:00' AS atualizado_em
FROM supplier, (VALUES ('dim_cooperatives'), ('dim_regionals'), ('dim_volunteers'), ('dim_status'), ('dim_status_invoice')) d(t)
UNION ALL SELECT 'dim_customers', CAST(c_custkey AS VARCHAR), CASE WHEN c_acctbal < 0 THEN '1' ELSE '2' END, DATE '1900-01-01',
       CASE WHEN c_acctbal < 0 THEN DATE '2001-08-02' END, '2001-08-01 03:00:00', '2001-08-02 03:00:00' FROM customer
UNION ALL SELECT 'dim_customers', CAST(c_custkey AS VARCHAR), '2', DATE '2001-08-02', NULL, '2001-08-02 03:00:00', '2001-08-02 03:00:00'
FROM customer WHERE c_acctbal < 0
UNION ALL SELECT 'dim_vehicles', CAST(p_partkey AS VARCHAR), CASE WHEN p_size < 10 THEN '1' ELSE '2' END, DATE '1900-01-01',
       CASE WHEN p_size < 10 THEN DATE '2001-08-02' END, '2001-08-01 03:00:00', '2001-08-02 03:00:00' FROM part
UNION ALL SELECT 'dim_vehicles', CAST(p_partkey AS VARCHAR), '2', DATE '2001-08-02', NULL, '2001-08-02 03:00:00', '2001-08-02 03:00:00'
FROM part WHERE p_size < 10""")
def load_dimensions(spark, sf):
    warehouse = I.new_warehouse(spark, "dimensions")
    for day, run in [(1, DAY1), (2, DAY2)]:
        jobs.load_dimensions(warehouse, _dimension_batches(spark, sf, day), run)
    result = None
    never = F.lit(None).cast("date")
    keys = {table: key for table, key in E.SIMPLE_DIMENSIONS.values()}
    keys |= {spec[0]: spec[1] for spec in E.VERSIONED_DIMENSIONS.values()}
    for table, key in keys.items():
        state = warehouse.read(table)
        ends = ["valido_de", "valido_ate"] if "valido_de" in state.columns else [never.alias("valido_de"), never.alias("valido_ate")]
        shown = state.select(
            F.lit(table).alias("table_name"), F.col(key).alias("code"), "mark", *ends,
            I.stamp_text("criado_em"), I.stamp_text("atualizado_em"),
        )
        result = shown if result is None else result.unionByName(shown)
    return result


@query("initial_load", _invoice_sql("""
SELECT c.codigo_boleto, c.pago, c.valor_boleto, b.parts, round(b.allocated, 2) AS allocated FROM clean c
LEFT JOIN (SELECT codigo_boleto, count(*) AS parts, sum(valor_rateado) AS allocated FROM (""" + _BRIDGE_ROWS + """) GROUP BY 1) b
ON b.codigo_boleto = c.codigo_boleto""").replace("ORDER BY seq", "ORDER BY seq DESC"))
def initial_load(spark, sf):
    warehouse = I.new_warehouse(spark, "initial")
    jobs.initial_load(warehouse, _invoice_raw(spark, sf), DAY2, ORDER)
    return _loaded(warehouse)


@query("initial_load_by_slice", _invoice_sql("""
SELECT c.codigo_boleto, c.pago, c.valor_boleto, b.parts, round(b.allocated, 2) AS allocated FROM clean c
LEFT JOIN (SELECT codigo_boleto, count(*) AS parts, sum(valor_rateado) AS allocated FROM (""" + _BRIDGE_ROWS + """) GROUP BY 1) b
ON b.codigo_boleto = c.codigo_boleto""").replace("ORDER BY seq", "ORDER BY seq DESC"))
def initial_load_by_slice(spark, sf):
    """As ``initial_load``, in slices of some years of due days."""
    warehouse = I.new_warehouse(spark, "slices")
    history = _invoice_raw(spark, sf).withColumn("years", F.expr("cast(left(data_vencimento, 4) as int) div 3"))
    jobs.initial_load_by_slice(warehouse, history, "years", DAY2, ORDER)
    return _loaded(warehouse)


def _loaded(warehouse):
    parts = warehouse.read(jobs.BRIDGE).groupBy("codigo_boleto").agg(
        F.count("*").alias("parts"), F.round(F.sum("valor_rateado"), 2).alias("allocated")
    )
    facts = warehouse.read(jobs.FACTS).select("codigo_boleto", "pago", "valor_boleto")
    return facts.join(parts, "codigo_boleto", "left")


def _daily_raw(spark, sf):
    structs = F.expr("array(named_struct('codigo_cooperativa', codigo_voluntario))")
    return {
        "statuses": I.raw_entity(spark, sf, "part", E.STATUSES, {"situacao": "p_type"}),
        "invoice_statuses": I.raw_entity(spark, sf, "part", E.INVOICE_STATUSES, {"considerado_inadimplencia": "p_type", "pago": "p_type"}),
        "volunteers": I.raw_entity(spark, sf, "supplier", E.VOLUNTEERS).withColumn("cooperativas", structs),
        "cooperatives": I.raw_entity(spark, sf, "supplier", E.COOPERATIVES),
        "regionals": I.raw_entity(spark, sf, "supplier", E.REGIONALS),
        "customers": I.raw_entity(spark, sf, "customer", E.CUSTOMERS),
        "vehicles": I.raw_entity(spark, sf, "part", E.VEHICLES),
        "invoices": _invoice_raw(spark, sf),
        "delinquency": _invoice_raw(spark, sf),
    }


def _two_days(spark, sf):
    """Two days of the whole load; the second changes nothing but stamps and adds a snapshot day."""
    warehouse = I.new_warehouse(spark, "daily")
    raw = _daily_raw(spark, sf)
    for run in (DAY1, DAY2):
        jobs.daily_run(warehouse, raw, _lookup(spark, sf), run, ORDER)
    return warehouse


@query("daily_run", """
SELECT 'dim_customers' AS table_name, count(*) AS row_count FROM customer UNION ALL SELECT 'dim_vehicles', count(*) FROM part
UNION ALL SELECT t, count(*) FROM supplier, (VALUES ('dim_cooperatives'), ('dim_regionals'), ('dim_volunteers')) d(t) GROUP BY t
UNION ALL SELECT t, count(*) FROM part, (VALUES ('dim_status'), ('dim_status_invoice')) d(t) GROUP BY t
UNION ALL SELECT 'fact_invoices', count(*) FROM orders
UNION ALL SELECT 'bridge_invoices_vehicles', CAST(sum(CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 1 ELSE 0 END) AS BIGINT) FROM orders
UNION ALL SELECT 'fact_delinquency_snapshot', 2 * count(*) FROM orders""")
def daily_run(spark, sf):
    warehouse = _two_days(spark, sf)
    tables = [spec[0] for spec in (*E.SIMPLE_DIMENSIONS.values(), *E.VERSIONED_DIMENSIONS.values())]
    result = None
    for table in [*tables, jobs.FACTS, jobs.BRIDGE, jobs.SNAPSHOT]:
        counted = checks.row_count(warehouse.read(table)).select(F.lit(table).alias("table_name"), "row_count")
        result = counted if result is None else result.unionByName(counted)
    return result


@query("daily_run_values", _invoice_sql(f""", bridge AS ({_BRIDGE_ROWS}),
facts AS (SELECT *, {BUCKET_SQL.format('dias_em_atraso')} AS faixa_atraso,
  {STATUS_SQL.format(flag='pago', paid='valor_pagamento', billed='valor_boleto')} AS status_pagamento, valor_pagamento - valor_boleto AS diferenca_pagamento
  FROM (SELECT {_CLEAN_COLUMNS}, CASE WHEN pago = 'y' THEN NULL ELSE {_OVERDUE} END AS dias_em_atraso FROM clean))
SELECT f.codigo_boleto, f.valor_boleto, f.dias_em_atraso, f.faixa_atraso, f.status_pagamento, f.diferenca_pagamento,
       count(b.codigo_veiculo) AS vehicles, round(sum(b.valor_rateado), 2) AS allocated
FROM facts f LEFT JOIN bridge b ON b.codigo_boleto = f.codigo_boleto GROUP BY ALL"""))
def daily_run_values(spark, sf):
    """The values that two days leave: each invoice as loaded, with what was allocated to its vehicles."""
    warehouse = _two_days(spark, sf)
    parts = warehouse.read(jobs.BRIDGE).groupBy("codigo_boleto").agg(
        F.count("codigo_veiculo").alias("vehicles"), F.round(F.sum("valor_rateado"), 2).alias("allocated")
    )
    facts = warehouse.read(jobs.FACTS).join(parts, "codigo_boleto", "left").na.fill(0, ["vehicles"])
    return facts.select(
        "codigo_boleto", "valor_boleto", "dias_em_atraso", "faixa_atraso", "status_pagamento", "diferenca_pagamento", "vehicles", "allocated"
    )


# Two days whose windows fall among the records' own days.
EARLY, LATER, AGAIN = (Run(date(1995, 3, day), datetime(1995, 3, day, 3)) for day in (1, 2, 3))


def _hit(day):
    """SQL: in which of the day's windows a record falls."""
    return f"""(data_emissao BETWEEN {day} - 7 AND {day} - 1 OR data_pagamento BETWEEN {day} - 30 AND {day} OR data_vencimento BETWEEN {day} - 30 AND {day} + 30)"""


_DAILY_SQL = f""", dated AS (
  SELECT *, CASE WHEN {_hit("DATE '1995-03-02'")} THEN DATE '1995-03-02' WHEN {_hit("DATE '1995-03-01'")} THEN DATE '1995-03-01' END AS updated,
         CASE WHEN {_hit("DATE '1995-03-01'")} THEN DATE '1995-03-01' ELSE DATE '1995-03-02' END AS created FROM clean),
parts AS (SELECT codigo_boleto, count(*) AS vehicles, round(sum(valor_rateado), 2) AS allocated FROM ({_BRIDGE_ROWS}) GROUP BY 1)
SELECT d.codigo_boleto, valor_boleto, nosso_numero, CASE WHEN pago = 'y' THEN NULL ELSE GREATEST(updated - data_vencimento, 0) END AS dias_em_atraso,
       {STATUS_SQL.format(flag='pago', paid='valor_pagamento', billed='valor_boleto')} AS status_pagamento, COALESCE(vehicles, 0) AS vehicles, allocated,
       CAST(created AS VARCHAR) || ' 03:00:00' AS criado_em, CAST(updated AS VARCHAR) || ' 03:00:00' AS atualizado_em,
       CAST(2 AS BIGINT) AS snapshots
FROM dated d LEFT JOIN parts p ON p.codigo_boleto = d.codigo_boleto WHERE updated IS NOT NULL"""


@query("daily_pipeline", _invoice_sql(_DAILY_SQL).replace("ORDER BY seq", "ORDER BY seq DESC"))
def daily_pipeline(spark, sf):
    """The job of a day over landed JSON: a first day, a second whose files lie beside those of the first, and a rerun.

    All raw records land on both days, the repeated ones in a file of their own in front of the others. What is
    left are the invoices in a window of either day, as of the last day that had them, with their vehicles.
    """
    warehouse, landing = I.new_warehouse(spark, "landed"), fresh_path(spark, "landing")
    schemas = {}
    for run in (EARLY, LATER, AGAIN):
        for entity, raw in _daily_raw(spark, sf).items() if run is not AGAIN else ():
            schemas[entity] = raw.drop(*ORDER).schema
            for copy in (0, 1):
                landed.write_records(raw.filter(F.col("__seq") == copy).drop(*ORDER), f"{landing}/{entity}/{run.reference}/{copy}", "gzip", 100_000)
        jobs.daily_pipeline(warehouse, landing, schemas, _lookup(spark, sf), run)
    parts = warehouse.read(jobs.BRIDGE).groupBy("codigo_boleto").agg(
        F.count("codigo_veiculo").alias("vehicles"), F.round(F.sum("valor_rateado"), 2).alias("allocated")
    )
    days = warehouse.read(jobs.SNAPSHOT).groupBy("codigo_boleto").agg(F.count("*").alias("snapshots"))
    facts = warehouse.read(jobs.FACTS).join(parts, "codigo_boleto", "left").na.fill(0, ["vehicles"]).join(days, "codigo_boleto", "left")
    return facts.select(
        "codigo_boleto", "valor_boleto", "nosso_numero", "dias_em_atraso", "status_pagamento", "vehicles", "allocated",
        I.stamp_text("criado_em"), I.stamp_text("atualizado_em"), "snapshots",
    )
