"""Queries for joins over time, set operations and the reporting views."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.catalog import inputs as I
from ledgerloom.catalog.columns import BUCKET_SQL, bridge
from ledgerloom.catalog.registry import query
from ledgerloom.functions import billing
from ledgerloom.operators import scd2, views
from ledgerloom.operators.as_of import as_of_key, as_of_once, version_key
from ledgerloom.operators.lookup import lookup_join
from ledgerloom.operators.shaping import append
from ledgerloom.operators.skew import hot_keys
from ledgerloom.session import settle

FACT_SQL = "facts AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) AS day FROM lineitem)"
PIT = "h.part = f.l_partkey AND f.day >= h.valido_de AND (h.valido_ate IS NULL OR f.day < h.valido_ate)"


def _facts(spark, sf):
    return I.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.to_date("l_shipdate").alias("day"))


def _with_sql(names, extra, body):
    return "WITH " + ", ".join([I.CTES[n] for n in names.split()] + [extra]) + " " + body


@query("pit_join", _with_sql("history", FACT_SQL, f"SELECT f.*, h.sk FROM facts f LEFT JOIN history h ON {PIT}"))
def pit_join(spark, sf):
    facts = _facts(spark, sf)
    hot = hot_keys(facts, "l_partkey")
    return version_key(facts, I.history(spark, sf), "l_partkey", "day", "part", "sk", hot)


# Each version lasts 30 days beyond the start of the next one; the latest start must win.
@query("pit_join_dedupe", _with_sql("invoices history", "overlapping AS (SELECT part, sk, valido_de, valido_ate + 30 AS valido_ate FROM history)", """
SELECT f.boleto, f.customer, f.emission, max(h.sk) AS sk FROM invoices f
LEFT JOIN overlapping h ON h.part = f.customer AND f.emission >= h.valido_de AND (h.valido_ate IS NULL OR f.emission < h.valido_ate) GROUP BY 1, 2, 3"""))
def pit_join_dedupe(spark, sf):
    versions = I.history(spark, sf).withColumn("valido_ate", F.date_add("valido_ate", 30))
    facts = I.invoices(spark, sf).select("boleto", "customer", "emission")
    hot = hot_keys(facts, "customer")
    return as_of_once(facts, versions, ["boleto"], "customer", "emission", "part", "sk", hot)


@query("series_align", _with_sql("history", FACT_SQL, f"""
SELECT f.day, count(*) AS facts, count(h.sk) AS resolved FROM facts f LEFT JOIN history h ON {PIT} GROUP BY 1"""))
def series_align(spark, sf):
    facts = _facts(spark, sf)
    keyed = as_of_key(facts, I.history(spark, sf), "l_partkey", "day", "part", "sk", hot_keys(facts, "l_partkey"))
    return keyed.groupBy("day").agg(F.count("*").alias("facts"), F.count("sk").alias("resolved"))


# Snapshot of all open invoices on two days, the bridge of all lines, and part versions with their owner.
SNAPSHOT_SQL = """
snapshot AS (
  SELECT boleto AS codigo_boleto, day AS dt_referencia, emission AS data_emissao, due AS data_vencimento, value AS valor_boleto,
         days AS dias_em_atraso, """ + BUCKET_SQL.format("days") + """ AS faixa_atraso, paid_flag AS pago
  FROM (SELECT *, GREATEST(day - due, 0) AS days
        FROM invoices, (VALUES (DATE '1999-08-02'), (DATE '2001-08-02')) AS d(day) WHERE status = 'O' AND emission <= day)),
vehicles AS (
  SELECT part, h.owner, h.sk, valido_de, valido_ate, s_name AS name, s_nationkey AS nation, s_acctbal < 0 AS debt
  FROM history h JOIN supplier ON s_suppkey = h.owner)"""
VIEW_SQL = """
SELECT f.*, b.item AS codigo_veiculo, b.n AS qtd_veiculos_boleto, f.valor_boleto / b.n AS valor_rateado, {key}
       v.owner AS codigo_voluntario, v.name AS nome_voluntario, v.nation AS codigo_regional_veiculo,
       v.nation AS codigo_cooperativa_veiculo, v.debt AS codigo_situacao_veiculo
FROM snapshot f LEFT JOIN bridge b ON b.boleto = f.codigo_boleto LEFT JOIN vehicles v ON v.part = b.item AND {match}"""


def snapshot(spark, sf):
    days = F.explode(F.expr("array(DATE '1999-08-02', DATE '2001-08-02')")).alias("dt_referencia")
    open_ones = I.invoices(spark, sf).filter("status = 'O'").select("*", days).filter("emission <= dt_referencia")
    overdue = billing.days_overdue(F.col("due"), F.col("dt_referencia"))
    return open_ones.select(
        F.col("boleto").alias("codigo_boleto"),
        "dt_referencia",
        F.col("emission").alias("data_emissao"),
        F.col("due").alias("data_vencimento"),
        F.col("value").alias("valor_boleto"),
        overdue.alias("dias_em_atraso"),
        billing.aging_bucket(overdue).alias("faixa_atraso"),
        F.col("paid_flag").alias("pago"),
    )


def vehicles(spark, sf):
    supplier = I.table(spark, sf, "supplier")
    versions = I.history(spark, sf)
    return versions.join(supplier, versions.owner == supplier.s_suppkey).select(
        F.col("part").alias("codigo_veiculo"),
        F.col("sk").alias("sk_vehicle"),
        "valido_de",
        "valido_ate",
        F.col("valido_ate").isNull().alias("vigente"),
        F.col("owner").alias("codigo_voluntario"),
        F.col("s_name").alias("nome_voluntario"),
        F.col("s_nationkey").alias("codigo_regional"),
        F.col("s_nationkey").alias("codigo_cooperativa"),
        (F.col("s_acctbal") < 0).alias("codigo_situacao"),
    )


def _bridge_table(spark, sf):
    names = {"boleto": "codigo_boleto", "item": "codigo_veiculo", "n": "qtd_veiculos_boleto", "share": "valor_rateado"}
    return bridge(spark, sf).withColumnsRenamed(names)


def _stored_bridge(spark, sf):
    """The bridge as a stored table, and its hot keys."""
    stored = settle(_bridge_table(spark, sf), "bridge")
    return stored, {"hot_invoices": hot_keys(stored, "codigo_boleto"), "hot_vehicles": hot_keys(stored, "codigo_veiculo")}


@query("delinquency_by_vehicle_current", _with_sql("invoices billed bridge history", SNAPSHOT_SQL, VIEW_SQL.format(key="", match="v.valido_ate IS NULL")))
def delinquency_by_vehicle_current(spark, sf):
    stored, hot = _stored_bridge(spark, sf)
    return views.by_current_owner(snapshot(spark, sf), stored, vehicles(spark, sf), **hot)


@query("delinquency_by_vehicle_historical", _with_sql("invoices billed bridge history", SNAPSHOT_SQL, VIEW_SQL.format(
    key="v.sk AS sk_vehicle,", match="f.dt_referencia >= v.valido_de AND (v.valido_ate IS NULL OR f.dt_referencia < v.valido_ate)")))
def delinquency_by_vehicle_historical(spark, sf):
    stored, hot = _stored_bridge(spark, sf)
    return views.by_owner_at_snapshot(snapshot(spark, sf), stored, vehicles(spark, sf), **hot)


OWNER_SQL = """
SELECT codigo_voluntario, nome_voluntario, faixa_atraso, count(*) AS boletos, round(sum(valor_rateado), 6) AS valor_em_atraso
FROM ({}) WHERE dt_referencia = DATE '2001-08-02' GROUP BY 1, 2, 3"""


@query("overdue_by_owner", _with_sql("invoices billed bridge history", SNAPSHOT_SQL, OWNER_SQL.format(VIEW_SQL.format(key="", match="v.valido_ate IS NULL"))))
def overdue_by_owner(spark, sf):
    """The flagship report: overdue value per responsible and aging range today."""
    today = snapshot(spark, sf).filter(F.col("dt_referencia") == F.lit(I.REF))
    stored, hot = _stored_bridge(spark, sf)
    view = views.by_current_owner(today, stored, vehicles(spark, sf), **hot)
    return view.groupBy("codigo_voluntario", "nome_voluntario", "faixa_atraso").agg(
        F.count("*").alias("boletos"), F.round(F.sum("valor_rateado"), 6).alias("valor_em_atraso")
    )


_VIEW_OUTPUT = """
SELECT '{name}' AS view_name, count(*) AS row_count, count(codigo_voluntario) AS owners, count(DISTINCT codigo_voluntario) AS distinct_owners,
       round(sum({value}), 2) AS total FROM ({source})"""


@query("create_views", _with_sql("invoices billed bridge history", SNAPSHOT_SQL, " UNION ALL ".join([
    *(_VIEW_OUTPUT.format(name=name, value="CAST(codigo_veiculo AS DOUBLE)", source="SELECT owner AS codigo_voluntario, part AS codigo_veiculo FROM vehicles WHERE valido_ate IS NULL")
      for name in ("dim_customers_current", "dim_vehicles_current")),
    _VIEW_OUTPUT.format(name="vw_delinquency_by_vehicle_atual", value="valor_rateado", source=VIEW_SQL.format(key="", match="v.valido_ate IS NULL")),
    _VIEW_OUTPUT.format(name="vw_delinquency_by_vehicle_historico", value="valor_rateado", source=VIEW_SQL.format(
        key="v.sk AS sk_vehicle,", match="f.dt_referencia >= v.valido_de AND (v.valido_ate IS NULL OR f.dt_referencia < v.valido_ate)"))])))
def create_views(spark, sf):
    warehouse, names = _viewed(spark, sf)
    shown = []
    for name in names:
        value = "valor_rateado" if name.startswith("vw_") else "codigo_veiculo"
        shown.append(spark.table(f"{warehouse.database}.{name}").agg(
            F.lit(name).alias("view_name"), F.count("*").alias("row_count"), F.count("codigo_voluntario").alias("owners"),
            F.count_distinct("codigo_voluntario").alias("distinct_owners"), F.round(F.sum(F.col(value).cast("double")), 2).alias("total"),
        ).select("view_name", "row_count", "owners", "distinct_owners", "total"))
    return append(*shown)


@query("view_current_rows", _with_sql("invoices billed bridge history", SNAPSHOT_SQL, VIEW_SQL.format(key="", match="v.valido_ate IS NULL")))
def view_current_rows(spark, sf):
    warehouse, _ = _viewed(spark, sf)
    return spark.table(f"{warehouse.database}.vw_delinquency_by_vehicle_atual")


@query("view_historical_rows", _with_sql("invoices billed bridge history", SNAPSHOT_SQL, VIEW_SQL.format(
    key="v.sk AS sk_vehicle,", match="f.dt_referencia >= v.valido_de AND (v.valido_ate IS NULL OR f.dt_referencia < v.valido_ate)")))
def view_historical_rows(spark, sf):
    warehouse, _ = _viewed(spark, sf)
    return spark.table(f"{warehouse.database}.vw_delinquency_by_vehicle_historico")


def _viewed(spark, sf):
    """A warehouse with its views, and their names."""
    warehouse = I.new_warehouse(spark, "views")
    # The views are made over empty tables: what they show must be what is loaded afterwards.
    tables = {
        "fact_delinquency_snapshot": snapshot(spark, sf),
        "bridge_invoices_vehicles": _bridge_table(spark, sf),
        "dim_vehicles": vehicles(spark, sf),
    }
    tables["dim_customers"] = tables["dim_vehicles"]
    for name, frame in tables.items():
        warehouse.replace(name, frame.limit(0))
    names = views.create_views(spark, warehouse.database)
    for name, frame in tables.items():
        # The same versions stand for both dimensions; they are made once.
        warehouse.replace(name, warehouse.read("dim_vehicles") if name == "dim_customers" else frame)
    return warehouse, names


def _dim_and_batch(spark, sf):
    return I.dim(spark, sf), I.batch(spark, sf)


@query("changed_keys", I.with_sql("dim batch plan", "SELECT part FROM plan WHERE changed"))
def changed_keys(spark, sf):
    return scd2.changed_keys(*_dim_and_batch(spark, sf), "part", I.MONITORED)


@query("keys_without_current", I.with_sql("dim batch", "SELECT part FROM batch WHERE part NOT IN (SELECT part FROM dim WHERE vigente)"))
def keys_without_current(spark, sf):
    return scd2.keys_without_current(*_dim_and_batch(spark, sf), "part")


_STATE = "SELECT d.part, d.price, d.valido_de, {end} AS valido_ate, {flag} AS vigente FROM dim d LEFT JOIN plan p ON p.part = d.part"


@query("close_changed", I.with_sql("dim batch plan", _STATE.format(
    end="CASE WHEN d.vigente AND p.changed THEN DATE '1996-07-01' ELSE d.valido_ate END",
    flag="CASE WHEN d.vigente AND p.changed THEN FALSE ELSE d.vigente END")))
def close_changed(spark, sf):
    dim, batch = _dim_and_batch(spark, sf)
    keys = scd2.changed_keys(dim, batch, "part", I.MONITORED)
    return scd2.close_versions(dim, keys, "part", I.SPLIT, I.NOW).select("part", "price", "valido_de", "valido_ate", "vigente")


@query("refresh_unchanged", I.with_sql("dim batch plan", """
SELECT d.part, d.owner, d.valido_de, CASE WHEN d.vigente AND NOT p.changed THEN p.price ELSE d.price END AS price
FROM dim d LEFT JOIN plan p ON p.part = d.part"""))
def refresh_unchanged(spark, sf):
    state = scd2.refresh_versions(*_dim_and_batch(spark, sf), "part", I.MONITORED, I.NOW)
    return state.select("part", "owner", "valido_de", "price")


@query("last_end_subquery", I.with_sql("dim batch", """
SELECT b.part, COALESCE((SELECT max(valido_ate) FROM dim d WHERE d.part = b.part), DATE '1900-01-01') AS start_day FROM batch b"""))
def last_end_subquery(spark, sf):
    from ledgerloom.functions.calendar import or_epoch

    dim, batch = _dim_and_batch(spark, sf)
    return batch.join(scd2.last_end(dim, "part"), "part", "left").select("part", or_epoch(F.col("last_end")).alias("start_day"))


@query("max_valid_to", I.with_sql("history", "SELECT part, max(valido_ate) AS last_end FROM history GROUP BY part"))
def max_valid_to(spark, sf):
    return scd2.last_end(I.history(spark, sf), "part")


@query("lookup_join", """
SELECT e.event_id, u.c_name AS description FROM events e LEFT JOIN (SELECT CASE WHEN c_acctbal < 0 THEN -c_custkey ELSE c_custkey END AS c_custkey, c_name FROM customer) u ON u.c_custkey = e.user_id""")
def lookup(spark, sf):
    known = I.table(spark, sf, "customer")
    code = F.when(F.col("c_acctbal") < 0, -F.col("c_custkey")).otherwise(F.col("c_custkey"))
    codes = known.select(code.alias("user_id"), F.col("c_name").alias("description"))
    events = I.table(spark, sf, "events").select("event_id", "user_id")
    return lookup_join(events, codes, "user_id").select("event_id", "description")


@query("union_all", I.with_sql("dim batch", "SELECT part, owner FROM dim UNION ALL SELECT part, owner FROM batch"))
def union_all(spark, sf):
    dim, batch = _dim_and_batch(spark, sf)
    return append(dim.select("part", "owner"), batch.select("part", "owner"))


@query("union_distinct", I.with_sql("dim batch plan", "SELECT part FROM plan WHERE changed UNION SELECT part FROM plan WHERE NOT has_current"))
def union_distinct(spark, sf):
    return scd2.keys_to_open(*_dim_and_batch(spark, sf), "part", I.MONITORED)


@query("distinct_union", I.with_sql("dim batch", "SELECT part FROM dim UNION SELECT part FROM batch"))
def distinct_union(spark, sf):
    dim, batch = _dim_and_batch(spark, sf)
    return dim.select("part").union(batch.select("part")).distinct()
