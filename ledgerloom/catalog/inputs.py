"""Warehouse-like inputs derived from the given tables, in Spark and in SQL.

Orders stand for invoices, parts for vehicles, suppliers for those responsible
for them and customers for customers. Everything is derived from whole tables.
"""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom.operators.lookup import lookup_join
from ledgerloom.operators.temporal import versions_from_changes
from ledgerloom.plans import entities as E
from ledgerloom.plans.warehouse import Warehouse
from ledgerloom.session import fresh_path

REF, NOW = date(2001, 8, 2), datetime(2001, 8, 2, 3, 0, 0)
SPLIT = date(1996, 7, 1)
#: Lines that one task of a history takes.
TASK_LINES = 1_000_000


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def new_warehouse(spark: SparkSession, label: str) -> Warehouse:
    return Warehouse(spark, fresh_path(spark, label), f"ledgerloom_{uuid.uuid4().hex}")


def with_sql(names: str, body: str) -> str:
    """SQL with the named inputs in front of it."""
    return "WITH " + ", ".join(CTES[name] for name in names.split()) + " " + body


def stamp_text(column: str) -> Column:
    """Timestamp as text, so that no zone setting takes part in a comparison."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


# SQL for each input. Every text has the same name as the function that builds it below.
CTES: dict[str, str] = {}

CTES["invoices"] = """
invoices AS (
  SELECT o_orderkey AS boleto, o_custkey AS customer, o_totalprice AS value, o_orderstatus AS status,
         o_orderpriority AS priority, CAST(o_orderdate AS DATE) AS emission,
         CAST(o_orderdate AS DATE) + 30 AS due,
         CASE o_orderstatus WHEN 'F' THEN 'y' WHEN 'O' THEN 'n' END AS paid_flag,
         CASE o_orderpriority WHEN '1-URGENT' THEN o_totalprice WHEN '2-HIGH' THEN o_totalprice * 0.9
              WHEN '3-MEDIUM' THEN o_totalprice * 1.05 WHEN '5-LOW' THEN o_totalprice + 0.005 END AS paid_value,
         CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 20 END AS paid_on
  FROM orders)"""


def invoices(spark: SparkSession, sf: str) -> DataFrame:
    price, priority, day = F.col("o_totalprice"), F.col("o_orderpriority"), F.to_date("o_orderdate")
    paid = F.when(priority == "1-URGENT", price).when(priority == "2-HIGH", price * 0.9)
    paid = paid.when(priority == "3-MEDIUM", price * 1.05).when(priority == "5-LOW", price + 0.005)
    status = F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("boleto"),
        F.col("o_custkey").alias("customer"),
        price.alias("value"),
        status.alias("status"),
        priority.alias("priority"),
        day.alias("emission"),
        F.date_add(day, 30).alias("due"),
        F.when(status == "F", "y").when(status == "O", "n").alias("paid_flag"),
        paid.alias("paid_value"),
        F.when(status == "F", F.date_add(day, 20)).alias("paid_on"),
    )


CTES["listed"] = """
listed AS (
  SELECT *, CASE WHEN n = 0 THEN CAST([] AS BIGINT[])
                 WHEN status = 'P' AND n = 4 THEN NULL
                 WHEN status = 'P' THEN list_append(range(customer, customer + n), NULL)
                 WHEN status = 'F' THEN list_append(range(customer, customer + n), customer)
                 ELSE range(customer, customer + n) END AS items
  FROM (SELECT *, CAST(substr(priority, 1, 1) AS BIGINT) - 1 AS n FROM invoices))"""


def listed(spark: SparkSession, sf: str) -> DataFrame:
    """Invoices with a list of items: some empty, some with repeats, null elements or no list at all."""
    n = F.col("priority").substr(1, 1).cast("bigint") - 1
    run = F.sequence(F.col("customer"), F.col("customer") + n - 1)
    none, empty = F.lit(None).cast("array<bigint>"), F.array().cast("array<bigint>")
    items = (
        F.when(n == 0, empty)
        .when((F.col("status") == "P") & (n == 4), none)
        .when(F.col("status") == "P", F.concat(run, F.array(F.lit(None).cast("bigint"))))
        .when(F.col("status") == "F", F.concat(run, F.array("customer")))
        .otherwise(run)
    )
    return invoices(spark, sf).withColumns({"n": n, "items": items})


CTES["stored"] = """
stored AS (
  SELECT boleto, value, CASE WHEN status = 'F' THEN '' WHEN status = 'O' THEN customer || ',' || boleto || ',' || customer
                             WHEN priority = '2-HIGH' THEN customer || ',,' || boleto END AS items
  FROM invoices)"""


def stored(spark: SparkSession, sf: str) -> DataFrame:
    """Invoices with their items as delimited text."""
    customer, boleto, status = F.col("customer"), F.col("boleto"), F.col("status")
    text = F.when(status == "F", "").when(status == "O", F.concat_ws(",", customer, boleto, customer))
    text = text.when(F.col("priority") == "2-HIGH", F.concat_ws(",", customer, F.lit(""), boleto))
    return invoices(spark, sf).select("boleto", "value", text.alias("items"))


CTES["billed"] = """
billed AS (SELECT l_orderkey AS boleto, l_partkey AS item, o_totalprice AS value
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def billed_items(spark: SparkSession, sf: str) -> DataFrame:
    """One row per invoice line, repeats included."""
    lines = table(spark, sf, "lineitem")
    return lines.select(F.col("l_orderkey").alias("boleto"), F.col("l_partkey").alias("item"))


CTES["bridge"] = """
bridge AS (SELECT boleto, item, count(*) OVER (PARTITION BY boleto) AS n,
                  value / count(*) OVER (PARTITION BY boleto) AS share
           FROM (SELECT DISTINCT boleto, item, value FROM billed))"""

CTES["history"] = """
history AS (
  SELECT part, owner, part * 100000 + (day - DATE '1990-01-01') AS sk, day AS valido_de,
         lead(day) OVER (PARTITION BY part ORDER BY day) AS valido_ate
  FROM (SELECT l_partkey AS part, CAST(l_shipdate AS DATE) AS day, max(l_suppkey) AS owner
        FROM lineitem GROUP BY 1, 2))"""


def history(spark: SparkSession, sf: str) -> DataFrame:
    """Versions of each part: whoever shipped it last is responsible until the next shipment."""
    lines = table(spark, sf, "lineitem")
    # More lines than the session's tasks should sort are dealt over as many tasks as they need.
    tasks = -(-lines.count() // TASK_LINES)
    many = tasks > int(spark.conf.get("spark.sql.shuffle.partitions"))
    shipped = lines.select(F.col("l_partkey").alias("part"), F.to_date("l_shipdate").alias("day"), "l_suppkey")
    shipped = shipped.repartition(tasks, "part", "day") if many else shipped
    states = shipped.groupBy("part", "day").agg(F.max("l_suppkey").alias("owner"))
    states = states.repartition(tasks, "part") if many else states
    number = F.col("part") * 100000 + F.datediff("valido_de", F.lit(date(1990, 1, 1)))
    return versions_from_changes(states, "part", "day").withColumn("sk", number)


# The dimension before the batch: the two halves of 1995 give a closed and a current
# version. Parts shipped in the first half only are left without a current one.
CTES["dim"] = """
halves AS (
  SELECT l_partkey AS part, CAST(l_shipdate AS DATE) >= DATE '1995-07-01' AS late, max(l_suppkey) AS owner,
         nullif(max(l_returnflag), 'R') AS mark, max(l_extendedprice) AS price, max(l_quantity) AS quantity
  FROM lineitem WHERE CAST(l_shipdate AS DATE) < DATE '1996-01-01' GROUP BY 1, 2),
dim AS (
  SELECT part, owner, mark, price, quantity,
         CASE WHEN late AND count(*) OVER (PARTITION BY part) = 2 THEN DATE '1995-07-01' ELSE DATE '1900-01-01' END AS valido_de,
         CASE WHEN NOT late THEN DATE '1995-07-01' END AS valido_ate, late AS vigente
  FROM halves)"""


def _state(lines: DataFrame) -> DataFrame:
    return lines.groupBy(F.col("l_partkey").alias("part")).agg(
        F.max("l_suppkey").alias("owner"),
        F.nullif(F.max("l_returnflag"), F.lit("R")).alias("mark"),
        F.max("l_extendedprice").alias("price"),
        F.max("l_quantity").alias("quantity"),
    )


def dim(spark: SparkSession, sf: str) -> DataFrame:
    lines, middle = table(spark, sf, "lineitem"), F.lit(date(1995, 7, 1))
    day, epoch = F.to_date("l_shipdate"), F.lit(date(1900, 1, 1))
    early = _state(lines.filter(day < middle)).select(
        "*", epoch.alias("valido_de"), middle.alias("valido_ate"), F.lit(False).alias("vigente")
    )
    late = _state(lines.filter((day >= middle) & (day < F.lit(date(1996, 1, 1)))))
    before = early.select(F.col("part").alias("earlier"))
    start = F.when(F.col("earlier").isNotNull(), middle).otherwise(epoch)
    late = late.join(before, late.part == before.earlier, "left").select(
        *late.columns, start.alias("valido_de"), F.lit(None).cast("date").alias("valido_ate"), F.lit(True).alias("vigente")
    )
    both = early.unionByName(late)
    stamp = F.lit(datetime(1996, 1, 1))
    place = F.col("part") * 2 + F.col("vigente").cast("int")
    return both.withColumns({"sk": place.cast("bigint"), "criado_em": stamp, "atualizado_em": stamp})


CTES["batch"] = """
batch AS (
  SELECT l_partkey AS part, max(l_suppkey) AS owner, nullif(max(l_returnflag), 'R') AS mark, max(l_extendedprice) AS price
  FROM lineitem WHERE CAST(l_shipdate AS DATE) >= DATE '1996-01-01'
  GROUP BY 1)"""


def batch(spark: SparkSession, sf: str) -> DataFrame:
    """Parts shipped since 1996, with their state then: all lines that are not in ``dim``."""
    day = F.to_date("l_shipdate")
    lines = table(spark, sf, "lineitem").filter(day >= F.lit(date(1996, 1, 1)))
    return _state(lines).drop("quantity")


MONITORED = ["owner", "mark"]

CTES["plan"] = """
plan AS (
  SELECT *, changed OR NOT has_current AS opens,
         COALESCE(GREATEST(last_end, CASE WHEN changed THEN DATE '1996-07-01' END), DATE '1900-01-01') AS start_day
  FROM (SELECT b.*, c.part IS NOT NULL AS has_current, e.last_end,
               c.part IS NOT NULL AND (c.owner IS DISTINCT FROM b.owner OR c.mark IS DISTINCT FROM b.mark) AS changed
        FROM batch b
        LEFT JOIN (SELECT * FROM dim WHERE vigente) c ON c.part = b.part
        LEFT JOIN (SELECT part, max(valido_ate) AS last_end FROM dim GROUP BY part) e ON e.part = b.part))"""

SCD2_SQL = """
SELECT d.part,
       CASE WHEN p.opens AND d.valido_de = p.start_day THEN p.owner ELSE d.owner END AS owner,
       CASE WHEN p.opens AND d.valido_de = p.start_day THEN p.mark ELSE d.mark END AS mark,
       CASE WHEN (p.opens AND d.valido_de = p.start_day) OR (d.vigente AND NOT p.opens) THEN p.price ELSE d.price END AS price,
       d.quantity, d.valido_de,
       CASE WHEN p.opens AND d.valido_de = p.start_day THEN NULL
            WHEN d.vigente AND p.changed THEN DATE '1996-07-01' ELSE d.valido_ate END AS valido_ate,
       CASE WHEN p.opens AND d.valido_de = p.start_day THEN TRUE
            WHEN d.vigente AND p.changed THEN FALSE ELSE d.vigente END AS vigente
FROM dim d LEFT JOIN plan p ON p.part = d.part
UNION ALL
SELECT p.part, p.owner, p.mark, p.price, NULL, p.start_day, NULL, TRUE
FROM plan p WHERE p.opens AND NOT EXISTS (SELECT 1 FROM dim d WHERE d.part = p.part AND d.valido_de = p.start_day)"""


CTES["paged"] = """
paged AS (
  SELECT e.event_type AS slice, CAST(event_id // 500 AS BIGINT) AS page, event_id AS id, user_id, value, ts,
         row_number() OVER (PARTITION BY e.event_type, event_id // 500 ORDER BY event_id) - 1 AS position
  FROM events e),
declared AS (SELECT event_type AS slice, count(CASE WHEN ts < TIMESTAMP '2024-01-22 00:00:00' THEN 1 END) AS total
             FROM events GROUP BY 1),
counted AS (SELECT slice, page, n, sum(n) OVER (PARTITION BY slice ORDER BY page) AS seen
            FROM (SELECT slice, page, count(*) AS n FROM paged GROUP BY 1, 2))"""

PAGE_RECORD = "struct<id: bigint, user_id: bigint, value: double>"


def paged(spark: SparkSession, sf: str, bodies: str) -> DataFrame:
    """Events as landed API pages, one slice per event type and at most 500 records per page.

    Bodies are objects, bare lists, or lists on even pages and objects on odd ones.
    """
    events = table(spark, sf, "events").select(
        F.col("event_type").alias("slice"), F.col("event_id").alias("id"), "user_id", "value",
        (F.col("ts") < F.lit("2024-01-22 00:00:00").cast("timestamp_ntz")).alias("early"),
    )
    page = F.floor(F.col("id") / 500)
    pages = events.groupBy("slice", page.alias("page")).agg(
        F.sort_array(F.collect_list(F.struct("id", "user_id", "value"))).alias("items")
    )
    totals = events.groupBy("slice").agg(F.count(F.when(F.col("early"), 1)).alias("total"))
    whole = F.to_json(F.struct("items", "total"))
    bare = F.to_json("items")
    body = {"object": whole, "list": bare, "mixed": F.when(F.col("page") % 2 == 0, bare).otherwise(whole)}[bodies]
    return lookup_join(pages, totals, "slice").select("slice", "page", body.alias("body"))


# Raw entity records: dirty text, days and numbers, with some records landed twice.
# For each base: table, key, day, amount, condition for unreadable values, condition for a second record.
BASES = {
    "customer": ("c_custkey", "c_nationkey * 30", "c_acctbal", "c_mktsegment = 'MACHINERY'", "c_acctbal < 0"),
    "part": ("p_partkey", "p_size * 10", "p_retailprice", "p_type = 'ECONOMY'", "p_size < 10"),
    "supplier": ("s_suppkey", "s_nationkey * 30", "s_acctbal", "s_acctbal < 1000", "s_nationkey < 5"),
    "orders": ("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority = '2-HIGH'", "o_orderstatus = 'P'"),
}


def _raw_columns(base: str, entity: E.Entity) -> dict[str, str]:
    """SQL expressions, valid in both engines, of the raw text of every column."""
    key, offset, amount, dirty, _ = BASES[base]
    source = {new: old for old, new in entity.renamed.items()}
    columns = {}
    for name in entity.text:
        value = f"concat('  COPY {name.upper()}', CAST({key} AS STRING), '-', CAST(copy AS STRING), ' ')"
        columns[source.get(name, name)] = value
    columns[source.get(entity.key, entity.key)] = f"concat('  ', CAST({key} AS STRING), ' ')"
    for i, name in enumerate(entity.days):
        columns[name] = f"CASE WHEN {dirty} THEN 'not-a-date' ELSE CAST(DATE '1995-01-01' + CAST({offset} + {i} AS INT) AS STRING) END"
    for i, name in enumerate(entity.numbers):
        columns[name] = f"CASE WHEN {dirty} THEN 'abc' ELSE CAST(CAST(round({amount}) AS BIGINT) + {i} AS STRING) END"
    return columns


def raw_entity(spark: SparkSession, sf: str, base: str, entity: E.Entity, extra: dict[str, str] | None = None) -> DataFrame:
    rows = table(spark, sf, base)
    twice = rows.withColumn("copy", F.lit(1)).unionByName(rows.filter(BASES[base][4]).withColumn("copy", F.lit(0)))
    columns = {**_raw_columns(base, entity), **(extra or {})}
    return twice.selectExpr(*(f"{value} AS `{name}`" for name, value in columns.items()), "copy AS __seq")


def clean_entity_sql(base: str, entity: E.Entity, extra: dict[str, str] | None = None, name: str = "clean") -> str:
    """The same records cleaned and first per key, as a common table expression."""
    raw = {**_raw_columns(base, entity), **(extra or {})}
    source = {new: old for old, new in entity.renamed.items()}
    shown = []
    for column in entity.text:
        shown.append(f"lower(regexp_replace({source.get(column, column)}, '^\\s+|\\s+$', '', 'g')) AS {column}")
    shown += [f"TRY_CAST({column} AS DATE) AS {column}" for column in entity.days]
    shown += [f"TRY_CAST({column} AS {kind}) AS {column}" for column, kind in entity.numbers.items()]
    shown += [column for column in (extra or {})]
    raws = ", ".join(f"{value} AS {column}" for column, value in raw.items())
    key = source.get(entity.key, entity.key)
    condition = BASES[base][4]
    return f"""raw_{name} AS (
  SELECT {raws}, copy AS seq
  FROM (SELECT *, 1 AS copy FROM {base} UNION ALL SELECT *, 0 AS copy FROM {base} WHERE {condition})),
{name} AS (
  SELECT {', '.join(shown)}
  FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY seq) AS place FROM raw_{name}) WHERE place = 1)"""
