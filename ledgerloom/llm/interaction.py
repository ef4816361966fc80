"""Filter interaction audit: a stream over the files, whose keyed state retracts what smaller ids prove wrong."""

from __future__ import annotations

import itertools
import json
import math

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from ledgerloom.llm.common import query, table
from ledgerloom.session import fresh_path

FILTERS = "ABCDE"
BIT = {letter: 1 << i for i, letter in enumerate(FILTERS)}
ORDERS = ["".join(p) for p in itertools.permutations(FILTERS)]
BLANKS = r"[\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Texts that share a state on the average, as a state costs a call of Python for each batch.
TEXTS_OF_STATE = 64
FIRST, LATER, NO_ID = 0, 1, 2
CHANGES = "doc_id long, part string, mask int, n long"
CHANGED = ["doc_id", "part", "mask", "n"]


def own_mask(text: Column) -> Column:
    """The bits of the filters A to D that a text (not null) fails by itself."""
    words = F.array_remove(F.split(text, BLANKS), "")
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    return (
        F.when(F.size(words) < 50, BIT["A"]).otherwise(0)
        + F.when(F.size(F.array_distinct(words)) * F.lit(100).cast("long") < F.size(words) * F.lit(65).cast("long"), BIT["B"]).otherwise(0)
        + F.when(capitals * F.lit(100).cast("long") > F.length(text) * F.lit(5).cast("long"), BIT["C"]).otherwise(0)
        + F.when(text.rlike(r"[#$%&*|]"), BIT["D"]).otherwise(0)
    ).cast("int")


def thinned(batches, groups: int):
    """Per Arrow batch and text, only the rows of the smallest id go on to the text's state.

    The others have a smaller id in sight, and rows without an id compare with nothing: both are counted here and
    travel by id, so a text that a third of all rows hold sends a row for each batch to the group of its state.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = rows.join(rows.group_by("key").aggregate([("doc_id", "min")]), "key")
        later = pc.fill_null(pc.greater(rows["doc_id"], rows["doc_id_min"]), False)
        kind = pc.if_else(pc.is_null(rows["doc_id"]), NO_ID, pc.if_else(later, LATER, FIRST)).cast(pa.int32())
        keys, ids = rows["key"].to_pylist(), pc.fill_null(rows["doc_id"], 0).to_pylist()
        group = [(int.from_bytes(k[:8]) if t == FIRST else i) % groups for k, i, t in zip(keys, ids, kind.to_pylist())]
        mask = pc.add(rows["mask"], pc.multiply(later.cast(pa.int32()), BIT["E"])).cast(pa.int32())
        out = pa.table({"group": pa.array(group, pa.int64()), "kind": kind, "key": pa.array([k.hex() for k in keys]), "doc_id": pa.array(ids, pa.int64()), "part": rows["part"], "mask": mask})
        out = out.set_column(2, "key", pc.if_else(pc.equal(out["kind"], FIRST), out["key"], ""))
        out = out.group_by(out.column_names).aggregate([([], "count_all")]).rename_columns([*out.column_names, "n"])
        yield from out.combine_chunks().to_batches()


def retracting(key, frames, state):
    """Changes of the counters that new rows of a group of texts bring; for each text the state holds the smallest id
    and how many rows of it each part has.

    A larger id fails E. A smaller id takes the place of the one held, whose rows so far counted as first: they are
    taken back (n below 0) and counted again as failing E.
    """
    held = json.loads(state.get[0]) if state.exists else {}
    out = []
    for frame in frames:
        for kind, text, doc_id, part, mask, n in zip(*(frame[c].tolist() for c in ("kind", "key", "doc_id", "part", "mask", "n"))):
            if kind != FIRST:
                out.append((None if kind == NO_ID else doc_id, part, mask, n))
                continue
            least, parts = held.get(text, (doc_id, {}))
            if doc_id < least:
                for p, k in parts.items():
                    out += [(least, p, mask, -k), (least, p, mask | BIT["E"], k)]
                least, parts = doc_id, {}
            if doc_id == least:
                parts[part] = parts.get(part, 0) + n
                held[text] = (least, parts)
            out.append((doc_id, part, mask if doc_id == least else mask | BIT["E"], n))
    state.update((json.dumps(held),))
    doc_ids, *rest = zip(*out)
    yield pd.DataFrame({"doc_id": pd.array(doc_ids, dtype="Int64"), **dict(zip(CHANGED[1:], rest))})


def changes(spark: SparkSession, path: str, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source", files_per_batch: int | None = None) -> DataFrame:
    """Signed counts (doc_id, part, mask, n) of all Parquet files under ``path``, taken as available-now micro-batches.

    Summed over all rows, n is the number of rows of that id and part which fail the filters of the mask. A batch
    takes as many files as the cluster has cores, unless said otherwise. State and progress lie in the shared folder:
    a lost executor repeats its tasks, and the sink's log keeps a file of a repeated task from counting twice. The
    number of states follows the number of rows, which Parquet's footers tell. States are kept by the session's state
    store (``spark.sql.streaming.stateStore.providerClass``): some 60 bytes a text, in memory by Spark's default, on
    disk with RocksDB, which is the one to set for billions of texts.
    """
    files_per_batch = files_per_batch or spark.sparkContext.defaultParallelism
    schema = spark.read.parquet(path).select(id_col, part_col, text_col).schema
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(f"{path[:-1]}[{path[-1]}]")  # a pattern may also name one file
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = rows.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    rows = rows.select(F.unhex(F.sha2("text", 256)).alias("key"), "doc_id", "part", own_mask(F.col("text")).alias("mask"))
    groups = spark.read.parquet(path).count() // TEXTS_OF_STATE + 1
    keyed = rows.mapInArrow(lambda batches: thinned(batches, groups), f"group long, kind int, key string, {CHANGES}").groupBy("group")
    changed = keyed.applyInPandasWithState(retracting, CHANGES, "held string", "append", GroupStateTimeout.NoTimeout)
    out = fresh_path(spark, "audit-changes")
    stream = changed.writeStream.outputMode("append").format("parquet").option("path", out)
    stream.option("checkpointLocation", fresh_path(spark, "audit-progress")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(CHANGES).parquet(out)


def report(changed: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step.

    ``labels`` (doc_id, quality, toxic) may hold an id more than once: one row with the mark is enough. Ids are summed
    before they meet their labels, so an id or a null that many rows share is a row for each part and mask.
    """
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id")
    marks = marks.agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    per_id = changed.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n")).where("n != 0")
    marked = per_id.join(marks, "doc_id", "left")
    counted = marked.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"), F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic")
    )
    plan = [(order, step + 1, BIT[order[step]], sum(BIT[x] for x in order[:step])) for order in ORDERS for step in range(len(order))]
    plan = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(b).alias("own"), F.lit(e).alias("earlier")) for o, s, b, e in plan])
    each = counted.withColumn("plan", F.explode(plan)).select("part", "mask", "n", "good", "toxic", "plan.*")
    fails, earlier = F.col("mask").bitwiseAND(F.col("own")) != 0, F.col("mask").bitwiseAND(F.col("earlier")) != 0
    removed, zero = fails & ~earlier, F.lit(0).cast("long")
    share = F.lit(math.factorial(len(FILTERS))).cast("long") / F.bit_count("mask")

    def total(where: Column, what: Column | str = "n") -> Column:
        return F.sum(F.when(where, F.col(what) if isinstance(what, str) else what).otherwise(zero)).cast("long")

    return each.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~earlier).alias("kept"), total(removed).alias("removed"), total(fails & earlier).alias("redundant"),
        total(F.col("mask") == F.col("own")).alias("unique_fails"), total(removed, "good").alias("good_lost"), total(removed, "toxic").alias("toxic_lost"),
        total(fails, F.col("n") * share.cast("long")).alias("shapley"),
    )


def audit(spark: SparkSession, path: str, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source", files_per_batch: int | None = None) -> DataFrame:
    """How five filters interact: columns part, filter_order, step and counts, for every part and all 120 orders.

    A: under 50 words. B: fewer than 65 distinct words of 100. C: more than 5 capitals A-Z of 100 code points.
    D: one of ``#$%&*|``. E: the text of a smaller id. Null texts count as empty, a null part as the empty string.
    Rows of an equal id and text count as first together; a row without an id never fails E and makes no other
    fail. Order and number of files, batches and repeated rows change nothing. An empty table gives no rows; other
    columns are not read.
    """
    return report(changes(spark, path, id_col, text_col, part_col, files_per_batch), labels)


SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least FROM documents
), words AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) AS capitals FROM texts
), fails AS (
  SELECT doc_id, part, len(w) < 50 AS a, 100 * len(list_distinct(w)) < 65 * len(w) AS b, 100 * capitals > 5 * length(t) AS c,
         regexp_matches(t, '[#$%&*|]') AS d, coalesce(doc_id > least, false) AS e FROM words
), marks AS (
  SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id
), counted AS (
  SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS mask, count(*) AS n,
         sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM fails LEFT JOIN marks USING (doc_id) GROUP BY ALL
), letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(l, bit)),
orders AS (
  SELECT p.l || q.l || r.l || s.l || t.l AS filter_order FROM letters p, letters q, letters r, letters s, letters t
  WHERE p.bit + q.bit + r.bit + s.bit + t.bit = 31 AND len(list_distinct([p.l, q.l, r.l, s.l, t.l])) = 5
), plan AS (
  SELECT filter_order, CAST(step AS INT) AS step,
         (SELECT bit FROM letters WHERE l = filter_order[step]) AS own,
         coalesce((SELECT sum(bit) FROM letters WHERE contains(filter_order[1:step - 1], l) AND step > 1), 0)::INT AS earlier
  FROM orders, range(1, 6) AS steps(step)
)
SELECT part, filter_order, step,
  CAST(sum(CASE WHEN mask & (own | earlier) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
  CAST(sum(CASE WHEN mask & own <> 0 AND mask & earlier = 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
  CAST(sum(CASE WHEN mask & own <> 0 AND mask & earlier <> 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
  CAST(sum(CASE WHEN mask = own THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
  CAST(sum(CASE WHEN mask & own <> 0 AND mask & earlier = 0 THEN good ELSE 0 END) AS BIGINT) AS good_lost,
  CAST(sum(CASE WHEN mask & own <> 0 AND mask & earlier = 0 THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost,
  CAST(sum(CASE WHEN mask & own <> 0 THEN n * (120 // bit_count(mask)) ELSE 0 END) AS BIGINT) AS shapley
FROM counted, plan GROUP BY part, filter_order, step
"""


@query("op11_interaction", SQL)
def op11_interaction(spark, sf_dir):
    return audit(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))
