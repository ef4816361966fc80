"""Files that hold one JSON array of records each, read in parallel however large a file is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ledgerloom.operators.running import running_total
from ledgerloom.sources.landed import INGEST_ORDER
from ledgerloom.session import settle

_STRINGS = r'"[^"]*("|$)'
_UP, _DOWN = "{[", "]"


def _count(text: Column, signs: str) -> Column:
    return F.length(text) - F.length(F.translate(text, signs, ""))


def _depth(bare: Column) -> Column:
    """By how much the nesting grows in text without strings."""
    return (_count(bare, _UP) - _count(bare, _DOWN)).cast("bigint")


def read_array(spark: SparkSession, path: str, schema: StructType | str, ordered: bool = False) -> DataFrame:
    """The records of all files under ``path``, each of which is one JSON array of objects.

    As ``read_records`` with ``one_array``, but a file is read by as many tasks as it has splits. The text is cut at
    every closing brace, wherever that stands, so no task knows at first whether it begins inside a string or how deep.
    Each piece therefore tells both what it would do outside and inside a string, and how many quotes it has. The
    running number of quotes says which holds, the running depth where a record of the outer array ends, and the running
    number of ends which record a piece belongs to; these are sums over blocks, whatever the size of the file. Pieces of
    one record meet by its number. (An escape never reaches across a cut, as a brace is not escaped in JSON.)

    An empty file or array has no records. Anything but objects in the array, text before or behind it, an array that is
    not closed and a record that does not fit raise. ``ordered`` adds the place in the landing (``INGEST_ORDER``).
    """
    text = spark.read.option("lineSep", "}").text(path)
    cut = text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("id"), F.col("value").alias("piece"),
    )
    plain = F.regexp_replace("piece", r"\\.", "")
    outside = F.regexp_replace(plain, _STRINGS, "")
    inside = F.regexp_replace(F.regexp_replace(plain, r'^[^"]*("|$)', ""), _STRINGS, "")
    told = cut.withColumns({"quotes": _count(plain, '"').cast("bigint"), "out": _depth(outside), "in": _depth(inside)})
    told = settle(told, "pieces")
    # A split has fewer pieces than bytes, so its first byte and the piece's number within it give the order.
    firsts = told.groupBy("file", "start").agg(F.min("id").alias("first"))
    placed = told.join(firsts, ["file", "start"]).withColumn("at", F.col("start") + F.col("id") - F.col("first"))
    narrow = placed.select("file", "at", "quotes", "out", "in")
    narrow = running_total(narrow, "file", "at", "quotes", "quoted")
    begins_inside, ends_inside = (F.col("quoted") - F.col("quotes")) % 2 == 1, F.col("quoted") % 2 == 1
    step = F.when(begins_inside, F.col("in")).otherwise(F.col("out")) - F.when(ends_inside, 0).otherwise(1)
    narrow = running_total(settle(narrow.select("file", "at", step.alias("step"), ends_inside.alias("string")), "steps"), "file", "at", "step", "depth")
    ends = (~F.col("string") & (F.col("depth") == 1)).cast("bigint")
    narrow = running_total(settle(narrow.select("file", "at", ends.alias("end")), "ends"), "file", "at", "end", "record")
    numbered = narrow.select("file", "at", (F.col("record") - F.col("end")).alias("record"), "end")
    pieces = placed.select("file", "at", "piece").join(numbered, ["file", "at"])
    # A file that ends with a brace has nothing left to close its array with: an empty piece says so.
    tails = narrow.groupBy("file").agg((F.max("at") + 1).alias("at"), F.max("record").alias("record"), F.max_by("end", "at").alias("last"))
    pieces = pieces.unionByName(tails.filter("last = 1").select("file", "at", F.lit("").alias("piece"), "record", F.lit(0).cast("bigint").alias("end")))
    whole = pieces.groupBy("file", "record").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "piece"))), lambda p: p["piece"]), "}").alias("text"),
        F.max("end").alias("closed"),
    )
    first = F.when(F.col("record") == 0, r"(?s)^\s*\[\s*\{.*").otherwise(r"(?s)^\s*,\s*\{.*")
    rest = F.when(F.col("record") == 0, r"^\s*(\[\s*\]\s*)?$").otherwise(r"^\s*\]\s*$")
    right = F.when(F.col("closed") == 1, F.regexp_like("text", first)).otherwise(F.regexp_like("text", rest))
    message = F.concat(F.lit("MALFORMED_ARRAY: "), F.col("file"), F.lit(" is not one array of objects at record "), F.col("record").cast("string"))
    checked = whole.withColumn("text", F.when(right, F.col("text")).otherwise(F.raise_error(message).cast("string")))
    body = F.concat(F.regexp_replace("text", r"^\s*[\[,]\s*", ""), F.lit("}"))
    # What is left behind the last record has no record of its own, but is looked at all the same.
    parsed = checked.withColumn("body", F.when(F.col("closed") == 1, body).when(F.length("text") < 0, "")).filter("body is not null")
    made = schema if isinstance(schema, str) else schema.simpleString()
    rows = parsed.select("file", "record", F.from_json("body", made, {"mode": "FAILFAST"}).alias("r"))
    shown = [F.col("r.*")]
    if ordered:
        shown += [c.alias(name) for c, name in zip((F.col("file"), F.lit(0).cast("bigint"), F.col("record")), INGEST_ORDER)]
    return rows.select(*shown)
