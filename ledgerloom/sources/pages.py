"""Flattening landed API pages into records.

A landed page is a row (slice, page number, body). Every record that was landed
is kept. A client stops asking for more at a page that is empty, short, or
reaches the declared total; pages landed behind such a point, and slices that
hold less than was declared, are reported, not dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.operators.running import running_total

STRICT = {"mode": "FAILFAST"}


def _read_bodies(pages: DataFrame, body: str, record_ddl: str, items_key: str, total_key: str | None = None) -> DataFrame:
    """Items, their count and the declared total of each page; a body that is missing or not JSON raises."""
    missing = F.raise_error(F.lit(f"a landed page has no '{body}'")).cast("string")
    text = F.when(F.trim(F.col(body)) != "", F.col(body)).otherwise(missing)
    is_list = F.ltrim(text).startswith("[")
    total = f", `{total_key}`: bigint" if total_key else ""
    document = F.when(~is_list, F.from_json(text, f"struct<`{items_key}`: array<{record_ddl}>{total}>", STRICT))
    items: Column = F.when(is_list, F.from_json(text, f"array<{record_ddl}>", STRICT)).otherwise(document[items_key])
    declared = document[total_key] if total_key else F.lit(None).cast("bigint")
    return pages.withColumns({"__items": items, "__declared": declared}).withColumn(
        "__count", F.coalesce(F.size("__items"), F.lit(0)).cast("bigint")
    )


def flatten_pages(
    pages: DataFrame, record_ddl: str, items_key: str, slice_column: str = "slice", page: str = "page", body: str = "body"
) -> DataFrame:
    """Records of all landed pages, with slice, page and position. A body may be an object or a bare list."""
    parsed = _read_bodies(pages, body, record_ddl, items_key)
    records = parsed.select(slice_column, page, F.posexplode("__items").alias("position", "__record"))
    return records.select(slice_column, page, "position", "__record.*")


def _declared(parsed: DataFrame, slice_column: str, page: str) -> DataFrame:
    """Per slice the total of its first page that declares one, and that page."""
    known = parsed.filter("__declared is not null").groupBy(slice_column)
    return known.agg(F.min_by("__declared", page).alias("declared"), F.min(page).alias("__known_from"))


def pages_behind_stop(
    pages: DataFrame,
    record_ddl: str,
    items_key: str,
    page_size: int,
    total_key: str | None = None,
    slice_column: str = "slice",
    page: str = "page",
    body: str = "body",
) -> DataFrame:
    """Slices with pages behind the one at which a client would have stopped, and how many records those hold.

    A page stops if it holds fewer than ``page_size`` records or, from the page on that declares a total, if the
    records up to it reach that total. Only page numbers and counts travel, never the bodies.
    """
    counts = _read_bodies(pages, body, record_ddl, items_key, total_key).select(slice_column, page, "__count", "__declared")
    totals = _declared(counts, slice_column, page).withColumnRenamed(slice_column, "__slice")
    summed = running_total(counts, slice_column, page, "__count", "__seen")
    known = summed.join(totals, summed[slice_column].eqNullSafe(totals["__slice"]), "left")
    reached = F.coalesce((F.col(page) >= F.col("__known_from")) & (F.col("__seen") >= F.col("declared")), F.lit(False))
    stops = (F.col("__count") < page_size) | reached
    last = known.groupBy(slice_column).agg(F.min(F.when(stops, F.col(page))).alias("last_page"))
    last = last.filter("last_page is not null").withColumnRenamed(slice_column, "__slice")
    behind = counts.join(last, counts[slice_column].eqNullSafe(last["__slice"])).filter(F.col(page) > F.col("last_page"))
    return behind.groupBy(slice_column, "last_page").agg(
        F.count(F.lit(1)).alias("pages_behind"), F.sum("__count").alias("records_behind")
    )


def total_shortfall(
    pages: DataFrame,
    record_ddl: str,
    items_key: str,
    total_key: str,
    slice_column: str = "slice",
    page: str = "page",
    body: str = "body",
) -> DataFrame:
    """Declared and received number of records per slice and whether some are missing; bodies are read once."""
    counts = _read_bodies(pages, body, record_ddl, items_key, total_key).groupBy(slice_column)
    first = F.min_by("__declared", F.when(F.col("__declared").isNotNull(), F.col(page)))
    report = counts.agg(first.alias("declared"), F.sum("__count").alias("received")).filter("declared is not null")
    return report.withColumn("complete", F.col("received") >= F.col("declared"))
