"""Reading and writing landed files: raw JSON records, code lists and dated Parquet."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ledgerloom.functions.cleaning import parse_map
from ledgerloom.operators.shaping import append
from ledgerloom.session import writing

INGEST_ORDER = ["__file", "__block", "__row"]


def read_records(
    spark: SparkSession, path: str, schema: StructType | str, one_array: bool = False, ordered: bool = False
) -> DataFrame:
    """Landed JSON records with an explicit schema; a missing path or a record that is not JSON raises.

    One record per line is read in parallel. ``one_array`` reads a file that
    holds a single JSON array, which cannot be split. ``ordered`` adds the
    position in the landing (``INGEST_ORDER``) for first-wins rules.
    """
    df = spark.read.schema(schema).option("multiLine", one_array).option("mode", "FAILFAST").json(path)
    if not ordered:
        return df
    names = df.columns
    return df.select(
        *names,
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__row"),
    )


def write_records(df: DataFrame, path: str, compression: str | None = None, file_records: int = 0) -> None:
    """Write records as JSON lines, UTF-8 as is; compressed on request, then with so many records a file that one task can read it."""
    with writing(df.sparkSession):
        df.write.mode("overwrite").option("maxRecordsPerFile", file_records).json(path, compression=compression)


def read_lookup(
    spark: SparkSession, path: str, code: str, description: str, one_object: bool = True
) -> DataFrame:
    """JSON objects of code to description, as a two-column frame; an unreadable object raises.

    The file is one object; with ``one_object=False`` every line is one, which is read in parallel.
    """
    text = spark.read.text(path, wholetext=one_object)
    return text.select(F.explode(parse_map(F.col("value"), strict=True)).alias(code, description))


def write_dated(df: DataFrame, path: str, day: str) -> None:
    """Write a processed table by day; only the days in the frame are replaced."""
    # Rebalancing gives each day few files, whatever the number of tasks, and splits a day that is large.
    writer = df.hint("rebalance", day).write.mode("overwrite").partitionBy(day)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def latest_slice(df: DataFrame, day: str) -> DataFrame:
    """Rows of the newest day in the table; a table without a day raises."""
    newest = df.agg(F.max(day)).first()[0]
    if newest is None:
        raise FileNotFoundError(f"there is no slice by '{day}' yet")
    return df.filter(F.col(day) == F.lit(newest))


def read_latest(spark: SparkSession, path: str, day: str) -> DataFrame:
    """The newest day of a table written by ``write_dated``, found in the list of its folders; without one it raises."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    names = [status.getPath().getName() for status in files.listStatus(root)] if files.exists(root) else []
    days = sorted(name.removeprefix(f"{day}=") for name in names if name.startswith(f"{day}=") and not name.endswith("__HIVE_DEFAULT_PARTITION__"))
    if not days:
        raise FileNotFoundError(f"there is no slice by '{day}' in {path}")
    return spark.read.option("basePath", path).parquet(f"{path}/{day}={days[-1]}")


def stamp_slice(df: DataFrame, column: str, code: object) -> DataFrame:
    """Mark every record with the slice it came from, over any field of that name."""
    return df.withColumn(column, F.lit(code))


def union_slices(slices: Mapping[object, DataFrame], column: str, rank: str | None = None) -> DataFrame:
    """All slices, each stamped with its code and, on request, its place in the order."""
    stamped = []
    for place, (code, df) in enumerate(slices.items()):
        marked = stamp_slice(df, column, code)
        stamped.append(marked if rank is None else marked.withColumn(rank, F.lit(place)))
    return append(*stamped)


def open_invoices(df: DataFrame, status: str = "codigo_situacao", open_code: int = 2) -> DataFrame:
    """All invoices with the open status, whatever their age."""
    return df.filter(F.col(status) == open_code)
