"""Warehouse tables on plain Parquet, kept in the session catalog.

Parquet has no row-level update, so a load computes a new state and puts it in
place of the old one:

* a small table is written to a new folder and the catalog entry is pointed at it;
* a partitioned table has only the partitions rewritten that the batch touches.

What a table is (its folder, columns and layout) is published beside the data, so
that a new session, whose catalog knows nothing, goes on with the same table.
"""

from __future__ import annotations

import json
import time
import uuid
from contextlib import nullcontext
from weakref import WeakKeyDictionary
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom.operators.checks import LoadRefused, refuse_repeated_keys
from ledgerloom.operators.scd2 import SLICE, with_slice
from ledgerloom.operators.upsert import drop_absent_children, sync_columns, upsert, upsert_known
from ledgerloom.session import DENSE, fresh_path, holding, remove, settle, writing

RANGE_COLUMN = "id_range"
RANGE_SIZE = 10_000_000
OTHER_IDS = 64
#: Ids beyond so many ranges are dealt into buckets like any other id, which bounds the partitions of a table.
RANGES = 100_000
#: So many partitions a task writes without the rows being dealt by partition before.
FEW_PARTITIONS, WRITERS = 6, "spark.sql.maxConcurrentOutputFileWriters"
#: Types that a batch may have where the table has a wider one.
WIDER = {("tinyint", "bigint"), ("smallint", "bigint"), ("int", "bigint"), ("float", "double"), ("int", "double"), ("void", "string")}


def id_range(key: str, size: int = RANGE_SIZE, other_ids: int = OTHER_IDS) -> Column:
    """Partition of a row by its key alone, so a key never changes partition.

    Numeric ids go by range: ids grow with time, so a daily batch touches few
    ranges. Any other id, and one past the last range, goes to one of ``other_ids`` negative buckets.
    """
    number = F.floor(F.col(key).try_cast("bigint") / size)
    other = -1 - F.pmod(F.xxhash64(F.col(key)), F.lit(other_ids))
    return F.when((number >= 0) & (number < RANGES), number).otherwise(other).cast("bigint")


class Warehouse:
    """Tables of one catalog database under one shared folder.

    ``range_size`` and ``other_ids`` decide the partition of a row. They are stored with each table that uses them,
    and a warehouse with others refuses to write it.
    """

    def __init__(self, spark: SparkSession, root: str, database: str, range_size: int = RANGE_SIZE, other_ids: int = OTHER_IDS):
        self.spark, self.root, self.database = spark, root.rstrip("/"), database
        self.layout = {"range_size": range_size, "other_ids": other_ids}
        self._landed: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{self.root}/catalog'")

    def _folder(self, path: str) -> list:
        """What a folder holds; nothing if it is not there."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        files = place.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        return list(files.listStatus(place)) if files.exists(place) else []

    def has_files(self, path: str) -> bool:
        return bool(self._folder(path))

    def _published(self, table: str) -> dict | None:
        """The last published description of a table: path, columns, partition column and layout."""
        folder = f"{self.root}/_published/{table}"
        done = sorted(s.getPath().getName() for s in self._folder(folder))
        for name in reversed(done):
            if any(s.getPath().getName() == "_SUCCESS" for s in self._folder(f"{folder}/{name}")):
                return json.loads(self.spark.read.text(f"{folder}/{name}").first()[0])
        return None

    def _publish(self, table: str, path: str, column: str | None) -> None:
        fields = [[f.name, f.dataType.simpleString()] for f in self.spark.table(self.name(table)).schema.fields]
        state = {"path": path, "fields": fields, "column": column, **(self.layout if column == RANGE_COLUMN else {})}
        if self._published(table) != state:
            row = self.spark.createDataFrame([(json.dumps(state),)], "value string")
            row.coalesce(1).write.text(f"{self.root}/_published/{table}/{time.time_ns():020d}")

    def _adopt(self, table: str) -> bool:
        """Take a published table into this session's catalog."""
        state = self._published(table)
        if state is None:
            if any(not s.getPath().getName().startswith("_") for s in self._folder(f"{self.root}/{table}")):
                raise LoadRefused(f"{self.root}/{table} holds data that was never published; a first load must not go over it")
            return False
        columns = ", ".join(f"`{name}` {kind}" for name, kind in state["fields"])
        partitioned = f" PARTITIONED BY (`{state['column']}`)" if state["column"] else ""
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({columns}) USING parquet{partitioned} LOCATION '{state['path']}'")
        if state["column"]:
            self.spark.sql(f"ALTER TABLE {self.name(table)} RECOVER PARTITIONS")
        return True

    def _fit(self, table: str, df: DataFrame) -> DataFrame:
        """The frame with the table's types where they are wider; any other difference raises before a file is written."""
        known = dict(self.spark.table(self.name(table)).dtypes)
        for name, kind in df.dtypes:
            if name in known and kind != known[name]:
                if (kind, known[name]) not in WIDER:
                    raise LoadRefused(f"column '{name}' of '{table}' is {known[name]} and arrived as {kind}")
                df = df.withColumn(name, F.col(f"`{name}`").cast(known[name]))
        return df

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.database}.{table}") or self._adopt(table)

    def read(self, table: str) -> DataFrame:
        """Current state of a table, without the column that only places its rows."""
        return self.spark.table(self.name(table)).drop(RANGE_COLUMN, SLICE)

    def read_slices(self, table: str) -> DataFrame | None:
        """A table of versions with the slice of each; none if the table is not there or not stored by slice."""
        stored = self.spark.table(self.name(table)) if self.exists(table) else None
        return stored if stored is not None and SLICE in stored.columns else None

    def read_or_none(self, table: str) -> DataFrame | None:
        return self.read(table) if self.exists(table) else None

    def land(self, df: DataFrame, label: str) -> DataFrame:
        """Write an intermediate result once and read it back, so later steps do not recompute it."""
        path = fresh_path(self.spark, label)
        landed = settle(df, label, path, DENSE)
        self._landed[landed] = path
        return landed

    def release(self, *frames: DataFrame | None) -> None:
        """Delete the files of landed frames whose load is done; any other frame is left alone."""
        for frame in frames:
            if frame is not None and (path := self._landed.pop(frame, None)):
                remove(self.spark, path)

    def replace(self, table: str, df: DataFrame) -> None:
        """Put a new state of a table in place that is one piece or stored by slice; the frame may read the old one."""
        if self.read_slices(table) is not None:
            slices = [row[0] for row in self.spark.table(self.name(table)).select(SLICE).distinct().collect()]
            self._put_slices(table, self.land(with_slice(df), table), SLICE, slices)
            return
        path = f"{self.root}/{table}/{uuid.uuid4().hex}"
        known = self.exists(table)
        if known:
            df = self._fit(table, df)
        with writing(self.spark):
            df.write.parquet(path, compression=DENSE)
        if known:
            self._add_columns(table, df)
            self.spark.sql(f"ALTER TABLE {self.name(table)} SET LOCATION '{path}'")
            self.spark.catalog.refreshTable(self.name(table))
        else:
            self._create(table, df, path, None)
        self._publish(table, path, None)

    def remove_superseded(self, table: str, hours: float = 24) -> int:
        """Delete the versions of an unpartitioned table that are not the current one and as old as that; gives their number.

        Readers that began before may still read a version, hence the hours.
        """
        state = self._published(table)
        if state is None or state["column"]:
            return 0
        gone = 0
        for status in self._folder(f"{self.root}/{table}"):
            path = status.getPath()
            if path.getName() != state["path"].rsplit("/", 1)[1] and status.getModificationTime() < (time.time() - 3600 * hours) * 1000:
                files = path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
                gone += bool(files.delete(path, True))
        return gone

    def upsert(self, table: str, batch: DataFrame, keys: Sequence[str], frozen: Sequence[str] = ()) -> None:
        """Upsert into an unpartitioned table, creating it on the first load. A batch that repeats a key raises."""
        landed = batch = self.land(batch, table)
        refuse_repeated_keys(batch, keys, table)
        if self.exists(table):
            batch = self._fit(table, batch)
        self.replace(table, upsert(self.read(table), batch, keys, frozen) if self.exists(table) else batch)
        self.release(landed)

    def upsert_ranges(
        self,
        table: str,
        batch: DataFrame,
        keys: Sequence[str],
        frozen: Sequence[str] = (),
        whole_parents: bool = False,
        keyed: DataFrame | None = None,
    ) -> None:
        """Upsert into a table partitioned by ranges of its first key; untouched ranges are neither read nor written.

        With ``whole_parents`` rows of a first-key value in the batch that the
        batch no longer holds are removed; otherwise they stay. ``keyed`` holds
        the keys of all rows of the batch, if they are cheaper to read there.
        """
        apart, keyed = keyed, batch if keyed is None else keyed
        refuse_repeated_keys(keyed, keys, table)
        place = id_range(keys[0], self.layout["range_size"], self.layout["other_ids"])
        batch = batch.withColumn(RANGE_COLUMN, place)
        # One row per touched partition: at most RANGES and the buckets of other ids.
        touched = [row[0] for row in keyed.select(place.alias(RANGE_COLUMN)).distinct().collect()]
        if not self.exists(table):
            self._overwrite_partitions(table, batch, RANGE_COLUMN, touched)
            return
        published = self._published(table) or {}
        if {k: published.get(k, v) for k, v in self.layout.items()} != self.layout:
            raise LoadRefused(f"'{table}' was laid out with {published}, not with {self.layout}")
        if not touched:
            return
        batch = self._fit(table, batch)
        old = self.spark.table(self.name(table)).filter(F.col(RANGE_COLUMN).isin(touched))
        untouched = None
        if apart is None:
            state = upsert(old, batch, keys, frozen)
        else:
            untouched = self.land(old.select(*keys).join(apart.select(*keys), list(keys), "left_anti"), "untouched")
            state = upsert_known(old, batch, keys, frozen, untouched)
        if whole_parents:
            state = drop_absent_children(state, batch, keys[0], keys)
        self._overwrite_partitions(table, state, RANGE_COLUMN, touched)
        self.release(untouched)

    def replace_slices(
        self, table: str, batch: DataFrame, column: str, keys: Sequence[str], slices: Sequence = (), keyed: DataFrame | None = None
    ) -> None:
        """Replace whole slices; a listed slice that the batch leaves out ends up empty.

        ``keyed`` holds the keys of all rows of the batch, if they are cheaper to read there; the slice is one of them.
        """
        refuse_repeated_keys(batch if keyed is None else keyed, keys, table)
        self._put_slices(table, batch, column, slices, keyed)

    def _put_slices(self, table: str, batch: DataFrame, column: str, slices: Sequence, keyed: DataFrame | None = None) -> None:
        if self.exists(table):
            batch = self._fit(table, sync_columns(batch, self.spark.table(self.name(table))))
        # One row per slice, and a batch covers one day.
        present = {row[0] for row in (batch if keyed is None else keyed).select(column).distinct().collect()}
        self._overwrite_partitions(table, batch, column, sorted(present))
        if slices:
            leaf = self.spark.table(self.name(table)).drop(column).limit(0)
            for value in set(slices) - present:
                leaf.write.mode("overwrite").parquet(f"{self.root}/{table}/{column}={value}")
            self.spark.catalog.refreshTable(self.name(table))

    def _overwrite_partitions(self, table: str, df: DataFrame, column: str, touched: Sequence) -> None:
        path = f"{self.root}/{table}"
        known = self.exists(table)
        if known:
            self._add_columns(table, df)
        # Rebalancing gives each partition few files and splits one that is large. Tasks that meet few partitions write
        # few files as it is, all of them open at once, so that rows are neither sent again nor sorted.
        few = len(touched) <= FEW_PARTITIONS
        writer = (df if few else df.hint("rebalance", column)).write.mode("overwrite").partitionBy(column)
        with writing(self.spark), holding(self.spark, WRITERS, str(FEW_PARTITIONS)) if few else nullcontext():
            writer.option("partitionOverwriteMode", "dynamic").parquet(path, compression=DENSE)
        if not known:
            self._create(table, df, path, column)
        # Only what was touched is told to the catalog; the rest of the table is not listed.
        for start in range(0, len(touched), 500):
            parts = " ".join(f"PARTITION (`{column}` = '{value}')" for value in touched[start : start + 500])
            self.spark.sql(f"ALTER TABLE {self.name(table)} ADD IF NOT EXISTS {parts}")
        self.spark.catalog.refreshTable(self.name(table))
        self._publish(table, path, column)

    def _create(self, table: str, df: DataFrame, path: str, column: str | None) -> None:
        fields = sorted(df.schema.fields, key=lambda f: f.name == column)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        partitioned = f" PARTITIONED BY (`{column}`)" if column else ""
        self.spark.sql(f"CREATE TABLE {self.name(table)} ({columns}) USING parquet{partitioned} LOCATION '{path}'")

    def _add_columns(self, table: str, df: DataFrame) -> None:
        known = set(self.spark.table(self.name(table)).columns)
        added = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name not in known]
        if added:
            self.spark.sql(f"ALTER TABLE {self.name(table)} ADD COLUMNS ({', '.join(added)})")
