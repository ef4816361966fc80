"""Session helpers: a tuned local session and the folder shared by all executors."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "ledgerloom", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benches, with a folder of its own; on a cluster use the session you are given."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ledgerloom-"))
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``; else one in the warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return (configured or f"{spark.conf.get('spark.sql.warehouse.dir')}/settled").rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/ledgerloom/{label}-{uuid.uuid4().hex}"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes of code beyond which the JVM interprets a method for good. Spark fuses a stage into one method, which for rows of
#: some forty cleaned columns is longer; told this limit, it runs such a stage as several methods that are compiled.
METHOD_LIMIT, COMPILED_BYTES = "spark.sql.codegen.hugeMethodLimit", "8000"
_lock, _held = threading.Lock(), {}


@contextmanager
def holding(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session while actions run, also in several threads: the first to come puts it, the last to go
    brings back what the session had."""
    with _lock:
        users, own = _held.get(key) or (0, spark.conf.get(key, None))
        spark.conf.set(key, value)
        _held[key] = users + 1, own
    try:
        yield
    finally:
        with _lock:
            users, own = _held[key]
            _held[key] = (users - 1, own) if users > 1 else None
            if users == 1:
                spark.conf.unset(key) if own is None else spark.conf.set(key, own)


def freeing_shuffles(spark: SparkSession):
    """Shuffle files of what runs meanwhile go as soon as it ends, not when the driver collects garbage."""
    return holding(spark, CLEANUP, "true")


@contextmanager
def writing(spark: SparkSession) -> Iterator[None]:
    """For an action that writes rows: shuffle files go as it ends, and no stage of wide rows is interpreted."""
    with freeing_shuffles(spark), holding(spark, METHOD_LIMIT, COMPILED_BYTES):
        yield


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate results that nothing will read again."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


#: Wide rows of text take some six tenths of the disk that the usual compression needs, in the same time.
DENSE = "zstd"


def settle(df: DataFrame, label: str, path: str | None = None, compression: str | None = None) -> DataFrame:
    """The frame written to the shared folder and read back.

    Cuts the lineage so that a lost executor does not mean computing it again,
    and gives the planner its true size, so a small one is broadcast by the
    session's own limit and a large one is not.
    """
    path = path or fresh_path(df.sparkSession, label)
    with writing(df.sparkSession):
        df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
