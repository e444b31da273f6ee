"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Settings the jobs in this package are written for.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Streaming state lives outside the heap, and a sender's neighbouring events
    # merge inside each task, so that a busy sender does not move row by row.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def get_session(app: str = "broadsheet", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A folder of our own is made only on a local master where the setting is
    absent; a cluster without the setting is an error, because a machine-local
    folder would lose data together with its executor.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="broadsheet-"))
    return context.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/broadsheet/{label}-{uuid.uuid4().hex}"


#: Shuffle files of a finished write are of no use to anyone; without this they stay until the driver's next collection of garbage.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_written = threading.local()


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """A block whose writes drop their shuffle files when they are done."""
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_UP, before)


def materialise(df: DataFrame, label: str = "table", codec: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    Cuts lineage for iterative jobs and fixes the result of steps that must not
    be computed twice (paid scoring calls, range partitioning). Unlike an RDD
    checkpoint the written table keeps column pruning and filter pushdown. The
    write's shuffle files go when it is done. ``codec`` replaces the session's
    Parquet compression; "zstd" pays where rows are text.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    with tidy(spark):
        df.write.parquet(path, compression=codec)
    table = spark.read.schema(df.schema).parquet(path)
    table._written_to = path
    for folders in getattr(_written, "scopes", [])[-1:]:
        folders.add(path)
    return table


def discard(table: DataFrame) -> None:
    """Delete a table that :func:`materialise` has written and that nothing reads any more."""
    _delete(table.sparkSession, table._written_to)
    for folders in getattr(_written, "scopes", []):
        folders.discard(table._written_to)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def intermediate(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A block whose materialised tables are deleted at its end, except those passed through the function it gives.

    What the block hands on must be a kept table, or read kept tables only. Kept tables belong to the block around, if there is one.
    """
    scopes = _written.__dict__.setdefault("scopes", [])
    own: set[str] = set()
    scopes.append(own)

    def keep(table: DataFrame) -> DataFrame:
        own.discard(table._written_to)
        for around in scopes[-2:-1]:
            around.add(table._written_to)
        return table

    try:
        yield keep
    finally:
        scopes.remove(own)
        for path in own:
            _delete(spark, path)


def metered(df: DataFrame, label: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """:func:`materialise`, and ``metrics`` over all rows, aggregated in the pass that writes them."""
    seen = Observation(label)
    table = materialise(df.observe(seen, *[value.alias(name) for name, value in metrics.items()]), label, "zstd")
    return table, seen.get


def read_if_there(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The Parquet table at ``path``, or None if nothing was ever written there; any other failure is raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def spread(scan: DataFrame) -> DataFrame:
    """Spread the rows of a small scan over all cores; larger scans stay as they are.

    A row group is read by one task, so a small table in one file would keep one
    core busy with all its text. Spark cuts a scan into more pieces than cores
    only from 128 MB per core, and such a scan is not shuffled here.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() <= cores else scan
