"""Session helpers: a local session for tests and bench, and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
METHOD_LIMIT_DEFAULT = "65535"
#: Spark's setting to remove a query's shuffle files when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: str | int = "*", app: str = "tabloom", **conf: str) -> SparkSession:
    """A session for tests and bench. On a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def keep_code_compilable(spark: SparkSession) -> None:
    """Have Spark split generated methods the JVM would refuse to compile.

    HotSpot never compiles a method above 8000 bytes of bytecode. A projection
    of a hundred features fused into one method exceeds that and would run
    interpreted, several times slower. A limit set by the user is kept.
    """
    if spark.conf.get(METHOD_LIMIT) == METHOD_LIMIT_DEFAULT:
        spark.conf.set(METHOD_LIMIT, "8000")


def shared_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names.

    Only a local session, whose executors live on this machine, gets a
    temporary folder of its own when none is named. A cluster that names none
    is an error: there is no other place that all executors can read.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tabloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_run: list[str] = []


@contextmanager
def run_tables(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that ``materialise`` makes inside, when the block ends.

    Results must have been written or collected by then.
    """
    _run.append(uuid.uuid4().hex)
    folder = os.path.join(shared_folder(spark), "tabloom", *_run)
    try:
        yield
    finally:
        _run.pop()
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_cleaning = threading.Lock()
_cleaned_for: dict[int, tuple[int, str | None]] = {}


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that end inside leave no shuffle files.

    Only for queries that write what they compute, as nothing can be reused
    from their shuffles. Blocks may overlap in threads; the last one to end
    puts the setting back.
    """
    name = id(spark._jsparkSession)
    with _cleaning:
        depth, before = _cleaned_for.get(name, (0, spark.conf.get(SHUFFLE_CLEANUP, None)))
        _cleaned_for[name] = depth + 1, before
        spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        with _cleaning:
            depth, before = _cleaned_for.pop(name)
            if depth > 1:
                _cleaned_for[name] = depth - 1, before
            elif before is None:
                spark.conf.unset(SHUFFLE_CLEANUP)
            else:
                spark.conf.set(SHUFFLE_CLEANUP, before)


def materialise(df: DataFrame, partition_by: Sequence[str] = (), **options: str) -> DataFrame:
    """Compute ``df`` once and read it back, cutting its lineage.

    Used where a result feeds several jobs. Parquet in the shared folder
    survives the loss of executors and keeps column pruning for the readers;
    with ``partition_by`` readers of one value also skip the others' files;
    ``options`` are the writer's.
    The table stays there until ``run_tables`` ends, if one is open, or until
    its folder is cleared. Shuffle files of the computation go when it ends.
    """
    spark = df.sparkSession
    path = os.path.join(shared_folder(spark), "tabloom", *_run, uuid.uuid4().hex)
    with shuffles_removed(spark):
        df.write.options(**options).partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialise`` made, once nothing reads them any more.

    Whatever was computed from them must have been written by then.
    """
    for table in tables:
        for folder in {os.path.dirname(f) for f in table.inputFiles()}:
            path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_width(spark: SparkSession) -> int:
    """The configured number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
