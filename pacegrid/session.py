"""Session defaults and the shared folder for staged tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import ExitStack, contextmanager

from pyspark.sql import DataFrame, SparkSession

# Small documents are packed many to a task: opening one costs far less than the
# 4 MB Spark assumes, so a task reads about 128 MB / 256 KB documents.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.files.openCostInBytes": "262144",
    # Explicit paths are listed in tasks; many each, not one.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "200",
}


#: What one task of a write within `small_tasks` takes of shuffled bytes and of files.
SMALL_TASKS = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m", "spark.sql.files.maxPartitionBytes": "32m"}
#: Bytecodes of generated code beyond which expressions are compiled apart; the JVM never compiles longer methods.
COMPILED = {"spark.sql.codegen.hugeMethodLimit": "8000"}
#: Shuffle files go when the write that made them is over, not when the driver next collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "pacegrid", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, for staged tables and checkpoints.

    The cluster names it in `spark.checkpoint.dir`. Only a local session may go
    without; it gets a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pacegrid-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_root(spark: SparkSession) -> str:
    """Folder of this application's staged tables."""
    return f"{shared_dir(spark)}/pacegrid/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; never one used before."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def _set(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@contextmanager
def small_tasks(spark: SparkSession) -> Iterator[None]:
    """Writes made in here are dealt out in small tasks, and leave no shuffle files behind.

    JSON texts and sample arrays compress ten to thirty times, and tasks are cut by compressed
    bytes: a task of the usual size sorts gigabytes. Settings that are smaller already stay.
    """
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    with ExitStack() as settings:
        settings.enter_context(_set(spark, SHUFFLE_CLEANUP, "true"))
        for name, most in SMALL_TASKS.items():
            if size(spark.conf.get(name)) > size(most):
                settings.enter_context(_set(spark, name, most))
        for name, limit in COMPILED.items():
            settings.enter_context(_set(spark, name, limit))
        yield


@contextmanager
def together(spark: SparkSession, folders: int) -> Iterator[None]:
    """Tasks that write to at most so many folders do so at once, without sorting their rows by folder."""
    with _set(spark, "spark.sql.maxConcurrentOutputFileWriters", str(folders)):
        yield


def write_stage(frame: DataFrame, path: str) -> DataFrame:
    """`frame` written for the readers of this run alone, and read back."""
    with small_tasks(frame.sparkSession):
        frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def stored(frame: DataFrame, label: str) -> DataFrame:
    """`frame` written to the shared folder and read back, so that its real size is known.

    A join with a narrow stored frame moves the other side only if the frame is too large
    to broadcast.
    """
    return write_stage(frame, scratch_path(frame.sparkSession, label))


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete all staged tables of this application, once nothing reads them any more."""
    delete_folder(spark, scratch_root(spark))


@contextmanager
def scratch_cleared(spark: SparkSession) -> Iterator[None]:
    """Delete what is staged in a run once it ends, also by an error.

    Frames that a run returns read staged tables: store or show them inside.
    """
    try:
        yield
    finally:
        clear_scratch(spark)
