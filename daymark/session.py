"""Session settings and the folders a job may write intermediate data to."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

TASK_BYTES = 128 << 20  # data one task should handle; fits an executor core's share of memory with room to sort


def local_session(name: str = "daymark", cores: str | int = "*") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    partitions = "8" if cores == "*" else str(cores)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        # The endpoint alone needs more generated classes than the default cache of 100 holds; compiling them anew on
        # every run costs more than the work itself when a session runs many queries.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .getOrCreate()
    )


def shuffle_settings(input_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a job over ``input_bytes`` of files: an ample number of shuffle partitions to start from, which AQE
    merges to ``TASK_BYTES`` each, so that the size per task does not grow with the input."""
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TASK_BYTES),
        "spark.sql.files.maxPartitionBytes": str(TASK_BYTES),
        "spark.sql.shuffle.partitions": str(max(2 * cores, -(-input_bytes // TASK_BYTES))),
    }


def apply_unless_set(spark: SparkSession, settings: dict[str, str]) -> None:
    """Settings the user has not made, by ``spark-submit`` or in the session."""
    made = spark.conf.getAll
    for name, value in settings.items():
        if name not in made:
            spark.conf.set(name, value)


def folder_bytes(spark: SparkSession, folder: str) -> int:
    """Size of the files below a folder; only their listing is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.agg({"length": "sum"}).first()[0] or 0


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir`` or set on the context; only a local session may do without."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):  # executors of local-cluster are other processes
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return tempfile.mkdtemp(prefix="daymark-")


_in_scope: ContextVar[list[str] | None] = ContextVar("folders of the innermost scratch scope", default=None)


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """Path of a folder that does not exist yet, below the shared folder."""
    path = f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
    if (folders := _in_scope.get()) is not None:
        folders.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes the folders that were asked for within, at the end. Frames made within may read them, so what is to last
    must be written by then."""
    folders: list[str] = []
    token = _in_scope.set(folders)
    try:
        yield
    finally:
        _in_scope.reset(token)
        for path in folders:
            remove_folder(spark, path)


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Other settings of the session for a while."""
    before = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder the job itself made."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def stored(df: DataFrame) -> DataFrame:
    """The rows of ``df`` from a table written to the shared folder: computed once, also if an executor is lost."""
    path = fresh_folder(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
