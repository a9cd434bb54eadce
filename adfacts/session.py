"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings the results rely on, plus adaptive execution. Cluster sizing
# (executors, memory, shuffle partitions) is left to spark-submit.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


# The JVM never compiles a longer method, in bytes of code: it interprets it for every row. Spark
# writes one such method for each stage over the 65 columns of a feature table.
LONGEST_COMPILED_METHOD = "8000"
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def build_session(app_name: str, **overrides: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SESSION_SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """Within it Spark leaves stages to its plain operators where their one method would be too long
    to be compiled. A limit that the session has been given stays."""
    if spark.conf.get(METHOD_LIMIT, None) is not None:
        yield
        return
    spark.conf.set(METHOD_LIMIT, LONGEST_COMPILED_METHOD)
    try:
        yield
    finally:
        spark.conf.unset(METHOD_LIMIT)


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets one temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="adfacts-checkpoint-"))
    return spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


_scope: ContextVar[Scratch | None] = ContextVar("scratch", default=None)


class Scratch:
    """A scope whose tables in the shared folder are deleted at its end, also after a failure.

    Within ``with Scratch(spark):`` everything that ``write_shared`` writes belongs to the innermost
    scope. Outside any scope tables stay.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: list[str] = []

    def __enter__(self) -> Scratch:
        self._outer = _scope.set(self)
        return self

    def __exit__(self, *_: object) -> None:
        _scope.reset(self._outer)
        for path in self.paths:
            delete_folder(self.spark, path)


def write_shared(df: DataFrame, label: str) -> str:
    """Write ``df`` as a Parquet table of its own in the shared folder; returns its path."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    scope = _scope.get()
    if scope is not None:
        scope.paths.append(path)  # before writing: a write that fails leaves files too
    df.write.parquet(path)
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and safe when executors go."""
    return df.sparkSession.read.schema(df.schema).parquet(write_shared(df, label))


def _file_system(spark: SparkSession, path: str) -> tuple:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def delete_folder(spark: SparkSession, path: str) -> None:
    files, folder = _file_system(spark, path)
    files.delete(folder, True)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    files, folder = _file_system(spark, path)
    return int(files.getContentSummary(folder).getLength())


def move_folder(spark: SparkSession, source: str, target: str) -> bool:
    """Rename within one file system, making the target's parent; False if there is no source."""
    files, folder = _file_system(spark, source)
    if not files.exists(folder):
        return False
    _, goal = _file_system(spark, target)
    files.mkdirs(goal.getParent())
    if not files.rename(folder, goal):
        raise OSError(f"{source} cannot be renamed to {target}")
    return True
