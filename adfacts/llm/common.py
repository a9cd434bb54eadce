"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adfacts.session import shared_folder

# A word is a run of anything but the blank and the control characters 9 to 13.
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, and safe when executors go."""
    return df.sparkSession.read.parquet(_write(df, label))


def _write(df: DataFrame, label: str) -> str:
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


class Scratch:
    """Tables that are needed only within a ``with`` block; they are deleted at its end."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: list[str] = []

    def table(self, df: DataFrame, label: str) -> DataFrame:
        self.paths.append(_write(df, label))
        return self.spark.read.parquet(self.paths[-1])

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        hadoop = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in self.paths:
            path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(hadoop).delete(path, True)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted`` with as many underscores behind it as keep it apart from the columns of ``df``."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def whole_text(column: str = "text") -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def fold_share(doc_id: str, folds: int) -> Column:
    """crc32 of the id's text modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
