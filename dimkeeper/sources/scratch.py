"""Intermediate tables in a folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_made: dict[str, list[str]] = {}


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, or where that is unset in the session's warehouse.

    ``release`` removes it; until then it belongs to the application that asked for it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{base.rstrip('/')}/dimkeeper-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(folder)
    return folder


def store(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` written as parquet and read back, and the folder it lies in."""
    spark = df.sparkSession
    path = scratch_dir(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def materialise(df: DataFrame) -> DataFrame:
    """``df`` written as parquet and read back: evaluated once, and safe if an executor is lost."""
    return store(df)[0]


@contextmanager
def materialised(df: DataFrame) -> Iterator[DataFrame]:
    """The same for the time of a ``with`` block, after which the stored rows are removed."""
    stored, path = store(df)
    try:
        yield stored
    finally:
        discard(df.sparkSession, path)


def discard(spark: SparkSession, *folders: str) -> None:
    """Remove folders that ``scratch_dir`` gave; frames that read them are void then."""
    made = _made.get(spark.sparkContext.applicationId, [])
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        if folder in made:
            made.remove(folder)


def release(spark: SparkSession) -> None:
    """Remove what this application has stored for its own use; frames that read it are void then."""
    discard(spark, *list(_made.get(spark.sparkContext.applicationId, [])))
