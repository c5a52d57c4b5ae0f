"""A folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


_FOLDER: ContextVar[str] = ContextVar("folder", default="")


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where that is unset, as in tests on one machine, a new one of our own.

    On a cluster a local folder is of no use to the executors, so that an unset one is an error there.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.partition("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="terraflux-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, below one of this application, which clear_scratch() deletes."""
    return f"{_own(spark)}/{_FOLDER.get()}{name}-{uuid.uuid4().hex}"


@contextmanager
def step_scratch(spark: SparkSession, name: str) -> Iterator[None]:
    """What is put into the shared folder inside is deleted at the end: for a step whose result is written before that.

    Only this step's own files go, whatever else runs in the application.
    """
    token = _FOLDER.set(f"{_FOLDER.get()}{name}-{uuid.uuid4().hex}/")
    folder = f"{_own(spark)}/{_FOLDER.get()}".rstrip("/")
    try:
        yield
    finally:
        _FOLDER.reset(token)
        drop(spark, folder)


def once(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back: for what several steps of a job need, so that it is worked out once
    and a lost executor costs nothing above it."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Deletes what this application has put into the shared folder. Results that are not written yet read from there."""
    drop(spark, _own(spark))


def drop(spark: SparkSession, folder: str) -> None:
    """Deletes a folder of scratch files; one that is not there is no error."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _own(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/terraflux-{spark.sparkContext.applicationId}"
