"""Intermediate tables in the shared folder that the session names.

A written table cuts lineage in a way that survives lost executors, is read back
with column pruning, and gives Spark its real size for join planning.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: The folder of the run in progress, below the application's.
_run: ContextVar[str] = ContextVar("run", default="")


def scratch_root(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``, which must be set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return f"{root.rstrip('/')}/leadlift-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return "/".join(filter(None, (scratch_root(spark), _run.get(), f"{name}-{uuid.uuid4().hex}")))


def materialise(
    df: DataFrame, name: str = "table", read_schema: T.StructType | None = None, codec: str | None = None
) -> DataFrame:
    """Write ``df`` once and read it back.

    ``codec`` packs the files otherwise than the session does. ``read_schema`` reads the same bytes under another declared type, e.g. a struct
    column as a vector.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(read_schema or df.schema).parquet(path)


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_scratch(spark: SparkSession) -> None:
    """Remove this application's intermediate tables, once nothing reads them any more."""
    _remove(spark, scratch_root(spark))


@contextmanager
def run_scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables made inside are removed at the end, also of a run that fails."""
    token = _run.set(f"run-{uuid.uuid4().hex}")
    folder = f"{scratch_root(spark)}/{_run.get()}"
    try:
        yield
    finally:
        _run.reset(token)
        _remove(spark, folder)
