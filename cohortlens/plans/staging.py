"""Cut lineage by writing a table into the cluster's shared checkpoint folder."""

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Session setting that names the folder where ``spark.checkpoint.dir`` is unset.
FOLDER_SETTING = "cohortlens.staging.dir"
_run: ContextVar[str | None] = ContextVar("staging_run", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``, else ``cohortlens.staging.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(FOLDER_SETTING, None)
    if not folder:
        raise ValueError(f"set spark.checkpoint.dir (or {FOLDER_SETTING}) to a folder that all executors share")
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{_run.get() or shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that several later jobs read, and read it back with its columns prunable."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staging_run(spark: SparkSession) -> Iterator[None]:
    """Whatever is staged inside goes to a folder of its own, which is deleted at the end.

    Frames made inside must not be used afterwards.
    """
    if _run.get():
        yield
        return
    folder = f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"
    token = _run.set(folder)
    try:
        yield
    finally:
        _run.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
