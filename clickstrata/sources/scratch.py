"""Intermediate tables in the folder that all executors share.

A range-sorted table must not be recomputed between two passes over it: a lost
executor would draw new range bounds and the passes would disagree. Such
tables are written once and read back.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession

CONF = "spark.checkpoint.dir"
_own: dict[str, str] = {}


def configured(spark: SparkSession) -> bool:
    """Whether the session names the shared folder."""
    return bool(spark.conf.get(CONF, None))


def use_folder(spark: SparkSession, folder: str) -> None:
    """The folder for a session that names none: the caller knows that all its executors reach it."""
    _own[spark.sparkContext.applicationId] = folder


def _root(spark: SparkSession) -> str:
    application = spark.sparkContext.applicationId
    folder = spark.conf.get(CONF, None) or _own.get(application)
    if not folder:
        raise RuntimeError(f"set {CONF} to a folder that all executors share")
    return f"{folder.rstrip('/')}/clickstrata-{application}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path of its own for an intermediate table."""
    return f"{_root(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to scratch once and return the stored table. Eager."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession, path: str | None = None) -> None:
    """Delete this application's intermediate tables, or the one at ``path``, once nothing reads them any more."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path or _root(spark))
    file_system = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    file_system.delete(jvm_path, True)
