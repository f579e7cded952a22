"""Tables written to the shared folder in the middle of a job."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_own: list[str] = []


def scratch(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; below a temporary one where that is unset and the master is local."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="millrace-"))
        base = _own[0]
    return f"{base.rstrip('/')}/settled-{uuid.uuid4().hex}"


def settle(df: DataFrame, by: str | None = None) -> DataFrame:
    """Write ``df`` to a folder of its own and read it again: its lineage ends there. With ``by`` each of its values has a folder below."""
    path = scratch(df.sparkSession)
    (df.repartition(by).write.partitionBy(by) if by else df.write).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._millrace_path = path
    return out


def _located(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def unsettle(df: DataFrame) -> None:
    """Delete what :func:`settle` wrote."""
    files, at = _located(df.sparkSession, df._millrace_path)
    files.delete(at, True)


def exists(spark: SparkSession, path: str) -> bool:
    files, at = _located(spark, path)
    return files.exists(at)
