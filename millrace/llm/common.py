"""Small helpers that several operators share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


_own: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; where that is unset, in a temporary one if the master is local."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="millrace-"))
        base = _own[0]
    return f"{base.rstrip('/')}/millrace-{uuid.uuid4().hex}"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: its lineage ends there,
    and the shuffle files that it took are deleted as soon as it is written."""
    spark = df.sparkSession
    path, before = shared_dir(spark), spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._millrace_path = path
    return out


def drop(df: DataFrame) -> None:
    """Delete what :func:`cut` wrote."""
    spark = df.sparkSession
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(df._millrace_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Scratch:
    """Tables that :func:`cut` writes inside a ``with`` block, which deletes them at its end."""

    def __enter__(self) -> Scratch:
        self.made: list[DataFrame] = []
        return self

    def __exit__(self, *_) -> None:
        for df in self.made:
            drop(df)

    def cut(self, df: DataFrame) -> DataFrame:
        return self.hold(cut(df))

    def hold(self, df: DataFrame) -> DataFrame:
        """Delete the table of ``df``, which :func:`cut` wrote, at the end of the block."""
        self.made.append(df)
        return df
