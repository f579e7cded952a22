"""Leak-free splits by source family."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import fingerprint


def hash_split(family: Column | str) -> Column:
    """train, val or benchmark by the family's hash: 80, 10 and 10 in a hundred."""
    quoted = F.concat(F.lit('"'), F.col(family) if isinstance(family, str) else family, F.lit('"'))
    bucket = F.conv(F.substring(F.sha2(quoted, 256), 1, 8), 16, 10).cast("bigint") % 100
    return F.when(bucket < 80, "train").when(bucket < 90, "val").otherwise("benchmark")


def assign_split(rows: DataFrame, recorded: DataFrame, *, family: str = "family", explicit: str = "split") -> DataFrame:
    """``rows`` with ``split``: the row's own, else the family's recorded one (family, recorded_split), else by hash."""
    joined = rows.join(recorded, family, "left")
    return joined.withColumn(explicit, F.coalesce(explicit, "recorded_split", hash_split(family))).drop("recorded_split")


def split_conflicts(rows: DataFrame, *, family: str = "family", split: str = "split") -> DataFrame:
    """Families that lie in more than one split."""
    return rows.groupBy(family).agg(F.count_distinct(split).alias("n_splits"), F.min(split).alias("first_split")).where("n_splits > 1")


def leaked_prompts(train: DataFrame, held: DataFrame, *, text: str = "prompt") -> DataFrame:
    """Held-out rows whose fingerprint is also in ``train``: hashes meet, then the texts are compared."""
    ours = train.select(F.xxhash64(fingerprint(text)).alias("h"), fingerprint(text).alias("f")).distinct()
    theirs = held.withColumn("f", fingerprint(text)).withColumn("h", F.xxhash64("f"))
    return theirs.join(ours, ["h", "f"], "left_semi").drop("h", "f")


def leaked_families(train: DataFrame, held: DataFrame, *, family: str = "family") -> DataFrame:
    return held.select(family).distinct().join(train.select(family), family, "left_semi")
