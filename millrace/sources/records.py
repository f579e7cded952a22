"""Readers and writers of record files: strict JSON lines, journals, banks, CSV, pinned binaries, fingerprints."""

from __future__ import annotations

import csv
import hashlib
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_records(spark: SparkSession, path: str, schema: T.StructType, *, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects with file, raw text and reason) of JSON lines.

    A line must be one object, without NaN or Infinity and without fields that the
    schema doesn't have. Blank lines give no row. ``strict`` raises if a line is rejected.
    """
    raw = spark.read.text(path).where("trim(value) <> ''").select(F.col("_metadata.file_path").alias("file"), "value")
    parsed = raw.withColumn("row", F.from_json("value", T.StructType([*schema.fields, T.StructField("_bad", T.StringType())]), {"columnNameOfCorruptRecord": "_bad", "allowNonNumericNumbers": "false", "mode": "PERMISSIVE"}))
    unknown = F.size(F.array_except(F.coalesce(F.json_object_keys("value"), F.array().cast("array<string>")), F.array(*(F.lit(f.name) for f in schema.fields)))) > 0
    reason = F.when(~F.startswith(F.ltrim("value"), F.lit("{")), "not an object").when(F.col("row").isNull() | F.col("row._bad").isNotNull(), "malformed").when(unknown, "unknown field")
    judged = parsed.withColumn("reason", reason)
    rejects = judged.where("reason IS NOT NULL").select("file", "value", "reason")
    if strict and (first := rejects.first()):
        raise ValueError(f"{first['file']}: {first['reason']}: {first['value'][:200]}")
    return judged.where("reason IS NULL").select(*(F.col("row")[f.name].alias(f.name) for f in schema.fields)), rejects


def recover_journal(spark: SparkSession, path: str, schema: T.StructType, *, finished: bool = True) -> DataFrame:
    """Rows of append-only files; an unfinished last line stays if it parses and goes if not. A bad earlier line is an error.

    A last line that ends is a finished one, unless ``finished`` says that writers end cut-off lines too.
    Each file is read as one row, since only its end tells whether its last line is finished.
    """
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.split("value", "\n").alias("lines"))
    lines = files.select("file", F.size("lines").alias("n"), F.posexplode("lines").alias("at", "line")).where("trim(line) <> ''")
    rows = lines.withColumn("row", F.from_json("line", T.StructType([*schema.fields, T.StructField("_bad", T.StringType())]), {"columnNameOfCorruptRecord": "_bad"}))
    bad = F.col("row").isNull() | F.col("row._bad").isNotNull()
    last = F.col("n") - 1 if finished else F.max("at").over(W.partitionBy("file"))
    error = rows.withColumn("last", last).where(bad & (F.col("at") < F.col("last"))).select("file", "at").first()
    if error:
        raise ValueError(f"{error['file']}: line {error['at'] + 1} is malformed")
    return rows.where(~bad).select("row.*").drop("_bad")


def write_bank(rows: DataFrame, path: str) -> None:
    """Replace those stage and split folders that ``rows`` has; null fields are written."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("ignoreNullFields", "false").partitionBy("stage", "split").json(path)


def read_bank(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows of ``<path>/stage=.../split=...``; a folder that isn't there is empty."""
    return spark.read.schema(schema).json(path)


def misplaced(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of ``<path>/<stage>/<split>.jsonl`` whose own stage or split isn't that of their file."""
    rows = spark.read.schema(schema).json(f"{path}/*/*.jsonl").select("*", F.col("_metadata.file_path").alias("file"))
    place = lambda k: F.regexp_extract("file", r"([^/]+)/([^/]+)\.jsonl$", k)
    return rows.where((F.col("stage") != place(1)) | (F.col("split") != place(2)))


def write_records(rows: DataFrame, path: str) -> None:
    """Replace a record folder; the commit is one per job."""
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def _headers(spark: SparkSession, path: str) -> DataFrame:
    """(file, header): the first line of each file."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    placed = lines.withColumn("at", F.monotonically_increasing_id()).where("block = 0")
    return placed.groupBy("file").agg(F.min_by("value", "at").alias("header"))


def read_required_csv(spark: SparkSession, path: str, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of CSV files with a header: required columns present and not blank, no surplus cells, at least one row.

    Columns are matched by name, file by file, so their order may differ; other columns than
    those of the other files are an error.
    """
    known = _headers(spark, path).groupBy("header").agg(F.collect_list("file").alias("files")).collect()  # one row a layout
    layouts = [(next(csv.reader([h.header.lstrip("\ufeff")]), []), h.files) for h in known]
    names = [c.strip() for c in layouts[0][0]] if layouts else []
    if missing := sorted(set(required) - set(names)):
        raise ValueError(f"{path}: columns {missing} are missing")
    parts = []
    for found, files in layouts:
        found = [c.strip() for c in found]
        if sorted(found) != sorted(names):
            raise ValueError(f"{files[0]}: columns {found} instead of {names}")
        schema = T.StructType([T.StructField(n, T.StringType()) for n in [*found, "_bad"]])
        options = {"header": True, "enforceSchema": True, "columnPruning": False, "columnNameOfCorruptRecord": "_bad"}
        parts.append(spark.read.schema(schema).options(**options).csv(path if len(layouts) == 1 else files).select(*names, "_bad"))
    rows = reduce(DataFrame.unionAll, parts) if parts else spark.createDataFrame([], T.StructType([T.StructField("_bad", T.StringType())]))
    bad = F.col("_bad").isNotNull()
    for c in required:
        bad = bad | F.col(c).isNull() | (F.trim(F.col(c)) == "")
    good = rows.where(~bad).drop("_bad")
    if not good.limit(1).count():
        raise ValueError(f"{path}: no rows")
    return good, rows.where(bad)


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)


MOST_BYTES = 2 << 20


def file_status(manifest: DataFrame, found: DataFrame, key: str, *, most_bytes: int = MOST_BYTES) -> DataFrame:
    """(key, status) of the manifest's entries (key, sha256) against files found (key, digest, length)."""
    status = F.when(F.col("length").isNull(), "missing").when(F.col("length") > most_bytes, "too large").when(F.col("digest") != F.col("sha256"), "changed").otherwise("ok")
    return manifest.join(found, key, "left").select(key, status.alias("status"))


def pinned_files(spark: SparkSession, path: str, manifest: DataFrame, *, most_bytes: int = MOST_BYTES) -> DataFrame:
    """(name, status) of the manifest's files (name, sha256): ok, missing, too large or changed."""
    files = spark.read.format("binaryFile").load(path)
    found = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "length", F.sha2("content", 256).alias("digest"))
    return file_status(manifest, found, "name", most_bytes=most_bytes)


def fingerprint(rows: DataFrame, buckets: int = 64) -> str:
    """Hash of a table that its order and partitions don't change: sorted row hashes by bucket, then of the buckets."""
    cells = [F.coalesce(F.col(f"`{c}`").cast("string") if not isinstance(rows.schema[c].dataType, T.ArrayType | T.MapType | T.StructType) else F.to_json(F.struct(f"`{c}`")), F.lit("\x00")) for c in sorted(rows.columns)]
    hashed = rows.select(F.sha2(F.concat_ws("\x1f", *cells), 256).alias("h"))
    counted = hashed.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    sums = counted.groupBy(F.pmod(F.xxhash64("h"), F.lit(buckets)).alias("b")).agg(F.bit_xor(F.xxhash64("h", "n")).alias("x"), F.sum(F.xxhash64("n", "h").cast("decimal(38,0)")).alias("s"), F.count(F.lit(1)).alias("n"))
    parts = sums.orderBy("b").collect()  # as many rows as buckets
    return hashlib.sha256(repr([tuple(map(str, p)) for p in parts]).encode()).hexdigest()


def require_fingerprint(rows: DataFrame, recorded: str) -> DataFrame:
    """``rows``, if their fingerprint is the recorded one; else an error."""
    if (now := fingerprint(rows)) != recorded:
        raise ValueError(f"the table has changed: its fingerprint is {now} and not {recorded}")
    return rows
