"""Helpers that aren't built in: token counters, canonical hashes, fenced code and JSON examples."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def word_tokens(text: Column | str) -> Column:
    """The default token counter: runs of non-space characters."""
    return F.regexp_count(text, F.lit(r"\S+"))


def token_counter(load: Callable[[], Callable[[str], int]]):
    """A vectorised token counter; ``load`` builds the tokenizer once in a worker's task."""

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = load()
        for texts in batches:
            yield texts.map(lambda t: tokens(t) if t is not None else 0).astype("int64")

    return F.pandas_udf(count, "bigint")


def canonical_hash():
    """SHA-256 of a JSON text as Python's dumps with sorted keys writes it."""

    def digest(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else hashlib.sha256(json.dumps(json.loads(t), sort_keys=True).encode()).hexdigest())

    return F.pandas_udf(digest, "string")


def fenced_code(rows: DataFrame, *, text: str = "text", languages: tuple[str, ...] = ("javascript", "js", "strudel")) -> DataFrame:
    """``rows`` with one row for each closed fence of these languages: its code and the line where the code starts."""
    fence = rf"(?ms)^```(?:{'|'.join(languages)})[ \t]*\n(.*?)\n```[ \t]*$"
    pieces, whole, code = F.split(text, fence), F.regexp_extract_all(text, F.lit(fence), F.lit(0)), F.regexp_extract_all(text, F.lit(fence), F.lit(1))
    breaks = lambda c: F.length(c) - F.length(F.replace(c, F.lit("\n"), F.lit("")))

    def one(x: Column, i: Column) -> Column:
        before = F.aggregate(F.slice(pieces, F.lit(1), i + 1), F.lit(0), lambda a, p: a + breaks(p)) + F.aggregate(F.slice(whole, F.lit(1), i), F.lit(0), lambda a, p: a + breaks(p))
        return F.struct((before + 2).alias("line"), x.alias("code"))

    return rows.withColumn("fence", F.explode(F.transform(code, one))).select("*", "fence.line", "fence.code").drop("fence")


def json_examples(rows: DataFrame, *, text: str = "text") -> DataFrame:
    """``rows`` with one row for each example of an object or array of objects: its code, else its pattern, where not blank."""
    listed = F.when(F.startswith(F.ltrim(text), F.lit("[")), F.col(text)).otherwise(F.concat(F.lit("["), F.col(text), F.lit("]")))
    got = rows.withColumn("example", F.explode(F.from_json(listed, "array<struct<code: string, pattern: string>>")))
    code = F.coalesce(F.nullif(F.col("example.code"), F.lit("")), F.col("example.pattern"))
    return got.withColumn("code", code).drop("example").where(F.trim("code") != "")
