"""SimHash near-duplicates found by pigeonring filtering.

A fingerprint's 64 bits form a ring of three segments. If two fingerprints differ
in at most two bits, some segment starts a chain whose first segment is equal,
whose first two differ in at most one bit and whose three differ in at most two.
So they share the first segment and one half of the second: six keys of 32 bits
for each fingerprint. Pairs with a common key pass the chain test and only then
the full Hamming test.

A key that more than ``pairs_up_to`` fingerprints share is not paired out. Its
fingerprints are linked through one-bit variants instead, exactly and in
proportion to their number: two fingerprints differ in at most two bits if and
only if they have a common variant with at most one flipped bit.

Equal fingerprints are one node. Null and empty texts have fingerprint zero and
link like any other. Null doc_ids never name a component unless all are null.
Rows that repeat a doc_id keep their own fingerprints and results. Further
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import Scratch, cut, fresh
from millrace.llm.graph import components
from millrace.llm.ragged import chunks

SEED, SHINGLE, PAIRS_UP_TO = 42, 3, 32
SEGMENTS = ((42, 22), (21, 21), (0, 21))  # shift and width


def fingerprints(texts: pa.Array) -> np.ndarray:
    """Signed 64-bit fingerprints of a column of texts."""
    out = [np.zeros(0, np.int64)]
    for t in chunks(texts):
        data = t.data + np.where((t.data >= 65) & (t.data <= 90), np.uint8(32), np.uint8(0))
        t.split()
        lengths = t.ends - t.starts
        plain, begin = t.joined(data)
        text = plain.tobytes()
        counts = np.where(t.n_words >= SHINGLE, t.n_words - SHINGLE + 1, np.minimum(t.n_words, 1))
        rows = np.repeat(np.arange(t.rows), counts)
        bounds = np.concatenate([[0], np.cumsum(counts)])
        first = np.arange(len(rows)) - bounds[rows] + t.at[rows]
        last = np.minimum(first + SHINGLE, t.at[rows + 1]) - 1
        spans = map(slice, begin[first].tolist(), (begin + lengths)[last].tolist())
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, map(text.__getitem__, spans), repeat(SEED)), np.uint64, len(rows))
        prints = np.zeros(t.rows, np.uint64)
        full = np.flatnonzero(counts)
        if len(full):
            bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            sums = np.add.reduceat(bits, bounds[full], axis=0, dtype=np.int32)
            prints[full] = np.packbits(2 * sums > counts[full, None], axis=1).view(">u8").ravel()
        out.append(prints.view(np.int64))
    return np.concatenate(out)


def fingerprint(column: str):
    return F.arrow_udf(lambda texts: pa.array(fingerprints(texts)), "bigint")(column)


def _differ(shift: int, width: int):
    return F.bit_count(F.shiftrightunsigned(F.col("x").bitwiseXOR(F.col("y")), shift).bitwiseAND(F.lit((1 << width) - 1)))


def links(nodes: DataFrame, pairs_up_to: int = PAIRS_UP_TO, settled=cut) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of ``nodes`` (fp) within two bits."""
    part = lambda shift, width: F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1))
    keys = []
    for i in range(3):
        (shift, width), (next_shift, next_width) = SEGMENTS[i], SEGMENTS[(i + 1) % 3]
        low = next_width // 2
        for half, (s, w) in enumerate(((next_shift, low), (next_shift + low, next_width - low))):
            keys.append(F.shiftleft(part(shift, width), 12).bitwiseOR(part(s, w)).bitwiseOR(F.lit((2 * i + half) << 40)))
    keyed = nodes.select("fp", F.explode(F.array(*keys)).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = settled(keyed.join(sizes, "key"))
    few = shared.where(F.col("n") <= pairs_up_to)
    i = F.shiftright("key", 41)
    step = [_differ(*s) for s in SEGMENTS]
    chain = F.lit(False)
    for k in range(3):
        chain = chain | ((i == k) & (step[k] == 0) & (step[(k + 1) % 3] <= 1))
    pairs = few.select("key", F.col("fp").alias("x")).join(few.select("key", F.col("fp").alias("y")), "key").where("x < y").where(chain)
    near = pairs.where(F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= 2).select(F.col("y").alias("a"), F.col("x").alias("b"))
    many = shared.where(F.col("n") > pairs_up_to).select("fp").distinct()
    flips = F.array(F.lit(0).cast("bigint"), *(F.lit((1 << b) - (1 << 64 if b == 63 else 0)).cast("bigint") for b in range(64)))
    variants = many.select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("variant"))
    least = variants.groupBy("variant").agg(F.min("fp").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    through = variants.join(least, "variant").where("fp <> least").select(F.col("fp").alias("a"), F.col("least").alias("b"))
    return near.unionAll(through)


def simhash_components(docs: DataFrame, *, pairs_up_to: int = PAIRS_UP_TO) -> DataFrame:
    """One row per document: doc_id, fingerprint (hex), component_id."""
    with Scratch() as scratch:
        prints = cut(docs.select("doc_id", fingerprint("text").alias("fp")))
        classes = cut(_classes(scratch, prints, pairs_up_to))
    return _joined(prints, classes).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _classes(scratch: Scratch, prints: DataFrame, pairs_up_to: int) -> DataFrame:
    """Each fingerprint's component: (node, component_id)."""
    nodes = scratch.cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = scratch.hold(components(links(nodes.select("fp"), pairs_up_to, scratch.cut)))
    rooted = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(least, "root").select(F.col("fp").alias("node"), "component_id")


def _joined(prints: DataFrame, classes: DataFrame) -> DataFrame:
    return prints.join(classes, prints.fp == classes.node)


def keep_first(docs: DataFrame, *, pairs_up_to: int = PAIRS_UP_TO) -> DataFrame:
    """One document of each component stays, that with the smallest doc_id; of rows
    that repeat this doc_id, the one with the smallest text hash, and one of those that are
    alike in both. Where all ids of a component are null, its rows are told apart by their
    text hash alone. Columns may have any name and type."""
    name, number = fresh(docs, "text_hash"), fresh(docs, "place")
    with Scratch() as scratch:
        prints = scratch.cut(docs.select("doc_id", fingerprint("text").alias("fp"), F.xxhash64("text").alias("text_hash")))
        first = _joined(prints, _classes(scratch, prints, pairs_up_to)).where("doc_id <=> component_id")
        first = cut(first.groupBy("doc_id", "component_id").agg(F.min("text_hash").alias("text_hash")).select(F.col("doc_id").alias(fresh(docs, "kept_id")), F.col("text_hash").alias(fresh(docs, "kept_hash"))))
    keyed = docs.withColumn(name, F.xxhash64("text"))
    kept = keyed.join(first, keyed["doc_id"].eqNullSafe(first[first.columns[0]]) & (keyed[name] == first[first.columns[1]]), "left_semi")
    sortable = (c.name for c in docs.schema if c.name != "doc_id" and _sortable(c.dataType))
    once = W.partitionBy("doc_id", name).orderBy(*(f"`{c}`" for c in sortable))
    return kept.withColumn(number, F.row_number().over(once)).where(F.col(number) == 1).select([f"`{c}`" for c in docs.columns])


def _sortable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _sortable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_sortable(f.dataType) for f in kind)
    return not isinstance(kind, T.MapType | T.VariantType)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: fingerprint and component of every document."""
    return simhash_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
