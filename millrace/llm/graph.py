"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import cut, drop


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Link the larger (or the other) neighbours of each node to its smallest one."""
    if larger:
        sides = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = sides.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        out = sides.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        linked = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        out = linked.unionAll(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Nodes of ``edges`` (a, b: bigint) with the smallest node that each can reach: (node, root).

    Every round contracts by groups and joins; its edges are written to the shared
    folder, so a lost executor costs one round. Stops when a round changes nothing.
    The result reads the last round's table, which :func:`~millrace.llm.common.drop` deletes.
    """
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))"), F.sum(F.col("b").cast("decimal(38,0)"))).first()
        if tuple(state) == seen or not state[0]:
            found = now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
            found._millrace_path = now._millrace_path
            return found
        seen = tuple(state)
        after = cut(_star(_star(now, True), False))
        drop(now)
        now = after
