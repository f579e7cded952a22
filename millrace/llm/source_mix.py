"""Mixing sources to target weights by Sainte-Laguë apportionment.

Every source's target is a share of the budget (``share`` times all words) by its
weight, held at ``cap`` times the source's size, the excess reshared by weight.
Targets become whole blocks of ``block_words`` words: sources get blocks by the
highest quotients target / (2 * blocks + 1), then groups of a source's shards and
the shards of a group get its blocks by the same rule. Inside a shard the documents lie in seeded order; the
quota takes each of its blocks 0, 1 or 2 times, the extra ones by a seeded
systematic draw, so a document's words follow from its place by arithmetic.

Null texts have size 0; null sources form one source that is ranked last; an empty
table gives an empty result. Rows that repeat a doc_id are mixed one by one. Other
columns of the input are ignored. A shard holds about ``shard_words`` words (a
longer document stays whole), and a source of n shards has about sqrt(n) groups of
them, so no task orders more than a shard, a group or a source's groups at once.
Only the table of sources is ordered as a whole. Texts are read once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.common import cut

BLOCK_WORDS = 16
SHARD_WORDS = 1 << 18

_SPARK = {
    "size": r"coalesce(regexp_count(text, '[^\\x20\\x09-\\x0D]+'), 0)",
    "num": "cast(conv(substring({0}, 1, 8), 16, 10) AS bigint)",
    "div": "div",
    "each": "explode(sequence({0}, {1} - 1))",
}
_DUCK = {
    "size": r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)",
    "num": "cast('0x' || substr({0}, 1, 8) AS bigint)",
    "div": "//",
    "each": "unnest(range({0}, {1}))",
}


def _sized(e: dict, seed: str) -> str:
    """Columns of the documents that the rest works on."""
    return f"doc_id, source, cast({e['size']} AS bigint) AS size, md5(concat('{seed}', coalesce(cast(doc_id AS string), 'null'))) AS h"


def _sql(docs: str, e: dict, block: int, shard: int, seed: str, share: float = 1.5, cap: int = 2) -> str:
    """The mix of ``docs``, a table of :func:`_sized` columns."""
    div = e["div"]

    def seats(votes: str, among: str, blocks: str, keys: str, out: str, of: str = "") -> str:
        """CTEs that give ``blocks`` seats to the rows of ``among`` by highest quotients."""
        part, order = f"PARTITION BY {of}" if of else "", f"{keys} NULLS LAST"
        tie = f"{votes} / (2.0 * seat + 1) DESC, {order}, seat"
        return f"""
    {out}_b AS (
      SELECT *, count(*) OVER ({part}) AS n_all, sum({votes}) OVER ({part}) AS v_all FROM {among}),
    {out}_l AS (
      SELECT *, CASE WHEN v_all > 0 THEN greatest(0, cast(floor({votes} * ({blocks} - n_all / 2.0) / v_all) AS bigint) - 1) ELSE 0 END AS lo,
             CASE WHEN v_all > 0 THEN greatest(0, cast(floor({votes} * ({blocks} + n_all / 2.0) / v_all) AS bigint)) + 2 ELSE 2 END AS hi
      FROM {out}_b),
    {out}_s AS (SELECT *, sum(lo) OVER ({part}) AS lo_all FROM {out}_l),
    {out}_c AS (SELECT *, {e["each"].format("lo", "hi")} AS seat FROM {out}_s),
    {out}_r AS (SELECT *, row_number() OVER ({part} ORDER BY {tie}) AS place FROM {out}_c)"""

    return rf"""
WITH d AS (SELECT doc_id, source, size, h FROM {docs}),
s AS (SELECT source, cast(sum(size) AS bigint) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, {cap} * source_size AS most, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM s),
p AS (
  SELECT *, cast(most AS double) / weight AS level,
         coalesce(sum(most) OVER (ORDER BY cast(most AS double) / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_before,
         coalesce(sum(weight) OVER (ORDER BY cast(most AS double) / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weight_before,
         sum(source_size) OVER () AS all_size, sum(weight) OVER () AS all_weight
  FROM w),
q AS (SELECT *, (cast({share} AS double) * all_size - full_before) / (all_weight - weight_before) AS rate FROM p),
t AS (
  SELECT source, source_size, least(cast(most AS double), weight * max(CASE WHEN rate <= level THEN rate END) OVER ()) AS target FROM q),
k AS (SELECT *, cast(floor(sum(target) OVER (ORDER BY source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) / {block} + 0.5) AS bigint) AS blocks FROM t),
{seats("target", "k", "blocks", "source", "a")},
g AS (
  SELECT source, source_size, target, greatest(1, source_size {div} {shard}) AS shards, lo + count(CASE WHEN place <= blocks - lo_all THEN 1 END) AS seats
  FROM a_r GROUP BY source, source_size, target, lo),
ds AS (
  SELECT d.*, g.source_size, g.target, {e["num"].format("h")} % g.shards AS shard, g.shards, g.seats FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
sh AS (
  SELECT source, shard, shard % greatest(1, cast(ceil(sqrt(shards)) AS bigint)) AS part, seats, cast(sum(size) AS bigint) AS shard_size
  FROM ds GROUP BY source, shard, shards, seats),
pt AS (SELECT source, part, seats, cast(sum(shard_size) AS bigint) AS part_size FROM sh GROUP BY source, part, seats),
{seats("cast(part_size AS double)", "pt", "seats", "part", "e", "source")},
ps AS (SELECT source, part, lo + count(CASE WHEN place <= seats - lo_all THEN 1 END) AS seats FROM e_r GROUP BY source, part, lo),
sp AS (SELECT sh.source, sh.part, sh.shard, sh.shard_size, ps.seats FROM sh JOIN ps ON sh.source IS NOT DISTINCT FROM ps.source AND sh.part = ps.part),
{seats("cast(shard_size AS double)", "sp", "seats", "shard", "b", "source, part")},
o AS (
  SELECT source, shard, shard_size, greatest(1, (shard_size + {block - 1}) {div} {block}) AS n_blocks, lo + count(CASE WHEN place <= seats - lo_all THEN 1 END) AS quota
  FROM b_r GROUP BY source, shard, shard_size, lo),
u AS (
  SELECT *, least({cap}, quota {div} n_blocks) AS times, CASE WHEN quota {div} n_blocks >= {cap} THEN 0 ELSE quota % n_blocks END AS extra,
         {e["num"].format(f"md5(concat('{seed}', '/', coalesce(source, ''), '/', cast(shard AS string)))")} % n_blocks AS turn
  FROM o),
x AS (
  SELECT ds.doc_id, ds.source, ds.size, ds.source_size, ds.target, u.times, u.extra, u.turn, u.n_blocks,
         cast(sum(ds.size) OVER (PARTITION BY ds.source, ds.shard ORDER BY ds.h, ds.doc_id, ds.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS bigint) AS upto
  FROM ds JOIN u ON ds.source IS NOT DISTINCT FROM u.source AND ds.shard = u.shard),
y AS (
  SELECT *, upto {div} {block} AS j1, (upto - size) {div} {block} AS j0, upto % {block} AS m1, (upto - size) % {block} AS m0 FROM x)
SELECT doc_id, source, size, source_size, target,
  cast(times * size
    + {block} * ((j1 * extra + turn) {div} n_blocks) + (((j1 + 1) * extra + turn) {div} n_blocks - (j1 * extra + turn) {div} n_blocks) * m1
    - {block} * ((j0 * extra + turn) {div} n_blocks) - (((j0 + 1) * extra + turn) {div} n_blocks - (j0 * extra + turn) {div} n_blocks) * m0 AS bigint) AS taken
FROM y"""


def mix_sources(docs: DataFrame, *, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: str = "mix") -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken."""
    spark = docs.sparkSession
    sized = cut(spark.sql(f"SELECT {_sized(_SPARK, seed)} FROM {{docs}}", docs=docs.select("doc_id", "source", "text")))
    return spark.sql(_sql("{docs}", _SPARK, block_words, shard_words, seed), docs=sized)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: every document of the table with the words that the mix takes of it."""
    return mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = _sql(f"(SELECT {_sized(_DUCK, 'mix')} FROM documents)", _DUCK, BLOCK_WORDS, SHARD_WORDS, "mix")
