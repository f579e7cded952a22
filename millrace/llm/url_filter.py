"""URL rules and block lists held in a Bloom filter cascade.

Level 0 encodes the listed keys, level 1 the keys of the corpus that pass level 0
without being listed, level 2 the listed keys that pass level 1, and so on until no
key of the corpus's complete universe is told wrongly. A key of that universe is
listed if the first level that it fails has an odd number. Levels are bit arrays
held in the query's plan, so judging URLs needs no join and no shuffle. Only if a
level has more than ``most_bits`` bits, distinct hosts and paths are judged by
joins with the words of the levels, to the same result.

Rules and block lists share the cascade: each URL asks for the keys of its host's
suffixes (of as many labels as the rules have) with its path cut to each length
among the rules', and for its host as a whole. The longest rule wins; without
one, a listed host is blocked and any other allowed.

Null URLs and those without ``://`` have an empty host and path, which no rule
fits. Rows that repeat a page_id are judged one by one. Further columns are
ignored; empty tables give an empty result, an empty list allows everything.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import Scratch, cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
MOST_BITS = 1 << 22


class Cascade:
    """Exact membership in ``keys`` (key, listed) for each key of that table.

    A level of up to ``most_bits`` bits is a constant of the plan. A larger one stays a table of words in
    the shared folder, where each key meets those that it probes: so no list is too long, and what
    the driver holds is bounded.
    """

    def __init__(self, keys: DataFrame, *, most_bits: int = MOST_BITS) -> None:
        self.levels: list[Level] = []
        with Scratch() as scratch:
            known = scratch.cut(keys.groupBy("key").agg(F.max("listed").alias("listed")))
            sizes = known.agg(F.count_if("listed"), F.count(F.lit(1))).first()
            n, other = sizes[0], sizes[1] - sizes[0]
            while n:
                # the keys that pass every level so far, and so are told apart by the next ones
                level = Level(len(self.levels), n, other, most_bits)
                level.fill(known.where(F.col("listed") == (level.number % 2 == 0)))
                self.levels.append(level)
                known = scratch.cut(level.passing(known))
                n, other = known.where(F.col("listed") != (level.number % 2 == 0)).count(), n

    def has(self, key: Column) -> Column:
        """Is ``key``, of the universe, listed? Only where all levels are constants."""
        out = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            out = F.when(~level.holds(key), F.lit(level.number % 2 == 1)).otherwise(out)
        return out

    @property
    def constant(self) -> bool:
        return all(level.constant for level in self.levels)

    def listed(self, keys: DataFrame) -> DataFrame:
        """Those of ``keys`` (key, distinct, of the universe) that are listed, whatever the size of the levels."""
        if self.constant:
            return keys.where(self.has(F.col("key")))
        with Scratch() as scratch:
            rest, found = keys, []
            for level in self.levels:
                passed = scratch.cut(level.passing(rest))
                if level.number % 2:
                    # those that fail an odd level are listed
                    found.append(scratch.cut(rest.join(passed, "key", "left_anti")))
                rest = passed
            if len(self.levels) % 2:
                found.append(rest)
            return cut(reduce(DataFrame.unionAll, found or [keys.where("false")]))


class Level:
    """One Bloom filter of the cascade."""

    def __init__(self, number: int, n: int, other: int, most_bits: int) -> None:
        self.number = number
        self.probes = min(12, max(1, math.ceil(math.log2(max(2, other / n)))))
        self.bits = 64 * math.ceil(max(64, 1.5 * n * self.probes) / 64)
        self.constant = self.bits <= most_bits

    def places(self, key: Column) -> list[Column]:
        first, step = (F.xxhash64(key, F.lit(2 * self.number + k)).bitwiseAND(F.lit((1 << 48) - 1)) for k in (0, 1))
        return [F.pmod(first + step * i, F.lit(self.bits).cast("bigint")) for i in range(self.probes)]

    def fill(self, encoded: DataFrame) -> None:
        places = encoded.select(F.explode(F.array(*self.places(F.col("key")))).alias("p"))
        words = places.groupBy(F.shiftright("p", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 AS int)))").alias("v"))
        if not self.constant:
            self.words = cut(words)
            return
        held = [0] * (self.bits // 64)
        for word, v in words.collect():  # at most most_bits / 64 rows
            held[word] = v
        self.held = F.split(F.lit(",".join(map(str, held))), ",").cast("array<bigint>")

    def holds(self, key: Column) -> Column:
        """Are all places of ``key`` set? Only for a constant level."""
        out = F.lit(True)
        for p in self.places(key):
            out = out & (F.getbit(F.get(self.held, F.shiftright(p, 6).cast("int")), p.bitwiseAND(F.lit(63)).cast("int")) == 1)
        return out

    def passing(self, keys: DataFrame) -> DataFrame:
        """Those of ``keys`` (key, ...; distinct) that this level holds."""
        if self.constant:
            return keys.where(self.holds(F.col("key")))
        probes = keys.select("key", F.explode(F.array_distinct(F.array(*self.places(F.col("key"))))).alias("p")).select("key", F.shiftright("p", 6).alias("word"), F.expr("shiftleft(1L, cast(p & 63 AS int))").alias("bit"))
        met = probes.join(self.words, "word", "left").groupBy("key").agg(F.bool_and(F.coalesce(F.expr("v & bit") != 0, F.lit(False))).alias("all"))
        return keys.join(met.where("all").select("key"), "key")


def parts(url: str = "url") -> tuple[Column, Column]:
    """Host and path of a URL."""
    host = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))
    return F.translate(host, UPPER, LOWER), path


def _rule_keys(rules) -> Column:
    """Keys under which a rule may fit a host and a path."""
    labels = F.split("host", r"\.")
    options = []
    for n in sorted({len(host.split(".")) for _, host, _ in rules}):
        suffix = F.array_join(F.slice(labels, F.greatest(F.size(labels) - n + 1, F.lit(1)), n), ".")
        for length in sorted({len(path) for _, _, path in rules}):
            fits = (F.size(labels) >= n) & (F.length("path") >= length) & (F.col("host") != "")
            options.append(F.when(fits, F.concat(F.lit("r "), suffix, F.substring("path", 1, length))))
    return F.array_compact(F.array(*options))


def _met_keys(asked: DataFrame, own: Column, listed: DataFrame) -> DataFrame:
    """(host, path, fitting, blocked) of the distinct hosts and paths, by a join with the listed keys."""
    each = asked.select("host", "path", F.explode(F.array_append("keys", own)).alias("key")).distinct()
    met = each.join(listed.select("key", F.lit(True).alias("there")), "key", "left")
    rule = F.when(F.col("there") & F.startswith("key", F.lit("r ")), F.col("key"))
    return met.groupBy("host", "path").agg(F.collect_set(rule).alias("fitting"), F.coalesce(F.bool_or(F.col("there") & (F.col("key") == own)), F.lit(False)).alias("blocked"))


def url_filter(pages: DataFrame, blocked_hosts: DataFrame, *, rules=RULES, most_bits: int = MOST_BITS) -> DataFrame:
    """page_id, host, path, rule and verdict of each page; ``blocked_hosts`` has a column host."""
    host, path = parts()
    asked = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("keys", _rule_keys(rules))
    ruled = pages.sparkSession.range(1).select(F.explode(F.array(*(F.lit(f"r {h}{p}") for _, h, p in rules))).alias("key"))
    listed = ruled.unionAll(blocked_hosts.where("host IS NOT NULL").select(F.concat(F.lit("h "), "host").alias("key")))
    universe = asked.select(F.explode("keys").alias("key")).unionAll(asked.select(F.concat(F.lit("h "), "host").alias("key")))
    tagged = listed.withColumn("listed", F.lit(True)).unionAll(universe.withColumn("listed", F.lit(False)))
    cascade = Cascade(tagged, most_bits=most_bits)
    own = F.concat(F.lit("h "), "host")
    if cascade.constant:
        found = asked.withColumns({"fitting": F.filter("keys", cascade.has), "blocked": cascade.has(own)})
    else:
        found = asked.join(_met_keys(asked, own, cascade.listed(universe.distinct())), ["host", "path"])
    longest = F.array_max(F.transform("fitting", lambda k: F.struct(F.length(k).alias("n"), k.alias("k"))))["k"]
    verdict = F.lit(None)
    for what, h, p in rules:
        verdict = F.when(F.col("rule") == h + p, what).otherwise(verdict)
    method = F.when(F.col("blocked"), "block").otherwise("allow")
    judged = found.withColumn("rule", F.substring(longest, 3, 1 << 30))
    return judged.select("page_id", "host", "path", "rule", F.coalesce(verdict, method).alias("verdict"))


def tracked_hosts(pages: DataFrame, *, least: int = 3, share: float = 0.4) -> DataFrame:
    """Hosts of at least ``least`` pages of which at least ``share`` carry a tracking parameter."""
    by = pages.select(parts()[0].alias("host"), F.coalesce(F.contains("url", F.lit("utm_source=")), F.lit(False)).alias("tracked"))
    return by.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.count_if("tracked").alias("t")).where((F.col("n") >= least) & (F.col("t") >= share * F.col("n"))).select("host")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: every page under the rules, with hosts of many tracked links blocked."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return url_filter(pages, tracked_hosts(pages))


def _oracle() -> str:
    fits = lambda h, p: f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))"
    by_length = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    rule = " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for _, h, p in by_length)
    verdict = " ".join(f"WHEN {fits(h, p)} THEN '{what}'" for what, h, p in by_length)
    return rf"""
WITH p AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path, coalesce(contains(url, 'utm_source='), false) AS tracked
  FROM pages),
h AS (SELECT host FROM p GROUP BY host HAVING count(*) >= 3 AND count(*) FILTER (tracked) >= 0.4 * count(*))
SELECT page_id, host, path, CASE {rule} END AS rule, CASE {verdict} WHEN host IN (SELECT host FROM h) THEN 'block' ELSE 'allow' END AS verdict
FROM p"""


ORACLE = _oracle()
