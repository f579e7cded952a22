"""License scans: ordered signature rules over normalised words.

Hundreds of hand-written regular expressions (:mod:`millrace.llm.license_rules`)
run over the lower-cased words of whole texts. A text is looked at only if it holds
one of a few markers, and a rule only if the text holds its keyword. Detections
are ordered by start, length (longest first), priority and rule; a detection that
lies inside one of equal or higher priority is suppressed. What remains gives the
labels, and its highest weight the score.

Base places are those where the words of a base phrase stand consecutively; their
labels always stay. Null and empty texts have no words. Each row is scanned by
itself, so ids and further columns don't matter, and an empty table gives an
empty result. Everything is SQL expressions inside one scan, without a shuffle.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import fresh
from millrace.llm.license_rules import MARKERS, rules

PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Not ASCII, but lower() would make ASCII letters of them.
ODD = "İK"
BASE = " (?:" + "|".join(p.replace(" ", "  ") for p, _ in PHRASES) + ") "
BASE_SCORE = 0.5


def spaced_words(text: str = "text") -> Column:
    """Lower-cased words, each with a space of its own on either side."""
    plain = F.coalesce(F.col(text), F.lit(""))
    for c in ODD:
        plain = F.replace(plain, F.lit(c), F.lit("é"))
    joined = F.trim(F.lower(F.regexp_replace(plain, GAPS, "  ")))
    return F.when(joined == "", "").otherwise(F.concat(F.lit(" "), joined, F.lit(" ")))


def _n(text: Column) -> Column:
    """Number of words in a piece of spaced words."""
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("bigint") / 2


def _rule_table() -> Column:
    """The rules as one constant of the plan."""
    names = ("rule", "label", "keyword", "regex", "priority", "weight")
    rows = json.dumps([dict(zip(names, r, strict=True)) for r in rules()])
    return F.from_json(F.lit(rows), "array<struct<rule: int, label: string, keyword: string, regex: string, priority: int, weight: double>>")


def _detections(words: Column, table: Column) -> Column:
    """All matches of all rules whose keyword is there, ordered for the sweep."""

    def matches(r: Column) -> Column:
        found = F.regexp_extract_all(words, r["regex"], F.lit(0))
        pieces = F.split(words, r["regex"])

        def place(text: Column, i: Column) -> Column:
            before = F.aggregate(F.slice(pieces, F.lit(1), i + 1), F.lit(0), lambda a, x: a + F.length(x)) + F.aggregate(
                F.slice(found, F.lit(1), i), F.lit(0), lambda a, x: a + F.length(x)
            )
            return F.struct(
                before.alias("start"), (-(before + F.length(text))).alias("minus_end"), (-r["priority"]).alias("minus_priority"),
                r["rule"].alias("rule"), r["label"].alias("label"), r["weight"].alias("weight"),
            )

        return F.transform(found, place)

    hits = F.filter(table, lambda r: F.contains(words, r["keyword"]))
    return F.array_sort(F.flatten(F.transform(hits, matches)))


def _sweep(ordered: Column) -> Column:
    """Detections that don't lie inside an earlier one of equal or higher priority."""
    empty = F.slice(ordered, 1, 0)
    start = F.struct(F.array(*[F.lit(0)] * 4).alias("ends"), empty.alias("kept"))

    def step(state: Column, d: Column) -> Column:
        priority, end = -d["minus_priority"], -d["minus_end"]
        inside = F.get(state["ends"], priority - 1) >= end
        ends = F.transform(state["ends"], lambda v, i: F.when(i < priority, F.greatest(v, end)).otherwise(v))
        return F.struct(ends.alias("ends"), F.when(inside, state["kept"]).otherwise(F.concat(state["kept"], F.array(d))).alias("kept"))

    return F.aggregate(ordered, start, step, lambda s: s["kept"])


def scan_licenses(docs: DataFrame, *, text: str = "text", name: str = "licenses") -> DataFrame:
    """``docs`` with a struct column ``name`` (with underscores added where they have it): counts, base places, labels, score and spans."""
    name = fresh(docs, name)
    own = [fresh(docs, c) for c in ("millrace_words", "millrace_base", "millrace_kept")]
    words, base, kept = map(F.col, own)
    marked = reduce(lambda a, b: a | b, (F.contains(words, F.lit(m.replace(" ", "  "))) for m in MARKERS))
    table = _rule_table()
    some = marked & F.contains(words, F.lit("licen"))
    pieces = F.split(words, BASE)
    base_info = F.struct(
        F.size(pieces).cast("bigint").alias("n"), _n(F.get(pieces, F.lit(0))).alias("first"), _n(F.get(pieces, F.size(pieces) - 1)).alias("rest"),
        F.regexp_extract_all(words, F.lit(BASE), F.lit(0)).alias("found"),
    )
    out = docs.withColumn(own[0], spaced_words(text)).withColumn(own[1], F.when(some, base_info)).withColumn(own[2], F.when(marked, _sweep(_detections(words, table))))
    n_base = F.coalesce(base["n"] - 1, F.lit(0).cast("bigint"))
    found = F.coalesce(base["found"], F.array().cast("array<string>"))
    labels = F.array_compact(F.array(*(F.when(F.array_contains(found, " " + p.replace(" ", "  ") + " "), label) for p, label in PHRASES)))
    method = F.coalesce(F.transform(kept, lambda d: d["label"]), F.array().cast("array<string>"))
    join = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    last = _n(words) - base["rest"] - _n(F.get(base["found"], F.size(base["found"]) - 1))
    spans = F.transform(kept, lambda d: F.struct(d["label"].alias("label"), d["rule"].alias("rule"), d["start"].alias("start"), (-d["minus_end"]).alias("end")))
    best = F.array_max(F.transform(kept, lambda d: d["weight"]))
    result = F.struct(
        _n(words).cast("bigint").alias("n_words"), n_base.alias("n_base"),
        F.when(n_base > 0, base["first"]).cast("bigint").alias("first_word"), F.when(n_base > 0, last).cast("bigint").alias("last_word"),
        join(labels).alias("base_labels"), join(F.concat(labels, method)).alias("labels"),
        F.greatest(F.coalesce(best, F.lit(0.0)), F.when(n_base > 0, BASE_SCORE).otherwise(0.0)).alias("score"),
        F.coalesce(F.size(kept), F.lit(0)).cast("bigint").alias("n_detections"), spans.alias("spans"),
    )
    return out.withColumn(name, result).select(*(f"`{c}`" for c in docs.columns), name)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: the license scan of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan_licenses(docs).select("doc_id", "licenses.*").drop("spans")


def _oracle() -> str:
    values = ", ".join(f"({n}, '{label}', '{kw}', '{rx}', {p}, {w})" for n, label, kw, rx, p, w in rules())
    marked = " OR ".join(f"contains(s, '{m.replace(' ', '  ')}')" for m in MARKERS)
    plain = "coalesce(text, '')"
    for c in ODD:
        plain = f"replace({plain}, '{c}', 'é')"
    n = lambda x: f"((length({x}) - length(replace({x}, ' ', ''))) // 2)"
    base = " ".join(f"WHEN trim(x) = '{p.replace(' ', '  ')}' THEN '{label}'" for p, label in PHRASES)
    return rf"""
WITH rules(rule, label, kw, rx, priority, weight) AS (VALUES {values}),
d AS (
  SELECT doc_id, CASE WHEN j = '' THEN '' ELSE ' ' || j || ' ' END AS s FROM (SELECT doc_id, trim(lower(regexp_replace({plain}, '{GAPS}', '  ', 'g'))) AS j FROM documents)),
b AS (SELECT *, regexp_extract_all(s, '{BASE}') AS found, string_split_regex(s, '{BASE}') AS pieces FROM d),
h AS (
  SELECT doc_id, rule, label, priority, weight, regexp_extract_all(s, rx) AS found, string_split_regex(s, rx) AS pieces
  FROM d JOIN rules ON ({marked}) AND contains(s, kw)),
e AS (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM h),
p AS (
  SELECT doc_id, rule, label, priority, weight,
         coalesce(list_sum(list_transform(pieces[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) AS lo, length(found[i]) AS n
  FROM e),
k AS (
  SELECT * FROM p AS x WHERE NOT EXISTS (
    SELECT 1 FROM p AS y WHERE y.doc_id = x.doc_id AND y.priority >= x.priority AND y.lo <= x.lo AND y.lo + y.n >= x.lo + x.n
      AND (y.lo, -(y.lo + y.n), -y.priority, y.rule) < (x.lo, -(x.lo + x.n), -x.priority, x.rule))),
g AS (SELECT doc_id, list(label) AS labels, max(weight) AS best, count(*) AS n FROM k GROUP BY doc_id),
r AS (
  SELECT b.doc_id, {n("s")} AS n_words, len(b.found) AS n_base, list_transform(b.found, lambda x: CASE {base} END) AS bl,
         {n("b.pieces[1]")} AS first_word, {n("s")} - {n("b.pieces[-1]")} - {n("b.found[-1]")} AS last_word, coalesce(g.labels, []) AS ml, coalesce(g.best, 0) AS best, coalesce(g.n, 0) AS n_detections
  FROM b LEFT JOIN g ON b.doc_id = g.doc_id)
SELECT doc_id, cast(n_words AS bigint) AS n_words, cast(n_base AS bigint) AS n_base,
  cast(CASE WHEN n_base > 0 THEN first_word END AS bigint) AS first_word, cast(CASE WHEN n_base > 0 THEN last_word END AS bigint) AS last_word,
  array_to_string(list_sort(list_distinct(bl)), ',') AS base_labels, array_to_string(list_sort(list_distinct(list_concat(bl, ml))), ',') AS labels,
  cast(greatest(best, CASE WHEN n_base > 0 THEN {BASE_SCORE} ELSE 0 END) AS double) AS score, n_detections
FROM r"""


ORACLE = _oracle()
