"""Spelling variants: words that differ by one letter, grouped under the commonest form.

A dictionary of counted words is looked up through the nodes of two tries. The forward
trie holds the words, the reversed trie holds them backwards, and every node has an
integer. A word of length ``k`` gives ``k + 1`` *splits* (prefix node, suffix node) that
meet between two positions, and ``k`` *skips*, whose nodes leave one position out. Two
words with a skip in common differ by one replaced character; a skip of one that is a split
of the other differs by one inserted character. Equal integers mean equal prefixes and
suffixes, so the neighbours are exact and no strings are compared.

Nodes of up to three characters are numbered by their characters. Deeper ones are numbered
by the task that holds their branch, which reads its words in order and keeps the path of
one word. A pair of nodes is shared by at most as many skips as there are different
characters, and by one split, so no group grows with the data; each group gives every
member the number of its other members and the best of them, never all pairs.

Null and empty texts have no words. A null doc_id counts as an empty string where a
caller's ``alter`` uses it. Repeated rows are counted again; further columns are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import Scratch, cut

LETTERS = "A-Za-zÀ-ÿ"
MIN_CHARS, MIN_COUNT, RATIO = 5, 3, 2
#: Nodes with fewer characters than this are numbered by them (21 bits a character); words that share as many are kept together.
NEAR = 4


def word_counts(docs: DataFrame, *, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, alter: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """(word, n) of the runs of letters, A-Z lower-cased, with at least ``min_chars`` characters and ``min_count`` occurrences.

    ``alter(doc_id, word)`` may give another spelling, no longer than the word, before words are counted.
    """
    runs = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"[{LETTERS}]{{{min_chars},}}"), F.lit(0))
    found = docs.select("doc_id", F.explode(runs).alias("run")).select("doc_id", F.translate("run", string.ascii_uppercase, string.ascii_lowercase).alias("run"))
    word = F.col("run") if alter is None else alter(F.col("doc_id"), F.col("run"))
    return found.select(word.alias("word")).where(F.length("word") >= min_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _packed(prefix: str) -> int:
    """Number of a node of fewer than ``NEAR`` characters; below zero, as deeper ones are above."""
    number = 0
    for c in prefix:
        number = number << 21 | ord(c) + 1
    return -1 - number


def _path_numbers(texts: list[str], before: tuple[str, list[int]], counter: int) -> Iterator[tuple[list[int], tuple[str, list[int]], int]]:
    """The node numbers on the path of each of the sorted ``texts``; ``before`` is the text and path ahead of the first."""
    last, path = before
    for text in texts:
        same, most = 0, min(len(last), len(text))
        while same < most and last[same] == text[same]:
            same += 1
        path = path[: same + 1]
        while len(path) <= len(text):
            if len(path) < NEAR:
                path.append(_packed(text[: len(path)]))
            else:
                path.append(counter)
                counter += 1
        last = text
        yield path, (last, path), counter


def _numbered(words: DataFrame, text: Column, name: str) -> DataFrame:
    """Add ``name``: the trie nodes on the path of ``text``, from the root to its end."""

    carried = words.columns

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, counter = ("", [_packed("")]), TaskContext.get().partitionId() << 40
        for batch in batches:
            flat, ends = [], [0]
            for path, before, counter in _path_numbers(batch.column("spelled").to_pylist(), before, counter):  # noqa: B020
                flat += path
                ends.append(len(flat))
            kept = [batch.column(c) for c in carried]
            yield pa.RecordBatch.from_arrays([*kept, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))], [*carried, name])

    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in words.schema), f"{name} array<bigint>"])
    spelled = words.withColumn("spelled", text)
    return spelled.repartition(F.substring("spelled", 1, NEAR)).sortWithinPartitions("spelled").mapInArrow(number, schema)


def numbered(words: DataFrame) -> DataFrame:
    """``words`` (word, n, distinct) with ``fwd`` and ``rev``, their nodes in both tries, and ``num``, the last of ``fwd``."""
    both = _numbered(_numbered(words.select("word", "n"), F.col("word"), "fwd"), F.reverse("word"), "rev")
    return both.withColumn("num", F.element_at("fwd", -1))


def _nodes(dictionary: DataFrame) -> DataFrame:
    """(p, s, key, first): all splits (``first`` null) and skips of the words, by pair of nodes.

    ``key`` orders words: commonest first, then by code points, which in one branch is the order of ``num``.
    ``first`` is false where the character before the skipped one is the same, as skipping that one gives the same word.
    """
    rows = dictionary.select(
        F.struct((-F.col("n")).alias("neg"), F.substring("word", 1, NEAR).alias("head"), "num").alias("key"), "fwd", "rev", F.size("fwd").alias("size"), F.split("word", "").alias("letters"),
    )
    pairs = F.expr("""concat(
        transform(sequence(0, size - 1), i -> struct(fwd[i] AS p, rev[size - 1 - i] AS s, CAST(null AS boolean) AS first)),
        transform(filter(sequence(0, size - 1), i -> i < size - 1), i -> struct(fwd[i] AS p, rev[size - 2 - i] AS s, i = 0 OR letters[i] <> letters[greatest(i - 1, 0)] AS first)))""")
    return rows.select("key", F.inline(pairs))


def near_words(dictionary: DataFrame) -> DataFrame:
    """(num, n_near, best) of the words of :func:`numbered` that have near words: how many, and the commonest."""
    split, skip = F.col("first").isNull(), F.col("first").isNotNull()
    groups = (
        _nodes(dictionary).groupBy("p", "s").agg(F.array_sort(F.collect_list(F.when(skip, F.struct("key", "first")))).alias("skips"), F.max(F.when(split, F.col("key"))).alias("whole"))
        .where(F.size("skips") + F.col("whole").isNotNull().cast("int") > 1)
    )
    members = F.expr("""concat(
        transform(skips, x -> struct(x.key.num AS num, size(skips) - 1 + CAST(x.first AND whole IS NOT NULL AS int) AS n_near,
            least(CASE WHEN size(skips) > 1 THEN IF(x.key.num = skips[0].key.num, skips[1].key, skips[0].key) END, IF(x.first, whole, null)) AS best)),
        IF(whole IS NULL, array(), array(struct(whole.num AS num, size(filter(skips, x -> x.first)) AS n_near, get(filter(skips, x -> x.first), 0).key AS best))))""")
    return groups.select(F.inline(members)).where("n_near > 0").groupBy("num").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def _roots(scratch: Scratch, forms: DataFrame) -> DataFrame:
    """(num, root): the ends of the chains ``num -> form``, by doubling.

    A form has at least twice its word's occurrences, so chains are short and there are few rounds.
    """
    at = scratch.cut(forms.select("num", F.col("form").alias("root")))
    while True:
        further = at.select(F.col("num").alias("root"), F.col("root").alias("next"))
        moved = at.join(further, "root", "left").select("num", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        moved = scratch.cut(moved)
        at = moved.select("num", "root")
        if moved.where("moved").isEmpty():
            return at


def variants(words: DataFrame, *, ratio: int = RATIO) -> DataFrame:
    """One row per word of ``words`` (word, n): word, form, root, n, n_near, form_n.

    ``form`` is the near word (one inserted, deleted or replaced character) of largest n, ties to the smallest in code-point
    order, if that n is at least ``ratio`` times the word's; ``root`` follows forms to the last.
    """
    with Scratch() as scratch:
        counted = scratch.cut(words)
        dictionary = scratch.cut(numbered(counted))
        near = near_words(dictionary).select("num", "n_near", F.col("best.num").alias("best"), (-F.col("best.neg")).alias("best_n"))
        plain = dictionary.select("num", "word", "n")
        known = scratch.cut(plain.join(near, "num", "left").withColumn("form", F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best"))))
        roots = _roots(scratch, known.where("form IS NOT NULL").select("num", "form"))
        named = lambda key, out: plain.select(F.col("num").alias(key), F.col("word").alias(out))
        formed = known.where("form IS NOT NULL").join(roots, "num").join(named("form", "form_word"), "form").join(named("root", "root_word"), "root")
        one = formed.select("word", F.col("form_word").alias("form"), F.col("root_word").alias("root"), "n", "n_near", F.col("best_n").alias("form_n"))
        own = known.where("form IS NULL").select(
            "word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.lit(None).cast("bigint").alias("form_n")
        )
        return cut(one.unionByName(own))


def misspelt(doc_id: Column, word: Column) -> Column:
    """The contract's planted misspellings: where 97 divides crc32 of ``doc_id:word``, the word lacks one character."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))
    at = (h % F.length(word)).cast("int")
    return F.when(h % 97 == 0, F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))).otherwise(word)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: spelling variants among the words of all documents."""
    return variants(word_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), alter=misspelt))


#: Words by brute arithmetic (CRC-32 over a table made here) and neighbours by strings with one position cut out.
ORACLE = """
WITH RECURSIVE steps(b, c, k) AS (
  SELECT range, range::BIGINT, 0 FROM range(256)
  UNION ALL SELECT b, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM steps WHERE k = 8),
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
occurring AS (SELECT doc_id, run, count(*) AS times FROM runs WHERE length(run) >= 5 GROUP BY ALL),
bytes AS (SELECT run, times, hex(coalesce(doc_id::VARCHAR, '') || ':' || run) AS x FROM occurring),
hashed AS (
  SELECT run, times, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(x) // 2), lambda i: ('0x' || x[2 * i + 1 : 2 * i + 2])::BIGINT)),
    lambda a, v: xor(a >> 8, t[(xor(a, v) & 255) + 1])), 4294967295::BIGINT) AS h FROM bytes, crc),
spelled AS (
  SELECT CASE WHEN h % 97 = 0 THEN run[1 : h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word, times FROM hashed),
words AS (SELECT word, sum(times)::BIGINT AS n FROM spelled WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
cuts AS (SELECT word, n, i, word[1 : i] || word[i + 2 :] AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word),
best AS (SELECT word, n, other, other_n, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS place FROM near),
forms AS (SELECT word, n_near, CASE WHEN other_n >= 2 * n THEN other END AS form, CASE WHEN other_n >= 2 * n THEN other_n END AS form_n FROM best WHERE place = 1),
chains(word, node, k) AS (SELECT word, word, 0 FROM words UNION ALL SELECT c.word, f.form, c.k + 1 FROM chains c JOIN forms f ON c.node = f.word WHERE f.form IS NOT NULL),
roots AS (SELECT word, arg_max(node, k) AS root FROM chains GROUP BY word)
SELECT w.word, f.form, r.root, w.n, coalesce(f.n_near, 0)::BIGINT AS n_near, f.form_n::BIGINT AS form_n FROM words w LEFT JOIN forms f USING (word) JOIN roots r USING (word)
"""
