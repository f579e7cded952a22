"""Ranked lexical search of stated items over all documents, by buckets of vector length.

A document's impact of a term grows with its occurrences and shrinks with the document's
length; an item's score for a document is the inner product of its term weights with the
document's impacts. Documents become sparse vectors over the terms of the items (no other
term can add to a score) and are ordered by vector length, longest first:

* the table of vectors is searched in bands of length. Each band starts with the score that
  an item's worst kept document had after the bands before, so later bands drop most at once;
* a task cuts its band into buckets of neighbouring lengths. By Cauchy-Schwarz a bucket whose
  longest vector times the item's length stays below that score is left out, and so are the
  shorter vectors at the end of a bucket;
* inside a bucket an item's strongest terms are its focus: the others, together, can't reach the
  score with the largest coordinates of the bucket. Only documents with a focus term are candidates,
  and one stays if its inner product over the focus plus the largest that both remainders' lengths allow reaches the score;
* the candidates that stay are scored again in integers. Bounds are taken with a margin for rounding, so results are exact.

Documents without a term, null and empty texts are never found; null and empty items find nothing. Repeated rows
are documents of their own; repeated items (same id and text) are one. Equal scores are ordered by doc_id, null last.
Further columns are ignored.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import Scratch, cut
from millrace.llm.ragged import BYTE, chunks, rolling

TOP = 10
SATURATION, SHARE = 1000, 75
#: Bytes of item texts that are searched at once; their terms and weights are what every task holds.
BLOCK_BYTES = 4 << 20
#: Documents of a bucket, and the shares of the longest vectors that the first bands hold.
BUCKET, BANDS = 4096, (1 / 64, 1 / 8)
MARGIN = 1e-9
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
VECTORS = "doc_id bigint, n bigint, terms array<int>, times array<bigint>"
FOUND = "item int, doc_id bigint, score bigint"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BETWEEN = np.ones(256, bool)
_BETWEEN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


class Items:
    """The terms of one block of items, as a vocabulary, and each item's terms with their counts."""

    def __init__(self, rows: list[tuple[object, list[str]]]) -> None:
        self.ids = [i for i, _ in rows]
        terms = sorted({t.encode() for _, ts in rows for t in ts})
        number = {t: k for k, t in enumerate(terms)}
        self.counts = []
        for _, ts in rows:
            own, times = np.unique(np.array([number[t.encode()] for t in ts], np.int64), return_counts=True)
            self.counts.append((own, times.astype(np.int64)))
        self.size = len(terms)
        self.data = np.frombuffer(b"".join(terms), np.uint8)
        self.ends = np.cumsum([len(t) for t in terms]).astype(np.int64)
        self.starts = self.ends - np.array([len(t) for t in terms], np.int64)
        hashes = rolling(BYTE[self.data], self.starts, self.ends)
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the words ``data[start:end]`` are terms, and their numbers: by hash, then by their bytes."""
        if not self.size or not len(starts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        hashes = rolling(BYTE[data], starts, ends)
        words, terms = [], []
        at = np.searchsorted(self.hashes, hashes)
        hit = np.flatnonzero(self.hashes[np.minimum(at, self.size - 1)] == hashes)
        at = at[hit]
        while len(hit):  # terms of one hash stand beside each other
            term = self.order[at]
            same = self._equal(data, starts[hit], ends[hit], term)
            words.append(hit[same])
            terms.append(term[same])
            further = ~same & (at + 1 < self.size)
            hit, at = hit[further], at[further] + 1
            again = self.hashes[at] == hashes[hit]
            hit, at = hit[again], at[again]
        return (np.concatenate(words), np.concatenate(terms)) if words else (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def _equal(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, term: np.ndarray) -> np.ndarray:
        length = ends - starts
        same = length == self.ends[term] - self.starts[term]
        length = np.where(same, length, 0)
        first = np.cumsum(length) - length
        inside = np.arange(int(length.sum())) - np.repeat(first, length)
        differs = data[np.repeat(starts, length) + inside] != self.data[np.repeat(self.starts[term], length) + inside]
        owner = np.repeat(np.arange(len(term)), length)
        same[owner[differs]] = False
        return same


def vectors(docs: DataFrame, items: Items) -> DataFrame:
    """(doc_id, n, terms, times): each document's number of terms, and how often it holds which terms of the items."""
    held = docs.sparkSession.sparkContext.broadcast(items)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for batch in batches:
            ids = batch.column(0)
            for t in chunks(batch.column(1)):
                t.split(_BETWEEN)
                n = t.n_words
                words, terms = own.find(_LOWER[t.data], t.starts, t.ends)
                rows = np.searchsorted(t.at, words, "right") - 1
                keys, times = np.unique(rows * max(own.size, 1) + terms, return_counts=True)
                ends = np.searchsorted(keys, np.arange(t.rows + 1) * max(own.size, 1)).astype(np.int32)
                terms = (keys % max(own.size, 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(t.first, t.rows), pa.array(n.astype(np.int64)), pa.ListArray.from_arrays(pa.array(ends), pa.array(terms)), pa.ListArray.from_arrays(pa.array(ends), pa.array(times.astype(np.int64)))],
                    ["doc_id", "n", "terms", "times"],
                )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(count, VECTORS)


class Weights:
    """Term weights of a block from the corpus's counts, and the impacts of documents."""

    def __init__(self, items: Items, documents: int, length: int, holding: dict[int, int]) -> None:
        self.documents, self.length = documents, length
        self.w = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * holding.get(t, 0) + 1))) for t in range(items.size)], np.int64)
        self.root = np.sqrt(self.w.astype(float))
        self.items = items.counts

    def impacts(self, n: np.ndarray, times: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Impact of each term of documents with ``n`` terms in all, ``sizes`` of them held; integers, rounded down."""
        if len(n) and SHARE * int(n.max()) * self.documents >= 1 << 63:
            share = np.array([SHARE * int(k) * self.documents // self.length for k in n], np.int64)
        else:
            share = SHARE * n * self.documents // self.length
        m = np.repeat(100 - SHARE + share, sizes)
        return 1_000_000_000 * times // (SATURATION * times + 8 * m)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy()[offsets[0] : offsets[-1]], offsets - offsets[0]


def _with_lengths(table: DataFrame, held) -> DataFrame:
    """``table`` with ``norm``, the length of the vector of impacts, each times the square root of its term's weight."""

    def norm(n: pa.Array, terms: pa.Array, times: pa.Array) -> pa.Array:
        own = held.value
        terms, at = _flat(terms)
        times, _ = _flat(times)
        squares = np.zeros(len(terms) + 1)
        np.cumsum((own.root[terms] * own.impacts(n.to_numpy(), times, np.diff(at))) ** 2, out=squares[1:])
        # differences of running sums lose digits; a length is a bound, so it may be a little too large but not too small
        return pa.array(np.sqrt(np.maximum(np.diff(squares[at]), 0) + 1e-12 * squares[-1]))

    return table.withColumn("norm", F.arrow_udf(norm, "double")("n", "terms", "times"))


class Bucket:
    """Neighbours by length: their coordinates by row and by term."""

    def __init__(self, ids: list, n: np.ndarray, norm: np.ndarray, terms: np.ndarray, times: np.ndarray, at: np.ndarray, weights: Weights) -> None:
        order = np.argsort(-norm, kind="stable")
        self.ids, self.norm = [ids[k] for k in order.tolist()], norm[order]
        sizes = np.diff(at)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        rows = np.repeat(place, sizes)
        impact = weights.impacts(n, times, sizes)
        by_term = np.lexsort((rows, terms))
        self.terms, self.rows, self.impact = terms[by_term], rows[by_term], impact[by_term]
        self.value = weights.root[self.terms] * self.impact
        first = np.flatnonzero(np.diff(self.terms, prepend=-1))
        self.first = np.append(first, len(self.terms))
        self.held = self.terms[first]
        self.most = np.maximum.reduceat(self.value, first) if len(first) else np.zeros(0)

    def search(self, own: np.ndarray, times: np.ndarray, weights: Weights, least: int, top: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of documents that may be among the ``top`` best, given that ``least`` is reached by as many already."""
        q = weights.root[own] * times
        length = math.sqrt(float(q @ q))
        floor = least * (1 - MARGIN)
        reach = len(self.norm) if not least else int(np.searchsorted(-self.norm, -floor / length if length else 0, "right"))
        at = np.searchsorted(self.held, own)
        here = self.held[np.minimum(at, len(self.held) - 1)] == own if len(self.held) else np.zeros(len(own), bool)
        if not reach or not here.any():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, q, wanted = at[here], q[here], (times * weights.w[own])[here]
        bound = q * self.most[at]
        order = np.argsort(-bound, kind="stable")
        at, q, bound, wanted = at[order], q[order], bound[order], wanted[order]
        rest = np.append(np.cumsum(bound[::-1])[::-1], 0.0)  # the most that terms from here on can add
        rest_length = np.sqrt(np.append(np.cumsum((q * q)[::-1])[::-1], 0.0))
        beyond = np.minimum(rest, rest_length * self.norm[0])
        focus = max(1, int(np.argmax(beyond < floor))) if least else len(q)
        partial, square = np.zeros(reach), np.zeros(reach)
        for k in range(focus):
            a, b = self.first[at[k]], self.first[at[k] + 1]
            b = a + int(np.searchsorted(self.rows[a:b], reach))
            partial[self.rows[a:b]] += q[k] * self.value[a:b]
            square[self.rows[a:b]] += self.value[a:b] ** 2
        if reach > top:
            floor = max(floor, float(np.partition(partial, reach - top)[reach - top]) * (1 - MARGIN))
        left = np.sqrt(np.maximum(self.norm[:reach] ** 2 - square, 0) + MARGIN * self.norm[:reach] ** 2)
        stays = np.flatnonzero((partial > 0) & (partial + np.minimum(rest[focus], rest_length[focus] * left) * (1 + MARGIN) >= floor))
        if not len(stays):
            return stays, stays
        score, among = np.zeros(len(stays), np.int64), np.full(len(self.norm), -1, np.int64)
        among[stays] = np.arange(len(stays))
        for k in range(len(q)):
            a, b = self.first[at[k]], self.first[at[k] + 1]
            to = among[self.rows[a:b]]
            inside = to >= 0
            score[to[inside]] += wanted[k] * self.impact[a:b][inside]
        good = (score > 0) & (score >= least)
        return stays[good], score[good]


def _best(found: list[tuple[int, bool, int]], top: int) -> list[tuple[int, bool, int]]:
    """The ``top`` best of (-score, doc_id is null, doc_id)."""
    return sorted(found)[:top]


def _searched(table: DataFrame, held, least: list[int], top: int) -> DataFrame:
    """(item, doc_id, score): for each item at least the ``top`` best rows of ``table`` that reach its score in ``least``."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        bar, best = list(least), [[] for _ in own.items]
        for batch in batches:
            for first in range(0, batch.num_rows, BUCKET):
                part = batch.slice(first, BUCKET)
                (terms, at), (times, _) = _flat(part.column("terms")), _flat(part.column("times"))
                bucket = Bucket(part.column("doc_id").to_pylist(), part.column("n").to_numpy(), part.column("norm").to_numpy(), terms, times, at, own)
                for i, (wanted, often) in enumerate(own.items):
                    rows, scores = bucket.search(wanted, often, own, bar[i], top)
                    if len(rows):
                        ids = [bucket.ids[k] for k in rows.tolist()]
                        best[i] = _best(best[i] + [(-s, d is None, d or 0) for s, d in zip(scores.tolist(), ids, strict=True)], top)
                        if len(best[i]) == top:
                            bar[i] = max(bar[i], -best[i][-1][0])
        flat = [(i, None if unknown else d, -s) for i, rows in enumerate(best) for s, unknown, d in rows]
        columns = list(zip(*flat, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], ["item", "doc_id", "score"])

    return table.mapInArrow(search, FOUND)


def _ranked(found: DataFrame, top: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return found.withColumn("rank", place).where(F.col("rank") <= top)


def _search_block(docs: DataFrame, items: Items, top: int) -> DataFrame:
    """(item, rank, doc_id, score) of one block of items."""
    context = docs.sparkSession.sparkContext
    with Scratch() as scratch:
        table = scratch.cut(vectors(docs, items))
        documents, length = table.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        holding = dict(map(tuple, table.select(F.explode("terms").alias("term")).groupBy("term").count().collect()))
        held = context.broadcast(Weights(items, documents, max(length, 1), holding))
        long = _with_lengths(table.where(F.size("terms") > 0), held).sortWithinPartitions(F.desc("norm"))
        long = scratch.cut(long)
        cuts = [math.inf, *(long.agg(F.percentile_approx("norm", [1 - share for share in BANDS], 1000)).first()[0] or []), -math.inf]
        found, least = None, [0] * len(items.ids)
        for above, upto in zip(cuts, cuts[1:], strict=False):
            band = long.where((F.col("norm") < above) & (F.col("norm") >= upto))
            rows = _searched(band, held, least, top)
            found = scratch.cut(_ranked(rows if found is None else rows.unionByName(found.drop("rank")), top))
            for item, score in found.where(F.col("rank") == top).select("item", "score").collect():
                least[item] = score
        return cut(found)


def search(docs: DataFrame, items: DataFrame, *, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of each row of ``items`` (item_id, text).

    Items are searched in blocks of about ``block_bytes``; what the driver and every task hold of one block is its terms, its
    items' counts of them, and ``top`` rows for each item. A block reads the documents once and its own vectors four times.
    """
    spark = docs.sparkSession
    words = F.regexp_extract_all(F.translate("text", string.ascii_uppercase, string.ascii_lowercase), F.lit(TERM), F.lit(0))
    asked = items.where(F.length("text") > 0).select("item_id", "text").distinct()
    total = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, results = max(1, -(-total // block_bytes)), []
    for k in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).select("item_id", words.alias("words"), "text").orderBy("item_id", "text").collect()
        block = Items([(r.item_id, r.words) for r in rows])
        names = spark.createDataFrame(list(enumerate(block.ids)), f"item int, item_id {items.schema['item_id'].dataType.simpleString()}")
        results.append(_search_block(docs, block, top).join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: the ten best documents for each benchmark item."""
    return search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE = r"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
size AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM docs WHERE len(terms) > 0),
held AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM docs) GROUP BY ALL),
weight AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM held, size GROUP BY term, n_docs),
impact AS (SELECT h.r, d.doc_id, h.term, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len(d.terms) * n_docs) // n_terms))) AS x FROM held h JOIN docs d USING (r) JOIN weight USING (term), size),
asked AS (
  SELECT item_id, text, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)),
scores AS (SELECT item_id, text, r, doc_id, sum(x)::BIGINT AS score FROM asked JOIN impact USING (term) GROUP BY ALL HAVING sum(x) > 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank FROM scores)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 10
"""
