"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts are compared as words with one space between them, with the capital letters
of ASCII and Latin-1 made small, byte by byte. A benchmark item is sought as a
whole, or in overlapping segments of :data:`SEGMENT` bytes where it is longer, with
an edit budget of k = ``rate`` times the length, rounded down. A region within the
budget shares at least n + 1 - q (k + 1) q-grams with the segment on k + 1
neighbouring diagonals. So shared q-grams are counted, row by row, in overlapping
bands of diagonals, bands that meet the bound are aligned, and those within the
budget are reported. q is 8 bytes, or the longest for which the bound is positive
where that is less. An item without a budget (under 10 bytes at the usual rate) is
sought as whole words: with a space on either side.

What is found is what the edit distance to all regions of a text would find, in
whatever chunks the rows come. A region's ``edits`` are its fewest; its words
``first`` .. ``upto`` are those that its longest extent touches, regions of one item
that meet being joined.

The benchmark is a stated query set, put in blocks of about ``block_bytes`` bytes (or
of one item) against whole texts. Only one block is held at a time, by the driver
as by the workers; where there are several, the result of each is written before
the next. No rows are joined or shuffled. Null and empty texts have no regions,
null and empty items (or null ids) are not sought; items that repeat an id are one
item. Each row is searched by itself; null and repeated doc_ids are rows like any
other, further columns are ignored, or kept by :func:`clean`. Empty tables find nothing.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import cut, drop, fresh
from millrace.llm.ragged import Texts, chunks

Q, SEGMENT, STEP = 8, 128, 16
RATE, MOST_RATE = 0.1, 0.25
BLOCK_BYTES = 1 << 20
TABLE_BITS = 23
FAR = 1 << 20
_KEY = np.uint64(0x9E3779B97F4A7C15)


def _lower(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the words of all rows with a space before, between and after them; where each word starts."""
    capital = (t.data >= 65) & (t.data <= 90)
    capital[1:] |= (t.data[:-1] == 0xC3) & (t.data[1:] >= 0x80) & (t.data[1:] <= 0x9E) & (t.data[1:] != 0x97)
    plain, begin = t.split().joined(t.data + np.where(capital, np.uint8(32), np.uint8(0)))
    return np.concatenate([np.full(1, 32, np.uint8), plain]), begin + 1


def _codes(plain: np.ndarray, q: int) -> np.ndarray:
    """The q bytes from each place on as one integer."""
    padded = np.concatenate([plain, np.zeros(8 - q, np.uint8)])
    eight = np.ndarray((max(len(plain) - q + 1, 0),), "<u8", padded, strides=(1,)) if len(padded) >= 8 else np.zeros(0, np.uint64)
    return eight & np.uint64((1 << 8 * q) - 1)


class Grams:
    """The places of all q-grams of the segments that are sought by this q."""

    def __init__(self, q: int, segments: list[tuple[int, np.ndarray]]) -> None:
        self.q = q
        codes = [_codes(s, q) for _, s in segments]
        every = np.concatenate(codes)
        order = np.argsort(every, kind="stable")
        self.owner = np.repeat(np.array([k for k, _ in segments], np.int32), [len(c) for c in codes])[order]
        self.place = np.concatenate([np.arange(len(c), dtype=np.int32) for c in codes])[order]
        self.codes, first = np.unique(every[order], return_index=True)
        self.first = np.append(first, len(every))
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[self._slot(self.codes)] = True

    @staticmethod
    def _slot(codes: np.ndarray) -> np.ndarray:
        return (codes * _KEY) >> np.uint64(64 - TABLE_BITS)

    def hits(self, plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of shared q-grams in ``plain``, and the numbers of the grams that they equal."""
        codes = _codes(plain, self.q)
        at = np.flatnonzero(self.table[self._slot(codes)])
        slot = np.minimum(np.searchsorted(self.codes, codes[at]), len(self.codes) - 1)
        exact = self.codes[slot] == codes[at]
        at, slot = at[exact], slot[exact]
        counts = self.first[slot + 1] - self.first[slot]
        hit = np.repeat(np.arange(len(at)), counts)
        return at[hit], np.arange(len(hit)) - (np.cumsum(counts) - counts)[hit] + self.first[slot][hit]


class Patterns:
    """Segments of benchmark items, their budgets and their q-grams."""

    def __init__(self, items: list[tuple[int, str]], rate: float) -> None:
        if not 0 <= rate <= MOST_RATE:
            raise ValueError(f"the rate must lie between 0 and {MOST_RATE}")
        segments, owners, margins = [], [], []
        for item, text in items:
            whole = _lower(next(chunks(pa.array([text], pa.large_string()))))[0]
            plain = whole[1:-1]
            if not len(plain):
                continue
            if int(rate * len(plain) + 1e-9) == 0 and len(whole) <= SEGMENT:
                found = [(whole, 1)]
            else:
                starts = sorted({*range(0, max(len(plain) - SEGMENT, 1), SEGMENT // 2), max(len(plain) - SEGMENT, 0)})
                found = [(plain[at : at + SEGMENT], 0) for at in starts]
            for segment, margin in found:
                segments.append(segment)
                owners.append(item)
                margins.append(margin)
        self.items, self.margin = np.array(owners, np.int64), np.array(margins, np.int64)
        self.sizes = np.array([len(s) for s in segments], np.int64)
        self.budget = np.where(self.margin == 1, 0, (rate * self.sizes + 1e-9).astype(np.int64))
        self.step = int(max(STEP, self.budget.max(initial=0)))
        own_q = np.minimum(Q, self.sizes // (self.budget + 1))
        self.least = self.sizes + 1 - own_q * (self.budget + 1)
        self.grams = [Grams(int(q), [(k, segments[k]) for k in np.flatnonzero(own_q == q)]) for q in np.unique(own_q)]
        self.padded = np.zeros((len(segments), SEGMENT), np.uint8)
        for k, s in enumerate(segments):
            self.padded[k, : len(s)] = s


def _bands(p: Patterns, plain: np.ndarray, row_at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segment, row and first diagonal of each band that shares enough q-grams. Row r is ``plain[row_at[r] : row_at[r + 1] + 1]``."""
    # each row has bands of its own, with an empty one before them
    n_bands = (np.diff(row_at) + 1 + SEGMENT) // p.step + 2
    band_at = np.cumsum(n_bands) - n_bands
    width = int(n_bands.sum())
    found = []
    for g in p.grams:
        at, ref = g.hits(plain)
        row = np.searchsorted(row_at, at, "right") - 1
        inside = (row < len(n_bands)) & (at + g.q <= row_at[np.minimum(row + 1, len(row_at) - 1)] + 1)
        at, ref, row = at[inside], ref[inside], row[inside]
        found.append(g.owner[ref] * np.int64(width) + band_at[row] + 1 + (at - row_at[row] - g.place[ref] + SEGMENT) // p.step)
    keys = np.sort(np.concatenate(found))
    # a band is 2 * step diagonals: those of its own step and of the next one
    bounds = np.flatnonzero(np.diff(keys, prepend=-1, append=-1))
    own, n = keys[bounds[:-1]], np.diff(bounds)
    both = np.sort(np.concatenate([own, own - 1]))
    both = both[np.diff(both, prepend=-2) != 0]
    upto = np.concatenate([[0], np.cumsum(n)])
    total = upto[np.searchsorted(own, both + 1, "right")] - upto[np.searchsorted(own, both)]
    both = both[total >= p.least[both // width]]
    segment, band = both // width, both % width
    row = np.searchsorted(band_at, band, "right") - 1
    return segment, row, row_at[row] + (band - band_at[row] - 1) * p.step - SEGMENT


def _align(p: Patterns, plain: np.ndarray, lows: np.ndarray, highs: np.ndarray, segment: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewest edits, and the place after the last byte, of a region of ``plain[low:high]`` on the diagonals of the band at ``first``."""
    width = 4 * p.step + 1
    cost = np.zeros((len(segment), width), np.int32)
    steps = np.arange(width, dtype=np.int32)
    best = np.full(len(segment), FAR, np.int32)
    end = np.zeros(len(segment), np.int64)
    base = first[:, None] - p.step + steps
    sizes = p.sizes[segment]
    for i in range(int(sizes.max(initial=0))):
        j = base + i
        equal = (j >= lows[:, None]) & (j < highs[:, None]) & (plain[np.clip(j, 0, len(plain) - 1)] == p.padded[segment, i][:, None])
        # band column b at row i + 1 ends just after text place first - step + b + i
        skip = np.full_like(cost, FAR)
        skip[:, :-1] = cost[:, 1:] + 1
        now = np.minimum(cost + ~equal, skip)
        now = np.minimum.accumulate(now - steps, axis=1) + steps
        ends = sizes == i + 1
        if ends.any():
            k = now[ends].argmin(1)
            best[ends] = now[ends, k]
            end[ends] = first[ends] - p.step + k + i + 1
        cost = now
    return best, np.clip(end, lows, highs)


def _regions(p: Patterns, t: Texts, block: int = 2048) -> list[tuple[int, int, int, int, int]]:
    """(row, item, first word, word after, edits) of the regions within the budget, joined where they meet."""
    if not len(p.items):
        return []
    plain, begin = _lower(t)
    row_at = np.append(begin - 1, len(plain) - 1)[t.at]
    every = _bands(p, plain, row_at)
    out: dict[tuple[int, int], list] = {}
    for lo in range(0, len(every[0]), block):
        segment, row, start = (x[lo : lo + block] for x in every)
        margin = p.margin[segment]
        edits, end = _align(p, plain, row_at[row] + 1 - margin, row_at[row + 1] + margin, segment, start)
        near = edits <= p.budget[segment]
        segment, row, end, edits, margin = segment[near], row[near], end[near], edits[near], margin[near]
        a = np.searchsorted(begin, end - p.sizes[segment] - edits + margin, "right") - 1
        b = np.searchsorted(begin, end - 1 - margin, "right")
        spans = np.column_stack([np.maximum(a, t.at[row]) - t.at[row], b - t.at[row], edits]).tolist()
        for r, item, span in zip(row.tolist(), p.items[segment].tolist(), spans, strict=True):
            out.setdefault((r, item), []).append(span)
    merged = []
    for (r, item), spans in sorted(out.items()):
        spans.sort()
        now = spans[0]
        for a, b, x in spans[1:]:
            if a <= now[1]:
                now = [now[0], max(now[1], b), min(now[2], x)]
            else:
                merged.append((r, item, *now))
                now = [a, b, x]
        merged.append((r, item, *now))
    return merged


REGIONS = "array<struct<item_id: bigint, first: bigint, upto: bigint, edits: int>>"
_built: dict[bytes, Patterns] = {}


def _patterns(name: bytes, items: list[tuple[int, str]], rate: float) -> Patterns:
    """The patterns of a block, built once in a worker, which holds one block at a time."""
    if name not in _built:
        _built.clear()
        _built[name] = Patterns(items, rate)
    return _built[name]


def _search(docs: DataFrame, items: list[tuple[int, str]], rate: float) -> Column:
    """A column of the regions of ``docs`` that repeat one of ``items``."""
    Patterns([], rate)
    shared = docs.sparkSession.sparkContext.broadcast(items)
    name = hashlib.sha256(pickle.dumps((items, rate))).digest()

    def search(texts: pa.Array) -> pa.Array:
        p = _patterns(name, shared.value, rate)
        rows: list[list] = [[] for _ in range(len(texts))]
        for t in chunks(texts, 1 << 20):
            for r, item, first, upto, edits in _regions(p, t):
                rows[t.first + r].append({"item_id": item, "first": first, "upto": upto, "edits": edits})
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("first", pa.int64()), ("upto", pa.int64()), ("edits", pa.int32())]))
        return pa.array(rows, kind)

    return F.arrow_udf(search, REGIONS).asNondeterministic()("text")


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[tuple[list[tuple[int, str]], int]]:
    """The items in blocks of about half of ``block_bytes``, or in one that has as much at most; with the number of blocks."""
    items = benchmark.where("text IS NOT NULL AND item_id IS NOT NULL").select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 if total <= block_bytes else 2 * -(-total // block_bytes)
    for k in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k) if blocks > 1 else items
        yield [tuple(r) for r in part.orderBy("item_id", "text").collect()], blocks


def contaminated(docs: DataFrame, benchmark: DataFrame, *, rate: float = RATE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, first, upto, edits) of every region that repeats a benchmark item."""
    found = []
    for items, blocks in _blocks(benchmark, block_bytes):
        rows = docs.select("doc_id", F.explode(_search(docs, items, rate)).alias("r")).select("doc_id", "r.*")
        found.append(rows if blocks == 1 else cut(rows))
    return reduce(DataFrame.unionAll, found)


def clean(docs: DataFrame, benchmark: DataFrame, *, rate: float = RATE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents without such a region, with their own columns."""
    name, left = fresh(docs, "regions"), docs
    for items, blocks in _blocks(benchmark, block_bytes):
        rest = left.withColumn(name, _search(left, items, rate)).where(F.size(name) == 0).select(docs.columns)
        before, left = left, rest if blocks == 1 else cut(rest)
        if before is not docs:
            drop(before)
    return left


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: where documents repeat benchmark items."""
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
