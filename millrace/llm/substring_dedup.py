"""Removal of repeated passages with suffixes filed by prefixes.

Suffixes start at words. A first pass counts, over all rows, how many suffixes
start with each prefix of 1, 2, 4, 8 and 13 words (hashed to :data:`BUCKETS` buckets a
length); a suffix is filed under its shortest prefix whose bucket holds at most a
sixteenth of ``tree_suffixes`` suffixes, else under all 13 words. Prefixes are
dealt over groups of about ``tree_suffixes``. A group doesn't hold the words of its
suffixes and builds no tree of them: it is sorted by 64-bit fingerprints of the
first 13 words, and equal ones, which are the leaves below one node of depth 13, are a
repeat if they lie in more than one document. Those outside the smallest doc_id
are windows to remove. Overlapping windows join into the repeats that are cut out.

Equal windows inside one chunk of rows are settled there: only those of its
smallest doc_id travel on, so a passage found everywhere costs one entry a chunk.

Null and empty texts have no words; the hash is then that of the empty string. A
null doc_id counts as larger than any other. Rows that repeat a doc_id count as
one document, so they remove nothing from each other. Further columns are
ignored; an empty table gives an empty result. ``docs`` is read three times; any
plan but columns and filters of files is written out first, so that the readings agree.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import cut
from millrace.llm.ragged import Texts, chunks, covered, rolling

WINDOW = 13
LEVELS = (1, 2, 4, 8, 13)
BUCKETS = 4096
TREE_SUFFIXES = 1 << 20
CHUNK_BYTES = 4 << 20
LAST = np.iinfo(np.int64).max


def _scan(batches):
    """Chunks of whole rows with their ids, from batches of (doc_id, text)."""
    for batch in batches:
        ids = batch.column(0).fill_null(LAST).to_numpy(zero_copy_only=False)
        for t in chunks(batch.column(1), CHUNK_BYTES):
            yield t.split(), ids[t.first : t.first + t.rows]


def _identity(t: Texts, ids: np.ndarray) -> int:
    h = xxhash.xxh64(t.data.tobytes())
    h.update(t.bounds.tobytes())
    h.update(ids.tobytes())
    return h.intdigest() - (1 << 63)


def _prefixes(words: np.ndarray, at: np.ndarray):
    for size in LEVELS:
        yield rolling(words, at, at + size)


def _window_hashes(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    words = t.word_hashes()
    at, rows = t.windows(WINDOW)
    return words, at, rows


def _counts(batches):
    total = np.zeros((len(LEVELS), BUCKETS), np.int64)
    for t, _ in _scan(batches):
        words, at, _ = _window_hashes(t)
        for k, h in enumerate(_prefixes(words, at)):
            total[k] += np.bincount((h & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
    level, bucket = np.nonzero(total)
    yield pa.record_batch([pa.array(level.astype(np.int32)), pa.array(bucket.astype(np.int32)), pa.array(total[level, bucket])], ["level", "bucket", "n"])


def _file(words: np.ndarray, at: np.ndarray, heavy: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint of each window and the group of its variable-length prefix."""
    group = np.zeros(len(at), np.uint64)
    open_ = np.ones(len(at), bool)
    for k, h in enumerate(_prefixes(words, at)):
        here = open_ & (~heavy[k][(h & np.uint64(BUCKETS - 1)).astype(np.int64)] | (k == len(LEVELS) - 1))
        group[here] = (h[here] >> np.uint64(20)) % np.uint64(groups)
        open_ &= ~here
    return h, group.astype(np.int64)


def _later(keys: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which suffixes lie, under their node, outside its smallest id."""
    if not len(keys):
        return np.zeros(0, bool)
    order = np.argsort(keys)
    sorted_keys, sorted_ids = keys[order], ids[order]
    first = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))
    least = np.repeat(np.minimum.reduceat(sorted_ids, first), np.diff(np.append(first, len(keys))))
    out = np.zeros(len(keys), bool)
    out[order] = sorted_ids > least
    return out


def _planes(values: np.ndarray) -> bytes:
    """Bytes of integers, byte by byte of significance: the high ones compress away."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _from_planes(raw: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(raw, np.uint8).reshape(size, -1).T.copy().view(kind).ravel()


def _suffixes(heavy: np.ndarray, groups: int):
    def run(batches):
        for t, ids in _scan(batches):
            words, at, rows = _window_hashes(t)
            h, group = _file(words, at, heavy, groups)
            sent = ~_later(h, ids[rows])
            h, group, at, rows = h[sent], group[sent], at[sent], rows[sent]
            order = np.argsort(group, kind="stable")
            h, group, at, rows = h[order], group[order], at[order], rows[order]
            bounds = np.flatnonzero(np.diff(group, prepend=-1, append=-1)) if len(group) else np.zeros(1, np.int64)
            chunk, out = _identity(t, ids), []
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                places = np.diff(at[lo:hi], prepend=0).astype(np.uint32)
                own, which = np.unique(rows[lo:hi], return_inverse=True)
                steps = np.diff(ids[own], prepend=0)
                out.append((int(group[lo]), chunk, h[lo:hi].tobytes(), _planes(places), _planes(np.bincount(which).astype(np.uint32)), _planes(steps)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["grp", "chunk", "h", "places", "counts", "ids"])

    return run


def _tree(table: pa.Table) -> pa.Table:
    """Windows that one group's part of the suffix tree shows to be repeats, by chunk."""
    hashes = [np.frombuffer(x, np.uint64) for x in table["h"].to_pylist()]
    places = [np.cumsum(_from_planes(x, np.uint32), dtype=np.int64) for x in table["places"].to_pylist()]
    ids = [np.repeat(np.cumsum(_from_planes(i, np.int64)), _from_planes(c, np.uint32)) for i, c in zip(table["ids"].to_pylist(), table["counts"].to_pylist(), strict=True)]
    later = _later(np.concatenate(hashes), np.concatenate(ids))
    out, lo = [], 0
    for chunk, at in zip(table["chunk"].to_pylist(), places, strict=True):
        hit = at[later[lo : lo + len(at)]]
        lo += len(at)
        if len(hit):
            out.append((chunk, _planes(np.diff(hit, prepend=0).astype(np.uint32))))
    return pa.table({"chunk": pa.array([x[0] for x in out], pa.int64()), "places": pa.array([x[1] for x in out], pa.binary())})


def _texts(batches):
    press = zstandard.ZstdCompressor(level=1)
    for t, ids in _scan(batches):
        nulls = ids == LAST
        packed = press.compress(t.data.tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array([_identity(t, ids)]), pa.array([packed]), pa.array([_planes(np.diff(t.bounds))]), pa.array([_planes(np.diff(ids, prepend=0))]), pa.array([nulls.tobytes()])],
            ["chunk", "text", "lengths", "ids", "nulls"],
        )


RESULT = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, spans array<struct<first: bigint, upto: bigint>>"


def _apply(texts: pa.Table, repeats: pa.Table) -> pa.Table:
    """Results of the documents of one chunk, from its text and its repeated windows."""
    if len(repeats) and not len(texts):
        raise RuntimeError("a chunk of documents changed between two reads")
    hits = [np.cumsum(_from_planes(x, np.uint32), dtype=np.int64) for x in repeats["places"].to_pylist()]
    out = []
    for packed, lengths, ids, nulls in zip(*(texts[c].to_pylist() for c in ("text", "lengths", "ids", "nulls")), strict=True):
        bounds = np.concatenate([[0], np.cumsum(_from_planes(lengths, np.int64))])
        raw = zstandard.ZstdDecompressor().decompress(packed, max_output_size=max(int(bounds[-1]), 1))
        t = Texts(np.frombuffer(raw, np.uint8), bounds).split()
        ids = np.cumsum(_from_planes(ids, np.int64))
        words, at, rows = _window_hashes(t)
        own = at[_later(rolling(words, at, at + WINDOW), ids[rows])]
        gone = covered(np.concatenate([own, *hits]), WINDOW, len(words))
        removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[t.at])
        first = gone.copy()
        first[1:] &= ~gone[:-1]
        starts_row = t.at[:-1][t.at[:-1] < len(gone)]
        first[starts_row] = gone[starts_row]
        span_at = np.flatnonzero(first)
        stop = np.flatnonzero(~gone | first)
        span_rows = np.searchsorted(t.at, span_at, "right") - 1
        stops = np.append(stop, len(gone))[np.searchsorted(stop, span_at, "right")]
        stops = np.minimum(stops, t.at[span_rows + 1])
        for row in range(t.rows):
            lo, hi = t.at[row], t.at[row + 1]
            kept = np.flatnonzero(~gone[lo:hi]) + lo
            whole = b" ".join([raw[a:b] for a, b in zip(t.starts[kept].tolist(), t.ends[kept].tolist(), strict=True)])
            a, b = np.searchsorted(span_rows, [row, row + 1])
            spans = [{"first": int(x - lo), "upto": int(y - lo)} for x, y in zip(span_at[a:b], stops[a:b], strict=True)]
            out.append((None if nulls[row] else int(ids[row]), int(hi - lo), int(removed[row]), hashlib.sha256(whole).hexdigest(), spans))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("first", pa.int64()), ("upto", pa.int64())]))]
    names = ["doc_id", "n_words", "n_removed", "kept_sha256", "spans"]
    return pa.table({n: pa.array([x[k] for x in out], kind) for k, (n, kind) in enumerate(zip(names, kinds, strict=True))})


def _stable(docs: DataFrame) -> bool:
    """Does every reading give the same rows in the same partitions? Only plain columns and filters of files are known to."""
    plan = docs._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() in ("Project", "Filter") and plan.deterministic():
        plan = plan.child()
    return plan.nodeName() == "LogicalRelation"


def substring_dedup(docs: DataFrame, *, tree_suffixes: int = TREE_SUFFIXES) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 and the removed spans of words."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    if not _stable(docs):
        docs = cut(docs)
    counted = docs.mapInArrow(_counts, "level int, bucket int, n bigint").groupBy("level", "bucket").agg(F.sum("n").alias("n")).collect()
    heavy, total = np.zeros((len(LEVELS), BUCKETS), bool), 0
    for level, bucket, n in counted:  # len(LEVELS) * BUCKETS rows at most
        heavy[level, bucket] = n > tree_suffixes // 16
        total += n * (level == 0)
    groups = max(64, total // tree_suffixes)
    filed = docs.mapInArrow(_suffixes(heavy, groups), "grp bigint, chunk bigint, h binary, places binary, counts binary, ids binary")
    repeats = filed.groupBy("grp").applyInArrow(_tree, "chunk bigint, places binary")
    texts = docs.mapInArrow(_texts, "chunk bigint, text binary, lengths binary, ids binary, nulls binary")
    return texts.groupBy("chunk").cogroup(repeats.groupBy("chunk")).applyInArrow(_apply, RESULT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: what is removed from every document."""
    return substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
