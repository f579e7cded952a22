"""Byte-level BPE by tree reduction: texts to ids and ids to texts.

Encoding is taken apart into halves and put together again. A text is cut where pre-tokens
surely end, down to pieces that the pattern splits; a pre-token's bytes are halved down to
short leaves, which are merged pair by pair. Two neighbours are joined by looking at their
boundary only: tokens ``a b`` are *settled* if the bytes of both encode to just these two.

A sequence is the encoding of its bytes if each of its neighbours are settled. (Take the
first merge that crosses a token's border, between ``a`` and ``b``. Until then every choice of
the lowest rank, leftmost first, was also the choice among the bytes of ``a b`` alone, so they
would be merged across the border as well, and not be settled.) So if the last token on the
left and the first on the right are settled, both stand as they are. If not, a window around
the border is encoded anew and doubled on each side whose outer neighbours aren't settled yet.

Null texts count as empty and have no ids; a null list of ids decodes to null. Each row is worked
on by itself; further columns are ignored by :func:`encode` and :func:`decode`, which are columns.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that are merged directly; characters of one run of the pattern; pre-tokens remembered by a worker, and their longest.
LEAF, RUN, REMEMBERED, SHORT = 64, 1 << 18, 300_000, 40
NEVER = 1 << 31


class Encoder:
    """Ranks of a vocabulary, the pattern of its pre-tokens, and what a worker has encoded."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        # the pre-tokens that were seen last, and those of the round before, from which they are taken over
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.same = lru_cache(10_000)(lambda data: tuple(self.leaf(data)))
        self.settled = lru_cache(20_000)(self._settled)

    def _merge(self, data: bytes) -> list[int]:
        """Merge the lowest-ranked pair, leftmost first, until none is left: a queue of pairs over linked parts."""
        rank, n = self.ranks.get, len(data)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        queue = [(r, i, i + 2) for i in range(n - 1) if (r := rank(data[i : i + 2])) is not None]
        heapq.heapify(queue)
        while queue:
            _, i, end = heapq.heappop(queue)
            if not alive[i] or (j := after[i]) >= n or after[j] != end:
                continue
            alive[j], after[i] = False, end
            if end < n:
                before[end] = i
                if (r := rank(data[i : after[end]])) is not None:
                    heapq.heappush(queue, (r, i, after[end]))
            if (b := before[i]) >= 0 and (r := rank(data[b:end])) is not None:
                heapq.heappush(queue, (r, b, end))
        return [self.ranks[data[i : after[i]]] for i in range(n) if alive[i]]

    def leaf(self, data: bytes) -> list[int]:
        """As :meth:`_merge`, for few bytes: over a list of parts."""
        rank = self.ranks.get
        parts = [data[i : i + 1] for i in range(len(data))]
        found = [rank(a + b, NEVER) for a, b in zip(parts, parts[1:], strict=False)]
        while found and (lowest := min(found)) < NEVER:
            i = found.index(lowest)
            del found[i]
            parts[i] += parts.pop(i + 1)
            if i < len(found):
                found[i] = rank(parts[i] + parts[i + 1], NEVER)
            if i:
                found[i - 1] = rank(parts[i - 1] + parts[i], NEVER)
        return [self.ranks[p] for p in parts]

    def _settled(self, left: int, right: int) -> bool:
        return self._merge(self.tokens[left] + self.tokens[right]) == [left, right]

    def _bytes(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two neighbours' bytes from theirs."""
        if not left or not right or self.settled(left[-1], right[0]):
            return left + right
        a = b = 1
        while True:
            middle = self._merge(self._bytes(left[-a:] + right[:b]))
            whole_left, whole_right = a >= len(left), b >= len(right)
            holds_left = whole_left or self.settled(left[-a - 1], middle[0])
            holds_right = whole_right or self.settled(middle[-1], right[b])
            if holds_left and holds_right:
                return left[: len(left) - min(a, len(left))] + middle + right[b:]
            a, b = a if holds_left else 2 * a, b if holds_right else 2 * b

    def reduce(self, data: bytes) -> list[int]:
        """Encode halves, the first of which is as long as a power of two, and join them."""
        if len(data) <= LEAF:
            return list(self.same(data)) if len(data) == LEAF else self.leaf(data)
        half = 1 << (len(data) - 1).bit_length() - 1
        return self.join(self.reduce(data[:half]), self.reduce(data[half:]))

    def pre_token(self, piece: str) -> tuple[int, ...]:
        data = piece.encode()
        whole = self.ranks.get(data)
        return (whole,) if whole is not None else tuple(self.reduce(data))

    def _pieces(self, text: str) -> list[tuple[int, ...]]:
        """Ids of each pre-token of a run; words are encoded once."""
        pieces = self.pattern.findall(text)
        new = {p for p in set(pieces) if p not in self.known}
        if len(self.known) + len(new) > REMEMBERED:
            self.older, self.known = self.known, {}
            new = set(pieces)
        before = self.older.get
        self.known.update((p, before(p) or self.pre_token(p)) for p in new)
        found = list(map(self.known.__getitem__, pieces))
        for p in new:
            if len(p) > SHORT:
                del self.known[p]
        return found

    def encode(self, text: str) -> list[int]:
        """Ids of a text: long ones are halved where a space stands between two other characters, as a pre-token ends there."""
        if len(text) <= RUN:
            return list(chain.from_iterable(self._pieces(text)))
        cut = _sure_cut(text)
        return self.encode(text[:cut]) + self.encode(text[cut:]) if cut else list(chain.from_iterable(self._pieces(text)))


_LONE_SPACE = regex.compile(r"(?<=\S) (?=\S)")


def _sure_cut(text: str) -> int:
    """A place near the middle where every pattern of this kind starts a pre-token; 0 if there is none."""
    middle = len(text) // 2
    found = _LONE_SPACE.search(text, middle)
    if found:
        return found.start()
    last = None
    for last in _LONE_SPACE.finditer(text, 0, middle):  # noqa: B007
        pass
    return last.start() if last else 0


_loaded: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """The vocabulary at ``path``, loaded once in a worker."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = Encoder(path, pattern)
    return _loaded[path, pattern]


def encode(text: Column | str, path: str, pattern: str) -> Column:
    """``array<int>``: ids of each text under the ranks at ``path``, without special tokens."""

    def ids(texts: pa.Array) -> pa.Array:
        own, flat, ends = encoder(path, pattern), array("i"), [0]
        for t in texts:
            flat.extend(own.encode(t.as_py() or ""))
            ends.append(len(flat))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.Array.from_buffers(pa.int32(), len(flat), [None, pa.py_buffer(flat)]))

    return F.arrow_udf(ids, "array<int>").asNondeterministic()(text)


def decode(ids: Column | str, path: str, pattern: str) -> Column:
    """``binary``: the bytes of each list of ids (which need not be whole characters)."""

    def texts(lists: pa.Array) -> pa.Array:
        own = encoder(path, pattern)
        return pa.array([None if not row.is_valid else own._bytes(row.values.to_pylist()) for row in lists], pa.binary())

    return F.arrow_udf(texts, "binary")(ids)


def encoded(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids, decoded) of every text: ids, and the bytes that they give back."""
    return docs.select("doc_id", encode("text", path, pattern).alias("ids")).withColumn("decoded", decode("ids", path, pattern))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: digests of every document's ids and of what they decode to."""
    import public_tokenizers

    both = encoded(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return both.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
