"""Token counts by rank-synchronous merging of ragged arrays.

The vocabulary is a piece model (byte-pair merges by score, byte fallback,
identity normalizer). Spaces become word marks and one mark is put in front of
every text that isn't empty. No piece has a mark after another character, so
marks begin pre-tokens, and a line break that no piece contains is a token alone.

The pre-tokens of a chunk that are not yet known fall into parts where no piece can
reach across two characters, and are held as one ragged array of symbols. Every round finds each sequence's lowest-rank pair and merges it at all
its places at once, from the left without overlap, in all sequences. Where a
merge would make a new pair of no higher rank beside it, that sequence merges
its leftmost place alone in this round, as a queue of single merges would; a long one
(a run of spaces, whose pieces share one rank) is swept from left to right by itself. What
remains is counted: one token for each symbol of the vocabulary, one for each
UTF-8 byte of any other character.

Null and empty texts have no tokens. Each row is counted by itself; further
columns are ignored.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.ragged import chunks

MARK = "▁"
OVER_LIMIT = 4096
REMEMBERED, SHORT = 400_000, 40
NONE = np.iinfo(np.int32).max
#: Symbols from which a sequence whose merges must go one by one is finished by itself, and its rounds before a queue takes over.
ALONE, ROUNDS, GONE = 48, 64, -1 << 41


class Vocabulary:
    """Pair table and merge counter of one piece model."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        special = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
        pieces = {model.id_to_piece(i): i for i in range(size) if not special(i)}
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece has a word mark after another character")
        scores = np.array([model.get_score(i) for i in range(size)])
        rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        self.size = size
        self.symbol = np.full(0x110000, -1, np.int32)
        pairs = {}
        for piece, i in pieces.items():
            if len(piece) == 1:
                self.symbol[ord(piece)] = i
            for k in range(1, len(piece)):
                if (left := pieces.get(piece[:k])) is not None and (right := pieces.get(piece[k:])) is not None:
                    pairs[left * size + right] = i
        # which characters stand beside each other in a piece, and in threes: elsewhere no merge can cross
        self.twos = self._joined({p for p in pieces if len(p) == 2}, 2)
        self.threes = self._joined(set(pieces), 3)
        self.pairs = {k: (int(rank[i]), i) for k, i in pairs.items()}
        self.keys = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[k] for k in self.keys.tolist()], np.int32)
        self.ranks = rank[self.merged]
        alone = "" if any("\n" in p for p in pieces) else "\n"
        self.pattern = re.compile(f" *[^ {alone}]+| +|\n" if alone else " *[^ ]+| +")
        self.known: dict[str, int] = {}

    @staticmethod
    def _joined(pieces: set[str], size: int) -> np.ndarray:
        """Sorted codes of all runs of ``size`` characters inside pieces."""
        runs = {p[k : k + size] for p in pieces for k in range(len(p) - size + 1)}
        return np.array(sorted(sum(ord(c) << 21 * k for k, c in enumerate(run)) for run in runs), np.int64)

    @staticmethod
    def _among(codes: np.ndarray, known: np.ndarray) -> np.ndarray:
        if not len(known):
            return np.zeros(len(codes), bool)
        return known[np.minimum(np.searchsorted(known, codes), len(known) - 1)] == codes

    def _parts(self, points: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Number of the part of each character: tokens fall apart where no piece reaches across.

        A piece across two characters is these two, or holds them with the one before or after.
        """
        two = points[:-1] | points[1:] << 21
        three = self._among(two[:-1] | points[2:] << 42, self.threes) if len(two) else np.zeros(0, bool)
        across = self._among(two, self.twos)
        across[:-1] |= three
        across[1:] |= three
        starts = np.ones(len(points), bool)
        starts[1:] = ~across | (token[1:] != token[:-1])
        return np.cumsum(starts) - 1

    def pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of adjacent symbols; NONE where they don't merge."""
        key = np.where((left < 0) | (right < 0), -1, left.astype(np.int64) * self.size + right)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        found = self.keys[at] == key
        return np.where(found, self.ranks[at], NONE), self.merged[at]

    def merge(self, tokens: list[str]) -> np.ndarray:
        """Number of tokens of each pre-token."""
        points = np.frombuffer("".join(tokens).encode("utf-32-le"), np.uint32).astype(np.int64)
        token = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
        seq = self._parts(points, token)
        owner = token[np.flatnonzero(np.diff(seq, prepend=-1))]
        sym = self.symbol[points]
        width = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
        counts = np.zeros(len(owner), np.int64)
        np.add.at(counts, seq[sym < 0], width[sym < 0])
        while len(sym):
            rank, to = np.full(len(sym), NONE, np.int32), np.full(len(sym), -1, np.int32)
            rank[:-1], to[:-1] = self.pair(sym[:-1], sym[1:])
            rank[:-1][seq[:-1] != seq[1:]] = NONE
            first = np.flatnonzero(np.diff(seq, prepend=-1))
            sizes = np.diff(np.append(first, len(seq)))
            lowest = np.minimum.reduceat(rank, first)
            done = np.repeat(lowest == NONE, sizes)
            if done.any():
                np.add.at(counts, seq[done & (sym >= 0)], 1)
                live = ~done
                sym, seq, rank, to = sym[live], seq[live], rank[live], to[live]
                if not len(sym):
                    break
                first = np.flatnonzero(np.diff(seq, prepend=-1))
                sizes = np.diff(np.append(first, len(seq)))
                lowest = lowest[lowest != NONE]
            best = np.repeat(lowest, sizes)
            hit = rank == best
            run = np.flatnonzero(hit & ~np.concatenate([[False], hit[:-1]]))
            place = np.arange(len(hit))
            start = np.zeros(len(hit), np.int64)
            start[run] = run
            start = np.maximum.accumulate(start)
            chosen = hit & ((place - start) % 2 == 0)
            after, kept = self._apply(sym, to, chosen)
            own = seq[kept]
            new = chosen[kept]
            beside = np.full(len(after), NONE, np.int32)
            beside[:-1] = self.pair(after[:-1], after[1:])[0]
            beside[:-1][own[:-1] != own[1:]] = NONE
            limit = best[kept]
            touched = new.copy()
            touched[:-1] |= new[1:]
            early = touched & (beside <= limit)
            # a merge may also meet the first half of the next one before that is merged
            nxt = np.flatnonzero(chosen[:-2] & chosen[2:]) if len(chosen) > 2 else np.zeros(0, np.int64)
            held = self.pair(to[nxt], sym[nxt + 2])[0] <= best[nxt] if len(nxt) else np.zeros(0, bool)
            careful = np.zeros(len(counts), bool)
            careful[own[early]] = True
            careful[seq[nxt[held]]] = True
            if careful.any():
                gone = np.zeros(len(sym), bool)
                for s in np.flatnonzero(careful).tolist():
                    lo, hi = np.searchsorted(seq, [s, s + 1])
                    if hi - lo > ALONE:
                        counts[s] += self._alone(sym[lo:hi])
                        gone[lo:hi] = True
                if gone.any():
                    sym, seq = sym[~gone], seq[~gone]
                    continue
                leftmost = np.zeros(len(hit), bool)
                hits = np.flatnonzero(hit)
                leftmost[hits[np.flatnonzero(np.diff(seq[hits], prepend=-1))]] = True
                chosen = np.where(careful[seq], leftmost, chosen)
                after, kept = self._apply(sym, to, chosen)
            sym, seq = after, seq[kept]
        return np.bincount(owner, counts, len(tokens)).astype(np.int64)

    def _alone(self, sym: np.ndarray) -> int:
        """Number of tokens of one long sequence, by itself: each round merges one rank from left to right over a stack."""
        left = np.where(sym < 0, -1 << 40, sym.astype(np.int64)).tolist()
        for _ in range(ROUNDS):
            lowest = int(self.pair(np.array(left[:-1]), np.array(left[1:]))[0].min()) if len(left) > 1 else NONE
            if lowest == NONE:
                return sum(s >= 0 for s in left)
            left = self._swept(left, lowest)
        return self._queued(left)

    def _swept(self, sym: list[int], rank: int) -> list[int]:
        """Merge the pairs of the lowest ``rank``, leftmost first, until none is left or one of a lower rank arises."""
        find, size, none, out = self.pairs.get, self.size, (NONE, -1), []
        for i, x in enumerate(sym):
            stop = False
            while out and not stop:
                r, to = find(out[-1] * size + x, none)
                if r > rank:
                    break
                stop = r < rank
                if not stop:
                    out.pop()
                    x = to
                    stop = i + 1 < len(sym) and find(x * size + sym[i + 1], none)[0] < rank
            out.append(x)
            if stop:
                return out + sym[i + 1 :]
        return out

    def _queued(self, sym: list[int]) -> int:
        """As :meth:`_alone`, by a queue of single merges."""
        find, size, n = self.pairs.get, self.size, len(sym)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(found[0], i, sym[i], sym[i + 1]) for i in range(n - 1) if (found := find(sym[i] * size + sym[i + 1]))]
        heapq.heapify(queue)
        while queue:
            _, i, x, y = heapq.heappop(queue)
            if sym[i] != x or (j := after[i]) >= n or sym[j] != y:
                continue
            sym[i], sym[j], after[i] = find(x * size + y)[1], GONE, after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (found := find(sym[a] * size + sym[b])):
                    heapq.heappush(queue, (found[0], a, sym[a], sym[b]))
        return sum(s >= 0 for s in sym)

    @staticmethod
    def _apply(sym: np.ndarray, to: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        stays = np.ones(len(sym), bool)
        stays[1:] = ~chosen[:-1]
        kept = np.flatnonzero(stays)
        return np.where(chosen, to, sym)[kept], kept

    def lookup(self, tokens: set[str]) -> None:
        """Count the pre-tokens that are not known yet."""
        new = [t for t in tokens if t not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = list(tokens)
        for lo in range(0, len(new), 50_000):
            part = new[lo : lo + 50_000]
            self.known.update(zip(part, self.merge([t.replace(" ", MARK) for t in part]).tolist(), strict=True))

    def count(self, texts: list[str]) -> list[int]:
        split = [self.pattern.findall(" " + t.replace(MARK, " ")) if t else [] for t in texts]
        fresh = set().union(*split)
        self.lookup(fresh)
        get = self.known.__getitem__
        out = [sum(map(get, s)) for s in split]
        for t in fresh:
            if len(t) > SHORT:
                self.known.pop(t, None)
        return out


_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The model at ``path``, loaded once in a worker."""
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


def token_counts(docs: DataFrame, path: str, *, over: int = OVER_LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit."""

    def count(texts: pa.Array) -> pa.Array:
        words = vocabulary(path)
        out: list[int] = []
        for t in chunks(texts):
            raw = t.data.tobytes()
            out += words.count([raw[a:b].decode("utf-8", "replace") for a, b in zip(t.bounds[:-1].tolist(), t.bounds[1:].tolist(), strict=True)])
        return pa.array(out, pa.int64())

    counted = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"), F.arrow_udf(count, "bigint")("text").alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > over)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: token counts of every document."""
    import public_tokenizers

    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("piece_bpe_32k.model"))
