"""Quality rules judged by an isolation forest on their statistics.

Each text gives a vector of rule statistics. Trees of random splits are grown on
a bounded sample of labelled rows (at most ``sample`` rows, by a seeded hash of
doc_id; bad ones make up a tenth of it at most, so that they stay anomalies); a
text that few splits isolate is an anomaly. The anomaly score above
which a text is rejected is calibrated on the labelled rows that pass the base
rules: it is the score that best tells good from bad (share of bad rejected plus
share of good kept), raised where needed to keep at least ``keep_good`` of the
good ones. Texts that fail the base rules are always rejected.

Null and empty texts have zero words and so fail the base rules. Without labelled
rows nothing but the base rules rejects. Each row is judged by itself: repeated
rows get equal verdicts, and null ids and further columns pass unchanged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import fresh
from millrace.llm.ragged import BYTE, Texts, chunks, covered, mix, rolling

WINDOW = 8
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
CODE_POINT = (np.arange(256) & 0xC0) != 0x80
UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
DIGIT = (np.arange(256) >= 48) & (np.arange(256) <= 57)
LETTER = UPPER | ((np.arange(256) >= 97) & (np.arange(256) <= 122)) | (np.arange(256) >= 0xC0)


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: is there another one; was there one before it."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    again = np.zeros(len(keys), bool)
    later = np.zeros(len(keys), bool)
    later[order[1:]] = same
    again[order[1:]] |= same
    again[order[:-1]] |= same
    return again, later


def statistics(t: Texts) -> dict[str, np.ndarray]:
    """Counts per row of a chunk whose words have been split."""
    words = t.word_hashes()
    at, rows = t.windows(WINDOW)
    shown = mix(rolling(words, at, at + WINDOW) ^ mix(rows.astype(np.uint64) + np.uint64(1)))
    again, _ = _repeats(shown)
    repeated = np.zeros(len(words) + 1, np.int64)
    np.cumsum(covered(at[again], WINDOW, len(words)), out=repeated[1:])
    starts, ends, line_rows = t.lines()
    solid = np.zeros(len(t.data) + 1, np.int64)
    np.cumsum(~t.space, out=solid[1:])
    full = solid[ends] > solid[starts]
    keys = rolling(BYTE[t.data], starts[full], ends[full]) ^ mix(line_rows[full].astype(np.uint64) + np.uint64(1))
    both = lambda byte_kind: t.per_row(byte_kind[t.data])
    return {
        "n_words": t.n_words,
        "word_chars": t.per_row(CODE_POINT[t.data] & ~t.space),
        "n_symbols": both(SYMBOLS),
        "n_dup_lines": np.bincount(line_rows[full][_repeats(keys)[1]], minlength=t.rows),
        "n_repeat_words": np.diff(repeated[t.at]),
        "n_lines": np.bincount(line_rows[full], minlength=t.rows),
        "n_upper": both(UPPER),
        "n_digits": both(DIGIT),
        "n_letters": both(LETTER),
    }


def features(s: dict[str, np.ndarray]) -> np.ndarray:
    """Rule statistics as shares, one row per text; short texts are drawn to the usual value."""
    words, chars, lines = s["n_words"] + 30.0, s["word_chars"] + 150.0, s["n_lines"] + 3.0
    columns = [
        np.minimum((s["n_letters"] + 150) / words, 8), s["n_symbols"] / chars, s["n_dup_lines"] / lines, s["n_repeat_words"] / words,
        s["n_upper"] / chars, (s["n_letters"] + s["n_digits"] + 150) / chars,
    ]
    return np.column_stack(columns).astype(np.float64)


def base_failed(s: dict[str, np.ndarray]) -> np.ndarray:
    return (s["n_words"] < 20) | (100 * s["n_repeat_words"] > 30 * s["n_words"])


def threshold(good: np.ndarray, bad: np.ndarray, keep_good: float) -> float:
    """The anomaly score up to which a text is kept."""
    if not len(good) or not len(bad):
        return np.inf
    at = np.unique(np.concatenate([good, bad]))
    kept = np.searchsorted(np.sort(good), at, "right") / len(good)
    lost = np.searchsorted(np.sort(bad), at, "right") / len(bad)
    best = np.argmax(np.round(kept - lost, 9))
    following = at[min(best + 1, len(at) - 1)]
    return float(max((at[best] + following) / 2, np.quantile(good, keep_good)))


class IsolationForest:
    """Trees of random splits over ``size`` sampled rows each; node 0 is a tree's root."""

    def __init__(self, rows: np.ndarray, trees: int = 100, size: int = 256, seed: int = 3) -> None:
        rng = np.random.default_rng(seed)
        size = min(size, len(rows))
        self.norm = max(self._expected(size), 1e-9)
        deepest = max(1, int(np.ceil(np.log2(max(size, 2)))))
        grown = [self._grow(rows[rng.choice(len(rows), size, replace=False)], deepest, rng) for _ in range(trees)]
        most = max(len(t) for t in grown)
        self.depth = deepest
        self.nodes = np.zeros((trees, most, 4))  # feature (-1 at a leaf), split, first child, path length
        for k, tree in enumerate(grown):
            self.nodes[k, : len(tree)] = tree

    @staticmethod
    def _expected(n: int) -> float:
        """Mean path length of an unsuccessful search among ``n`` rows."""
        return 0.0 if n <= 1 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n if n > 2 else 1.0

    def _grow(self, rows: np.ndarray, deepest: int, rng: np.random.Generator) -> list:
        tree: list = [None]
        todo = [(0, rows, 0)]
        while todo:
            at, part, depth = todo.pop()
            low, high = (part.min(0), part.max(0)) if len(part) else (np.zeros(1), np.zeros(1))
            open_ = np.flatnonzero(high > low)
            if depth >= deepest or len(part) <= 1 or not len(open_):
                tree[at] = (-1, 0, at, depth + self._expected(len(part)))
                continue
            f = rng.choice(open_)
            split = rng.uniform(low[f], high[f])
            tree[at] = (f, split, len(tree), 0)
            left = part[:, f] < split
            todo += [(len(tree), part[left], depth + 1), (len(tree) + 1, part[~left], depth + 1)]
            tree += [None, None]
        return tree

    def score(self, rows: np.ndarray) -> np.ndarray:
        """2 ** -(mean path / expected path): near 1 for rows that few splits isolate."""
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for tree in self.nodes:
            at = np.zeros(len(rows), np.int64)
            for _ in range(self.depth):
                f = tree[at, 0].astype(np.int64)
                inner = f >= 0
                right = rows[every, np.maximum(f, 0)] >= tree[at, 1]
                at = np.where(inner, tree[at, 2].astype(np.int64) + right, at)
            total += tree[at, 3]
        return 2.0 ** -(total / len(self.nodes) / self.norm)


def _feature_udf():
    @F.arrow_udf("array<double>")
    def vector(texts: pa.Array) -> pa.Array:
        rows = [np.column_stack([base_failed(s), features(s)]) for s in (statistics(t.split()) for t in chunks(texts))]
        return pa.array(list(np.concatenate(rows)) if rows else [], pa.list_(pa.float64()))

    return vector


def fit(docs: DataFrame, labels: DataFrame, *, sample: int = 8192, keep_good: float = 0.995, seed: int = 3) -> tuple[IsolationForest | None, float]:
    """The forest and the anomaly score above which a text is rejected."""
    picked = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "quality")
    picked = picked.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id", "quality").limit(sample)
    vectors = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("doc_id", "quality", _feature_udf()("text").alias("v"))
    got = vectors.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id", "v").limit(2 * sample).toPandas()
    if not len(got):
        return None, np.inf
    rows, good = np.array(got["v"].tolist()), got["quality"].to_numpy() == 1
    passed, rows = rows[:, 0] == 0, rows[:, 1:]
    few = np.cumsum(~good) <= max(good.sum() // 9, 256 * ~good.any())
    forest = IsolationForest(rows[good | few], seed=seed)
    scores = forest.score(rows)
    return forest, threshold(scores[good & passed], scores[~good & passed], keep_good)


def quality_rules(docs: DataFrame, labels: DataFrame, *, name: str = "quality_rules", **fitting) -> DataFrame:
    """``docs`` with a struct column ``name`` (with underscores added where they have it): counts, anomaly score and verdicts."""
    name = fresh(docs, name)
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, **fitting))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    @F.arrow_udf("struct<" + ", ".join(f"{c}: bigint" for c in counts) + ", anomaly: double, base_failed: boolean, kept: boolean>")
    def judge(texts: pa.Array) -> pa.Array:
        forest, most = shared.value
        parts = []
        for t in chunks(texts):
            s = statistics(t.split())
            failed = base_failed(s)
            score = forest.score(features(s)) if forest else np.zeros(t.rows)
            parts.append([*(s[c].astype(np.int64) for c in counts), score, failed, ~failed & (score <= most)])
        columns = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * 5 + [np.zeros(0)] + [np.zeros(0, bool)] * 2
        return pa.StructArray.from_arrays([pa.array(c) for c in columns], [*counts, "anomaly", "base_failed", "kept"])

    return docs.withColumn(name, judge.asNondeterministic()("text"))


def keep(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that the rules keep, with their own columns."""
    name = fresh(docs, "quality_rules")
    return quality_rules(docs, labels, name=name, **options).where(F.col(name)["kept"]).select(docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: statistics and verdict of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = quality_rules(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return out.select("doc_id", "quality_rules.*")
