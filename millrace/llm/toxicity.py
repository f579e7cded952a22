"""Toxicity scores of a bidirectional gated recurrent network.

Words are runs of letters, lower-cased in ASCII. A word's input vector has a word
part: how much its presence speaks for the label, and a vector of signs from its
hash; and a character part: the same of its 4-byte pieces (highest and mean of the
first, mean of the second) and of its first 3, 4 and 5 bytes. What speaks for the label
is counted in one fold of the labelled rows, the network is trained on another,
on windows: of a toxic text the one that scores highest, of others some
high-scoring and some random ones, chosen anew in each of a few rounds among
:data:`POOL` of each text. A text's score is that of its highest window among windows of
:data:`STEPS` words at every :data:`STRIDE`-th word, scaled so that 0.7 is the best cut
between the labels of the rows learned from.

At most ``sample`` rows of each label are learned from, taken by a seeded hash of
doc_id. Their texts stay with the executors: the driver gets counts by place of a
table of fixed size, the inputs of POOL windows a text, and one score a text. Null and
empty texts, and those without a letter, score 0. Where a label is missing, every score
is 0. Each row is scored by itself; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import Scratch
from millrace.llm.gru import BiGru
from millrace.llm.ragged import BYTE, Texts, chunks, mix, rolling

STEPS, STRIDE, POOL = 32, 8, 12
TABLE, SIGNS = 1 << 18, 8
CUT = 0.7
BETWEEN = np.ones(256, bool)
BETWEEN[65:91] = BETWEEN[97:123] = BETWEEN[128:] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _slots(h: np.ndarray, kind: int) -> np.ndarray:
    return (mix(h + np.uint64(kind * 0x9E3779B97F4A7C15 & (2**64 - 1))) & np.uint64(TABLE - 1)).astype(np.int64)


def _signs(h: np.ndarray) -> np.ndarray:
    """SIGNS numbers of -1/16 or 1/16 from each hash: small beside the log odds, so that few rows are enough to learn from."""
    return ((mix(h)[:, None] >> np.arange(SIGNS, dtype=np.uint64)) & np.uint64(1)).astype(np.float32) / 8 - np.float32(1 / 16)


def _letters(t: Texts) -> Texts:
    return Texts(LOWER[t.data], t.bounds, t.first).split(BETWEEN)


def slots(t: Texts) -> dict[str, np.ndarray]:
    """Table places of each word's whole, first bytes and pieces (with ``piece_at`` per word)."""
    coded = BYTE[t.data]
    lengths = t.ends - t.starts
    whole = rolling(coded, t.starts, t.ends)
    out = {"word": _slots(whole, 1), "word_signs": _signs(whole)}
    for k in (3, 4, 5):
        out[f"head{k}"] = _slots(rolling(coded, t.starts, np.minimum(t.starts + k, t.ends)), k)
    n_pieces = np.maximum(lengths - 3, 1)
    rows = np.repeat(np.arange(len(lengths)), n_pieces)
    piece_at = np.cumsum(n_pieces) - n_pieces
    begin = t.starts[rows] + np.arange(len(rows)) - piece_at[rows]
    pieces = rolling(coded, begin, np.minimum(begin + 4, t.ends[rows]))
    out["piece"], out["piece_signs"] = _slots(pieces, 9), _signs(pieces)
    out["piece_at"], out["piece_rows"] = piece_at, rows
    return out


def inputs(s: dict[str, np.ndarray], tables: dict[str, np.ndarray]) -> np.ndarray:
    """Input vector of each word."""
    if not len(s["word"]):
        return np.zeros((0, 6 + 2 * SIGNS), np.float32)
    piece = tables["piece"][s["piece"]]
    sizes = np.diff(np.append(s["piece_at"], len(piece)))
    return np.column_stack([
        tables["word"][s["word"]], np.maximum.reduceat(piece, s["piece_at"]), np.add.reduceat(piece, s["piece_at"]) / sizes,
        *(tables[f"head{k}"][s[f"head{k}"]] for k in (3, 4, 5)), s["word_signs"], np.add.reduceat(s["piece_signs"], s["piece_at"], axis=0) / sizes[:, None],
    ]).astype(np.float32)


KINDS = ("word", "head3", "head4", "head5", "piece")


def _seen(batches):
    """How many texts of each label have each place of each table; kind -1 counts the texts."""
    for batch in batches:
        toxic = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for t in chunks(batch.column(1), 1 << 20):
            label, t = toxic[t.first : t.first + t.rows], _letters(t)
            s, rows = slots(t), np.repeat(np.arange(t.rows), t.n_words)
            found = [(np.full(2, -1), np.arange(2), np.zeros(2, np.int64), np.bincount(label, minlength=2))]
            for kind, name in enumerate(KINDS):
                own = rows[s["piece_rows"]] if name == "piece" else rows
                once = np.unique(own * TABLE + s[name])
                keys, n = np.unique(label[once // TABLE] * TABLE + once % TABLE, return_counts=True)
                found.append((np.full(len(keys), kind), keys // TABLE, keys % TABLE, n))
            columns = [np.concatenate(c).astype(np.int64) for c in zip(*found, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["kind", "label", "place", "n"])


def _weights(rows: DataFrame, prior: float = 8.0) -> dict[str, np.ndarray] | None:
    """For each kind of table: log odds, by texts, of the label where a place occurs; None where a label is missing."""
    counted = rows.select(F.col("toxic").cast("bigint"), "text").mapInArrow(_seen, "kind bigint, label bigint, place bigint, n bigint")
    got = counted.groupBy("kind", "label", "place").agg(F.sum("n").alias("n")).toPandas()  # 2 * (1 + TABLE * kinds) rows at most
    texts, seen = np.zeros(2), {kind: np.zeros((2, TABLE)) for kind in KINDS}
    for kind, part in got.groupby("kind"):
        if kind < 0:
            texts[part["label"]] = part["n"]
        else:
            seen[KINDS[kind]][part["label"], part["place"]] = part["n"]
    if not texts.all():
        return None
    share = prior * texts / texts.sum()
    rate = lambda kind, label: (seen[kind][label] + share[label]) / (texts[label] + share[label])
    return {kind: np.log(rate(kind, 1) / rate(kind, 0)).astype(np.float32) for kind in KINDS}


def windows(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of words and row of each window; a text without words has an empty one."""
    n = t.n_words
    counts = np.where(n > STEPS, -(-(n - STEPS) // STRIDE) + 1, 1)
    rows = np.repeat(np.arange(t.rows), counts)
    first = (np.arange(len(rows)) - (np.cumsum(counts) - counts)[rows]) * STRIDE
    return t.at[rows] + first, np.minimum(n[rows] - first, STEPS), rows


def _pools(shared):
    """Of each text: the inputs of half of POOL windows that score highest by their weights, and of as many others, by a seeded draw."""

    def run(batches):
        for batch in batches:
            row, toxic = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for t in chunks(batch.column(2), 1 << 19):
                number, label, t = row[t.first : t.first + t.rows], toxic[t.first : t.first + t.rows], _letters(t)
                x = np.vstack([inputs(slots(t), shared.value), np.zeros((STEPS, 6 + 2 * SIGNS), np.float32)])
                first, lengths, rows = windows(t)
                total = np.concatenate([[0.0], np.cumsum(np.maximum(x[:, :2], 0).sum(1))])
                score = total[first + lengths] - total[first]
                draw = mix(number[rows].astype(np.int64).view(np.uint64) + first.astype(np.uint64) - t.at[rows].astype(np.uint64) + np.uint64(1))
                chosen = np.zeros(len(rows), bool)
                for key in (-score, draw.astype(np.float64)):
                    order = np.lexsort((key, chosen, rows))
                    place = np.arange(len(rows)) - np.searchsorted(rows[order], rows[order])
                    chosen[order[place < POOL // 2]] = True
                at = np.flatnonzero(chosen)
                held = x[first[at, None] + np.arange(STEPS)] * (np.arange(STEPS) < lengths[at, None])[:, :, None]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number[rows[at]]), pa.array(label[rows[at]].astype(np.int32)), pa.array(first[at] - t.at[rows[at]]), pa.array(lengths[at]), pa.array(score[at]), pa.array([w.tobytes() for w in held.astype(np.float32)], pa.binary())],
                    ["number", "toxic", "first", "length", "score", "x"],
                )

    return run


class Model:
    """Tables, network and scale; without a network every score is 0."""

    def __init__(self) -> None:
        self.tables: dict[str, np.ndarray] = {}
        self.net: BiGru | None = None
        self.middle, self.slope = 0.0, 1.0

    def window_logits(self, x: np.ndarray, first: np.ndarray, lengths: np.ndarray, block: int = 2048) -> np.ndarray:
        xf = (x @ self.net.p["wf"] + self.net.p["bf"]).astype(np.float32)
        xb = (x @ self.net.p["wb"] + self.net.p["bb"]).astype(np.float32)
        if not len(x):
            xf = xb = np.zeros((1, 3 * self.net.hidden), np.float32)
        out = np.zeros(len(first), np.float32)
        full = np.argsort(lengths != STEPS, kind="stable")
        n_full = int((lengths == STEPS).sum())
        for a, b in ((0, n_full), (n_full, len(first))):
            for lo in range(a, b, block):
                part = full[lo : min(lo + block, b)]
                places = np.minimum(first[part, None] + np.arange(STEPS), len(xf) - 1)
                out[part] = self.net.logits(xf, xb, places, lengths[part])
        return out

    def text_logits(self, t: Texts) -> np.ndarray:
        first, lengths, rows = windows(t)
        out = self.window_logits(inputs(slots(t), self.tables), first, lengths)
        best = np.full(t.rows, -np.inf)
        np.maximum.at(best, rows, out)
        best[t.n_words == 0] = -np.inf
        return best

    def logits(self, column: pa.Array) -> np.ndarray:
        return np.concatenate([np.zeros(0), *(self.text_logits(_letters(t)) for t in chunks(column, 1 << 19))])

    def scores(self, column: pa.Array) -> np.ndarray:
        if self.net is None:
            return np.zeros(len(column))
        z = self.slope * (self.logits(column) - self.middle) + np.log(CUT / (1 - CUT))
        return np.where(np.isneginf(z), 0.0, 1 / (1 + np.exp(-np.clip(z, -60, 60))))

    def train(self, x: np.ndarray, lengths: np.ndarray, row: np.ndarray, y: np.ndarray, score: np.ndarray, rounds: int = 4, seed: int = 7) -> None:
        """Fit the network to windows ``x`` of rows with labels ``y``; the windows of a row stand together, ``row`` counts from 0."""
        rng = np.random.default_rng(seed)
        self.net = BiGru(x.shape[2], seed=seed)
        n_rows, at = len(np.unique(row)), np.arange(STEPS)
        flat, first = x.reshape(-1, x.shape[2]), np.arange(len(x)) * STEPS
        for _ in range(rounds):
            order = np.lexsort((-score, row))
            place = np.arange(len(row)) - np.searchsorted(row[order], row[order])
            own = y[order]
            chosen = np.concatenate([order[own & (place == 0)], order[~own & (place < 2)], rng.permutation(order[~own])[: 2 * n_rows]])
            label = y[chosen].astype(np.float32)
            importance = np.where(label == 1, 0.5 * (1 - label).sum() / max(label.sum(), 1), 1).astype(np.float32)
            self.net.train(flat[first[chosen, None] + at], lengths[chosen], label, importance, epochs=2, batch=64, seed=seed)
            score = self.window_logits(flat, first, lengths)

    def scale(self, best: np.ndarray, y: np.ndarray) -> None:
        """Put the cut where it best tells the labels of these texts apart."""
        order = np.argsort(-best, kind="stable")
        hits = np.cumsum(y[order])
        f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
        k = int(np.argmax(f1))
        self.middle = float((best[order[k]] + best[order[min(k + 1, len(y) - 1)]]) / 2)


def fit(rows: DataFrame) -> Model:
    """A model of labelled rows (number, text, toxic, fold)."""
    model, context = Model(), rows.sparkSession.sparkContext
    tables = _weights(rows.where("fold = 0"))
    if tables is None:
        return model
    shared = context.broadcast(tables)
    other = rows.where("fold = 1")
    found = other.select("number", "toxic", "text").mapInArrow(_pools(shared), "number bigint, toxic int, first bigint, length bigint, score double, x binary")
    got = found.toPandas().sort_values(["number", "first"], kind="stable")  # POOL windows a row at most
    y = got["toxic"].to_numpy() == 1
    if not len(got) or y.all() or not y.any():
        return model
    model.tables = tables
    x = np.frombuffer(b"".join(got["x"]), np.float32).reshape(len(got), STEPS, -1)
    model.train(x, got["length"].to_numpy(), np.unique(got["number"], return_inverse=True)[1], y, got["score"].to_numpy())
    ready = context.broadcast(model)
    logit = F.arrow_udf(lambda texts: pa.array(ready.value.logits(texts), pa.float64()), "double")
    best = other.select("number", "toxic", logit("text").alias("best")).toPandas().sort_values(["number", "best"])
    model.scale(np.maximum(best["best"].to_numpy(), -1e9), best["toxic"].to_numpy() == 1)
    return model


def toxicity(docs: DataFrame, labels: DataFrame, *, sample: int = 2000) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    held = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(3))
    learn = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").select("doc_id", "toxic").where(held != 1)
    picked = None
    for label in (0, 1):
        part = learn.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        picked = part if picked is None else picked.unionAll(part)
    # 2 * sample rows at most
    number = F.xxhash64("doc_id", "text").alias("number")
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select(number, "text", F.col("toxic").cast("int").alias("toxic"), (held == 2).cast("int").alias("fold"))
    with Scratch() as scratch:
        model = fit(scratch.cut(rows.orderBy("number", "toxic").limit(2 * sample)))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    score = F.arrow_udf(lambda texts: pa.array(shared.value.scores(texts), pa.float64()), "double")
    scored = docs.select("doc_id", (held == 1).alias("held_out"), score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: toxicity of every document."""
    return toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
