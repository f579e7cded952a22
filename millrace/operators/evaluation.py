"""Evaluation: scored predictions, leaderboards, shared prompt sets, best checkpoints and distances of vector sets."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.text import completion
from millrace.operators.tables import settle, unsettle


def scored_predictions(tasks: DataFrame, predictions: DataFrame) -> DataFrame:
    """Every task with its parsed prediction; a missing one counts as empty text. Two predictions for one id are an error."""
    one = predictions.groupBy("id").agg(F.first("completion").alias("completion"), F.count(F.lit(1)).alias("n"))
    twice = F.raise_error(F.concat(F.lit("more than one prediction for "), F.col("id").cast("string"))).cast("boolean")
    one = one.select("id", "completion", F.when(F.col("n") > 1, twice).otherwise(False).alias("missing"))
    joined = tasks.join(one, "id", "left")
    parsed = completion(F.coalesce("completion", F.lit("")))
    return joined.withColumn("missing", F.coalesce("missing", F.lit(True))).withColumn("valid", parsed["reason"].isNull()).withColumn("code", parsed["code"])


def viewer_rows(tasks: DataFrame, predictions: DataFrame) -> DataFrame:
    """(id, prompt, shown, text) of each prediction: its code if it parses, else all of it. A prediction for no task is an error."""
    known = tasks.select("id", F.struct("prompt").alias("task"))
    rows = predictions.select("id", "completion").join(known, "id", "left").withColumn("c", completion("completion"))
    unknown = F.raise_error(F.concat(F.lit("a prediction for no task: "), F.col("id").cast("string"))).cast("string")
    good = F.col("c.reason").isNull()
    prompt = F.when(F.col("task").isNull(), unknown).otherwise(F.col("task.prompt"))
    return rows.select("id", prompt.alias("prompt"), F.when(good, "parsed").otherwise("raw").alias("shown"), F.when(good, F.col("c.code")).otherwise(F.col("completion")).alias("text"))


def extra_predictions(tasks: DataFrame, predictions: DataFrame) -> DataFrame:
    return predictions.join(tasks, "id", "left_anti")


def summary(scored: DataFrame, *groups: str) -> DataFrame:
    """Tasks, missing, execution rate and mean reward, by each group and in all."""
    by = scored.rollup(*groups) if groups else scored.groupBy()
    return by.agg(F.count(F.lit(1)).alias("tasks"), F.count_if("missing").alias("missing"), F.avg(F.col("valid").cast("double")).alias("execution_rate"), F.avg("reward").alias("mean_reward"))


def exact_quantiles(rows: DataFrame, group: str, value: str, shares: list[float], *, bins: int = 1024) -> DataFrame:
    """(group, share, quantile) of the finite values of each group, interpolated between ranks, without collecting values.

    Every rank that is wanted lies in an interval, at first from least to greatest value. A round counts the values of each
    interval in ``bins`` parts, with each part's least and greatest value, and goes on with the part that holds the
    rank, until that holds one value. Counts are added up before the shuffle; the intervals, a few for each
    group, are broadcast, so groups must be a short list of names.
    """
    known = rows.select(group, F.col(value).cast("double").alias("v")).where(F.abs("v") < float("inf"))
    ends = known.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    asked = ends.withColumn("share", F.explode(F.array(*map(F.lit, shares)))).withColumn("at", F.col("share") * (F.col("n") - 1))
    ranks = settle(asked.select(group, "share", "at", "lo", "hi", F.explode(F.array_distinct(F.array(F.floor("at"), F.ceil("at")))).alias("rank"), F.lit(0).cast("bigint").alias("below")))
    state, made = ranks, [ranks]
    while state.where("lo < hi").limit(1).count():
        part = F.least(F.lit(bins - 1), F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins)).cast("int")
        open_ = F.broadcast(state.where("lo < hi").select(group, "lo", "hi").distinct())
        held = known.join(open_, group).where((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))
        counted = held.groupBy(group, "lo", "hi", part.alias("part")).agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("least"), F.max("v").alias("most"))
        upto = F.sum("c").over(W.partitionBy(group, "lo", "hi").orderBy("part").rowsBetween(W.unboundedPreceding, 0))
        found = state.where("lo < hi").join(counted.withColumn("upto", upto), [group, "lo", "hi"])
        found = found.where((F.col("rank") >= F.col("below") + F.col("upto") - F.col("c")) & (F.col("rank") < F.col("below") + F.col("upto")))
        nearer = found.select(group, "share", "at", F.col("least").alias("lo"), F.col("most").alias("hi"), "rank", (F.col("below") + F.col("upto") - F.col("c")).alias("below"))
        state = settle(state.where("lo = hi").unionByName(nearer))
        made.append(state)
    out = settle(state.groupBy(group, "share").agg(F.min("lo").alias("a"), F.max("lo").alias("b"), F.first("at").alias("at")).select(group, "share", (F.col("a") + (F.col("b") - F.col("a")) * (F.col("at") - F.floor("at"))).alias("quantile")))
    for table in made:
        unsettle(table)
    return out


def component_rates(rows: DataFrame, *, name: str = "component", value: str = "component_value") -> DataFrame:
    """Mean, pass share and number of each component, with its 2nd and 98th percentile."""
    by = rows.groupBy(name).agg(F.avg(value).alias("mean"), F.avg((F.col(value) >= 1).cast("double")).alias("passed"), F.count(value).alias("n"))
    edge = lambda share, out: F.max(F.when(F.col("share") == share, F.col("quantile"))).alias(out)
    edges = exact_quantiles(rows, name, value, [0.02, 0.98]).groupBy(name).agg(edge(0.02, "p2"), edge(0.98, "p98"))
    return by.join(F.broadcast(edges), name, "left")


def flat_tasks(rollouts: DataFrame) -> DataFrame:
    """Tasks all of whose rollouts have the same total."""
    return rollouts.groupBy("task_id").agg(F.min("total").alias("lo"), F.max("total").alias("hi")).where("lo = hi").select("task_id")


def coverage(clips: DataFrame) -> DataFrame:
    """(model, prompt_id) pairs that are missing; models and prompts are short lists."""
    models, prompts = clips.select("model").distinct(), clips.select("prompt_id").distinct()
    roster = prompts.withColumn("model", F.explode(F.lit([r[0] for r in models.orderBy("model").collect()])))  # one row a model
    return roster.join(clips.select("model", "prompt_id").distinct(), ["model", "prompt_id"], "left_anti")


def shared_prompts(clips: DataFrame, models: list[str]) -> DataFrame:
    """Prompts that every one of the models has."""
    chosen = clips.where(F.col("model").isin(models))
    return chosen.groupBy("prompt_id").agg(F.count_distinct("model").alias("n")).where(F.col("n") == len(models)).select("prompt_id")


def metric_at_save(log: DataFrame, saves: DataFrame) -> DataFrame:
    """Each save with the latest metric logged at or before its step (as-of, by run)."""
    both = log.select("run", "step", "metric", F.lit(0).alias("kind")).unionByName(saves.select("run", "step", F.lit(None).cast("double").alias("metric"), F.lit(1).alias("kind")))
    past = W.partitionBy("run").orderBy("step", "kind").rowsBetween(W.unboundedPreceding, 0)
    return both.withColumn("metric", F.last("metric", ignorenulls=True).over(past)).where("kind = 1").select("run", "step", "metric")


def best_save(saves: DataFrame) -> DataFrame:
    """The save of each run with the highest metric, the earliest of equals."""
    best = saves.where("metric IS NOT NULL").groupBy("run").agg(F.max(F.struct("metric", (-F.col("step")).alias("minus"))).alias("b"))
    return best.select("run", (-F.col("b.minus")).alias("step"), F.col("b.metric").alias("metric"))


def uncached(clips: DataFrame, cache: DataFrame) -> DataFrame:
    return clips.join(cache, ["content_hash", "protocol"], "left_anti")


def count_mismatches(found: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """Keys whose number of extracted records isn't the expected one."""
    got = found.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    both = got.join(expected.select(key, "expected"), key, "full")
    return both.where(F.coalesce("n", F.lit(0)) != F.coalesce("expected", F.lit(0))).select(key, F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("expected", F.lit(0)).alias("expected"))


def _points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of a column of vectors, or of lists of them, as one matrix; and how many each row has. Nulls have none."""
    nested = pa.types.is_list(column.type.value_type)
    counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False) if nested else column.is_valid().to_numpy(zero_copy_only=False).astype(np.int64)
    frames = column.flatten() if nested else column.drop_null()
    sizes = np.unique(pc.list_value_length(frames).to_numpy(zero_copy_only=False)) if len(frames) else np.zeros(1, np.int64)
    if len(sizes) > 1:
        raise ValueError(f"vectors of {sizes.min()} and {sizes.max()} dimensions")
    return frames.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(frames), int(sizes[0])), counts


def moments(vectors: DataFrame, group: str, column: str = "embedding") -> DataFrame:
    """(group, n, mean, cov): sample moments of all vectors; each task sends one row of sums a group, with map-side partials.

    ``column`` holds a vector a row, or a list of frames (vectors) of any number, which are read as they lie in the
    Arrow buffers and never exploded. Null rows and rows without frames add nothing.
    """

    def partial(batches):
        sums: dict = {}
        for batch in batches:
            x, counts = _points(batch.column(column))
            codes, keys = pd.factorize(batch.column(group).to_pandas(), use_na_sentinel=False)
            owner = np.repeat(codes, counts)
            for code, key in enumerate(keys):
                part = x[owner == code]
                if len(part):
                    n, s, q = sums.get(key, (0, 0.0, 0.0))
                    sums[key] = (n + len(part), s + part.sum(0), q + part.T @ part)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array([None if pd.isna(k) else k for k in sums]), pa.array([v[0] for v in sums.values()]), pa.array([list(v[1]) for v in sums.values()]), pa.array([v[2].ravel().tolist() for v in sums.values()])], [group, "n", "s", "q"])

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        n, s = int(pdf["n"].sum()), np.sum(pdf["s"].tolist(), axis=0)
        q = np.sum(pdf["q"].tolist(), axis=0).reshape(len(s), len(s))
        mean = s / n
        cov = (q - n * np.outer(mean, mean)) / max(n - 1, 1)
        return pd.DataFrame({group: [pdf[group].iloc[0]], "n": [n], "mean": [mean.tolist()], "cov": [cov.ravel().tolist()]})

    sums = vectors.select(group, column).mapInArrow(partial, f"{group} string, n bigint, s array<double>, q array<double>")
    return sums.groupBy(group).applyInPandas(merge, f"{group} string, n bigint, mean array<double>, cov array<double>")


def frechet(groups: DataFrame, reference: DataFrame, group: str) -> DataFrame:
    """(group, distance) of each group's moments from those of the one-row reference."""
    ref = reference.first()
    mean, cov = np.array(ref["mean"]), np.array(ref["cov"]).reshape(len(ref["mean"]), -1)

    def root(m: np.ndarray) -> np.ndarray:
        w, v = np.linalg.eigh((m + m.T) / 2)
        return (v * np.sqrt(np.maximum(w, 0))) @ v.T

    def distances(batches):
        for pdf in batches:
            out = []
            for m, c in zip(pdf["mean"], pdf["cov"], strict=True):
                m, c = np.array(m), np.array(c).reshape(len(m), -1)
                half = root(c)
                cross = np.sqrt(np.maximum(np.linalg.eigvalsh(half @ cov @ half), 0)).sum()
                out.append(float(((m - mean) ** 2).sum() + np.trace(c) + np.trace(cov) - 2 * cross))
            yield pd.DataFrame({group: pdf[group], "distance": out})

    return groups.mapInPandas(distances, f"{group} string, distance double")


def mauve_distance(vectors: DataFrame, reference: DataFrame, group: str, *, k: int = 8, seed: int = 1, scale: float = 5.0, steps: int = 25) -> DataFrame:
    """(group, mad): -ln of the area under the divergence frontier of cluster histograms of each group and the reference."""
    every = vectors.select(group, "embedding").unionByName(reference.select(F.lit(None).cast("string").alias(group), "embedding"))
    rows = every.withColumn("features", array_to_vector("embedding"))
    clusters = KMeans(k=k, seed=seed, featuresCol="features").fit(rows).transform(rows)
    counts = clusters.groupBy(group, "prediction").agg(F.count(F.lit(1)).alias("n")).collect()  # k rows a group
    hist: dict = {}
    for g, c, n in counts:
        hist.setdefault(g, np.zeros(k))[c] += n
    q = hist.pop(None) + 1e-9
    q /= q.sum()
    kl = lambda a, b: float((a * np.log(a / b)).sum())
    out = []
    for g, p in sorted(hist.items()):
        p = (p + 1e-9) / (p + 1e-9).sum()
        mixed = [w * p + (1 - w) * q for w in np.linspace(1e-6, 1 - 1e-6, steps)]
        points = sorted([(np.exp(-scale * kl(q, m)), np.exp(-scale * kl(p, m))) for m in mixed] + [(0.0, 1.0), (1.0, 0.0)])
        x, y = np.array(points).T
        out.append((g, float(-np.log(max(np.trapezoid(y, x), 1e-12)))))
    return vectors.sparkSession.createDataFrame(out, f"{group} string, mad double")


def leaderboard(clips: DataFrame, scores: DataFrame, references: dict[str, DataFrame], spread: DataFrame, *, k: int = 8) -> DataFrame:
    """(model, prompts, clap, one distance for each of ``references``, mad): one row a model.

    ``clips`` is (model, prompt_id, the columns that ``references`` name, embedding) and may hold frames; ``scores`` is
    (model, prompt_id, clap). ``references`` gives a one-row table of moments for each column of ``clips``; its
    distance is named as the column. ``spread`` holds the reference vectors of the clusters.
    """
    out = scores.groupBy("model").agg(F.count_distinct("prompt_id").alias("prompts"), F.avg("clap").alias("clap"))
    for column, reference in references.items():
        far = frechet(moments(clips, "model", column), reference, "model")
        out = out.join(far.withColumnRenamed("distance", column), "model", "left")
    return out.join(mauve_distance(clips.select("model", "embedding"), spread, "model", k=k), "model", "left")
