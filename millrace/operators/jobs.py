"""Job journals: quotas, assignment, progress, retries, snapshots and lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.operators.tables import settle


def allocate(shares: DataFrame, count: Column | int, *, by: list[str] | None = None) -> DataFrame:
    """``shares`` (model_id, pos, fraction) with quotas by largest remainder, ties by pos; exact in total.

    ``by`` gives strata with quotas of their own. Fractions are normalised.
    """
    part, n = W.partitionBy(*(by or [])), F.lit(count) if isinstance(count, int) else count
    fraction = F.col("fraction").cast("decimal(20,10)")
    raw = (n.cast("decimal(18,0)") * fraction / F.sum(fraction).over(part)).cast("decimal(38,12)")
    rows = shares.withColumn("raw", raw).withColumn("base", F.floor("raw").cast("bigint"))
    rank = F.row_number().over(part.orderBy(F.desc(F.col("raw") - F.col("base")), "pos"))
    left = n.cast("bigint") - F.sum("base").over(part)
    return rows.withColumn("place", rank).withColumn("left", left).withColumn("quota", F.col("base") + F.when(F.col("place") <= F.col("left"), 1).otherwise(0)).drop("raw", "base", "place", "left")


def positions(rows: DataFrame, order: str, *, name: str = "row_index", partitions: int = 64) -> DataFrame:
    """Rows with their exact 0-based place in a global order, without ordering all rows in one task.

    Ranges of the order are numbered by task, then shifted by the sizes of those before. Their bounds come from a sample
    that another run would draw anew, so the ranges are written once and read by both.
    """
    ranged = settle(rows.repartitionByRange(partitions, order).withColumn("_range", F.spark_partition_id()))
    local = ranged.withColumn("_at", F.row_number().over(W.partitionBy("_range").orderBy(order)))
    sizes = local.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_range", (F.sum("_n").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, 0)) - F.col("_n")).alias("_offset"))
    return local.join(F.broadcast(offsets), "_range").withColumn(name, F.col("_offset") + F.col("_at") - 1).drop("_range", "_at", "_offset")


def assign_models(jobs: DataFrame, quotas: DataFrame, *, order: str = "job_index") -> DataFrame:
    """Jobs in order: the first quota's worth to the first model, and so on; the rest get none."""
    upto = F.sum("quota").over(W.orderBy("pos").rowsBetween(W.unboundedPreceding, 0))
    ranges = quotas.select(F.col("model_id").alias("assigned"), (upto - F.col("quota")).alias("lo"), upto.alias("hi"))
    placed = positions(jobs, order)
    return placed.join(F.broadcast(ranges), (F.col("row_index") >= F.col("lo")) & (F.col("row_index") < F.col("hi")), "left").drop("lo", "hi")


def progress(jobs: DataFrame, attempts: DataFrame, targets: DataFrame, most_attempts: int) -> DataFrame:
    """Per model: target, jobs, accepted, next pending job, shortfall, overrun."""
    by = attempts.groupBy("job_id").agg(F.count(F.lit(1)).alias("n"), F.bool_or("accepted").alias("ok"))
    state = jobs.join(by, "job_id", "left").withColumn("ok", F.coalesce("ok", F.lit(False))).withColumn("open", ~F.col("ok") & (F.coalesce("n", F.lit(0)) < most_attempts))
    got = state.groupBy("model_id").agg(F.count(F.lit(1)).alias("jobs"), F.count_if("ok").alias("accepted"), F.min(F.when(F.col("open"), F.col("job_index"))).alias("next_job"))
    joined = targets.join(got, "model_id", "left").fillna(0, ["jobs", "accepted"])
    return joined.withColumn("shortfall", F.greatest(F.lit(0), F.col("target") - F.col("accepted"))).withColumn("overrun", F.col("accepted") > F.col("target"))


def pending(jobs: DataFrame, attempts: DataFrame, saved: DataFrame, models: DataFrame, most_attempts: int) -> DataFrame:
    """Jobs not accepted, with attempts left, of a known model, whose request isn't saved yet."""
    by = attempts.groupBy("job_id").agg(F.count(F.lit(1)).alias("n"), F.bool_or("accepted").alias("ok"))
    left = jobs.join(by, "job_id", "left").where(~F.coalesce("ok", F.lit(False)) & (F.coalesce("n", F.lit(0)) < most_attempts))
    return left.join(models, "model_id", "left_semi").join(saved, "request_id", "left_anti")


def history(attempts: DataFrame) -> DataFrame:
    """Attempts, latest feedback and first accepted try of each job."""
    return attempts.groupBy("job_id").agg(F.count(F.lit(1)).alias("attempts"), F.max_by("feedback", "retry").alias("latest"), F.min(F.when(F.col("accepted"), F.col("retry"))).alias("first_accepted"))


def snapshot_diff(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """(key, change): added, removed, changed or same, by hashes of the rows."""
    side = lambda rows, name: rows.select(key, F.xxhash64(*sorted(rows.columns)).alias(name))
    both = side(old, "o").join(side(new, "n"), key, "full")
    return both.select(key, F.when(F.col("o").isNull(), "added").when(F.col("n").isNull(), "removed").when(F.col("o") != F.col("n"), "changed").otherwise("same").alias("change"))


def lineage(runs: DataFrame, run: int) -> DataFrame:
    """(run_id, distance) of a run and its ancestors by (run_id, parent_id).

    Jumps double in length each round, so a line of n ancestors takes log n joins. A run
    that is listed twice, and a circle, are errors; an ancestor that isn't listed ends the line.
    """
    if repeated := runs.groupBy("run_id").count().where("count > 1").first():
        raise ValueError(f"run {repeated[0]} is listed more than once")
    jumps = settle(runs.where("parent_id IS NOT NULL").select(F.col("run_id").alias("at"), F.col("parent_id").alias("to")))
    found = settle(runs.where(F.col("run_id") == run).select("run_id", F.lit(0).alias("distance")).unionAll(runs.sparkSession.range(1).select(F.lit(run).cast(runs.schema["run_id"].dataType), F.lit(0))).distinct())
    length = 1
    while True:
        further = found.join(jumps, found.run_id == jumps.at).select(F.col("to").alias("run_id"), (F.col("distance") + length).alias("distance"))
        grown = settle(found.unionAll(further))
        rows, runs_seen = grown.agg(F.count(F.lit(1)), F.count_distinct("run_id")).first()
        if rows > runs_seen:
            raise ValueError(f"the lineage of run {run} is circular")
        if rows < 2 * length:
            return grown
        far = jumps.select(F.col("at").alias("via"), F.col("to").alias("end"))
        jumps = settle(jumps.join(far, F.col("to") == F.col("via")).select("at", F.col("end").alias("to")))
        found, length = grown, 2 * length


def run_prints(rows: DataFrame, *, run: str = "run_id") -> DataFrame:
    """(run, n, mixed, total): for each run how many rows it has, and two sums of their hashes, which no order or partitioning changes.

    All runs are taken in one aggregation with map-side partials. Columns are hashed in the order of their names.
    """
    cells = sorted(c for c in rows.columns if c != run)
    hashed = rows.select(run, F.xxhash64(*cells).alias("h"), F.xxhash64(F.lit(1), *cells).alias("g"))
    return hashed.groupBy(run).agg(F.count(F.lit(1)).alias("n"), F.bit_xor("h").alias("mixed"), F.sum(F.col("g").cast("decimal(38,0)")).alias("total"))


def snapshots(line: DataFrame, rows: DataFrame) -> DataFrame:
    """(run_id, distance, snapshot) of a :func:`lineage`: one hash for the rows of a run and of all its ancestors.

    Prints add up along the line, whose runs (one row each) are put in order by one task; rows are not.
    """
    up = W.orderBy(F.desc("distance")).rowsBetween(W.unboundedPreceding, 0)
    own = line.join(run_prints(rows.join(F.broadcast(line.select("run_id")), "run_id", "left_semi")), "run_id", "left")
    parts = [F.sum(F.coalesce("n", F.lit(0))).over(up), F.bit_xor(F.coalesce("mixed", F.lit(0))).over(up), F.sum(F.coalesce("total", F.lit(0))).over(up)]
    return own.select("run_id", "distance", F.sha2(F.concat_ws(",", *(p.cast("string") for p in parts)), 256).alias("snapshot"))


def frozen_lineage(runs: DataFrame, rows: DataFrame, run: int) -> DataFrame:
    """(run_id, parent_id, parent_snapshot) of a run and its ancestors: what each run builds on, as it is now."""
    line = lineage(runs, run)
    parents = snapshots(line, rows).select(F.col("run_id").alias("parent_id"), F.col("snapshot").alias("parent_snapshot"))
    return settle(runs.join(line.select("run_id"), "run_id", "left_semi").join(parents, "parent_id", "left").select("run_id", "parent_id", "parent_snapshot"))


def checked_rows(frozen: DataFrame, rows: DataFrame, run: int, *, id: str | None = None) -> DataFrame:
    """``rows`` of a run and its ancestors, if every ancestor still is as it was when the next run was frozen; else an error that
    names the farthest that isn't. With ``id`` a repeated id among them is an error too.
    """
    line = settle(lineage(frozen.select("run_id", "parent_id"), run))
    now = snapshots(line, rows).select(F.col("run_id").alias("parent_id"), "distance", "snapshot")
    broken = frozen.join(now, "parent_id").where(~F.col("snapshot").eqNullSafe(F.col("parent_snapshot")))
    if (worst := broken.orderBy(F.desc("distance")).first()) is not None:
        raise ValueError(f"run {worst['parent_id']} has changed since run {worst['run_id']} was frozen")
    kept = rows.join(F.broadcast(line.select("run_id")), "run_id", "left_semi")
    if id and (twice := kept.groupBy(id).count().where("count > 1").first()):
        raise ValueError(f"id {twice[0]} occurs {twice[1]} times in the lineage of run {run}")
    return kept


def replay(rows: DataFrame, seen: DataFrame, n: int, seed: int) -> DataFrame:
    """(id, h): ``n`` rows whose id and key ``seen`` doesn't have, one for each key, in seeded order. Fewer than ``n`` are an error."""
    fresh = rows.join(seen.select("key"), "key", "left_anti").join(seen.select("id"), "id", "left_anti")
    hashed = fresh.withColumn("h", F.sha2(F.concat(F.lit(f"{seed},"), F.col("id").cast("string")), 256))
    chosen = settle(hashed.groupBy("key").agg(F.min(F.struct("h", "id")).alias("first")).select("first.id", "first.h").orderBy("h").limit(n))
    if (left := chosen.count()) < n:
        raise ValueError(f"{n} rows are asked for and {left} are left")
    return chosen
