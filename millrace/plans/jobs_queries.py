"""Queries of :mod:`millrace.operators.jobs`."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.text import fingerprint
from millrace.operators import jobs as J
from millrace.plans.registry import query
from millrace.plans.text_queries import PRINT

BY = "SELECT job_id, count(*) AS n, bool_or(accepted) AS ok FROM <attempts_v> GROUP BY job_id"


@query("""SELECT job_id, retry, coalesce(a.feedback, 'none') AS feedback, coalesce('m' || a.tokens::int, j.model_id) AS model_id, request_id FROM <attempts_v> a LEFT JOIN <jobs_v> j USING (job_id)""")
def joi4_attempt_fields(v):
    joined = v("attempts_v").join(v("jobs_v"), "job_id", "left")
    own = F.concat(F.lit("m"), F.col("tokens").cast("int").cast("string"))
    return joined.select("job_id", "retry", F.coalesce("feedback", F.lit("none")).alias("feedback"), F.coalesce(own, F.col("model_id")).alias("model_id"), "request_id")


@query(f"""SELECT job_id, j.model_id FROM <jobs_v> j LEFT JOIN ({BY}) b USING (job_id) WHERE NOT coalesce(ok, false) AND coalesce(n, 0) < 5 AND model_id <> '5-LOW' AND request_id NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def joi5_pending(v):
    saved = v("customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("request_id"))
    models = v("jobs_v").where("model_id <> '5-LOW'").select("model_id").distinct()
    return J.pending(v("jobs_v"), v("attempts_v"), saved, models, 5).select("job_id", "model_id")


@query("""WITH o AS (SELECT id, family FROM <requests_v> WHERE id % 10 <> 3), n AS (SELECT id, CASE WHEN id % 7 = 0 THEN 'new' ELSE family END AS family FROM <requests_v> WHERE id % 10 <> 4)
SELECT id, CASE WHEN o.family IS NULL THEN 'added' WHEN n.family IS NULL THEN 'removed' WHEN o.family <> n.family THEN 'changed' ELSE 'same' END AS change FROM o FULL JOIN n USING (id)""")
def joi6_snapshot_diff(v):
    rows = v("requests_v").select("id", "family")
    new = rows.where("id % 10 <> 4").withColumn("family", F.when(F.col("id") % 7 == 0, "new").otherwise(F.col("family")))
    return J.snapshot_diff(rows.where("id % 10 <> 3"), new, "id")


@query("SELECT job_id, count(*) AS attempts, arg_max(feedback, retry) AS latest, min(retry) FILTER (accepted) AS first_accepted FROM <attempts_v> GROUP BY job_id")
def win6_history(v):
    return J.history(v("attempts_v"))


SHARES = "(SELECT o_orderpriority AS model_id, row_number() OVER (ORDER BY o_orderpriority) AS pos, 0.1 + 0.07 * row_number() OVER (ORDER BY o_orderpriority) AS fraction FROM (SELECT DISTINCT o_orderpriority FROM orders))"
QUOTA = f"""SELECT model_id, pos, base + (row_number() OVER (ORDER BY raw - base DESC, pos) <= n_jobs - sum(base) OVER ())::bigint AS quota FROM (SELECT *, floor(raw)::bigint AS base FROM (SELECT model_id, pos, n_jobs, n_jobs * fraction::double / sum(fraction::double) OVER () AS raw FROM {SHARES}, (SELECT count(*) AS n_jobs FROM <jobs_v>)))"""


def quotas(v):
    """Quotas of the models over all jobs."""
    models = v("orders").select(F.col("o_orderpriority").alias("model_id")).distinct()  # one row a model
    placed = models.withColumn("pos", F.row_number().over(W.orderBy("model_id")))
    return J.allocate(placed.withColumn("fraction", F.expr("0.1 + 0.07 * pos")), v("jobs_v").count())


@query(f"SELECT model_id, pos, quota FROM ({QUOTA})")
def win8_largest_remainder(v):
    return quotas(v).select("model_id", "pos", "quota")


@query(f"""WITH q AS (SELECT model_id, sum(quota) OVER (ORDER BY pos) - quota AS lo, sum(quota) OVER (ORDER BY pos) AS hi FROM ({QUOTA})), j AS (SELECT job_id, row_number() OVER (ORDER BY job_index) - 1 AS row_index FROM <jobs_v>)
SELECT job_id, row_index, q.model_id AS assigned FROM j LEFT JOIN q ON row_index >= lo AND row_index < hi""")
def win7_assign_models(v):
    return J.assign_models(v("jobs_v").select("job_id", "job_index"), quotas(v)).select("job_id", "row_index", "assigned")


@query("""SELECT id, ['vague', 'mood', 'genre', 'solo'][id % 4 + 1] AS style, ['a', 'b', 'c'][id % 3 + 1] AS opening, ['x', 'y', 'z', 'w', 'u'][(3 * id + 1) % 5 + 1] AS focus FROM <requests_v>""")
def win9_round_robin(v):
    pick = lambda options, at: F.get(F.array(*map(F.lit, options)), F.pmod(at, F.lit(len(options))).cast("int"))
    i = F.col("id")
    return v("requests_v").select("id", pick(("vague", "mood", "genre", "solo"), i).alias("style"), pick("abc", i).alias("opening"), pick("xyzwu", 3 * i + 1).alias("focus"))


@query(f"""WITH gone AS (SELECT job_id, row_number() OVER (ORDER BY job_index) - 1 AS i FROM <jobs_v> LEFT JOIN ({BY}) USING (job_id) WHERE model_id = '5-LOW' AND NOT coalesce(ok, false))
SELECT job_id, CASE WHEN gone.job_id IS NULL THEN model_id WHEN i < (SELECT count(*) + 1 FROM gone) // 2 THEN '1-URGENT' ELSE '2-HIGH' END AS model_id FROM <jobs_v> LEFT JOIN gone USING (job_id)""".replace("gone.job_id IS NULL", "i IS NULL"))
def win10_reassign(v):
    """Unfinished jobs of a removed model go to two others, half and half; job ids stay."""
    jobs = v("jobs_v").select("job_id", "job_index", "model_id")
    by = v("attempts_v").groupBy("job_id").agg(F.bool_or("accepted").alias("ok"))
    gone = jobs.where("model_id = '5-LOW'").join(by, "job_id", "left").where("NOT coalesce(ok, false)").select("job_id", "job_index")
    shares = gone.sparkSession.createDataFrame([("1-URGENT", 1, 0.5), ("2-HIGH", 2, 0.5)], "model_id string, pos int, fraction double")
    moved = J.assign_models(gone, J.allocate(shares, gone.count())).select("job_id", "assigned")
    return jobs.join(moved, "job_id", "left").select("job_id", F.coalesce("assigned", "model_id").alias("model_id"))


@query("SELECT task_id, step // 25 AS window, round(avg(total), 10) AS mean, round(avg(total) - lag(avg(total)) OVER (PARTITION BY task_id ORDER BY step // 25), 10) AS change FROM <rollouts_v> GROUP BY task_id, step // 25")
def win11_reward_windows(v):
    by = v("rollouts_v").groupBy("task_id", F.floor(F.col("step") / 25).alias("window")).agg(F.avg("total").alias("m"))
    change = F.col("m") - F.lag("m").over(W.partitionBy("task_id").orderBy("window"))
    return by.select("task_id", "window", F.round("m", 10).alias("mean"), F.round(change, 10).alias("change"))


@query("SELECT job_id, max(retry) AS attempts FROM <attempts_v> GROUP BY job_id HAVING NOT arg_max(accepted, retry) AND max(retry) < 4")
def win12_retry_round(v):
    by = v("attempts_v").groupBy("job_id").agg(F.max("retry").alias("attempts"), F.max_by("accepted", "retry").alias("last"))
    return by.where("NOT last AND attempts < 4").select("job_id", "attempts")


@query(f"""WITH s AS (SELECT model_id, job_index, coalesce(ok, false) AS ok, NOT coalesce(ok, false) AND coalesce(n, 0) < 3 AS open FROM <jobs_v> LEFT JOIN ({BY}) USING (job_id)), g AS (SELECT model_id, count(*) AS jobs, count(*) FILTER (ok) AS accepted, min(job_index) FILTER (open) AS next_job FROM s GROUP BY model_id)
SELECT model_id, quota AS target, jobs, accepted, next_job, greatest(0, quota - accepted) AS shortfall, accepted > quota AS overrun FROM ({QUOTA}) LEFT JOIN g USING (model_id)""")
def agg11_progress(v):
    targets = quotas(v).select("model_id", F.col("quota").alias("target"))
    return J.progress(v("jobs_v"), v("attempts_v"), targets, 3)


@query(f"""WITH s AS (SELECT model_id, coalesce(ok, false) AS ok, request_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) AS saved FROM <jobs_v> LEFT JOIN ({BY}) USING (job_id)), g AS (SELECT model_id, count(*) FILTER (ok) AS accepted, count(*) FILTER (NOT ok AND saved) AS credited FROM s GROUP BY model_id)
SELECT model_id, greatest(quota - credited, accepted) AS target, accepted + credited AS shown FROM ({QUOTA}) JOIN g USING (model_id)""")
def agg12_credited_targets(v):
    """Targets less the unfinished jobs whose request has a saved answer, never below what is accepted."""
    saved = v("customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("request_id"), F.lit(True).alias("saved"))
    by = v("attempts_v").groupBy("job_id").agg(F.bool_or("accepted").alias("ok"))
    state = v("jobs_v").join(by, "job_id", "left").join(saved, "request_id", "left").fillna(False, ["ok", "saved"])
    got = state.groupBy("model_id").agg(F.count_if("ok").alias("accepted"), F.count_if(~F.col("ok") & F.col("saved")).alias("credited"))
    return quotas(v).join(got, "model_id").select("model_id", F.greatest(F.col("quota") - F.col("credited"), F.col("accepted")).alias("target"), (F.col("accepted") + F.col("credited")).alias("shown"))


@query("""SELECT model_id, retry, sum(tokens)::bigint AS total, sum(CASE WHEN retry % 2 = 0 THEN tokens ELSE 0 END)::bigint AS prompt FROM <attempts_v> JOIN <jobs_v> USING (job_id) GROUP BY model_id, retry""")
def agg18_token_usage(v):
    """Usage records name the same figure in more than one way; the first that is there counts."""
    usage = F.when(F.col("retry") % 2 == 0, F.to_json(F.struct(F.col("tokens").cast("bigint").alias("prompt_tokens")))).otherwise(F.to_json(F.struct(F.col("tokens").cast("bigint").alias("total"))))
    rows = v("attempts_v").join(v("jobs_v"), "job_id").withColumn("usage", usage)
    field = lambda *names: F.coalesce(*(F.get_json_object("usage", f"$.{n}").cast("bigint") for n in names))
    return rows.groupBy("model_id", "retry").agg(F.sum(field("total", "total_tokens", "prompt_tokens")).alias("total"), F.sum(F.coalesce(field("prompt", "prompt_tokens"), F.lit(0))).alias("prompt"))


@query("""SELECT job_id, 'journal' AS origin FROM <attempts_v> WHERE accepted GROUP BY job_id UNION ALL SELECT o_orderkey AS job_id, 'completed' AS origin FROM orders WHERE o_orderstatus = 'F' AND o_orderkey NOT IN (SELECT job_id FROM <attempts_v> WHERE accepted)""")
def set2_accepted(v):
    journal = v("attempts_v").where("accepted").select("job_id").distinct()
    completed = v("orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("job_id")).join(journal, "job_id", "left_anti")
    return journal.withColumn("origin", F.lit("journal")).unionByName(completed.withColumn("origin", F.lit("completed")))


@query("""SELECT l_partkey % 16 AS run_id, count(DISTINCT l_orderkey) AS n_accepted FROM lineitem WHERE l_returnflag = 'A' AND l_partkey % 16 IN (13, 6, 3, 1, 0) GROUP BY 1""")
def set3_lineage_union(v):
    """Accepted rows of run 13 and all its ancestors; a run's parent is half of it."""
    run = F.col("l_partkey") % 16
    runs = v("lineitem").select(run.alias("run_id")).distinct().withColumn("parent_id", F.when(F.col("run_id") > 0, F.expr("run_id div 2")))
    accepted = v("lineitem").where(F.col("l_returnflag") == "A").select(run.alias("run_id"), "l_orderkey")
    return accepted.join(J.lineage(runs, 13), "run_id", "left_semi").groupBy("run_id").agg(F.count_distinct("l_orderkey").alias("n_accepted"))


@query("""SELECT l_partkey % 16 AS run_id, count(*) AS n, sum(l_linenumber)::BIGINT AS lines FROM lineitem WHERE l_partkey % 16 IN (13, 6, 3, 1, 0) GROUP BY 1""")
def set3_checked_lineage(v):
    """Rows of run 13 and its ancestors, which are as they were when the next run was frozen, though dealt out otherwise."""
    rows = v("lineitem").withColumn("run_id", F.col("l_partkey") % 16)
    runs = rows.select("run_id").distinct().withColumn("parent_id", F.when(F.col("run_id") > 0, F.expr("run_id div 2")))
    frozen = J.frozen_lineage(runs, rows.repartition("l_suppkey"), 13)
    return J.checked_rows(frozen, rows, 13).groupBy("run_id").agg(F.count(F.lit(1)).alias("n"), F.sum("l_linenumber").cast("bigint").alias("lines"))


@query("SELECT id FROM <tasks_v> WHERE id NOT IN (SELECT id FROM <predictions_v>)")
def set6_without_prediction(v):
    return v("tasks_v").select("id").join(v("predictions_v"), "id", "left_anti")


@query(f"""WITH k AS (SELECT id, {PRINT.format('prompt')} AS key, sha256('7,' || id) AS h FROM <requests_v> WHERE split = 'train'), s AS (SELECT {PRINT.format('prompt')} AS key, id FROM <requests_v> WHERE split <> 'train'), o AS (SELECT * FROM k WHERE key NOT IN (SELECT key FROM s) AND id NOT IN (SELECT id FROM s))
SELECT id, h FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY h, id) AS rn FROM o) WHERE rn = 1 ORDER BY h LIMIT 50""")
def win3_joi8_replay(v):
    """Fifty unseen rows in seeded order, one for each prompt."""
    rows = v("requests_v").select("id", "split", fingerprint("prompt").alias("key"))
    return J.replay(rows.where("split = 'train'"), rows.where("split <> 'train'"), 50, 7)
