"""Queries of :mod:`millrace.operators.evaluation`, and of exports."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.operators import evaluation as E
from millrace.plans.registry import query
from millrace.plans.text_queries import WHOLE

_VALID = WHOLE.format("coalesce(completion, '')")
_SCORED = f"SELECT t.id, category, author_id, completion IS NULL AS missing, {_VALID} AS valid, CASE WHEN {_VALID} THEN (t.id % 10) / 10.0::double ELSE 0.0 END AS reward FROM <tasks_v> t LEFT JOIN <predictions_v> p ON t.id = p.id"


def scored(v):
    rows = E.scored_predictions(v("tasks_v"), v("predictions_v"))
    return rows.withColumn("reward", F.when(F.col("valid"), (F.col("id") % 10) / 10).otherwise(0.0))


@query(f"SELECT id, missing, valid FROM ({_SCORED})")
def joi2_scored_predictions(v):
    return scored(v).select("id", "missing", "valid")


@query("SELECT id FROM <predictions_v> WHERE id NOT IN (SELECT id FROM <tasks_v>)")
def joi2_extra_predictions(v):
    return E.extra_predictions(v("tasks_v"), v("predictions_v")).select("id")


@query(rf"""SELECT p.id, prompt, CASE WHEN {_VALID} THEN 'parsed' ELSE 'raw' END AS shown, CASE WHEN {_VALID} THEN 'n(' || p.id || ')' ELSE completion END AS text FROM <predictions_v> p JOIN <tasks_v> t ON p.id = t.id""")
def joi3_viewer_rows(v):
    """Predictions of the tasks that there are; others would be an error."""
    return E.viewer_rows(v("tasks_v"), v("predictions_v").join(v("tasks_v").select("id"), "id", "left_semi"))


@query("SELECT m.model, p.prompt_id FROM (SELECT DISTINCT model FROM <clips_v>) m CROSS JOIN (SELECT DISTINCT prompt_id FROM <clips_v>) p WHERE NOT EXISTS (SELECT 1 FROM <clips_v> c WHERE c.model = m.model AND c.prompt_id = p.prompt_id)")
def joi9_missing_pairs(v):
    return E.coverage(v("clips_v"))


@query("WITH r AS (SELECT s.run, s.step, l.metric FROM <saves_v> s ASOF LEFT JOIN (SELECT * FROM <log_v> WHERE metric IS NOT NULL) l ON s.run = l.run AND s.step >= l.step) SELECT run, step, metric FROM r")
def joi12_metric_at_save(v):
    return E.metric_at_save(v("log_v"), v("saves_v"))


@query("WITH r AS (SELECT s.run, s.step, l.metric FROM <saves_v> s ASOF JOIN (SELECT * FROM <log_v> WHERE metric IS NOT NULL) l ON s.run = l.run AND s.step >= l.step) SELECT run, arg_min(step, (-metric, step)) AS step, max(metric) AS metric FROM r GROUP BY run")
def joi12_best_save(v):
    return E.best_save(E.metric_at_save(v("log_v"), v("saves_v")))


@query("""SELECT doc_id, content_hash FROM (SELECT doc_id, sha256(text) AS content_hash, CASE WHEN doc_id % 2 = 0 THEN 'a' ELSE 'b' END AS protocol FROM documents) d WHERE NOT EXISTS (SELECT 1 FROM (SELECT sha256(text) AS h, 'a' AS p FROM documents WHERE doc_id % 3 = 0) c WHERE c.h = content_hash AND c.p = protocol)""")
def joi14_uncached(v):
    clips = v("documents").select("doc_id", F.sha2("text", 256).alias("content_hash"), F.when(F.col("doc_id") % 2 == 0, "a").otherwise("b").alias("protocol"))
    cache = v("documents").where("doc_id % 3 = 0").select(F.sha2("text", 256).alias("content_hash"), F.lit("a").alias("protocol")).distinct()
    return E.uncached(clips, cache).select("doc_id", "content_hash")


@query("""WITH g AS (SELECT source, count(*) AS n FROM documents WHERE lang <> 'es' GROUP BY source), e AS (SELECT source, count(*) AS expected FROM documents WHERE source <> 'src2' GROUP BY source)
SELECT source, coalesce(n, 0) AS n, coalesce(expected, 0) AS expected FROM g FULL JOIN e USING (source) WHERE coalesce(n, 0) <> coalesce(expected, 0)""")
def joi15_count_mismatches(v):
    docs = v("documents").select("source", "lang")
    expected = docs.where("source <> 'src2'").groupBy("source").agg(F.count(F.lit(1)).alias("expected"))
    return E.count_mismatches(docs.where("lang <> 'es'"), expected, "source")


@query(f"""SELECT category, author_id, count(*) AS tasks, count(*) FILTER (missing) AS missing, round(avg(valid::int), 6) AS execution_rate, round(avg(reward), 6) AS mean_reward FROM ({_SCORED}) GROUP BY ROLLUP (category, author_id)""")
def agg13_summary(v):
    got = E.summary(scored(v), "category", "author_id")
    return got.withColumns({c: F.round(c, 6) for c in ("execution_rate", "mean_reward")})


@query("""SELECT component, round(avg(component_value), 6) AS mean, round(avg((component_value >= 1)::int), 6) AS passed, count(*) AS n, round(quantile_cont(component_value, 0.02), 6) AS p2, round(quantile_cont(component_value, 0.98), 6) AS p98 FROM <rollouts_v> GROUP BY component""")
def agg14_component_rates(v):
    got = E.component_rates(v("rollouts_v"))
    return got.withColumns({c: F.round(c, 6) for c in ("mean", "passed", "p2", "p98")})


@query("SELECT task_id FROM <rollouts_v> GROUP BY task_id HAVING min(total) = max(total)")
def agg15_flat_tasks(v):
    return E.flat_tasks(v("rollouts_v"))


@query("SELECT task_id, ordinal FROM <rollouts_v> WHERE task_id NOT IN (SELECT task_id FROM <rollouts_v> GROUP BY task_id HAVING min(total) = max(total))")
def agg15_kept_rollouts(v):
    return v("rollouts_v").join(E.flat_tasks(v("rollouts_v")), "task_id", "left_anti").select("task_id", "ordinal")


@query("""SELECT model, count(DISTINCT prompt_id) AS prompts, round(avg(greatest(-1.0, least(1.0, list_cosine_similarity(embedding::double[], t::double[])))), 6) AS clap FROM <clips_v> c JOIN (SELECT clip_id AS prompt, embedding AS t FROM <clips_v>) x ON x.prompt = prompt_id GROUP BY model""")
def agg16_leaderboard(v):
    from millrace.operators.retrieval import clap_score

    clips = v("clips_v")
    texts = clips.select(F.col("clip_id").alias("prompt_id"), F.col("embedding").alias("t"))
    return clips.join(texts, "prompt_id").groupBy("model").agg(F.count_distinct("prompt_id").alias("prompts"), F.round(F.avg(clap_score(F.col("embedding"), F.col("t"))), 6).alias("clap"))


@query("SELECT prompt_id FROM <clips_v> WHERE model IN ('model1', 'model2', 'model3') GROUP BY prompt_id HAVING count(DISTINCT model) = 3")
def agg17_shared_prompts(v):
    return E.shared_prompts(v("clips_v"), ["model1", "model2", "model3"])


@query("SELECT prompt_id FROM <clips_v> WHERE model = 'model4' INTERSECT SELECT prompt_id FROM <clips_v> WHERE model = 'model5'")
def set4_intersection(v):
    one = lambda m: v("clips_v").where(F.col("model") == m).select("prompt_id")
    return one("model4").intersect(one("model5"))


@query()
def udf3_frechet_distance(v):
    clips = v("clips_v")
    reference = E.moments(clips.withColumn("every", F.lit("all")), "every")
    return E.frechet(E.moments(clips, "model"), reference, "model")


@query("""WITH f AS (SELECT model, unnest(frames)::double[] AS x FROM <frames_v>), d AS (SELECT model, unnest(range(1, 33)) AS i, unnest(x) AS y FROM f), m AS (SELECT model, i, count(*) AS n, avg(y) AS mean, var_samp(y) AS var FROM d GROUP BY ALL)
SELECT model, max(n) AS n, round(sum(mean), 6) AS mean_sum, round(sum(var), 6) AS variance FROM m GROUP BY model""")
def udf3_frame_moments(v):
    """Frames of each model: how many, and the sums of their means and variances over all dimensions."""
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    size = F.size("mean")
    diagonal = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.get("cov", i * (size + 1)))
    return E.moments(v("frames_v"), "model", "frames").select("model", "n", F.round(total(F.col("mean")), 6).alias("mean_sum"), F.round(total(diagonal), 6).alias("variance"))


@query()
def agg16_distances(v):
    """Leaderboard of the models: prompts, mean score, Fréchet distances of frames and of whole clips, cluster distance."""
    from millrace.operators.retrieval import frames_score

    clips = v("frames_v").select("clip_id", "model", "prompt_id", F.col("frames").alias("fad"), F.col("embedding").alias("fad_clap"), "embedding")
    texts = clips.select(F.col("clip_id").alias("prompt_id"), F.col("embedding").alias("t"))
    scores = clips.join(texts, "prompt_id").select("model", "prompt_id", frames_score(F.col("fad"), F.col("t")).alias("clap"))
    every = clips.withColumn("every", F.lit("all"))
    references = {c: E.moments(every, "every", c) for c in ("fad", "fad_clap")}
    return E.leaderboard(clips, scores, references, clips.select("embedding"))


@query()
def udf4_mauve_distance(v):
    return E.mauve_distance(v("clips_v").select("model", "embedding"), v("clips_v").where("clip_id % 2 = 0"), "model")


@query("SELECT id, prompt FROM <requests_v> WHERE split = 'train'")
def top1_bank_export(v):
    rows = v("requests_v").where("split = 'train'").select("id", "prompt")
    return rows.repartitionByRange("id").sortWithinPartitions("id")


@query("""SELECT block, task_id, ordinal, total, side FROM (SELECT *, step // 50 AS block, row_number() OVER (PARTITION BY step // 50 ORDER BY total DESC, ordinal) AS hi, row_number() OVER (PARTITION BY step // 50 ORDER BY total, ordinal) AS lo FROM <rollouts_v>), (SELECT unnest(['top', 'bottom']) AS side)
WHERE (side = 'top' AND hi <= 5) OR (side = 'bottom' AND lo <= 5)""")
def top2_extremes(v):
    """The five best and worst rollouts of each block of 50 steps; tasks keep their own five before the shuffle."""
    rows = v("rollouts_v").withColumn("block", F.floor(F.col("step") / 50)).select("block", "task_id", "ordinal", "total")
    place = lambda *order: F.row_number().over(W.partitionBy("block").orderBy(*order))
    top = rows.withColumn("p", place(F.desc("total"), "ordinal")).where("p <= 5").withColumn("side", F.lit("top"))
    bottom = rows.withColumn("p", place("total", "ordinal")).where("p <= 5").withColumn("side", F.lit("bottom"))
    return top.unionByName(bottom).drop("p")


@query("SELECT id, sha256('5/' || id) AS h FROM <requests_v> ORDER BY h LIMIT 40")
def top3_avoid_sample(v):
    """A seeded sample of forty prompts."""
    return v("requests_v").select("id", F.sha2(F.concat(F.lit("5/"), F.col("id").cast("string")), 256).alias("h")).orderBy("h").limit(40)


@query("SELECT id FROM <requests_v> WHERE stage = 'rl' AND split = 'train' ORDER BY id LIMIT 25")
def top5_first_eligible(v):
    return v("requests_v").where("stage = 'rl' AND split = 'train'").orderBy("id").limit(25).select("id")


@query("""SELECT id, '{"bpm":' || (60 + id % 90) || ',"category":"' || category || '"}' AS plan, substr(sha256('rl' || chr(31) || id), 1, 24) AS task_id FROM <tasks_v>""")
def par19_training_rows(v):
    plan = F.to_json(F.struct((60 + F.col("id") % 90).alias("bpm"), "category"))
    return v("tasks_v").select("id", plan.alias("plan"), F.substring(F.sha2(F.concat_ws("\x1f", F.lit("rl"), F.col("id").cast("string")), 256), 1, 24).alias("task_id"))


@query("""SELECT substr(sha256('["rl", "' || id || '"]'), 1, 24) AS id, prompt, 'empty' AS retrieval_regime, '' AS context, split FROM <requests_v> WHERE stage = 'rl'""")
def par20_rl_export(v):
    key = F.concat(F.lit('["rl", "'), F.col("id").cast("string"), F.lit('"]'))
    rows = v("requests_v").where("stage = 'rl'")
    return rows.select(F.substring(F.sha2(key, 256), 1, 24).alias("id"), "prompt", F.lit("empty").alias("retrieval_regime"), F.lit("").alias("context"), "split")
