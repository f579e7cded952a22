"""Queries of :mod:`millrace.operators.retrieval`."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.text import words
from millrace.operators import retrieval as R
from millrace.plans.dedup_queries import WORDS
from millrace.plans.registry import query

JOINED = """SELECT v.task_id, v.pos, s.id, v.techniques, s.methods, s.structural_variation, v.embedding AS q, s.embedding AS e, s.role FROM <voices_v> v JOIN <stems_v> s ON v.role = s.role AND s.density BETWEEN v.density_lo AND v.density_hi AND s.family <> v.own_family"""
SCORE = "round(0.65 * list_cosine_similarity(q::double[], e::double[]) + 0.25 * len(list_intersect(techniques, methods)) / greatest(1, len(techniques)) + 0.10 * structural_variation, 5)"


@query(f"SELECT task_id, id FROM ({JOINED})")
def joi1_candidates(v):
    return R.candidates(v("voices_v"), v("stems_v")).select("task_id", "id")


@query(f"SELECT task_id, id, {SCORE} AS score FROM ({JOINED})")
def par17_rank_score(v):
    return R.ranked(v("voices_v"), v("stems_v")).select("task_id", "id", "score")


@query(f"SELECT task_id, pos, arg_min(id, (-score, id)) AS id, max(score) AS score FROM (SELECT *, {SCORE} AS score FROM ({JOINED})) GROUP BY task_id, pos")
def win4_best_stem(v):
    return R.best_stem(R.ranked(v("voices_v"), v("stems_v"), best=True))


@query(f"SELECT task_id, role FROM <voices_v> WHERE task_id NOT IN (SELECT task_id FROM ({JOINED}) WHERE structural_variation > 0.8 AND id % 11 = 0)")
def win4_missing_roles(v):
    found = R.candidates(v("voices_v"), v("stems_v")).where("structural_variation > 0.8 AND id % 11 = 0").select("task_id")
    return v("voices_v").join(found, "task_id", "left_anti").select("task_id", "role")


@query("""SELECT query_id, id, score, place FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS place FROM (SELECT q.vec_id AS query_id, e.vec_id AS id, round(list_cosine_similarity(q.embedding::double[], e.embedding::double[]), 6) AS score
  FROM embeddings q JOIN embeddings e ON q.vec_id % 50 = 0)) WHERE place <= 5""")
def top4_vector_top_k(v):
    """Queries are the vectors whose id is divisible by 50, against all."""
    rows = v("embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return R.top_k(rows.where("id % 50 = 0"), rows, 5)


@query(f"""WITH c AS (SELECT id, word, count(*) AS n FROM (SELECT id, unnest({WORDS}) AS word FROM <requests_v>) GROUP BY ALL), m AS (SELECT id, greatest(sqrt(sum(n * n)), 1e-12) AS norm FROM c GROUP BY id)
SELECT x.id AS a, y.id AS b, round(sum(x.n * y.n) / (any_value(p.norm) * any_value(q.norm)), 6) AS cosine FROM c x JOIN c y ON x.word = y.word AND y.id % 50 = 0 JOIN m p ON p.id = x.id JOIN m q ON q.id = y.id GROUP BY x.id, y.id""")
def par16_lexical_cosine(v):
    rows = v("requests_v").select("id", words("prompt").alias("words"))
    return R.lexical_pairs(rows, rows.where("id % 50 = 0"), digits=6)


@query("SELECT c.clip_id, round(greatest(-1.0, least(1.0, list_cosine_similarity(c.embedding::double[], t.embedding::double[]))), 6) AS score FROM <clips_v> c JOIN <clips_v> t ON t.clip_id = c.prompt_id")
def par18_clap_score(v):
    clips = v("clips_v")
    texts = clips.select(F.col("clip_id").alias("prompt_id"), F.col("embedding").alias("t"))
    return clips.join(texts, "prompt_id").select("clip_id", F.round(R.clap_score(F.col("embedding"), F.col("t")), 6).alias("score"))


@query("""SELECT f.clip_id, round(greatest(-1.0, least(1.0, list_avg(list_transform(f.frames, lambda x: list_cosine_similarity(x::double[], t.embedding::double[]))))), 6) AS score FROM <frames_v> f JOIN <frames_v> t ON t.clip_id = f.prompt_id""")
def par18_frame_score(v):
    """Clips of one to three frames against the vector of their prompt."""
    clips = v("frames_v")
    texts = clips.select(F.col("clip_id").alias("prompt_id"), F.col("embedding").alias("t"))
    return clips.join(texts, "prompt_id").select("clip_id", F.round(R.frames_score(F.col("frames"), F.col("t")), 6).alias("score"))


@query(f"SELECT word, count(*) AS df FROM (SELECT unnest(list_distinct({WORDS})) AS word FROM <requests_v>) GROUP BY word")
def agg19_vocabulary(v):
    return R.vocabulary(v("requests_v").select(words("prompt").alias("words")))


@query("SELECT conv_id, turn, total FROM (SELECT *, sum(tokens) OVER (PARTITION BY conv_id ORDER BY turn DESC ROWS UNBOUNDED PRECEDING)::bigint AS total FROM <chat_v>) WHERE total <= 90")
def win5_newest_first(v):
    return R.newest_first(v("chat_v"), 90).select("conv_id", "turn", "total")


_ROOM = "CASE conv_id % 6 WHEN 0 THEN 100000 WHEN 1 THEN 720 WHEN 2 THEN 360 WHEN 3 THEN 170 WHEN 4 THEN 70 ELSE 20 END"
_COUNT = lambda x: f"len(regexp_extract_all({x}, '\\S+'))"


def _cut_sql(limit: int) -> str:
    first, last = f"code[1 : {limit - limit // 3}]", f"right(code, {limit // 3})"
    begin, end = f"regexp_extract({first}, '(?s)^(.*)\\n', 1)", f"regexp_extract({last}, '(?s)^[^\\n]*\\n(.*)$', 1)"
    text = f"CASE WHEN {begin} <> '' THEN {begin} ELSE {first} END || chr(10) || '[cut]' || chr(10) || CASE WHEN {end} <> '' THEN {end} ELSE {last} END"
    return f"CASE WHEN length(code) > {limit} THEN {{'size': asked + {_COUNT(text)}, 'limit': {limit}, 'kept': {text}}} END"


@query(f"""WITH t AS (SELECT doc_id // 4 AS conv_id, doc_id % 4 AS turn, coalesce(source, '') AS prompt, coalesce(text, '') AS code FROM documents),
r AS (SELECT *, {_ROOM} - 10 AS room, {_COUNT('prompt')} AS asked, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back FROM t),
l AS (SELECT *, {{'size': asked + {_COUNT('code')}, 'limit': NULL::INT, 'kept': code}} AS whole, CASE WHEN back = 1 THEN list_filter([{", ".join(map(_cut_sql, R.EXCERPTS))}], lambda x: x IS NOT NULL AND x.size <= room) ELSE [] END AS cuts FROM r),
c AS (SELECT *, CASE WHEN whole.size <= room OR back > 1 OR len(cuts) = 0 THEN whole ELSE cuts[1] END AS chosen FROM l),
s AS (SELECT conv_id, turn, chosen.limit AS "limit", md5(chosen.kept) AS kept, room, sum(chosen.size) OVER (PARTITION BY conv_id ORDER BY turn DESC)::BIGINT AS total FROM c)
SELECT conv_id, turn, "limit", kept, total FROM s WHERE total <= room""")
def win5_excerpts(v):
    """Documents as turns; in every sixth conversation the newest turn fits as it is, in others only shortened to one of four lengths, or not at all."""
    turns = v("documents").select(F.expr("doc_id div 4").alias("conv_id"), (F.col("doc_id") % 4).alias("turn"), F.coalesce("source", F.lit("")).alias("prompt"), F.coalesce("text", F.lit("")).alias("code"))
    return R.packed_history(turns, F.expr(_ROOM), fixed=10).select("conv_id", "turn", "limit", F.md5("kept").alias("kept"), "total")


@query("""WITH o AS (SELECT l_orderkey AS task_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS pos, l_quantity::bigint AS tokens FROM lineitem),
RECURSIVE_LIST AS (SELECT task_id, list({'pos': pos, 'tokens': tokens} ORDER BY pos) AS items FROM o GROUP BY task_id)
SELECT task_id, list_reduce(list_prepend(0::bigint, list_transform(items, lambda x: x.tokens)), lambda a, x: CASE WHEN a + x <= 80 THEN a + x ELSE a END) AS used FROM RECURSIVE_LIST""")
def par14_budget_packing(v):
    """Each item is taken iff it fits; items are those of one task only."""
    from pyspark.sql import Window as W

    place = F.row_number().over(W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"))
    items = v("lineitem").withColumn("pos", place).groupBy(F.col("l_orderkey").alias("task_id"))
    packed = items.agg(R.pack(F.collect_list(F.struct("pos", F.col("pos").cast("string").alias("name"), F.col("l_quantity").cast("bigint").alias("tokens"))), 80).alias("p"))
    return packed.select("task_id", "p.used")


@query("""SELECT id, '<stem id="' || id || '">role ' || role || ' at ' || printf('%.2f', density) || ' events per cycle, using ' || replace(array_to_string(methods, ' & '), '&', '&amp;') || '</stem>' AS item FROM <stems_v>""")
def par13_explain_stem(v):
    c = F.col
    return v("stems_v").select("id", R.explain_stem(c("id"), c("role"), c("density"), c("methods")).alias("item"))


@query("""SELECT id % 25 AS task_id, bool_or(role = 'bass') AND bool_or(role = 'chords_pad') AND NOT bool_or(role = 'bass' AND list_contains(methods, 'lpf') OR role = 'chords_pad' AND list_contains(methods, 'hpf')) AS hint FROM <stems_v> GROUP BY 1""")
def par15_mix_hint(v):
    return R.mix_hint(v("stems_v").withColumn("task_id", F.col("id") % 25))
