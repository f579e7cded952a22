"""Queries of :mod:`millrace.operators.validation`."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import events as E
from millrace.operators import validation as V
from millrace.plans.events_queries import haps
from millrace.plans.registry import query
from millrace.plans.views import LICENSES

ALLOWED = ", ".join(f"'{x}'" for x in LICENSES)


def _allowed(v):
    rows = v("region").limit(1).select(F.explode(F.array(*map(F.lit, LICENSES))).alias("license"))
    return F.broadcast(rows)  # nine rows


@query(f"SELECT id, license FROM <sources_v> WHERE license IN ({ALLOWED})")
def fil1_license_pass(v):
    return V.license_gate(v("sources_v"), _allowed(v))[0].select("id", "license")


@query(f"SELECT id, license FROM <sources_v> WHERE license NOT IN ({ALLOWED})")
def fil1_license_rejects(v):
    return V.license_gate(v("sources_v"), _allowed(v))[1].select("id", "license")


@query("""SELECT id, list_filter([CASE WHEN NOT length(prompt) >= 40 THEN 'prompt_short' END, CASE WHEN NOT stage IN ('sft', 'rl') THEN 'stage' END, CASE WHEN NOT id % 17 <= id % 19 THEN 'density' END,
  CASE WHEN NOT ((id % 4 = 0) = (id % 8 < 2)) THEN 'cocreate' END, CASE WHEN NOT (stage = 'rl' OR id % 10 <> 1) THEN 'contract' END], lambda x: x IS NOT NULL) AS reasons FROM <requests_v>""")
def fil2_record_rules(v):
    i = F.col("id")
    rules = {
        "prompt_short": F.length("prompt") >= 40, "stage": F.col("stage").isin("sft", "rl"), "density": i % 17 <= i % 19,
        "cocreate": (i % 4 == 0) == (i % 8 < 2), "contract": (F.col("stage") == "rl") | (i % 10 != 1),
    }
    return V.with_reasons(v("requests_v"), rules).select("id", "reasons")


_TOLD = "concat(CASE id % 5 WHEN 0 THEN 'use lpf (2) ' WHEN 1 THEN 'at 120 bpm ' WHEN 2 THEN 'in F# Lydian ' ELSE '' END, family)"
_STYLE = "CASE id % 3 WHEN 0 THEN 'technical' WHEN 1 THEN 'musical' ELSE 'mood' END"


_quoted = lambda names: ", ".join(f"'{n}'" for n in names)


@query(rf"""WITH q AS (SELECT id, lower({_TOLD}) AS told, {_STYLE} AS style FROM <requests_v>), p AS (SELECT *, regexp_split_to_array(told, '[ :]+') AS parts FROM q),
f AS (SELECT *, len(list_intersect(regexp_extract_all(told, '(\w+)\s*\(', 1), [{_quoted(V.CALLS)}])) > 0 AS calls, len(list_intersect(regexp_extract_all(told, '(?:^|\W)\d+\s*([a-z_]\w*)', 1), [{_quoted(V.UNITS)}])) > 0
  OR len(list_filter(range(1, len(parts)), lambda i: regexp_matches(parts[i], '(^|\W)[a-g][#b]?$') AND regexp_extract(parts[i + 1], '^\w+') IN ({_quoted(V.MODES)}))) > 0 AS precise FROM p)
SELECT id, CASE WHEN style = 'technical' THEN NULL WHEN calls THEN 'api_call' WHEN precise AND style <> 'musical' THEN 'precise' END AS reason FROM f""")
def fil3_style_leak(v):
    rows = v("requests_v").select("id", F.expr(_TOLD).alias("told"), F.expr(_STYLE).alias("style"))
    return rows.select("id", V.style_leak("told", "style").alias("reason"))


_PLAIN = "trim(regexp_replace(replace(lower(translate({0}, '‘’“”', '''''\"\"')), 'ß', 'ss'), '\\s+', ' ', 'g'))"


@query(f"""WITH q AS (SELECT program_id, 'Please play “'|| coalesce(require, 'x') || '”  at ' || cast(tempo AS string) AS prompt, tempo, list_filter([require, CASE WHEN program_id % 7 = 0 THEN 'Ünknown' END], lambda x: x IS NOT NULL) AS quotes,
  list_filter([require, forbid, CASE WHEN program_id % 11 = 0 THEN require END], lambda x: x IS NOT NULL) AS named, require, forbid, voices_min, voices_max, shape, space, key FROM <contracts_v>),
r AS (SELECT *, (require IS NOT NULL)::int + (forbid IS NOT NULL AND forbid <> 'vocals')::int + (voices_min IS NOT NULL)::int + (tempo IS NOT NULL)::int + (key IS NOT NULL)::int AS strong, (shape IS NOT NULL)::int + (space IS NOT NULL)::int AS weak FROM q)
SELECT program_id, list_filter([CASE WHEN NOT coalesce(len(list_filter(quotes, lambda q: NOT contains({_PLAIN.format('prompt')}, {_PLAIN.format('q')}))) = 0 AND prompt IS NOT NULL OR len(quotes) = 0, false) THEN 'quote' END, CASE WHEN NOT len(list_filter(named, lambda n: n NOT IN ('kick', 'bass', 'hi_hat', 'snare', 'vocals'))) = 0 THEN 'unknown_family' END,
  CASE WHEN NOT len(list_distinct(named)) = len(named) THEN 'repeated_family' END, CASE WHEN NOT (voices_min IS NULL OR (voices_min <= voices_max AND (require IS NOT NULL)::int <= voices_max)) THEN 'voices' END, CASE WHEN NOT (strong >= 1 AND strong + weak >= 2) THEN 'too_few' END], lambda x: x IS NOT NULL) AS reasons FROM r""")
def fil4_contract_rules(v):
    c = v("contracts_v")
    prompt = F.expr("concat('Please play “', coalesce(require, 'x'), '”  at ', cast(tempo AS string))")
    rows = c.withColumn("prompt", prompt)
    quotes = F.array_compact(F.array("require", F.when(F.col("program_id") % 7 == 0, "Ünknown")))
    named = F.array_compact(F.array("require", "forbid", F.when(F.col("program_id") % 11 == 0, F.col("require"))))
    n = lambda *xs: sum((F.col(x).isNotNull().cast("int") for x in xs), F.lit(0))
    strong = n("require", "voices_min", "tempo", "key") + (F.col("forbid").isNotNull() & (F.col("forbid") != "vocals")).cast("int")
    rules = V.contract_reasons(
        "prompt", quotes, named, F.array(*map(F.lit, ("kick", "bass", "hi_hat", "snare", "vocals"))), n_strong=strong, n_weak=n("shape", "space"),
        voices_min=F.col("voices_min"), voices_max=F.col("voices_max"), n_require=n("require"),
    )
    return V.with_reasons(rows, rules).select("program_id", "reasons")


#: What a request says of its tempo and key, and the code that comes with it.
_SAID = {
    "tempo_quote": "CASE program_id % 6 WHEN 0 THEN concat('at ', cast(cast(tempo AS bigint) AS string), ' bpm') WHEN 2 THEN concat(cast(cast(tempo AS bigint) AS string), ' BPM') WHEN 4 THEN CASE WHEN program_id % 8 = 0 THEN 'at a fast bpm' ELSE concat(cast(cast(tempo AS bigint) AS string), ' beats') END END",
    "key_quote": "CASE program_id % 3 WHEN 0 THEN 'in C  Minor' WHEN 1 THEN 'in G “MAJOR”' END", "code": "CASE program_id % 10 WHEN 3 THEN 'stack()' WHEN 4 THEN '' END",
}
_SAYS = ", ".join(f"{e} AS {n}" for n, e in _SAID.items())


@query(f"""WITH q AS (SELECT *, {_SAYS} FROM <contracts_v>), r AS (SELECT *, (require IS NOT NULL)::int + (coalesce(forbid, 'vocals') <> 'vocals')::int + (voices_min IS NOT NULL)::int + (tempo IS NOT NULL)::int + (key IS NOT NULL)::int + (coalesce(code, '') <> '')::int AS strong FROM q)
SELECT program_id, list_filter([CASE WHEN NOT coalesce(tempo IS NULL OR (contains(tempo_quote, tempo::BIGINT::VARCHAR) AND contains(lower(tempo_quote), 'bpm')), false) THEN 'tempo_quote' END,
  CASE WHEN NOT coalesce(key IS NULL OR contains(lower(key_quote), split_part(key, ':', 2)), false) THEN 'key_quote' END,
  CASE WHEN NOT (strong >= 1 AND strong + (shape IS NOT NULL)::int + (space IS NOT NULL)::int >= 2) THEN 'too_few' END], lambda x: x IS NOT NULL) AS reasons FROM r""")
def fil4_literal_rules(v):
    c = F.col
    rows = v("contracts_v").withColumns({n: F.expr(e) for n, e in _SAID.items()})
    families = lambda x: F.array_compact(F.array(x))
    rules = V.literal_reasons(tempo=c("tempo"), tempo_quote=c("tempo_quote"), key=c("key"), key_quote=c("key_quote"))
    rules |= V.enough_claims(require=families("require"), forbid=families("forbid"), single=[c("voices_min"), c("tempo"), c("key")], code=c("code"), weak=[c("shape"), c("space")])
    return V.with_reasons(rows, rules).select("program_id", "reasons")


@query("""SELECT program_id, list_filter([CASE WHEN program_id % 15 = 0 THEN 'contract' END, CASE WHEN tempo IS NULL THEN 'tempo' END, CASE WHEN key IS NULL THEN 'key' END], lambda x: x IS NOT NULL) AS authoring,
  list_filter([CASE WHEN program_id % 15 = 0 THEN 'contract' END], lambda x: x IS NOT NULL) AS exporting FROM <contracts_v>""")
def fil5_policy_modes(v):
    """The same requests while they are written and when they are exported."""
    rows = v("contracts_v")
    for name, authoring in (("authoring", True), ("exporting", False)):
        rows = V.with_reasons(rows, V.policy_reasons(F.col("program_id") % 15 != 0, F.col("tempo"), F.col("key"), authoring=authoring), name=name)
    return rows.select("program_id", "authoring", "exporting")


@query("SELECT program_id FROM <contracts_v> WHERE tempo IS NOT NULL AND key IS NOT NULL")
def fil5_rl_policy(v):
    return v("contracts_v").where("tempo IS NOT NULL AND key IS NOT NULL").select("program_id")


@query("SELECT id FROM <tasks_v> WHERE category = 'atomic' OR (category = 'stack' AND id % 5 + 1 <= 3)")
def fil6_warmup(v):
    return v("tasks_v").where((F.col("category") == "atomic") | ((F.col("category") == "stack") & (F.col("id") % 5 + 1 <= 3))).select("id")


@query("""WITH r AS (SELECT id // 2 AS id, split, stage, CASE WHEN id % 8 = 3 THEN 'c' END AS contract FROM <requests_v> WHERE family <> 'src1'),
i AS (SELECT id, count(*) AS n, count(*) FILTER (split <> 'train') AS w, count(*) FILTER (stage = 'rl' AND contract IS NULL) AS c FROM r GROUP BY id)
SELECT unnest(['empty', 'repeated_id', 'wrong_split', 'no_contract']) AS check, unnest([(count(*) = 0)::bigint, count(*) FILTER (n > 1), sum(w)::bigint, sum(c)::bigint]) AS violations FROM i""")
def fil7_training_gate(v):
    rows = v("requests_v").where("family <> 'src1'").select(F.expr("id div 2").alias("id"), "split", "stage", F.when(F.col("id") % 8 == 3, "c").alias("contract"))
    return V.training_gate(rows)


@query("""WITH b AS (SELECT program_id, s, count(*) AS n, count(*) FILTER (onset AND coalesce(gain, 1.0) > 0) AS heard FROM <haps_v> GROUP BY ALL), p AS (SELECT program_id, sum(n)::bigint AS n, sum(heard) AS heard, count(*) FILTER (s NOT IN ('bd', 'gm_cello', 'hh', 'sd')) AS unknown FROM b GROUP BY program_id)
SELECT program_id, n, CASE WHEN n > 100 THEN 'event_cap' WHEN heard = 0 THEN 'silent' WHEN unknown > 0 THEN 'unknown_sound' ELSE 'ok' END AS status FROM p""")
def fil8_run_status(v):
    catalog = v("region").limit(1).select(F.explode(F.array(*map(F.lit, ("bd", "gm_cello", "hh", "sd")))).alias("sound"))
    return E.run_status(haps(v), F.broadcast(catalog), cap=100)


@query("SELECT vec_id, len(embedding) >= 32 AND len(list_filter(embedding[1:32], lambda x: x <> 0)) > 0 AS passes FROM embeddings")
def fil9_clip_gate(v):
    return v("embeddings").select("vec_id", V.clip_gate("embedding", 16, 2).alias("passes"))


@query("""WITH b AS (SELECT family, count(*) AS n, count(*) FILTER (id % 51 = 0) AS excluded FROM <sources_v> GROUP BY family)
SELECT family, n, excluded, CASE WHEN family = 'src0' THEN excluded <= floor(n / 100) AND n - excluded >= 2 ELSE excluded = 0 END AS usable FROM b""")
def fil10_tolerance(v):
    return V.tolerance(v("sources_v").withColumn("failed", F.col("id") % 51 == 0), group="family", failed="failed", tolerant="src0")


@query(r"""SELECT conv_id, turn, tokens + 12 <= 60 AND tokens > 0 AS fits FROM <chat_v>""")
def fil11_length_gate(v):
    return v("chat_v").select("conv_id", "turn", ((F.col("tokens") + 12 <= 60) & (F.col("tokens") > 0)).alias("fits"))


@query(r"""WITH c AS (SELECT conv_id, turn, list_transform(regexp_extract_all(coalesce(text, ''), '\S+'), lambda x: length(x)) AS ids FROM <chat_v>),
p AS (SELECT *, CASE WHEN turn % 5 = 1 THEN list_prepend(0, ids[1:11]) WHEN conv_id % 7 = 0 THEN ids ELSE ids[1:12] END AS prompt FROM c)
SELECT conv_id, turn, CASE WHEN NOT (ids[1 : len(prompt)] = prompt) THEN 'not_prefix' WHEN len(ids) <= len(prompt) THEN 'no_completion' WHEN len(ids) > 60 THEN 'too_long' END AS reason FROM p""")
def fil11_token_prefix(v):
    """Turns as lists of token ids (here lengths of words): some prompts aren't a prefix, some have nothing after them, some rows are too long."""
    ids = F.transform(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"\S+"), F.lit(0)), F.length)
    rows = v("chat_v").select("conv_id", "turn", ids.alias("ids"))
    prompt = F.when(F.col("turn") % 5 == 1, F.array_prepend(F.slice("ids", 1, 11), F.lit(0))).when(F.col("conv_id") % 7 == 0, F.col("ids")).otherwise(F.slice("ids", 1, 12))
    return rows.select("conv_id", "turn", V.fits_length(prompt, F.col("ids"), 60).alias("reason"))


_STATUS = """CASE WHEN retry IS NOT NULL THEN CASE WHEN accepted THEN 'accepted attempt' ELSE 'rejected attempt' END WHEN coalesce(task, '') <> '' THEN 'candidate' WHEN coalesce(teacher, '') <> '' THEN 'accepted'
  WHEN coalesce(stage, '') <> '' THEN upper(stage) || ' input' WHEN coalesce(code, '') <> '' THEN 'source' ELSE 'prompt only' END"""


def _browsed(v):
    c = F.col
    status = V.record_status(**{n: c(n) for n in ("retry", "accepted", "task", "teacher", "stage", "code")})
    return v("records_v").select("id", "model_id", status.alias("status"), F.coalesce("plan_category", "category", F.lit("unknown")).alias("category"), F.coalesce("prompt_style", F.lit("unspecified")).alias("style"), V.maker(c("teacher"), c("model_id")).alias("by"))


@query(f"""SELECT id, {_STATUS} AS status, coalesce(plan_category, category, 'unknown') AS category, CASE WHEN teacher IS NOT NULL THEN split_part(teacher, ':', 1) ELSE regexp_extract(coalesce(model_id, ''), '^(.*)-composer$', 1) END AS provider,
  CASE WHEN teacher IS NOT NULL THEN split_part(teacher, ':', 2) WHEN ends_with(coalesce(model_id, ''), '-composer') THEN '' ELSE coalesce(model_id, '') END AS model FROM <records_v>""")
def fil12_status(v):
    return _browsed(v).select("id", "status", "category", "by.provider", "by.model")


@query(f"""WITH r AS (SELECT {_STATUS} AS status, coalesce(plan_category, category, 'unknown') AS category, coalesce(prompt_style, 'unspecified') AS style FROM <records_v> WHERE contains(lower(coalesce(model_id, '')), 'm1'))
SELECT 'status' AS facet, status AS value, count(*) AS n FROM r WHERE category = 'unknown' AND style = 'mood' GROUP BY ALL UNION ALL SELECT 'category', category, count(*) FROM r WHERE style = 'mood' GROUP BY ALL UNION ALL SELECT 'style', style, count(*) FROM r WHERE category = 'unknown' GROUP BY ALL""")
def fil12_facets(v):
    """What each filter of the browser would still show beside the others, for records that hold "M1"."""
    rows = _browsed(v).select("model_id", "status", "category", "style")
    return V.facet_counts(rows, {"status": None, "category": "unknown", "style": "mood"}, text="M1")


@query("""SELECT job_id, retry, CASE WHEN accepted THEN 'accepted attempt' ELSE 'rejected attempt' END AS status, split_part(model_id, '-', 1) AS provider, coalesce(nullif(split_part(model_id, '-', 2), ''), 'none') AS model
FROM <attempts_v> LEFT JOIN <jobs_v> USING (job_id) WHERE contains(lower(model_id), 'urg')""")
def fil12_browser(v):
    rows = v("attempts_v").join(v("jobs_v"), "job_id", "left").withColumn("candidate", F.lit(False))
    found = V.matches(rows.select("job_id", "retry", "accepted", "model_id", "candidate"), "URG")
    return found.select(
        "job_id", "retry", V.status_of_attempt("accepted", "job_id", "candidate").alias("status"), F.split_part("model_id", F.lit("-"), F.lit(1)).alias("provider"),
        F.coalesce(F.nullif(F.split_part("model_id", F.lit("-"), F.lit(2)), F.lit("")), F.lit("none")).alias("model"),
    )
