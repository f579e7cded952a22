"""Queries of :mod:`millrace.functions.text`, and of splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import splits as S
from millrace.plans.registry import query

FOLD = "replace(lower({0}), 'ß', 'ss')"
PRINT = "trim(regexp_replace(" + FOLD + r", '\s+', ' ', 'g'))"
KEY = "array_to_string(regexp_extract_all(" + FOLD + ", '[a-z0-9'']+'), ' ')"
BUCKET = "cast('0x' || substr(sha256('\"' || {0} || '\"'), 1, 8) AS bigint) % 100"
SPLIT = "CASE WHEN " + BUCKET + " < 80 THEN 'train' WHEN " + BUCKET + " < 90 THEN 'val' ELSE 'benchmark' END"
MODE = T.MODE


@query(f"SELECT id, {PRINT.format('prompt')} AS print FROM <requests_v>")
def ded1_fingerprint(v):
    return v("requests_v").select("id", T.fingerprint("prompt").alias("print"))


@query(f"SELECT id, {KEY.format('prompt')} AS word_key FROM <requests_v>")
def ded2_word_key(v):
    return v("requests_v").select("id", T.word_key("prompt").alias("word_key"))


@query(f"""
WITH d AS (SELECT doc_id, source, {SPLIT.format('source')} AS split, min(doc_id) OVER (PARTITION BY {PRINT.format('text')}) = doc_id AS first FROM documents)
SELECT split, count(*) AS n_rows, count(*) FILTER (first) AS n_kept, count(*) FILTER (NOT first) AS n_duplicates, count(DISTINCT source) AS n_families FROM d GROUP BY split""")
def ded5_split_counts(v):
    """Documents, distinct documents and families of each split."""
    rows = v("documents").select("doc_id", "source", F.xxhash64(T.fingerprint("text")).alias("h"))
    first = rows.groupBy("h").agg(F.min("doc_id").alias("doc_id"), F.lit(True).alias("kept"))
    marked = rows.join(first, ["h", "doc_id"], "left").withColumn("split", S.hash_split("source"))
    return marked.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("kept").alias("n_kept"), F.count_if(F.col("kept").isNull()).alias("n_duplicates"), F.count_distinct("source").alias("n_families")
    )


@query(f"""SELECT id, coalesce(CASE WHEN id % 97 = 0 THEN 'val' END, CASE WHEN family = 'src3' THEN 'train' END, {SPLIT.format('family')}) AS split FROM <requests_v>""")
def ded6_assign_split(v):
    rows = v("requests_v").select("id", "family", F.when(F.col("id") % 97 == 0, "val").alias("split"))
    recorded = v("requests_v").where("family = 'src3'").select("family", F.lit("train").alias("recorded_split")).distinct()
    return S.assign_split(rows, recorded).select("id", "split")


@query(f"""WITH r AS (SELECT family, coalesce(CASE WHEN id % 97 = 0 THEN 'val' END, {SPLIT.format('family')}) AS split FROM <requests_v>)
SELECT family, count(DISTINCT split) AS n_splits, min(split) AS first_split FROM r GROUP BY family HAVING count(DISTINCT split) > 1""")
def ded6_split_conflicts(v):
    rows = v("requests_v").select("family", F.coalesce(F.when(F.col("id") % 97 == 0, "val"), S.hash_split("family")).alias("split"))
    return S.split_conflicts(rows)


@query("SELECT s.id, s.family FROM <sources_v> s WHERE s.family NOT IN (SELECT family FROM <requests_v> WHERE split <> 'train')")
def ded7_train_only(v):
    held = v("requests_v").where("split <> 'train'").select("family").distinct()
    return v("sources_v").select("id", "family").join(held, "family", "left_anti")


@query(f"""SELECT id FROM <requests_v> WHERE split <> 'train' AND {PRINT.format('prompt')} IN (SELECT {PRINT.format('prompt')} FROM <requests_v> WHERE split = 'train')""")
def joi7_leaked_prompts(v):
    rows = v("requests_v")
    return S.leaked_prompts(rows.where("split = 'train'"), rows.where("split <> 'train'")).select("id")


@query("SELECT DISTINCT family FROM <requests_v> WHERE id % 7 = 0 AND family IN (SELECT family FROM <requests_v> WHERE id % 7 <> 0)")
def joi7_leaked_families(v):
    rows = v("requests_v")
    return S.leaked_families(rows.where("id % 7 <> 0"), rows.where("id % 7 = 0"))


#: An answer before and after the line that opens its code.
_HALVES = r"string_split_regex({0}, '</think>\s*```(js|javascript|strudel)\s*?\n')"
_BLANK = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"
WHOLE = f"coalesce(len({_HALVES}) = 2 AND starts_with(ltrim({_HALVES}[1], {_BLANK}), '<think>') AND ends_with(rtrim({_HALVES}[2], {_BLANK}), chr(10) || '```'), false)"
THINKING = f"trim(substr(ltrim({_HALVES}[1], {_BLANK}), 8), {_BLANK})"
CODE = f"trim(substr(rtrim({_HALVES}[2], {_BLANK}), 1, greatest(0, length(rtrim({_HALVES}[2], {_BLANK})) - 4)), {_BLANK})"


@query(f"""WITH p AS (SELECT program_id, {THINKING.format('completion')} AS thinking, {CODE.format('completion')} AS code, {WHOLE.format('completion')} AS whole FROM <programs_v>)
SELECT program_id, CASE WHEN whole AND thinking <> '' AND code <> '' THEN thinking END AS thinking, CASE WHEN whole AND thinking <> '' AND code <> '' THEN code END AS code,
  CASE WHEN NOT whole THEN 'shape' WHEN thinking = '' OR code = '' THEN 'empty' END AS reason FROM p""")
def par1_parse_completion(v):
    return v("programs_v").select("program_id", T.completion("completion").alias("c")).select("program_id", "c.*")


@query("""SELECT id, '[{"role":"user","content":' || to_json(prompt || CASE WHEN id % 3 = 0 THEN chr(10) || chr(10) || '```js' || chr(10) || family || chr(10) || '```' ELSE '' END) || '},{"role":"assistant","content":' || to_json('<think>' || family) || '}]' AS messages FROM <requests_v>""")
def par2_messages(v):
    return v("requests_v").select("id", T.messages("prompt", F.when(F.col("id") % 3 == 0, F.col("family")), "family").alias("messages"))


@query("""SELECT id, '# ' || family AS header, CASE WHEN regexp_matches(code, '\\bsetcpm\\s*\\(') THEN trim(code) ELSE 'setcpm(30)' || chr(10) || trim(code) END AS code,
  'collected-' || substr(sha256(trim(code)), 1, 24) AS new_id, coalesce(nullif(trim(family), ''), 'unknown') AS description FROM <sources_v>""")
def par5_normalise_source(v):
    """Trimmed code with a tempo call in front where it has none, an id from its hash, a description."""
    body = F.trim("code")
    return v("sources_v").select(
        "id", F.concat(F.lit("# "), "family").alias("header"), F.when(F.regexp_like("code", F.lit(r"\bsetcpm\s*\(")), body).otherwise(F.concat(F.lit("setcpm(30)\n"), body)).alias("code"),
        F.concat(F.lit("collected-"), F.substring(F.sha2(body, 256), 1, 24)).alias("new_id"), F.coalesce(F.nullif(F.trim("family"), F.lit("")), F.lit("unknown")).alias("description"),
    )


#: A request in words made from its id, for operators that look for cues.
_SAID = {
    "duck": """concat(CASE id % 4 WHEN 0 THEN 'A slow drone and pads, ' WHEN 1 THEN 'only a bassline, ' WHEN 2 THEN 'drums and a lead with an intro, ' ELSE 'Use lpf and jux( on the kicks, ' END,
      CASE id % 3 WHEN 0 THEN cast(60 + id % 90 AS string) || ' BPM, ' ELSE '' END, CASE id % 5 WHEN 0 THEN 'f# Dorian ' WHEN 1 THEN 'in C:minor ' ELSE '' END, CASE id % 6 WHEN 0 THEN 'as a short loop' ELSE '' END)""",
}
_SAID_SPARK = _SAID["duck"]
_HAS = lambda p: f"regexp_matches(lower(said), '{p}')"
_TOKENS = r"regexp_split_to_array(lower(said), '\s+')"
_WANTED = rf"list_concat(regexp_extract_all(lower(said), '(\w+)\s*\(', 1), list_transform(list_filter(range(1, len({_TOKENS})), lambda i: regexp_extract({_TOKENS}[i], '\w+$') IN ('use', 'using', 'apply')), lambda i: regexp_extract({_TOKENS}[i + 1], '^\w+')))"
_ROLE = {r: _HAS(r"\b(?:" + "|".join(w) + r")s?\b") for r, w in T.ROLE_WORDS.items()}


@query(f"""WITH q AS (SELECT id, {_SAID['duck']} AS said FROM <requests_v>),
a AS (SELECT id, said, regexp_extract(lower(said), '\\b(\\d+(?:\\.\\d+)?)\\s*bpm\\b', 1) AS b, regexp_extract(said, '(?i)\\b([a-gA-G][#b]?)[ :]+({MODE})\\b', 1) AS root, lower(regexp_extract(said, '(?i)\\b([a-gA-G][#b]?)[ :]+({MODE})\\b', 2)) AS mode,
  list_filter([{", ".join(f"CASE WHEN {hit} THEN '{r}' END" for r, hit in _ROLE.items())}], lambda x: x IS NOT NULL) AS found, {_HAS("only|single voice|atomic|bassline alone")} AS atomic, {_HAS("intro|breakdown|section|arrangement")} AS arrange, {_HAS("one bar|one-bar|static|short loop")} AS short_loop,
  list_filter([{", ".join(f"CASE WHEN list_contains({_WANTED}, '{t}') THEN '{t}' END" for t in T.TECHNIQUES)}], lambda x: x IS NOT NULL) AS techniques FROM q),
b AS (SELECT *, CASE WHEN len(found) > 0 THEN found ELSE ['drums_core', 'bass', 'chords_pad'] END AS every FROM a), c AS (SELECT *, CASE WHEN atomic THEN every[1:1] ELSE every END AS roles FROM b)
SELECT id, CASE WHEN b = '' THEN 120.0 ELSE cast(b AS double) END AS bpm, CASE WHEN mode <> '' THEN upper(root[1]) || root[2:] || ':' || mode WHEN list_has_any(roles, ['bass', 'chords_pad', 'arp_lead']) THEN 'C:minor' END AS key,
  CASE WHEN arrange THEN 'arrange' WHEN atomic THEN 'atomic' ELSE 'stack' END AS category, roles, list_filter([CASE WHEN b <> '' THEN 'bpm' END, CASE WHEN mode <> '' THEN 'key' END, CASE WHEN len(found) > 0 THEN 'roles' END], lambda x: x IS NOT NULL) AS explicit,
  techniques, short_loop, CASE WHEN arrange THEN 32 ELSE 16 END AS cycles, true AS intent_only FROM c""".replace("\\\\", "\\"))
def par6_make_plan(v):
    return v("requests_v").select("id", T.plan(F.expr(_SAID_SPARK)).alias("p")).select("id", "p.*")


@query(f"""WITH q AS (SELECT id, {_SAID['duck']} AS said FROM <requests_v>), a AS (SELECT id, regexp_extract(lower(said), '\\b(\\d+)\\s*bpm\\b', 1) AS b, regexp_extract(said, '(?i)\\b([a-gA-G][#b]?)[ :]+({MODE})\\b', 1) AS root, lower(regexp_extract(said, '(?i)\\b([a-gA-G][#b]?)[ :]+({MODE})\\b', 2)) AS mode,
  list_filter([{", ".join(f"CASE WHEN list_contains({_WANTED}, '{t}') THEN '{t}' END" for t in T.TECHNIQUES)}], lambda x: x IS NOT NULL) AS named FROM q)
SELECT id, CASE WHEN b <> '' THEN cast(b AS double) ELSE 100.0 END AS bpm, CASE WHEN mode <> '' THEN upper(root[1]) || root[2:] || ':' || mode WHEN id % 2 = 0 THEN 'G:major' END AS key, CASE WHEN id % 9 = 0 THEN 'cocreate' ELSE 'stack' END AS category,
  list_concat(['slow'], list_filter(named, lambda t: t <> 'slow')) AS techniques FROM a""".replace("\\\\", "\\"))
def par7_overlay_plan(v):
    chosen = {"bpm": F.lit(100.0), "key": F.when(F.col("id") % 2 == 0, "G:major"), "category": F.lit("stack"), "techniques": F.array(F.lit("slow"))}
    return v("requests_v").select("id", T.overlay(chosen, F.expr(_SAID_SPARK), supplied=F.col("id") % 9 == 0).alias("p")).select("id", "p.*")


_NOTE = "concat(substr('CDEFGABcdefgab', cast(event_id % 14 + 1 AS int), 1), CASE event_id % 3 WHEN 0 THEN '#' WHEN 1 THEN 'b' ELSE '' END, CASE WHEN event_id % 13 = 0 THEN 'x' ELSE cast(event_id % 9 - 1 AS string) END)"


@query(f"""WITH n AS (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN cast(event_id % 100 AS string) ELSE {_NOTE} END AS note FROM events)
SELECT event_id, note, coalesce(try_cast(note AS double), cast((try_cast(regexp_extract(note, '^([a-gA-G])([#b]?)(-?\\d+)$', 3) AS int) + 1) * 12 + CASE lower(regexp_extract(note, '^([a-gA-G])([#b]?)(-?\\d+)$', 1)) WHEN 'c' THEN 0 WHEN 'd' THEN 2 WHEN 'e' THEN 4 WHEN 'f' THEN 5 WHEN 'g' THEN 7 WHEN 'a' THEN 9 WHEN 'b' THEN 11 END
  + CASE regexp_extract(note, '^([a-gA-G])([#b]?)(-?\\d+)$', 2) WHEN '#' THEN 1 WHEN 'b' THEN -1 ELSE 0 END AS double)) AS pitch FROM n""".replace("\\\\", "\\"))
def par8_midi_pitch(v):
    note = F.expr(f"CASE WHEN event_id % 10 = 0 THEN cast(event_id % 100 AS string) ELSE {_NOTE} END")
    return v("events").select("event_id", note.alias("note")).withColumn("pitch", T.midi_pitch("note"))


_STEPS = " ".join(f"WHEN '{m}' THEN {sum(1 << s for s in steps)}" for m, steps in T.MODES.items())
_ROOT = "(CASE substr(key, 1, 1) WHEN 'C' THEN 0 WHEN 'D' THEN 2 WHEN 'E' THEN 4 WHEN 'F' THEN 5 WHEN 'G' THEN 7 WHEN 'A' THEN 9 WHEN 'B' THEN 11 END + CASE substr(key, 2, 1) WHEN '#' THEN 1 WHEN 'b' THEN -1 ELSE 0 END + 12) % 12"
MASK = f"(((CASE split_part(key, ':', 2) {_STEPS} END << {_ROOT}) | ((CASE split_part(key, ':', 2) {_STEPS} END << {_ROOT}) >> 12)) & 4095)"


@query(f"SELECT program_id, key, CASE WHEN key IS NOT NULL THEN {MASK} END AS mask FROM <programs_v>")
def par9_scale_mask(v):
    return v("programs_v").select("program_id", "key", T.scale_mask("key").alias("mask"))


_ROUGH = """CASE WHEN len(list_intersect(names, ['bd', 'sd', 'cp'])) > 0 AND hi IS NULL THEN 'drums_core' WHEN len(list_intersect(names, ['hh', 'oh', 'sh', 'rim', 'rd', 'cr'])) > 0 AND hi IS NULL THEN 'perc_tops'
  WHEN hi <= 55 THEN 'bass' WHEN hi IS NOT NULL AND rate >= 8 THEN 'arp_lead' WHEN hi IS NOT NULL THEN 'chords_pad' ELSE 'fx_texture' END"""


@query(f"""WITH p AS (SELECT program_id, event_id % 3 AS part, list(DISTINCT split_part(s, '_', -1)) AS names, max(note) AS hi, count(*) / 16.0 AS rate FROM <haps_v> WHERE onset AND gain > 0 GROUP BY ALL), r AS (SELECT *, {_ROUGH} AS role FROM p)
SELECT program_id, part, role, CASE role WHEN 'drums_core' THEN 0.95 WHEN 'perc_tops' THEN 0.9 WHEN 'bass' THEN 0.8 WHEN 'arp_lead' THEN 0.65 WHEN 'chords_pad' THEN 0.55 ELSE 0.5 END::double AS confidence FROM r""")
def par10_infer_role(v):
    from millrace.operators.events import infer_role

    parts = v("haps_v").where("onset AND gain > 0").groupBy("program_id", (F.col("event_id") % 3).alias("part"))
    got = parts.agg(F.collect_set("s").alias("sounds"), F.max("note").alias("highest"), (F.count(F.lit(1)) / 16).alias("rate"))
    return got.select("program_id", "part", infer_role("sounds", "highest", "rate").alias("r")).select("program_id", "part", "r.*")


@query(f"""SELECT program_id, list_transform(regexp_extract_all(completion, '(?i)\\b(\\d{{2,3}}(?:\\.\\d+)?)\\s*bpm\\b', 1), lambda x: cast(x AS double)) AS tempos,
  list_sort(list_distinct(list_transform(regexp_extract_all(completion, '\\b([A-G][#b]?[ :](?:{MODE}))\\b', 1), lambda x: replace(x, ' ', ':')))) AS keys FROM <programs_v>""")
def par11_claims(v):
    return v("programs_v").select("program_id", T.tempo_claims("completion").alias("tempos"), T.key_claims("completion").alias("keys"))


@query("SELECT event_id, 0.2 * least(1.0, greatest(0.0, (event_id % 4000 - (3000 - 256)) / 256.0)) AS penalty FROM events")
def par12_overlong_penalty(v):
    return v("events").select("event_id", T.overlong_penalty((F.col("event_id") % 4000), 3000).alias("penalty"))
