"""Queries of :mod:`millrace.operators.scoring`: plan and contract scores of the programs."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import events as E
from millrace.operators import families as M
from millrace.operators import scoring as S
from millrace.operators.tables import settle
from millrace.plans.events_queries import ADHERENCE, CYCLES, HEARD, LOW, PAIRS, PRINTS, SOUND, TELEMETRY, VOICES, _MASKS, haps, registry_tables
from millrace.plans.registry import query
from millrace.plans.text_queries import MASK

#: What each program was asked for, made from its id.
ROLES = "CASE program_id % 3 WHEN 0 THEN {arr}'drums_core', 'bass'{end} WHEN 1 THEN {arr}'chords_pad'{end} ELSE {arr}'arp_lead', 'perc_tops', 'fx_texture'{end} END"
CATEGORY = "CASE program_id % 4 WHEN 0 THEN 'atomic' WHEN 1 THEN 'arrange' ELSE 'stack' END"
ROLES_DUCK, ROLES_SPARK = ROLES.format(arr="[", end="]"), ROLES.format(arr="array(", end=")")


#: A part of a cycle's events stands for the code that a request supplied; for every third program it is all of them.
BEFORE = "program_id % 10 = 3 AND (program_id % 3 = 0 OR begin_at < 8)"
ORIGINAL = "CASE WHEN program_id % 10 = 3 THEN concat(' stack(s(', cast(CASE WHEN program_id % 4 = 1 THEN 0 ELSE program_id END AS string), '))') END"


def facts(v, events=None):
    """One row per program: its run's summaries beside what was asked for. A program without an audible event hasn't run."""
    events, programs = settle(haps(v).drop("value")) if events is None else events, v("programs_v")
    prints = settle(E.fingerprints(events, CYCLES))
    windows = E.evolution(prints, CYCLES).groupBy("program_id").agg(F.array_sort(F.collect_list("variation")).alias("windows"))
    rows = programs.withColumn("parsed", T.completion("completion")["reason"].isNull()).withColumn("thinking", T.completion("completion")["thinking"])
    rows = rows.join(E.telemetry(events, CYCLES), "program_id", "left").join(E.variation(prints, CYCLES), "program_id", "left").join(windows, "program_id", "left")
    rows = rows.join(E.scale_adherence(events, programs), "program_id").join(E.pitch_classes(events), "program_id", "left")
    rows = rows.withColumn("roles", F.expr(ROLES_SPARK)).withColumn("category", F.expr(CATEGORY)).withColumn("classes", F.coalesce("classes", F.array().cast("array<struct<pc: int, n: bigint>>")))
    i = F.col("program_id")
    return rows.withColumns({
        "ran": (i % 13 != 0) & F.col("event_count").isNotNull(), "short_loop": i % 9 == 0, "intent_only": i % 6 == 1, "key_stated": i % 4 == 1,
        "bpm": F.col("cpm") * 4 + F.when(i % 8 == 0, 9.0).otherwise(0.0),
    })


_PRINTS16 = PRINTS.replace("cycle < 12", "cycle < 16")
_WINDOWS = f"""SELECT program_id, list(variation) AS windows FROM (SELECT g.program_id, (coalesce(n, 0) + (coalesce(f, 0) < 8)::int) / 8.0::double AS variation FROM (SELECT program_id, unnest([0, 1]) AS w FROM (SELECT DISTINCT program_id FROM ({_PRINTS16}))) g
  LEFT JOIN (SELECT program_id, cycle // 8 AS w, count(DISTINCT print) AS n, count(*) AS f FROM ({_PRINTS16}) GROUP BY ALL) b USING (program_id, w)) GROUP BY program_id"""
_VARIATION = f"SELECT program_id, (count(DISTINCT print) + (count(*) < 16)::int) / 16.0::double AS structural_variation FROM ({_PRINTS16}) GROUP BY program_id"
_CLASSES = f"SELECT program_id, list({{'pc': pc, 'n': n}}) AS classes FROM (SELECT program_id, (round_even(note, 0)::int % 12 + 12) % 12 AS pc, count(*) AS n FROM {HEARD} WHERE note IS NOT NULL AND NOT bare GROUP BY ALL) GROUP BY program_id"
FACTS = f"""SELECT p.program_id, p.cpm, p.key, p.methods, p.completion, t.* EXCLUDE (program_id), w.windows, x.structural_variation, a.adherence, {ROLES_DUCK.replace('program_id', 'p.program_id')} AS roles, {CATEGORY.replace('program_id', 'p.program_id')} AS category,
  p.program_id % 13 <> 0 AND event_count IS NOT NULL AS ran, p.program_id % 9 = 0 AS short_loop, p.program_id % 6 = 1 AS intent_only, p.program_id % 4 = 1 AS key_stated, coalesce(h.classes, []) AS classes, p.cpm * 4 + CASE WHEN p.program_id % 8 = 0 THEN 9.0 ELSE 0.0 END AS bpm, p.program_id % 7 <> 5 AS parsed
  FROM <programs_v> p LEFT JOIN ({TELEMETRY}) t USING (program_id) LEFT JOIN ({_WINDOWS}) w USING (program_id) LEFT JOIN ({_VARIATION}) x USING (program_id) JOIN ({ADHERENCE}) a USING (program_id) LEFT JOIN ({_CLASSES}) h USING (program_id)"""
_NAMES = "list_transform(sound_sources, lambda s: split_part(s, '_', -1))"
_SOME = lambda *x: f"len(list_intersect({_NAMES}, [" + ", ".join(f"'{n}'" for n in x) + "])) > 0"
_SHOWN = f"""list_filter([CASE WHEN {_SOME('bd', 'sd', 'cp')} THEN 'drums_core' END, CASE WHEN {_SOME('hh', 'oh', 'rim', 'sh', 'rd')} THEN 'perc_tops' END, CASE WHEN len(list_filter(pitches, lambda p: p <= 55)) > 0 THEN 'bass' END,
  CASE WHEN len(list_filter(pitches, lambda p: p BETWEEN 48 AND 84)) > 0 THEN 'chords_pad' END, CASE WHEN len(list_filter(pitches, lambda p: p >= 60)) > 0 THEN 'arp_lead' END, CASE WHEN {_SOME('noise', 'white', 'pink', 'brown')} THEN 'fx_texture' END], lambda r: r IS NOT NULL)"""
_COVER = f"len(list_filter(roles, lambda r: list_contains({_SHOWN}, r))) / len(roles)::double"
_CODE = "CASE WHEN parsed THEN regexp_extract(completion, '(?s)```js\\n(.*)\\n```$', 1) END"
_ORIGINAL = ORIGINAL.replace("array(", "[")
_INSTRUCT = f"""coalesce(list_avg(list_filter([CASE WHEN program_id % 3 <> 1 THEN (abs(cpm * 4 - bpm) < 0.01)::int::double END, CASE WHEN program_id % 10 = 3 THEN coalesce(contains({_CODE}, trim({_ORIGINAL})), false)::int::double END,
  CASE WHEN category = 'arrange' AND NOT intent_only THEN (list_contains(methods, 'arrange') OR list_contains(methods, 'cat'))::int::double END, CASE WHEN program_id % 5 <> 0 THEN list_contains(methods, 'lpf')::int::double END, CASE WHEN program_id % 2 = 0 AND program_id % 5 <> 0 THEN list_contains(methods, 'arrange')::int::double END], lambda x: x IS NOT NULL)), 1.0)"""
_EVOLVE = "list_avg(list_transform(windows, lambda x: greatest(0.0, least(1.0, (x - 0.125) / 0.375))))"


def plan_parts(rows):
    """The plan score's nullable components. A plan of mere intent asks for no roles, and for a key only if one is stated."""
    i, c = F.col("program_id"), F.col
    techniques = F.when(i % 5 == 0, F.array().cast("array<string>")).otherwise(F.array_compact(F.array(F.lit("lpf"), F.when(i % 2 == 0, "arrange"))))
    instructions = S.instructions(
        stated_bpm=i % 3 != 1, cpm=c("cpm"), bpm=c("bpm"), techniques=techniques, methods=c("methods"), original=F.expr(ORIGINAL), code=T.completion("completion")["code"], category=c("category"), intent_only=c("intent_only"),
    )
    return rows.select(
        "*", S.yes((F.col("gain_max") > 0) & (F.col("gain_max") <= 2)).alias("mix_proxy"), instructions.alias("instructions"), 
        F.when(~F.col("intent_only"), S.role_coverage(F.col("roles"), F.col("sound_sources"), F.col("pitches"))).alias("covered"),
        F.when((F.col("category") != "atomic") & ~F.col("short_loop"), S.evolution_score(F.col("windows"))).alias("evolution"),
        F.when(~F.col("intent_only") | F.col("key_stated"), F.col("adherence")).alias("harmony"),
    )


_PLAN = f"""SELECT *, (gain_max > 0 AND gain_max <= 2)::int::double AS mix_proxy, {_INSTRUCT} AS instructions, CASE WHEN NOT intent_only THEN {_COVER} END AS covered,
  CASE WHEN category <> 'atomic' AND NOT short_loop THEN {_EVOLVE} END AS evolution, CASE WHEN NOT intent_only OR key_stated THEN adherence END AS harmony FROM ({FACTS})"""
_MEAN = "list_avg(list_filter([mix_proxy, instructions, covered, evolution, harmony], lambda x: x IS NOT NULL))"


@query("SELECT program_id, CASE WHEN program_id % 7 = 5 THEN 'format' WHEN program_id % 13 = 0 THEN 'execution' ELSE 'passed' END AS gate FROM <programs_v>")
def sco1_gate(v):
    parsed = T.completion("completion")["reason"].isNull()
    return v("programs_v").select("program_id", F.when(~parsed, "format").when(F.col("program_id") % 13 == 0, "execution").otherwise("passed").alias("gate"))


@query(f"SELECT program_id, round(mix_proxy, 6) AS mix_proxy, round(instructions, 6) AS instructions, round(covered, 6) AS covered, round(evolution, 6) AS evolution, round(harmony, 6) AS harmony, round(CASE WHEN parsed AND ran THEN {_MEAN} ELSE 0.0 END, 6) AS total FROM ({_PLAN})")
def sco2_plan_score(v):
    names = ("mix_proxy", "instructions", "covered", "evolution", "harmony")
    total = S.gated(F.col("parsed"), F.col("ran"), S.mean_of(*map(F.col, names)))
    return plan_parts(facts(v)).select("program_id", *(F.round(n, 6).alias(n) for n in names), F.round(total, 6).alias("total"))


@query(f"SELECT program_id, round({_INSTRUCT}, 6) AS instructions FROM ({FACTS})")
def sco3_instructions(v):
    return plan_parts(facts(v)).select("program_id", F.round("instructions", 6).alias("instructions"))


@query(f"SELECT program_id, round(covered, 6) AS covered FROM ({_PLAN})")
def sco4_role_coverage(v):
    return plan_parts(facts(v)).select("program_id", F.round("covered", 6).alias("covered"))


@query(f"""SELECT program_id, list_filter([CASE WHEN instructions < 1 THEN 'instructions' END, CASE WHEN NOT intent_only AND harmony < 0.9 THEN 'harmony' END, CASE WHEN mix_proxy < 1 THEN 'gain' END, CASE WHEN covered < 1 THEN 'roles' END,
  CASE WHEN NOT intent_only AND category <> 'atomic' AND NOT short_loop AND list_max(windows) < 0.25 THEN 'evolution' END], lambda x: x IS NOT NULL) AS reasons FROM ({_PLAN})""")
def sco5_acceptance(v):
    c = F.col
    reasons = F.array_compact(F.array(
        F.when(c("instructions") < 1, "instructions"), F.when(~c("intent_only") & (c("harmony") < 0.9), "harmony"), F.when(c("mix_proxy") < 1, "gain"), F.when(c("covered") < 1, "roles"),
        F.when(~c("intent_only") & (c("category") != "atomic") & ~c("short_loop") & (F.array_max("windows") < 0.25), "evolution"),
    ))
    return plan_parts(facts(v)).select("program_id", reasons.alias("reasons"))


def contract_rows(v):
    """Facts, contract, present families, voice counts, sections and scale fits of each program.

    The events' values are read once; the facts, one row a program, are settled too: what follows reads them instead of the events.
    """
    events = settle(haps(v).drop("value"))
    contracts = v("contracts_v").withColumnRenamed("key", "asked_key")
    base = settle(facts(v, events))
    found = settle(M.sound_families(base.select(F.explode("sound_sources").alias("sound")), *registry_tables(v)))
    present = M.present_families(base.select("program_id", "sound_sources", "pitch_lo"), found, LOW)
    named = contracts.where("require IS NOT NULL").select("program_id", F.col("require").alias("family"), F.lit(0).alias("priority"))
    parts = M.voice_counts(base.select("program_id", "sound_sources"), found, named)
    rows = base.join(contracts, "program_id").join(present, "program_id", "left").join(parts, "program_id", "left")
    heard = lambda t: t.select("program_id", F.to_json(F.struct(*(c for c in t.columns if c != "program_id"))).alias("heard_before"))
    rows = rows.join(heard(E.telemetry(events.where(BEFORE), CYCLES)), "program_id", "left").withColumn("original", F.expr(ORIGINAL))
    heard_now = F.to_json(F.struct("event_count", "events_per_cycle", "sound_sources", "pitches", "pitch_lo", "pitch_hi", "syncopation", "gain_min", "gain_max"))
    return rows.join(E.sections(events, CYCLES), "program_id", "left").withColumn("heard", F.when(F.col("event_count").isNotNull(), heard_now)).withColumn("fit", F.when(F.size("pitches") > 0, E.scale_fit(F.col("pitches"))))


def contract_checks(rows):
    c = F.col
    rows = rows.withColumns({
        "k_require": F.when(c("require").isNotNull(), S.yes(F.array_contains("families", c("require")))),
        "k_forbid": F.when(c("forbid").isNotNull(), S.yes(~F.array_contains("families", c("forbid")))),
        "w_forbid": F.when(c("forbid") == "vocals", S.WEIGHTS["vocals"]).otherwise(S.WEIGHTS["forbid"]),
        "k_voices": F.when(c("voices_min").isNotNull(), S.yes((F.size("sound_sources") >= c("voices_min")) & (c("voices") <= c("voices_max")))),
        "k_tempo": F.when(c("tempo").isNotNull(), S.yes(F.abs(c("cpm") * 4 - c("tempo")) <= 1)),
        "k_key": F.when(c("asked_key").isNotNull(), S.yes(c("adherence") >= 0.9)),
        "k_shape": S.yes(S.takes_shape(c("sections"), c("shape"))), "k_space": S.yes(S.leaves_space(c("events_per_cycle"), c("space"))),
        "k_preserve": S.preserved(c("original"), T.completion("completion")["code"], c("heard"), c("heard_before")),
    })
    stated, keys = T.tempo_claims("thinking"), T.key_claims("thinking")
    guards = S.usual_bands(c("events_per_cycle"), c("gain_max"), c("voices"), c("voices_max"), c("structural_variation"), c("loop"), c("asked_key"), c("pitches"), c("fit"))
    honesty = {"h_tempo": S.honest_tempo(stated, c("cpm") * 4), "h_key": S.honest_key(keys, c("classes"))}
    return rows.withColumns(honesty | {f"g_{n}": g for n, g in guards.items()})


_SECTIONS = f"""SELECT program_id, [{", ".join("{" + f"'onsets': count(*) FILTER (part = {k}), 'sounds': coalesce(list(DISTINCT snd) FILTER (part = {k} AND snd IS NOT NULL), [])" + "}" for k in range(4))}] AS sections
  FROM (SELECT program_id, least(3, floor(begin_at * 4 / 16))::int AS part, {SOUND} AS snd FROM {HEARD} WHERE begin_at >= 0 AND begin_at < 16) GROUP BY program_id"""
_FIT = f"SELECT program_id, list_max(list_transform([{_MASKS}], lambda m: len(list_filter(pitches, lambda p: (m >> (p::int % 12)) & 1 = 1)) / len(pitches)::double)) AS fit FROM ({TELEMETRY}) WHERE len(pitches) > 0"
_PRESENT = f"""SELECT program_id, coalesce(list_sort(list(DISTINCT family) FILTER (family IS NOT NULL)), []) AS families FROM ({TELEMETRY}) LEFT JOIN (SELECT program_id, family FROM (SELECT program_id, unnest(sound_sources) AS sound FROM ({TELEMETRY})) JOIN ({PAIRS}) USING (sound) UNION SELECT program_id, 'bass' AS family FROM ({TELEMETRY}) WHERE pitch_lo <= 48) USING (program_id) GROUP BY program_id"""
_BEFORE = TELEMETRY.replace("<haps_v>", f"(SELECT * FROM <haps_v> WHERE {BEFORE})")
_ROWS = f"""SELECT f.*, c.require, c.forbid, c.voices_min, c.voices_max, c.tempo, c.key AS asked_key, c.shape, c.space, c.loop, r.families, o.voices, s.sections, t.fit, y.before, z.now, {ORIGINAL.replace('program_id', 'f.program_id')} AS original FROM ({FACTS}) f JOIN <contracts_v> c USING (program_id) LEFT JOIN ({_PRESENT}) r USING (program_id) LEFT JOIN ({VOICES}) o USING (program_id) LEFT JOIN ({_SECTIONS}) s USING (program_id) LEFT JOIN ({_FIT}) t USING (program_id)
  LEFT JOIN (SELECT program_id, b AS before FROM (SELECT b.program_id, b FROM ({_BEFORE}) b)) y USING (program_id) LEFT JOIN (SELECT program_id, n AS now FROM (SELECT n.program_id, n FROM ({TELEMETRY}) n)) z USING (program_id)"""
_IJ = "[[1,2],[1,3],[1,4],[2,3],[2,4],[3,4]]"
_GREW = "(sections[{b}].onsets >= 1.5 * greatest(1, sections[{a}].onsets) OR len(sections[{b}].sounds) > len(sections[{a}].sounds))"
_DIFF = "(len(list_distinct(list_concat(sections[{a}].sounds, sections[{b}].sounds))) > 0 AND len(list_intersect(sections[{a}].sounds, sections[{b}].sounds)) <= 0.5 * len(list_distinct(list_concat(sections[{a}].sounds, sections[{b}].sounds))))"
_any = lambda test: f"len(list_filter({_IJ}, lambda p: {test})) > 0"
_BUILD, _THIN, _VARY = _any(_GREW.format(a="p[1]", b="p[2]")), _any(_GREW.format(a="p[2]", b="p[1]")), _any(_DIFF.format(a="p[1]", b="p[2]"))
_SHAPED = f"CASE shape WHEN 'build' THEN ({_BUILD})::int::double WHEN 'thin_out' THEN ({_THIN})::int::double WHEN 'contrast' THEN ({_BUILD} OR {_THIN} OR {_VARY})::int::double END"
_bpm = "list_transform(regexp_extract_all(think, '(?i)\\b(\\d{2,3}(?:\\.\\d+)?)\\s*bpm\\b', 1), lambda x: cast(x AS double))"
_keys = f"list_transform(regexp_extract_all(think, '\\b([A-G][#b]?[ :](?:{T.MODE}))\\b', 1), lambda x: replace(x, ' ', ':'))"
_IN_KEY = MASK.replace("(key,", "(k,")
_SHARE = f"coalesce(list_sum(list_transform(classes, lambda c: CASE WHEN ({_IN_KEY} >> c.pc::int) & 1 = 1 THEN c.n ELSE 0 END)) / list_sum(list_transform(classes, lambda c: c.n))::double, 0.0)"
CHECKS = f"""SELECT *, CASE WHEN require IS NOT NULL THEN list_contains(families, require)::int::double END AS k_require, CASE WHEN forbid IS NOT NULL THEN (NOT list_contains(families, forbid))::int::double END AS k_forbid, CASE WHEN forbid = 'vocals' THEN 0.5 ELSE 2.0 END AS w_forbid,
  CASE WHEN voices_min IS NOT NULL THEN (len(sound_sources) >= voices_min AND voices <= voices_max)::int::double END AS k_voices, CASE WHEN tempo IS NOT NULL THEN (abs(cpm * 4 - tempo) <= 1)::int::double END AS k_tempo, CASE WHEN asked_key IS NOT NULL THEN (adherence >= 0.9)::int::double END AS k_key,
  {_SHAPED} AS k_shape, CASE space WHEN 'sparse' THEN (events_per_cycle <= 8)::int::double WHEN 'busy' THEN (events_per_cycle >= 12)::int::double END AS k_space, CASE WHEN original IS NOT NULL THEN (coalesce(contains({_CODE}, trim(original)), false) AND before IS DISTINCT FROM now)::int::double END AS k_preserve,
  CASE WHEN len({_bpm}) > 0 THEN (len(list_filter({_bpm}, lambda b: abs(b - cpm * 4) <= 1)) > 0)::int::double END AS h_tempo, CASE WHEN len({_keys}) > 0 THEN (len(list_filter({_keys}, lambda k: {_SHARE} >= 0.8)) > 0)::int::double END AS h_key,
  (events_per_cycle BETWEEN 0.5 AND 64)::int::double AS g_density, (gain_max > 0 AND gain_max <= 1)::int::double AS g_gain, (voices <= greatest(10, coalesce(voices_max, 0)))::int::double AS g_not_stuffed, CASE WHEN NOT loop THEN (structural_variation >= 0.125)::int::double END AS g_variation,
  CASE WHEN asked_key IS NULL AND len(pitches) >= 4 THEN (fit >= 0.6)::int::double END AS g_pitch FROM (SELECT *, CASE WHEN parsed THEN completion ELSE NULL END AS think FROM ({_ROWS}))"""
K = ("require", "forbid", "voices", "tempo", "key", "shape", "space", "preserve")
G = ("density", "gain", "not_stuffed", "variation", "pitch")
_W = {"require": "1.0", "forbid": "w_forbid", "voices": "1.0", "tempo": "1.0", "key": "1.0", "shape": "0.5", "space": "0.5", "preserve": "2.0"}
_WSUM = " + ".join(f"CASE WHEN k_{k} IS NOT NULL THEN {w} ELSE 0.0 END" for k, w in _W.items())
_VSUM = " + ".join(f"coalesce(k_{k} * {w}, 0.0)" for k, w in _W.items())
_CONTRACT = f"(CASE WHEN {_WSUM} > 0 THEN ({_VSUM}) / ({_WSUM}) ELSE 1.0 END)"
_HONEST = "coalesce(list_avg(list_filter([h_tempo, h_key], lambda x: x IS NOT NULL)), 1.0)"
_FAILED = " + ".join(f"coalesce((g_{g} < 1)::int, 0)" for g in G)
_TOTAL = f"CASE WHEN parsed AND ran THEN pow(0.5, {_FAILED}) * (0.8 * {_CONTRACT} + 0.2 * {_HONEST}) ELSE 0.0 END"


def contract_totals(rows):
    c = F.col
    weights = {"require": F.lit(1.0), "forbid": c("w_forbid"), "voices": F.lit(1.0), "tempo": F.lit(1.0), "key": F.lit(1.0), "shape": F.lit(0.5), "space": F.lit(0.5), "preserve": F.lit(2.0)}
    contract = S.weighted(*((w, c(f"k_{k}")) for k, w in weights.items()))
    honesty = S.mean_of(c("h_tempo"), c("h_key"))
    total = S.gated(c("parsed"), c("ran"), S.contract_total(contract, honesty, [c(f"g_{g}") for g in G]))
    return rows.withColumns({"contract": contract, "honesty": honesty, "total": total})


@query(f"SELECT program_id, round({_CONTRACT}, 6) AS contract, round({_HONEST}, 6) AS honesty, round({_TOTAL}, 6) AS total FROM ({CHECKS})")
def sco6_contract_score(v):
    rows = contract_totals(contract_checks(contract_rows(v)))
    return rows.select("program_id", *(F.round(x, 6).alias(x) for x in ("contract", "honesty", "total")))


@query(f"SELECT program_id, {', '.join(f'k_{k}' for k in K)}, h_tempo, h_key FROM ({CHECKS})")
def sco7_contract_checks(v):
    return contract_checks(contract_rows(v)).select("program_id", *(f"k_{k}" for k in K), "h_tempo", "h_key")


@query(f"SELECT program_id, ({_BUILD}) AS builds, ({_THIN}) AS thins, ({_BUILD} OR {_THIN} OR {_VARY}) AS contrasts FROM ({_SECTIONS})")
def joi11_sco8_sections(v):
    got = E.sections(haps(v, every=False), CYCLES)
    shape = lambda s: S.takes_shape(F.col("sections"), F.lit(s))
    return got.select("program_id", shape("build").alias("builds"), shape("thin_out").alias("thins"), shape("contrast").alias("contrasts"))


@query(f"SELECT program_id, {', '.join(f'g_{g}' for g in G)} FROM ({CHECKS})")
def sco9_craft_guards(v):
    return contract_checks(contract_rows(v)).select("program_id", *(f"g_{g}" for g in G))


@query(f"""WITH c AS (SELECT program_id, {_TOTAL} AS total, parsed AND ran AS valid FROM ({CHECKS})), p AS (SELECT program_id, CASE WHEN parsed AND ran THEN {_MEAN} ELSE 0.0 END AS plan_total, category FROM ({_PLAN}))
SELECT category, count(*) AS tasks, count(*) FILTER (valid) AS ran, round(avg(CASE WHEN program_id % 2 = 0 THEN total ELSE plan_total END), 6) AS mean_reward FROM c JOIN p USING (program_id) GROUP BY category""")
def sco10_evaluate(v):
    """Programs with an even id have a contract and get its score, the others that of their plan."""
    rows = plan_parts(contract_totals(contract_checks(contract_rows(v))))  # both scores of the same facts
    rows = rows.withColumn("plan_total", S.gated(F.col("parsed"), F.col("ran"), S.mean_of(*map(F.col, ("mix_proxy", "instructions", "covered", "evolution", "harmony")))))
    reward = F.when(F.col("program_id") % 2 == 0, F.col("total")).otherwise(F.col("plan_total"))
    return rows.groupBy("category").agg(F.count(F.lit(1)).alias("tasks"), F.count_if(F.col("parsed") & F.col("ran")).alias("ran"), F.round(F.avg(reward), 6).alias("mean_reward"))
