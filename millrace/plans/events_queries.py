"""Queries of :mod:`millrace.operators.events` and :mod:`millrace.operators.families`."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.text import all_scale_masks
from millrace.operators import events as E
from millrace.operators import families as M
from millrace.operators.tables import settle
from millrace.plans.registry import query
from millrace.plans.text_queries import MASK

CYCLES = 16


def haps(v, every=True):
    """The events as they are stored, a JSON value each, with what it says."""
    return E.with_controls(v("haps_v").select("event_id", "program_id", "begin_at", "end_at", "onset", "value"), every=every)


SOUND = "CASE WHEN bank IS NOT NULL AND s IS NOT NULL THEN bank || '_' || s ELSE s END"
HEARD = "(SELECT * FROM <haps_v> WHERE onset AND coalesce(gain, 1.0) > 0)"
TELEMETRY = f"""SELECT program_id, count(*) AS event_count, count(*) / 16.0::double AS events_per_cycle, coalesce(list_sort(list(DISTINCT {SOUND}) FILTER ({SOUND} IS NOT NULL)), []) AS sound_sources, coalesce(list_sort(list(DISTINCT note) FILTER (note IS NOT NULL)), []) AS pitches,
  min(note) AS pitch_lo, max(note) AS pitch_hi, count(*) FILTER (abs(begin_at * 4 - round_even(begin_at * 4, 0)) > 1e-6) / count(*)::double AS syncopation, min(coalesce(gain, 1.0)) AS gain_min, max(coalesce(gain, 1.0)) AS gain_max FROM {HEARD} GROUP BY program_id"""
_TIMES = "printf('%.6f', round(begin_at - cycle, 6)), printf('%.6f', round(end_at - begin_at, 6))"
_SAID = {"bank": "'\"' || bank || '\"'", "gain": "printf('%.4f', round(gain, 4))", "n": "n::VARCHAR", "note": "CASE WHEN note IS NOT NULL THEN note_text END", "s": f"'\"' || ({SOUND}) || '\"'"}
_entries = lambda names: f"concat_ws(',', {_TIMES}, coalesce(nullif(concat_ws(',', " + ", ".join(f"'{n}=' || {_SAID[n]}" for n in names) + "), ''), ''))"
_CORE, _BOTH = _entries(E.STRUCTURAL), _entries(sorted(_SAID))
PRINTS = f"""SELECT program_id, cycle, sha256(string_agg(core, '|' ORDER BY core)) AS print, sha256(string_agg(wide, '|' ORDER BY wide)) AS controls
  FROM (SELECT *, {_CORE} AS core, {_BOTH} AS wide FROM (SELECT *, cast(floor(begin_at) AS int) AS cycle FROM {HEARD}) AS timed WHERE cycle >= 0 AND cycle < 12) GROUP BY program_id, cycle"""


@query(TELEMETRY)
def agg1_telemetry(v):
    return E.telemetry(haps(v, every=False), CYCLES)


@query(PRINTS)
def agg2_fingerprints(v):
    return E.fingerprints(haps(v), 12)


@query(f"""WITH p AS ({PRINTS}) SELECT program_id, (count(DISTINCT print) + (count(*) < 12)::int) / 12.0::double AS structural_variation, (count(DISTINCT controls) + (count(*) < 12)::int) / 12.0::double AS control_variation, count(*) AS active_cycles FROM p GROUP BY program_id""")
def agg2_variation(v):
    return E.variation(E.fingerprints(haps(v), 12), 12)


@query(f"""WITH p AS ({PRINTS}), b AS (SELECT program_id, cycle // 8 AS w, count(DISTINCT print) AS n, count(*) AS f FROM p GROUP BY ALL), g AS (SELECT program_id, unnest([0, 1]) AS w, unnest([8, 4]) AS len FROM (SELECT DISTINCT program_id FROM p))
SELECT program_id, w AS window, (coalesce(n, 0) + (coalesce(f, 0) < len)::int) / len::double AS variation FROM g LEFT JOIN b USING (program_id, w)""")
def agg3_evolution(v):
    return E.evolution(E.fingerprints(haps(v), 12), 12)


@query(f"""WITH p AS (SELECT program_id, least(3, floor(begin_at * 4 / 16))::int AS part, {SOUND} AS snd FROM {HEARD} WHERE begin_at >= 0 AND begin_at < 16)
SELECT program_id, {", ".join(f"count(*) FILTER (part = {k}) AS onsets{k}, coalesce(list_sort(list(DISTINCT snd) FILTER (part = {k} AND snd IS NOT NULL)), []) AS sounds{k}" for k in range(4))} FROM p GROUP BY program_id""")
def agg4_sections(v):
    got = E.sections(haps(v, every=False), CYCLES)
    flat = [F.col("sections")[k][f].alias(f"{f}{k}") for k in range(4) for f in ("onsets", "sounds")]
    return got.select("program_id", *flat)


ADHERENCE = f"""SELECT p.program_id, CASE WHEN any_value(key) IS NOT NULL THEN coalesce(avg(CASE WHEN note IS NULL OR bare THEN NULL WHEN ({MASK} >> (round_even(note, 0)::int % 12)) & 1 = 1 THEN 1.0 ELSE 0.0 END), 0.0) END AS adherence
  FROM <programs_v> p LEFT JOIN {HEARD} h ON p.program_id = h.program_id GROUP BY p.program_id"""


@query(ADHERENCE)
def agg5_scale_adherence(v):
    return E.scale_adherence(haps(v, every=False), v("programs_v"))


_MASKS = ", ".join(map(str, all_scale_masks()))


@query(f"""WITH t AS (SELECT program_id, list_sort(list(DISTINCT note) FILTER (note IS NOT NULL)) AS pitches FROM {HEARD} GROUP BY program_id)
SELECT program_id, list_max(list_transform([{_MASKS}], lambda m: len(list_filter(pitches, lambda p: (m >> (p::int % 12)) & 1 = 1)) / len(pitches)::double)) AS fit FROM t WHERE len(pitches) > 0""")
def joi13_scale_fit(v):
    return E.telemetry(haps(v, every=False), CYCLES).where(F.size("pitches") > 0).select("program_id", E.scale_fit(F.col("pitches")).alias("fit"))


@query(f"""SELECT program_id, CASE WHEN bank IS NOT NULL THEN bank || ' drums' ELSE s END AS instrument, count(*) AS n, min(begin_at) AS first, round(sum(greatest(0.0, least(end_at - begin_at, 16 - begin_at))), 6) AS sounding FROM <haps_v> GROUP BY ALL""")
def agg21_instruments(v):
    return E.instruments(haps(v, every=False), CYCLES)


#: A small registry: family, its sounds, its drum pieces (fixed values of the fixtures).
FAMILIES = {
    "drums": ((), ("bd", "sd", "hh", "oh", "cp", "rim")), "kick": ((), ("bd",)), "snare": ((), ("sd", "rim")), "hi_hat": ((), ("hh", "oh")),
    "strings": (("gm_cello", "gm_violin"), ()), "bass": (("gm_acoustic_bass",), ()), "vocals": (("gm_choir_aahs",), ()), "synth": (("sawtooth", "square"), ()),
}
LOW = ["bass"]
_SOUND_ROWS = [(f, s) for f, (sounds, _) in FAMILIES.items() for s in sounds]
_KIT_ROWS = [(f, s) for f, (_, kit) in FAMILIES.items() for s in kit]
_values = lambda rows: ", ".join(f"('{a}', '{b}')" for a, b in rows)
PAIRS = f"""SELECT DISTINCT snd AS sound, family FROM (SELECT DISTINCT {SOUND} AS snd FROM {HEARD}) e JOIN (VALUES {_values(_SOUND_ROWS)}) x(family, name) ON snd = name
  UNION SELECT DISTINCT snd AS sound, family FROM (SELECT DISTINCT {SOUND} AS snd FROM {HEARD}) e JOIN (VALUES {_values(_KIT_ROWS)}) x(family, suffix) ON NOT starts_with(snd, 'gm_') AND split_part(snd, '_', -1) = suffix"""


def registry_tables(v):
    """(family_sound, family_kit) as tables of a few rows."""
    spark = v("region").sparkSession
    return F.broadcast(spark.createDataFrame(_SOUND_ROWS, "family string, sound string")), F.broadcast(spark.createDataFrame(_KIT_ROWS, "family string, suffix string"))


def families_of(v):
    return M.sound_families(haps(v, every=False).where(E.audible()).select(E.sound().alias("sound")), *registry_tables(v))


def heard_families(v):
    """Telemetry, a row a program, and the families of its sounds; the events are read once."""
    programs = settle(E.telemetry(haps(v, every=False), CYCLES))
    return programs, settle(M.sound_families(programs.select(F.explode("sound_sources").alias("sound")), *registry_tables(v)))


@query(PAIRS)
def joi10_sound_families(v):
    return families_of(v)


@query(f"""WITH t AS ({TELEMETRY}), f AS ({PAIRS}), h AS (SELECT program_id, family FROM (SELECT program_id, unnest(sound_sources) AS sound FROM t) JOIN f USING (sound) UNION SELECT program_id, 'bass' AS family FROM t WHERE pitch_lo <= 48)
SELECT program_id, coalesce(list_sort(list(DISTINCT family) FILTER (family IS NOT NULL)), []) AS families FROM t LEFT JOIN h USING (program_id) GROUP BY program_id""")
def agg6_present_families(v):
    return M.present_families(*heard_families(v), LOW)


VOICES = f"""SELECT program_id, count(DISTINCT part) AS voices FROM (SELECT program_id, sound, coalesce(arg_min(family, priority), sound) AS part FROM (SELECT program_id, unnest(sound_sources) AS sound FROM ({TELEMETRY}))
  LEFT JOIN (SELECT sound, g.program_id AS pid, family, priority FROM ({PAIRS}) JOIN (SELECT program_id, require AS family, 0 AS priority FROM <contracts_v> WHERE require IS NOT NULL UNION ALL SELECT program_id, 'drums' AS family, 1 AS priority FROM <programs_v>) g USING (family)) m ON m.pid = program_id AND m.sound = sound
  GROUP BY program_id, sound) GROUP BY program_id""".replace("AND m.sound = sound", "AND m.sound = x.sound").replace("FROM (" + TELEMETRY + "))\n", "FROM (" + TELEMETRY + ")) x\n").replace("SELECT program_id, sound, coalesce(arg_min(family, priority), sound) AS part", "SELECT x.program_id, x.sound, coalesce(arg_min(family, priority), x.sound) AS part").replace("m.pid = program_id", "m.pid = x.program_id").replace("GROUP BY program_id, sound) GROUP", "GROUP BY x.program_id, x.sound) GROUP")


@query(VOICES)
def agg7_voice_count(v):
    named = v("contracts_v").where("require IS NOT NULL").select("program_id", F.col("require").alias("family"), F.lit(0).alias("priority"))
    return M.voice_counts(*heard_families(v), named)


@query(r"""WITH n AS (SELECT DISTINCT CASE WHEN p_partkey % 5 = 0 THEN 'gm_' ELSE '' END || replace(p_brand, '#', '_') || '_' || p_size AS name FROM part)
SELECT regexp_extract(name, '^(.*)_([^_]+)$', 1) AS bank, list_sort(list(DISTINCT regexp_extract(name, '^(.*)_([^_]+)$', 2))) AS pieces FROM n WHERE NOT starts_with(name, 'gm_') GROUP BY 1""")
def agg20_drum_banks(v):
    name = F.expr("concat(CASE WHEN p_partkey % 5 = 0 THEN 'gm_' ELSE '' END, replace(p_brand, '#', '_'), '_', cast(p_size AS string))")
    return M.drum_banks(v("part").select(name.alias("name")))
