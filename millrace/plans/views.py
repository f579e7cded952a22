"""Views over the driver tables that stand for the library's record types.

Each is one SQL text that Spark and DuckDB read alike; ``{name}`` stands for
another view or a table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

#: SPDX ids of the license allowlist (fixed values).
LICENSES = ("MIT", "Apache-2.0", "BSD-3-Clause", "CC0-1.0", "CC-BY-4.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later")
_LICENSE = " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate((*LICENSES, "CC-BY-NC-4.0", "Proprietary", "WTFPL")))
_BUCKET = {"spark": "cast(conv(substr(sha2(concat('\"', source, '\"'), 256), 1, 8), 16, 10) AS bigint) % 100", "duck": "cast('0x' || substr(sha256('\"' || source || '\"'), 1, 8) AS bigint) % 100"}
_WORDS = {"spark": r"size(regexp_extract_all(text, '\\S+', 0))", "duck": r"len(regexp_extract_all(text, '\S+'))"}
_ARRAY = {"spark": "array({0})", "duck": "[{0}]"}
_NO_NULLS = {"spark": "array_compact(array({0}))", "duck": "list_filter([{0}], lambda m: m IS NOT NULL)"}
_PART = {"spark": "slice(embedding, {a}, {b} - {a} + 1)", "duck": "embedding[{a} : {b}]"}
_ROWS = {"spark": "(VALUES {0}) AS t({1})", "duck": "(VALUES {0}) AS t({1})"}


def _views(e: str) -> dict[str, str]:
    arr, compact = _ARRAY[e].format, _NO_NULLS[e].format
    LEFT, RIGHT = "{", "}"
    zero, dbl = "cast(0 AS double)", "cast({0} AS double)".format
    return {
        "requests_v": f"""SELECT doc_id AS id, text AS prompt, source AS family,
            CASE WHEN doc_id % 4 = 3 THEN 'rl' ELSE 'sft' END AS stage, concat('m', cast(doc_id % 5 AS string)) AS author_id,
            CASE WHEN {_BUCKET[e]} < 80 THEN 'train' WHEN {_BUCKET[e]} < 90 THEN 'val' ELSE 'benchmark' END AS split FROM <documents>""",
        "sources_v": f"""SELECT doc_id AS id, source AS family, text AS code, doc_id AS ordinal, lang, CASE doc_id % 12 {_LICENSE} END AS license FROM <documents>""",
        # typed columns for SQL, and the same as a JSON value: objects of mixed controls, bare notes, nothing; some events lie before or after the cycles
        "haps_v": f"""SELECT *, CASE WHEN bare THEN note_text WHEN nothing THEN NULL ELSE concat('{LEFT}', concat_ws(', ', CASE WHEN s IS NOT NULL THEN concat('"s": "', s, '"') END, CASE WHEN bank IS NOT NULL THEN concat('"bank": "', bank, '"') END,
              CASE WHEN note IS NOT NULL THEN concat('"note": ', note_text) END, CASE WHEN n IS NOT NULL THEN concat('"n": ', cast(n AS string)) END,
              CASE WHEN gain_units IS NOT NULL THEN concat('"gain": ', cast(cast(floor(gain_units / 10000) AS int) AS string), '.', lpad(cast(gain_units % 10000 AS string), 4, '0')) END), '{RIGHT}') END AS value
          FROM (SELECT event_id, program_id, begin_at, end_at, onset, bare, nothing, note, CASE WHEN named THEN concat('"', trim(substr('c c#d d#e f f#g g#a a#b ', cast(2 * (pitch % 12) + 1 AS int), 2)), cast(cast(floor(pitch / 12) AS int) - 1 AS string), '"') ELSE cast(pitch AS string) END AS note_text,
              CASE WHEN NOT bare AND NOT nothing AND event_id % 29 <> 7 THEN s END AS s, CASE WHEN NOT bare AND NOT nothing AND event_id % 5 = 0 THEN 'RolandTR909' END AS bank,
              CASE WHEN NOT bare AND NOT nothing AND event_id % 6 = 2 THEN event_id % 4 END AS n, CASE WHEN NOT bare AND NOT nothing THEN gain_units END AS gain_units, CASE WHEN NOT bare AND NOT nothing THEN gain_units / {dbl(10000)} END AS gain
            FROM (SELECT event_id, program_id, begin_at + late AS begin_at, begin_at + late + {dbl("1 + event_id % 4")} / {dbl(8)} AS end_at, onset, s, event_id % 19 = 3 AS bare, event_id % 23 = 5 AND event_id % 19 <> 3 AS nothing, event_id % 3 = 1 AS named, pitch,
                CASE WHEN event_id % 19 = 3 OR (event_id % 23 <> 5 AND pitched) THEN cast(pitch AS double) END AS note,
                CASE WHEN event_id % 17 = 0 THEN 0 WHEN event_id % 13 <> 2 THEN gain_units END AS gain_units
              FROM (SELECT event_id, user_id AS program_id, {dbl("(event_id * 7) % 128")} / {dbl(8)} + CASE WHEN event_id % 11 = 0 THEN {dbl("0.1")} ELSE {zero} END AS begin_at, {dbl("CASE WHEN event_id % 31 = 9 THEN 20 WHEN event_id % 37 = 4 THEN -3 ELSE 0 END")} AS late,
                  event_type <> 'error' AS onset, CASE event_type WHEN 'click' THEN 'bd' WHEN 'view' THEN 'gm_cello' WHEN 'signup' THEN 'hh' WHEN 'purchase' THEN 'sawtooth' ELSE 'sd' END AS s,
                  event_type IN ('view', 'purchase') AS pitched, 36 + event_id % 48 AS pitch, cast(floor(value * 40) AS bigint) AS gain_units FROM <events>) AS raw) AS typed) AS said""",
        "programs_v": f"""SELECT program_id, {dbl("20 + program_id % 20")} AS cpm,
            CASE program_id % 5 WHEN 1 THEN 'C:minor' WHEN 2 THEN 'G:major' WHEN 3 THEN 'A:dorian' WHEN 4 THEN 'F#:phrygian' END AS key,
            {compact("'stack', CASE WHEN program_id % 2 = 0 THEN 'arrange' END, CASE WHEN program_id % 3 = 0 THEN 'lpf' END, CASE WHEN program_id % 7 = 0 THEN 'euclid' END, CASE WHEN program_id % 10 = 1 THEN 'cat' END")} AS methods,
            concat('<think>Play at ', cast(4 * (20 + program_id % 20) + CASE WHEN program_id % 4 = 1 THEN 9 ELSE 0 END AS string), ' bpm in ',
              CASE program_id % 5 WHEN 1 THEN 'C minor' WHEN 2 THEN 'G:major' WHEN 3 THEN 'D dorian' ELSE 'no key' END, '.</think>', chr(10), '```js', chr(10), 'stack(s(', cast(program_id AS string), '))', chr(10),
              CASE WHEN program_id % 7 = 5 THEN '' ELSE '```' END) AS completion
            FROM (SELECT DISTINCT user_id AS program_id FROM <events>) AS u""",
        "contracts_v": f"""SELECT program_id, CASE program_id % 4 WHEN 0 THEN 'kick' WHEN 1 THEN 'strings' WHEN 2 THEN 'bass' END AS require,
            CASE program_id % 4 WHEN 1 THEN 'hi_hat' WHEN 2 THEN 'vocals' WHEN 3 THEN 'snare' END AS forbid,
            CASE WHEN program_id % 3 = 0 THEN 1 END AS voices_min, CASE WHEN program_id % 3 = 0 THEN 3 END AS voices_max,
            CASE WHEN program_id % 2 = 0 THEN 4 * cpm + CASE WHEN program_id % 8 = 0 THEN {dbl(9)} ELSE {zero} END END AS tempo,
            CASE WHEN program_id % 5 IN (1, 2) THEN key END AS key, CASE program_id % 6 WHEN 0 THEN 'build' WHEN 1 THEN 'thin_out' WHEN 2 THEN 'contrast' END AS shape,
            CASE program_id % 5 WHEN 0 THEN 'sparse' WHEN 3 THEN 'busy' END AS space, program_id % 9 = 0 AS loop FROM <programs_v>""",
        "stems_v": f"""SELECT vec_id AS id, CASE label % 6 WHEN 0 THEN 'drums_core' WHEN 1 THEN 'perc_tops' WHEN 2 THEN 'bass' WHEN 3 THEN 'chords_pad' WHEN 4 THEN 'arp_lead' ELSE 'fx_texture' END AS role,
            {dbl("(vec_id * 13) % 64")} AS density, concat('fam', cast(vec_id % 20 AS string)) AS family,
            {compact("'stack', CASE WHEN vec_id % 2 = 1 THEN 'lpf' END, CASE WHEN vec_id % 4 >= 2 THEN 'slow' END, CASE WHEN vec_id % 8 >= 4 THEN 'jux' END")} AS methods,
            {dbl("vec_id % 8")} / {dbl(8)} AS structural_variation, embedding FROM <embeddings>""",
        "voices_v": f"""SELECT vec_id AS task_id, 0 AS pos, CASE vec_id % 6 WHEN 0 THEN 'drums_core' WHEN 1 THEN 'perc_tops' WHEN 2 THEN 'bass' WHEN 3 THEN 'chords_pad' WHEN 4 THEN 'arp_lead' ELSE 'fx_texture' END AS role,
            {dbl("vec_id % 16")} AS density_lo, {dbl("vec_id % 16 + 24")} AS density_hi, concat('fam', cast(vec_id % 20 AS string)) AS own_family,
            CASE vec_id % 3 WHEN 0 THEN {arr("'lpf'")} WHEN 1 THEN {arr("'lpf', 'jux'")} ELSE {arr("'stack', 'slow', 'fast'")} END AS techniques, embedding FROM <embeddings> WHERE vec_id % 50 = 0""",
        "clips_v": "SELECT vec_id AS clip_id, concat('model', cast(label AS string)) AS model, vec_id % 20 AS prompt_id, embedding FROM <embeddings>",
        "frames_v": f"""SELECT vec_id AS clip_id, concat('model', cast(label AS string)) AS model, vec_id % 20 AS prompt_id, {_PART[e].format(a=1, b=32)} AS embedding,
            {compact(", ".join([_PART[e].format(a=1, b=32), *(f"CASE WHEN vec_id % 3 >= {k} THEN {_PART[e].format(a=1 + 8 * k, b=32 + 8 * k)} END" for k in (1, 2))]))} AS frames FROM <embeddings>""",
        "records_v": """SELECT doc_id AS id, CASE WHEN doc_id % 6 < 2 THEN doc_id % 3 END AS retry, CASE WHEN doc_id % 6 < 2 THEN doc_id % 6 = 0 END AS accepted, CASE WHEN doc_id % 6 = 2 THEN 'job' END AS task,
            CASE WHEN doc_id % 6 = 3 THEN concat('house:m', cast(doc_id % 5 AS string)) END AS teacher, CASE doc_id % 12 WHEN 4 THEN 'sft' WHEN 10 THEN 'rl' END AS stage, CASE WHEN doc_id % 12 = 5 THEN 'stack()' WHEN doc_id % 36 = 11 THEN '' END AS code,
            CASE WHEN doc_id % 4 = 0 THEN 'stack' END AS plan_category, CASE WHEN doc_id % 4 < 2 THEN 'atomic' END AS category, CASE doc_id % 5 WHEN 0 THEN 'musical' WHEN 1 THEN 'mood' WHEN 2 THEN 'technical' END AS prompt_style,
            CASE doc_id % 7 WHEN 0 THEN 'acme-composer' WHEN 1 THEN 'M1' WHEN 2 THEN 'm12' END AS model_id FROM <documents>""",
        "jobs_v": "SELECT o_orderkey AS job_id, o_orderpriority AS model_id, o_orderkey AS job_index, o_custkey AS request_id FROM <orders>",
        "attempts_v": """SELECT l_orderkey AS job_id, cast(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS int) AS retry,
            l_returnflag = 'A' AND l_linestatus = 'F' AS accepted, concat('f', cast(l_partkey % 7 AS string)) AS feedback, l_quantity AS tokens FROM <lineitem>""",
        "tasks_v": "SELECT id, prompt, family, author_id, CASE id % 4 WHEN 0 THEN 'atomic' WHEN 1 THEN 'stack' WHEN 2 THEN 'arrange' ELSE 'cocreate' END AS category FROM <requests_v> WHERE split = 'benchmark'",
        "predictions_v": """SELECT id, concat('<think>', author_id, '</think>', chr(10), '```js', chr(10), 'n(', cast(id AS string), ')', chr(10), CASE WHEN id % 3 = 0 THEN '' ELSE '```' END) AS completion FROM <tasks_v> WHERE id % 7 <> 0
            UNION ALL SELECT id + 1000000000 AS id, 'extra' AS completion FROM <tasks_v> WHERE id % 11 = 0""",
        "rollouts_v": f"""SELECT user_id AS task_id, event_id AS ordinal, CASE WHEN user_id % 10 = 0 THEN {dbl("0.5")} ELSE floor(least(value / {dbl(200)}, {dbl(1)}) * {dbl(10000)}) / {dbl(10000)} END AS total, event_type AS component,
            floor(least(value / {dbl(100)}, {dbl(1)}) * {dbl(10000)}) / {dbl(10000)} AS component_value, event_id % 200 AS step, ts FROM <events>""",
        "log_v": "SELECT user_id % 10 AS run, event_id AS step, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS metric FROM <events> WHERE event_type = 'click'",
        "saves_v": "SELECT user_id % 10 AS run, event_id AS step FROM <events> WHERE event_type = 'purchase'",
        "chat_v": f"SELECT conv_id, turn, role, text, {_WORDS[e]} AS tokens FROM <conversations>",
    }


SPARK, DUCK = _views("spark"), _views("duck")


NAMED = "<(" + "|".join([*TABLES, *SPARK]) + ")>"


def _named(text: str) -> set[str]:
    return set(re.findall(NAMED, text))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, or a view over it."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = SPARK[name].replace("{", "{{").replace("}", "}}")
    parts = {n: view(spark, sf_dir, n) for n in _named(text)}
    return spark.sql(re.sub(NAMED, r"{\1}", text), **parts)


def oracle(body: str) -> str:
    """SQL of DuckDB in which ``<name>`` stands for a table or view."""
    ctes: dict[str, str] = {}

    def add(text: str) -> None:
        for n in re.findall(NAMED, text):
            if n in DUCK and n not in ctes:
                add(DUCK[n])
                ctes[n] = DUCK[n]

    add(body)
    plain = lambda text: re.sub(NAMED, r"\1", text)
    head = ",\n".join(f"{n} AS ({plain(t)})" for n, t in ctes.items())
    body = plain(body)
    if not head:
        return body
    return f"WITH {head},\n{body[5:]}" if body.startswith("WITH ") else f"WITH {head}\n{body}"
