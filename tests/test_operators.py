"""Documented examples, and properties that SQL doesn't state."""

import json
import re

import pytest
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import dedup as D
from millrace.operators import evaluation as E
from millrace.operators import jobs as J
from millrace.operators.splits import hash_split
from millrace.sources import records as S


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_documented_split(spark):
    assert one(spark, hash_split(F.lit("seed-drums")))[0] == "train"


@pytest.mark.parametrize(("n", "quotas"), [(200, [80, 60, 60]), (7, [3, 2, 2])])
def test_documented_quotas(spark, n, quotas):
    shares = spark.createDataFrame([("a", 1, 0.4), ("b", 2, 0.3), ("c", 3, 0.3)], "model_id string, pos int, fraction double")
    assert [r.quota for r in J.allocate(shares, n).orderBy("pos").collect()] == quotas


def test_completion_reasons(spark):
    good = "<think> a </think>\n```js\ncode\n```"
    cases = {good: None, "no": "shape", "<think> </think>```js\nx\n```": "empty", "<think>a</think>```js\nx</think>\n```": "nested", good + "x": "shape"}
    for text, reason in cases.items():
        assert one(spark, T.completion(F.lit(text))["reason"])[0] == reason


def test_notes_and_scales(spark):
    got = one(spark, *(T.midi_pitch(F.lit(n)) for n in ("C4", "c#-1", "Bb3", "60", "H1", "0")))
    assert list(got) == [60.0, 1.0, 58.0, 60.0, None, 0.0]
    assert one(spark, T.scale_mask(F.lit("A:minor")))[0] == one(spark, T.scale_mask(F.lit("C:major")))[0]
    assert len(T.all_scale_masks()) == len({*T.all_scale_masks()})


def repeats(new, old):
    w = [re.findall(r"[a-z0-9']+", x.lower()) for x in (new, old)]
    a, b = set(w[0]), set(w[1])
    return w[0] == w[1] or (len(w[0]) >= 8 and len(w[1]) >= 8 and w[0][:8] == w[1][:8]) or (len(a) >= 4 and len(b) >= 4 and len(a & b) >= 0.5 * len(a | b))


def test_greedy_acceptance_equals_a_loop(spark):
    import random

    rng = random.Random(4)
    words = "ash bay cot dew elm fir gap hut ivy jet".split()
    prompts = [" ".join(rng.choice(words[: rng.randint(3, 10)]) for _ in range(rng.randint(1, 11))) for _ in range(150)] + ["", "...", "ash"]
    accepted = []
    for i, p in enumerate(prompts):
        if not any(repeats(p, prompts[j]) for j in accepted):
            accepted.append(i)
    rows = spark.createDataFrame(list(enumerate(prompts)), "id bigint, prompt string")
    got = {r.id: r for r in D.accept_greedily(rows).collect()}
    assert sorted(i for i, r in got.items() if r.accepted) == accepted
    for i, r in got.items():
        assert r.accepted == (r.repeats is None)
        if not r.accepted:
            assert r.repeats < i


def test_append_is_idempotent_and_keeps_repeats_of_a_batch(spark):
    old = spark.createDataFrame([(1, "p"), (2, None)], "id int, prompt_id string")
    new = spark.createDataFrame([(2, "q"), (3, "p"), (4, "r"), (4, "r"), (5, None)], "id int, prompt_id string")
    once = D.append_new(old, new)
    assert sorted(r.id for r in once.collect()) == [1, 2, 4, 4, 5]
    assert D.append_new(once, new).count() == once.count()


def test_positions_and_assignment(spark):
    jobs = spark.range(1000).select((F.col("id") * 7 % 1000).alias("job_index"))
    quotas = spark.createDataFrame([("a", 1, 10), ("b", 2, 990)], "model_id string, pos int, quota bigint")
    got = J.assign_models(jobs, quotas).collect()
    assert all(r.row_index == r.job_index and r.assigned == ("a" if r.job_index < 10 else "b") for r in got)


def test_circular_lineage_is_an_error(spark):
    runs = spark.createDataFrame([(1, 2), (2, 1), (3, None)], "run_id int, parent_id int")
    assert [tuple(r) for r in J.lineage(runs, 3).collect()] == [(3, 0)]
    with pytest.raises(ValueError, match="circular"):
        J.lineage(runs, 1)


def test_strict_records(spark, tmp_path):
    lines = ['{"a": 1, "b": 2.5}', "", '{"a": 2, "b": NaN}', "[1]", '{"a": 3, "c": 1}', '{"a": 4}', "oops"]
    (tmp_path / "x.jsonl").write_text("\n".join(lines))
    schema = spark.createDataFrame([], "a int, b double").schema
    good, bad = S.read_records(spark, str(tmp_path), schema)
    assert sorted(r.a for r in good.collect()) == [1, 4]
    assert sorted(r.reason for r in bad.collect()) == ["malformed", "malformed", "not an object", "unknown field"] or bad.count() == 4
    with pytest.raises(ValueError):
        S.read_records(spark, str(tmp_path), schema, strict=True)


def test_journal_recovery(spark, tmp_path):
    schema = spark.createDataFrame([], "a int").schema
    for name, text, n in (("cut", '{"a": 1}\n{"a": 2}\n{"a"', 2), ("whole", '{"a": 1}\n{"a": 2}', 2)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "j.jsonl").write_text(text)
        assert S.recover_journal(spark, str(tmp_path / name), schema).count() == n
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "j.jsonl").write_text('{"a"\n{"a": 2}\n')
    with pytest.raises(ValueError, match="line 1"):
        S.recover_journal(spark, str(tmp_path / "bad"), schema)


def test_required_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿id,name,note\n1,x,\n2,,y\n3,z,w,extra\n")
    good, bad = S.read_required_csv(spark, str(tmp_path / "a.csv"), ["id", "name"])
    assert [r.id for r in good.collect()] == ["1"] and bad.count() == 2
    with pytest.raises(ValueError, match="missing"):
        S.read_required_csv(spark, str(tmp_path / "a.csv"), ["other"])
    S.write_csv(good, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 1


def test_pinned_files(spark, tmp_path):
    import hashlib

    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a.txt").write_bytes(b"a")
    (tmp_path / "f" / "b.txt").write_bytes(b"changed")
    rows = [("a.txt", hashlib.sha256(b"a").hexdigest()), ("b.txt", "0"), ("c.txt", "0")]
    got = S.pinned_files(spark, str(tmp_path / "f"), spark.createDataFrame(rows, "name string, sha256 string"))
    assert {r.name: r.status for r in got.collect()} == {"a.txt": "ok", "b.txt": "changed", "c.txt": "missing"}


def test_misplaced_rows(spark, tmp_path):
    (tmp_path / "sft").mkdir()
    (tmp_path / "sft" / "train.jsonl").write_text('{"id": 1, "stage": "sft", "split": "train"}\n{"id": 2, "stage": "rl", "split": "train"}\n')
    schema = spark.createDataFrame([], "id int, stage string, split string").schema
    assert [r.id for r in S.misplaced(spark, str(tmp_path), schema).collect()] == [2]


def test_fingerprint_ignores_order_but_not_rows(spark):
    rows = spark.range(100).withColumn("x", F.array("id"))
    first = S.fingerprint(rows)
    assert first == S.fingerprint(rows.repartition(5)) and first != S.fingerprint(rows.unionAll(rows.limit(1)))


def test_frechet_distance_of_a_set_from_itself_is_zero(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    rows = spark.createDataFrame([("a", rng.standard_normal(4).tolist()) for _ in range(60)], "g string, embedding array<double>")
    moments = E.moments(rows, "g")
    assert abs(E.frechet(moments, moments, "g").first().distance) < 1e-8
    x = np.array([r.embedding for r in rows.collect()])
    assert np.allclose(np.array(moments.first()["cov"]).reshape(4, 4), np.cov(x.T))


def repeats(a, b):
    import re

    x, y = (re.findall("[a-z0-9']+", t.lower()) for t in (a, b))
    same = len(x) >= 8 and len(y) >= 8 and x[:8] == y[:8]
    p, q = set(x), set(y)
    return x == y or same or (len(p) >= 4 and len(q) >= 4 and len(p & q) >= 0.5 * len(p | q))


@pytest.mark.parametrize("order", ["sorted", "mixed"])
def test_stream_acceptance_by_arrival(spark, tmp_path, order):
    """What is accepted stays, whatever ids come later; inside a batch the smaller id is first."""
    import os
    import random

    from millrace.streaming import journals as S_

    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("abcdefgh") + str(k) for k in range(rng.choice([2, 5, 9])))) for i in range(60)]
    if order == "mixed":
        rng.shuffle(rows)
    parts, bank = [rows[20 * k : 20 * k + 20] for k in range(3)], []
    (tmp_path / "in").mkdir()
    for k, part in enumerate(parts):
        path = tmp_path / "in" / f"{9 - k}.json"
        path.write_text("\n".join(json.dumps({"id": i, "prompt": p}) for i, p in part))
        os.utime(path, (1_000_000 + k, 1_000_000 + k))
        for i, p in sorted(part):
            if not any(repeats(p, q) for _, q in bank):
                bank.append((i, p))
    stream = spark.readStream.schema("id bigint, prompt string").option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    S_.each_batch(stream, str(tmp_path / "state"), S_.accept_into(str(tmp_path / "bank"))).awaitTermination()
    got = {r.id for r in spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "bank")).collect()}
    assert got == {i for i, _ in bank} and 10 < len(got) < 60


def test_export_waits_for_a_round(spark, tmp_path):
    from millrace.streaming import journals as S_

    batches = [[(1, 7), (2, 8)], [(2, 9), (3, 7)], [(4, 6), (5, 8)]]
    work = S_.export_into(str(tmp_path / "rows"), save_every=2)
    tables = [spark.createDataFrame(b, "id bigint, prompt_id bigint") for b in batches]
    read = lambda: sorted(r.id for r in spark.read.schema("id bigint, prompt_id bigint").parquet(str(tmp_path / "rows")).collect())
    work(tables[0], 0)
    assert not (tmp_path / "rows").exists()
    work(tables[1], 1)
    assert read() == [1, 2, 2, 3]
    work(tables[2], 2)
    S_.export_rest(spark, str(tmp_path / "rows"), tables[0].schema, 2, save_every=2)
    assert read() == [1, 2, 2, 3, 4]


def test_lineage(spark):
    runs = spark.createDataFrame([(k, k // 2 if k else None) for k in range(40)], "run_id bigint, parent_id bigint")
    assert sorted(map(tuple, J.lineage(runs, 39).collect())) == [(0, 6), (1, 5), (2, 4), (4, 3), (9, 2), (19, 1), (39, 0)]
    long = spark.range(200).selectExpr("id AS run_id", "if(id > 0, id - 1, null) AS parent_id")
    assert J.lineage(long, 150).count() == 151
    with pytest.raises(ValueError, match="more than once"):
        J.lineage(runs.unionAll(runs.limit(1)), 3)


def test_guards_of_evaluation(spark):
    tasks = spark.createDataFrame([(1, "p")], "id bigint, prompt string")
    twice = spark.createDataFrame([(1, "x"), (1, "y")], "id bigint, completion string")
    with pytest.raises(Exception, match="more than one prediction"):
        E.scored_predictions(tasks, twice).collect()
    with pytest.raises(Exception, match="for no task"):
        E.viewer_rows(tasks, spark.createDataFrame([(2, "x")], "id bigint, completion string")).collect()
    rows = spark.createDataFrame([(1, "a"), (2, "a")], "id bigint, key string")
    with pytest.raises(ValueError, match="are left"):
        J.replay(rows, rows.where("id > 5"), 2, 7)
    with pytest.raises(ValueError, match="has changed"):
        S.require_fingerprint(rows, "other")


def test_csv_columns_go_by_name(spark, tmp_path):
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "a.csv").write_text('id,"name"\n1,x\n')
    (tmp_path / "c" / "b.csv").write_text("name,id\nbob,2\n")
    good, _ = S.read_required_csv(spark, str(tmp_path / "c"), ["id", "name"])
    assert sorted((r.id, r.name) for r in good.collect()) == [("1", "x"), ("2", "bob")]
    (tmp_path / "c" / "d.csv").write_text("id,other\n3,y\n")
    with pytest.raises(ValueError, match="columns"):
        S.read_required_csv(spark, str(tmp_path / "c"), ["id"])


def test_frechet_distance_of_known_sets(spark):
    """Between sets of equal spread the distance is that of their means; between others also that of their spreads."""
    import numpy as np

    x = np.random.default_rng(0).standard_normal((400, 3))
    rows = [("a", v.tolist()) for v in x] + [("b", (v + [3.0, 4.0, 0.0]).tolist()) for v in x] + [("c", (2 * v).tolist()) for v in x]
    moments = E.moments(spark.createDataFrame(rows, "g string, embedding array<double>"), "g")
    base = moments.where("g = 'a'")
    got = {r.g: r.distance for r in E.frechet(moments, base, "g").collect()}
    want = {"a": 0.0, "b": 25.0, "c": np.trace(np.cov(x.T)) + (x.mean(0) ** 2).sum()}
    assert all(abs(got[g] - want[g]) < 1e-6 for g in want)


def test_mauve_distance_tells_sets_apart(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    near, far = rng.standard_normal((120, 4)), rng.standard_normal((120, 4)) + 50
    half = np.vstack([near[:60], far[:60]])
    rows = [(g, v.tolist()) for g, x in (("far", far), ("half", half), ("same", near)) for v in x]
    vectors = spark.createDataFrame(rows, "model string, embedding array<double>")
    got = {r.model: r.mad for r in E.mauve_distance(vectors, vectors.where("model = 'same'"), "model").collect()}
    assert abs(got["same"]) < 0.05 < got["half"] < got["far"]


# --- values of events


def _python_controls(value):
    """Controls of a value, written down from the rule: bare scalars are notes, nothing has no controls, a bank names its sounds."""
    if value is None:
        return {}
    if not isinstance(value, dict):
        return {"note": value}
    return value | {"s": f"{value['bank']}_{value['s']}"} if value.get("bank") and value.get("s") else value


def _python_prints(rows, cycles, names=None):
    import json

    buckets = {}
    for program, begin, end, value in rows:
        said = _python_controls(json.loads(value) if value is not None else None)
        if said.get("gain", 1) > 0 and 0 <= int(begin // 1) < cycles:
            kept = {k: round(x, 4) if isinstance(x, float) else x for k, x in said.items() if names is None or k in names}
            buckets.setdefault((program, int(begin // 1)), []).append(json.dumps([round(begin % 1, 6), round(end - begin, 6), kept], sort_keys=True))
    return {k: "|".join(sorted(v)) for k, v in buckets.items()}


VALUES = (
    '{"s": "bd"}', '{"s": "bd", "n": 1}', '{"s": "bd", "n": 1.0}', '{"s": "bd", "n": "1"}', '{"n": 1, "s": "bd"}', '{"s": "bd", "bank": "tr", "gain": 0.5}', '{"s": "tr_bd", "gain": 0.50001}', '{"s": "tr_bd", "gain": 0.5001}',
    '{"note": "c4"}', '{"note": 60}', '{"note": 60.00001}', "60", "60.0", '"c4"', "null", None, "{}", '{"gain": 0}', '{"s": "bd", "gain": 0.0}', '{"s": "", "bank": "tr"}', '{"cutoff": 800, "s": "saw"}', '{"cutoff": 900, "s": "saw"}', '{"note": true}',
    '{"s": "h\\u00e9\\"h", "delay": [0.25, 2]}',
)


def test_fingerprints_of_mixed_values(spark):
    import random

    from millrace.operators import events as E

    rng = random.Random(4)
    rows = [(k, float(c) + rng.choice([0.0, 0.25]), None) for k in range(len(VALUES)) for c in range(3)]
    rows = [(k, b, b + 0.5, VALUES[k]) for k, b, _ in rows]
    rows += [(100 + k, b := rng.choice([-1.0, 0.0, 0.5, 1.0, 2.5, 9.0]), b + rng.choice([0.5, 0.25]), rng.choice(VALUES)) for k in range(40) for _ in range(rng.randint(1, 6))]
    events = E.with_controls(spark.createDataFrame([(*r[:3], True, r[3]) for r in rows], "program_id bigint, begin_at double, end_at double, onset boolean, value string"))
    got = {(r.program_id, r.cycle): r for r in E.fingerprints(events, 4).collect()}
    for names, field in ((("s", "note", "n"), "print"), (None, "controls")):
        expected = _python_prints(rows, 4, names)
        assert set(got) == set(expected)
        # two cycles have one print just where they have one in Python; the texts themselves are our own
        assert len({(expected[k], got[k][field]) for k in got}) == len(set(expected.values())) == len({got[k][field] for k in got})


def test_missing_gains_count_as_one(spark):
    from millrace.operators import events as E

    rows = [(1, 0.0, '{"s": "bd"}'), (1, 1.0, '{"s": "bd", "gain": 0.3}'), (2, 0.0, '{"gain": 0.2, "note": "e4"}'), (3, 0.0, None), (3, 0.5, "61"), (4, 0.0, '{"gain": 0}')]
    events = E.with_controls(spark.createDataFrame([(p, b, b + 1, True, v) for p, b, v in rows], "program_id bigint, begin_at double, end_at double, onset boolean, value string"))
    got = {r.program_id: r for r in E.telemetry(events, 4).collect()}
    assert {p: (r.gain_min, r.gain_max) for p, r in got.items()} == {1: (0.3, 1.0), 2: (0.2, 0.2), 3: (1.0, 1.0)}
    assert (got[2].pitches, got[3].pitches, got[3].sound_sources, got[3].event_count) == ([64.0], [61.0], [], 2)
    keys = spark.createDataFrame([(2, "C:major"), (3, "C:major")], "program_id bigint, key string")
    assert {r.program_id: r.adherence for r in E.scale_adherence(events, keys).collect()} == {2: 1.0, 3: 0.0}


def test_sections_leave_out_events_beyond_the_cycles(spark):
    from millrace.operators import events as E

    rows = [(1, b, '{"s": "bd"}') for b in (-1.0, 0.0, 15.0, 15.99, 16.0, 20.0, 99.0)]
    events = E.with_controls(spark.createDataFrame([(p, b, b + 1, True, v) for p, b, v in rows], "program_id bigint, begin_at double, end_at double, onset boolean, value string"))
    assert [x.onsets for x in E.sections(events, 16).first().sections] == [1, 0, 0, 2]
    assert E.telemetry(events, 16).first().event_count == 7


# --- streams that stop, repeat and come late


def test_banks_and_batches_agree_on_openings_of_few_words(spark):
    from millrace.operators import dedup as D

    rows = [(1, "la la la la la la la la one"), (2, "la la la la la la la la two"), (3, "one two three")]
    all_rows = spark.createDataFrame(rows, "id bigint, prompt string")
    assert {r.id: r.accepted for r in D.accept_greedily(all_rows).collect()} == {1: True, 2: False, 3: True}
    assert {r.id: r.repeats for r in D.repeats_of(all_rows.where("id > 1"), all_rows.where("id = 1")).collect()} == {2: 1}


def _feed(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def test_ingest_goes_on_after_a_stop(spark, tmp_path):
    from datetime import datetime, timedelta

    from millrace.streaming import journals as J

    at = lambda minutes: datetime(2024, 1, 1) + timedelta(minutes=minutes)
    schema, folder = "id bigint, ts timestamp", f"{tmp_path}/in"
    for part in ([(1, at(0)), (2, at(10)), (2, at(11))], [(2, at(12)), (3, at(50))], [(1, at(1)), (3, at(55)), (4, at(300))], [(4, at(301)), (5, at(2)), (6, at(302))]):
        _feed(spark, folder, part, schema)
        J.ingest(spark.readStream.schema(schema).parquet(folder), f"{tmp_path}/out", f"{tmp_path}/state", keys=["id"], time="ts", delay="60 minutes").awaitTermination()
    # 5 came five hours late, after the state of its time was dropped
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [1, 2, 3, 4, 6]


def test_monitor_writes_closed_windows_once(spark, tmp_path):
    from datetime import datetime, timedelta

    import pytest as pt

    from millrace.streaming import journals as J

    at = lambda hours: datetime(2024, 1, 1) + timedelta(hours=hours)
    schema, folder = "ts timestamp, component string, total double", f"{tmp_path}/in"
    parts = ([(at(0.1), "a", 1.0), (at(1.2), "a", 0.5)], [(at(0.9), "a", 0.0), (at(2.6), "a", 1.0)], [(at(0.5), "a", 9.0), (at(1.9), "b", 0.25), (at(9), "a", 1.0)])
    for part in parts:
        _feed(spark, folder, part, schema)
        J.monitor(spark.readStream.schema(schema).parquet(folder), f"{tmp_path}/out", f"{tmp_path}/state", size="1 hour", delay="1 hour").awaitTermination()
    got = {(r.start, r.component): (r.n, r.mean) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    # the second run's late row still counts, that of the third is late; the window of hour 9 is open
    assert got == {(at(0), "a"): (2, 0.5), (at(1), "a"): (1, 0.5), (at(1), "b"): (1, 0.25), (at(2), "a"): (1, 1.0)}
    with pt.raises(ValueError):
        J.monitor(spark.createDataFrame(parts[0], schema), "x", "y")


# --- requests, contracts, browser, histories and frames


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("Use lpf, jux(2) and a fast workout", ["jux", "lpf"]), ("use using  slow", ["slow"]), ("reuse fast; apply\nfast off (1)", ["off", "fast"]), ("using euclid.", ["euclid"]), ("use: lpf lpf2( myjux(", []), ("", []), (None, []),
    ],
)
def test_named_techniques(spark, text, expected):
    from millrace.functions.text import named_techniques

    got = spark.createDataFrame([(text,)], "t string").select(named_techniques("t").alias("n")).first().n
    assert sorted(got) == sorted(expected)


@pytest.mark.parametrize(
    ("text", "style", "reason"),
    [
        ("play Stack (x)", "mood", "api_call"), ("stacks(x) of sound", "mood", None), ("at 120.5BPM now", "mood", "precise"), ("a 440 hz tone", "musical", None), ("v120 bpm", "mood", None), ("in F#: Lydian", "mood", "precise"),
        ("in Bb minor", "mood", "precise"), ("an A-minor minor thing", "mood", None), ("s(", "technical", None), ("12 bpms", "mood", None),
    ],
)
def test_style_leaks(spark, text, style, reason):
    from millrace.operators.validation import style_leak

    assert spark.createDataFrame([(text, style)], "p string, style string").select(style_leak("p", "style").alias("r")).first().r == reason


def test_literals_of_contracts(spark):
    from millrace.operators import validation as V

    rows = [(1, 120.0, "At 120 BPM", None, None), (2, 92.5, "92.5 bpm", "C:minor", "c  MINOR"), (3, 120.0, "a quick bpm", None, None), (4, 120.0, "120 beats", "C:minor", "sad"), (5, 120.0, None, "C:minor", None)]
    df = spark.createDataFrame(rows, "id bigint, tempo double, tempo_quote string, key string, key_quote string")
    rules = V.literal_reasons(**{n: F.col(n) for n in ("tempo", "tempo_quote", "key", "key_quote")})
    assert {r.id: r.reasons for r in V.with_reasons(df, rules).collect()} == {1: [], 2: [], 3: ["tempo_quote"], 4: ["tempo_quote", "key_quote"], 5: ["tempo_quote", "key_quote"]}


def _python_excerpt(code, limit):
    if len(code) <= limit:
        return code
    tail = limit // 3
    head, last = code[: limit - tail], code[-tail:]
    return (head[: head.rfind("\n")] if head.rfind("\n") > 0 else head) + "\n[cut]\n" + (last[last.find("\n") + 1 :] if "\n" in last and last[last.find("\n") + 1 :] else last)


def _python_history(turns, budget, fixed):
    kept, used = [], fixed
    for n, (turn, prompt, code) in enumerate(sorted(turns, reverse=True)):
        versions = [(None, code)] + [(x, _python_excerpt(code, x)) for x in (4500, 2200, 1000, 350) if n == 0 and len(code) > x]
        for limit, text in versions:
            size = len(prompt.split()) + len(text.split())
            if used + size <= budget:
                used += size
                kept.append((turn, limit, text, used - fixed))
                break
        else:
            break
    return kept


def test_histories_take_excerpts_of_the_newest_turn(spark):
    import random

    from millrace.operators import retrieval as R

    rng = random.Random(7)
    rows, expected = [], {}
    for conv in range(60):
        budget = rng.choice([20, 80, 200, 500, 900, 1400, 3000])
        turns = [(k, "please " * rng.randint(1, 3), rng.choice(["", "\n"]) + "".join(rng.choice(["ab ", "abc ", "d\n"]) if conv % 7 else "x y" for _ in range(rng.choice([5, 120, 500, 1200, 2500])))) for k in range(rng.randint(1, 5))]
        rows += [(conv, budget, *t) for t in turns]
        expected[conv] = _python_history(turns, budget, 7)
    long = [(0, "go", "a b\n" * 10), (1, "go", "ab " * 2000)]
    rows += [(60, 1600, *t) for t in long]
    expected[60] = _python_history(long, 1600, 7)
    df = spark.createDataFrame(rows, "conv_id bigint, budget int, turn bigint, prompt string, code string").repartition(5)
    got = {}
    for r in R.packed_history(df, F.col("budget"), fixed=7).collect():
        got.setdefault(r.conv_id, []).append((r.turn, r.limit, r.kept, r.total))
    assert {k: sorted(v, reverse=True) for k, v in got.items()} == {k: v for k, v in expected.items() if v}
    assert {x[1] for v in expected.values() for x in v} == {None, 350, 1000, 2200, 4500}


def test_moments_over_ragged_frames(spark):
    import numpy as np

    from millrace.operators import evaluation as E
    from millrace.operators.retrieval import frames_score

    rng = np.random.default_rng(3)
    clips = [("a" if k % 3 else None, rng.normal(size=(k % 5, 6)).astype(np.float32)) for k in range(40)]
    rows = [(g, x.tolist()) for g, x in clips] + [("a", None)]
    df = spark.createDataFrame(rows, "g string, frames array<array<float>>").repartition(4)
    for r in E.moments(df, "g", "frames").collect():
        x = np.concatenate([f for g, f in clips if g == r.g]).astype(np.float64)
        assert r.n == len(x) and np.allclose(r.mean, x.mean(0)) and np.allclose(np.reshape(r["cov"], (6, 6)), np.cov(x, rowvar=False))
    flat = spark.createDataFrame([(g, f.tolist()) for g, x in clips for f in x], "g string, frames array<float>")
    assert {r.g: r.n for r in E.moments(flat, "g", "frames").collect()} == {r.g: r.n for r in E.moments(df, "g", "frames").collect()}
    with pytest.raises(Exception, match="dimensions"):
        E.moments(spark.createDataFrame([("a", [[1.0], [1.0, 2.0]])], "g string, frames array<array<float>>"), "g", "frames").collect()
    text = rng.normal(size=6)
    scored = df.withColumn("t", F.array(*map(F.lit, text.tolist()))).select("frames", frames_score(F.col("frames"), F.col("t")).alias("s")).collect()
    for r in scored:
        x = np.array(r.frames or [], np.float64)
        assert (r.s is None) == (len(x) == 0) and (r.s is None or abs(r.s - np.mean(x @ text / (np.linalg.norm(x, axis=1) * np.linalg.norm(text)))) < 1e-6)


def test_facets_count_under_the_other_choices(spark):
    from millrace.operators import validation as V

    rows = [("x", "p", 1), ("x", "q", 2), ("y", "p", 3), ("y", "p", 4), (None, "q", 5)]
    df = spark.createDataFrame(rows, "a string, b string, n int")
    got = {(r.facet, r.value): r.n for r in V.facet_counts(df, {"a": "y", "b": "q"}).collect()}
    assert got == {("a", "x"): 1, ("a", None): 1, ("b", "p"): 2}
    assert V.facet_counts(df.where("false"), {"a": None}).count() == 0


def test_lineages_hold_their_snapshots(spark):
    rows = [(r, 100 * r + k, f"text {k}") for r in (1, 2, 4, 9) for k in range(5)] + [(2, 201, "text 1")]
    accepted = spark.createDataFrame(rows, "run_id bigint, id bigint, prompt string")
    runs = spark.createDataFrame([(9, 4), (4, 2), (2, 1), (1, None), (3, 1)], "run_id bigint, parent_id bigint")
    frozen = J.frozen_lineage(runs, accepted.repartition(7, "id"), 9)
    assert {r.run_id: r.parent_snapshot is None for r in frozen.collect()} == {9: False, 4: False, 2: False, 1: True}
    assert J.checked_rows(frozen, accepted, 9).count() == len(rows)
    changed = accepted.withColumn("prompt", F.when(F.col("id") == 203, "other").otherwise(F.col("prompt")))
    with pytest.raises(ValueError, match="run 2 has changed"):
        J.checked_rows(frozen, changed, 9)
    for other in (accepted.where("id <> 100"), accepted.unionAll(accepted.where("run_id = 1"))):
        with pytest.raises(ValueError, match="run 1 has changed"):
            J.checked_rows(frozen, other, 9)
    # a run's own rows aren't frozen by itself
    assert J.checked_rows(frozen, accepted.where("run_id <> 9"), 9).count() == 16
    with pytest.raises(ValueError, match="id 201"):
        J.checked_rows(frozen, accepted, 9, id="id")


def test_exact_quantiles_by_narrowing(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    groups = {"a": rng.normal(size=2000), "b": np.repeat([0.25, 1.0], [3, 997]), "c": np.array([5.0]), "d": rng.lognormal(0, 12, size=500), "e": np.array([1.0, 2.0])}
    rows = [(g, float(x)) for g, xs in groups.items() for x in xs] + [("a", None), ("f", None), ("e", float("nan")), ("e", float("inf"))]
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    for bins in (2, 1024):
        got = {(r.g, r.share): r.quantile for r in E.exact_quantiles(df, "g", "x", [0.02, 0.5, 1.0], bins=bins).collect()}
        assert set(got) == {(g, s) for g in groups for s in (0.02, 0.5, 1.0)}
        assert all(np.isclose(v, np.quantile(groups[g], s), rtol=1e-12) for (g, s), v in got.items())


@pytest.mark.parametrize("most", [7, 1000])
def test_top_k_over_batches_and_blocks(spark, most):
    import numpy as np

    from millrace.operators import retrieval as R

    rng = np.random.default_rng(2)
    x = rng.integers(-2, 3, size=(120, 3)).astype(float) + 0.25
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "id bigint, embedding array<double>").repartition(6)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8")
    try:
        got = {(r.query_id, r.place): (r.id, r.score) for r in R.top_k(df.where("id % 5 = 0"), df, 4, most_queries=most).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    for q in range(0, 120, 5):
        order = sorted((-round(float(unit[q] @ unit[k]), 6), k) for k in range(120))[:4]
        assert [got[q, place] for place in (1, 2, 3, 4)] == [(k, -s) for s, k in order]
    assert R.top_k(df.where("false"), df, 4).count() == 0


def test_positions_of_more_rows_than_are_sampled(spark):
    """Bounds of ranges are drawn from a sample; places are exact whatever was drawn."""
    rows = spark.range(300_000).select(((F.col("id") * 7919) % 300_007).alias("at"), F.col("id").alias("other")).repartition(6)
    got = J.positions(rows, "at").toPandas().sort_values("at")
    assert got["row_index"].tolist() == list(range(300_000))


def test_similar_sets_over_many_blocks(spark, monkeypatch):
    """Pairs are those of brute force, for sets of 4 to 900 words, in blocks of a few sets and in one; no word is joined on."""
    import random

    rng = random.Random(5)
    texts = []
    for k in range(160):
        base = [f"w{rng.randrange(60 if k % 3 else 1500)}" for _ in range(rng.choice((5, 9, 30, 60, 200, 900)))]
        texts += [base, [w if rng.random() < 0.8 else f"x{rng.randrange(9)}" for w in base]]
    rows = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "id bigint, prompt string")
    sets, first = {}, {}
    for k, t in enumerate(texts):
        if first.setdefault(tuple(t), k) == k and len(set(t)) >= D.LEAST_WORDS:
            sets[k] = set(t)
    share = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    want = {(a, b): share(a, b) for a in sets for b in sets if a > b and share(a, b) >= 0.5}
    assert len(want) > 100
    for most in (2048, D.BLOCK_BYTES):
        monkeypatch.setattr(D, "BLOCK_BYTES", most)
        assert {(r.a, r.b): r.similarity for r in D.jaccard_pairs(D.repeat_classes(rows)).collect()} == want
    half = rows.where("id >= 160")
    near = {r.id: r.repeats for r in D.repeats_of(half, rows.where("id < 160")).collect()}
    assert all(near.get(a) is not None for (a, b) in want if a >= 160 > b)


def test_top_k_scores_come_in_tiles(spark, monkeypatch):
    """Tiles of three by three, smaller than k: ties go to the smallest id, as in one tile."""
    import numpy as np

    from millrace.operators import retrieval as R

    assert R.BLOCK_ROWS**2 * 8 <= 16 << 20
    x = np.random.default_rng(3).integers(-1, 2, size=(60, 3)).astype(float) + 0.25
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "id bigint, embedding array<double>").repartition(3)
    whole = sorted(R.top_k(df.where("id % 4 = 0"), df, 5).collect())
    monkeypatch.setattr(R, "BLOCK_ROWS", 3)
    assert sorted(R.top_k(df.where("id % 4 = 0"), df, 5).collect()) == whole and len(whole) == 75


@pytest.mark.parametrize("name", ["src9_fingerprint", "set3_checked_lineage"])
def test_shuffles_have_as_many_parts_as_the_session_asks_for(spark, monkeypatch, name):
    from pyspark.sql import DataFrame

    from millrace.plans.registry import QUERIES

    asked, plain = [], DataFrame.repartition
    monkeypatch.setattr(DataFrame, "repartition", lambda self, *to: asked.append(to) or plain(self, *to))
    QUERIES[name](spark, "/root/testdata/sf0.001")
    assert asked and not any(isinstance(n, int) for to in asked for n in to)


def test_ranked_stems_against_a_loop(spark, monkeypatch):
    from millrace.operators import retrieval as R

    monkeypatch.setattr(R, "BLOCK_ROWS", 4)
    voices = [(k, 0, "ab"[k % 2], 0.0, 6.0, f"f{k % 3}", ["x", "y"][: k % 3], [1.0, float(k)]) for k in range(9)]
    stems = [(k, "ab"[k // 2 % 2], float(k % 8), f"f{k % 4}", ["y"] * (k % 2), 0.25, [float(k % 5), 1.0]) for k in range(40)]
    v = spark.createDataFrame(voices, "task_id bigint, pos int, role string, density_lo double, density_hi double, own_family string, techniques array<string>, embedding array<float>")
    s = spark.createDataFrame(stems, "id bigint, role string, density double, family string, methods array<string>, structural_variation double, embedding array<float>").repartition(3)
    want = {}
    for t, _, role, lo, hi, own, asked, x in voices:
        for i, r, d, f, has, change, y in stems:
            if r == role and lo <= d <= hi and f != own:
                cosine = (x[0] * y[0] + x[1] * y[1]) / ((x[0] ** 2 + x[1] ** 2) * (y[0] ** 2 + y[1] ** 2)) ** 0.5
                want[t, i] = round(0.65 * cosine + 0.25 * len({*asked} & {*has}) / max(1, len(asked)) + 0.1 * change, 5)
    got = {(r.task_id, r.id): r.score for r in R.ranked(v, s, most_queries=4).collect()}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 2e-5 for k in want)
    first = {t: min((-score, i) for (u, i), score in got.items() if u == t)[1] for t in {t for t, _ in got}}
    assert {r.task_id: r.id for r in R.best_stem(R.ranked(v, s, best=True)).collect()} == first


@pytest.mark.parametrize("name", ["agg6_present_families", "agg7_voice_count", "sco10_evaluate"])
def test_event_values_are_read_once(spark, monkeypatch, name):
    from millrace.operators import events as V
    from millrace.plans.registry import QUERIES

    calls, plain = [], V.with_controls
    monkeypatch.setattr(V, "with_controls", lambda *a, **k: calls.append(1) or plain(*a, **k))
    QUERIES[name](spark, "/root/testdata/sf0.001")
    assert len(calls) == 1
