"""Per-program summaries of event tables.

An event is (program_id, begin_at, end_at, onset) and a JSON value: an object of controls, a
bare scalar, which counts as a note, or nothing, which has no controls. :func:`with_controls`
reads the value once into typed columns (s, bank, note, gain, scalar) and a map of canonical
controls; the summaries take its rows. An event is *audible* if it is an onset with a gain over 0;
a missing gain is 1. Musical time is in cycles. Programs without an audible event give
no telemetry row. Every summary aggregates by (program, cycle) before program, so no
task collects a program's raw events.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import all_scale_masks, midi_pitch, scale_mask

#: Controls that tell what is played, apart from how (fixed values).
STRUCTURAL = ("n", "note", "s")


def _kind(x: Column) -> Column:
    return F.schema_of_variant(x)


def _canonical(x: Column) -> Column:
    """A control as text: whole numbers and other values as JSON writes them, other numbers with four decimals."""
    fraction = _kind(x).startswith("DECIMAL") | _kind(x).isin("DOUBLE", "FLOAT")
    return F.when(fraction, F.format_string("%.4f", F.round(x.cast("double"), 4))).otherwise(F.to_json(x))


def _let(x: Column, use: Callable[[Column], Column]) -> Column:
    """``use(x)`` with ``x`` worked out once."""
    return F.transform(F.array(x), use)[0]


def _told(v: Column, kind: Column, every: bool) -> Column:
    """What a value of a kind says, as a struct; with ``every`` all controls too."""
    held = F.coalesce(kind.startswith("OBJECT"), F.lit(False))
    scalar = kind.isNotNull() & ~held & (kind != "VOID")
    field = lambda name, of="string": F.try_variant_get(v, f"$.{name}", of)
    given = lambda x: F.when(~x.isin("", "0", "false"), x)
    texts = F.transform_values(F.when(held, v).cast("map<string,variant>"), lambda _, x: _canonical(x))
    merged = _let(F.concat(F.lit('"'), given(field("bank")), F.lit("_"), given(field("s")), F.lit('"')), lambda both: F.when(
        both.isNull(), texts).otherwise(F.map_concat(F.map_filter(texts, lambda k, _: k != "s"), F.create_map(F.lit("s"), both))))
    controls = F.when(held, merged).when(scalar, F.create_map(F.lit("note"), _canonical(v))).otherwise(F.create_map().cast("map<string,string>"))
    # a number in quotes is no pitch
    pitch = lambda x: F.when(_kind(x) != "STRING", x.try_cast("double")).otherwise(_let(x.try_cast("string"), lambda name: F.when(name.rlike("^[a-gA-G]"), midi_pitch(name))))
    return F.struct(
        *([controls.alias("controls")] if every else []), field("s").alias("s"), given(field("bank")).alias("bank"), pitch(F.when(held, field("note", "variant")).when(scalar, v)).alias("note"),
        field("gain", "double").alias("gain"), scalar.alias("scalar"),
    )


def with_controls(events: DataFrame, *, value: str = "value", every: bool = True) -> DataFrame:
    """``events`` with what its JSON ``value`` says: ``controls`` (canonical texts by name), ``s``, ``bank``, ``note``, ``gain``, ``scalar``.

    Where both ``bank`` and ``s`` are given, the controls' ``s`` is ``bank_s``. Note names become MIDI pitches; other
    strings have none. A value that isn't JSON counts as none. Nested values are compared as written. Without ``every``
    there are no ``controls``, which only fingerprints need.
    """
    told = events.withColumn("told", _let(F.try_parse_json(value), lambda v: _let(_kind(v), lambda kind: _told(v, kind, every))))
    return told.withColumns({c: F.col("told")[c] for c in (*(["controls"] if every else []), "s", "bank", "note", "gain", "scalar")}).drop("told")


def audible() -> Column:
    return F.expr("onset AND coalesce(gain, 1.0) > 0")


def sound(s: str = "s", bank: str = "bank") -> Column:
    return F.when(F.col(bank).isNotNull() & F.col(s).isNotNull(), F.concat(bank, F.lit("_"), s)).otherwise(F.col(s))


def telemetry(events: DataFrame, cycles: int) -> DataFrame:
    """Counts, rates, sounds, pitches, syncopation and gains of each program's audible events."""
    heard = events.where(audible())
    quarter = F.col("begin_at") * 4
    off, gain = F.abs(quarter - F.rint(quarter)) > 1e-6, F.coalesce("gain", F.lit(1.0))
    return heard.groupBy("program_id").agg(
        F.count(F.lit(1)).alias("event_count"), (F.count(F.lit(1)) / F.lit(float(cycles))).alias("events_per_cycle"), F.array_sort(F.collect_set(sound())).alias("sound_sources"),
        F.array_sort(F.collect_set("note")).alias("pitches"), F.min("note").alias("pitch_lo"), F.max("note").alias("pitch_hi"), (F.count_if(off) / F.count(F.lit(1))).alias("syncopation"),
        F.min(gain).alias("gain_min"), F.max(gain).alias("gain_max"),
    )


def fingerprints(events: DataFrame, cycles: int) -> DataFrame:
    """(program_id, cycle, print, controls): hashes of what each non-empty cycle plays, by structural and by all controls."""
    heard = events.where(audible()).withColumn("cycle", F.floor("begin_at").cast("int")).where((F.col("cycle") >= 0) & (F.col("cycle") < cycles))
    decimals = lambda c: F.format_string("%.6f", F.round(c, 6))
    times = F.concat_ws(",", decimals(F.col("begin_at") - F.col("cycle")), decimals(F.col("end_at") - F.col("begin_at")))
    entries = F.array_sort(F.map_entries("controls"))
    text = lambda es: F.concat_ws(",", times, F.array_join(F.transform(es, lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("null")))), ","))
    tokens = heard.select("program_id", "cycle", text(F.filter(entries, lambda e: e["key"].isin(*STRUCTURAL))).alias("core"), text(entries).alias("both"))
    digest = lambda c: F.sha2(F.array_join(F.array_sort(F.collect_list(c)), "|"), 256)
    return tokens.groupBy("program_id", "cycle").agg(digest("core").alias("print"), digest("both").alias("controls"))


def variation(prints: DataFrame, cycles: int) -> DataFrame:
    """Distinct fingerprints over cycles, an empty cycle counting as one of its own."""
    empty = F.when(F.count(F.lit(1)) < cycles, 1).otherwise(0)
    share = lambda c: (F.count_distinct(c) + empty) / F.lit(float(cycles))
    return prints.groupBy("program_id").agg(share("print").alias("structural_variation"), share("controls").alias("control_variation"), F.count(F.lit(1)).alias("active_cycles"))


def evolution(prints: DataFrame, cycles: int, size: int = 8) -> DataFrame:
    """The same by tumbling groups of ``size`` cycles; the last one may be short, empty ones count once."""
    n_windows = -(-cycles // size)
    length = lambda w: F.least(F.lit(size), F.lit(cycles) - w * size)
    by = prints.groupBy("program_id", F.floor(F.col("cycle") / size).cast("int").alias("window")).agg(F.count_distinct("print").alias("n"), F.count(F.lit(1)).alias("full"))
    frame = prints.select("program_id").distinct().select("program_id", F.explode(F.sequence(F.lit(0), F.lit(n_windows - 1))).alias("window"))
    got = frame.join(by, ["program_id", "window"], "left").fillna(0, ["n", "full"])
    return got.select("program_id", "window", ((F.col("n") + F.when(F.col("full") < length(F.col("window")), 1).otherwise(0)) / length(F.col("window"))).alias("variation"))


def sections(events: DataFrame, cycles: int, parts: int = 4) -> DataFrame:
    """Onsets and distinct sounds of each of ``parts`` equal slices of a program's ``cycles``; events outside them don't count."""
    heard = events.where(audible()).where((F.col("begin_at") >= 0) & (F.col("begin_at") < cycles)).withColumn("part", F.least(F.lit(parts - 1), F.floor(F.col("begin_at") * parts / cycles)))
    one = lambda k: F.struct(F.count_if(F.col("part") == k).alias("onsets"), F.array_sort(F.collect_set(F.when(F.col("part") == k, sound()))).alias("sounds"))
    return heard.groupBy("program_id").agg(F.array(*(one(k) for k in range(parts))).alias("sections"))


def pitch_class(note: Column) -> Column:
    return F.pmod(F.bround(note, 0).cast("int"), F.lit(12))


def scale_adherence(events: DataFrame, keys: DataFrame) -> DataFrame:
    """Share of a program's pitched audible onsets that lie in its key; null without a key, 0 without pitches. Bare scalars don't count."""
    notes = events.where(audible()).where("note IS NOT NULL AND NOT scalar").groupBy("program_id", pitch_class(F.col("note")).alias("pc")).agg(F.count(F.lit(1)).alias("n"))
    joined = keys.select("program_id", scale_mask("key").alias("mask")).join(notes, "program_id", "left")
    inside = F.call_function("getbit", F.col("mask"), F.coalesce("pc", F.lit(0))) == 1
    return joined.groupBy("program_id").agg(F.when(F.max("mask").isNotNull(), F.coalesce(F.sum(F.when(inside, F.col("n")).otherwise(0)) / F.sum("n"), F.lit(0.0))).alias("adherence"))


def pitch_classes(events: DataFrame) -> DataFrame:
    """(program_id, classes): how many pitched audible onsets each of the at most twelve pitch classes has; bare scalars don't count."""
    notes = events.where(audible()).where("note IS NOT NULL AND NOT scalar").groupBy("program_id", pitch_class(F.col("note")).alias("pc")).agg(F.count(F.lit(1)).alias("n"))
    return notes.groupBy("program_id").agg(F.array_sort(F.collect_list(F.struct("pc", "n"))).alias("classes"))


def scale_fit(pitches: Column) -> Column:
    """Largest share of distinct pitches that one of the 84 scales holds."""
    classes = F.transform(pitches, pitch_class)
    masks = F.array(*map(F.lit, all_scale_masks()))
    inside = lambda m: F.size(F.filter(classes, lambda c: F.call_function("getbit", m, c) == 1))
    return F.array_max(F.transform(masks, lambda m: inside(m) / F.size(classes)))


def infer_role(sounds: str, highest: str, rate: str) -> Column:
    names = F.transform(sounds, lambda x: F.element_at(F.split(x, "_"), -1))
    some = lambda *x: F.arrays_overlap(names, F.array(*map(F.lit, x))) & F.col(highest).isNull()
    ladder = (
        (some("bd", "sd", "cp"), "drums_core", 0.95), (some("hh", "oh", "sh", "rim", "rd", "cr"), "perc_tops", 0.9), (F.col(highest) <= 55, "bass", 0.8),
        (F.col(highest).isNotNull() & (F.col(rate) >= 8), "arp_lead", 0.65), (F.col(highest).isNotNull(), "chords_pad", 0.55), (F.lit(True), "fx_texture", 0.5),
    )
    return F.coalesce(*(F.when(hit, F.struct(F.lit(role).alias("role"), F.lit(c).alias("confidence"))) for hit, role, c in ladder))


def instruments(events: DataFrame, cycles: int) -> DataFrame:
    """Events, first start and sounding time of each instrument; a bank's drums are one."""
    name = F.when(F.col("bank").isNotNull(), F.concat("bank", F.lit(" drums"))).otherwise(F.col("s"))
    length = F.greatest(F.lit(0.0), F.least(F.col("end_at") - F.col("begin_at"), F.lit(float(cycles)) - F.col("begin_at")))
    return events.groupBy("program_id", name.alias("instrument")).agg(F.count(F.lit(1)).alias("n"), F.min("begin_at").alias("first"), F.round(F.sum(length), 6).alias("sounding"))


def run_status(events: DataFrame, catalog: DataFrame, cap: int = 20_000) -> DataFrame:
    """Verdict on each program's run: too many events, nothing audible, unknown sounds, or ok."""
    known = catalog.select("sound", F.lit(True).alias("known"))
    by = events.groupBy("program_id", F.col("s").alias("sound")).agg(F.count(F.lit(1)).alias("n"), F.count_if(audible()).alias("heard"))
    got = by.join(known, "sound", "left").groupBy("program_id").agg(F.sum("n").alias("n"), F.sum("heard").alias("heard"), F.count_if(F.col("known").isNull() & F.col("sound").isNotNull()).alias("unknown"))
    return got.select("program_id", "n", F.when(F.col("n") > cap, "event_cap").when(F.col("heard") == 0, "silent").when(F.col("unknown") > 0, "unknown_sound").otherwise("ok").alias("status"))
