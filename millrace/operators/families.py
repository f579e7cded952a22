"""Sounds, the families that hold them, and drum banks.

``family_sound`` (family, sound) lists exact names, ``family_kit`` (family, suffix) drum
pieces that any bank may have, ``low`` the families that a low pitch also shows. A name
that starts with ``gm_`` is never a drum piece. The tables are short registries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOW_NOTE = 48


def sound_families(sounds: DataFrame, family_sound: DataFrame, family_kit: DataFrame) -> DataFrame:
    """Distinct (sound, family) of the rows' sounds, by exact name or by drum piece."""
    every = sounds.select("sound").distinct()
    exact = every.join(family_sound, "sound")
    piece = every.where(~F.startswith("sound", F.lit("gm_"))).withColumn("suffix", F.element_at(F.split("sound", "_"), -1)).join(family_kit, "suffix")
    return exact.select("sound", "family").unionByName(piece.select("sound", "family")).distinct()


def present_families(programs: DataFrame, families: DataFrame, low: list[str]) -> DataFrame:
    """program_id and the sorted families of its sound_sources, with those that a pitch up to 48 shows."""
    heard = programs.select("program_id", F.explode("sound_sources").alias("sound")).join(families, "sound").groupBy("program_id").agg(F.collect_set("family").alias("f"))
    deep = F.when(F.col("pitch_lo") <= LOW_NOTE, F.array(*map(F.lit, low))).otherwise(F.array().cast("array<string>"))
    joined = programs.join(heard, "program_id", "left")
    return joined.select("program_id", F.array_sort(F.array_union(F.coalesce("f", F.array().cast("array<string>")), deep)).alias("families"))


def voice_counts(programs: DataFrame, families: DataFrame, named: DataFrame) -> DataFrame:
    """Parts of each program: a sound counts under the first named family that holds it, else under drums, else alone.

    ``named``: (program_id, family, priority).
    """
    sounds = programs.select("program_id", F.explode("sound_sources").alias("sound"))
    drums = programs.select("program_id", F.lit("drums").alias("family"), F.lit(1 << 30).alias("priority"))
    groups = named.select("program_id", "family", "priority").unionByName(drums)
    first = sounds.join(families, "sound").join(groups, ["program_id", "family"]).groupBy("program_id", "sound").agg(F.min_by("family", "priority").alias("part"))
    parts = sounds.join(first, ["program_id", "sound"], "left").select("program_id", F.coalesce("part", "sound").alias("part"))
    counted = parts.groupBy("program_id").agg(F.count_distinct("part").alias("voices"))
    return programs.select("program_id").join(counted, "program_id", "left").fillna(0, ["voices"])


def drum_banks(names: DataFrame, *, name: str = "name") -> DataFrame:
    """Banks and their sorted pieces: names with ``_`` but not ``gm_``, split at the last one."""
    at = r"^(.*)_([^_]+)$"
    split = names.where(F.regexp_like(name, F.lit(at)) & ~F.startswith(name, F.lit("gm_")))
    return split.groupBy(F.regexp_extract(name, at, 1).alias("bank")).agg(F.array_sort(F.collect_set(F.regexp_extract(name, at, 2))).alias("pieces"))
