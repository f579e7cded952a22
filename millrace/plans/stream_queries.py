"""Queries of :mod:`millrace.streaming`, :mod:`millrace.sources` and :mod:`millrace.functions.records`."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from millrace.functions import records as R
from millrace.operators.tables import scratch
from millrace.plans.registry import query, raw_query
from millrace.plans.views import view
from millrace.sources import records as S
from millrace.streaming import journals as J


def _events(spark, sf_dir):
    """The event table as a stream of files."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*")


def _done(started) -> None:
    started.awaitTermination()


@raw_query("SELECT DISTINCT user_id AS task_id, event_type AS model_id FROM events")
def str1_journal_ingest(spark, sf_dir):
    """Each (task, model) of the stream once, in a parquet sink."""
    out = scratch(spark)
    stream = _events(spark, sf_dir).select(F.col("user_id").alias("task_id"), F.col("event_type").alias("model_id"))
    _done(J.ingest(stream, f"{out}/rows", f"{out}/state", keys=["task_id", "model_id"]))
    return spark.read.schema(stream.schema).parquet(f"{out}/rows")


def _instant(ts: str):
    """A time without a zone, read as UTC whatever the session's zone is."""
    return F.expr(f"CAST(convert_timezone('UTC', current_timezone(), {ts}) AS timestamp)")


def _wall_clock(instant: str):
    return F.expr(f"convert_timezone(current_timezone(), 'UTC', CAST({instant} AS timestamp_ntz))")


def _by_time(rows, folder: str, again, parts: int = 4):
    """Write ``rows`` to ``folder`` in parts by equal ranges of ts, each with those rows of ``again(part)`` beside it; yield after each."""
    low, high = rows.select(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    part = F.lit(0)
    for k in range(1, parts if low is not None else 1):
        part = part + F.when(F.unix_micros("ts") > low + (high - low) * k // parts, 1).otherwise(0)
    dealt = rows.withColumn("part", part)
    for k in range(parts):
        again(dealt, k).drop("part").write.mode("append").parquet(folder)
        yield k


@raw_query("SELECT event_id, user_id AS task_id, event_type AS model_id, ts FROM events")
def str1_restarted_ingest(spark, sf_dir):
    """A journal in four parts by time, each run stopped and started again from its checkpoint; a third of a part's rows come again with the next one."""
    out = scratch(spark)
    rows = view(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("task_id"), F.col("event_type").alias("model_id"), _instant("ts").alias("ts"))
    again = lambda dealt, k: dealt.where((F.col("part") == k) | ((F.col("part") == k - 1) & (F.col("event_id") % 3 == 0)))
    for _ in _by_time(rows, f"{out}/in", again):
        stream = spark.readStream.schema(rows.schema).parquet(f"{out}/in")
        _done(J.ingest(stream, f"{out}/rows", f"{out}/state", keys=["event_id"], time="ts", delay="1 hour"))
    return spark.read.schema(rows.schema).parquet(f"{out}/rows").withColumn("ts", _wall_clock("ts"))


@raw_query("SELECT event_type AS model_id, count(*) AS attempts, count(*) FILTER (value > 100) AS accepted, greatest(0, 1500 - count(*) FILTER (value > 100)) AS shortfall FROM events GROUP BY event_type")
def str2_running_progress(spark, sf_dir):
    out = scratch(spark)
    targets = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_type").alias("model_id")).distinct().withColumn("target", F.lit(1500))
    stream = _events(spark, sf_dir).select(F.col("event_type").alias("model_id"), (F.col("value") > 100).alias("accepted"))
    got = J.running_progress(stream, targets).drop("target")

    def work(batch, number):
        batch.write.mode("overwrite").parquet(f"{out}/progress")

    _done(got.writeStream.outputMode("complete").foreachBatch(work).option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start())
    return spark.read.parquet(f"{out}/progress")


def _arrivals(rows, key: str, folder: str, parts: int = 4):
    """Write ``rows`` to ``folder`` in parts by equal ranges of ``key``, one after the other, and yield after each."""
    low, high = rows.select(F.min(key), F.max(key)).first()
    part = F.lit(0)
    for k in range(1, parts if low is not None else 1):
        part = part + F.when(F.col(key) > low + (high - low) * k // parts, 1).otherwise(0)
    for k in range(parts):
        rows.where(part == k).write.mode("append").parquet(folder)
        yield k


@raw_query()
def str3_accept_first(spark, sf_dir):
    """Requests that arrive in four parts, accepted batch by batch; arrival is by id, so the rows are those that batch acceptance gives."""
    out = scratch(spark)
    rows = view(spark, sf_dir, "requests_v").select("id", "prompt")
    for _ in _arrivals(rows, "id", f"{out}/in"):
        stream = spark.readStream.schema(rows.schema).parquet(f"{out}/in")
        _done(J.each_batch(stream, f"{out}/state", J.accept_into(f"{out}/bank")))
    return spark.read.schema(rows.schema).option("recursiveFileLookup", True).parquet(f"{out}/bank").select("id")


@raw_query("""WITH b AS (SELECT min(event_id) AS lo, max(event_id) - min(event_id) AS n FROM events),
p AS (SELECT event_id AS id, user_id AS prompt_id, (event_id > lo + n // 4)::int + (event_id > lo + n * 2 // 4)::int + (event_id > lo + n * 3 // 4)::int AS part FROM events, b)
SELECT id, prompt_id FROM p QUALIFY part = min(part) OVER (PARTITION BY prompt_id)""")
def str4_periodic_export(spark, sf_dir):
    """Events that arrive in four parts: those of users whom no earlier part has."""
    out = scratch(spark)
    rows = view(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("user_id").alias("prompt_id"))
    for _ in _arrivals(rows, "id", f"{out}/in"):
        stream = spark.readStream.schema(rows.schema).parquet(f"{out}/in")
        _done(J.each_batch(stream, f"{out}/state", J.export_into(f"{out}/rows")))
    return spark.read.schema(rows.schema).option("recursiveFileLookup", True).parquet(f"{out}/rows")


@query("SELECT time_bucket(INTERVAL 1 DAY, ts) AS start, component, count(*) AS n, round(avg(total), 6) AS mean FROM <rollouts_v> GROUP BY ALL")
def str5_rollout_monitor(v):
    return J.rollout_monitor(v("rollouts_v")).withColumn("mean", F.round("mean", 6))


@raw_query("""WITH b AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) - min(epoch_us(ts)) AS n FROM events),
r AS (SELECT *, (epoch_us(ts) > lo + n // 4)::int + (epoch_us(ts) > lo + n * 2 // 4)::int + (epoch_us(ts) > lo + n * 3 // 4)::int AS part, time_bucket(INTERVAL 6 HOUR, ts) AS start FROM <rollouts_v>, b),
told AS (SELECT *, part = 0 AND ordinal % 5 = 0 AS held_back FROM r), mark AS (SELECT max(ts) FILTER (part < 3 AND NOT held_back) - INTERVAL 1 HOUR AS late, max(ts) - INTERVAL 1 HOUR AS done FROM told)
SELECT start, component, count(*) AS n, round(avg(total), 12) AS mean FROM told, mark WHERE (NOT held_back OR start + INTERVAL 6 HOUR > late) AND start + INTERVAL 6 HOUR <= done GROUP BY ALL""")
def str5_monitor_stream(spark, sf_dir):
    """Rollouts in four parts by time, each a run of its own: a fifth of the first part comes with the last one and is late.

    The windows that the watermark has closed at the end; each is written once.
    """
    out = scratch(spark)
    rows = view(spark, sf_dir, "rollouts_v").select(_instant("ts").alias("ts"), "component", "total", "ordinal")
    late = (F.col("part") == 0) & (F.col("ordinal") % 5 == 0)
    again = lambda dealt, k: dealt.where(((F.col("part") == k) & ~late) | (late & F.lit(k == 3)))
    for _ in _by_time(rows, f"{out}/in", again):
        stream = spark.readStream.schema(rows.schema).parquet(f"{out}/in")
        _done(J.monitor(stream, f"{out}/rows", f"{out}/state", size="6 hours"))
    return spark.read.schema("start timestamp, component string, n bigint, mean double").parquet(f"{out}/rows").select(_wall_clock("start").alias("start"), "component", "n", F.round("mean", 12).alias("mean"))


@raw_query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0")
def src1_strict_records(spark, sf_dir):
    """Orders written as JSON lines, some with an unknown field or a NaN, and read strictly."""
    out = scratch(spark)
    line = F.expr("""CASE WHEN o_orderkey % 5 = 0 THEN concat('{"o_orderkey":', o_orderkey, ',"extra":1}') WHEN o_orderkey % 7 = 0 THEN concat('{"o_orderkey":', o_orderkey, ',"o_totalprice":NaN}') ELSE to_json(struct(o_orderkey, o_totalprice)) END""")
    view(spark, sf_dir, "orders").select(line.alias("value")).write.text(f"{out}/lines")
    schema = view(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").schema
    return S.read_records(spark, f"{out}/lines", schema)[0]


@raw_query("SELECT id, prompt, stage, split FROM <requests_v>")
def src3_src4_bank_round_trip(spark, sf_dir):
    """A bank written by stage and split and read again."""
    out = scratch(spark)
    rows = view(spark, sf_dir, "requests_v").select("id", "prompt", "stage", "split")
    S.write_bank(rows, f"{out}/bank")
    return S.read_bank(spark, f"{out}/bank", rows.schema).select("id", "prompt", "stage", "split")


@raw_query("SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY l_returnflag")
def src9_fingerprint(spark, sf_dir):
    """Line items summed up, if their fingerprint is still that of the same rows in another order."""
    rows = view(spark, sf_dir, "lineitem")
    recorded = S.fingerprint(rows.repartition("l_partkey"))
    return S.require_fingerprint(rows, recorded).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@raw_query("SELECT o_orderkey, o_orderpriority FROM orders")
def src2_recovered_journal(spark, sf_dir):
    """Orders written as journals, each with an unfinished last line, and read again."""
    out = scratch(spark)
    rows = view(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    part = F.pmod("o_orderkey", F.lit(16)).alias("part")
    lines = rows.select(part, F.to_json(F.struct("o_orderkey", "o_orderpriority")).alias("line"))
    cut_off = lines.groupBy("part").agg(F.min("line").alias("line")).select("part", F.lit(1).alias("last"), F.substring("line", 1, 9).alias("line"))
    every = lines.select("part", F.lit(0).alias("last"), "line").unionAll(cut_off).repartition("part").sortWithinPartitions("part", "last")
    every.select("part", "line").write.option("lineSep", "\n").partitionBy("part").text(f"{out}/journals")
    ends = S.recover_journal(spark, f"{out}/journals", rows.schema, finished=False)
    return ends.select("o_orderkey", "o_orderpriority")


_MARKDOWN = "concat('# ', family, chr(10), chr(10), '```js', chr(10), 'a(', cast(id AS string), ')', chr(10), '```', chr(10), 'text', chr(10), '```python', chr(10), 'no', chr(10), '```', chr(10), '```js', chr(10), 'b', chr(10), 'c', chr(10), '```', chr(10))"


@query("SELECT id, 4 AS line, 'a(' || id || ')' AS code FROM <sources_v> UNION ALL SELECT id, 11 AS line, 'b' || chr(10) || 'c' AS code FROM <sources_v>")
def par3_udf5_fenced_code(v):
    return R.fenced_code(v("sources_v").select("id", F.expr(_MARKDOWN).alias("text"))).select("id", "line", "code")


@query("SELECT id, CASE WHEN id % 3 = 0 THEN family ELSE 'p' END AS code FROM <sources_v> UNION ALL SELECT id, 'second' AS code FROM <sources_v> WHERE id % 2 = 0")
def par4_json_examples(v):
    one = "concat('{\"code\":\"', CASE WHEN id % 3 = 0 THEN family ELSE '' END, '\",\"pattern\":\"p\"}')"
    text = F.expr(f"CASE WHEN id % 2 = 0 THEN concat('[', {one}, ',{{\"pattern\":\"second\"}},{{\"code\":\" \"}}]') ELSE {one} END".replace("{{", "{").replace("}}", "}"))
    return R.json_examples(v("sources_v").select("id", text.alias("text"))).select("id", "code")


def _find_words():
    """Loads, in a worker, what splits a text."""
    found = re.compile(r"[^ \t\n\r\f\v]+").findall
    return lambda text: len(found(text))


@query(r"SELECT doc_id, len(regexp_extract_all(text, '\S+')) AS n, len(regexp_extract_all(text, '\S+')) AS counted FROM documents")
def udf1_token_counter(v):
    """Any function that makes tokens of a text can be counted with; here words."""
    return v("documents").select("doc_id", R.word_tokens("text").cast("bigint").alias("n"), R.token_counter(_find_words)("text").alias("counted"))


@query("""SELECT doc_id, sha256('{"a": ' || doc_id || ', "b": "' || source || '"}') AS h FROM documents""")
def udf6_canonical_hash(v):
    return v("documents").select("doc_id", R.canonical_hash()(F.to_json(F.struct(F.col("source").alias("b"), F.col("doc_id").alias("a")))).alias("h"))


@raw_query("SELECT cast(o_orderkey AS varchar) AS o_orderkey, o_orderpriority AS name FROM orders WHERE o_orderkey % 3 <> 0")
def src6_src7_csv_round_trip(spark, sf_dir):
    """Orders written as CSV, some with a blank name, and read with both columns required."""
    out = scratch(spark)
    name = F.when(F.col("o_orderkey") % 3 == 0, " ").otherwise(F.col("o_orderpriority"))
    S.write_csv(view(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("o_orderkey"), name.alias("name")), f"{out}/csv")
    return S.read_required_csv(spark, f"{out}/csv", ["o_orderkey", "name"])[0]


@raw_query("SELECT source || '.json' AS name, CASE WHEN source = 'src3' THEN 'changed' WHEN count(*) > 0 AND source = 'src4' THEN 'missing' ELSE 'ok' END AS status FROM documents GROUP BY source")
def src8_pinned_files(spark, sf_dir):
    """A file for each source, checked against a manifest of which two entries don't fit."""
    out = scratch(spark)
    texts = view(spark, sf_dir, "documents").groupBy("source").agg(F.count(F.lit(1)).cast("string").alias("value"))
    texts.where("source <> 'src4'").repartition("source").write.partitionBy("source").text(f"{out}/files")
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(f"{out}/files")
    named = found.select(F.col("source"), F.sha2("content", 256).alias("digest"), "length")
    manifest = texts.select("source", F.sha2(F.concat(F.when(F.col("source") == "src3", "x").otherwise(F.col("value")), F.lit("\n")), 256).alias("sha256"))
    return S.file_status(manifest, named, "source").select(F.concat("source", F.lit(".json")).alias("name"), "status")
