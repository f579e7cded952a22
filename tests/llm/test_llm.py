"""Each operator against brute force on small tables with awkward rows."""

import collections
import hashlib
import re

import duckdb
import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import decontaminate, graph, licenses, line_dedup, quality, simhash, source_mix, substring_dedup, token_counts, toxicity, url_filter
from millrace.llm.gru import BiGru
from tests.llm.conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(t):
    return WORD.findall(t or "")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def pairs(df):
    """Rows of doc_id and text, in the order of the table."""
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id bigint, quality int, toxic int")


# --- licenses


def expect_license(t):
    w = [x for x in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))]
    hits = []
    for phrase, label in licenses.PHRASES:
        p = phrase.split()
        hits += [(i, label) for i in range(len(w)) if w[i : i + len(p)] == p]
    return len(w), len(hits), min((i for i, _ in hits), default=None), max((i for i, _ in hits), default=None), ",".join(sorted({x for _, x in hits}))


def test_license_base_columns(awkward):
    got = licenses.scan_licenses(awkward).select("text", "licenses.*").collect()
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == expect_license(r.text)
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))


@pytest.mark.parametrize(
    ("text", "labels_"),
    [
        ("SPDX-License-Identifier: BSD-3-Clause", "bsd"), ("see https://creativecommons.org/licenses/by-nc/4.0", "cc-by-nc"), ("under the GNU Lesser General Public License", "gpl,lgpl"),
        ("the Mozilla Public License 2.0 and the ISC licence", "isc,mpl"), ("no rights at all", ""), ("This is free and unencumbered software released into the public domain", "unlicense"),
    ],
)
def test_license_rules(spark, text, labels_):
    assert licenses.scan_licenses(spark.createDataFrame([(text,)], "text string")).first().licenses.labels == labels_


def test_license_suppression_and_empty(spark, nothing):
    spans = licenses.scan_licenses(spark.createDataFrame([("Licensed under the MIT License",)], "text string")).first().licenses.spans
    assert [s.label for s in spans] == ["mit"]
    assert licenses.scan_licenses(nothing).count() == 0
    clash = spark.createDataFrame([("MIT License", 1, 2, 3)], "text string, licenses int, millrace_words int, millrace_words_ int")
    row = licenses.scan_licenses(clash).first()
    assert row.licenses_.n_base == 1 and (row.licenses, row.millrace_words, row.millrace_words_) == (1, 2, 3)


# --- quality


def expect_counts(t):
    w, seen, dup = words(t), set(), 0
    for line in (t or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
    n = collections.Counter(windows)
    covered = {j for k, x in enumerate(windows) if n[x] > 1 for j in range(k, k + 8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(covered)


def test_quality_counts(spark, awkward, nothing):
    got = quality.quality_rules(awkward, labels(spark)).select("text", "quality_rules.*").collect()
    for r in got:
        e = expect_counts(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == e
        assert r.base_failed == (e[0] < 20 or 100 * e[4] > 30 * e[0]) and r.kept == (not r.base_failed)
    assert quality.keep(nothing, labels(spark)).columns == nothing.columns
    assert quality.quality_rules(nothing, labels(spark)).count() == 0


def test_quality_forest_tells_symbols_from_prose(spark):
    rows = [(i, prose(80, i) if i % 4 else " ".join(w + "###" for w in prose(60, i).split())) for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    marked = labels(spark, [(i, int(i % 4 > 0), None) for i in range(0, 240, 2)] + [(None, 1, 0), (999, 0, 0)])
    kept = {r.doc_id for r in quality.keep(docs, marked).collect()}
    assert sum(i in kept for i in range(240) if i % 4) >= 178 and sum(i in kept for i in range(0, 240, 4)) <= 3


# --- line dedup


def expect_removed(rows):
    """Lines to remove by document, by comparing all pairs of lines."""
    places = collections.defaultdict(list)
    for i, t in {(i, t) for i, t in rows if t is not None}:
        key = (i if i is not None else line_dedup.LAST, xxhash.xxh64_intdigest(t.encode(), 42) - ((xxhash.xxh64_intdigest(t.encode(), 42) >> 63) << 64))
        for n, line in enumerate(t.split("\n")):
            if line.strip(" \t\r\x0b\x0c"):
                places[line].append((*key, n))
    lines = list(places)
    sets = [{x[k : k + 5] for k in range(max(len(x) - 4, 1))} for x in lines]
    root = list(range(len(lines)))
    for a in range(len(lines)):
        for b in range(a):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) and sets[a]:
                old, new = root[a], root[b]
                root = [new if r == old else r for r in root]
    out = collections.defaultdict(set)
    for r in set(root):
        every = sorted(p for k, x in enumerate(lines) if root[k] == r for p in places[x])
        for doc, h, n in every:
            if (doc, h, n) != every[0]:
                out[doc, h].add(n)
    return out


def test_lines(awkward, nothing):
    got = {(r.doc, r.text_hash): set(r.removed) for r in line_dedup.removed_lines(awkward).collect()}
    assert got == expect_removed(pairs(awkward))
    table = line_dedup.line_dedup(awkward)
    assert table.count() == awkward.count()
    kept = line_dedup.keep_lines(awkward)
    assert kept.columns == awkward.columns
    assert line_dedup.keep_lines(nothing).count() == 0 and line_dedup.line_dedup(nothing).count() == 0


def test_lines_of_large_buckets(spark):
    base = prose(40, 1).split()
    rows = [(i, " ".join(base[:i] + ["changed" + str(i)] + base[i + 1 :])) for i in range(40)] + [(99, prose(40, 2))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    removed = {r.doc_id for r in line_dedup.line_dedup(docs, pairs_up_to=4).where("n_removed > 0").collect()}
    assert removed == set(range(1, 40))


def test_components(spark):
    edges = [(a, a + 1) for a in range(0, 60) if a % 20 != 19] + [(100, 5), (5, 100), (7, 7)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got[x] == x // 20 * 20 for x in range(60)) and got[100] == 0
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# --- simhash


def expect_print(t):
    w = words(lower(t))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] if w else []
    bits = [sum(xxhash.xxh64_intdigest(s.encode(), 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * bits[b] > len(shingles))


def expect_components(prints, ids):
    root = list(range(len(prints)))
    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 2 and root[a] != root[b]:
                old, new = root[a], root[b]
                root = [new if r == old else r for r in root]
    least = {r: min((i for i, q in zip(ids, root, strict=True) if q == r and i is not None), default=None) for r in root}
    return [least[r] for r in root]


def test_simhash(awkward, nothing):
    rows = pairs(awkward)
    prints = [expect_print(t) for _, t in rows]
    want = collections.Counter(zip((i for i, _ in rows), (f"{p:016x}" for p in prints), expect_components(prints, [i for i, _ in rows]), strict=True))
    assert collections.Counter(tuple(r) for r in simhash.simhash_components(awkward).collect()) == want
    kept = simhash.keep_first(awkward)
    assert kept.columns == awkward.columns
    assert collections.Counter(r.doc_id for r in kept.collect())[13] == 1
    assert simhash.keep_first(nothing).count() == 0 and simhash.simhash_components(nothing).count() == 0


def test_keep_first_with_any_columns(spark):
    rows = [(1, prose(30, 1), {"a": 1}, 1), (2, prose(30, 1), {"a": 2}, 2), (2, prose(30, 1), {"a": 3}, 3), (3, prose(30, 2), None, 4), (None, None, {}, 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, tags map<string,int>, kept_id int").withColumns({"kept_hash": F.lit(1), "text_hash": F.lit(2), "_kept_id": F.lit(3), "x.y": F.lit(4)})
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns and sorted(r.kept_id for r in kept.collect()) == [1, 4, 5]


@pytest.mark.parametrize("pairs_up_to", [0, 3, 1000])
def test_simhash_links(spark, pairs_up_to):
    rng = np.random.default_rng(3)
    seeds = rng.integers(-(2**63), 2**63, 30)
    nodes = {int(s) for s in seeds}
    for s in seeds:
        for _ in range(8):
            nodes.add(int(s ^ np.bitwise_or.reduce(np.int64(1) << rng.integers(0, 63, rng.integers(1, 5)))))
    nodes |= {0, -1, -(2**63), 1 << 62}
    nodes = sorted(nodes)
    edges = simhash.links(spark.createDataFrame([(n,) for n in nodes], "fp bigint"), pairs_up_to)
    got = {r.node: r.root for r in graph.components(edges).collect()}
    want = expect_components([n & (2**64 - 1) for n in nodes], nodes)
    assert [got.get(n, n) for n in nodes] == want


# --- decontamination


def test_decontamination(spark, awkward, nothing):
    items = [(0, prose(25, 100)), (1, prose(120, 101)), (2, None), (None, prose(30, 9)), (3, "ab"), (4, prose(12, 102))]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    near = items[0][1].split()
    near[7] = "changed"
    rows = [
        (0, prose(30, 1) + " " + items[0][1].upper() + " " + prose(30, 2)), (1, prose(500, 3)), (2, items[1][1].replace(" ", "\n\t")), (3, " ".join(near)), (4, prose(50, 4) + items[5][1]),
        (5, " ".join(items[1][1].split()[20:90])), (6, None), (7, ""), (8, " ".join(items[0][1].split()[:8])), (None, items[0][1]),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r.doc_id, r.item_id): r.edits for r in decontaminate.contaminated(docs, bench).collect()}
    assert set(got) == {(0, 0), (2, 1), (3, 0), (4, 4), (5, 1), (None, 0)} and got[0, 0] == 0 and 0 < got[3, 0] <= 12
    blocks = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench, block_bytes=200).collect()}
    assert blocks == set(got)
    assert sorted(r.doc_id for r in decontaminate.clean(docs, bench).collect()) == [1, 6, 7, 8]
    assert decontaminate.clean(awkward, bench).columns == awkward.columns
    assert decontaminate.clean(nothing, bench).count() == 0 and decontaminate.contaminated(awkward, bench.where("false")).count() == 0


# --- token counts


def test_token_counts(awkward, nothing):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    got = token_counts.token_counts(awkward, path).collect()
    for (i, t), r in zip(pairs(awkward), got, strict=True):
        assert (r.doc_id, r.n_bytes, r.n_tokens) == (i, len((t or "").encode()), len(model.encode(t or ""))) and r.over_limit == (r.n_tokens > 4096)
    assert token_counts.token_counts(nothing, path).count() == 0
    rng = np.random.default_rng(2)
    texts = ["".join(rng.choice(list(a), n)) for a in ("ab ", "▁ x", "the\n ", "=-#", "éß漢 ") for n in (1, 7, 60, 300)]
    assert token_counts.Vocabulary(path).count(texts) == [len(x) for x in model.encode(texts)]


def test_long_runs_of_equal_ranks(monkeypatch):
    import random
    import time

    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model, own = sentencepiece.SentencePieceProcessor(model_file=path), token_counts.Vocabulary(path)
    rng = random.Random(2)
    tests = [" " * n for n in (1, 2, 13, 14, 15, 16, 29, 100, 2001)] + ["x" + " " * 999, " " * 500 + "x", "a  " * 400, " \t " * 300, "-" * 999, "\n " * 300]
    tests += ["".join(rng.choice(letters) for _ in range(700)) for letters in ("  a", " -", "-=*", "aA ", "/ ", "▁ x", "aeiou", "  \n") for _ in range(5)]
    expected = [len(x) for x in model.encode(tests)]
    assert own.count(tests) == expected
    for alone, rounds in ((0, 64), (0, 0), (10**9, 64)):  # all by sweeps, all by the queue, one merge a round
        monkeypatch.setattr(token_counts, "ALONE", alone)
        monkeypatch.setattr(token_counts, "ROUNDS", rounds)
        assert token_counts.Vocabulary(path).count(tests) == expected
    monkeypatch.undo()
    for unit in (" ", "-", "\t", "x", "= ", "a  "):
        text = unit * (1_000_000 // len(unit))
        began = time.time()
        got = own.count([text])
        assert time.time() - began < 20 and got == [len(model.encode(text))]


def test_long_runs_without_spaces():
    import time

    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model, own = sentencepiece.SentencePieceProcessor(model_file=path), token_counts.Vocabulary(path)
    rng = np.random.default_rng(5)
    runs = ["".join(rng.choice(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"), 40_000)), "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 40_000)), "ab" * 20_000, "=" * 40_000]
    began = time.time()
    assert own.count(runs) == [len(x) for x in model.encode(runs)]
    assert time.time() - began < 30


# --- substring dedup


def expect_kept(rows):
    first = {}
    rank = lambda i: line_dedup.LAST if i is None else i
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - 12):
            key = tuple(w[k : k + 13])
            first[key] = min(first.get(key, rank(i)), rank(i))
    out = []
    for i, t in rows:
        w = words(t)
        gone = {j for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < rank(i) for j in range(k, k + 13)}
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(x for j, x in enumerate(w) if j not in gone).encode()).hexdigest()))
    return collections.Counter(out)


@pytest.mark.parametrize("tree_suffixes", [1, 1 << 20])
def test_substrings(spark, awkward, nothing, tree_suffixes):
    got = substring_dedup.substring_dedup(awkward, tree_suffixes=tree_suffixes if tree_suffixes > 1 else 2000).drop("spans").collect()
    assert collections.Counter(map(tuple, got)) == expect_kept(pairs(awkward))
    shuffled = awkward.repartition(5)
    assert collections.Counter(map(tuple, substring_dedup.substring_dedup(shuffled).drop("spans").collect())) == expect_kept(pairs(awkward))
    assert substring_dedup.substring_dedup(nothing).count() == 0


def test_stable_plans(spark, tmp_path):
    spark.range(100).selectExpr("id AS doc_id", "cast(id AS string) AS text").write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    assert substring_dedup._stable(docs) and substring_dedup._stable(docs.where("doc_id > 3").select("doc_id", F.upper("text").alias("text")))
    for other in (docs.sample(0.5), docs.unionAll(docs), docs.coalesce(1), docs.repartition(3), docs.where(F.rand() < 0.5), docs.limit(5), docs.orderBy("text")):
        assert not substring_dedup._stable(other)


# --- source mix


def test_mix(awkward, nothing, tmp_path):
    got = source_mix.mix_sources(awkward).toPandas()
    table = pd.DataFrame([tuple(r) for r in awkward.select("doc_id", "text", "source").collect()], columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64"})
    con = duckdb.connect()
    con.register("documents", table)
    want = con.execute(source_mix.ORACLE).df()
    key = ["doc_id", "size", "taken"]
    a, b = (x[["doc_id", "source", "size", "source_size", "target", "taken"]].sort_values(key).reset_index(drop=True) for x in (got, want))
    assert a["taken"].tolist() == b["taken"].tolist() and np.allclose(a["target"], b["target"])
    assert (got["taken"] <= 2 * got["size"]).all() and (got["taken"] >= 0).all()
    by = got.groupby("source", dropna=False).agg(target=("target", "first"), taken=("taken", "sum"))
    assert (abs(by["target"] - by["taken"]) <= 2 * source_mix.BLOCK_WORDS + 0.02 * by["target"]).all()
    assert source_mix.mix_sources(nothing).count() == 0
    again = source_mix.mix_sources(awkward.repartition(3)).toPandas()
    assert sorted(again["taken"]) == sorted(got["taken"])


def test_mix_shards(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 90).cast("int")).alias("text"), F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").alias("source"))
    got = source_mix.mix_sources(docs, shard_words=2000).toPandas()
    by = got.groupby("source", dropna=False).agg(target=("target", "first"), taken=("taken", "sum"))
    assert (abs(by["target"] - by["taken"]) <= 0.02 * by["target"]).all() and (got["taken"] <= 2 * got["size"]).all()


# --- URL filter


def test_urls(spark):
    urls = [
        None, "", "no scheme/path", "http://", "HTTP://A.ORG/x", "http://org/", "http://org", "http://xorg/", "https://m.example.org/es/1?q#f", "https://example.org/en/12", "https://example.org/en/2", "ftp://shop.com/fr/a://b.com/de/",
        "http://shop.com/de/", "http://shop.com/de", "http://com.net/de/", "http://bad.net/a?utm_source=1", "http://bad.net/b?utm_source=2", "http://bad.net/c", "http://a.com?x=/de/",
    ]
    pages = spark.createDataFrame([(k, u, 1, 2) for k, u in enumerate([*urls, urls[8]])], "page_id bigint, url string, host int, key int")
    got = {r.page_id: r for r in url_filter.url_filter(pages, url_filter.tracked_hosts(pages)).collect()}
    rules = {k: r.rule for k, r in got.items() if r.rule}
    assert rules == {4: "org/", 5: "org/", 8: "example.org/es/", 9: "example.org/en/1", 10: "org/", 11: "com/fr/", 12: "com/de/", 19: "example.org/es/"}
    assert [got[k].verdict for k in (4, 8, 12, 13, 15, 17)] == ["allow", "block", "block", "allow", "block", "block"]
    assert (got[0].host, got[0].path, got[8].host, got[8].path, got[18].path) == ("", "", "m.example.org", "/es/1", "")
    by_joins = url_filter.url_filter(pages, url_filter.tracked_hosts(pages), most_bits=1)
    assert sorted(map(str, by_joins.collect())) == sorted(map(str, url_filter.url_filter(pages, url_filter.tracked_hosts(pages)).collect()))
    none = pages.where("false")
    assert url_filter.url_filter(none, url_filter.tracked_hosts(none)).count() == 0


def test_cascade_is_exact(spark):
    keys = spark.range(5000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"), (F.col("id") % 7 == 0).alias("listed"))
    cascade = url_filter.Cascade(keys)
    assert len(cascade.levels) >= 2
    assert keys.where(cascade.has(F.col("key")) != F.col("listed")).count() == 0
    large = url_filter.Cascade(keys, most_bits=64)
    assert not large.constant and not large.levels[0].constant
    got = {r.key for r in large.listed(keys.select("key")).collect()}
    assert got == {f"k{i}" for i in range(0, 5000, 7)}


# --- toxicity


def test_gradients():
    net = BiGru(3, 4)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rng = np.random.default_rng(0)
    x, lengths, y = rng.standard_normal((4, 5, 3)), np.array([5, 2, 0, 1]), np.array([1.0, 0, 1, 0])
    _, g = net.gradients(x, lengths, y, np.ones(4))
    for name, value in net.p.items():
        at = tuple(rng.integers(0, s) for s in value.shape)
        kept = value[at]
        value[at] = kept + 1e-6
        up = net.gradients(x, lengths, y, np.ones(4))[0]
        value[at] = kept - 1e-6
        down = net.gradients(x, lengths, y, np.ones(4))[0]
        value[at] = kept
        assert abs((up - down) / 2e-6 - g[name][at]) < 1e-6


def test_toxicity(spark, awkward, nothing):
    got = toxicity.toxicity(awkward, labels(spark)).collect()
    assert all(r.score == 0 and r.predicted == 0 for r in got) and len(got) == awkward.count()
    assert toxicity.toxicity(nothing, labels(spark)).count() == 0
    rows = [(i, prose(90, i) + (" grumblefoot " if i % 3 == 0 else " ") + prose(90, i + 5000)) for i in range(300)] + [(900, None), (901, ""), (902, "...")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    marked = labels(spark, [(i, None, int(i % 3 == 0)) for i in range(300)] + [(None, 1, 1), (5, 1, None)])
    scored = {r.doc_id: r for r in toxicity.toxicity(docs, marked).collect()}
    held = [r for i, r in scored.items() if r.held_out and i < 300]
    right = sum(r.predicted == int(r.doc_id % 3 == 0) for r in held)
    assert right >= 0.95 * len(held) and all(0 <= r.score <= 1 for r in scored.values()) and scored[901].predicted == 0


# --- pipeline


def test_pipeline(spark, tmp_path, awkward):
    import corpus_pipeline

    d = str(tmp_path)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs.unionByName(awkward.select(docs.columns)).write.parquet(f"{d}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").write.parquet(f"{d}/{t}.parquet")
    got = corpus_pipeline.run(spark, d)
    assert got.columns == ["doc_id", "source", "size", "source_size", "target", "taken"] and 0 < got.count() <= docs.count()
    assert len(corpus_pipeline.STAGES) == 5
    spark.read.parquet(f"{d}/documents.parquet").where("false").write.parquet(f"{d}/none/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{d}/{t}.parquet").where("false").write.parquet(f"{d}/none/{t}.parquet")
    assert corpus_pipeline.run(spark, f"{d}/none").count() == 0
