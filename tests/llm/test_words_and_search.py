"""Spelling variants, byte-level BPE and lexical search against brute force."""

import base64
import collections
import math
import random
import re

import duckdb
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from millrace.llm import byte_pairs, lexical_search, spelling
from tests.llm.conftest import prose

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


# --- spelling


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    same = 0
    while same < min(len(a), len(b)) and a[same] == b[same]:
        same += 1
    return a[same + 1 :] == b[same + (len(a) == len(b)) :] if len(a) >= len(b) else a[same:] == b[same + 1 :]


def expect_variants(n):
    form = {}
    for w in n:
        best = min(((-n[v], v) for v in n if near(w, v)), default=None)
        form[w] = best[1] if best and -best[0] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], sum(near(w, v) for v in n), n.get(form[w])))
    return out


def variants(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@pytest.mark.parametrize(("alphabet", "longest"), [("ab", 9), ("aéÿ", 7), ("abcdefgh", 6)])
def test_variants_of_dense_words(spark, alphabet, longest):
    rng = random.Random(longest)
    n = {}
    for _ in range(150):
        n["".join(rng.choice(alphabet) for _ in range(rng.randint(5, longest)))] = rng.choice([3, 4, 6, 8, 17, 40])
    words = spark.createDataFrame(list(n.items()), "word string, n bigint")
    assert variants(spelling.variants(words.repartition(7))) == expect_variants(n)


def test_variants_of_any_characters_and_very_long_words(spark):
    long = "".join(random.Random(3).choice("xyz") for _ in range(20_000))
    n = {"": 5, "a": 4, "ab": 9, "漢": 3, "漢字": 8, "😀漢字": 20, "abcd": 5, "abce": 20, "aabbce": 3, "abbce": 9, long: 3, long[:-1]: 9, long[:700] + long[701:]: 4, "w" + long[1:]: 2}
    assert variants(spelling.variants(spark.createDataFrame(list(n.items()), "word string, n bigint"))) == expect_variants(n)


def test_words_are_whole_runs(spark, awkward, nothing):
    counts = collections.Counter()
    for r in awkward.collect():
        counts.update(w for w in re.findall("[A-Za-zÀ-ÿ]+", lower(r.text)) if len(w) >= 5)
    got = {r.word: r.n for r in spelling.word_counts(awkward).collect()}
    assert got == {w: k for w, k in counts.items() if k >= 3}
    assert variants(spelling.variants(spelling.word_counts(awkward))) == expect_variants(got)
    assert spelling.variants(spelling.word_counts(nothing)).count() == 0


def test_planted_misspellings(spark, awkward):
    import zlib

    for r in awkward.select("doc_id", F.explode(F.array([F.lit(w) for w in ("gravel", "wénché", "basalt" * 50)])).alias("w")).select("doc_id", "w", spelling.misspelt(F.col("doc_id"), F.col("w")).alias("to")).collect():
        h = zlib.crc32(f"{'' if r.doc_id is None else r.doc_id}:{r.w}".encode())
        at = h % len(r.w)
        assert r.to == (r.w[:at] + r.w[at + 1 :] if h % 97 == 0 else r.w)
    ids = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("meadow").alias("w"))
    changed = ids.select(spelling.misspelt(F.col("doc_id"), F.col("w")).alias("to"), "doc_id").where("to <> 'meadow'").collect()
    assert 10 < len(changed) < 60 and all(len(r.to) == 5 for r in changed)


# --- byte pairs


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def own():
    return byte_pairs.Encoder(RANKS, PATTERN)


def test_every_token_encodes_to_itself(own):
    assert all(own._merge(t) == [r] == own.leaf(t) for t, r in own.ranks.items())


def test_trees_equal_the_library(own, library):
    rng = random.Random(5)
    for n in (1, 2, 63, 64, 65, 130, 1000, 10_007):
        for letters in ("ab", "x", " ", "\n ", "-=", "01", "é漢 ", "abcdefghijklmnop", "the and of", "\x00\x85\xa0", "<|endoftext|>"):
            text = "".join(rng.choice(letters) for _ in range(n))
            assert own.encode(text) == library.encode_ordinary(text)


def test_joins_equal_whole_merges(own):
    rng = random.Random(6)
    for _ in range(300):
        data = bytes(rng.choice(b"abc  eeth\xc3\xa9-") for _ in range(rng.randint(2, 200)))
        k = rng.randint(1, len(data) - 1)
        assert own.join(own._merge(data[:k]), own._merge(data[k:])) == own._merge(data)


def test_a_million_equal_characters(own):
    for c in " -x\té":
        assert own.reduce((c * 1_000_000).encode()) == own._merge((c * 1_000_000).encode())


def test_long_texts_are_cut_between_words(own, library):
    for text in (prose(60_000, 9), prose(40_000, 9) + " " * 300 + prose(10, 2), "x" * 600_000 + " y", " a" * 300_000, "z " * 300_000):
        whole = library.encode_ordinary(text) if len(text) < 590_000 else [i for p in own.pattern.findall(text) for i in own.pre_token(p)]
        assert own.encode(text) == whole and own._bytes(whole).decode() == text


def test_columns_of_ids(spark, awkward, nothing, library):
    both = byte_pairs.encoded(awkward, RANKS, PATTERN).collect()
    texts = {r.doc_id: r.text for r in awkward.collect() if r.doc_id is not None}
    assert len(both) == awkward.count()
    for r in both:
        if r.doc_id is not None:
            assert r.ids == library.encode_ordinary(texts[r.doc_id] or "") and bytes(r.decoded) == (texts[r.doc_id] or "").encode()
    assert byte_pairs.encoded(nothing, RANKS, PATTERN).count() == 0
    lists = spark.createDataFrame([(None,), ([],), ([220, 198],)], "ids array<int>")
    assert [r.t and bytes(r.t) for r in lists.select(byte_pairs.decode("ids", RANKS, PATTERN).alias("t")).collect()] == [None, b"", b" \n"]


# --- lexical search


def expect_ranks(docs, items, top=10):
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    held = [(d, collections.Counter(term.findall(lower(t)))) for d, t in docs]
    N, L = sum(bool(c) for _, c in held), sum(sum(c.values()) for _, c in held)
    df = collections.Counter(t for _, c in held for t in c)
    out = []
    for item, text in sorted(set((i, t) for i, t in items if t)):
        scores = []
        for d, c in held:
            m = 25 + (75 * sum(c.values()) * N) // max(L, 1)
            s = sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in term.findall(lower(text)) if c[t])
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out += [(item, k, None if unknown else d, -s) for k, (s, unknown, d) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


def ranks(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


ITEMS = [(1, "ashbay cotdew"), (1, "ashbay cotdew"), (2, None), (3, ""), (4, "nosuchterm"), (5, prose(50, 1)), (6, "ASHbay, gap-ivy hutjet hutjet!"), (7, "漢字 word"), (8, prose(30, 2)), (None, "word")]


def test_search_awkward_documents(spark, awkward, nothing):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = [(r.doc_id, r.text) for r in awkward.collect()]
    expected = expect_ranks(docs, [(i, t) for i, t in ITEMS if i is not None])
    got = ranks(lexical_search.search(awkward, items))
    assert [r for r in got if r[0] is not None] == expected
    assert [r for r in ranks(lexical_search.search(awkward, items, block_bytes=100)) if r[0] is not None] == expected
    assert lexical_search.search(nothing, items).count() == 0
    assert lexical_search.search(awkward, items.where("false")).count() == 0


@pytest.mark.parametrize("parts", [1, 5])
def test_search_prunes_nothing_that_counts(spark, monkeypatch, parts):
    monkeypatch.setattr(lexical_search, "BUCKET", 16)
    rng = random.Random(parts)
    docs = [(k, prose(rng.choice([3, 10, 40, 200]), rng.randint(0, 150)) + " hot" * rng.choice([0, 1, 30])) for k in range(400)]
    docs += [(1000 - k, docs[7][1]) for k in range(30)]
    items = [(k, prose(8, k) + " hot") for k in range(20)] + [(99, docs[7][1])]
    found = lexical_search.search(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(parts), spark.createDataFrame(items, "item_id bigint, text string"))
    assert ranks(found) == expect_ranks(docs, items)


def test_buckets_leave_out_what_cannot_reach(spark):
    docs = spark.createDataFrame([(k, prose(30, k)) for k in range(200)], "doc_id bigint, text string")
    items = lexical_search.Items([(1, prose(10, 3).split())])
    table = lexical_search.vectors(docs, items)
    rows = table.where(F.size("terms") > 0).toPandas()
    weights = lexical_search.Weights(items, 200, int(rows.n.sum()), {})
    import numpy as np

    at = np.cumsum([0, *map(len, rows.terms)])
    terms, times = np.concatenate(rows.terms.to_list()), np.concatenate(rows.times.to_list())
    norm = np.array([math.sqrt(sum((weights.root[t] * 1e6) ** 2 for t in ts)) for ts in rows.terms])
    bucket = lexical_search.Bucket(rows.doc_id.to_list(), rows.n.to_numpy(), norm, terms, times, at, weights)
    own, often = items.counts[0]
    every, scores = bucket.search(own, often, weights, 0, 1000)
    assert len(every) == len(rows)
    few, best = bucket.search(own, often, weights, int(scores.max()), 10)
    assert best.max() == scores.max() and len(few) < len(every) // 4
    assert not len(bucket.search(own, often, weights, int(scores.max()) * 1000, 10)[0])


@pytest.mark.parametrize("name", ["op11_spelling_variants", "op13_lexical_search"])
def test_twins(spark, name):
    from millrace.llm.queries import ORACLES, QUERIES
    from tests.test_queries import DIR, rows

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    assert rows(QUERIES[name](spark, DIR).toPandas()) == rows(con.execute(ORACLES[name]).df())
