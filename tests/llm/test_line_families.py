import random

import pytest
import xxhash

from millrace.llm import graph, line_dedup
from millrace.llm.common import Scratch


def word(rng):
    return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6))


def test_star_family_in_large_buckets(spark):
    rng = random.Random(5)
    centre = [word(rng) for _ in range(60)]
    lines = [centre]
    for _ in range(100):
        changed = list(centre)
        for k in rng.sample(range(60), 4):
            changed[k] = word(rng)
        lines.append(changed)
    docs = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(lines)], "doc_id bigint, text string")
    assert line_dedup.line_dedup(docs).where("n_removed > 0").count() >= 95


def shingles(line):
    return {line[k : k + 5] for k in range(max(len(line) - 4, 1))}


@pytest.mark.parametrize("pairs_up_to", [1, 16, 1000])
def test_recall_of_templated_lines(spark, pairs_up_to):
    """Against all pairs: families of one template whose lines are partly similar, and others at 0.5 to 0.8."""
    rng, lines = random.Random(8), []
    for _ in range(12):
        centre = [word(rng) for _ in range(50)]
        for _ in range(25):
            changed = list(centre)
            for k in rng.sample(range(50), rng.choice([1, 2, 3, 4, 8, 12])):
                changed[k] = word(rng)
            lines.append(" ".join(changed))
    sets, root = [shingles(x) for x in lines], list(range(len(lines)))
    linked = set()
    for a in range(len(lines)):
        for b in range(a):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                linked.add((a, b))
                old, new = root[a], root[b]
                root = [new if r == old else r for r in root]
    want = {a for a in range(len(lines)) if any(root[b] == root[a] for b in range(a))}
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id bigint, text string")
    got = {r.doc_id for r in line_dedup.line_dedup(docs, pairs_up_to=pairs_up_to).where("n_removed > 0").collect()}
    assert len(linked) > 60 and got <= want and len(got) >= 0.97 * len(want)


def test_parts_of_a_bucket_meet(spark, monkeypatch):
    rng = random.Random(9)
    centre = [word(rng) for _ in range(60)]
    rows = [(i, " ".join(centre[:i] + [word(rng)] + centre[i + 1 :])) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    monkeypatch.setattr(line_dedup, "PART_LINES", 4)
    assert line_dedup.line_dedup(docs, pairs_up_to=2).where("n_removed > 0").count() == 59


def test_lines_are_read_whole(spark):
    rows = ["https://www.alpha.example/one/long/path.html", "https://www.zebra.test/q?item=31337&page=2", "key=value;colour=red;size=10;weight=7", "key=value;x=9;owner=somebody;place=far", "abc", "abd"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    assert line_dedup.line_dedup(docs).where("n_removed > 0").count() == 0


def test_pieces_hold_every_shingle(spark):
    rng = random.Random(6)
    rows = ["".join(rng.choice(letters) for _ in range(n)) + "x" for n in range(70) for letters in ("ab", "ab\u00e9\u6f22\U0001f600 ")]
    lines = spark.createDataFrame([(x,) for x in rows], "line string")
    pieces = lines.selectExpr("line", f"regexp_extract_all(line, r'{line_dedup.PIECE}', 1) AS pieces").withColumn("shingles", line_dedup._shingles())
    k = line_dedup.K
    for r in pieces.collect():
        want = [r.line[i : i + k] for i in range(len(r.line) - k + 1)] or [r.line]
        assert want == [p[i : i + k] for p in r.pieces for i in range(max(len(p) - k + 1, 1))]
        hashed = [xxhash.xxh64_intdigest(x.encode(), 42) for x in want]
        assert set(r.shingles) == {h - (h >> 63 << 64) for h in hashed}


@pytest.mark.parametrize("part_lines", [512, 16])
def test_buckets_near_the_threshold(spark, monkeypatch, part_lines):
    """One bucket of a family whose lines are 0.72 to 0.85 alike, some of them by shared changes, and one of unlike lines: exactly the components of all pairs, from few pairs."""
    rng = random.Random(12)
    centre, alternative = [word(rng) for _ in range(60)], [word(rng) for _ in range(60)]
    lines = []
    for n in range(160):
        changed = list(centre)
        if n % 8 == 0:
            changed[:9] = alternative[:9]
        for k in rng.sample(range(60), rng.choice([2, 3, 4, 4, 5, 6])):
            changed[k] = word(rng)
        lines.append(" ".join(changed))
    lines += [" ".join(word(rng) for _ in range(20)) for _ in range(9)]
    sets, root = [shingles(x) for x in lines], list(range(len(lines)))
    band = [0] * 160 + [1] * 9
    for a in range(len(lines)):
        for b in range(a):
            if band[a] == band[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                root = [root[b] if r == root[a] else r for r in root]
    monkeypatch.setattr(line_dedup, "PART_LINES", part_lines)
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id bigint, text string")
    lids = {r.line: r.lid for r in line_dedup._lines(docs).collect()}
    bucket = spark.createDataFrame([(b, lids[x], max(-(-160 // part_lines) if b == 0 else 1, 1)) for b, x in zip(band, lines)], "band bigint, lid bigint, salts int")
    none = spark.createDataFrame([], "node bigint, root bigint")
    with Scratch() as scratch:
        shared = scratch.cut(bucket.join(line_dedup._maps(docs, bucket.select("lid")), "lid"))
        open_ = line_dedup._open(scratch, shared, none)
        drawn = scratch.cut(line_dedup._through_drawn(open_, 0.8))
        near = scratch.hold(line_dedup._verified(docs, drawn, 0.8))
        at = {lid: k for k, lid in enumerate(lids[x] for x in lines)}
        for r in near.collect():
            a, b = sets[at[r.a]], sets[at[r.b]]
            assert len(a & b) >= 0.8 * len(a | b)
        pairs = scratch.cut(line_dedup._left_over(line_dedup._open(scratch, open_.drop("root", "rest"), graph.components(near)), 0.8))
        assert near.count() > 40 and pairs.count() < 1200
        found = near.unionAll(line_dedup._verified(docs, pairs, 0.8))
        got = {at[r.node]: at[r.root] for r in graph.components(found).collect()}
    groups = lambda of: {frozenset(k for k in range(len(lines)) if of(k) == r) for r in {of(k) for k in range(len(lines))}}
    assert groups(lambda k: got.get(k, k)) == groups(lambda k: root[k])
