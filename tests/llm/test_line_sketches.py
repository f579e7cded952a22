"""Lines that share a bucket by chance are told apart by their minima, without maps of their shingles."""

import random
from collections import defaultdict

import xxhash

from millrace.llm import line_dedup


def signed(h):
    return h - (h >> 63 << 64)


def test_chance_meetings_need_no_maps(spark, monkeypatch):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(3)) for _ in range(40)]
    rows = [(i, " ".join(rng.sample(words, 18))) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    bands = line_dedup._signatures(docs).selectExpr("lid", "explode(bands) AS band")
    shared = bands.join(bands.groupBy("band").count().where("count > 1"), "band").select("lid").distinct().count()
    mapped, maps = [0], line_dedup._maps

    def counted(docs, lids, *turn):
        mapped[0] += lids.count()
        return maps(docs, lids, *turn)

    monkeypatch.setattr(line_dedup, "_maps", counted)
    line_dedup.removed_lines(docs).count()
    assert shared > 100 and mapped[0] < shared / 4


def test_equal_minima_are_counted(spark):
    """Lines are kept apart only below ``_least_equal`` minima; the last bits of all fields count."""
    n, least = line_dedup.BANDS * line_dedup.ROWS, line_dedup._least_equal(0.8)
    assert least == 12 and line_dedup._least_equal(1.0) == n and line_dedup._least_equal(0.1) == 0
    rng, rows = random.Random(3), []
    for apart in range(n + 1):
        x, y = [rng.randrange(64) for _ in range(n)], []
        changed = set(rng.sample(range(n), apart))
        y = [v ^ rng.choice((1, 32, 63)) if k in changed else v for k, v in enumerate(x)]
        pack = lambda v: tuple(sum(b << 7 * i for i, b in enumerate(v[8 * k : 8 * k + 8])) for k in range(n // 8))
        rows.append((apart, pack(x), pack(y)))
    sketch = "struct<s0: bigint, s1: bigint, s2: bigint, s3: bigint>"
    table = spark.createDataFrame(rows, f"apart int, x {sketch}, y {sketch}")
    kept = {r.apart for r in table.where(line_dedup._may_agree("x", "y", 0.8)).collect()}
    assert kept == set(range(n - least + 1))


def test_places_and_pieces_give_every_shingle(spark):
    rng, k = random.Random(7), line_dedup.K
    texts = sorted({"".join(rng.choice(letters) for _ in range(n)) + "x" for n in (*range(45), 300) for letters in ("ab", "abé漢\U0001f600 ")})
    lines = spark.createDataFrame([(x, x) for x in texts], "text string, line string")
    got = defaultdict(set)
    for r in line_dedup._hashed(lines).collect():
        got[r.text] |= {r[f"h0_{i}"] for i in range(line_dedup.STEP)}
    want = {x: {signed(xxhash.xxh64_intdigest(y.encode(), 42)) for y in ([x[i : i + k] for i in range(len(x) - k + 1)] or [x])} for x in texts}
    assert dict(got) == want
