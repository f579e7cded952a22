"""Lines that meet lines of other components by their sketches are found without a row for each pair."""

import random
import re

from millrace.llm import line_dedup


def test_close_lines_without_pairs(spark):
    rng, n = random.Random(13), line_dedup.BANDS * line_dedup.ROWS
    families = [[rng.randrange(64) for _ in range(n)] for _ in range(4)]
    pack = lambda v: tuple(sum(b << 7 * i for i, b in enumerate(v[8 * k : 8 * k + 8])) for k in range(n // 8))
    rows, minima = [], {}
    for lid in range(300):
        band, salts = lid % 3, (1, 2, 3)[lid % 3]
        v = list(families[rng.randrange(4)]) if lid % 5 else [rng.randrange(64) for _ in range(n)]
        for k in rng.sample(range(n), rng.choice([0, 4, 11, 19, 21])):
            v[k] = rng.randrange(64)
        minima[lid] = (band, rng.choice([0, 1, 2, 3]), v)
        rows.append((band, salts, lid, pack(v), minima[lid][1], minima[lid][1] > 0))
    sketch = "struct<s0: bigint, s1: bigint, s2: bigint, s3: bigint>"
    open_ = spark.createDataFrame(rows, f"band bigint, salts int, lid bigint, map {sketch}, root bigint, rest boolean")
    least, want = line_dedup._least_equal(0.8), set()
    for a in minima:
        for b in range(a):
            (band_a, root_a, x), (band_b, root_b, y) = minima[a], minima[b]
            if band_a == band_b and root_a != root_b and (root_a or root_b) and sum(p == q for p, q in zip(x, y)) >= least:
                want |= {a, b}
    close = line_dedup._close(open_, 0.8)
    assert 100 < len(want) < 300 and sorted(r.lid for r in close.collect()) == sorted(want)
    joins = re.findall(r"\bJoin (\w+)", close._jdf.queryExecution().optimizedPlan().toString())
    assert joins and set(joins) == {"LeftSemi"}
