"""Decontamination against edit distances to every region, for any layout of rows."""

import random

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import decontaminate
from millrace.llm.ragged import chunks
from tests.llm.conftest import prose


def least_edits(item, text):
    """Fewest edits that make ``item`` a part of ``text``."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item):
        new = [i + 1]
        for j in range(len(text)):
            new.append(min(row[j] + (c != text[j]), row[j + 1] + 1, new[-1] + 1))
        row = new
    return min(row)


def expect(docs, items, rate):
    out = {}
    for i, text in docs:
        text = " ".join((text or "").lower().split())
        for item, sought in items:
            sought = " ".join(sought.lower().split())
            most = int(rate * len(sought) + 1e-9)
            if most == 0 and sought and f" {sought} " in f" {text} ":
                out[i, item] = 0
            elif most and (edits := least_edits(sought, text)) <= most:
                out[i, item] = edits
    return out


def sample(rng, rate, n_docs):
    """Documents beside, or made of, edited items; items of 1 to about 60 bytes."""
    word = lambda: "".join(rng.choice("abcd") for _ in range(rng.randint(1, 5)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(k, text(rng.choice([1, 1, 2, 3, 4, 6, 9, 14]))) for k in range(12)]
    docs = []
    for k in range(n_docs):
        body = text(rng.choice([0, 1, 2, 3, 5, 20]))
        if rng.random() < 0.6:
            chars = list(rng.choice(items)[1])
            for _ in range(rng.randint(0, int(rate * len(chars)) + 1)):
                at = rng.randrange(len(chars))
                chars[at : at + 1] = rng.choice(["", "z", chars[at] + "z"])
            found = "".join(chars) or "z"
            body = found if rng.random() < 0.3 else f"{body} {found} {text(rng.choice([0, 1, 4]))}"
        docs.append((k, body))
    return docs, items


@pytest.mark.parametrize("seed", range(25))
def test_chunks_against_brute_force(seed):
    rng = random.Random(seed)
    rate = rng.choice([0.0, 0.05, 0.1, 0.1, 0.25])
    docs, items = sample(rng, rate, 40)
    p, got = decontaminate.Patterns(items, rate), {}
    for t in chunks(pa.array([x for _, x in docs]), rng.choice([50, 300, 1 << 20])):
        for r, item, first, upto, edits in decontaminate._regions(p, t):
            assert 0 <= first < upto <= len(docs[t.first + r][1].split())
            got[t.first + r, item] = min(edits, got.get((t.first + r, item), 99))
    assert got == expect(docs, items, rate)


@pytest.mark.parametrize("partitions", [1, 4, 200])
def test_partitions_against_brute_force(spark, partitions):
    docs, items = sample(random.Random(99), 0.1, 250)
    docs += [(1000 + k, "abcd dcba a") for k in range(29)] + [(2000, None), (2001, ""), (None, "ABCD\n\tdcba")]
    items += [(50, "abcd dcba"), (51, "Abcd"), (None, "abcd")]
    table = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(partitions)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = expect(docs, items[:-1], 0.1)
    for block_bytes in (decontaminate.BLOCK_BYTES, 150):
        got = {}
        for r in decontaminate.contaminated(table, bench, block_bytes=block_bytes).collect():
            got[r.doc_id, r.item_id] = min(r.edits, got.get((r.doc_id, r.item_id), 99))
        assert got == want
        clean = {r.doc_id for r in decontaminate.clean(table, bench, block_bytes=block_bytes).collect()}
        assert clean == {i for i, _ in docs} - {i for i, _ in want}


def test_long_items_by_segments():
    rng, item = random.Random(4), prose(60, 50)
    p = decontaminate.Patterns([(1, item)], 0.1)
    for k in range(1, 13):
        segment = list(item[64:192])
        for _ in range(k):
            at = rng.randrange(len(segment))
            segment[at : at + 1] = rng.choice(["", "#", segment[at] + "#"])
        text = f"zz {''.join(segment)} yy"
        found = decontaminate._regions(p, next(chunks(pa.array([text]))))
        assert [x[:2] for x in found] == [(0, 1)]
        assert found[0][4] == min(least_edits(s, text) for s in (item[a : a + 128] for a in (*range(0, len(item) - 128, 64), len(item) - 128)))
    assert not decontaminate._regions(p, next(chunks(pa.array([prose(400, 51)]))))
    with pytest.raises(ValueError, match="rate"):
        decontaminate.Patterns([], 0.5)


def test_alignment_is_edit_distance():
    rng, item = np.random.default_rng(1), prose(12, 50)[:120]
    p = decontaminate.Patterns([(1, item)], 0.1)
    for k in range(12):
        chars = list(item)
        for _ in range(k):
            at = int(rng.integers(0, len(chars)))
            chars[at : at + 1] = [["x"], [], [chars[at], "x"]][int(rng.integers(0, 3))]
        text = "zz " * 20 + "".join(chars) + " yy" * 20
        plain = np.frombuffer(text.encode(), np.uint8)
        edits, end = decontaminate._align(p, plain, np.array([0]), np.array([len(plain)]), np.array([0]), np.array([48]))
        assert edits[0] == least_edits(item, text) and abs(end[0] - 60 - len(chars)) <= 12
