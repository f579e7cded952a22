"""Texts of many lines are looked up in turns."""

import random

from millrace.llm import line_dedup
from tests.llm.conftest import prose


def test_lookup_in_turns(spark, monkeypatch):
    rng = random.Random(2)
    rows = []
    for i in range(40):
        w = prose(30, i % 10).split()
        w[rng.randrange(30)] = "changed"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = {(r.doc, r.text_hash, tuple(r.removed)) for r in line_dedup.removed_lines(docs).collect()}
    turns, texts = set(), line_dedup._texts
    monkeypatch.setattr(line_dedup, "_texts", lambda docs, lids, turn: turns.add(turn) or texts(docs, lids, turn))
    monkeypatch.setattr(line_dedup, "BROADCAST_LINES", 2)
    got = {(r.doc, r.text_hash, tuple(r.removed)) for r in line_dedup.removed_lines(docs).collect()}
    assert len(want) > 20 and got == want
    assert {(k, line_dedup.TURNS) for k in range(line_dedup.TURNS)} <= turns
