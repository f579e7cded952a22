"""The mix against one that gives blocks one at a time and takes words one at a time."""

import hashlib
import math
import random

import pytest

from millrace.llm import source_mix
from tests.llm.test_llm import words

BLOCK = source_mix.BLOCK_WORDS


def number(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def seats(votes, blocks):
    """Highest quotients, one block after the other; ties go to the first key."""
    given = dict.fromkeys(votes, 0)
    for _ in range(blocks):
        if any(votes.values()):
            best = max(votes, key=lambda k: (votes[k] / (2 * given[k] + 1), -list(votes).index(k)))
            given[best] += 1
    return given


def targets(sizes, share=1.5, cap=2):
    """Shares by weight; what is above a source's cap goes to the others until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    out, left, open_ = {}, share * sum(sizes.values()), list(order)
    while open_:
        rate = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if weight[s] * rate > cap * sizes[s]]
        if not full:
            return out | {s: weight[s] * rate for s in open_}
        for s in full:
            out[s] = cap * sizes[s]
            left -= out[s]
            open_.remove(s)
    return out


def expect(rows, shard_words):
    sizes, size = {}, [len(words(t)) for _, t, _ in rows]
    for (_, _, s), n in zip(rows, size, strict=True):
        sizes[s] = sizes.get(s, 0) + n
    target = targets(sizes)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    blocks = seats({s: target[s] for s in order}, math.floor(sum(target[s] for s in order) / BLOCK + 0.5))
    taken = [0] * len(rows)
    for s in order:
        n_shards = max(1, sizes[s] // shard_words)
        parts = max(1, math.ceil(math.sqrt(n_shards)))
        key = [hashlib.md5(f"mix{'null' if i is None else i}".encode()).hexdigest() for i, _, _ in rows]
        shards = {}
        for k, (_, _, own) in enumerate(rows):
            if own == s:
                shards.setdefault(int(key[k][:8], 16) % n_shards, []).append(k)
        total = {h: sum(size[k] for k in members) for h, members in sorted(shards.items())}
        by_part = {}
        for h in total:
            by_part.setdefault(h % parts, []).append(h)
        got = seats({p: sum(total[h] for h in by_part[p]) for p in sorted(by_part)}, blocks[s])
        for p in sorted(by_part):
            quota = seats({h: total[h] for h in sorted(by_part[p])}, got[p])
            for h in sorted(by_part[p]):
                n_blocks = max(1, -(-total[h] // BLOCK))
                turn = number(f"mix/{s or ''}/{h}") % n_blocks
                times = min(2, quota[h] // n_blocks)
                extra = 0 if quota[h] // n_blocks >= 2 else quota[h] % n_blocks
                drawn = [times + ((j + 1) * extra + turn) // n_blocks - (j * extra + turn) // n_blocks for j in range(n_blocks)]
                at = 0
                for k in sorted(shards[h], key=lambda k: (key[k], rows[k][0] if rows[k][0] is not None else -1, size[k])):
                    for _ in range(size[k]):
                        taken[k] += drawn[at // BLOCK]
                        at += 1
    return taken, target


@pytest.mark.parametrize(("seed", "shard_words"), [(1, 40), (2, 100), (3, 250), (4, 1 << 18)])
def test_mix_against_single_steps(spark, seed, shard_words):
    rng = random.Random(seed)
    rows = [(k if rng.random() < 0.98 else None, None if rng.random() < 0.03 else " ".join(["w"] * rng.choice([0, 1, 5, 20, 90])), rng.choice(["a", "a", "a", "a", "b", "c", "d", None])) for k in range(120)]
    rows = [r for n, r in enumerate(rows) if r[0] is not None or not any(q[0] is None for q in rows[:n])]
    taken, target = expect(rows, shard_words)
    got = source_mix.mix_sources(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), shard_words=shard_words).collect()
    want = {r[0]: (r[2], len(words(r[1])), n) for r, n in zip(rows, taken, strict=True)}
    assert {r.doc_id: (r.source, r.size, r.taken) for r in got} == want
    assert all(abs(r.target - target[r.source]) < 1e-6 for r in got)
