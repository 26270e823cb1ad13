"""Links between members of one bucket that lead nothing, against all pairs that share a key."""

from __future__ import annotations

import random
from itertools import combinations

import pytest

from spanframe.llm import near_dedup
from spanframe.llm.hashing import shingles, word_hashes


def _bridged(seed, size):
    """Two groups of near copies, of a and of b, joined only by the pair (x, y) at the bound."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(50000)]
    a = rng.choices(vocab, k=104)

    def edit(w, places, tag):
        w = list(w)
        for p in places:
            w[p] = f"{tag}{p}s{seed}"
        return w

    x = edit(a, range(4, 14), "p")
    y = edit(x, range(24, 44), "p")  # 20 of 104 words
    b = edit(y, range(64, 74), "p")
    rows = [x, y, a, b]
    for side in (a, b):
        for c in range(size):
            rows.append(edit(side, [rng.choice([2, 50, 54, 58, 82, 92, 101])], f"c{c}e"))
    return [" ".join(r) for r in rows]


def _classes(rows):
    """{id: least id}: components of the linked pairs that share a key."""
    seqs = {d: word_hashes(t.encode()) for d, t in rows}
    keys = {d: set(near_dedup.order_minhash(shingles(w, near_dedup.K)).tolist()) for d, w in seqs.items()}
    root = {d: d for d, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(seqs), 2):
        x, y = find(a), find(b)
        if x != y and keys[a] & keys[b] and near_dedup.close(seqs[a], seqs[b], 0.8):
            root[max(x, y)] = min(x, y)
    return {d: find(d) for d in root}


@pytest.mark.parametrize("rows_of_a_chunk", [3, 512])
def test_bridge_between_members_that_lead_nothing(spark, monkeypatch, rows_of_a_chunk):
    monkeypatch.setattr(near_dedup, "CHUNK_ROWS", rows_of_a_chunk)
    rows = [(s * 1000 + i, t) for s in (31, 32) for i, t in enumerate(_bridged(s, 40))]
    want = _classes(rows)
    assert set(want.values()) == {31000, 32000}
    got = near_dedup.near_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.id: r.class_id for r in got.collect()} == want


def test_bridge_between_groups_of_hundreds(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "CHUNK_ROWS", 64)
    rows = list(enumerate(_bridged(1, 250)))
    got = near_dedup.near_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.id: r.class_id for r in got.collect()} == _classes(rows)
