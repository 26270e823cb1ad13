"""Recall of near copies against all pairs of words."""

from __future__ import annotations

import random

import numpy as np
import pytest

from spanframe.llm import near_dedup
from spanframe.llm.hashing import shingles, word_hashes


def _keys(words):
    return set(near_dedup.order_minhash(shingles(word_hashes(" ".join(words).encode()), near_dedup.K)).tolist())


@pytest.mark.parametrize("share, least", [(0.1, 0.99), (0.15, 0.95), (0.2, 0.85)])
def test_share_of_edited_copies_with_a_common_key(share, least):
    rng, met = random.Random(8), 0
    for c in range(200):
        a = [f"w{rng.randrange(50000)}" for _ in range(200)]
        b = list(a)
        for p in rng.sample(range(200), int(200 * share)):
            b[p] = f"x{p}"
        met += bool(_keys(a) & _keys(b))
    assert met >= least * 200


def test_links_of_the_documents_against_all_pairs_of_words(spark):
    """All pairs of different texts whose words are similar enough end in one class."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    classes = {r.id: r.class_id for r in near_dedup.near_classes(docs).collect()}
    seqs = sorted(((r.doc_id, word_hashes(r.text.encode())) for r in docs.collect() if r.text), key=lambda x: len(x[1]))
    seqs = [(d, w, near_dedup.labelled(w)) for d, w in seqs if len(w)]
    pairs = caught = 0
    for i, (a, wa, la) in enumerate(seqs):
        for b, wb, lb in seqs[i + 1 :]:
            edits = near_dedup.max_edits(len(wa), len(wb), 0.8)
            if len(wb) - len(wa) > edits:
                break
            if len(wb) - len(np.intersect1d(la, lb, assume_unique=True)) > edits or np.array_equal(wa, wb):
                continue
            if near_dedup.banded_distance(wa, wb, edits) <= edits:
                pairs += 1
                caught += classes[a] == classes[b]
    assert pairs > 50 and caught >= 0.98 * pairs
