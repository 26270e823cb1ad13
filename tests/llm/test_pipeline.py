"""The pipeline, stage by stage, against the brute-force versions on each stage's own input."""

from __future__ import annotations

import pytest

import corpus_pipeline
from spanframe.llm.common import materialise

from . import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """(name, rows in, rows out) of each stage."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = materialise(stage(spark, docs, SF))
        out.append((name, docs, after))
        docs = after
    return {n: (a, b) for n, a, b in out}


def _texts(frame):
    return sorted((r.doc_id, r.text) for r in frame.collect())


def test_stages_hand_over_documents(spark, stages):
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert list(stages) == ["language_id", "line_dedup", "near_dedup", "decontaminate", "mix_sources"]
    for name in list(stages)[:-1]:
        assert stages[name][1].columns == columns


def test_language_id(stages):
    before, after = (dict(_texts(x)) for x in stages["language_id"])
    assert after.items() <= before.items() and len(after) >= 0.97 * len(before)
    assert all(any(c.isalpha() for c in t) for t in after.values())


def test_line_dedup(stages):
    before, after = stages["line_dedup"]
    want = brute.dedup_lines(_texts(before))
    text = dict(_texts(before))
    assert dict(_texts(after)) == {d: t for d, t in want.items() if t or not text[d]}
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_near_dedup(stages):
    before, after = stages["near_dedup"]
    classes = brute.near_classes(_texts(before))
    assert _texts(after) == [(d, t) for d, t in _texts(before) if classes[d] == d]


def test_decontaminate(spark, stages):
    before, after = stages["decontaminate"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    gone = {d for d, _ in brute.leaks(_texts(before), items)}
    assert _texts(after) == [(d, t) for d, t in _texts(before) if d not in gone]


def test_mix(stages):
    before, after = stages["mix_sources"]
    source = {r.doc_id: r.source for r in before.collect()}
    words = {d: brute.words(t) for d, t in _texts(before)}
    size, taken = {}, {}
    for d, w in words.items():
        size[source[d]] = size.get(source[d], 0) + len(w)
    for r in after.collect():
        assert r.text.split(" ") == words[r.doc_id][r.first_word : r.first_word + r.n_words]
        assert r.source == source[r.doc_id]
        taken[r.source] = taken.get(r.source, 0) + r.n_words
    assert taken == {s: int(t) for s, t in brute.targets(size).items() if int(t)}


def test_run_is_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, stages["mix_sources"][1].collect()))
