"""Every stage of the pipeline on nulls, empty and very long texts, repeated rows, clashing columns and empty tables."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

SF = "/root/testdata/sf0.001"
CLASHES = ("_lang", "_score", "_margin", "_rejected", "_rejected_of_caller", "_n_lines", "_n_removed", "_row", "_key", "_text", "id",
           "th", "text_key", "root", "kept", "name", "line", "least", "end", "shard", "slot", "rows", "item_id")


def _rows():
    rng = random.Random(8)
    vocab = {"en": [f"the{i}ing" for i in range(900)], "fr": [f"le{i}eau" for i in range(900)]}
    free = lambda lang, n: " ".join(rng.choices(vocab[lang], k=n))
    paragraph = free("en", 60)
    copy = free("fr", 80)
    rows = [(100 + i, free(lang, 60), lang, "a") for i in range(20) for lang in ("en", "fr")]
    return rows + [
        (None, f"{free('en', 30)}\n{paragraph}", None, None), (None, free("en", 40), "en", "b"),
        (1, f"{paragraph}\n{free('en', 30)}", "en", "a"), (2, paragraph, "en", None),
        (3, None, "en", "a"), (4, "", "fr", "b"), (5, " \n\t", None, "b"), (6, "123 !!", "en", "b"),
        (7, copy, "fr", "c"), (8, f"{copy} {free('fr', 3)}", "fr", "c"),
        (9, "\n".join(free("en", 12) for _ in range(4000)), "en", "a"),
        (10, free("fr", 50), "fr", "b"), (10, free("fr", 50), "fr", "b"),
    ] + [(11, " ".join(vocab["en"][:50]), "en", "a")] * 2


@pytest.fixture(scope="module")
def docs(spark):
    d = spark.createDataFrame(_rows(), "doc_id long, text string, lang string, source string") \
        .withColumn("n_chars", F.length("text").cast("long"))
    return d.withColumns({c: F.lit("mine") for c in CLASHES}).repartition(3)


@pytest.fixture(scope="module")
def done(spark, docs):
    """The rows each of the first four stages leaves of the same input."""
    return {name: stage(spark, docs, SF) for name, stage in corpus_pipeline.STAGES[:-1]}


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES[:-1]])
def test_columns_are_handed_on(docs, done, name):
    out = done[name]
    assert out.columns == docs.columns
    assert all(r[c] == "mine" for r in out.collect() for c in CLASHES)


def test_what_stays(done):
    ids = {name: sorted((r.doc_id or 0) for r in out.collect() if (r.doc_id or 0) < 100) for name, out in done.items()}
    assert not {3, 4, 5, 6} & set(ids["language_id"]) and {1, 2, 9, 11} <= set(ids["language_id"])
    assert ids["line_dedup"] == [0, 0, 1, 3, 4, 5, 6, 7, 8, 9, 10, 10, 11, 11]  # all of 2 is a later copy
    assert ids["near_dedup"] == [0, 0, 1, 2, 3, 4, 5, 6, 7, 9, 10, 10, 11, 11]
    assert ids["decontaminate"] == sorted((i or 0) for i, *_ in _rows() if (i or 0) < 100)
    cut = {r.doc_id: r for r in done["line_dedup"].collect()}
    assert "\n" not in cut[1].text and cut[1].n_chars == len(cut[1].text)
    assert cut[3].text is None and cut[3].n_chars is None


def test_mix(spark, docs):
    out = corpus_pipeline.mix_sources(spark, docs, SF).collect()
    words = {(i, w) for i, t, *_ in _rows() for w in (t or "").split()}
    assert {(r.doc_id, w) for r in out for w in r.text.split()} <= words
    assert {r.source for r in out} == {None, "a", "b", "c"} and not {3, 4, 5} & {r.doc_id for r in out}


def test_empty_tables(spark, docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).isEmpty()
