"""Rejection does not depend on the length of a text."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from spanframe.llm import language

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def corpus(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    model = language.fit(docs.filter(~language.held_out(F.col("doc_id"))))
    own = {}
    for r in docs.filter(language.held_out(F.col("doc_id"))).orderBy("doc_id").collect():
        own.setdefault(r.lang, []).extend((r.text or "").split())
    return model, own


@pytest.mark.parametrize("chars", [1_000, 100_000, 1_500_000])
def test_clean_texts_of_any_length_are_told(spark, corpus, chars):
    model, own = corpus
    # words in random order: a text repeated whole would add no bytes
    rng = random.Random(chars)
    rows = [(lang, " ".join(rng.choices(own[lang], k=chars // 3))[:chars]) for lang in model]
    got = language.identify(spark.createDataFrame(rows, "lang string, text string"), model).collect()
    assert len(got) > 1 and all(r._lang == r.lang and not r._rejected for r in got), [(r.lang, r._lang, r._margin) for r in got]
