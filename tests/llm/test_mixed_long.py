"""mixed_text on nulls, empty and very long texts, odd blanks and clashing names."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from spanframe.llm import mixing


def _mixed(docs, **kw):
    _, _, plan = mixing.mix(docs, **kw)
    return mixing.mixed_text(docs, plan), plan


def test_segments_of_a_long_text_are_cut_in_linear_time(spark):
    words = [f"w{i}" for i in range(1_000_000)]
    docs = spark.createDataFrame([(1, " ".join(words), "a"), (2, "x y", "b")], "doc_id long, text string, source string")
    out, plan = _mixed(docs)
    t0 = time.time()
    rows = out.filter("doc_id = 1").collect()
    assert time.time() - t0 < 60
    assert sum(r.n_words for r in rows) == plan.filter("doc.id = 1").agg(F.sum("n")).first()[0] > 1_000_000
    assert all(r.text.split(" ") == words[r.first_word : r.first_word + r.n_words] for r in rows)


def test_nulls_blanks_and_names(spark):
    texts = [None, "", " \n\t", "\x0b a b  c\r\nd \x0c", "e", " f" * 700]
    rows = [(i, t, "s", "mine", "mine") for i, t in enumerate(texts)] + [(None, "g h", None, "mine", "mine")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _w string, slot string")
    out, plan = _mixed(docs, block_words=50, shard_slots=4)
    split = {i: [w for w in (t or "").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").replace("\n", " ")
                 .replace("\t", " ").split(" ") if w] for i, t, *_ in rows}
    got = out.collect()
    assert len(got) == plan.count() and {r.doc_id for r in got} <= {3, 4, 5, None}
    assert all(r.text.split(" ") == split[r.doc_id][r.first_word : r.first_word + r.n_words] for r in got)
    assert mixing.mixed_text(docs, plan.limit(0)).isEmpty() and mixing.mixed_text(docs.limit(0), plan).isEmpty()
