"""The mix of rows that are repeated in full is its plan, each segment once."""

from __future__ import annotations

from spanframe.llm import mixing


def test_mixed_text_of_repeated_rows_is_the_plan(spark):
    free = lambda d, n: " ".join(f"w{d}x{i}" for i in range(n))
    rows = [(1, free(1, 90), "a")] * 4 + [(None, free(0, 50), "a")] * 3 + [(2, free(2, 70), "a"), (3, free(3, 200), "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    _, targets, plan = mixing.mix(docs, block_words=32, shard_slots=8)
    key = ["shard", "slot", "source", "at", "first_word"]
    want = sorted((*(r[k] for k in key), r.n, str(r.doc.id)) for r in plan.collect())
    got = mixing.mixed_text(docs, plan).collect()
    assert sorted((*(r[k] for k in key), r.n_words, str(r.doc_id)) for r in got) == want
    words = {str(d): t.split() for d, t, _ in rows}
    assert all(r.text.split() == words[str(r.doc_id)][r.first_word : r.first_word + r.n_words] for r in got)
    assert {r.source: int(r.target) for r in targets.collect()} == {
        s: sum(r.n_words for r in got if r.source == s) for s in ("a", "b")}
