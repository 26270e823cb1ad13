"""Rows that share an id, or have none, are judged by their own texts."""

from __future__ import annotations

from spanframe.llm import decontaminate, near_dedup

TEXT = " ".join(f"w{i}" for i in range(30))
CLEAN = " ".join(f"clean{i}" for i in range(30))
OTHER = " ".join(f"other{i}" for i in range(30))


def _left(frame):
    return sorted((r.doc_id is not None, r.doc_id or 0, r.text) for r in frame.collect())


def test_near_dedup_keeps_clean_rows_of_an_id(spark):
    rows = [(None, TEXT), (5, TEXT), (4, TEXT + " more"), (None, CLEAN), (5, OTHER), (None, None), (5, "")]
    left = near_dedup.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert [(r.doc_id, r.text) for r in left.filter("text is null").collect()] == [(None, None)]
    assert _left(left.filter("text is not null")) == [
        (False, 0, CLEAN), (True, 4, TEXT + " more"), (True, 5, ""), (True, 5, OTHER)]


def test_near_dedup_keeps_one_text_of_a_class_of_one_id(spark):
    rows = [(None, TEXT), (None, TEXT + " more"), (7, CLEAN), (7, CLEAN + " more"), (8, CLEAN)]
    left = near_dedup.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(str(r.doc_id) for r in left) == ["7", "None"]


def test_drop_leaks_keeps_clean_rows_of_an_id(spark):
    rows = [(None, TEXT), (None, CLEAN), (1, OTHER + " " + TEXT), (1, OTHER), (None, None)]
    bench = spark.createDataFrame([(1, TEXT)], "item_id long, text string")
    left = decontaminate.drop_leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench)
    assert sorted((str(r.doc_id), str(r.text)) for r in left.collect()) == [("1", OTHER), ("None", "None"), ("None", CLEAN)]
