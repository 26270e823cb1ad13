"""Tables that are folders of part files, read as streams."""

import pytest

from spanframe.plans.registry import load_all


@pytest.fixture(scope="module")
def folder_tables(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("folders"))
    texts = [(0, "Fever and cough. Fever"), (1, "no cough"), (2, None), (3, " - "), (4, "\tpain, fever \n")]
    spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3).write.parquet(f"{d}/documents.parquet")
    items = [(0, "fever high grade"), (1, "cough at night"), (2, "pain in chest"), (3, "no known illness")]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_streams_read_a_folder_of_part_files(spark, folder_tables):
    q = load_all()
    hits = sorted(map(tuple, q["stream_parse_join"].build(spark, folder_tables).collect()))
    assert hits == [(0, 0, 0, 5), (0, 0, 17, 22), (0, 1, 10, 15), (1, 1, 3, 8), (1, 3, 0, 2), (4, 0, 7, 12), (4, 2, 1, 5)]
    decoded = q["stream_decode"].build(spark, folder_tables)
    assert {r["id"]: r["runs_exact"] for r in decoded.collect()}["0_0"] == "0 5;17 22" and decoded.count() == 12
    encoded = q["stream_encode"].build(spark, folder_tables)
    assert {(r["pn_num"], r["tok_no"]) for r in encoded.collect()} == {(0, 1), (0, 2), (0, 3), (0, 4), (1, 1), (1, 2), (4, 1), (4, 2)}
