"""Costly expressions stand once in the plan, and vectors of tokens are not shuffled."""

import re

import pyarrow as pa
import pytest

from spanframe.functions import arrow
from spanframe.plans.registry import load_all

SF_SMALL = "/root/testdata/sf0.001"


def plan(spark, name):
    return load_all()[name].build(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["row_mean_f1", "roc_auc", "row_losses", "join_submission_skeleton"])
def test_a_draw_is_made_once(spark, name):
    assert plan(spark, name).count("md5(") <= 1  # roc_auc draws behind a checkpoint


@pytest.mark.parametrize("name", ["filter_empty_spans", "label_containment", "label_overlap90"])
def test_hits_are_not_made_again_by_a_filter_on_spans(spark, name):
    assert plan(spark, name).count(".token = term") == 1


def test_logits_are_made_once(spark):
    assert plan(spark, "row_losses").count("ln((pc") == 1


@pytest.mark.parametrize("name", ["embed_lookup", "sentence_embedding_mean", "cosine_similarity", "concat_feature_token_vec"])
def test_token_vectors_stay_bounded(spark, name):
    p = plan(spark, name)
    assert "rightHint=(strategy=broadcast)" in p or "ResolvedHint" in p
    assert "summary" not in p.lower() and not re.search(r"Join Inner, .*tok_no", p)


def test_paint_takes_plain_rows_at_once(monkeypatch):
    rows = []
    one = arrow._painted_row
    monkeypatch.setattr(arrow, "_painted_row", lambda b, f: rows.append(len(b)) or one(b, f))
    ints = pa.list_(pa.int32())
    s = pa.array([[0, 4], None, [], [0, 2], [3, 3, 8], [1], [5]], ints)
    e = pa.array([[3, 6], [1], [], [9, 4], [3, 7, 9], None, [6]], ints)
    out = arrow.paint.func(s, e).to_pylist()
    tup = [None if r is None else [tuple(x.values()) for x in r] for r in out]
    assert tup == [[(0, 3, 0), (4, 6, 1)], None, [], [(0, 2, 0), (2, 4, 1), (4, 9, 0)], [(3, 7, 1), (8, 9, 2)], None, [(5, 6, 0)]]
    assert rows == [2]
    assert arrow.paint.func(s[3:], e[3:]).to_pylist() == out[3:]
