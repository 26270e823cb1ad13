"""Draws, scores, overlaps and encodings made for many rows at once, and in bounded slices."""

import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spanframe.functions import arrow
from spanframe.operators import metrics as M
from spanframe.operators import models as MD
from spanframe.plans.registry import load_all

SF_SMALL = "/root/testdata/sf0.001"
INTS = pa.list_(pa.int32())


def test_helpers_work_in_bounded_slices(monkeypatch):
    """A batch of many long rows is not widened at once (memory of the Python workers)."""
    monkeypatch.setattr(arrow, "SLICE", 8)
    rnd, seen = random.Random(1), []
    rows = [None if i % 7 == 3 else [rnd.randint(1, 9) for _ in range(rnd.randint(0, 6))] for i in range(60)]
    first = pa.array([i % 2 for i in range(60)])
    one = arrow._lists
    monkeypatch.setattr(arrow, "_lists", lambda x: seen.append(len(x.flatten())) or one(x))
    got = arrow.word_bounds.func(pa.array(rows, INTS), first).to_pylist()
    for r, f, g in zip(rows, first.to_pylist(), got):
        if r is None:
            assert g["s"] is None and g["e"] is None
        else:
            at = np.concatenate([[0], np.cumsum(r)]).tolist()
            assert g == {"s": at[:-1][f::2], "e": at[1:][f::2]}
    assert len(seen) > 5 and max(seen) <= 8 + 6


@pytest.mark.parametrize("size", [3, 1 << 18])
def test_overlaps_against_sets(monkeypatch, size):
    monkeypatch.setattr(arrow, "SLICE", size)
    rnd = random.Random(5)
    span = lambda: (rnd.choice([None, *range(-5, 20)]), rnd.choice([None, *range(0, 25)]))
    rows = [[None if rnd.random() < .1 else [span() for _ in range(rnd.randint(0, 5))] for _ in "pt"] for _ in range(200)]
    side = lambda k, j: pa.array([None if r[k] is None else [x[j] for x in r[k]] for r in rows], INTS)
    got = arrow.overlaps.func(side(0, 0), side(0, 1), side(1, 0), side(1, 1)).to_pylist()
    for r, g in zip(rows, got):
        if None in r:
            assert g is None
            continue
        p, t = ({c for a, b in x if a is not None and b is not None for c in range(a, b)} for x in r)
        assert g == {"tp": len(p & t), "fp": len(p - t), "fn": len(t - p)}


def test_batch_score_sees_many_rows_and_keeps_order(spark):
    def scorer(f: pd.DataFrame):
        assert list(f.columns) == ["pn_num", "feature_num", "tok_no", "s", "e"]
        return f.assign(prob=f.pn_num * 1000.0 + f.feature_num * 100 + f.tok_no * 10 + (f.e - f.s))

    d = spark.createDataFrame([(1, 2, [0, 3], [2, 7]), (3, 4, [], []), (5, 6, None, None), (7, 8, [1], [2])],
                              "pn_num long, feature_num long, s array<int>, e array<int>").coalesce(1)
    got = {r.pn_num: r.probs for r in MD.batch_score(d, scorer).collect()}
    assert got == {1: [1212.0, 1224.0], 3: [], 5: None, 7: [7811.0]}


def test_rows_with_equal_keys_are_counted_as_one(spark):
    sp = "array<struct<start:int,end:int>>"
    d = spark.createDataFrame([(1, [(0, 5)], [(3, 8)]), (1, [(0, 5)], [(3, 8)]), (None, [(0, 2)], []), (2, [], [])],
                              f"k int, p {sp}, t {sp}")
    got = {r.k: (r.tp, r.fp, r.fn) for r in M.packed_overlap_counts(d, "p", "t", ["k"]).collect()}
    assert got == {1: (2, 3, 3), None: (0, 2, 0)}


def _plan(spark, name):
    return load_all()[name].build(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["cv_oof_model"])
def test_the_fold_joins_notes_not_tokens(spark, name):
    """Below the explode, not above it: the only join above is that with a broadcast table."""
    lines = _plan(spark, name).splitlines()
    explode = next(i for i, x in enumerate(lines) if "Generate " in x)
    assert all("broadcast" in x for x in lines[:explode] if "Join " in x) and any("Join " in x for x in lines[explode:])


def test_tokens_are_not_exploded_to_be_scored(spark):
    plan = _plan(spark, "cv_oof_scores")
    assert "MapInPandas" not in plan and "Window" not in plan.split("Join Inner")[0]


def test_scores_of_a_log_are_computed_once(spark, monkeypatch):
    from spanframe.plans.catalog import io

    monkeypatch.setattr(io.FS, "append_log", lambda df, path, keys: seen.append(df._jdf.queryExecution().optimizedPlan().toString()))
    monkeypatch.setattr(io.FS, "scratch", lambda s, n: SF_SMALL + "/nation.parquet")
    seen = []
    load_all()["metric_log_append"].build(spark, SF_SMALL)
    assert len(seen) == 3 and not any("Relation" in p for p in seen)


@pytest.mark.parametrize("name", ["encode_pair", "encode_pair_truncated"])
def test_the_text_of_a_note_is_made_once_a_note(spark, name):
    """The words become text below the joins with the note's rows."""
    plan = _plan(spark, name)
    assert "transform(" in plan.split("Aggregate [pn_num")[0].split("Join Inner")[-1]


def test_no_score_where_only_labels_are_read(spark):
    assert "md5(" not in _plan(spark, "filter_no_positive")
