"""Driver contract, plans and the streaming path."""

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert rows and df.columns == ["case_num", "n_tokens", "n_pos", "neg_pos_ratio"]


def test_registry_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 140
    for k in ("tabular_mlp_predictions", "text_classifier_predictions"):
        assert k in q and k not in o


@pytest.mark.parametrize("key", ["label_boundary", "decode_token_runs", "char_micro_f1", "cv_scores_rollup",
                                 "smooth_valid", "roc_auc", "vocab_topk", "postprocess_spaces"])
def test_against_oracle_small(spark, key):
    import sys
    import os
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools"))
    from check_oracle import digest

    df = E.queries()[key](spark, SF)
    rows = df.collect()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(E.oracle_sql()[key])
    orows = cur.fetchall()
    assert digest(df.columns, rows)[0] == digest([d[0] for d in cur.description], orows)[0]


def _plan(df):
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_expression_operators_stay_in_jvm(spark):
    q = E.queries()
    for key in ("parse_loc_strip_split", "label_overlap90", "format_spans", "norm_feature_text"):
        plan = _plan(q[key](spark, SF))
        assert "BatchEvalPython" not in plan, key


def test_dimension_join_is_broadcast(spark):
    plan = _plan(E.queries()["join_features_left"](spark, SF))
    assert "Broadcast" in plan


def test_scan_prunes_columns(spark):
    txt = _plan(E.queries()["token_offsets"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in txt


def test_streaming_matches_batch(spark):
    from spanframe.plans.fixtures import Bindings as Fixtures
    from spanframe.streaming.parse_join import term_occurrences

    s = E.queries()["stream_parse_join"](spark, SF)
    fx = Fixtures(spark, SF)
    b = term_occurrences(fx.notes, fx.features)
    assert sorted(s.collect()) == sorted(b.collect())


def test_series_windows_are_blocked(spark):
    """No window over a whole run: every Window is keyed by (run, block) or
    runs on a reduced block/offset table."""
    import re

    for key in ("smooth_valid", "running_mean", "new_best_flags"):
        plan = _plan(E.queries()[key](spark, SF))
        for line in plan.splitlines():
            if "windowspecdefinition(run#" in line and "_blk" not in line:
                # the only run-keyed windows allowed are the block-total scans
                assert re.search(r"windowspecdefinition\(run#\d+L?, _blk", line) or "_bt" in line or \
                    "_n#" in line, line


def test_text_maps_have_no_exchange(spark):
    q = E.queries()
    for key in ("clean_spaces", "strip_note"):
        assert "Exchange hash" not in _plan(q[key](spark, SF)).replace("Subquery", ""), key


def test_token_scores_join_on_the_note_only(spark):
    """No exchange of the (row, token) pairs to attach labels."""
    plan = _plan(E.queries()["threshold_binary"](spark, SF))
    assert "tok_no" not in "".join(x for x in plan.splitlines() if "Exchange hashpartitioning" in x)


def test_point_lookup_filters_the_scan(spark):
    plan = _plan(E.queries()["lookup_patient"](spark, SF))
    assert "EqualTo(doc_id,7)" in plan


def test_class_scores_do_not_shuffle_vectors(spark):
    plan = _plan(E.queries()["argmax_class"](spark, SF))
    main = plan.split("Subquery")[0]
    assert "Exchange hash" not in main and "Window" not in main


def test_shared_folder_is_required_on_a_cluster():
    from types import SimpleNamespace

    from spanframe.session import ensure_checkpoint_dir

    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda *a: None)))
