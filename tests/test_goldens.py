"""Tiny goldens for every dialect and quirk (values derived by hand)."""

from pyspark.sql import functions as F

from spanframe.functions import spans as S
from spanframe.functions.text import norm_feature_text
from spanframe.operators import decode as D
from spanframe.operators import labels as L
from spanframe.operators import metrics as M


def _spans(spark, lit, fn):
    row = spark.createDataFrame([(lit,)], "loc string").select(fn("loc").alias("s")).first()
    return [(x["start"], x["end"]) for x in row["s"]]


def test_parse_dialects(spark):
    assert _spans(spark, "['696 724']", S.parse_loc_strip_split) == [(696, 724)]
    disc = "['285 292;301 312', '9 12']"
    want = [(285, 292), (301, 312), (9, 12)]
    for fn in (S.parse_loc_strip_split, S.parse_loc_literal, S.parse_loc_scoring):
        assert _spans(spark, disc, fn) == want
    assert _spans(spark, disc, S.parse_loc_sorted) == sorted(want)
    assert _spans(spark, "285 292;301 312;9 12", S.parse_loc_prediction) == want
    for fn in (S.parse_loc_strip_split, S.parse_loc_literal, S.parse_loc_scoring, S.parse_loc_sorted):
        assert _spans(spark, "[]", fn) == []
    assert _spans(spark, "", S.parse_loc_prediction) == []


def test_format_spans(spark):
    r = spark.createDataFrame([("['5 9;12 20', '30 31']",)], "loc string") \
        .select(S.format_spans(S.parse_loc_strip_split("loc")).alias("a"),
                S.format_spans(S.parse_loc_strip_split("loc"), "; ").alias("b")).first()
    assert r["a"] == "5 9;12 20;30 31" and r["b"] == "5 9; 12 20; 30 31"


def _rows_tokens(spark, spans, toks):
    rows = spark.createDataFrame([("r", 1, spans)], "id string, pn_num long, spans array<struct<start:int,end:int>>")
    tokens = spark.createDataFrame([(1, i + 1, s, e) for i, (s, e) in enumerate(toks)],
                                   "pn_num long, tok_no int, s int, e int")
    return rows, tokens


def test_overlap90_quirks(spark):
    cases = [((5, 9), (5, 9), 1), ((5, 9), (9, 12), 0), ((0, 0), (0, 4), 1), ((0, 10), (1, 10), 1)]
    for tok, sp, want in cases:
        rows, tokens = _rows_tokens(spark, [sp], [tok])
        assert L.label_overlap90(rows, tokens).first()["score"] == want, (tok, sp)


def test_containment(spark):
    rows, tokens = _rows_tokens(spark, [(1, 10)], [(0, 10)])
    assert L.label_containment(rows, tokens).first()["label"] == 0
    rows, tokens = _rows_tokens(spark, [(0, 10)], [(2, 5)])
    assert L.label_containment(rows, tokens).first()["label"] == 1


def test_boundary_quirks(spark):
    note = spark.createDataFrame([(1, [(0, 3), (4, 8)])], "pn_num long, toks array<struct<s:int,e:int>>")
    rows, _ = _rows_tokens(spark, [(5, 8)], [])
    assert L.label_boundary(rows, note).count() == 0          # span starts in the last token
    rows, _ = _rows_tokens(spark, [(0, 3)], [])
    assert [r["p"] for r in L.label_boundary(rows, note).collect()] == [1]


def _mask_tokens(spark, mask):
    return spark.createDataFrame([(1, 1, i + 1, i, i + 1, float(v), v) for i, v in enumerate(mask)],
                                 "pn_num long, feature_num long, tok_no int, s int, e int, prob double, label int")


def test_char_run_decoders(spark):
    t = _mask_tokens(spark, [0, 1, 1, 0, 1])
    keys = ["pn_num", "feature_num"]
    assert D.decode_char_runs(t, keys, F.col("prob") >= 0.5, shift_start=1).first()["location"] == "2 3;5 5"
    assert D.decode_char_runs(t, keys, F.col("label") > 0).first()["location"] == "1 3;4 5"
    tl = spark.createDataFrame([(1, 5)], "pn_num long, text_len int")
    runs = D.runs_transition(t, keys, F.col("prob") >= 0.5, tl).collect()
    assert [(r["start"], r["end"]) for r in runs] == [(1, 3)]


def test_token_run_modes(spark):
    keys = ["pn_num", "feature_num"]
    # run starting at char 0 swallows everything in no-flush mode; trailing run lost
    t = spark.createDataFrame([(1, 1, 1, 0, 3, 0.9), (1, 1, 2, 4, 6, 0.1), (1, 1, 3, 7, 9, 0.9)],
                              "pn_num long, feature_num long, tok_no int, s int, e int, prob double")
    r = D.decode_token_runs(t, keys).first()
    assert r["flush"] == "0 3;7 9" and r["noflush"] == ""
    t2 = spark.createDataFrame([(1, 1, 1, 0, 3, 0.1), (1, 1, 2, 4, 6, 0.9), (1, 1, 3, 7, 9, 0.1)],
                               "pn_num long, feature_num long, tok_no int, s int, e int, prob double")
    r2 = D.decode_token_runs(t2, keys).first()
    assert r2["flush"] == "4 6" and r2["noflush"] == "4 6"


def test_micro_f1_golden(spark):
    pred = spark.createDataFrame([(1, 0, 4)], "r long, start int, end int")
    truth = spark.createDataFrame([(1, 2, 6), (2, 0, 0)], "r long, start int, end int")
    c = M.span_overlap_counts(pred, truth, ["r"])
    out = M.micro_f1(c).first()
    assert (out["tp"], out["fp"], out["fn"], out["f1"]) == (2, 2, 2, 0.5)


def test_norm_feature_text(spark):
    df = spark.createDataFrame([("Last-Pap-smear-I-year-ago",), ("heart-pounding-OR-heart-racing",)], "t string")
    got = [r[0] for r in df.select(norm_feature_text("t")).collect()]
    assert got == ["Last Pap smear 1 year ago", "heart pounding or heart racing"]
