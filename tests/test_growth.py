"""What keeps the time and disk of the large queries down, and that their results stay the same."""

import math
import re

import pytest
from pyspark.sql import functions as F

from spanframe.functions import numeric as N
from spanframe.operators import decode as D
from spanframe.plans.registry import load_all

SF_SMALL = "/root/testdata/sf0.001"


def plan(spark, name):
    return load_all()[name].build(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()


def test_rounded_equals_round(spark):
    values = [None, 0.0, -0.0, 1e-9, -1e-9, 0.5e-6, 1.5e-6, -2.5e-6, 0.1234565, 0.1234575, -0.1234565, 2 / 3, -2 / 3, 999.9999995,
              1e3 + 0.5e-6, 123456789.123456, -1e15, 1e300, float("inf"), float("-inf"), float("nan"), *[k / 1e7 for k in range(-40, 40)]]
    rows = spark.createDataFrame([(x,) for x in values], "x double").select("x", F.round("x", 6).alias("a"), N.rounded("x").alias("b"),
                                                                            F.round("x", 2).alias("c"), N.rounded("x", 2).alias("d"))
    for r in rows.collect():
        for a, b in ((r.a, r.b), (r.c, r.d)):
            assert repr(a) == repr(b), r


def test_no_token_is_drawn_in_a_lambda(spark):
    p = plan(spark, "char_pred_3class")
    assert p.count("md5(") == 1 and not re.search(r"lambdafunction\([^\n]*md5\(", p)


def test_a_note_is_painted_once_for_all_its_rows(spark):
    p = plan(spark, "char_pred_3class")
    assert "paint(" in p.split("Join Inner, (case_num", 1)[1]  # below the join with the features


@pytest.mark.parametrize("offsets", [[(0, 3), (4, 5), (5, 9)], [(0, 9), (2, 4), (3, 3)], [(1, 2)], [], [(0, 4), (0, 4)]])
def test_3class_of_notes_equals_3class_of_rows(spark, offsets):
    probs = [[0.1 * (k + 1) + 0.05 * j for k in range(len(offsets))] for j in range(2)]
    note = spark.createDataFrame([(1, [a for a, _ in offsets], [b for _, b in offsets]), (2, None, None)], "pn int, s array<int>, e array<int>")
    rows = note.join(spark.createDataFrame([(1, 0, probs[0]), (1, 1, probs[1]), (2, 0, None)], "pn int, f int, prob array<double>"), "pn")
    toks = rows.select("pn", "f", F.arrays_zip("s", "e", "prob").alias("toks"))
    classes = lambda p: (1 - p, 0.3 * p, 0.7 * p)

    def scored(painted, items):
        x = painted.join(rows.select("pn", "f", "prob"), "pn").select("pn", "f", "s", "prob", F.explode(items).alias("x"))
        return x.select("pn", "f", "x.start", "x.end", F.get("s", "x.item").alias("s"), F.get("prob", "x.item").alias("prob"))

    a = sorted(map(tuple, D.paint_3class(toks, ["pn", "f"], classes).collect()))
    b = sorted(map(tuple, D.paint_3class(note, ["pn", "f"], classes, scored=scored).collect()))
    seen = {}  # the literal definition, char by char
    for j in range(2):
        for k, (s, e) in enumerate(offsets):
            for c in range(s, e):
                p = probs[j][k]
                seen[j, c] = (1 - p, 0.3 * p, 0.7 * p) if c == s else (1 - p, 0.7 * p, 0.3 * p)
    chars = {(f, c): p for _, f, start, end, *p in a for c in range(start, end)}
    assert a == b and {k: tuple(v) for k, v in chars.items()} == seen
    assert all(math.isfinite(x) for r in a for x in r)


def test_sums_of_parts_round_like_the_sum_of_the_whole(spark):
    import random

    from spanframe.plans.catalog import vectors as X

    rnd = random.Random(3)
    vec = lambda n, scale: [rnd.uniform(-1, 1) * scale for _ in range(n)]
    rows = [(vec(rnd.randint(0, 9), 10.0 ** rnd.randint(-8, 9)), vec(rnd.randint(0, 9), 10.0 ** rnd.randint(-8, 9))) for _ in range(400)]
    rows += [([0.1, 0.2], [0.3, -0.5999995]), ([1e-6], [0.5e-6]), ([0.25e-6], [0.25e-6]), ([1e300], [1e300]), ([float("nan")], [1.0]),
             ([float("inf")], [-1.0]), ([None, 1.0], [2.0]), ([], []), ([1e16, 1.0], [-1e16]), ([0.0] * 5, [-0.0])]
    d = spark.createDataFrame(rows, "a array<double>, b array<double>").withColumn("cat", F.concat("a", "b"))
    d = X._with_vsum(d, "cat", [N.vec_sum("a"), N.vec_sum("b")], [N.vec_abs_sum("a"), N.vec_abs_sum("b")])
    for r in d.withColumn("want", X._vsum(F.col("cat"))).collect():
        assert repr(r.vsum) == repr(r.want), r


def test_a_text_is_not_matched_for_each_of_its_segments(spark):
    """Inlined into the lambda that picks the words, the test of a text's first char would run once a segment."""
    assert not re.search(r"lambdafunction\([^\n]*RLIKE", plan(spark, "concat_feature_token_vec"))


def test_vectors_of_features_are_not_shuffled_with_rows(spark):
    """Features get their vectors before they meet the notes."""
    p = plan(spark, "concat_feature_token_vec")
    assert re.search(r"Join LeftOuter, \(feature_num#\w+ = feature_num#\w+\)", p.split("Join Inner, (case_num", 1)[1])


def test_notes_with_one_number_meet_each_other(spark, tmp_path):
    """Every scored row meets every note of its number, over the tokens that both have."""
    docs = [(1, "b a c d"), (1, "a b"), (2, None), (3, "..."), (None, "a b"), (5, "x a")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, "a z"), (1, "b"), (None, "c")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    emb = [(0, [1.0, 2.0]), (1, [4.0, 8.0]), (1, [16.0, 32.0]), (7, [64.0])]
    spark.createDataFrame(emb, "vec_id long, embedding array<float>").withColumn("label", F.lit(0)).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = sorted(tuple(r) for r in load_all()["concat_feature_token_vec"].build(spark, str(tmp_path)).collect())

    words = [(1, ["b", "a", "c", "d"]), (1, ["a", "b"]), (5, ["x", "a"])]
    count = {w: sum(x == w for _, ws in [*words, (None, ["a", "b"])] for x in ws) for w in "abcdx"}  # "a" is a stop word
    ids = {w: k for k, w in enumerate(sorted((w for w in count if w != "a"), key=lambda w: (-count[w], w)))}
    vectors = lambda k: [v for i, v in emb if i == k] or [[0.0, 0.0]]
    want = [(pn, f, k + 1, len(v) + len(u), float(sum(v) + sum(u))) for pn, ws in words for other, row in words if other == pn
            for f in (0, 1) for u in vectors(f) for k, w in enumerate(ws[:len(row)]) for v in vectors(ids.get(w, 5000))]
    assert got == sorted(want)


def test_losses_are_compiled_and_the_key_of_a_row_is_made_once(spark):
    """No loss is a lambda over an array, and ids become text below the explode, not once a token."""
    p = plan(spark, "row_losses")
    assert "aggregate(" not in p and "array_max(" not in p
    assert "concat_ws(" not in p.split("posexplode(")[0] and "concat_ws(" in p


@pytest.mark.parametrize("k", [2, 3])
def test_cross_entropy_of_columns_equals_that_of_an_array(spark, k):
    rows = [(0, 0.0, 1.5, -2.0), (1, 0.0, 1.5, 700.0), (2, -800.0, 800.0, 0.1), (0, 0.0, None, 1.0), (None, 1.0, 2.0, 3.0), (-1, 1.0, 2.0, 3.0),
            (1, float("nan"), 1.0, 2.0), (5, 1.0, 2.0, 3.0), (1, float("-inf"), 0.0, 0.0)]
    d = spark.createDataFrame(rows, "label int, a double, b double, c double")
    cols = [F.col(c) for c in "abc"[:k]]
    for r in d.select(N.cross_entropy(F.array(*cols), "label").alias("x"), N.cross_entropy(cols, "label").alias("y")).collect():
        assert repr(r.x) == repr(r.y), r


def test_the_fold_joins_the_note_not_its_tokens(spark):
    above = plan(spark, "union_oof").split("posexplode(")[0]
    assert "Join" not in above and "concat_ws(" not in above


def test_a_folder_for_each_value_is_written_without_a_sort(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameWriter

    from spanframe.sources import files as FS

    before, seen = spark.conf.get(FS.WRITERS), []
    one = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: seen.append(spark.conf.get(FS.WRITERS)) or one(self, *a, **k))
    rows = [(k, None if k % 7 == 3 else k % 7) for k in range(500)]  # more values than files are kept open
    FS.write_by(spark.createDataFrame(rows, "x long, v long").coalesce(2), f"{tmp_path}/t", "v", most=5)
    assert seen == ["6"] and spark.conf.get(FS.WRITERS) == before
    got = spark.read.parquet(f"{tmp_path}/t")
    assert sorted((r.x, r.v) for r in got.collect()) == rows

    def fails(self, *a, **k):
        raise OSError("full")

    monkeypatch.setattr(DataFrameWriter, "parquet", fails)
    with pytest.raises(OSError):
        FS.write_by(spark.range(3), f"{tmp_path}/u", "id", most=5)
    assert spark.conf.get(FS.WRITERS) == before


def test_characters_are_found_in_pieces(spark):
    """A run's edges are not looked up by a walk through the whole text."""
    rnd = __import__("random").Random(7)
    texts = ["".join(rnd.choice("ab \U0001F600é") for _ in range(n)) for n in (1, 255, 256, 257, 511, 512, 513, 2000)] + [" " * 700, "", None]
    rows = []
    for k, t in enumerate(texts):
        cut = sorted(rnd.sample(range(0, 2100), 40))
        rows += [(k, t, [(a, b) for a, b in zip(cut[j::2], cut[j + 1::2])]) for j in (0, 1)] + [(k, t, [(0, 5000)]), (k, t, []), (k, t, None)]
        if t:
            rows.append((k, t, [(a, a + 1) for a in range(0, len(t), 2)]))
    d = spark.createDataFrame(rows, "k int, clean string, runs array<struct<start:int,end:int>>")

    def want(t, runs):  # the rule on the whole text
        n, out = len(t), []
        clipped = [(max(a, 0), n - 1 if b >= n and t[-1:] == " " else min(b, n)) for a, b in runs]
        for a, b in [x for x in clipped if x[0] < x[1]]:
            if out and a - out[-1][-1] == 1 and t[a - 1] == " " and t[out[-1][-1] - 1] != " ":
                out[-1][-1] = b
            else:
                out.append([a, b])
        out = [(a + len(t[a:own]) - len(t[a:own].lstrip(" ")), b - (t[b - 1] == " ")) for (a, b), own in zip(out, _first_ends(out, clipped))]
        return [x for x in out if x[0] < x[1]]

    def _first_ends(out, clipped):
        ends = dict(reversed([x for x in clipped if x[0] < x[1]]))
        return [ends[a] for a, _ in out]

    for r in D.clean_blank_edges(d, "clean", "runs", "pp").collect():
        if r.runs is None:
            assert r.pp is None
        elif r.clean is not None:
            assert [tuple(x) for x in r.pp] == want(r.clean, r.runs), r
    assert "substring(clean" not in plan(spark, "postprocess_spaces")


def test_draws_are_md5_of_key_and_number():
    import hashlib

    import numpy as np

    from spanframe.functions import arrow

    keys = [b"12_3_", b"", b"x" * 60, b"-9223372036854775808_-9223372036854775808_", b"1_", b"y" * 53]
    counts = np.array([1200, 3, 4, 20000, 0, 12])
    want = [int(hashlib.md5(k + str(i).encode()).hexdigest()[:8], 16) for k, n in zip(keys, counts) for i in range(1, n + 1)]
    assert arrow.numbered_draws(keys, counts, 777).tolist() == want


def test_scores_by_batch_equal_scores(spark):
    from spanframe.plans import fixtures as FX

    rows = [(-7, 3, ["a", "b", "a"], "a"), (1 << 62, 1 << 61, ["b"] * 150, "b"), (1, 2, [], "a"), (1, 2, None, "a"), (5, 6, ["x", "y"], None)]
    d = spark.createDataFrame(rows, "pn_num long, feature_num long, words array<string>, term string")
    d = d.withColumns({"s": F.transform("words", lambda w, i: i * 3), "e": F.transform("words", lambda w, i: i * 3 + 2)}).coalesce(1)
    a, b = (sorted((r.pn_num, repr(r.words), repr(r.toks)) for r in f(d).collect()) for f in (FX.score, FX.score_by_batch))
    assert a == b and a[-1][2].count("tok_no") == 150


@pytest.mark.parametrize("name", ["postprocess_spaces", "cv_scores_rollup"])
def test_draws_of_a_batch_are_hashed_side_by_side(spark, name):
    assert "drawn_tokens(" in plan(spark, name) and "md5(" not in plan(spark, name)
