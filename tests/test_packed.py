"""Packed-row operators against plain Python, and the operators that this library's users may see fail."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import __spark_entry__ as E
from spanframe.functions.arrow import paint
from spanframe.functions.text import strip_note, strip_shift
from spanframe.operators import decode as D
from spanframe.operators import models as MD
from spanframe.operators import packed as PK
from spanframe.operators import vocab as V
from spanframe.sources import files as FS

SF = "/root/testdata/sf0.001"
TOKS = "row long, toks array<struct<tok_no:int,s:int,e:int,label:int,prob:double>>"


def _rows(n=60, seed=1):
    rng = random.Random(seed)
    out = []
    for r in range(n):
        at, toks = rng.choice([0, 0, 1, 3]), []
        for k in range(rng.randrange(0, 25)):
            e = at + rng.randrange(0, 5)
            toks.append((k + 1, at, e, int(rng.random() < 0.4), rng.choice([0.1, 0.5, 0.51, 0.9])))
            at = e + rng.randrange(0, 3)
        out.append((r, toks))
    return out


def _char_runs(marked):
    out, chars = [], sorted(marked)
    for c in chars:
        if out and out[-1][1] == c:
            out[-1][1] = c + 1
        else:
            out.append([c, c + 1])
    return ";".join(f"{a} {b}" for a, b in out)


def test_char_decoder_equals_a_char_mask(spark):
    rows = _rows()
    d = PK.decode_chars(spark.createDataFrame(rows, TOKS), lambda x: x["prob"] >= 0.5)
    got = {r.row: r.location for r in d.collect()}
    for row, toks in rows:
        assert got[row] == _char_runs({c for _, s, e, _, p in toks if p >= 0.5 for c in range(s, e)})


def test_token_decoders_equal_the_long_form(spark):
    rows = [(r, [t for t in toks if t[1] < t[2]]) for r, toks in _rows(80, 5)]
    rows = [(r, [(k + 1, *t[1:]) for k, t in enumerate(toks)]) for r, toks in rows]
    packed = spark.createDataFrame(rows, TOKS)
    got = PK.decode_tokens(packed).select("row", "flush", "noflush").filter(F.size("toks") > 0).collect()
    long = packed.select("row", F.inline("toks"))
    assert sorted(got) == sorted(D.decode_token_runs(long, ["row"]).collect()) and len(got) > 50


def test_overlap_lengths_equal_char_sets(spark):
    rng = random.Random(2)
    spans = lambda: [(s, s + rng.randrange(0, 9)) for s in (rng.randrange(0, 60) for _ in range(rng.randrange(0, 8)))]
    rows = [(k, spans(), spans()) for k in range(150)]
    d = spark.createDataFrame(rows, "k long, p array<struct<start:int,end:int>>, t array<struct<start:int,end:int>>")
    got = {r.k: tuple(r.c) for r in d.select("k", PK.overlap_lengths(F.col("p"), F.col("t")).alias("c")).collect()}
    for k, p, t in rows:
        a, b = ({c for s, e in x for c in range(s, e)} for x in (p, t))
        assert got[k] == (len(a & b), len(a - b), len(b - a))


def test_count_at_most(spark):
    rng = random.Random(3)
    rows = [(sorted(rng.randrange(50) for _ in range(rng.randrange(0, 70))), rng.randrange(-2, 52)) for _ in range(200)]
    d = spark.createDataFrame(rows, "v array<int>, b int").select("v", "b", PK.count_at_most(F.col("v"), F.col("b")).alias("n"))
    assert all(r.n == sum(x <= r.b for x in r.v) for r in d.collect())


def _painted(intervals):
    text = {}
    for k, (s, e) in enumerate(intervals):
        text |= {c: k for c in range(s, e)}
    out = []
    for c in sorted(text):
        if out and out[-1][1] == c and out[-1][2] == text[c]:
            out[-1][1] = c + 1
        else:
            out.append([c, c + 1, text[c]])
    return [tuple(x) for x in out]


def test_paint(spark):
    """The tail of an outer interval comes back after a nested one; any order and overlap."""
    rng = random.Random(4)
    rows = [[(0, 10), (2, 5)], [], [(3, 3)], [(4, 6), (0, 9)], [(0, 2), (2, 4)]]
    rows += [[(s, s + rng.randrange(0, 12)) for s in (rng.randrange(0, 30) for _ in range(rng.randrange(0, 9)))] for _ in range(200)]
    d = spark.createDataFrame([(k, [s for s, _ in r], [e for _, e in r]) for k, r in enumerate(rows)],
                              "k long, s array<int>, e array<int>")
    got = {r.k: [tuple(x) for x in r.p] for r in d.select("k", paint("s", "e").alias("p")).collect()}
    assert got[0] == [(0, 2, 0), (2, 5, 1), (5, 10, 0)]
    assert all(got[k] == _painted(r) for k, r in enumerate(rows))


def test_pack_tokens(spark):
    texts = [None, "", " ,. ", "Ab c2d", "  É日x-y ", "a" * 5000, "w " * 3000]
    d = spark.createDataFrame(list(enumerate(texts)), "k long, t string").repartition(2)
    for r in PK.pack_tokens(d, ["k"], "t").collect():
        words = [(m.group().lower(), m.start(), m.end()) for m in re.finditer(r"[^\W_]+", texts[r.k] or "")]
        assert list(zip(r.words or [], r.s or [], r.e or [])) == words and (r.s is None) == (texts[r.k] is None)


def test_strip_takes_unicode_blanks(spark):
    texts = ["\xa0a b　", " \t x", "", "\x1c\x85", "a", None, "​z"]
    d = spark.createDataFrame([(t,) for t in texts], "t string").select("t", strip_note("t").alias("x"), strip_shift("t").alias("n"))
    for r in d.collect():
        assert r.x == (r.t and r.t.strip()) if r.t is not None else r.x is None
        assert r.t is None or r.n == len(r.t) - len(r.t.lstrip())


def test_strict_lookup_fails_on_an_unknown_word(spark):
    tokens = spark.createDataFrame([("a",), ("b",), ("a",)], "token string")
    vocab = spark.createDataFrame([("a", 0), ("b", 1)], "token string, idx int")
    assert sorted(r.idx for r in V.encode_strict(tokens, vocab).collect()) == [0, 0, 1]
    with pytest.raises(PySparkException, match="not in the vocabulary: b"):
        V.encode_strict(tokens, vocab.filter("idx = 0")).collect()


@pytest.mark.parametrize("sep", [1, 2])
def test_truncated_pair(spark, sep):
    rng, width = random.Random(sep), 12
    rows = [(k, [rng.randrange(3, 99) for _ in range(rng.randrange(0, 14))], [rng.randrange(3, 99) for _ in range(rng.randrange(0, 14))])
            for k in range(80)]
    d = spark.createDataFrame(rows, "k long, f array<int>, n array<int>")
    starts, ends = F.transform("n", lambda _, i: i * 3), F.transform("n", lambda _, i: i * 3 + 2)
    got = {r.k: r.x for r in d.select("k", V.truncated_pair(F.col("f"), F.col("n"), starts, ends, sep, width).alias("x")).collect()}
    for k, f, n in rows:
        head = [V.CLS, *f, *[V.SEP] * sep]
        ids = (head + n)[: width - 1] + [V.SEP]
        types = [0 if sep == 2 or i < len(head) else 1 for i in range(len(ids))]
        offsets = ([(0, 0)] * len(head) + [(i * 3, i * 3 + 2) for i in range(len(n))])[: width - 1] + [(0, 0)]
        pad = width - len(ids)
        x = got[k]
        assert x.input_ids == ids + [V.PAD] * pad and x.token_type_ids == types + [0] * pad
        assert [tuple(o) for o in x.offset_mapping] == offsets + [(0, 0)] * pad


def test_log_append_is_idempotent(spark):
    path = FS.scratch(spark, "log")
    rows = lambda *r: spark.createDataFrame(list(r), "run string, epoch long, loss double")
    for batch in ([("a", 1, 0.5), (None, 1, 0.7)], [("a", 1, 0.5), (None, 1, 0.7)], [("a", 2, 0.4), ("a", 1, 0.9)]):
        FS.append_log(rows(*batch), path, keys=("run", "epoch"))
    assert sorted(map(str, spark.read.parquet(path).collect())) == sorted(map(str, rows(("a", 1, 0.5), (None, 1, 0.7), ("a", 2, 0.4)).collect()))


def test_half_written_cache_is_not_read(spark):
    root = FS.scratch(spark, "cache")
    spark.range(3).write.parquet(f"{root}/data-lost")  # a job that was lost before its commit
    calls = []

    def build():
        calls.append(1)
        return spark.range(7)

    assert [FS.compute_or_load(spark, root, build).count() for _ in range(3)] == [7, 7, 7] and calls == [1]


def test_every_row_is_scored_by_a_model_that_never_saw_its_fold(spark):
    rows = spark.createDataFrame([(i, i % 3, int(i % 5 < 2), int(i % 5 < 2 and i % 7 > 0)) for i in range(300)],
                                 "k long, fold long, label int, x int").withColumn("n", F.lit(1))
    seen = {}

    def fit(train):
        m = MD.naive_bayes(train, ["x"])
        seen[tuple(sorted(r.fold for r in train.select("fold").distinct().collect()))] = m
        return m

    out = MD.cross_validated(rows, "fold", fit, lambda m, d: MD.positive_share(m, d, ["x"]), range(3)).collect()
    assert len(out) == 300 and set(seen) == {(0, 1), (0, 2), (1, 2)}
    assert all(r.fold not in r.model_folds and sorted([*r.model_folds, r.fold]) == [0, 1, 2] for r in out)
    right = sum((r.prob >= 0.5) == (r.label == 1) for r in out)
    assert right > sum(r.label == 0 for r in out)  # better than the majority


def test_pr_curve_is_that_of_every_distinct_score(spark):
    rng = random.Random(8)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(20) / 20, rng.randrange(2)) for _ in range(400)] + [("c", 0.5, 0)]
    from spanframe.operators.metrics import pr_curve

    got = pr_curve(spark.createDataFrame(rows, "cls string, score double, y int"), "cls", "score", F.col("y")).collect()
    assert {(r.cls, r.threshold) for r in got} == {(c, s) for c, s, _ in rows}
    for r in got:
        above = [y for c, s, y in rows if c == r.cls and s >= r.threshold]
        total = sum(y for c, _, y in rows if c == r.cls)
        assert (r.tp, r.fp, r.fn) == (sum(above), len(above) - sum(above), total - sum(above))
        assert r.recall == (pytest.approx(sum(above) / total, abs=1e-6) if total else None)


@pytest.mark.parametrize("key", ["stream_decode", "stream_encode"])
def test_streams_equal_batch(spark, key):
    from spanframe.plans.catalog.vocab import OOV, _vocab
    from spanframe.plans.fixtures import Bindings
    from spanframe.streaming import decode as SD

    fx = Bindings(spark, SF)
    batch = SD.decoded_rows(fx.notes, fx.features) if key == "stream_decode" else SD.encoded_words(fx.notes, _vocab(fx), OOV)
    got = E.queries()[key](spark, SF)
    assert got.columns == batch.columns and sorted(got.collect()) == sorted(batch.collect())


def test_one_tokenising_pass(spark):
    """No key below reads a note's words twice, and no run decoder shuffles or windows tokens."""
    import contextlib
    import io

    for key in ("char_micro_f1", "decode_token_runs", "decode_runs_exact", "char_prf", "label_overlap90", "roc_auc", "islands_runs"):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            E.queries()[key](spark, SF).explain()
        plan = buf.getvalue()
        assert plan.count("ArrowEvalPython") <= 1, key
        if "decode" in key:
            assert "Window" not in plan and "SortMergeJoin" not in plan, key
