"""Candidates by name and by shape, dictionary features from the uncapped word table, against plain Python."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from spanframe.llm import secret_scan as ss


def _docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


@pytest.mark.parametrize("text, token", [
    ('password = "correcthorsebatterystaple"', "correcthorsebatterystaple"),
    ("password=hunter2ab", "hunter2ab"),
    ('token = "abcdefghijABCDEFGHIJklmnopqr"', "abcdefghijABCDEFGHIJklmnopqr"),
    ("db_password: p!ss;word", "p!ss"),
    ('{"api_key" : "Zm9vYmFyYmF6cXV4MTIz=="}', "Zm9vYmFyYmF6cXV4MTIz=="),
])
def test_every_value_of_a_secret_name_is_judged(spark, text, token):
    got = ss.scan_secrets(_docs(spark, [text])).collect()
    assert [(r.start, r.token) for r in got] == [(text.index(token), token)] and got[0].is_secret


def test_spans_are_apart():
    rng = random.Random(1)
    bits = ["password=", "key: ", "a1b2c3d4e5f6g7", "hunter2ab", " ", '"', "word ", "token=", "0123456789abcdef/x", "\n"]
    for _ in range(500):
        text = "".join(rng.choices(bits, k=12))
        got = ss.spans(text)
        assert all(a[1] <= b[0] for a, b in zip(got, got[1:])) and all(b < e for b, e in got)


def test_features_use_all_words_of_the_corpus(spark):
    """More words than the 20,000 that an earlier form kept, each in three documents."""
    rng = random.Random(7)
    letters = "abcdefghijklmnop"
    vocab = sorted({"".join(rng.choices(letters, k=rng.randrange(4, 9))) for _ in range(26_000)})[:24_000]
    texts = [" ".join(vocab[k::8]) for k in range(8)] * 3
    asks = rng.sample(vocab, 60)
    texts += [f"{asks[k]} zz1 {a}-{'q' * 5}{k}12345678 {asks[-k]} 7" for k, a in enumerate(asks)]
    counts = Counter(w for t in texts for w in set(t.lower().split()) if w.isalpha() and len(w) < 30)
    assert sum(n >= 3 for n in counts.values()) >= 24_000
    pairs = Counter()
    for w, n in counts.items():
        for i in range(len(w) - 1):
            pairs[w[i : i + 2]] += n
    first = Counter()
    for p, n in pairs.items():
        first[p[0]] += n
    log = lambda p: math.log((pairs[p] + 1) / (first[p[0]] + 26)) if re.fullmatch("[a-z]{2}", p) else -9.0
    d = _docs(spark, texts)
    got = ss.candidates(d, ss.corpus_words(d)).collect()
    assert len(got) == 60
    word = {w for w, n in counts.items() if n >= 3}
    for r in got:
        f = dict(zip(ss.FEATURES, r.features))
        low = r.token.lower()
        assert f["coverage"] == pytest.approx(sum(len(p) for p in re.findall("[a-z]{3,}", low) if p in word) / len(low))
        assert f["coverage"] > 0.15  # the rarest words count too
        assert f["transition"] == pytest.approx(sum(log(low[i : i + 2]) for i in range(len(low) - 1)) / (len(low) - 1))
        text = texts[r.id]
        left, right = (re.findall(r"\w+", x) for x in (text[max(0, r.start - 40) : r.start], text[r.start + r.length :][:40]))
        assert f["left_words"] == pytest.approx(sum(w.lower() in word for w in left[-3:]) / 3)
        assert f["right_words"] == pytest.approx(sum(w.lower() in word for w in right[:3]) / 3)
