"""Each query against its plain-Python version over the whole smoke tables."""

from __future__ import annotations

import random

import pytest

from spanframe.llm import decontaminate, mixing, near_dedup, queries, url_filter
from spanframe.llm.components import components

from . import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source").collect()
    return sorted(rows, key=lambda r: r.doc_id)


def run(spark, name):
    return queries.QUERIES[name](spark, SF).collect()


def test_decontaminate(spark, docs):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id): r.distance for r in run(spark, "op1_decontaminate")}
    assert got == brute.leaks([(r.doc_id, r.text) for r in docs], items)


def test_decontaminate_finds_edited_windows(spark):
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(4000)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.randrange(12, 50)))) for i in range(12)]
    rows = []
    for d in range(150):
        w = rng.choices(vocab, k=120)
        x = items[d % 12][1].split()
        k = rng.randrange(0, int(0.2 * len(x)) + 1) if d < 120 else 3 * len(x) // 4
        for p in rng.sample(range(len(x)), k):
            x[p] = "edited"
        rows.append((d, " ".join(w[:40] + x + w[40:])))
    want = brute.leaks(rows, items)
    got = {(r.doc_id, r.item_id): r.distance for r in decontaminate.decontaminate(
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert set(got) <= set(want) and len(got) >= 0.98 * len(want) > 100
    assert all(got[k] == want[k] for k in got)


def _edited(kind, seed=5):
    """(documents, items): each document holds an item with words changed, inserted or deleted up to the bound."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.randrange(12, 50)))) for i in range(12)]
    rows = []
    for d in range(96):
        x = items[d % 12][1].split()
        k = int(0.2 * len(x)) // 2 if kind != "change" else int(0.2 * len(x))
        for _ in range(k):
            p = rng.randrange(1, len(x) - 1)
            x[p : p + (kind != "insert")] = [] if kind == "delete" else [f"e{rng.randrange(99)}"]
        w = rng.choices(vocab, k=80)
        rows.append((d, " ".join(w[:40] + x + w[40:])))
    return rows, items


def _leaks(spark, rows, items, **options):
    return {(r.doc_id, r.item_id): (r.n_windows, r.first_word, r.distance) for r in decontaminate.decontaminate(
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"), **options).collect()}


@pytest.mark.parametrize("kind", ["insert", "delete"])
def test_decontaminate_finds_inserted_and_deleted_words(spark, kind):
    rows, items = _edited(kind)
    want = brute.leaks(rows, items)
    got = _leaks(spark, rows, items)
    assert set(got) <= set(want) and len(got) >= 0.98 * len(want) >= 90
    assert all(got[k][2] >= want[k] for k in got)


def test_decontaminate_is_exact_where_walks_do_not_reach_the_target(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "MAX_WALKS", 4)
    rows, items = _edited("change")
    assert {k: v[2] for k, v in _leaks(spark, rows, items, target_recall=1.1).items()} == brute.leaks(rows, items)


def test_a_text_scanned_in_pieces_reports_an_item_once():
    rows, items = _edited("change")
    text = " ".join(t for _, t in rows)
    m = decontaminate.Matcher([(i, decontaminate.words_of(t)) for i, t in items], 0.8, 0.99, 2, 7)
    whole, pieces = list(m.scan([text, "", None])), list(m.scan([text, "", None], most_windows=7))
    assert whole == pieces and len(whole) == len({(r, i) for r, i, *_ in whole}) == 12


def test_benchmark_in_blocks_gives_the_same(spark):
    b, d = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("benchmark", "documents"))
    one = decontaminate.decontaminate(d, b).select("doc_id", "item_id", "distance").collect()
    many = decontaminate.decontaminate(d, b, block_words=500).select("doc_id", "item_id", "distance").collect()
    assert sorted(one) == sorted(many)


def test_quality(spark, docs):
    got = {r.doc_id: r for r in run(spark, "op2_quality_rules")}
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for r in docs:
        n, *_, repeat = want = brute.quality(r.text)
        g = got[r.doc_id]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == want
        assert g.base_failed == (n < 10 or 100 * repeat > 20 * n)
        assert not (g.base_failed and g.kept)
        if r.doc_id in quality and not g.base_failed:
            assert g.kept == (quality[r.doc_id] == 1)


def test_mixing(spark, docs):
    got = run(spark, "op3_mix_sources")
    size, taken = {}, {}
    for r in docs:
        size[r.source] = size.get(r.source, 0) + len(brute.words(r.text))
    source = {r.doc_id: r.source for r in docs}
    want = brute.targets(size)
    for r in got:
        s = source[r.doc_id]
        taken[s] = taken.get(s, 0) + r.taken
        assert r.source_size == size[s] and r.target == pytest.approx(want[s])
        assert 0 <= r.taken <= 2 * r.size
    assert all(abs(taken[s] - want[s]) < 1 for s in size)
    again = run(spark, "op3_mix_sources")
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)


def test_mixed_text_is_the_plan(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    documents, targets, plan = mixing.mix(d, block_words=100, shard_slots=50)
    rows = mixing.mixed_text(d, plan).collect()
    text = {r.doc_id: brute.words(r.text) for r in d.collect()}
    slots = {}
    for r in rows:
        assert r.text.split(" ") == text[r.doc_id][r.first_word : r.first_word + r.n_words]
        slots.setdefault((r.shard, r.slot), []).append((r["at"], r.n_words, r.source))
        assert r.shard == r.slot // 50
    for parts in slots.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(parts, parts[1:]))
        assert len({p[2] for p in parts}) == 1 and parts[-1][0] + parts[-1][1] <= 100
    got = mixing.taken_words(documents, targets, plan).agg({"taken": "sum"}).first()[0]
    assert got == sum(r.n_words for r in rows)


@pytest.mark.parametrize("n", [1, 2, 7, 64, 1000])
def test_permutation(spark, n):
    from pyspark.sql import functions as F
    d = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), F.lit(3)).alias("p"))
    assert sorted(r.p for r in d.collect()) == list(range(n))


def test_line_dedup(spark, docs):
    want = brute.dedup_lines([(r.doc_id, r.text) for r in docs])
    for r in run(spark, "op4_line_dedup"):
        assert r.kept_sha256 == brute.sha(want[r.doc_id])


@pytest.mark.parametrize("m", [1, 2, 3, 4, 5, 7])
def test_line_dedup_depths(spark, m):
    from spanframe.llm.line_dedup import dedup_lines
    rng = random.Random(m)
    rows = [(d, "\n".join(rng.choice("abc") for _ in range(rng.randrange(0, 30)))) for d in range(40)]
    want = brute.dedup_lines(rows, m)
    got = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), m).collect()
    assert {r.doc_id: r.text for r in got} == want


@pytest.mark.parametrize("m, words", [(1, 2), (2, 3), (3, 4), (3, None), (5, 6), (7, 5)])
def test_line_dedup_of_few_lines_with_many_words(spark, m, words):
    from spanframe.llm.line_dedup import dedup_lines
    rng = random.Random(m)
    line = lambda: " ".join(rng.choice("ab") for _ in range(rng.randrange(0, 4)))
    rows = [(d, "\n".join(line() for _ in range(rng.randrange(0, 25)))) for d in range(40)]
    rows += [(40, "c d e f g h"), (41, "x\nc d e f g h\ny"), (42, "c d e\nf g h\nz"), (43, "q\nc d e\nf g h")]
    want = brute.dedup_lines(rows, m, words)
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = dedup_lines(d.unionByName(d.filter("doc_id % 7 = 0")), m, words).collect()  # a row repeated in full cuts nothing more
    assert {r.doc_id: r.text for r in got} == want


def test_licenses(spark, docs):
    want = {r.doc_id: brute.licence_base(r.text) for r in docs}
    for r in run(spark, "op5_license_scan"):
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == want[r.doc_id]
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_licence_templates(spark):
    from spanframe.llm.licenses import TEMPLATES, scan_licenses
    rng = random.Random(2)
    rows = []
    for i, t in enumerate(TEMPLATES):
        noise = [rng.choice("the of and this license software".split()) for _ in range(60)]
        rows.append((i, " ".join(noise[:30]) + " " + t.text.upper() + " " + " ".join(noise[30:])))
        rows.append((100 + i, " ".join(rng.sample(t.text.split(), len(t.text.split())))))  # the words, in disorder
    got = {r.doc_id: {f.label for f in r._findings if f.kind == "template"} for r in scan_licenses(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(t.label in got[i] for i, t in enumerate(TEMPLATES))
    assert sum(t.label in got[100 + i] for i, t in enumerate(TEMPLATES)) == 0


def test_substring_dedup(spark, docs):
    want = brute.dedup_passages([(r.doc_id, r.text) for r in docs])
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in run(spark, "op6_substring_dedup")} == want


def test_substring_dedup_with_shared_anchors(spark, monkeypatch):
    """Few words, so anchors recur in many contexts; tiny shards and salts."""
    from spanframe.llm import substring_dedup
    monkeypatch.setattr(substring_dedup, "SALT_ROWS", 3)
    rng = random.Random(6)
    base = [rng.choice("abcd") for _ in range(200)]
    rows = []
    for d in range(60):
        w = list(base[rng.randrange(100):][: rng.randrange(0, 90)])
        for _ in range(rng.randrange(0, 3)):
            if w:
                w[rng.randrange(len(w))] = rng.choice("abcd")
        rows.append((d, " ".join(w)))
    want = brute.dedup_passages(rows, 6)
    got = substring_dedup.dedup_passages(spark.createDataFrame(rows, "doc_id long, text string"), window=6, anchor=2)
    assert {r.id: (r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()} == want


def test_urls(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    url = {r.page_id: r.url for r in pages}
    for r in run(spark, "op7_url_filter"):
        rule = brute.url_rule(url[r.page_id], queries.URL_RULES)
        assert (r.host, r.path) == brute.url_parts(url[r.page_id])
        assert r.rule == (rule and rule.host + rule.path)
        assert r.verdict == (rule.verdict if rule else "allow")


def test_url_aliases(spark):
    link = '<link rel="canonical" href="{}">'
    rows = [
        (1, "http://a.example.org/es/x", ""),
        (2, "http://b.net/alias", link.format("http://a.example.org/es/x?utm_source=q")),
        (3, "https://www.b.net/alias/#top", None),
        (4, "http://c.net/p", '<meta http-equiv="refresh" content="0; url=/q">'),
        (5, "http://c.net/q", "<LINK href='//shop.com/de/1' rel=canonical>"),
        (6, "http://z.com/fr/1", ""),
        (7, "http://y.net/1", link.format("http://z.com/fr/1")),
        (8, "http://y.net/1/", link.format("http://shop.com/de/2")),
        (9, "http://alone.net/", ""),
    ]
    got = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, html string"),
                           url_filter.rule_table(spark, queries.URL_RULES),
                           spark.createDataFrame([("http://r.net/", "http://c.net/p")], "from_url string, to_url string"))
    verdict = {r.page_id: r._verdict for r in got.collect()}
    assert verdict == {1: "block", 2: "block", 3: "block", 4: "block", 5: "block", 6: "allow", 7: "allow", 8: "allow",
                       9: "allow"}


def test_page_links(spark):
    page = "http://Site.com/a/b/c?x=1"
    rows = [
        (page, '<link rel="canonical" href="../d"><link href=./e rel=canonical>', {"http://Site.com/a/d", "http://Site.com/a/b/e"}),
        (page, "<meta http-equiv=refresh content='0; url=?q=2'><META http-equiv='Refresh' content='5;URL=/f/../g'>",
         {"http://Site.com/a/b/c?q=2", "http://Site.com/g"}),
        (page, '<base href="/root/"><meta property="og:url" content="h&amp;i"><meta content="//o.net/j" property="og:url">',
         {"http://Site.com/root/h&i", "http://o.net/j"}),
        (page, '<link rel="nofollow canonical" href="https://p.net/x/">', {"https://p.net/x/"}),
        (page, '<link rel=canonical href="javascript:void(0)"><link rel=canonical href="">'
               '<link rel=canonical href="http://[x/"><link rel="canonicals" href="/no"><a href="/no">', set()),
        (page, None, set()), (None, '<link rel=canonical href="/a">', set()), (page, "", set()),
        (page, "<link " * 20_000, set()),
    ]
    for url, html, want in rows:
        d = spark.createDataFrame([(url, html)], "url string, html string")
        assert {r.to_url for r in url_filter.page_links(d).collect()} == want, html


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1040)] \
        + [(5000, 5000 + i) for i in range(50)] + [(None, 3)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges[:-1]:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    want = {x: find(x) for a, b in edges[:-1] if a != b for x in (a, b)}
    assert dict(map(tuple, components(spark.createDataFrame(edges, "u long, v long")).collect())) == want


def test_near_classes(spark, docs):
    want = brute.near_classes([(r.doc_id, r.text) for r in docs])
    got = run(spark, "op8_near_dedup")
    assert {r.doc_id: r.class_id for r in got} == want
    assert all(r.kept == (r.doc_id == r.class_id) for r in got)


def test_near_classes_of_edited_copies(spark):
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(300)]
    rows = []
    for base in range(12):
        w = rng.choices(vocab, k=rng.randrange(8, 150))
        for copy in range(8):
            x = list(w)
            for _ in range(rng.randrange(0, max(1, len(x) // 20))):
                x[rng.randrange(len(x))] = rng.choice(vocab)
            rows.append((base * 100 + copy, " ".join(x)))
    want = brute.near_classes(rows)
    got = near_dedup.near_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.id: r.class_id for r in got.collect()} == want


def test_banded_distance():
    import numpy as np
    rng = random.Random(1)
    for _ in range(1500):
        a = [rng.randrange(rng.choice([2, 5, 50])) for _ in range(rng.randrange(0, 25))]
        b = list(a) if rng.random() < 0.8 else [rng.randrange(5) for _ in range(rng.randrange(25))]
        for _ in range(rng.randrange(0, 8)):
            if rng.random() < 0.5 and b:
                b.pop(rng.randrange(len(b)))
            else:
                b.insert(rng.randrange(len(b) + 1), rng.randrange(5))
        k, d = rng.randrange(0, 12), brute.edit_distance(a, b)
        x, y = np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64)
        assert near_dedup.banded_distance(x, y, k) == (d if d <= k else k + 1)


def test_secrets(spark, docs):
    import re
    key = re.compile(r"AKIA[0-9A-Z]{16}|(?<=token = \")[0-9a-f]{40}|(?<=password=)[0-9a-f]{18}")
    want = {(r.doc_id, m.start()) for r in docs for m in key.finditer(r.text)}
    got = run(spark, "op9_secret_scan")
    assert {(r.doc_id, r.start) for r in got if r.is_secret} == want
    assert all(0 <= r.score <= 1 for r in got)


def test_secret_forest_judges_unseen_formats(spark):
    """Keys of formats that no rule labels, against words with numbers and numbers."""
    import string
    from spanframe.llm import secret_scan
    rng = random.Random(9)
    alnum = string.ascii_letters + string.digits
    words = "report file page house number value table server public window".split()
    rows, secret = [], set()
    for d in range(400):
        w = rng.choices(words, k=40)
        if d % 4 == 0:
            w[20] = "AKIA" + "".join(rng.choices(string.ascii_uppercase + string.digits, k=16))
        elif d % 4 == 1:
            w[20] = "".join(rng.choices(string.digits, k=16))
        elif d % 4 == 2:
            w[20] = "-".join(rng.choices(words, k=3)) + str(rng.randrange(1000, 99999))
        else:
            w[20] = "9" + "".join(rng.choices(alnum, k=31))
            secret.add(d)
        rows.append((d, " ".join(w)))
    got = secret_scan.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    unseen = [r for r in got if r.id in secret]
    assert sum(r.is_secret for r in unseen) >= 0.9 * len(unseen) > 50
    assert not any(r.is_secret for r in got if r.id % 4 in (1, 2))


def test_language(spark):
    big = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{big}/documents.parquet").select("doc_id", "lang").collect()}
    got = queries.op10_language(spark, big).collect()
    assert all(r.held_out == brute.held_out(r.doc_id) and 0 <= r.score <= 1 for r in got)
    out = [r for r in got if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in out) >= 0.97 * len(out)
    assert sum(r.rejected for r in got) <= 0.02 * len(got)
