"""Fingerprints, fill-in-the-middle and the Merkle manifest against plain Python, with edge cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spanframe.llm import fill_middle, fingerprints, merkle, queries

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("id", "th", "at", "h", "c", "form", "grp", "size", "begin", "end", "digest", "children", "path", "leaf", "root",
           "head", "rows", "_row", "_at", "prev_id", "r_id", "t_id", "_n", "fingerprint", "tampered")


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def edge_rows():
    rng = random.Random(12)
    plain = " ".join(rng.choices([f"w{i}" for i in range(90)], k=60))
    long = " ".join(rng.choices([f"v{i}" for i in range(9000)], k=60_000))
    out = [(1, plain, "en"), (2, plain, "en"), (None, "null id", "en"), (None, "another null id", None), (3, None, None),
           (4, "", "fr"), (5, " \n\t ", "fr"), (6, long, "en"), (7, plain + " x", "fr"), (7, plain + " x", "fr"),
           (8, "one", "de"), (8, "other", "de"), (9, "é日𝄞 <P> q", "é"), (10, "a<S", "é"), (11, "日本語", "zz"), (12, "AbC", "en")]
    out += [(100 + i, f"text {i} " + "many words " * (i % 7), "big") for i in range(70)]
    return [(i, t, g, "s" if (i or 0) % 2 else None, None if t is None else len(t)) for i, t, g in out]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).withColumns({c: F.lit("mine") for c in CLASHES}).repartition(4)


@pytest.fixture(scope="module")
def docs(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]


# ---- fill in the middle

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def cut(doc_id, text):
    text = text or ""
    u = UNIT.findall(text)
    h = [int(sha(f"1:{'' if doc_id is None else doc_id}")[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(u) + 1) for x in h[:2])
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return len(u), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_middle_query(spark, docs):
    got = {r.doc_id: r for r in queries.op12_fill_middle(spark, SF).collect()}
    assert len(got) == len(docs)
    for i, text, *_ in docs:
        *want, output = cut(i, text)
        r = got[i]
        assert [r.n, r.form, r.prefix_chars, r.middle_chars] == want
        assert r.output_sha256 == sha(output) and r.restored_sha256 == sha(text)


def test_fill_middle_edges(edge):
    out = fill_middle.fill_in_middle(edge).withColumn("back", fill_middle.restored(F.col("_output"), F.col("_form")))
    assert out.columns[: len(edge.columns)] == edge.columns
    rows = out.collect()
    assert len(rows) == edge.count() and all(r[c] == "mine" for r in rows for c in CLASHES)
    for r in rows:
        assert (r._n_units, r._form, r._prefix_chars, r._middle_chars, r._output) == cut(r.doc_id, r.text)
        assert r.back == (r.text or "")
    assert {r._form for r in rows} == {"plain", "psm", "spm"}
    assert fill_middle.fill_in_middle(edge.limit(0)).isEmpty()


def test_cuts_of_sliced_arrays():
    rng = random.Random(3)
    for _ in range(60):
        texts = [None if rng.random() < 0.1 else "".join(rng.choices("aZz{@[`Aé日𝄞\n 0_", k=rng.randrange(0, 40)))
                 for _ in range(rng.randrange(1, 30))]
        one, two = (np.array([rng.randrange(2**32) for _ in texts]) for _ in "ab")
        n, p, m = fill_middle.cuts(pa.array(["xx", *texts], pa.string()).slice(1), one, two)
        for i, t in enumerate(texts):
            u = UNIT.findall(t or "")
            a, b = sorted((one[i] % (len(u) + 1), two[i] % (len(u) + 1)))
            assert (n[i], p[i], m[i]) == (len(u), len("".join(u[:a])), len("".join(u[a:b])))


# ---- fingerprints


def jaccard(a, b):
    a, b = (Counter(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in (a, b))
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both) if a or b else 1.0


def edited(text, following):
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


def test_fingerprints_query(spark, docs):
    got = {r.doc_id: r for r in queries.op11_fingerprints(spark, SF).collect()}
    ring = sorted(((i, t or "") for i, t, *_ in docs), reverse=True)
    assert len(got) == len(ring)
    off, text = [], {}
    for (i, t), (j, after) in zip(ring, ring[1:] + ring[:1]):
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), sha(edited(t, after)))
        assert text.setdefault(t, r.fingerprint) == r.fingerprint
        off += [r.near_edited - jaccard(t, edited(t, after)), r.near_next - jaccard(t, after)]
        assert r.near_next == same(r.fingerprint, got[j].fingerprint) and r.near_edited == same(r.fingerprint, r.edited_fingerprint)
    owner = {}
    for t, f in text.items():  # texts that differ share a fingerprint only if they are all but equal
        assert jaccard(owner.setdefault(f, t), t) > 0.9
    assert abs(np.mean(off)) < 0.01 and np.std(off) < 0.06 and max(map(abs, off)) < 0.27


def same(a, b):
    return sum(a[k : k + 4] == b[k : k + 4] for k in range(0, len(a), 4)) / (len(a) // 4)


def test_likeness_is_generalised_jaccard():
    rng = random.Random(5)
    s = fingerprints.Sampler(samples=2048, kept=64)
    for _ in range(6):
        a = {f"w{i}": rng.randrange(1, 40) for i in range(rng.randrange(1, 200))}
        b = {w: rng.randrange(1, 40) if rng.random() < 0.3 else n for w, n in a.items()} | {"only": 9}
        want = sum(min(a.get(w, 0), b.get(w, 0)) for w in a | b) / sum(max(a.get(w, 0), b.get(w, 0)) for w in a | b)
        assert abs((s.sign(a) == s.sign(b)).mean() - want) < 0.05
        assert (s.sign(a) == fingerprints.Sampler(samples=2048).sign(dict(reversed(a.items())))).all()


def test_fingerprints_edges(spark, edge):
    got = fingerprints.fingerprint_edits(edge).collect()
    assert len(got) == edge.count()
    by = {}
    for r in got:
        by.setdefault(r.id, []).append(r)
    text = {i: t or "" for i, t, *_ in edge_rows()}
    assert by[1][0].fingerprint == by[2][0].fingerprint and by[2][0].near_next == 1.0  # 1 comes after 2, with its text
    assert by[7][0] == by[7][1]
    assert {r.n_chars for r in by[None]} == {7, 15} and {r.n_chars for r in by[8]} == {3, 5}
    assert (by[3][0].n_chars, by[3][0].edited_sha256, by[4][0].near_next) == (0, sha(""), 1.0)
    assert by[6][0].edited_sha256 == sha(edited(text[6], text[5])) and by[6][0].n_chars == len(text[6])
    assert by[1][0].edited_sha256 in {sha(edited(text[1], t)) for t in ("null id", "another null id")}  # null ids come last
    assert fingerprints.fingerprint_edits(edge.limit(0)).isEmpty()
    lone = fingerprints.fingerprint_edits(edge.filter("doc_id = 12")).first()
    assert (lone.edited_sha256, lone.near_next) == (sha("AbA"), 1.0)
    out = fingerprints.fingerprint(edge)
    assert out.columns[: len(edge.columns)] == edge.columns
    rows = out.withColumn("l", fingerprints.likeness(F.col("_fingerprint"), F.col("_fingerprint"))).collect()
    assert all(r[c] == "mine" for r in rows for c in CLASHES) and {r.l for r in rows} == {1.0}
    assert {r._fingerprint for r in rows if not (r.text or "").strip()} == {"0" * 256}
    assert {(r.doc_id, r._fingerprint) for r in rows} == {(r.id, r.fingerprint) for r in got}


# ---- Merkle manifest


def leaf_of(row, lower=False):
    doc_id, text, lang, source, n_chars = row
    if lower and text is not None:
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text)
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def climb(nodes):
    """Root of a list of digests, and for each of them the (left, right) siblings on the way."""
    way, member = [[] for _ in nodes], [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        up, members = [], []
        for b in range(0, len(nodes), 8):
            run = nodes[b : b + 8]
            for k in range(len(run)):
                for leaf in member[b + k]:
                    way[leaf].append(("".join(run[:k]), "".join(run[k + 1 :])))
            up.append(sha("".join(run)))
            members.append([x for m in member[b : b + 8] for x in m])
        nodes, member = up, members
    return (nodes[0] if nodes else None), way


def manifest(rows):
    """[(doc_id, leaf, subroot, root, proof, folded, verified)] in any order."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in langs:
        rs = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees.append((rs, *climb([leaf_of(r) for r in rs])))
    root, tops = climb([t[1] for t in trees])
    out = []
    for (rs, subroot, ways), top in zip(trees, tops):
        for r, way in zip(rs, ways):
            path = way + top
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            node = leaf_of(r, lower=tampered)
            for left, right in path:
                node = sha(left + node + right)
            out.append((r[0], leaf_of(r), subroot, root, sha("".join(a + b for a, b in path)), node, node == root))
    return out


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple(map(str, r)))


def test_manifest_query(spark, docs):
    got = queries.op13_merkle_manifest(spark, SF).collect()
    assert order(got) == order(manifest(docs))
    assert {r.verified for r in got} == {True, False}


def _frame(edge):
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    fields = [F.translate("text", upper, upper.lower()) if f == "text" else F.col(f) for f in merkle.FIELDS]
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, merkle.leaf_digest(fields))
    d = merkle.manifest(edge, tampered=tampered)
    fold = merkle.folded(F.coalesce("tampered", "leaf"), F.col("path"))
    return d.select("id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")), fold, fold == F.col("root"))


def test_manifest_edges(edge):
    assert order(_frame(edge).collect()) == order(manifest(edge_rows()))
    assert _frame(edge.limit(0)).isEmpty()
    one = edge.filter("doc_id = 12")
    leaf = leaf_of(edge_rows()[15])
    r = _frame(one).first()
    assert r[1] == r[2] == r[3] == leaf and r[4] == sha("")  # a lone leaf is subroot and root
    some = edge.filter("lang = 'big' or doc_id = 6")
    assert order(_frame(some).collect()) == order(manifest([r for r in edge_rows() if r[2] == "big" or r[0] == 6]))


def test_manifest_of_a_repeated_row(spark):
    rows = [(1, "same", "en", None, 4)] * 50 + [(2, "else", "en", None, 4)]
    got = _frame(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert order(got) == order(manifest(rows))
