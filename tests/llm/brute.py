"""Plain-Python versions of the operators, written from their contracts."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(new[-1] + 1, row[j + 1] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


def fold(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def leaks(docs, items, similarity=0.8):
    """{(doc, item): least distance over item-sized windows}."""
    out = {}
    for d, text in docs:
        w = fold(text)
        for i, t in items:
            x = fold(t)
            if not x or not w:
                continue
            k = int((1 - similarity) * len(x) + 1e-9)
            inside = set(x)
            for s in range(max(1, len(w) - len(x) + 1)):
                win = w[s : s + len(x)]
                if sum(y in inside for y in win) < len(x) - k:
                    continue
                e = edit_distance(x, win)
                if e <= k:
                    out[d, i] = min(out.get((d, i), e), e)
    return out


def quality(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    seen = {}
    for i in range(len(w) - 4):
        seen.setdefault(tuple(w[i : i + 5]), []).append(i)
    covered = {j for v in seen.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """{source: target} by resharing what is above the bound until nothing is."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > most * sizes[s]}
        if not over:
            out |= {s: left * weight[s] / total for s in open_}
            break
        out |= {s: most * sizes[s] for s in over}
        left -= sum(most * sizes[s] for s in over)
        open_ -= over
    return out


def dedup_lines(docs, m=3, words=20):
    """docs: (id, text) in order of id; {id: kept text}."""
    seen, out = set(), {}
    for d, text in docs:
        lines = text.split("\n")
        n = [len(WORD.findall(x)) for x in lines]
        gone = set()
        for i in range(len(lines)):
            for j in range(1, m + 1):
                k = tuple(lines[i : i + j])
                if len(k) == j and (j == m or (words is not None and sum(n[i : i + j]) >= words)):
                    gone |= set(range(i, i + j)) if k in seen else set()
                    seen.add(k)
        out[d] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return out


def dedup_passages(docs, n=20):
    seen, out = set(), {}
    for d, text in docs:
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - n + 1):
            k = tuple(w[i : i + n])
            if k in seen:
                gone[i : i + n] = [True] * n
            seen.add(k)
        out[d] = (len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g)))
    return out


def near_classes(docs, similarity=0.8, k=5):
    """{id: least id of its class}; edit distance of the words of texts that share a five-word shingle."""
    seqs = {d: w for d, t in docs if (w := words(t))}
    grams = {d: {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} for d, w in seqs.items()}
    bags = {d: Counter(w) for d, w in seqs.items()}
    ids = sorted(seqs)
    root = {d: d for d, _ in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[:i]:
            longest = max(len(seqs[a]), len(seqs[b]))
            edits = int((1 - similarity) * longest + 1e-9)
            # each word of the longer text that the other lacks costs an edit
            if min(len(seqs[a]), len(seqs[b])) < longest - edits or sum((bags[a] & bags[b]).values()) < longest - edits:
                continue
            if grams[a] & grams[b] and edit_distance(seqs[a], seqs[b]) <= edits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d, _ in docs}


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def licence_base(text):
    w = fold(text)
    at = [(i, label) for p, label in PHRASES.items() for n in [len(p.split())]
          for i in range(len(w) - n + 1) if w[i : i + n] == p.split()]
    first, last = (min(at)[0], max(at)[0]) if at else (None, None)
    return len(w), len(at), first, last, ",".join(sorted({x for _, x in at}))


def url_parts(url):
    if url is None or "://" not in url:
        return "", ""
    m = re.match(r"([^/?#]*)([^?#]*)", url[url.index("://") + 3 :], re.S)
    return re.sub("[A-Z]", lambda x: x.group().lower(), m[1]), m[2]


def url_rule(url, rules):
    host, path = url_parts(url)
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: (len(r.host + r.path), r.verdict == "allow"), default=None)
