"""Licence scans with a positional rare-token index.

Words are runs of letters, digits and characters beyond ASCII, A-Z
lower-cased.  Two kinds of findings:

* a *phrase* names a licence in a few words; every place where its words stand
  consecutively is a finding;
* a *template* is a passage of a licence text.  The index holds, for each
  template, its words of highest IDF with their positions.  A file looks up
  all its words that are in the index; postings that agree on the position of
  the template in the file (within ``DRIFT`` words) intersect to a candidate,
  and the candidate is a finding if all mandatory key phrases of the template
  stand near their places.

IDF counts come from all documents, in one map pass with map-side sums over
the fixed vocabulary of the templates; the scan is a second map pass.  No
document is shuffled.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from .common import bound_arrow_batches
from .decontaminate import words_of

RARE = 8
DRIFT = 3

# fixed values: phrases and passages of well-known licences
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    keys: tuple[str, ...]


TEMPLATES = (
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the "
             "gnu general public license as published by the free software foundation",
             ("free software foundation", "gnu general public license")),
    Template("gpl", "work is licensed under the gnu general public license version",
             ("gnu general public license version",)),
    Template("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the "
             "gnu lesser general public license as published by the free software foundation",
             ("gnu lesser general public license",)),
    Template("agpl", "under the terms of the gnu affero general public license as published by the free software "
             "foundation", ("gnu affero general public license",)),
    Template("apache", "licensed under the apache license version 2 0 the license you may not use this file except in "
             "compliance with the license you may obtain a copy of the license at",
             ("apache license version 2 0", "in compliance with the license")),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
             "associated documentation files the software to deal in the software without restriction",
             ("permission is hereby granted free of charge", "deal in the software without restriction")),
    Template("mit", "released under the mit license", ("mit license",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee "
             "is hereby granted provided that the above copyright notice",
             ("for any purpose with or without fee is hereby granted",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
             "provided that the following conditions are met",
             ("redistribution and use in source and binary forms",)),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0",
             ("mozilla public license",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             ("unencumbered software released into the public domain",)),
    Template("cc-by-nc", "licensed under cc by nc", ("cc by nc",)),
    Template("cc-by-sa", "licensed under cc by sa", ("cc by sa",)),
    Template("cc-by-nd", "licensed under cc by nd", ("cc by nd",)),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license",
             ("creative commons attribution",)),
    Template("cc0", "to the extent possible under law the person has waived all copyright and related rights",
             ("waived all copyright and related",)),
)


class Index:
    """Rare-word postings of the templates, and the phrases, over one small vocabulary."""

    def __init__(self, templates: tuple[Template, ...], phrases: dict[str, str], idf: dict[bytes, float]):
        texts = [words_of(t.text) for t in templates]
        heads = [words_of(p) for p in phrases]
        self.vocab = {w: i + 1 for i, w in enumerate(sorted({w for ws in texts + heads for w in ws}))}
        self.texts = [np.array([self.vocab[w] for w in ws]) for ws in texts]
        self.phrases = [(label, np.array([self.vocab[w] for w in ws])) for ws, label in zip(heads, phrases.values())]
        self.labels = [t.label for t in templates]
        self.keys = [[self._place(words_of(k), ws) for k in t.keys] for t, ws in zip(templates, texts)]
        self.postings: dict[int, list[tuple[int, int]]] = {}
        self.least = []
        for t, ws in enumerate(texts):
            rare = sorted(set(ws), key=lambda w: (-idf.get(w, 0.0), w))[:RARE]
            self.least.append(max(1, (len(rare) + 1) // 2))
            for q, w in enumerate(ws):
                if w in rare:
                    self.postings.setdefault(self.vocab[w], []).append((t, q))
        self.indexed = np.zeros(len(self.vocab) + 1, dtype=bool)
        self.indexed[list(self.postings)] = True
        self.head = np.zeros(len(self.vocab) + 1, dtype=bool)
        for _, p in self.phrases:
            self.head[p[0]] = True

    def _place(self, key: list[bytes], text: list[bytes]) -> tuple[int, np.ndarray]:
        for q in range(len(text) - len(key) + 1):
            if text[q : q + len(key)] == key:
                return q, np.array([self.vocab[w] for w in key])
        raise ValueError(f"key phrase {b' '.join(key)!r} is not in its template")

    @staticmethod
    def _stands(ids: np.ndarray, at: int, phrase: np.ndarray) -> bool:
        return at >= 0 and at + len(phrase) <= len(ids) and bool((ids[at : at + len(phrase)] == phrase).all())

    def scan(self, text: str | None) -> tuple[int, list[tuple[str, str, int, int, float]]]:
        """Number of words, and (label, kind, first word, words, score) of each finding."""
        words = words_of(text)
        ids = np.fromiter(map(self.vocab.get, words, repeat(0)), dtype=np.int32, count=len(words))
        out = []
        for p in np.flatnonzero(self.head[ids]).tolist():
            for label, phrase in self.phrases:
                if self._stands(ids, p, phrase):
                    out.append((label, "phrase", p, len(phrase), 1.0))
        hits = np.flatnonzero(self.indexed[ids])
        votes: dict[tuple[int, int], set[int]] = {}
        if len(hits) >= min(self.least, default=1):
            for p in hits.tolist():
                for t, q in self.postings[int(ids[p])]:
                    votes.setdefault((t, p - q), set()).add(int(ids[p]))
        found: dict[tuple[int, int], tuple[float, int]] = {}
        for (t, start), got in votes.items():
            near = set().union(*(votes.get((t, start + d), ()) for d in range(-DRIFT, DRIFT + 1)))
            if len(near) < self.least[t] or not all(
                    any(self._stands(ids, start + q + d, key) for d in range(-DRIFT, DRIFT + 1)) for q, key in self.keys[t]):
                continue
            body, at = self.texts[t], max(0, start)
            there = ids[at : start + len(body)]
            score = float((there == body[at - start : at - start + len(there)]).sum()) / len(body)
            spot = (t, start // (2 * DRIFT + 1))
            found[spot] = max(found.get(spot, (0.0, 0)), (score, -at))
        for (t, _), (score, at) in sorted(found.items()):
            out.append((self.labels[t], "template", -at, len(self.texts[t]), score))
        return len(words), out


def document_frequency(docs: DataFrame, words: list[bytes], text_col: str = "text") -> dict[bytes, int]:
    """Documents that hold each of ``words`` (a fixed, small list), over all documents."""
    vocab = {w: w for w in words}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                got = set(map(vocab.get, words_of(text)))
                got.discard(None)
                seen.update(got)
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in seen], type=pa.string()),
                                          pa.array(list(seen.values()), type=pa.int64())], names=["word", "n"])

    part = docs.select(text_col).mapInArrow(run, "word string, n long")
    return {r.word.encode(): r.n for r in part.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def scan_licenses(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, phrases: dict[str, str] | None = None,
                  text_col: str = "text") -> DataFrame:
    """``docs`` with ``_n_words`` and ``_findings``.

    ``_findings`` is an array of (label, kind, first_word, n_words, score),
    kind ``phrase`` or ``template``; ``score`` is the share of the passage's
    words found in their places.  A null text is empty: 0 words and an empty
    array.  Repeated rows are scanned alike; other columns stay as they are,
    but for those named like the new ones; an empty table stays empty.
    """
    bound_arrow_batches(docs.sparkSession)
    docs = docs.drop("_n_words", "_findings")
    phrases = PHRASES if phrases is None else phrases
    words = sorted({w for t in templates for w in words_of(t.text)})
    df = document_frequency(docs, words, text_col)
    n = max(1, max(df.values(), default=1))
    idf = {w: math.log((1 + n) / (1 + df.get(w, 0))) for w in words}
    shared = docs.sparkSession.sparkContext.broadcast(Index(templates, phrases, idf))
    finding = StructType.fromDDL("label string, kind string, first_word long, n_words long, score double")
    schema = StructType([*docs.schema, StructField("_n_words", LongType()), StructField("_findings", ArrayType(finding))])
    arrow, at, names = to_arrow_schema(schema), docs.columns.index(text_col), finding.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            got = [index.scan(t) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                *batch.columns, pa.array([g[0] for g in got], type=pa.int64()),
                pa.array([[dict(zip(names, f)) for f in g[1]] for g in got], type=arrow.field("_findings").type),
            ], schema=arrow)

    return docs.mapInArrow(run, schema)
