"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit check.

A document leaks an item when one of its item-sized word windows is within
``floor((1 - min_similarity) * L)`` word edits of the item (L: words of the
item).  Words are runs of letters, digits and characters beyond ASCII, with A-Z
lower-cased.  A text shorter than the item has one window: the whole text.

* Every window position of every document is considered.  A window within k
  edits of an item shares at least ``L - q + 1 - q*k`` word q-grams with it
  (q-gram lemma), so positions that share fewer with all items of that length
  are skipped; this loses nothing.
* The CGK random walk turns a window into a string of symbols: at step j it
  emits the current word and moves on if the random bit (j, word) says so.  Of
  its 3L steps the first 2L, within which the window ends on average, are kept.
  Edit distance becomes Hamming distance, and sampling a few positions of the
  embedding gives an LSH key.  Walks and samples are repeated until simulated
  pairs *at* the edit bound, by changed, inserted or deleted words, are found
  with ``target_recall``.  Where ``MAX_WALKS`` walks do not reach it, every item
  of a window's length is its candidate, which is exact.
* Windows that share a key with an item are verified by the exact word edit
  distance.

The pass over the documents is a map without a shuffle.  The benchmark is a
stated query set: it is cut into blocks of at most ``block_words`` words, each
broadcast on its own, so its size is bounded whatever the benchmark holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import bound_arrow_batches, text_key

Q = 3
# bytes of UTF-8: A-Z to a-z; letters, digits and all bytes beyond ASCII stay; the rest become blanks
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
SAMPLES_PER_WALK = 8
MAX_WALKS = 64


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(FOLD).split() if text else []


def edit_bound(length: int, min_similarity: float) -> int:
    return int((1 - min_similarity) * length + 1e-9)


def edit_distances(a: np.ndarray, b: np.ndarray, b_len: np.ndarray) -> np.ndarray:
    """Word edit distance of each row of ``a`` (P, L) to the row of ``b`` (P, M) cut at ``b_len``."""
    pairs, width = b.shape
    steps = np.arange(width + 1)
    row = np.tile(steps, (pairs, 1))
    for i in range(a.shape[1]):
        new = np.empty_like(row)
        new[:, 0] = i + 1
        new[:, 1:] = np.minimum(row[:, 1:] + 1, row[:, :-1] + (a[:, i : i + 1] != b))
        row = np.minimum.accumulate(new - steps, axis=1) + steps  # insertions
    return row[np.arange(pairs), b_len]


class Matcher:
    """One block of benchmark items, ready to scan documents."""

    def __init__(self, items: list[tuple[object, list[str]]], min_similarity: float, target_recall: float,
                 bits: int, seed: int):
        self.vocab = {w: i + 1 for i, w in enumerate(sorted({w for _, ws in items for w in ws}))}
        self.pad = len(self.vocab) + 1
        self.bits, self.seed = bits, seed
        items = sorted(((x, ws) for x, ws in items if ws), key=lambda r: (len(r[1]), r[1], str(r[0])))
        self.ids = [x for x, _ in items]
        size = np.array([len(ws) for _, ws in items], dtype=np.int64)
        self.lengths = [int(n) for n in np.unique(size)]
        self.widest = max(self.lengths, default=0)
        self.class_of = np.searchsorted(self.lengths, size)
        self.items = np.full((len(items), self.widest), self.pad, dtype=np.int64)
        for i, (_, ws) in enumerate(items):
            self.items[i, : len(ws)] = [self.vocab[w] for w in ws]
        self.bound = [edit_bound(n, min_similarity) for n in self.lengths]
        # q-gram threshold of each length; short items fall back to single words
        self.q, self.least = [], []
        for n, k in zip(self.lengths, self.bound):
            q = Q if n - Q + 1 - Q * k >= 1 else 1
            self.q.append(q)
            self.least.append(max(1, n - q + 1 - q * k))
        self._masks()
        self.walks: list[tuple] = []
        self.sampled = False  # whether samples reach the target; if not, all items of a length are candidates
        while self.lengths and not self.sampled and len(self.walks) < MAX_WALKS:
            self._add_walk()
            self.sampled = len(self.walks) % 4 == 0 and self.simulated_recall() >= target_recall

    # ---- q-gram filter -------------------------------------------------
    def _gram(self, ids: np.ndarray) -> np.ndarray:
        m = len(self.vocab) + 2
        return (ids[:-2] * m + ids[1:-1]) * m + ids[2:]

    def _masks(self) -> None:
        """For each q-gram, the set of item lengths that hold it, as bits (lengths share bits beyond 64)."""
        per = -(-max(1, len(self.lengths)) // 64)
        self.bit_of = [i // per for i in range(len(self.lengths))]
        grams: dict[int, int] = {}
        self.word_mask = np.zeros(self.pad + 1, dtype=np.uint64)
        for c, row in zip(self.class_of, self.items):
            bit, row = 1 << self.bit_of[c], row[: self.lengths[c]]
            if self.q[c] == Q:
                for g in self._gram(row):
                    grams[int(g)] = grams.get(int(g), 0) | bit
            else:
                self.word_mask[row] |= np.uint64(bit)
        self.has_short = bool(self.word_mask.any())
        self.grams = np.array(sorted(grams), dtype=np.int64)
        self.gram_mask = np.array([grams[int(g)] for g in self.grams], dtype=np.uint64)
        self.sieve = np.zeros(1 << 20, dtype=bool)
        self.sieve[self._slot(self.grams)] = True

    @staticmethod
    def _slot(g: np.ndarray) -> np.ndarray:
        return ((g.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)

    def _hits(self, ids: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        out = []
        if len(ids) >= Q and len(self.grams):
            known = ids > 0
            p = np.flatnonzero(known[:-2] & known[1:-1] & known[2:])
            if len(p):
                m = len(self.vocab) + 2
                g = (ids[p] * m + ids[p + 1]) * m + ids[p + 2]
                keep = self.sieve[self._slot(g)]
                p, g = p[keep], g[keep]
                if len(p):
                    at = np.minimum(np.searchsorted(self.grams, g), len(self.grams) - 1)
                    keep = self.grams[at] == g
                    out.append((Q, p[keep], self.gram_mask[at[keep]]))
        if self.has_short:
            mask = self.word_mask[ids]
            p = np.flatnonzero(mask)
            out.append((1, p, mask[p]))
        return out

    def starts(self, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(length class, window starts) that pass the q-gram lemma."""
        for q, p, mask in self._hits(ids):
            if not len(p):
                continue
            seen = int(np.bitwise_or.reduce(mask))
            for c, n in enumerate(self.lengths):
                if self.q[c] != q or not seen >> self.bit_of[c] & 1:
                    continue
                at = p[(mask >> np.uint64(self.bit_of[c])) & np.uint64(1) == 1]
                t = self.least[c]
                if len(at) < t:
                    continue
                first, last = at[: len(at) - t + 1], at[t - 1 :]
                ok = last - first <= n - q
                if not ok.any():
                    continue
                top = max(0, len(ids) - n)
                lo = np.clip(last[ok] - (n - q), 0, top)
                hi = np.clip(first[ok], 0, top)
                mark = np.zeros(top + 2, dtype=np.int64)
                np.add.at(mark, lo, 1)
                np.add.at(mark, hi + 1, -1)
                yield c, np.flatnonzero(np.cumsum(mark[:-1]) > 0)

    # ---- CGK walk and bit sampling ---------------------------------------
    def _add_walk(self) -> None:
        """Draw a walk (a code for each symbol, an odd factor for each step) and its samples for each length."""
        rng = np.random.default_rng([self.seed, len(self.walks)])
        codes = rng.integers(0, 1 << 63, size=self.pad + 1, dtype=np.uint64)
        odd = rng.integers(0, 1 << 63, size=2 * self.widest, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        at = np.stack([rng.integers(0, 2 * n, size=(SAMPLES_PER_WALK, self.bits)) for n in self.lengths])
        walk = (codes, odd, at)
        keys = self._keys(self.items, self.class_of, walk, blank_key=1)
        tables = []
        for s in range(SAMPLES_PER_WALK):
            order = np.argsort(keys[:, s], kind="stable")
            tables.append((keys[order, s], order))
        self.walks.append((walk, tables))

    def embed(self, windows: np.ndarray, walk: tuple) -> np.ndarray:
        codes, odd, _ = walk
        padded = np.hstack([windows, np.full((len(windows), 1), self.pad, dtype=windows.dtype)])
        flat, coded = padded.ravel(), codes[padded].ravel()
        base = np.arange(len(windows)) * padded.shape[1]
        at, last = base.copy(), base + padded.shape[1] - 1
        out = np.empty((2 * self.widest, len(windows)), dtype=np.int64)
        for j in range(2 * self.widest):
            out[j] = flat[at]
            at = np.minimum(at + ((coded[at] * odd[j]) >> np.uint64(63)).astype(np.int64), last)
        return out.T

    def _keys(self, windows: np.ndarray, cls: np.ndarray, walk: tuple, blank_key: int) -> np.ndarray:
        """(windows, samples) keys of the sampled symbols and the length class; ``blank_key`` for padding alone."""
        emb = self.embed(windows, walk)
        picked = emb[np.arange(len(windows))[:, None, None], walk[2][cls]]
        key = np.repeat(cls[:, None].astype(np.uint64), SAMPLES_PER_WALK, axis=1)
        for b in range(self.bits):
            key = key * np.uint64(0x9E3779B97F4A7C15) + picked[:, :, b].astype(np.uint64)
        blank = (picked == self.pad).all(axis=2)
        return np.where(blank, np.uint64(blank_key), key)

    def candidates(self, windows: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (window, item) of one length for which some repeated bit sample agrees."""
        if not self.sampled:
            first = np.searchsorted(self.class_of, cls, "left")
            n = np.searchsorted(self.class_of, cls, "right") - first
            w = np.repeat(np.arange(len(windows)), n)
            return w, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
        return self._colliding(windows, cls)

    def _colliding(self, windows: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = []
        for walk, tables in self.walks:
            keys = self._keys(windows, cls, walk, blank_key=2)
            for s, (sorted_keys, order) in enumerate(tables):
                lo = np.searchsorted(sorted_keys, keys[:, s], "left")
                n = np.searchsorted(sorted_keys, keys[:, s], "right") - lo
                w = np.repeat(np.arange(len(windows)), n)
                i = order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)]
                found.append(w * len(self.items) + i)
        pair = np.unique(np.concatenate(found))
        w, i = pair // len(self.items), pair % len(self.items)
        same = self.class_of[i] == cls[w]
        return w[same], i[same]

    def simulated_recall(self, pairs: int = 400) -> float:
        """Least share, over kinds of edits, of simulated windows at the edit bound that collide with their item.

        Changed, inserted and filled-in words are words no item has: nothing is
        left to agree on.  A window keeps its item's length, so an inserted word
        pushes one out and a deleted one lets one in; each costs two edits.
        """
        rng = np.random.default_rng([self.seed, 99])
        return min(self._recall_of(kind, pairs, rng) for kind in ("change", "insert", "delete"))

    def _recall_of(self, kind: str, pairs: int, rng: np.random.Generator) -> float:
        of = rng.integers(0, len(self.items), size=pairs)
        wins = self.items[of].copy()
        for r, c in enumerate(self.class_of[of]):
            n, edits = self.lengths[c], self.bound[c]
            words = wins[r, :n].copy()
            if kind == "change":
                words[rng.choice(n, size=edits, replace=False)] = 0
            elif kind == "insert":
                words = np.insert(words, rng.integers(0, n, size=edits // 2), 0)[:n]
            else:
                kept = np.delete(words, rng.choice(n, size=edits // 2, replace=False))
                words = np.concatenate([kept, np.zeros(n - len(kept), dtype=words.dtype)])
            wins[r, :n] = words
        w, i = self._colliding(wins, self.class_of[of])
        return len(np.unique(w[i == of[w]])) / pairs

    # ---- scan -----------------------------------------------------------
    def word_ids(self, text: str | None) -> np.ndarray:
        words = words_of(text)
        return np.fromiter(map(self.vocab.get, words, repeat(0)), dtype=np.int64, count=len(words))

    def scan(self, texts: list[str | None], most_windows: int = 20_000) -> Iterator[tuple]:
        """(index of the text, item, windows found, first window start, least distance, similarity)."""
        held, n_held, found = [], 0, {}
        for r, text in enumerate(texts):
            ids = self.word_ids(text)
            for c, at in self.starts(ids):
                n = self.lengths[c]
                if not self.sampled:  # pairs of a piece stay bounded
                    most_windows = max(1, 1_000_000 // len(self.ids))
                for part in np.array_split(at, -(-len(at) // most_windows)):
                    grid = part[:, None] + np.arange(n)
                    wins = np.full((len(part), self.widest), self.pad, dtype=np.int64)
                    wins[:, :n] = np.where(grid < len(ids), ids[np.minimum(grid, len(ids) - 1)], self.pad)
                    held.append((np.full(len(part), r), np.full(len(part), c), part, np.minimum(n, len(ids) - part), wins))
                    n_held += len(part)
                    if n_held >= most_windows:
                        self._verify(held, found)
                        held, n_held = [], 0
        if held:
            self._verify(held, found)
        for (r, item), (n, first, best) in sorted(found.items()):
            yield r, self.ids[item], n, first, best, 1 - best / self.lengths[self.class_of[item]]

    def _verify(self, held: list[tuple], found: dict) -> None:
        """Add to ``found``: (text, item) to (windows found, first window start, least distance).

        Windows of one long text may come in several pieces, so counts add up.
        """
        row, cls, at, real, wins = (np.concatenate(x) for x in zip(*held))
        w, i = self.candidates(wins, cls)
        for c in np.unique(cls[w]):
            n, own = self.lengths[c], cls[w] == c
            cw, ci = w[own], i[own]
            d = edit_distances(self.items[ci][:, :n], wins[cw][:, :n], real[cw])
            ok = d <= self.bound[c]
            for r, item, start, dist in zip(row[cw[ok]].tolist(), ci[ok].tolist(), at[cw[ok]].tolist(), d[ok].tolist()):
                n_seen, first, best = found.get((r, item), (0, start, dist))
                found[r, item] = (n_seen + 1, min(first, start), min(best, dist))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", min_similarity: float = 0.8,
                  target_recall: float = 0.99, bits: int = 2, block_words: int = 2_000_000,
                  seed: int = 7) -> DataFrame:
    """One row for each (document row, item) that leaks.

    Columns: ``id_col``, ``item_col``, ``n_windows`` (windows found),
    ``first_word`` (start of the first of them), ``distance``, ``similarity``.

    Null or word-less texts and items match nothing.  A repeated document row
    is judged like its twin and reported again; repeated items are reported
    by their own ids.  Null ids are kept as null.  Empty tables give an empty
    result.  Other columns are not read, so they may have any names.
    """
    bound_arrow_batches(docs.sparkSession)
    schema = docs.select(F.col(id_col)).schema.add(item_col, benchmark.schema[item_col].dataType) \
        .add("n_windows", "long").add("first_word", "long").add("distance", "long").add("similarity", "double")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # the number of blocks follows from the size of the benchmark
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text"))
    sized = items.withColumn("n", F.coalesce(F.length("text"), F.lit(0)) / 2)
    total = sized.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, int(-(-total // block_words)))
    out = None
    for b in range(blocks):
        block = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("text", "item"), F.lit(blocks)) == b)
        matcher = Matcher([(r.item, words_of(r.text)) for r in block.toLocalIterator()], min_similarity, target_recall, bits, seed)
        found = _scan(texts, matcher, schema)
        out = found if out is None else out.unionByName(found)
    return out


def _scan(texts: DataFrame, matcher: Matcher, schema) -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast(matcher)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            ids, cols = batch.column(0), [[] for _ in arrow]
            for r, *found in m.scan(batch.column(1).to_pylist()):
                for col, v in zip(cols, (ids[r].as_py(), *found)):
                    col.append(v)
            if cols[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, type=f.type) for v, f in zip(cols, arrow)], schema=arrow)

    return texts.mapInArrow(run, schema)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents without those that leak an item; columns unchanged.

    Each row is judged by its own text, told by id and fingerprint: rows that
    share an id, null ids included, do not go for one another.
    """
    keyed = docs.select(F.struct(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("th")).alias("_key"),
                        F.col(text_col).alias("_text"))
    found = decontaminate(keyed, benchmark, id_col="_key", text_col="_text", **options) \
        .select(F.col("_key.id").alias("_leak_id"), F.col("_key.th").alias("_leak_th")).distinct()
    return docs.join(found, docs[id_col].eqNullSafe(found["_leak_id"]) & (text_key(docs[text_col]) == found["_leak_th"]),
                     "left_anti")
