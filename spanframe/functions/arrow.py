"""The few Arrow-batched helpers.

Spark SQL has no prefix sum over an array: ``aggregate`` with ``concat`` is
quadratic in the array length, and a window would sort and shuffle the exploded
tokens by note.  A numpy cumsum per row inside one Arrow batch is O(n), and
only segment lengths cross to Python.  Painting intervals over one another
needs a mutable row of pieces; it is a small loop per row.

A batch holds up to 10,000 rows however long their lists are, so each helper
works through it in slices of some ``SLICE`` values: its memory does not grow
with the batch.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T


BOUNDS = T.StructType([T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("s", "e")])


def _lists(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, row offsets) of a list<int> array, its slice applied."""
    off = texts.offsets.to_numpy()
    return texts.values.to_numpy(zero_copy_only=False)[off[0]:off[-1]].astype(np.int64), off - off[0]


SLICE = 1 << 18


def in_slices(fn: Callable[..., pa.Array], lists: pa.Array, *others: pa.Array) -> pa.Array:
    """``fn`` of the columns, some ``SLICE`` values of ``lists`` (at least one row) at a time."""
    off = lists.offsets.to_numpy()
    cut = np.flatnonzero(np.diff((off[:-1] - off[0]) // SLICE, prepend=-1)).tolist() or [0]
    parts = [fn(*[x.slice(i, j - i) for x in (lists, *others)]) for i, j in zip(cut, [*cut[1:], len(lists)])]
    return parts[0] if len(parts) == 1 else pa.concat_arrays(parts)


@F.arrow_udf(BOUNDS)
def word_bounds(lens: pa.Array, first: pa.Array) -> pa.Array:
    """Start and end of every word, from the lengths of the segments of a text.

    Words and gaps alternate; ``first`` is the index of the first word."""
    return in_slices(_word_bounds, lens, first)


def _word_bounds(lens: pa.Array, first: pa.Array) -> pa.Array:
    """One cumulative sum over the rows, less the sum before each row."""
    null = lens.is_null()
    values, off = _lists(lens.fill_null([]))
    ends = np.cumsum(values)
    before = np.concatenate([[0], ends])[off[:-1]]
    size = np.diff(off)
    row = np.repeat(np.arange(len(size)), size)
    word = (np.arange(len(values)) - off[:-1][row]) % 2 == first.to_numpy(zero_copy_only=False)[row]
    e = (ends - before[row])[word]
    s = e - values[word]
    counts = np.concatenate([[0], np.cumsum(np.bincount(row[word], minlength=len(size)))]).astype(np.int32)
    lists = [pa.ListArray.from_arrays(pa.array(counts), pa.array(x.astype(np.int32)), mask=null) for x in (s, e)]
    return pa.StructArray.from_arrays(lists, ["s", "e"])


def _painted_row(b: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, item) of the pieces of one row whose intervals overlap."""
    item = np.flatnonzero(f > b)
    b, f = b[item], f[item]
    # elementary pieces between all ends; the last painter of each is found from the last interval backwards
    cut = np.unique(np.concatenate([b, f]))
    lo, hi = np.searchsorted(cut, b), np.searchsorted(cut, f)
    owner = np.full(len(cut) - 1, -1)
    for k in range(len(item)):
        owner[lo[k]:hi[k]] = item[k]
    edge = np.flatnonzero(np.diff(owner, prepend=-2) != 0)
    stop = np.append(edge[1:], len(owner))
    seen = owner[edge] >= 0
    return cut[edge][seen], cut[stop][seen], owner[edge][seen]


@F.arrow_udf(T.ArrayType(T.StructType([T.StructField(c, T.IntegerType()) for c in ("start", "end", "item")])))
def paint(s: pa.Array, e: pa.Array) -> pa.Array:
    """Intervals painted in order, a later one over an earlier one: disjoint pieces (start, end, item).

    ``item`` is the index of the interval that is seen.  The tail of an interval
    comes back after one nested in it ends; empty intervals paint nothing.  Rows
    without overlaps are taken as they are, a slice at once; the others are
    painted one by one."""
    return in_slices(_paint, s, e)


def _paint(s: pa.Array, e: pa.Array) -> pa.Array:
    null = pc.or_(s.is_null(), e.is_null())
    # a row that is null on one side is empty on both
    (b, off), (f, _) = (_lists(pc.if_else(null, pa.scalar([], x.type), x)) for x in (s, e))
    size = np.diff(off)
    row = np.repeat(np.arange(len(size)), size)
    item = np.arange(len(b)) - off[:-1][row]
    real = f > b
    row, b, f, item = row[real], b[real], f[real], item[real]
    crossed = np.unique(row[1:][(row[1:] == row[:-1]) & (b[1:] < f[:-1])])
    if len(crossed):
        plain = ~np.isin(row, crossed)
        parts = [(row[plain], b[plain], f[plain], item[plain])]
        lo, hi = np.searchsorted(row, crossed), np.searchsorted(row, crossed, side="right")
        for r, i, j in zip(crossed.tolist(), lo.tolist(), hi.tolist()):
            start, end, k = _painted_row(b[i:j], f[i:j])
            parts.append((np.full(len(k), r), start, end, item[i:j][k]))
        row, b, f, item = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(row, kind="stable")
        row, b, f, item = row[order], b[order], f[order], item[order]
    counts = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(size)))]).astype(np.int32)
    pieces = pa.StructArray.from_arrays([pa.array(x.astype(np.int32)) for x in (b, f, item)], ["start", "end", "item"])
    return pa.ListArray.from_arrays(pa.array(counts), pieces, mask=null)


# The step constants, shifts and word order of MD5 (RFC 1321)
_SINES = np.array([int(abs(math.sin(i + 1)) * 2**32) for i in range(64)], dtype=np.uint32)
_SHIFTS = [x for four in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for x in four * 4]
_WORDS = [(m * i + b) % 16 for m, b, lo in ((1, 0, 0), (5, 1, 16), (3, 5, 32), (7, 0, 48)) for i in range(lo, lo + 16)]


def _md5_heads(w: np.ndarray) -> np.ndarray:
    """First 32 bits of the MD5 of one-block messages: ``w`` is (16 words, messages)."""
    a, b, c, d = (np.full(w.shape[1], x, np.uint32) for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476))
    for i, (k, r, g) in enumerate(zip(_SINES, _SHIFTS, _WORDS)):
        f = d ^ (b & (c ^ d)) if i < 16 else c ^ (d & (b ^ c)) if i < 32 else b ^ c ^ d if i < 48 else c ^ (b | ~d)
        f += a
        f += k
        f += w[g]
        a, d, c, b = d, c, b, b + ((f << np.uint32(r)) | (f >> np.uint32(32 - r)))
    return (a + np.uint32(0x67452301)).byteswap()


def numbered_draws(prefixes: list[bytes], counts: np.ndarray, at_a_time: int = 1 << 14) -> np.ndarray:
    """First 32 bits of md5(prefix + number) for the numbers 1 to count of each row, row by row.

    Keys of one block (55 bytes) are hashed in numpy, ``at_a_time`` of them; longer ones one by one."""
    ends = np.cumsum(counts)
    room = 55 - np.char.str_len(np.char.mod("%d", counts))
    size = np.array([len(p) for p in prefixes], dtype=np.int64)
    short = size <= room
    blocks = np.zeros((len(prefixes), 64), np.uint8)
    for i in np.flatnonzero(short).tolist():
        blocks[i, :size[i]] = np.frombuffer(prefixes[i], np.uint8)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
    for lo in range(0, len(out), at_a_time):
        at = np.arange(lo, min(lo + at_a_time, len(out)))
        row = np.searchsorted(ends, at, side="right")
        number = at - (ends - counts)[row] + 1
        m, end = blocks[row], np.where(short[row], size[row], 0)
        digits = np.searchsorted(10 ** np.arange(1, 11), number, side="right") + 1
        for width in range(int(digits.min()), int(digits.max()) + 1):
            k = np.flatnonzero(digits == width)
            for j in range(width):
                m[k, end[k] + j] = 48 + number[k] // 10 ** (width - 1 - j) % 10
        end = end + digits
        m[np.arange(len(at)), end] = 128
        m[:, 56], m[:, 57] = end * 8 & 255, end * 8 >> 8
        out[lo:lo + len(at)] = _md5_heads(np.ascontiguousarray(m.view("<u4").T))
    for i in np.flatnonzero(~short).tolist():
        out[ends[i] - counts[i]:ends[i]] = [int.from_bytes(hashlib.md5(b"%s%d" % (prefixes[i], k)).digest()[:4], "big")
                                            for k in range(1, int(counts[i]) + 1)]
    return out


TOKS = T.ArrayType(T.StructType([*[T.StructField(c, T.IntegerType()) for c in ("tok_no", "s", "e", "label")],
                                 T.StructField("prob", T.DoubleType())]))


@F.arrow_udf(TOKS)
def drawn_tokens(labels: pa.Array, s: pa.Array, e: pa.Array, key: pa.Array) -> pa.Array:
    """The scored tokens of a row: a stand-in score is the token's label, blurred
    by the draw of the row's key and the token's number."""
    return in_slices(_drawn_tokens, labels, s, e, key)


def _drawn_tokens(labels: pa.Array, s: pa.Array, e: pa.Array, key: pa.Array) -> pa.Array:
    null = labels.is_null()
    (label, off), (b, _), (f, _) = (_lists(x.fill_null([])) for x in (labels, s, e))
    size = np.diff(off)
    h = numbered_draws([k.encode() for k in key.to_pylist()], size)
    prob = (label * 450 + np.where(h % 1000 < 2, 549, h % 450)) / 1000.0
    number = np.arange(1, len(h) + 1) - np.repeat(off[:-1], size)
    toks = pa.StructArray.from_arrays([*[pa.array(x.astype(np.int32)) for x in (number, b, f, label)], pa.array(prob)],
                                      ["tok_no", "s", "e", "label", "prob"])
    return pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), toks, mask=null)


OVERLAPS = T.StructType([T.StructField(c, T.LongType()) for c in ("tp", "fp", "fn")])


@F.arrow_udf(OVERLAPS)
def overlaps(ps: pa.Array, pe: pa.Array, ts: pa.Array, te: pa.Array) -> pa.Array:
    """Chars in both, in the first and in the second only of two span lists (starts and ends) a row."""
    return in_slices(_overlaps, ps, pe, ts, te)


def _overlaps(*sides: pa.Array) -> pa.Array:
    null = pc.or_(pc.or_(sides[0].is_null(), sides[1].is_null()), pc.or_(sides[2].is_null(), sides[3].is_null()))
    rows, places, steps = [], [], []
    for start, end, step in ((*sides[:2], (1, 0)), (*sides[2:], (0, 1))):
        values = [pc.if_else(null, pa.scalar([], x.type), x) for x in (start, end)]
        off = values[0].offsets.to_numpy()
        b, f = (x.values.slice(off[0], off[-1] - off[0]) for x in values)
        b, f = (pc.if_else(pc.and_(b.is_valid(), f.is_valid()), x, 0).to_numpy(zero_copy_only=False).astype(np.int64) for x in (b, f))
        row = np.repeat(np.arange(len(off) - 1), np.diff(off))
        real = f > b
        for place, sign in ((b, 1), (f, -1)):
            rows.append(row[real])
            places.append(place[real])
            steps.append(np.tile(np.array(step, dtype=np.int64) * sign, (int(real.sum()), 1)))
    row, place, step = (np.concatenate(x) for x in (rows, places, steps))
    order = np.lexsort((place, row))
    row, place, (p, t) = row[order], place[order], step[order].cumsum(axis=0).T
    # behind a row's last end nothing is covered, so lengths may run on into the next row
    length = np.diff(place, append=0)
    counts = []
    for on in ((p > 0) & (t > 0), (p > 0) & (t <= 0), (p <= 0) & (t > 0)):
        total = np.concatenate([[0], np.cumsum(np.where(on, length, 0))])
        at = np.searchsorted(row, np.arange(len(null) + 1))
        counts.append(pa.array(total[at[1:]] - total[at[:-1]]))
    return pa.StructArray.from_arrays(counts, ["tp", "fp", "fn"], mask=null)
