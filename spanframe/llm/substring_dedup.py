"""Substring dedup with sharded automata of recurring passages.

A word goes if a window of ``window`` consecutive words that covers it also
starts earlier (smaller id, or same id and an earlier start); windows are
judged on the input.

1. *Anchors.*  Of the ``anchor``-word runs of each window, the one with the
   least hash (the first on ties) is the window's anchor; equal windows have
   equal anchors at equal offsets.  About one word in seven starts an anchor, so
   far fewer rows than windows are counted.
2. *Confirm recurring passages.*  Anchors found at two or more positions are
   kept, with their first position, the origin.  Counting combines map-side.
3. *Automata.*  Windows around a recurring anchor are cut into segments that
   share an origin shard: a block of the origin document's windows.  In each
   shard an Aho-Corasick automaton over word ids is compiled from the origin's
   own windows, and the segments of all other documents stream through it;
   every occurrence found starts later than the origin's, so it is cut.
4. Windows that share an anchor but not the words around it are not in the
   origin's automaton.  They recur only among themselves; the first position
   of each is found by a map-side combined minimum over 128-bit digests.

Shards with many segments are salted: the origin's windows, which are bounded
by a block, are copied to each salt, and no group is held in memory beyond one
automaton.  Documents without a recurring anchor are finished in step 3 and
not read again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, BooleanType, LongType, StringType, StructField, StructType

from .common import bound_arrow_batches, materialise, text_key
from .hashing import shingles, word_hashes

WINDOW = 20
ANCHOR = 7
SHARD_WINDOWS = 8192
SALT_ROWS = 2000


def anchors_of(h: np.ndarray, window: int, anchor: int) -> np.ndarray:
    """For each window start, the position of its anchor; empty for a text shorter than a window."""
    n = len(h) - window + 1
    if n < 1:
        return np.zeros(0, dtype=np.int64)
    g = shingles(h, anchor)
    width = window - anchor + 1
    out = np.empty(n, dtype=np.int64)
    for at in range(0, n, 1 << 18):  # bounded memory for long texts
        end = min(n, at + (1 << 18))
        view = np.lib.stride_tricks.sliding_window_view(g[at : end + width - 1], width)
        out[at:end] = view.argmin(axis=1) + np.arange(at, end)
    return out


def _anchor_rows(src: DataFrame, window: int, anchor: int) -> DataFrame:
    """(h, id, pos) of every anchor; ``src`` has (id, text)."""
    schema = StructType([StructField("h", LongType()), src.schema["id"], StructField("pos", LongType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hs, rows, ps = [], [], []
            for r, text in enumerate(batch.column(1).to_pylist()):
                h = word_hashes(text.encode()) if text else np.zeros(0, dtype=np.uint64)
                pos = np.unique(anchors_of(h, window, anchor))
                if len(pos):
                    hs.append(shingles(h, anchor)[pos].view(np.int64))
                    rows.append(np.full(len(pos), r))
                    ps.append(pos)
            if hs:
                ids = batch.column(0).take(pa.array(np.concatenate(rows)))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(hs)), ids, pa.array(np.concatenate(ps))],
                                                 schema=arrow)

    return src.mapInArrow(run, schema)


def _runs(*keys: np.ndarray) -> list[tuple[int, int]]:
    """(begin, end) of maximal runs of equal neighbours; the keys are aligned arrays."""
    n = len(keys[0])
    if not n:
        return []
    change = np.zeros(n, dtype=bool)
    change[0] = True
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    at = np.flatnonzero(change)
    return list(zip(at.tolist(), [*at[1:].tolist(), n]))


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _cut(src: DataFrame, window: int, anchor: int) -> DataFrame:
    """One row for each finished document, or for each open one and its segments.

    ``src`` has (id, th, text, found): ``found`` lists the recurring anchors of
    the id as (pos, h, oid, opos), with the origin's id and position, or is
    null.
    """
    kind = src.schema["id"].dataType
    schema = StructType([
        StructField("id", kind), StructField("th", LongType()), StructField("n_words", LongType()),
        StructField("kept_sha256", StringType()), StructField("text", StringType()),
        StructField("origin", kind), StructField("origin_null", BooleanType()), StructField("block", LongType()),
        StructField("start", LongType()), StructField("own", BooleanType()), StructField("words", BinaryType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            cols = [batch.column(i).to_pylist() for i in range(4)]
            for doc, th, text, found in zip(*cols):
                words = text.encode().split() if text else []
                if not found:
                    out.append((doc, th, len(words), _digest(words), None, None, None, None, None, None, None))
                    continue
                out.append((doc, th, len(words), None, text, None, None, None, None, None, None))
                out.extend(_segments(doc, th, words, text, found, window, anchor))
                if len(out) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    return src.mapInArrow(run, schema)


def _segments(doc, th, words: list[bytes], text: str, found: list[dict], window: int, anchor: int) -> Iterator[tuple]:
    """Maximal stretches of windows whose anchors recur and share an origin shard."""
    h = word_hashes(text.encode())
    pos = anchors_of(h, window, anchor)
    g = shingles(h, anchor).view(np.int64)
    # rows that share an id share ``found``: an anchor counts where its words stand
    found = sorted((f for f in found if f["pos"] < len(g) and g[f["pos"]] == f["h"]), key=lambda f: f["pos"])
    if not found:
        return
    at = np.array([f["pos"] for f in found])
    slot = np.minimum(np.searchsorted(at, pos), len(at) - 1)
    starts = np.flatnonzero(at[slot] == pos) if len(pos) else pos
    if not len(starts):
        return
    slot = slot[starts]
    names: dict = {}
    origin = np.array([names.setdefault(f["oid"], len(names)) for f in found])[slot]
    first = np.array([f["opos"] for f in found])[slot] - (pos[starts] - starts)
    block = first // SHARD_WINDOWS
    by_name = list(names)
    own = np.array([n == doc for n in by_name])[origin] & (first == starts)
    for b, e in _runs(origin, block, own, starts - np.arange(len(starts))):
        s = int(starts[b])
        oid = by_name[origin[b]]
        yield (doc, th, None, None, None, oid, oid is None, int(block[b]), s, bool(own[b]),
               b" ".join(words[s : int(starts[e - 1]) + window]))


def _automaton(patterns: list[list[bytes]], window: int):
    """Automaton over word ids of all windows of the patterns, and the id of each word."""
    ids: dict[bytes, int] = {}
    a = ahocorasick.Automaton(ahocorasick.STORE_LENGTH, ahocorasick.KEY_SEQUENCE)
    for words in patterns:
        seq = tuple(ids.setdefault(w, len(ids) + 1) for w in words)
        for i in range(len(seq) - window + 1):
            a.add_word(seq[i : i + window])
    if len(a):
        a.make_automaton()
    return a, ids


def _locate(segments: DataFrame, window: int) -> DataFrame:
    """(id, th, start, n, digest): runs of ``n`` windows found in their shard's automaton, with a null digest,
    and each of the other windows with the digest of its words.

    ``segments`` is partitioned by (origin, block, salt) and sorted within
    partitions, the origin's own segments (``own``) first in each shard.
    """
    schema = StructType([segments.schema["id"], StructField("th", LongType()), StructField("start", LongType()),
                         StructField("n", LongType()), StructField("digest", BinaryType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, patterns, automaton, ids = None, [], None, {}
        for batch in batches:
            out: list[tuple] = []
            rows = zip(*(batch.column(i).to_pylist() for i in range(8)))
            for origin, null, block, salt, own, doc, th, (start, raw) in (
                    (*r[:7], (r[7]["start"], r[7]["words"])) for r in rows):
                if (origin, null, block, salt) != shard:
                    shard, patterns, automaton = (origin, null, block, salt), [], None
                words = raw.split(b" ")
                if own:
                    patterns.append(words)
                    continue
                if automaton is None:
                    automaton, ids = _automaton(patterns, window)
                hit = np.zeros(len(words) - window + 1, dtype=bool)
                if len(automaton):
                    seq = tuple(ids.get(w, 0) for w in words)
                    hit[[end - window + 1 for end, _ in automaton.iter(seq)]] = True
                for b, e in _runs(hit):
                    if hit[b]:
                        out.append((doc, th, start + b, e - b, None))
                    else:
                        out.extend((doc, th, start + i, 1, xxhash.xxh3_128_digest(b" ".join(words[i : i + window])))
                                   for i in range(b, e))
                if len(out) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    return segments.mapInArrow(run, schema)


def _finish(open_docs: DataFrame, window: int) -> DataFrame:
    """(id, n_words, n_removed, kept) of documents with ``later``, their runs (start, n) of windows to cut."""
    schema = StructType([open_docs.schema["id"], StructField("n_words", LongType()), StructField("n_removed", LongType()),
                         StructField("kept_sha256", StringType()), StructField("kept", StringType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text, later in zip(*(batch.column(i).to_pylist() for i in range(3))):
                words = text.encode().split()
                mark = np.zeros(len(words) + 1, dtype=np.int64)
                for run in later or ():
                    mark[run["start"]] += 1
                    mark[run["start"] + run["n"] - 1 + window] -= 1
                keep = np.cumsum(mark[:-1]) == 0
                left = [w for w, k in zip(words, keep.tolist()) if k]
                out.append((doc, len(words), len(words) - len(left), _digest(left), b" ".join(left).decode()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    return open_docs.mapInArrow(run, schema)


def dedup_passages(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept_sha256, kept): one row for each row of ``docs``.

    ``kept`` is the text that is left, its words joined by one space, for
    documents that hold a recurring anchor, and null for the others, whose text
    stays as it is; ``kept_sha256`` is the digest of the kept words for all.

    A null or blank text has no words.  Null ids come before all others in the
    order of copies.  A row repeated in full lies on top of its twin and does
    not cut it; rows that share an id but differ in text are read as lying on
    top of one another as well, so an equal window cuts only from a later
    start.  A text shorter than a window keeps all its words.  Empty tables
    give empty results; other columns are not read.
    """
    if not 1 <= anchor <= window:
        raise ValueError("anchor must be between 1 and window")
    bound_arrow_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = _anchor_rows(src, window, anchor)
    first = rows.groupBy("h").agg(F.min(F.struct("id", "pos")).alias("origin"), F.count(F.lit(1)).alias("n")) \
        .filter(F.col("n") > 1).drop("n")
    found = rows.join(first, "h").groupBy("id").agg(F.collect_set(F.struct(
        "pos", "h", F.col("origin.id").alias("oid"), F.col("origin.pos").alias("opos"))).alias("found"))
    found = found.withColumnRenamed("id", "f_id")
    met = src.withColumn("th", text_key(F.col("text"))).join(
        found.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("f_id")), "left").select("id", "th", "text", "found")
    cut = materialise(_cut(met, window, anchor))

    segments = cut.filter(F.col("words").isNotNull())
    shard = ["origin", "origin_null", "block"]
    # copies of an own segment (a row repeated in full) give the same patterns
    own = segments.filter("own").select(*shard, "id", "th", "start", "words").dropDuplicates([*shard, "start", "th"])
    other = segments.filter(~F.col("own"))
    salts = other.groupBy(*shard).agg(F.count(F.lit(1)).alias("n")) \
        .select(*[F.col(c).alias(f"s_{c}") for c in shard], F.ceil(F.col("n") / SALT_ROWS).alias("salts"))
    same = F.col("origin").eqNullSafe(F.col("s_origin")) & (F.col("block") == F.col("s_block"))
    body = F.struct("start", "words").alias("body")
    cols = [*shard, "salt", "own", "id", "th", "body"]
    patterns = own.join(salts, same).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))) \
        .select(*shard, F.col("salt").cast("long"), F.lit(True).alias("own"), "id", "th", body)
    streams = other.join(salts, same) \
        .withColumn("salt", F.pmod(F.xxhash64("id", "th", "start"), F.col("salts"))) \
        .select(*shard, "salt", F.lit(False).alias("own"), "id", "th", body)
    both = patterns.unionByName(streams).select(cols).repartition(*shard, "salt") \
        .sortWithinPartitions(*shard, "salt", F.col("own").desc())
    located = materialise(_locate(both, window))

    hit = F.col("digest").isNull()
    rest = located.filter(~hit)
    least = rest.groupBy("digest").agg(F.min(F.struct("id", "start")).alias("first"),
                                       F.max(F.struct("id", "start")).alias("last")) \
        .filter(F.col("first") != F.col("last")).drop("last")
    later = rest.join(least, "digest").filter(F.col("first") < F.struct("id", "start"))
    runs = located.filter(hit).select("id", "th", "start", "n").unionByName(later.select("id", "th", "start", "n")) \
        .groupBy("id", "th").agg(F.collect_set(F.struct("start", "n")).alias("later")) \
        .withColumnsRenamed({"id": "l_id", "th": "l_th"})
    whole = cut.filter(F.col("words").isNull())
    opened = whole.filter(F.col("kept_sha256").isNull()).join(
        runs, F.col("id").eqNullSafe(F.col("l_id")) & (F.col("th") == F.col("l_th")), "left") \
        .select("id", "text", "later")
    done = whole.filter(F.col("kept_sha256").isNotNull()).select(
        "id", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept_sha256", F.lit(None).cast("string").alias("kept"))
    return done.unionByName(_finish(opened, window))
