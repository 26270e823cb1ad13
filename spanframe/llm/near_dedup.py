"""Near-duplicates by Order MinHash, verified by banded alignment.

Two texts are linked if they have a five-word shingle in common and the edit
distance of their word sequences is at most ``1 - min_similarity`` of the
longer one; classes are the connected components of the links.

* Order MinHash: a shingle is labelled by its occurrence number, so repeats
  count.  Each of many random orders picks the least labelled shingles, and
  the key keeps them in *text* order: it agrees with high probability only
  where edit similarity is high.  One changed word costs up to five shingles,
  so texts with a fifth of their words changed at even distances share about
  a fifth of them; picks and tables are sized for that share.
* Equal texts are one node from the start (one row per text, not per copy).
* The least text of a bucket (texts with one key) leads it and is compared with
  all members, which is linear and joins most near copies.
* Then all other members of a bucket that are still in different components are
  compared, each pair in the first bucket it shares.  A bucket is split into
  chunks of bounded size and each pair of chunks is one piece of work, so texts
  travel once a chunk pair, not once a pair; chunks of one component never
  meet, nor do chunks of lengths too far apart.  No pair is left out but by lossless bounds (lengths, shared words).
* Candidates are verified by the exact banded edit distance of their words.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from .common import bound_arrow_batches, materialise, text_key
from .components import components
from .hashing import mix, shingles, word_hashes

K = 5
CHUNK_ROWS, CHUNK_WORDS = 2048, 1 << 18  # bounds of the members of a bucket that one work unit takes for each side
WIDE = 8  # buckets of more chunks are dealt by bands of lengths: a row then meets three bands instead of all chunks


class Sketch(NamedTuple):
    """``tables`` keys of ``picks`` shingles for texts of ``least`` to ``most`` shingles."""

    picks: int
    tables: int
    least: int
    most: float


# Short texts have too few shingles to agree on two.  The ranges overlap so far that
# two texts whose lengths may differ by a fifth always have one kind of key in common.
SKETCHES = (Sketch(1, 24, 1, 16), Sketch(2, 64, 12, float("inf")))


def occurrence_labels(g: np.ndarray) -> np.ndarray:
    """0 for the first shingle of its kind in the text, 1 for the second, ..."""
    order = np.argsort(g, kind="stable")
    i = np.arange(len(g))
    new = np.ones(len(g), dtype=bool)
    new[1:] = g[order[1:]] != g[order[:-1]]
    out = np.empty(len(g), dtype=np.uint64)
    out[order] = i - np.maximum.accumulate(np.where(new, i, 0))
    return out


@cache
def _orders(kind: Sketch) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([5, kind.picks])
    salt = rng.integers(0, 1 << 63, size=kind.tables, dtype=np.uint64)
    return salt, rng.integers(0, 1 << 63, size=kind.tables, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def labelled(g: np.ndarray) -> np.ndarray:
    """Hashes of shingles or words told apart by their occurrence number: distinct within the text."""
    return mix(g + occurrence_labels(g) * np.uint64(0xA0761D6478BD642F))


def order_minhash(g: np.ndarray) -> np.ndarray:
    """The 64-bit keys of a text, one for each table of each kind that fits its length."""
    label, keys = labelled(g), []
    for kind in SKETCHES:
        if not kind.least <= len(g) <= kind.most:
            continue
        salt, odd = _orders(kind)
        step = max(1, (1 << 18) // len(g))  # bounded memory for long texts
        for t in range(0, kind.tables, step):
            rank = (label[None, :] ^ salt[t : t + step, None]) * odd[t : t + step, None]
            rank ^= rank >> np.uint64(32)
            rows, picks = np.arange(len(rank)), min(kind.picks, len(g))
            at = np.empty((picks, len(rank)), dtype=np.int64)
            for p in range(picks):
                at[p] = rank.argmin(axis=1)
                rank[rows, at[p]] = np.iinfo(np.uint64).max
            at.sort(axis=0)  # text order
            key = salt[t : t + step]  # a key of one table never meets one of another
            for p in range(picks):
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + g[at[p]])
            keys.append(key)
    return np.concatenate(keys)


def banded_distance(a: np.ndarray, b: np.ndarray, k: int) -> int:
    """Edit distance of two sequences if it is at most ``k``, else ``k + 1``.

    Only the diagonals -k..k are visited.  Each column of the band is a pair
    of bit vectors of 2k + 1 rows (differences of vertical neighbours, +1 and
    -1), updated with whole-word operations.
    """
    if abs(len(a) - len(b)) > k:
        return k + 1
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    head = int(differ[0]) if len(differ) else n
    a, b = a[head:], b[head:]
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[len(a) - n:][::-1] != b[len(b) - n:][::-1])
    tail = int(differ[0]) if len(differ) else n
    a, b = a[: len(a) - tail].tolist(), b[: len(b) - tail].tolist()
    m, n = len(a), len(b)
    if not m or not n:
        return max(m, n) if max(m, n) <= k else k + 1
    k = min(k, max(m, n))
    rows: dict[int, list[int]] = {}
    for i, x in enumerate(a):
        rows.setdefault(x, []).append(i + 1)
    top, full = 1 << 2 * k, (1 << 2 * k + 1) - 1
    # bit r of column j stands for row j - k + r; rows above 1 are flat in column 0
    up, down = full ^ ((1 << k + 1) - 1), 0
    dist = min(k, m)
    for j in range(1, n + 1):
        up, down = up >> 1 | top, down >> 1
        same, low = 0, j - k
        at = rows.get(b[j - 1])
        if at:
            for i in at[bisect_left(at, low):bisect_right(at, j + k)] if len(at) > 1 else at:
                if low <= i <= j + k:
                    same |= 1 << i - low
        diag = (((same & up) + up) ^ up | same | down) & full
        right_up = (down | ~(diag | up)) & full
        right_down = diag & up
        if j + k <= m:
            dist += not diag & top  # the lowest row of the band moves along its diagonal
        else:
            bit = m - low
            dist += (right_up >> bit & 1) - (right_down >> bit & 1)
        shifted = (right_up << 1 | 1) & full
        up = ((right_down << 1) | ~(diag | shifted)) & full
        down = shifted & diag
    return dist if dist <= k else k + 1


def max_edits(na: int, nb: int, min_similarity: float) -> int:
    return int((1 - min_similarity) * max(na, nb) + 1e-9)


def close(a: np.ndarray, b: np.ndarray, min_similarity: float) -> bool:
    """Whether the edit distance of two word sequences allows a link.

    It is at least the longer length less the words they share, which rejects
    most false candidates before the alignment."""
    k = max_edits(len(a), len(b), min_similarity)
    if abs(len(a) - len(b)) > k:
        return False
    shared = len(np.intersect1d(labelled(a), labelled(b), assume_unique=True))
    return max(len(a), len(b)) - shared <= k and banded_distance(a, b, k) <= k


def sketch(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, th, node, n, keys): fingerprint of the text, digest and number of its words, its keys;
    node is null without words."""
    bound_arrow_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("th"), F.col(text_col).alias("text"))
    schema = StructType([src.schema["id"], src.schema["th"], StructField("node", BinaryType()), StructField("n", IntegerType()),
                         StructField("keys", ArrayType(LongType()))])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes, keys = [], [], []
            for text in batch.column(2).to_pylist():
                h = word_hashes(text.encode()) if text else ()
                if not len(h):
                    nodes.append(None), sizes.append(0), keys.append(None)
                    continue
                nodes.append(xxhash.xxh3_128_digest(h.tobytes()))
                sizes.append(len(h))
                keys.append(order_minhash(shingles(h, K)).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(
                pa.array(c, type=f.type) for c, f in zip((nodes, sizes, keys), list(arrow)[2:]))], schema=arrow)

    return src.mapInArrow(run, schema)


def _verify(pairs: DataFrame, texts: DataFrame, min_similarity: float) -> DataFrame:
    """The pairs (u, v) whose word sequences are close enough; ``texts`` has (node, text).

    Texts travel, not hashes: they compress, hashes do not."""
    a = texts.select(F.col("node").alias("u"), F.col("text").alias("a"))
    b = texts.select(F.col("node").alias("v"), F.col("text").alias("b"))
    met = pairs.join(a, "u").join(b, "v").select("u", "v", "a", "b")
    schema = StructType([StructField("u", BinaryType()), StructField("v", BinaryType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [close(*(word_hashes(t.as_py().encode()) for t in two), min_similarity)
                    for two in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], schema=arrow) \
                .filter(pa.array(keep, type=pa.bool_()))

    return met.mapInArrow(run, schema).distinct()


def _pairs(rows: DataFrame, min_similarity: float) -> DataFrame:
    """Distinct pairs (u, v) of (node, n) and (l_node, l_n) whose lengths allow a link."""
    longer = F.greatest("n", "l_n")
    fits = longer - F.least("n", "l_n") <= F.floor((1 - min_similarity) * longer + 1e-9)
    return rows.filter((F.col("node") != F.col("l_node")) & fits) \
        .select(F.least("node", "l_node").alias("u"), F.greatest("node", "l_node").alias("v")).distinct()


def _bands(n: Column, min_similarity: float) -> Column:
    """Band of lengths; texts that may be linked are in the same or in neighbouring bands."""
    ratio = -math.log(min(max(min_similarity, 1e-3), 1 - 1e-3)) * 1.001
    return F.floor(F.log(n) / F.lit(ratio)).cast("int")


def _chunk_pairs(rest: DataFrame) -> DataFrame:
    """``rest`` (key, node, band, n, root) dealt to work units: (key, unit, side, node, root).

    Chunks hold members of one band, and only chunks of the same or of
    neighbouring bands meet.  A component too large for one chunk has chunks of
    its own, which do not meet one another; the small components of a bucket
    share chunks by a hash."""
    parts = F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(CHUNK_ROWS)), F.ceil(F.sum("n") / F.lit(CHUNK_WORDS)))
    per = materialise(rest.groupBy("key", "band", "root").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n"), parts.alias("parts")))
    many = F.greatest(F.ceil(F.sum("rows") / F.lit(CHUNK_ROWS)), F.ceil(F.sum("n") / F.lit(CHUNK_WORDS)))
    large = per.filter(F.col("parts") > 1).select("key", "band", F.col("root").alias("own"), "parts")
    small = per.filter(F.col("parts") == 1).groupBy("key", "band").agg(many.alias("parts")) \
        .select("key", "band", F.lit(b"").alias("own"), "parts")
    chunks = materialise(large.unionByName(small))
    own = F.when(F.col("parts") > 1, F.col("root")).otherwise(F.lit(b""))
    rows = rest.join(per.select("key", "band", "root", "parts"), ["key", "band", "root"]) \
        .select("key", "band", "node", "root", own.alias("own"))
    rows = rows.join(chunks, ["key", "band", "own"]).select(
        "key", "band", "node", "root", "own",
        F.pmod(F.xxhash64(F.when(F.col("own") == b"", F.col("root")).otherwise(F.col("node"))), F.col("parts")).alias("chunk"))
    each = chunks.select("key", "band", "own",
                         F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1)).alias("chunk"))
    a = each.toDF("key", "a_band", "a_own", "a_chunk")
    b = each.toDF("b_key", "b_band", "b_own", "b_chunk").withColumn("at", F.explode(F.array("b_band", F.col("b_band") - 1)))
    within = (F.col("a_own") < F.col("b_own")) | (
        (F.col("a_own") == b"") & (F.col("b_own") == b"") & (F.col("a_chunk") <= F.col("b_chunk")))
    across = (F.col("a_own") != F.col("b_own")) | (F.col("a_own") == b"")
    units = a.join(b, (F.col("key") == F.col("b_key")) & (F.col("a_band") == F.col("at"))
                   & F.when(F.col("a_band") == F.col("b_band"), within).otherwise(across)) \
        .drop("b_key", "at").withColumn("unit", F.xxhash64("a_band", "a_own", "a_chunk", "b_band", "b_own", "b_chunk"))
    units = materialise(units)
    same = (F.col("a_band") == F.col("b_band")) & (F.col("a_own") == F.col("b_own")) & (F.col("a_chunk") == F.col("b_chunk"))
    sides = units.select("key", F.col("a_band").alias("band"), F.col("a_own").alias("own"), F.col("a_chunk").alias("chunk"), "unit",
                         F.when(same, 2).otherwise(0).alias("side")) \
        .unionByName(units.filter(~same).select("key", F.col("b_band").alias("band"), F.col("b_own").alias("own"),
                                                F.col("b_chunk").alias("chunk"), "unit", F.lit(1).alias("side")))
    return rows.join(sides, ["key", "band", "own", "chunk"]).select("key", "unit", "side", "node", "root")


def key_slots(n: int) -> np.ndarray:
    """Places of the keys of a text of ``n`` words among those of all tables of all kinds."""
    n, at, out = max(1, n - K + 1), 0, []
    for kind in SKETCHES:
        if kind.least <= n <= kind.most:
            out.append(np.arange(at, at + kind.tables))
        at += kind.tables
    return np.concatenate(out)


def chunk_links(key: int, sides: list[int], roots: list[bytes], keys: list[list[int]], texts: list[str],
                min_similarity: float) -> Iterator[tuple[int, int]]:
    """Links that join different components between the sides 0 and 1 of a work unit, or within side 2.

    A pair is judged in the first bucket it shares only.  Pairs that links found
    here have joined are skipped: they are in one component already."""
    sides = np.array(sides)
    left, right = (np.flatnonzero(sides == s) for s in ((0, 1) if sides[0] < 2 else (2, 2)))
    if not len(left) or not len(right):
        return
    seqs = [word_hashes(t.encode()) for t in texts]
    sizes = np.array([len(g) for g in seqs])
    held = np.zeros((len(seqs), sum(k.tables for k in SKETCHES)), dtype=np.int64)
    for i, k in enumerate(keys):
        held[i, key_slots(sizes[i])] = k
    slot = int(np.flatnonzero(held[0] == key)[0])
    label = np.unique(np.array(roots, dtype=object), return_inverse=True)[1]
    ranks = np.unique(np.concatenate([labelled(g) for g in seqs]), return_inverse=True)[1]
    ends = np.cumsum(sizes)
    right_ranks = np.concatenate([ranks[ends[j] - sizes[j] : ends[j]] for j in right])
    right_starts = np.cumsum(sizes[right]) - sizes[right]
    marked = np.zeros(int(ranks.max()) + 1, dtype=np.int32)
    for i in left:
        longer = np.maximum(sizes[i], sizes[right])
        allowed = ((1 - min_similarity) * longer + 1e-9).astype(np.int64)
        ok = (label[right] != label[i]) & (longer - np.minimum(sizes[i], sizes[right]) <= allowed)
        if sides[i] == 2:
            ok &= right > i
        if ok.any():
            ok &= ~((held[right, :slot] == held[i, :slot]) & (held[i, :slot] != 0)).any(axis=1)
        if not ok.any():
            continue
        mine = ranks[ends[i] - sizes[i] : ends[i]]
        marked[mine] = 1
        ok &= longer - np.add.reduceat(marked[right_ranks], right_starts) <= allowed
        marked[mine] = 0
        for j, k in zip(right[ok], allowed[ok]):
            if label[i] != label[j] and banded_distance(seqs[i], seqs[j], int(k)) <= k:
                label[label == label[j]] = label[i]
                yield int(i), int(j)


def _cross_links(rest: DataFrame, texts: DataFrame, min_similarity: float) -> DataFrame:
    """Links (u, v) between members of one bucket in different components; ``rest`` has (key, node, band, n, root),
    ``texts`` (node, text, keys)."""
    bound_arrow_batches(rest.sparkSession)
    rows = _chunk_pairs(rest).join(texts, "node").repartition("key", "unit").sortWithinPartitions("key", "unit") \
        .select("key", "unit", "side", "node", "root", "keys", "text")
    schema = StructType([StructField("u", BinaryType()), StructField("v", BinaryType())])
    arrow = to_arrow_schema(schema)

    def judged(unit: pa.Table) -> pa.RecordBatch:
        c = [unit.column(i).to_pylist() for i in range(7)]
        two = [sorted((c[3][i], c[3][j])) for i, j in chunk_links(c[0][0], c[2], c[4], c[5], c[6], min_similarity)]
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in two], type=pa.binary()) for k in (0, 1)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None
        for batch in batches:
            key, unit = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            cuts = np.flatnonzero((key[1:] != key[:-1]) | (unit[1:] != unit[:-1])) + 1
            for b, e in zip([0, *cuts], [*cuts, batch.num_rows]):
                if b == e:
                    continue
                if held and at != (key[b], unit[b]):
                    yield judged(pa.Table.from_batches(held))
                    held = []
                at = (key[b], unit[b])
                held.append(batch.slice(b, e - b))
        if held:
            yield judged(pa.Table.from_batches(held))

    return rows.mapInArrow(run, schema).distinct()


def links(docs: DataFrame, min_similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(members, links): members (id, th, node) of every row, verified links (u, v) between nodes of different texts."""
    members = materialise(sketch(docs, id_col, text_col))
    nodes = members.filter(F.col("node").isNotNull()).groupBy("node").agg(
        F.min(F.struct("id", "th")).alias("one"), F.first("n").alias("n"), F.first("keys").alias("keys"))
    rows = nodes.select("node", "n", F.explode("keys").alias("key"))
    # the least node leads: in a group of similar texts most buckets then have the same leader
    shared = rows.groupBy("key").agg(F.min(F.struct("node", "n")).alias("lead"), F.count(F.lit(1)).alias("size")) \
        .filter(F.col("size") > 1).select("key", F.col("lead.node").alias("l_node"), F.col("lead.n").alias("l_n"))
    # members of buckets that hold more than one text
    bucket = materialise(rows.join(shared, "key").select("key", "node", "n", "l_node", "l_n"))
    wanted = bucket.select("node").distinct().join(nodes.select("node", "one"), "node") \
        .select("node", F.col("one.id").alias("w_id"), F.col("one.th").alias("w_th"))
    src = docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("th"), F.col(text_col).alias("text"))
    texts = materialise(src.join(wanted.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("w_id"))
                                 & (F.col("th") == F.col("w_th"))).select("node", "text"))
    found = materialise(_verify(_pairs(bucket, min_similarity), texts, min_similarity))
    comp = components(found).withColumnRenamed("node", "c_node")
    rest = bucket.filter(F.col("node") != F.col("l_node")).select("key", "node", "n") \
        .join(comp, F.col("node") == F.col("c_node"), "left") \
        .select("key", "node", "n", F.coalesce("root", "node").alias("root"))
    wide = (F.count(F.lit(1)) > WIDE * CHUNK_ROWS) | (F.sum("n") > WIDE * CHUNK_WORDS)
    apart = rest.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), wide.alias("wide")) \
        .filter(F.col("lo") != F.col("hi")).select("key", "wide")
    # a bucket of a few chunks stays whole
    band = F.when(F.col("wide"), _bands(F.col("n"), min_similarity)).otherwise(0)
    rest = materialise(rest.join(materialise(apart), "key").select("key", "node", "n", "root", band.alias("band")))
    if rest.isEmpty():
        return members.select("id", "th", "node"), found
    whole = texts.join(nodes.select("node", "keys"), "node")
    return members.select("id", "th", "node"), found.unionByName(materialise(_cross_links(rest, whole, min_similarity)))


def near_classes(docs: DataFrame, min_similarity: float = 0.8, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, class_id, kept): one row for each row of ``docs``.

    ``class_id`` is the least id of the class, ``kept`` is true for that id.
    Texts with the same words are copies.  A text of fewer than five words is
    one shingle.  A null, empty or blank text is in a class of its own and
    kept.  Null ids never name a class that has another id; a class of null
    ids only has a null ``class_id`` and is kept.  Rows that repeat an id
    share its class and are kept together.  An empty table gives none.
    """
    return _judged(docs, min_similarity, id_col, text_col).select("id", "class_id", "kept")


def _judged(docs: DataFrame, min_similarity: float, id_col: str, text_col: str) -> DataFrame:
    """(id, th, root, class_id, kept) of each row; ``root`` is null for a text without words."""
    members, found = links(docs, min_similarity, id_col, text_col)
    roots = components(found)
    nodes = members.filter(F.col("node").isNotNull()).groupBy("node").agg(F.min("id").alias("least")) \
        .join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = nodes.groupBy("root").agg(F.min("least").alias("class_id"))
    named = nodes.join(least, "root").select("node", "root", "class_id")
    return members.join(named, "node", "left").select(
        "id", "th", "root", F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
    ).withColumn("kept", F.col("id").eqNullSafe(F.col("class_id")))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_similarity: float = 0.8) -> DataFrame:
    """``docs`` with one text of each class; columns unchanged.

    A row is judged by its id and text, so rows that share an id, null ids
    included, do not go for one another.  Of several texts of the id that names
    a class, the one with the least fingerprint stays.  Rows repeated in full
    stay or go together, and texts without words stay.
    """
    rows = materialise(_judged(docs, min_similarity, id_col, text_col).filter(F.col("root").isNotNull())
                       .select("id", "th", "root", "kept").distinct())
    one = rows.filter("kept").groupBy("root").agg(F.min("th").alias("least"))
    gone = rows.join(one, "root").filter(~F.col("kept") | (F.col("th") != F.col("least"))) \
        .select(F.col("id").alias("_gone_id"), F.col("th").alias("_gone_th"))
    return docs.join(gone, docs[id_col].eqNullSafe(gone["_gone_id"]) & (text_key(docs[text_col]) == gone["_gone_th"]), "left_anti")
