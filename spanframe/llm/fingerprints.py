"""Document fingerprints by consistent weighted sampling.

A text is the bag of its words, each weighted by its count.  For each of
``samples`` draws a word has gamma variates that depend on the word alone; they
turn its weight into a level ``t`` and a key, and the word with the least key is
the sample, kept together with its level.  Two bags give the same (word, level)
with a probability equal to their generalised Jaccard similarity, the sum of
the lesser weights over the sum of the greater ones.  A fingerprint is one
16-bit hash of (word, level) for each draw, as hex digits.

The variates are computed from a hash of the word, so every task and every
rerun has the same; a worker keeps those of recent words in a table of bounded
size.  Fingerprints are a map over the texts, read whole.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from .common import WORD, bound_arrow_batches, materialise, packed, text_key, unpacked

SAMPLES = 64
CHUNK_WORDS = 4096  # distinct words of a text that are weighed at a time
KEPT_WORDS = 1 << 16  # words whose keys a worker keeps
_WORDS = re.compile(WORD)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Bits of ``x`` mixed (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Kept:
    """Rows of float32 for recent words, made by ``fill`` from their hashes; emptied when it is full."""

    def __init__(self, size: int, widths: int, samples: int, fill):
        self.size, self.fill, self.at = max(size, CHUNK_WORDS), fill, {}
        self.hash = np.zeros(self.size, dtype=np.uint64)
        self.tables = [np.zeros((self.size, samples), dtype=np.float32) for _ in range(widths)]

    def rows(self, words: list[str], seed: int) -> np.ndarray:
        """Row of each of at most ``CHUNK_WORDS`` distinct words."""
        at = self.at
        rows = list(map(at.get, words))
        if None in rows:
            new = [w for w, r in zip(words, rows) if r is None]
            if len(at) + len(new) > self.size:
                at.clear()
                new = words
            b, e = len(at), len(at) + len(new)
            h = np.array([xxhash.xxh3_64_intdigest(w, seed) for w in new], dtype=np.uint64)
            self.hash[b:e] = h
            for table, values in zip(self.tables, self.fill(h)):
                table[b:e] = values
            at.update(zip(new, range(b, e)))
            rows = list(map(at.__getitem__, words))
        return np.array(rows, dtype=np.int64)


class Sampler:
    """Signatures of weighted bags; one in each Python worker.

    Most words of a text stand in it once; of these only the key is kept.
    """

    def __init__(self, samples: int = SAMPLES, seed: int = 7, kept: int = KEPT_WORDS):
        self.samples, self.seed = samples, seed
        # two streams of variates, and one for the hash of a sample, which must not depend on what made it the sample
        self.stream = _mixed(np.arange(1, 3 * samples + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(3, samples)
        self.once = Kept(kept, 1, samples, lambda h: [self._key(*self._variates(h), np.float32(0))[0]])
        self.often = Kept(kept // 8, 3, samples, self._variates)

    def _variates(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(gamma r, log of gamma c, uniform beta) of words for all draws; a Gamma(2, 1) is -log of two uniforms."""
        # the hash is mixed already: an odd multiple of it for each draw, folded and multiplied once more
        bits = []
        for odd in self.stream[:2] | np.uint64(1):
            x = h[:, None] * odd
            x ^= x >> np.uint64(32)
            x *= np.uint64(0x9E3779B97F4A7C15)
            bits.append(x)
        half, low = np.float32(0.5), np.uint64((1 << 23) - 1)  # 23 bits and a half fit float32, so no uniform rounds up to 1
        a, c = (np.float32(46 * np.log(2)) - np.log(((x >> np.uint64(41)).astype(np.float32) + half)
                                                    * (((x >> np.uint64(18)) & low).astype(np.float32) + half)) for x in bits)
        beta = ((bits[0] & np.uint64((1 << 18) - 1)).astype(np.float32) + half) * np.float32(2.0 ** -18)
        # rounding may bring a variate to 0 or just below it
        tiny = np.float32(1e-6)
        return np.maximum(a, tiny), np.log(np.maximum(c, tiny)), beta

    def _key(self, r: np.ndarray, log_c: np.ndarray, beta: np.ndarray, log_weight) -> tuple[np.ndarray, np.ndarray]:
        """(log of the key, level) of words of the given weights."""
        level = np.floor(log_weight / r + beta)
        return log_c - r * (level - beta + 1), level

    def sign(self, weights: dict[str, int]) -> np.ndarray:
        """16-bit signature of a bag of words; zeros for an empty bag."""
        out = np.zeros(self.samples, dtype=np.uint16)
        least = np.full(self.samples, np.inf, dtype=np.float32)
        once = [w for w, n in weights.items() if n == 1]
        often = [w for w, n in weights.items() if n != 1]
        draws = np.arange(self.samples)
        for kept, words in ((self.once, once), (self.often, often)):
            for k in range(0, len(words), CHUNK_WORDS):
                part = words[k : k + CHUNK_WORDS]
                rows = kept.rows(part, self.seed)
                if kept is self.once:
                    key, level = kept.tables[0][rows], None
                else:
                    log_weight = np.log(np.array([weights[w] for w in part], dtype=np.float64)).astype(np.float32)
                    key, level = self._key(*(t[rows] for t in kept.tables), log_weight[:, None])
                first = key.argmin(axis=0)
                key, mark = key[first, draws], kept.hash[rows[first]]
                if level is not None:
                    mark = mark + level[first, draws].astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                sample = (_mixed(mark ^ self.stream[2]) >> np.uint64(48)).astype(np.uint16)
                out, least = np.where(key < least, sample, out), np.minimum(key, least)
        return out

    def sign_text(self, text: str | None) -> np.ndarray:
        return self.sign(Counter(_WORDS.findall(text or "")))


def to_text(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Share of the draws on which two fingerprints agree, an estimate of the generalised Jaccard similarity."""
    at = F.sequence(F.lit(0), F.lit(samples - 1))
    same = F.filter(at, lambda i: F.substring(a, 4 * i + 1, F.lit(4)) == F.substring(b, 4 * i + 1, F.lit(4)))
    return F.size(same) / F.lit(float(samples))


def fingerprint(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``_fingerprint``, four hex digits for each of ``SAMPLES`` draws.

    Equal bags of words, hence equal texts, have equal fingerprints.  A null,
    empty or blank text is an empty bag, whose fingerprint is all zeros.  All
    columns stay in their order, repeated rows too, but one named like the new
    one is replaced; an empty table stays empty.
    """
    bound_arrow_batches(docs.sparkSession)
    d = packed(docs, text=text_col)
    schema = StructType([d.schema["_row"], StructField("fingerprint", StringType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler()
        for batch in batches:
            found = [to_text(sampler.sign_text(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(found, pa.string())], schema=arrow)

    return unpacked(d.mapInArrow(run, schema), docs.columns, _fingerprint=F.col("fingerprint"))


def key_bounds(keys: DataFrame, buckets: int) -> list[tuple]:
    """Keys (known, id, th) that cut the order of ``keys`` into about ``buckets`` parts; the last is the greatest key.

    They come from a hash sample of some 25 keys a bucket, as Spark's own
    range partitioning would take, and only set how even the buckets are.
    """
    n, greatest = keys.agg(F.count(F.lit(1)), F.max(F.struct("id", "th"))).first()
    if not n:
        return []
    share = min(1.0, 25 * buckets / n)
    drawn = keys.filter(F.pmod(F.xxhash64("id", "th", F.lit(1)), F.lit(1 << 30)) < int(share * (1 << 30)))
    found = sorted(_order(r.id, r.th) for r in drawn.select("id", "th").collect())
    step = max(1, len(found) // buckets)
    last = _order(*greatest)
    return sorted({k for k in found[step - 1 :: step] if k < last}) + [last]


def _order(id_, th: int) -> tuple:
    """Sort key in Spark's order: null ids first."""
    return (id_ is not None, 0 if id_ is None else id_, th)


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of all texts and of edited ones, and how alike they are.

    (id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next), one row for each row of ``docs``.  The edited text is the text
    with its last third (code points, rounded down) replaced by as many from
    the start of the next document, or by all of it if it is shorter.

    The next document is that of the next smaller id, null ids last, and the
    first one after the last; a lone document is its own next.  Rows that share
    an id are ordered by a hash of their texts.  Rows repeated in full are one
    document in this order and get equal rows.  A null text is an empty one;
    empty and blank texts have the fingerprint of no words and are alike.  An
    empty table gives no rows; other columns are not read.

    Whole texts are shuffled once, into buckets of neighbouring ids whose
    bounds are keys of documents.  A document on a bound goes into two buckets,
    so each bucket holds the next document of all its own, and one pass over a
    sorted bucket, with one text kept in memory, gives the result.
    """
    spark = docs.sparkSession
    bound_arrow_batches(spark)
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")) \
        .withColumn("th", text_key(F.col("text")))
    keys = materialise(src.select("id", "th").groupBy("id", "th").agg(F.count(F.lit(1)).alias("rows")))
    # rows repeated in full are made one, and only they are shuffled for it; a table of their own tells Spark its size
    twins = materialise(keys.filter(F.col("rows") > 1).select(F.col("id").alias("t_id"), F.col("th").alias("t_th"), "rows"))
    pair = F.col("id").eqNullSafe(F.col("t_id")) & (F.col("th") == F.col("t_th"))
    ones = src.join(twins, pair, "left_anti").unionByName(
        src.join(twins, pair, "left_semi").groupBy("id", "th").agg(F.first("text").alias("text")).select("id", "text", "th"))
    bounds = spark.sparkContext.broadcast(key_bounds(keys, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))

    @F.arrow_udf(ArrayType(IntegerType()))
    def buckets(ids: pa.Array, hashes: pa.Array) -> pa.Array:
        """Own bucket, and the one after it for a document on the bound."""
        out, all_ = [], bounds.value
        for i, th in zip(ids.to_pylist(), hashes.to_pylist()):
            key = _order(i, th)
            k = bisect_left(all_, key)
            out.append([k, (k + 1) % len(all_)] if all_[k] == key else [k])
        return pa.array(out, pa.list_(pa.int32()))

    dealt = ones.select("id", "th", "text", F.posexplode(buckets("id", "th")).alias("guest", "bucket")) \
        .withColumn("own", F.col("guest") == 0).drop("guest") \
        .repartition("bucket").sortWithinPartitions("bucket", "own", F.col("id").asc_nulls_first(), "th")
    schema = StructType([src.schema["id"], StructField("th", LongType())]) \
        .add("n_chars", "long").add("edited_sha256", "string").add("fingerprint", "string") \
        .add("edited_fingerprint", "string").add("near_edited", "double").add("near_next", "double")
    arrow = to_arrow_schema(schema)

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler, after, after_sign = Sampler(), None, None  # the row before in the bucket is the next document
        for batch in batches:
            out = []
            for id_, th, text, own in zip(*(batch.column(c).to_pylist() for c in ("id", "th", "text", "own"))):
                sign = sampler.sign_text(text)
                if own:
                    edited = text[: len(text) - len(text) // 3] + after[: len(text) // 3]
                    changed = sampler.sign_text(edited)
                    out.append((id_, th, len(text), hashlib.sha256(edited.encode()).hexdigest(), to_text(sign),
                                to_text(changed), float((sign == changed).mean()), float((sign == after_sign).mean())))
                after, after_sign = text, sign
            columns = zip(*out) if out else [[]] * len(arrow)
            yield pa.RecordBatch.from_arrays([pa.array(x, type=f.type) for x, f in zip(columns, arrow)], schema=arrow)

    found = dealt.mapInArrow(judge, schema)
    # each row repeated in full comes back as often as it was
    one = F.lit(1).cast("long")
    return found.join(twins, pair, "left").withColumn("_n", F.explode(F.sequence(one, F.coalesce("rows", one)))) \
        .select("id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
