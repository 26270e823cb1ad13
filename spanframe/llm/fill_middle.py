"""Fill-in-the-middle: cut a text into prefix, middle and suffix on unit borders.

A unit is a run of ASCII letters or any other single code point.  Units are
never listed.  The UTF-8 bytes of a whole Arrow batch are viewed as uint64
words, and the bytes that end a unit are marked in the high bit of their byte by
arithmetic on all eight bytes of a word at once.  ``bitwise_count`` gives the
marks of a word and a cumulative sum the marks before it, so the n-th unit of a
text is found by one binary search for its word and a select inside the word,
for all texts of the batch together.

A map without a shuffle; a lost executor's rows are cut anew to the same bytes,
because the draws are hashes of the id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import bound_arrow_batches, packed, unpacked

CUT = StructType([StructField(name, LongType()) for name in ("units", "prefix", "middle")])
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = f"{PREFIX}|{SUFFIX}|{MIDDLE}"

_BYTES = np.uint64(0x0101010101010101)
_HIGH = np.uint64(0x8080808080808080)
_LOW7 = np.uint64(0x7F7F7F7F7F7F7F7F)
_CASE = np.uint64(0x2020202020202020)
_U1, _U7, _U8, _U56 = (np.uint64(x) for x in (1, 7, 8, 56))


def _letters(x: np.ndarray) -> np.ndarray:
    """High bit of each byte that is an ASCII letter (sums of 7-bit values never carry into the next byte)."""
    low = (x | _CASE) & _LOW7
    from_a = low + np.uint64(0x80 - ord("a")) * _BYTES
    past_z = low + np.uint64(0x80 - ord("z") - 1) * _BYTES
    return from_a & ~past_z & ~x & _HIGH


def _continued(x: np.ndarray) -> np.ndarray:
    """High bit of each byte 10xxxxxx, which continues a code point."""
    return x & ~(x << _U1) & _HIGH


def _following(marks: np.ndarray) -> np.ndarray:
    """The mark of the next byte, in the place of each byte."""
    after = np.zeros_like(marks)
    after[:-1] = marks[1:] << _U56
    return (marks >> _U8) | after


class Marks:
    """Marked bytes with rank and select."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(marks), dtype=np.int64)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marks in the bytes before ``at``."""
        word = at >> 3
        part = (np.uint64(1) << (_U8 * (at & 7).astype(np.uint64))) - _U1
        return self.before[word] + np.bitwise_count(self.marks[word] & part)

    def select(self, nth: np.ndarray) -> np.ndarray:
        """Byte after the ``nth`` mark (from 1)."""
        word = np.searchsorted(self.before, nth, side="left") - 1
        left = (nth - self.before[word]).astype(np.uint64)
        # byte i of the product counts the marks in bytes 0..i; bytes that count fewer than wanted lie before the mark
        counts = (self.marks[word] >> _U7) * _BYTES
        reached = ((counts | _HIGH) - left * _BYTES) & _HIGH
        return 8 * word + 9 - np.bitwise_count(reached).astype(np.int64)


def unit_marks(data: np.ndarray, ends: np.ndarray) -> tuple[Marks, Marks]:
    """Marks of unit-ending bytes, and of the bytes that begin a code point.

    ``data`` is UTF-8 as uint8; the texts in it end at ``ends`` (exclusive), and
    a text's last byte always ends a unit.
    """
    x = np.zeros(len(data) // 8 + 2, dtype="<u8")
    x.view(np.uint8)[: len(data)] = data
    letter, continued = _letters(x), _continued(x)
    inside = _following(continued) | (letter & _following(letter))
    end = ~inside & _HIGH
    last = ends[ends > 0] - 1
    np.bitwise_or.at(end, last >> 3, np.uint64(0x80) << (_U8 * (last & 7).astype(np.uint64)))
    return Marks(end), Marks(~continued & _HIGH)


def _text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, begin, end) of a string array; a null is an empty text."""
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    begin, end = off[:-1] - off[0], off[1:] - off[0]
    null = texts.is_null().to_numpy(zero_copy_only=False)
    return raw[off[0] : off[-1]], begin, np.where(null, begin, end)


def cuts(texts: pa.Array, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(units, prefix code points, middle code points) of each text.

    The draws ``one`` and ``two``, modulo units + 1, are the cuts in units; the
    smaller ends the prefix, the larger the middle.
    """
    data, begin, end = _text_bytes(texts)
    units, points = unit_marks(data, end[end > begin])
    base = units.rank(begin)
    n = units.rank(end) - base
    a, b = one % (n + 1), two % (n + 1)
    at = [np.where(u > 0, units.select(np.maximum(base + u, 1)), begin) for u in (np.minimum(a, b), np.maximum(a, b))]
    first = points.rank(begin)
    chars = [points.rank(p) - first for p in at]
    return n, chars[0], chars[1] - chars[0]


@F.arrow_udf(CUT)
def _cut(text: pa.Array, one: pa.Array, two: pa.Array) -> pa.Array:
    if not len(text):
        found = [pa.array([], pa.int64())] * 3
    else:
        found = [pa.array(x, pa.int64()) for x in cuts(text, one.to_numpy(), two.to_numpy())]
    return pa.StructArray.from_arrays(found, CUT.names)


def draws(key: Column, seed: int) -> Column:
    """Four unsigned 32-bit draws: the first groups of eight digits of sha256(``seed:key``)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return F.transform(F.array(*map(F.lit, (1, 9, 17, 25))), lambda i: F.conv(F.substring(digest, i, F.lit(8)), 16, 10).cast("long"))


def fill_in_middle(docs: DataFrame, plain_percent: int = 10, spm_percent: int = 20, seed: int = 1,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``_n_units``, ``_form``, ``_prefix_chars``, ``_middle_chars`` and ``_output``.

    ``_form`` is ``plain`` for a share of ``plain_percent`` of the rows, for
    empty texts and for texts that hold one of the marks; else ``spm`` for
    ``spm_percent`` of the rows and ``psm`` for the rest.  ``_output`` is the text
    (plain), ``<P>prefix<S>suffix<M>middle`` (psm) or
    ``<S>suffix<P>prefix<M>middle`` (spm); the lengths are code points, null where
    the form is plain.

    A null text is an empty one; a null id draws like an empty id.  Rows that
    share an id share its draws, and repeated rows get equal results.  Whole
    texts are read, however long; a text with no letter has a unit for each
    code point.  All columns stay in their order, but those named like the new
    ones are replaced; an empty table stays empty.
    """
    bound_arrow_batches(docs.sparkSession)
    d = packed(docs, id=id_col, text=text_col)
    d = d.select("_row", F.coalesce("text", F.lit("")).alias("text"), draws(F.col("id"), seed).alias("h"))
    d = d.withColumn("c", _cut("text", F.col("h")[0], F.col("h")[1]))
    plain = (F.col("text") == "") | F.col("text").rlike(MARKS) | (F.col("h")[2] % 100 >= 100 - plain_percent)
    form = F.when(plain, "plain").when(F.col("h")[3] % 100 < spm_percent, "spm").otherwise("psm")
    d = d.select("_row", "text", "c", form.alias("form"))
    p, m = F.col("c.prefix").cast("int"), F.col("c.middle").cast("int")
    prefix, middle = F.substring("text", F.lit(1), p), F.substring("text", p + 1, m)
    suffix = F.substring("text", p + m + 1, F.length("text"))
    output = F.when(F.col("form") == "plain", F.col("text")) \
        .when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)) \
        .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
    cut = F.col("form") != "plain"
    return unpacked(d, docs.columns, _n_units=F.col("c.units"), _form=F.col("form"),
                    _prefix_chars=F.when(cut, F.col("c.prefix")), _middle_chars=F.when(cut, F.col("c.middle")),
                    _output=output)


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of.  No piece holds a mark, so the marks split it exactly."""
    parts = F.split(output, MARKS)
    return F.when(form == "plain", output).when(form == "psm", F.concat(parts[1], parts[3], parts[2])) \
        .otherwise(F.concat(parts[2], parts[3], parts[1]))
