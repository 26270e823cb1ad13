"""Language identification by compression.

Each language has a raw-content zstandard dictionary made of its own labelled
text.  A text is compressed once with each dictionary; the language whose
dictionary gives the fewest bytes is predicted, and a prediction whose margin
over the next language is narrow is rejected.  Both sides are lower-cased.  A
long text is cut into pieces of bounded size, each compressed on its own, and
the bytes are summed: once a text holds its own vocabulary a dictionary saves
nothing more, so one pass over the whole would lower the margin with length.

Dictionaries are fitted on a bounded sample (``dict_bytes`` of text for each
language); predictions read every text in full, in one map pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import bound_arrow_batches

UNKNOWN = "und"
PIECE_CHARS = 400  # a dictionary mixes pieces of many documents
JUDGED_CHARS = 16_000  # a text is judged in pieces of this size at most; in smaller ones the cost of starting each weighs more


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id, as text, is divisible by five (false for a null id)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(labelled: DataFrame, dict_bytes: int = 48 * 1024, max_languages: int = 256, text_col: str = "text",
        lang_col: str = "lang", id_col: str = "doc_id") -> dict[str, bytes]:
    """Raw-content dictionary of each language: at most ``dict_bytes`` of its labelled text.

    All texts are cut into pieces of even length, ``PIECE_CHARS`` at most, and
    a hash sample of the pieces of each language, just large enough, makes its
    dictionary; so a few long texts fill it as well as many short ones.  A
    language with less text gives what it has.  Rows without text or language
    teach nothing.  More than ``max_languages`` languages are refused: the model is
    held in memory, and its size is the product of the two bounds.
    """
    n = F.length("text")
    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.col(id_col).alias("id")) \
        .filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    sizes = rows.groupBy("lang").agg(F.sum(n).alias("chars")).limit(max_languages + 1).collect()
    if len(sizes) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    if not sizes:
        return {}
    # share of the pieces of a language that fills its dictionary one and a half times
    share = F.create_map(*[x for r in sizes for x in (F.lit(r.lang), F.lit(min(1.0, 1.5 * dict_bytes / r.chars)))])
    # length, hash and share of a text are made once, in a generated row, not again for each of its pieces
    once = F.inline(F.array(F.struct(n.cast("long").alias("n"), F.ceil(n / PIECE_CHARS).alias("k"),
                                     F.xxhash64("id", "text").alias("h"), share[F.col("lang")].alias("share"))))
    draw = lambda i: F.pmod(F.xxhash64("h", i), F.lit(1 << 30)) / F.lit(float(1 << 30))
    at = lambda i: F.floor(F.col("n") * i / F.col("k")).cast("int")
    taken = F.filter(F.sequence(F.lit(0).cast("long"), F.col("k") - 1), lambda i: draw(i) < F.col("share"))
    piece = F.transform(taken, lambda i: F.struct(
        draw(i).alias("draw"), F.substring("text", at(i) + 1, at(i + 1) - at(i)).alias("piece")))
    pieces = rows.select("lang", "text", once).select("lang", piece.alias("p")).select("lang", F.explode_outer("p").alias("p")) \
        .filter(F.col("p").isNotNull()).select("lang", "p.draw", "p.piece")
    by: dict[str, list[str]] = {r.lang: [] for r in sizes}
    for r in sorted(pieces.collect(), key=lambda r: (r.lang, r.draw, r.piece)):
        by[r.lang].append(r.piece.lower())
    return {lang: "\n".join(dict.fromkeys(p)).encode()[:dict_bytes] for lang, p in by.items() if p}


class Classifier:
    """Compressors of all languages; built once in each Python worker."""

    def __init__(self, dictionaries: dict[str, bytes], level: int = 6):
        self.langs = sorted(dictionaries)
        self.coders = []
        for lang in self.langs:
            d = zstd.ZstdCompressionDict(dictionaries[lang], dict_type=zstd.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            self.coders.append(zstd.ZstdCompressor(dict_data=d, level=level, write_content_size=False))

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """(language, score, margin).

        ``margin`` is the saving of the best language over the next one, as a
        share of the next one's bytes.  ``score`` is the softmax weight of the
        best language over bytes saved, in 0..1.
        """
        if not text or not self.langs or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, 0.0
        low = text.lower()
        n = -(-len(low) // JUDGED_CHARS)
        cuts = [len(low) * i // n for i in range(n + 1)]  # pieces of even length
        raw = [low[b:e].encode() for b, e in zip(cuts, cuts[1:])]
        size = np.array([sum(len(c.compress(r)) for r in raw) for c in self.coders], dtype=np.float64)
        best = int(size.argmin())
        if len(size) == 1:
            return self.langs[0], 1.0, 1.0
        rest = np.delete(size, best).min()
        weight = np.exp(-(size - size[best]) / 4.0)
        return self.langs[best], float(1 / weight.sum()), float((rest - size[best]) / rest)


def identify(docs: DataFrame, dictionaries: dict[str, bytes], min_margin: float = 0.005, text_col: str = "text",
             level: int = 6) -> DataFrame:
    """``docs`` with ``_lang``, ``_score``, ``_margin`` and ``_rejected``.

    ``_lang`` is ``und`` where the text is null, has no letter, or nothing was
    learned; ties go to the first language by code point.  ``_rejected`` is
    true for ``und`` and for a margin below ``min_margin``.  All columns of
    ``docs`` stay, nulls and repeated rows included, but for those named like
    the new ones; an empty table stays empty.
    """
    bound_arrow_batches(docs.sparkSession)
    docs = docs.drop("_lang", "_score", "_margin", "_rejected")
    schema = StructType([*docs.schema, StructField("_lang", StringType()), StructField("_score", DoubleType()),
                         StructField("_margin", DoubleType())])
    arrow, at = to_arrow_schema(schema), docs.columns.index(text_col)
    model = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = Classifier(model.value, level)
        for batch in batches:
            found = [c.predict(t) for t in batch.column(at).to_pylist()]
            new = [pa.array(x, type=f.type) for x, f in zip(zip(*found), list(arrow)[-3:])] if found else \
                [pa.array([], type=f.type) for f in list(arrow)[-3:]]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], schema=arrow)

    return docs.mapInArrow(run, schema).withColumn(
        "_rejected", (F.col("_lang") == UNKNOWN) | (F.col("_margin") < min_margin))
