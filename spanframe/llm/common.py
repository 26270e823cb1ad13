"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# a word is a run of characters other than space, tab, \n, \v, \f, \r
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_array(text: Column) -> Column:
    """Words of a text as an array; null text gives an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_key(text: Column) -> Column:
    """64-bit fingerprint that tells rows of one id apart (0 for a null text)."""
    return F.coalesce(F.xxhash64(text), F.lit(0).cast("long"))


def packed(docs: DataFrame, **cols: str) -> DataFrame:
    """``docs`` as one struct column ``_row`` beside copies of the named columns.

    An operator that carries all columns along works on this, so no name it
    uses inside can clash with a column of the caller.
    """
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       *[F.col(c).alias(name) for name, c in cols.items()])


def unpacked(frame: DataFrame, columns: list[str], **new: Column) -> DataFrame:
    """The carried columns in their order, with ``new`` in place of those of the same name, then the rest of ``new``."""
    kept = [new[c].alias(c) if c in new else F.col("_row").getField(c).alias(c) for c in columns]
    return frame.select(*kept, *[v.alias(c) for c, v in new.items() if c not in columns])


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once into the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()``, but as compressed, prunable
    parquet; it survives lost executors because the folder is shared.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bound_arrow_batches(spark: SparkSession, max_bytes: int = 16 << 20) -> None:
    """Bound the bytes (not only the rows) of an Arrow batch.

    Texts differ in length by orders of magnitude, so a batch of 10,000 rows
    has no useful memory bound.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key).rstrip("b")) > max_bytes:
        spark.conf.set(key, str(max_bytes))
