"""Vocabularies and id encodings.

* A top-K vocabulary is bounded by K; the planner broadcasts it from its bytes.
* Per-note id sequences are built from the note's own token rows (bounded
  by one note), truncated *before* collecting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.stopwords import ENGLISH
from ..plans.ordered import global_index

PAD, CLS, SEP = 0, 1, 2
ID_SHIFT = 3


def drop_stop_words(tokens: DataFrame, col: str = "token") -> DataFrame:
    return tokens.filter(~F.col(col).isin(ENGLISH))


def word_freq(tokens: DataFrame, col: str = "token") -> DataFrame:
    return drop_stop_words(tokens, col).groupBy(col).agg(F.count(F.lit(1)).alias("cnt"))


def top_k(freq: DataFrame, k: int, col: str = "token") -> DataFrame:
    """K most common (ties by token) with 0-based idx.  The ordering is a
    TakeOrderedAndProject (per-partition top-K, then merge); the rank window
    runs on those K rows only."""
    top = freq.orderBy(F.desc("cnt"), F.col(col)).limit(k)
    return top.withColumn("idx", (F.row_number().over(W.orderBy(F.desc("cnt"), F.col(col))) - 1).cast("int"))


def first_seen_index(tokens: DataFrame, col: str = "token") -> DataFrame:
    """Index by first appearance (row key, position), dense, distributed."""
    first = tokens.groupBy(col).agg(F.min(F.struct("pn_num", "pos")).alias("f"))
    first = first.select(col, F.col("f.pn_num").alias("_fp"), F.col("f.pos").alias("_fs"))
    return global_index(first, ["_fp", "_fs"], name="idx").select(col, "idx")


def encode(tokens: DataFrame, vocab: DataFrame, oov: int, col: str = "token") -> DataFrame:
    """Vocabulary lookup with an OOV default (left join on the bounded vocab)."""
    v = vocab.select(col, "idx")
    return tokens.join(v, col, "left").withColumn("idx", F.coalesce(F.col("idx"), F.lit(oov)).cast("int"))


def encode_strict(tokens: DataFrame, vocab: DataFrame, col: str = "token") -> DataFrame:
    """Vocabulary lookup in which an unknown word is an error: the query fails
    when it meets one, and names it.  Null is a word that no vocabulary holds."""
    v = vocab.select(F.col(col).alias("_v"), "idx")
    unknown = F.raise_error(F.concat(F.lit("not in the vocabulary: "), F.coalesce(F.col(col), F.lit("null"))))
    return tokens.join(v, F.col(col) == F.col("_v"), "left").drop("_v") \
        .withColumn("idx", F.coalesce(F.col("idx").cast("long"), unknown.cast("long")))


def truncated_pair(first: Column, second: Column, starts: Column, ends: Column, separators: int, max_len: int) -> Column:
    """struct<input_ids, token_type_ids, offset_mapping> of exactly ``max_len``.

    CLS + first + SEP (one or two) + second, cut at ``max_len - 1``, then a
    closing SEP and padding.  Types are 0 up to the separators and 1 after them
    (all 0 with two separators); offsets are (0, 0) but for the second
    sequence, and all three are cut and padded together."""
    pairs = F.zip_with(starts, ends, lambda s, e: F.struct(s.cast("int").alias("s"), e.cast("int").alias("e")))
    zero = F.struct(F.lit(0).alias("s"), F.lit(0).alias("e"))
    return truncated_lists(first, second, pairs, separators, max_len, zero, F.lit)


def truncated_lists(first: Column, second: Column, offsets: Column, separators: int, max_len: int, zero: Column, item) -> Column:
    """``truncated_pair`` of lists of any element type, such as numbers already
    written as text: ``item`` makes an element of a number, ``zero`` is the offset of a special."""
    head = F.concat(F.array(item(CLS)), first, F.array(*[item(SEP)] * separators))
    n_head = F.size(first) + 1 + separators
    # not more than fits is taken from the second list, so its tail is not copied
    body = F.slice(F.concat(head, F.slice(second, 1, max_len)), 1, max_len - 1)
    n_real = F.least(n_head + F.size(second), F.lit(max_len - 1)) + 1
    pad = F.lit(max_len) - n_real
    offs = F.slice(F.concat(F.array_repeat(zero, n_head), F.slice(offsets, 1, max_len)), 1, max_len - 1)
    second_type = item(1 if separators == 1 else 0)
    types = F.concat(F.array_repeat(item(0), F.least(n_head, n_real)),
                     F.array_repeat(second_type, F.greatest(n_real - n_head, F.lit(0))), F.array_repeat(item(0), pad))
    return F.struct(F.concat(body, F.array(item(SEP)), F.array_repeat(item(PAD), pad)).alias("input_ids"),
                    types.alias("token_type_ids"),
                    F.concat(offs, F.array_repeat(zero, pad + 1)).alias("offset_mapping"))


def id_sequences(encoded: DataFrame, key: str, max_tokens: int | None = None,
                 id_col: str = "tid") -> DataFrame:
    """Per key: ids in token order (optionally the first ``max_tokens``)."""
    e = encoded if max_tokens is None else encoded.filter(F.col("tok_no") <= max_tokens)
    lst = F.sort_array(F.collect_list(F.struct("tok_no", id_col)))
    return e.groupBy(key).agg(F.transform(lst, lambda x: x[id_col]).alias("ids"))


def zero_pad(arr: Column, length: int) -> Column:
    return F.concat(arr, F.array_repeat(F.lit(PAD), F.greatest(F.lit(0), F.lit(length) - F.size(arr))))


def single_encoding(ids: Column, max_len: int) -> Column:
    """[CLS] ids[:max_len-2] [SEP] + PAD to max_len."""
    body = F.concat(F.array(F.lit(CLS)), F.slice(ids, 1, max_len - 2), F.array(F.lit(SEP)))
    return zero_pad(body, max_len)


def pair_text(first: str, second: str, separators: int) -> Column:
    """CLS + first + SEP (one or two) + second + SEP as a line of ids; padding is left to the reader.

    ``first`` and ``second`` are lines of ids, null where there are none, so a
    sequence that is part of many pairs is written once."""
    sep = F.lit(str(SEP))
    return F.concat_ws(" ", F.lit(str(CLS)), first, *[sep] * separators, second, sep)


def pair_types_text(n_first: Column, n_second: Column) -> Column:
    """0 for CLS, first and SEP; 1 for the second sequence and its SEP."""
    return F.concat(F.repeat(F.lit("0 "), n_first + 2), F.repeat(F.lit("1 "), n_second), F.lit("1"))


def attention_mask(ids: Column) -> Column:
    return F.transform(ids, lambda x: F.when(x != PAD, 1).otherwise(0))


def ints_to_text(arr: Column) -> Column:
    return F.array_join(F.transform(arr, lambda x: x.cast("string")), " ")
