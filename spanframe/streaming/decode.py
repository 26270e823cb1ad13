"""Parsers, decoders, text rules and the vocabulary lookup on a stream of notes.

All of them are expressions on packed rows (``operators.packed``) and
stream-static joins, so the functions below take a stream or a table alike.
``run_to_parquet`` drives one: parquet file stream in, parquet sink out, with
the checkpoint and the output in the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.spans import format_spans, parse_loc_literal, parse_loc_sorted, parse_loc_strip_split
from ..functions.stopwords import ENGLISH
from ..functions.text import WORD_PATTERN, clean_spaces, norm_feature_text, strip_note, strip_shift
from ..operators import packed as PK
from ..plans.fixtures import annotate, literals, row_id, score


def decoded_rows(notes: DataFrame, features: DataFrame, th: float = 0.5) -> DataFrame:
    """One row per (note with words, feature of its case): the scores decoded by
    every rule, the location literal parsed by its dialects, and the normalised
    feature text.

    (id, pn_num, feature_num, feature_text, location, n_spans, sorted_location,
    n_pieces, runs_shift1, runs_exact, flush, noflush)"""
    worded = notes.filter(F.col("pn_history").rlike(WORD_PATTERN))
    rows = score(annotate(PK.pack_tokens(worded, ["pn_num", "case_num"], "pn_history"), features))
    rows = rows.withColumn("location", literals(rows)[1]).drop("words", "s", "e", "hits")
    rows = PK.decode_chars(rows, lambda x: x["prob"] >= th, "runs_shift1", start=1)
    rows = PK.decode_tokens(PK.decode_chars(rows, lambda x: x["label"] > 0, "runs_exact"), th)
    texts = features.select(F.col("feature_num").alias("t_num"), norm_feature_text("feature_text").alias("feature_text"))
    return rows.join(texts, F.col("feature_num") == F.col("t_num")).select(
        row_id().alias("id"), "pn_num", "feature_num", "feature_text", "location",
        F.size(parse_loc_strip_split("location")).alias("n_spans"),
        format_spans(parse_loc_sorted("location")).alias("sorted_location"),
        F.size(parse_loc_literal("location")).alias("n_pieces"), "runs_shift1", "runs_exact", "flush", "noflush")


def encoded_words(notes: DataFrame, vocab: DataFrame, oov: int) -> DataFrame:
    """(pn_num, tok_no, idx, is_stop, shift, n_clean): the words of the cleaned
    notes as vocabulary ids, unknown ones as ``oov``; ``vocab`` (token, idx) is static.

    ``shift`` is what stripping the note takes off its start, ``n_clean`` the
    length that is left."""
    d = notes.select("pn_num", clean_spaces("pn_history").alias("clean"), strip_shift("pn_history").alias("shift"),
                     F.length(strip_note("pn_history")).alias("n_clean"))
    p = PK.pack_tokens(d, ["pn_num", "shift", "n_clean"], "clean")
    t = PK.explode_tokens(p, ["pn_num", "shift", "n_clean"])
    v = vocab.select(F.col("token").alias("v_token"), "idx")
    return t.join(v, F.col("token") == F.col("v_token"), "left").select(
        "pn_num", "tok_no", F.coalesce("idx", F.lit(oov)).cast("int").alias("idx"),
        F.col("token").isin(ENGLISH).alias("is_stop"), F.col("shift").cast("int").alias("shift"), "n_clean")


def table_glob(folder: str, name: str) -> str:
    """A pattern that ``folder/name`` alone matches, for a file stream.

    The table may be one file or a folder of part files.  A stream takes a plain
    path for a folder to list; a pattern is resolved first, so either is read."""
    return f"{folder.rstrip('/')}/{name[:-1]}[{name[-1]}]"


def run_to_parquet(spark: SparkSession, source_dir: str, file_name: str, schema, build: Callable[[DataFrame], DataFrame],
                   out_dir: str, checkpoint_dir: str) -> DataFrame:
    """``build`` over all files of the table ``file_name`` as a parquet stream into a parquet sink; the sink's table."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 64).parquet(table_glob(source_dir, file_name))
    out = build(stream)
    q = out.writeStream.format("parquet").option("checkpointLocation", checkpoint_dir).outputMode("append") \
        .trigger(availableNow=True).start(out_dir)
    q.awaitTermination()
    return spark.read.schema(out.schema).parquet(out_dir)
