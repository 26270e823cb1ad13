"""Structured Streaming form of the row-local operators.

Notes arrive as a parquet file stream; each micro-batch is tokenised with
offsets (the same Arrow prefix-sum expression as the batch path), joined to
the static feature dimension (stream-static join on case and term) and
appended to a parquet sink.  The checkpoint and output folders live under
the shared checkpoint directory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.fixtures import tokens_of
from .decode import run_to_parquet


def term_occurrences(notes: DataFrame, features: DataFrame) -> DataFrame:
    """(pn_num, feature_num, s, e) for every token equal to a feature term of
    the note's case; pure DataFrame -> DataFrame, so it runs on streams."""
    t = tokens_of(notes, ["pn_num", "case_num"], "pn_history")
    f = features.select("feature_num", F.col("case_num").alias("f_case"), "term")
    j = t.join(f, (t.case_num == f.f_case) & (t.token == f.term))
    return j.select("pn_num", "feature_num", "s", "e")


def run_available_now(spark: SparkSession, source_dir: str, file_name: str, source_schema: str,
                      features: DataFrame, case_of, out_dir: str, checkpoint_dir: str) -> DataFrame:
    def occurrences(stream: DataFrame) -> DataFrame:
        notes = stream.select(F.col("doc_id").alias("pn_num"), case_of("doc_id").alias("case_num"),
                              F.col("text").alias("pn_history"))
        return term_occurrences(notes, features)

    return run_to_parquet(spark, source_dir, file_name, source_schema, occurrences, out_dir, checkpoint_dir)
