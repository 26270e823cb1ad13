"""Corpus pipeline: the stages from raw documents to a mixed training set.

``STAGES`` lists (name, function); each function takes ``(spark, docs, sf_dir)``,
works on all rows of ``docs`` and returns what is kept, with the columns of
``docs``; the last returns the mix.  Columns that a stage does not read are
handed on whatever their names, an empty table stays empty, and null ids,
sources and languages are values like others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanframe.llm import language, mixing
from spanframe.llm.common import materialise, table
from spanframe.llm.decontaminate import drop_leaks
from spanframe.llm.line_dedup import dedup_lines
from spanframe.llm.near_dedup import drop_near_duplicates


def _with_own_columns(docs: DataFrame, names: tuple[str, ...], stage) -> DataFrame:
    """``stage(docs)`` with the columns of ``docs``, those that the stage uses for itself (``names``) set aside meanwhile."""
    aside: dict[str, str] = {}
    for c in docs.columns:
        if c in names:
            other = f"{c}_of_caller"
            while other in docs.columns:
                other += "_"
            aside[c] = other
    out = stage(docs.withColumnsRenamed(aside))
    return out.select([F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is unknown, or told by a narrow margin only, go.

    A null text or one without a letter has no language and goes, however long
    the text; rows repeated in full, or tied between languages, are judged
    alike.  Without a labelled text nothing is learned and every row goes.
    """
    model = language.fit(docs.filter(~language.held_out(F.col("doc_id"))))
    return _with_own_columns(docs, ("_lang", "_score", "_margin", "_rejected"),
                             lambda d: language.identify(d, model).filter(~F.col("_rejected")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are deleted; documents of which nothing is left go.

    A run counts from three lines or from 20 words on.  ``n_chars``, where there
    is one, follows the new text.  Null and empty texts stay as they are; rows
    with a null id come first in the order of copies; rows repeated in full do
    not cut each other; a text may have any number of lines.
    """
    def stage(d: DataFrame) -> DataFrame:
        d = dedup_lines(d)
        d = d.filter((F.col("_n_removed") == 0) | (F.col("_n_removed") < F.col("_n_lines")))
        return d.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in d.columns else d

    return _with_own_columns(docs, ("_n_lines", "_n_removed"), stage)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays.

    Texts that are null or without words stay.  Rows are judged by id and text,
    so rows that share an id, null ids included, do not go for one another, and
    rows repeated in full stay or go together.
    """
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go.

    Null and word-less texts leak nothing and stay, as do all rows where the
    benchmark is empty; rows that share an id are judged each by its own text,
    rows repeated in full alike.
    """
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: one row for each stretch of a document that a slot of an output shard takes.

    Null and empty texts have no words and are never taken; a null source is a
    source of its own; rows repeated in full are laid out one by one.  Draws are
    hashes, so reruns agree.
    """
    _, _, plan = mixing.mix(docs)
    return mixing.mixed_text(docs, plan)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
]

# compression, graph walks and random draws: SQL cannot express the stages; tests/llm holds brute-force versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table; every hand-over is a written table."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs)
    return docs
