"""File sources and sinks: CSV/TSV/text scans, submission and
OOF sinks, append-only metric logs, compute-or-load caches.

Every scratch location lives under the cluster's shared checkpoint folder
(``spark.checkpoint.dir``) in a fresh sub-folder per call - never on a
machine-local path.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# RFC-4180 style quoting: quotes doubled, blanks kept, embedded newlines kept.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def scratch(spark: SparkSession, name: str) -> str:
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex}"


WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def write_by(df: DataFrame, path: str, col: str, most: int) -> None:
    """A folder for each of the ``most`` values (or fewer) of ``col``.

    A task keeps a file open for each value.  With one file at a time Spark
    would sort all its rows by the value first, and spill them.  Where a task
    meets more values than ``most``, it sorts the rows that are left."""
    conf = df.sparkSession.conf
    before = conf.get(WRITERS)
    conf.set(WRITERS, str(most + 1))  # Spark begins to sort with the last of them
    try:
        df.write.mode("overwrite").partitionBy(col).parquet(path)
    finally:
        conf.set(WRITERS, before)


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",") -> None:
    opts = dict(CSV_OPTIONS, header=str(header).lower(), sep=sep)
    df.write.mode("overwrite").options(**opts).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str, header: bool = True, sep: str = ",") -> DataFrame:
    """Schema-first CSV scan (no inference); multi-line quoted fields."""
    opts = dict(CSV_OPTIONS, header=str(header).lower(), sep=sep)
    return spark.read.schema(schema).options(**opts).csv(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Line scan; the trailing empty line after the last newline is not a row."""
    return spark.read.text(path)


def read_keyed_lines(spark: SparkSession, path: str, key: str, value: str, key_type: str = "bigint") -> DataFrame:
    """``key<TAB>value`` lines -> (key, value): line alignment by an explicit key,
    never by position."""
    parts = F.split(F.col("value"), "\t", 2)
    return read_lines(spark, path).select(F.try_element_at(parts, F.lit(1)).cast(key_type).alias(key),
                                          F.try_element_at(parts, F.lit(2)).alias(value))


def write_keyed_lines(df: DataFrame, key: str, value: str, path: str) -> None:
    df.select(F.concat_ws("\t", F.col(key).cast("string"), F.col(value).cast("string")).alias("value")) \
        .write.mode("overwrite").text(path)


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def append_log(df: DataFrame, path: str, keys=("epoch",)) -> None:
    """Append-only metric log, one row for each value of ``keys``.

    Rows whose keys the log already holds are left out (null is a value like
    any other), so a job that is run again adds nothing twice."""
    log = _stored(df.sparkSession, path)
    if log is not None:
        old = log.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
        df = df.join(old, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]), "left_anti")
    df.write.mode("append").parquet(path)


def compute_or_load(spark: SparkSession, root: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table kept under ``root``; ``build`` is called and its result kept if there is none.

    The table is written into a folder of its own, and only then is the
    folder's name committed, as a one-row table that one task writes.  So a
    folder that a lost job left half written is never read.  If two jobs
    commit at a time, both read the folder with the lesser name."""
    root = root.rstrip("/")
    for attempt in (1, 2):
        committed = _stored(spark, f"{root}/committed")
        name = committed and committed.agg(F.min("name")).first()[0]
        if name:
            return spark.read.parquet(f"{root}/{name}")
        if attempt == 1:
            new = f"data-{uuid.uuid4().hex}"
            build().write.parquet(f"{root}/{new}")
            spark.range(1).select(F.lit(new).alias("name")).coalesce(1).write.mode("append").parquet(f"{root}/committed")
    raise RuntimeError(f"nothing committed under {root}")
