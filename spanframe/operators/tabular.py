"""Tabular feature preparation: impute, scale, encode.

Statistics are *fitted* by one aggregation that returns a single row
(bounded), then applied as literals - the estimator/transformer pattern of
Spark ML, without a cross join or a one-partition window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.ordered import global_index

# One-hot turns categories into columns; beyond this many the request is
# refused (an error, not a silent cap) - index/vector encodings apply instead.
MAX_ONEHOT_CATEGORIES = 10_000


def fit_mean(df: DataFrame, col: str) -> float:
    return df.agg(F.avg(col).alias("m")).first()["m"]


def fit_min_max(df: DataFrame, col: str):
    r = df.agg(F.min(col).alias("mn"), F.max(col).alias("mx")).first()
    return r["mn"], r["mx"]


def fit_stats(df: DataFrame, cols) -> dict:
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max")]
    return df.agg(*aggs).first().asDict()


def mean_impute(df: DataFrame, cols, stats: dict | None = None) -> DataFrame:
    stats = stats or fit_stats(df, cols)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(stats[f"{c}__mean"])) for c in cols})


def minmax_scale(df: DataFrame, cols, stats: dict | None = None) -> DataFrame:
    """(x - min) / (max - min); 0 when the column is constant."""
    stats = stats or fit_stats(df, cols)
    out = {}
    for c in cols:
        mn, mx = stats[f"{c}__min"], stats[f"{c}__max"]
        rng = (mx - mn) if (mn is not None and mx is not None) else 0
        out[c] = F.lit(0.0) if not rng else (F.col(c) - F.lit(mn)) / F.lit(float(rng))
    return df.withColumns(out)


def category_index(df: DataFrame, col: str) -> DataFrame:
    """(value, idx) for the distinct values in alphabetical order (0-based),
    ranked with the distributed index (no single-partition window)."""
    cats = df.select(col).where(F.col(col).isNotNull()).distinct()
    return global_index(cats, [col], name="idx").withColumn("idx", F.col("idx").cast("int"))


def onehot(df: DataFrame, col: str, prefix: str | None = None) -> DataFrame:
    """One column per category (alphabetical), 1.0/0.0; nulls -> all zeros.

    Categories become columns, so they are read once (bounded list)."""
    prefix = prefix or col
    idx = category_index(df, col)
    if idx.limit(MAX_ONEHOT_CATEGORIES + 1).count() > MAX_ONEHOT_CATEGORIES:
        raise ValueError(f"{col}: more than {MAX_ONEHOT_CATEGORIES} categories; use label_encode instead")
    cats = [r[0] for r in idx.orderBy("idx").select(col).collect()]
    return df.withColumns({f"{prefix}_{v}": F.when(F.col(col) == v, 1.0).otherwise(0.0) for v in cats})


def label_encode(df: DataFrame, col: str, name: str = "code") -> DataFrame:
    """Sorted-classes label encoding (values compared as strings)."""
    idx = category_index(df.select(F.col(col).cast("string").alias(col)), col)
    return df.join(idx.withColumnRenamed("idx", name),
                   F.col(col).cast("string") == idx[col], "left").drop(idx[col])


def onehot_array(label, n: int):
    """Class id -> length-n one-hot array<int>."""
    lab = F.col(label) if isinstance(label, str) else label
    last = (F.lit(n) if isinstance(n, int) else n) - 1
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.when(i == lab, 1).otherwise(0))
