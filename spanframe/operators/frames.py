"""Frame-level operators: projections, overlays, natural joins, shapes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import spans as S


def keep_only(df: DataFrame, keep) -> DataFrame:
    """Drop every column not in ``keep`` (column complement)."""
    return df.drop(*[c for c in df.columns if c not in set(keep)])


def split_by_dtype(df: DataFrame, label: str | None = None, key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(numeric, categorical) column frames without ``label``; ``key`` is in both."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in (label, key)]
    rest = [c for c in df.columns if c not in text and c not in (label, key)]
    lead = [key] if key else []
    return df.select(*lead, *rest), df.select(*lead, *text)


def rows_with_positive(df: DataFrame, keys, label: str) -> DataFrame:
    """Data points that have at least one positive token (+ counts)."""
    return (df.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n_tokens"), F.sum(label).cast("long").alias("n_pos"))
            .filter(F.col("n_pos") > 0))


def overlay(base: DataFrame, corrections: DataFrame, key: str, cols) -> DataFrame:
    """Apply corrections keyed by ``key``: left join + coalesce per column."""
    c = corrections.select(key, *[F.col(x).alias(f"_c_{x}") for x in cols])
    j = base.join(c, key, "left")
    for x in cols:
        j = j.withColumn(x, F.coalesce(F.col(f"_c_{x}"), F.col(x)))
    return j.drop(*[f"_c_{x}" for x in cols])


def with_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    return df.withColumns({k: F.lit(v) for k, v in defaults.items()})


def split_row_id(df: DataFrame, col: str = "id", sep: str = "_") -> DataFrame:
    parts = F.split(F.col(col), sep)
    return df.select(col,
                     F.try_element_at(parts, F.lit(1)).try_cast("bigint").alias("pn_key"),
                     F.try_element_at(parts, F.lit(2)).try_cast("bigint").alias("feature_key"))


def natural_join(a: DataFrame, b: DataFrame, how: str = "inner") -> DataFrame:
    """Join on all common column names (pandas ``merge`` without ``on``)."""
    common = [c for c in a.columns if c in set(b.columns)]
    return a.join(b, common, how)


def verify_annotation_spans(merged: DataFrame) -> DataFrame:
    """Locate every annotation string in its note and compare with the
    given location element (data-quality check; first occurrence wins)."""
    z = F.arrays_zip(S.parse_string_list("annotation").alias("ann"),
                     S.parse_string_list("location").alias("loc"))
    e = merged.select("id", "pn_history", F.posexplode(z).alias("i", "p"))
    e = e.select("id", "pn_history", (F.col("i") + 1).alias("elem_no"),
                 F.col("p.ann").alias("ann"), F.col("p.loc").alias("loc"))
    pos = F.expr("instr(pn_history, ann)")
    fs = (pos - 1).cast("long")
    fe = F.when(pos == 0, F.lit(-1)).otherwise(pos - 1 + F.length("ann")).cast("long")
    return e.select("id", "elem_no", "ann", fs.alias("found_start"), fe.alias("found_end"), "loc",
                    (F.col("loc") == F.concat_ws(" ", fs.cast("string"), fe.cast("string"))).alias("ok"))


def share_without_spans(df: DataFrame, spans) -> DataFrame:
    share = F.avg(F.when(F.size(spans) == 0, 1.0).otherwise(0.0))
    pct = F.round(share * 100, 0).cast("int")
    return df.agg(F.round(share, 6).alias("share"), pct.alias("pct"),
                  F.format_string("%d%%", pct).alias("pct_text"))


def table_shapes(tables: dict) -> DataFrame:
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(name).alias("tbl"), "n_rows", F.lit(len(df.columns)).alias("n_cols"))
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def collect_targets(df: DataFrame, group: str, order: str, value: str) -> DataFrame:
    """Per-group ordered id list (bounded group: the targets of one note)."""
    lst = F.sort_array(F.collect_list(F.struct(order, value)))
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("n_targets"),
                                 F.array_join(F.transform(lst, lambda x: x[value]), ",").alias("ids"))
