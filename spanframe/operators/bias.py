"""Identity-subgroup sample weights (the bias-aware loss weighting)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tabular import fit_mean


def sample_weights(rows: DataFrame, identities, target: str = "target") -> DataFrame:
    """w = 1/4 + 1/4 any(id>=.5) + 1/4 (y>=.5 and any(id<.5)) + 1/4 (y<.5 and any(id>=.5));
    loss weight = 1 / mean(w).  Missing identity flags count as 0."""
    ids = [F.coalesce(F.col(i), F.lit(0.0)) for i in identities]
    any_in = reduce(lambda a, b: a | b, [i >= 0.5 for i in ids])
    any_out = reduce(lambda a, b: a | b, [i < 0.5 for i in ids])
    y = F.col(target)
    w = (F.lit(0.25) + 0.25 * any_in.cast("int") + 0.25 * ((y >= 0.5) & any_out).cast("int")
         + 0.25 * ((y < 0.5) & any_in).cast("int"))
    wd = rows.select("doc_id", w.alias("w"))
    mean_w = fit_mean(wd, "w")
    return wd.select("doc_id", F.round("w", 6).alias("weight"), F.round(F.lit(1.0 / mean_w), 6).alias("loss_weight"))
