"""Ordered computations that stay distributed when one group is huge.

A plain ``Window.partitionBy(run).orderBy(step)`` sends a whole run to one
task; with five runs that is five tasks for the entire table.  These helpers
rank and scan in two levels instead:

* ``global_index`` / ``group_index`` range-partition on the ordering key,
  number rows inside each range partition, and add per-partition offsets
  taken from a tiny ``(partition, group) -> count`` table.
* ``blocked_running`` / ``blocked_moving_avg`` cut each group into blocks of
  ``block`` consecutive steps; windows run per (group, block) - bounded
  size, many partitions - and block totals are prefix-scanned on a table
  that is ``block`` times smaller.  Moving windows copy the last ``n-1``
  rows of a block into the next one (a halo) so results stay exact.

Ordering columns must form a unique key inside the group (add a
tie-breaker); then every number is deterministic under recomputation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .strategy import checkpoint_table

DEFAULT_BLOCK = 65_536


def _join_keys(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """Inner equi-join that also matches null keys; the right keys are dropped."""
    r = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(r, on).drop(*[f"_r_{k}" for k in keys])


def group_index(df: DataFrame, group_cols, order_cols, name: str = "idx",
                base: int = 1) -> DataFrame:
    """Row number inside each group (``base``-based) without a per-group task.

    Null is a group like any other."""
    group_cols, order_cols = list(group_cols), list(order_cols)
    r = (df.repartitionByRange(*(group_cols + order_cols))
         .sortWithinPartitions(*(group_cols + order_cols))
         .withColumn("_pid", F.spark_partition_id())
         .withColumn("_loc", F.monotonically_increasing_id()
                     - F.shiftleft(F.spark_partition_id().cast("long"), 33)))
    # Range bounds are sampled per exchange (seeded by RDD id): the counting
    # pass and the numbering pass must read ONE materialised partitioning.
    # A reliable checkpoint in the shared folder also cuts the lineage, so a
    # lost executor never re-samples the bounds.
    r = checkpoint_table(r)
    keys = ["_pid"] + group_cols
    counts = r.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_loc").alias("_first"))
    wg = W.partitionBy(*group_cols).orderBy("_pid").rowsBetween(W.unboundedPreceding, -1) \
        if group_cols else W.orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)
    offs = counts.withColumn("_off", F.coalesce(F.sum("_n").over(wg), F.lit(0))).drop("_n")
    out = _join_keys(r, offs, keys)
    return (out.withColumn(name, (F.col("_off") + F.col("_loc") - F.col("_first") + base).cast("long"))
            .drop("_pid", "_loc", "_off", "_first"))


def global_index(df: DataFrame, order_cols, name: str = "idx", base: int = 0) -> DataFrame:
    """Dense position in a total order (``base``-based), computed distributed."""
    return group_index(df, [], order_cols, name=name, base=base)


def blocked_running(df: DataFrame, group_cols, step_col: str, value_col: str,
                    how: str, name: str, block: int = DEFAULT_BLOCK,
                    exclusive: bool = False) -> DataFrame:
    """Running ``sum``/``max``/``min``/``count`` over a dense 1-based step.

    ``exclusive`` leaves the current row out (rows strictly before it).
    """
    group_cols = list(group_cols)
    agg = {"sum": F.sum, "max": F.max, "min": F.min, "count": F.count}[how]
    comb = {"sum": lambda a, b: a + b, "count": lambda a, b: a + b,
            "max": lambda a, b: F.greatest(a, b), "min": lambda a, b: F.least(a, b)}[how]
    d = df.withColumn("_blk", F.floor((F.col(step_col) - 1) / block))
    totals = d.groupBy(*group_cols, "_blk").agg(agg(value_col).alias("_bt"))
    wb = W.partitionBy(*group_cols).orderBy("_blk").rowsBetween(W.unboundedPreceding, -1)
    prior = totals.withColumn("_prior", agg("_bt").over(wb)).drop("_bt")
    hi = -1 if exclusive else 0
    wi = W.partitionBy(*group_cols, "_blk").orderBy(step_col).rowsBetween(W.unboundedPreceding, hi)
    d = d.withColumn("_in", agg(value_col).over(wi))
    d = _join_keys(d, prior, group_cols + ["_blk"])
    both = F.when(F.col("_prior").isNull(), F.col("_in")) \
        .when(F.col("_in").isNull(), F.col("_prior")) \
        .otherwise(comb(F.col("_prior"), F.col("_in")))
    return d.withColumn(name, both).drop("_blk", "_in", "_prior")


def blocked_moving_avg(df: DataFrame, group_cols, step_col: str, value_col: str,
                       n: int, name: str, block: int = DEFAULT_BLOCK) -> DataFrame:
    """Mean of the last ``n`` rows (``valid`` mode: only rows with step >= n).

    Blocks are at least two windows long."""
    block = max(block, 2 * n)
    group_cols = list(group_cols)
    d = df.withColumn("_blk", F.floor((F.col(step_col) - 1) / block)) \
        .withColumn("_own", F.lit(True))
    halo = (d.filter((F.col(step_col) - 1) % block >= block - (n - 1))
            .withColumn("_blk", F.col("_blk") + 1).withColumn("_own", F.lit(False)))
    u = d.unionByName(halo)
    w = W.partitionBy(*group_cols, "_blk").orderBy(step_col).rowsBetween(-(n - 1), 0)
    u = u.withColumn(name, F.avg(value_col).over(w))
    return (u.filter(F.col("_own") & (F.col(step_col) >= n)).drop("_blk", "_own"))
