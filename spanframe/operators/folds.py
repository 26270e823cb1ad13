"""Folds, splits, samples and batches.

Randomness is replaced by md5 draws on a key and a seed: stable under
recomputation (lost executors recompute the same rows), identical in
every engine, and splittable without any global state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.ordered import global_index, group_index


def md5_bucket(key: Column, modulo: int = 100) -> Column:
    """First 32 bits of md5(key) modulo ``modulo``."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint") % modulo


def seeded_key(cols, seed: int) -> Column:
    return F.md5(F.concat_ws("_", *[F.col(c).cast("string") for c in cols], F.lit(str(seed))))


def _deal(sizes: list[tuple[int, int]], k: int) -> list[tuple[int, list[int], list[int]]]:
    """Folds of the groups of each size, largest size first: (size, prefix, cycle).

    Each group goes to the lightest fold (the first of equals).  Once the loads
    are within one group of each other, groups of one size go round the folds
    in a fixed order, so a size needs its irregular beginning and one cycle.
    """
    load, out = [0] * k, []
    for size, count in sizes:
        prefix: list[int] = []
        while len(prefix) < count and max(load) - min(load) > size:
            f = load.index(min(load))
            load[f] += size
            prefix.append(f)
        cycle = sorted(range(k), key=lambda f: (load[f], f))
        rounds, rest = divmod(count - len(prefix), k)
        load = [x + rounds * size for x in load]
        for f in cycle[:rest]:
            load[f] += size
        out.append((size, prefix, cycle))
    return out


def group_kfold(df: DataFrame, group: str, k: int = 5) -> DataFrame:
    """Group-disjoint folds of even size: groups by (size desc, key), each to
    the lightest fold.

    Only the table (size, number of groups) reaches the driver - it has at most
    as many rows as there are distinct sizes; groups are numbered inside their
    size with the distributed index."""
    groups = df.groupBy(group).agg(F.count(F.lit(1)).alias("_cnt"))
    sizes = [(r["_cnt"], r["n"]) for r in groups.groupBy("_cnt").agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.desc("_cnt")).collect()]
    plan = df.sparkSession.createDataFrame(_deal(sizes, k), "_size long, _prefix array<int>, _cycle array<int>")
    ranked = group_index(groups, ["_cnt"], [group], name="_rk", base=0)
    cycle_at = F.pmod(F.col("_rk") - F.size("_prefix"), F.lit(k)).cast("int")
    fold = F.coalesce(F.get("_prefix", F.col("_rk").cast("int")), F.get("_cycle", cycle_at)).cast("long")
    folds = ranked.join(plan, F.col("_cnt") == F.col("_size")).select(F.col(group).alias("_g"), fold.alias("fold"))
    return df.join(folds, F.col(group).eqNullSafe(F.col("_g"))).drop("_g")


def split_hash(df: DataFrame, key: str, train_pct: int = 80) -> DataFrame:
    """Disjoint hash split: ``part`` = train when md5 bucket < train_pct."""
    return df.withColumn("part", F.when(md5_bucket(F.col(key)) < train_pct, "train").otherwise("valid"))


def sample_n(df: DataFrame, key_cols, n: int, seed: int = 0) -> DataFrame:
    """n rows without replacement: smallest seeded hashes (top-k, bounded)."""
    return df.withColumn("_h", seeded_key(key_cols, seed)).orderBy("_h", *key_cols).limit(n).drop("_h")


def seeded_shuffle(df: DataFrame, key_cols, seed: int = 23) -> DataFrame:
    """Random order as a dense rank of a seeded hash (distributed)."""
    h = df.withColumn("_h", seeded_key(key_cols, seed))
    return global_index(h, ["_h"] + list(key_cols), name="shuffle_pos").drop("_h")


def sample_with_replacement(df: DataFrame, key_cols, k: int, seed: int = 0) -> DataFrame:
    """k draws with replacement: draw j picks row md5(seed, j) mod N.

    Rows get a dense index (distributed); the k draws are a k-row table
    derived from the row count, joined back on the index."""
    idx = global_index(df, list(key_cols), name="_row")
    n = idx.agg(F.count(F.lit(1)).alias("_n"))
    draws = n.select(F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("draw_no"), "_n")
    draws = draws.select("draw_no", (md5_bucket(F.concat_ws("_", F.lit(str(seed)), F.col("draw_no")),
                                                1 << 30) % F.col("_n")).alias("_row"))
    return draws.join(idx, "_row").drop("_row")


def batch_ids(df: DataFrame, order_cols, batch_size: int) -> DataFrame:
    """Fixed-size batches in a deterministic order, with a flag for rows in
    full batches (the ``drop_last`` view keeps ``in_full_batch``)."""
    idx = global_index(df, list(order_cols), name="_row")
    full = idx.count() // batch_size          # one bounded scalar (the row count)
    out = idx.withColumn("batch_id", F.floor(F.col("_row") / batch_size))
    return out.withColumn("in_full_batch", F.col("batch_id") < F.lit(full)).drop("_row")
