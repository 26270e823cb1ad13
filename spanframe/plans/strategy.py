"""Physical-strategy helper: cutting lineage.

Joins carry no broadcast hints, but for vectors of vocabulary ids, which are
bounded: the planner and AQE decide from the bytes of the sides, so no plan depends on a row count taken on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def checkpoint_table(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into ``spark.checkpoint.dir`` (set by the cluster);
    never a machine-local folder, never ``localCheckpoint``."""
    from ..session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
