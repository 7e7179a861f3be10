"""A written step of a plan."""

from __future__ import annotations

from pyspark.sql import DataFrame

from trackstream.session import checkpoint_dir


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint in
    the shared folder named by ``spark.checkpoint.dir`` (a lost executor then
    re-reads the files instead of recomputing the upstream plan)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
