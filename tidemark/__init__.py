"""tidemark: DataFrame operators for panels of repeated market snapshots on Spark.

A panel is a long table ``(entity, time, measures...)``. Every public operator
takes a DataFrame and returns a DataFrame; column names are arguments with the
defaults ``entity="symbol"`` and ``time="snapshot_time"``.
"""

from tidemark.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
