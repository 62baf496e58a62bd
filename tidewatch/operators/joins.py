"""Dimension joins.

No hint and no row count: Spark broadcasts a side when its measured bytes are
below ``spark.sql.autoBroadcastJoinThreshold`` (from file statistics, or at
run time from a finished shuffle stage), and merges otherwise, where AQE splits
the partition of a hot device.  The plan is the same code at every size."""
from __future__ import annotations

from pyspark.sql import DataFrame


def join_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "left") -> DataFrame:
    return fact.join(dim, on=on, how=how)
