"""Ordered operations (W1-W6): samples, last-n, latest per key.

``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: each task keeps its
own top n and only n rows per task reach the final merge, so last-n never
sorts or moves the whole input.  Latest-per-key is an aggregate of ``max_by``
(partial aggregation first, no window; sort-based, as its buffers hold structs)."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def sample_rows(df: DataFrame, n: int, order_cols: list[str]) -> DataFrame:
    """``LIMIT n`` with an order so that the sample is stable."""
    return df.orderBy(*order_cols).limit(n)


def last_n(df: DataFrame, n: int, time_col: str, tiebreak: str) -> DataFrame:
    """Newest first; ``n <= 0`` returns no rows."""
    if n <= 0:
        return df.limit(0)
    return df.orderBy(F.desc(time_col), F.desc(tiebreak)).limit(n)


def latest_per_key(df: DataFrame, key: str | list[str], order_cols: list[str]) -> DataFrame:
    """The row with the greatest ``order_cols`` per key (ties impossible when
    the order ends with a unique column)."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*[F.col(c) for c in rest]),
                    F.struct(*[F.col(c) for c in order_cols])).alias("_r")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])
