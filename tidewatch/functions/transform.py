"""Feature transforms: shifted log and outlier capping.

* ``log1p(x + shift)``: Spark yields NULL (not -inf/NaN) when ``x + shift <= -1``;
  NaN stays NaN.
* capping is ``when(x < lo, lo).when(x > hi, hi).otherwise(x)``: NULL stays NULL
  and NaN (greater than everything in Spark) becomes ``hi``.  ``greatest/least``
  would skip NULLs and differ, so they are not used.
"""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidewatch.schema import ATTACK_LABEL, NORMAL_LABEL


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def log_shift(c, shift: float) -> Column:
    return F.log1p(_c(c) + F.lit(float(shift)))


def cap(c, lower: float, upper: float) -> Column:
    x = _c(c)
    return (F.when(x < F.lit(float(lower)), F.lit(float(lower)))
            .when(x > F.lit(float(upper)), F.lit(float(upper)))
            .otherwise(x))


def label_text(code) -> Column:
    """0 -> 'Attack', 1 -> 'Normal', anything else NULL."""
    x = _c(code)
    return F.when(x == ATTACK_LABEL, F.lit("Attack")).when(x == NORMAL_LABEL, F.lit("Normal"))
