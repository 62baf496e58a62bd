"""Display formats: clock text, timestamp text, one-decimal rates."""
from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clock_text(ts_or_text) -> Column:
    """``HH:mm:ss``; input that is not a valid time gives ``00:00:00``."""
    x = _c(ts_or_text)
    t = F.try_to_timestamp(x.cast("string"))
    return F.coalesce(F.date_format(t, "HH:mm:ss"), F.lit("00:00:00"))


def timestamp_text(ts) -> Column:
    return F.date_format(_c(ts), "yyyy-MM-dd HH:mm:ss")


def one_decimal_rate(part, total) -> Column:
    """``round(100 * part / total, 1)``, 0.0 when total is 0 or NULL."""
    return F.coalesce(F.round(F.try_divide(_c(part) * F.lit(100.0), _c(total)), 1), F.lit(0.0))
