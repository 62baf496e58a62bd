"""Class decoding: argmax / confidence over a probability array, class-name
lookup with an ``Unknown`` default, and the binary attack/normal flag."""
from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

from tidewatch.schema import NORMAL_CLASS, STATUS_DISPLAY, UNKNOWN_CLASS


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def argmax_index(proba) -> Column:
    """0-based index of the largest probability; ties go to the lowest index."""
    p = _c(proba)
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")


def max_probability(proba) -> Column:
    return F.array_max(_c(proba)).cast("double")


def _map_literal(mapping: dict) -> Column:
    return F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))


def decode_class(index, class_map: dict[int, str]) -> Column:
    """Class index -> class name from a small literal map; unknown -> 'Unknown'."""
    m = _map_literal({int(k): str(v) for k, v in class_map.items()})
    return F.coalesce(F.try_element_at(m, _c(index).cast("int")), F.lit(UNKNOWN_CLASS))


def normal_index(class_map: dict[int, str]) -> int:
    idx = [int(k) for k, v in class_map.items() if v == NORMAL_CLASS]
    if not idx:
        raise ValueError("class map has no 'Normal' class")
    return min(idx)


def binary_prediction(index, class_map: dict[int, str]) -> Column:
    """1 only when the index is exactly the Normal class; NULL/other -> 0."""
    return F.when(_c(index) == F.lit(normal_index(class_map)), F.lit(1)).otherwise(F.lit(0))


def status_display(status) -> Column:
    return F.try_element_at(_map_literal(STATUS_DISPLAY), _c(status))
