"""Message payload parsing (bytes -> text -> fields) and fingerprinting.

Semantics kept from the reference job:
* plain split on the separator, no CSV quoting; extra fields are ignored;
* short rows and malformed numbers become NULL instead of failing the query
  (``get`` + ``try_cast``; Spark 4 is ANSI, where ``cast``/``getItem`` throw);
* the fingerprint is SHA-256 of the raw payload text, taken before parsing.
"""
from __future__ import annotations

import re

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def payload_text(value, normalize: bool = False) -> Column:
    """Payload as a string.  ``normalize`` strips trailing CR/LF so that the
    same line sent with and without its newline fingerprints the same."""
    s = _c(value).cast("string")
    return F.regexp_replace(s, r"[\r\n]+$", "") if normalize else s


def split_payload(value, sep: str = ",", normalize: bool = False) -> Column:
    return F.split(payload_text(value, normalize), re.escape(sep), -1)


def payload_hash(value, normalize: bool = False) -> Column:
    """SHA-256 hex of the payload text (NULL payload -> NULL)."""
    return F.sha2(payload_text(value, normalize), 256)


#: fields of one type from which they are cast together
CAST_TOGETHER = 9


def _cast_all(parts: Column, first: int, last: int, dtype) -> Column:
    return F.transform(F.slice(parts, first + 1, last - first + 1), lambda x: x.try_cast(dtype))


def parse_fields(value, layout, sep: str = ",", normalize: bool = False) -> list[Column]:
    """One typed column per ``(name, type)`` of ``layout``, by position.

    Many fields of one type are cast as one array: a cast per field makes the
    generated method of a wide record too long for the JIT compiler, which then
    interprets it for every row."""
    parts = split_payload(value, sep, normalize)
    places: dict = {}
    for i, (_, dtype) in enumerate(layout):
        places.setdefault(dtype, []).append(i)
    out = []
    for i, (name, dtype) in enumerate(layout):
        at = places[dtype]
        if isinstance(dtype, T.StringType):
            col = F.get(parts, i)
        elif len(at) >= CAST_TOGETHER:
            col = F.get(_cast_all(parts, at[0], at[-1], dtype), i - at[0])
        else:
            col = F.get(parts, i).try_cast(dtype)
        out.append(col.alias(name))
    return out


def bind_once(value: Column, fn) -> Column:
    """``fn(value)`` with ``value`` evaluated once per row.

    Filters are pushed below projections by substituting aliases, and filter
    conditions get no common-subexpression elimination, so a condition that
    uses one split payload fifteen times would split it fifteen times.  A
    one-element ``transform`` binds the value to a lambda variable instead."""
    return F.get(F.transform(F.array(value), fn), 0)


def reject_reason(value, layout, sep: str = ",", device_field: str = "device_name",
                  normalize: bool = False) -> Column:
    """Why a payload cannot become a valid flow, or NULL when it can.

    ``arity``: wrong number of fields; ``bad_number``: a non-empty numeric
    field that does not parse; ``null_device``: empty device name;
    ``null_payload``: no payload at all.
    """
    n = len(layout)
    dev_idx = [i for i, (nm, _) in enumerate(layout) if nm == device_field]

    def reason(parts: Column) -> Column:
        bad_num = F.lit(False)
        for i, (_, dtype) in enumerate(layout):
            if isinstance(dtype, T.StringType):
                continue
            raw = F.trim(F.get(parts, i))
            bad_num = bad_num | (raw.isNotNull() & (raw != "") & raw.try_cast(dtype).isNull())
        null_dev = F.lit(False)
        if dev_idx:
            d = F.get(parts, dev_idx[0])
            null_dev = d.isNull() | (F.trim(d) == "")
        return (F.when(parts.isNull(), F.lit("null_payload"))
                .when(F.size(parts) != n, F.lit("arity"))
                .when(bad_num, F.lit("bad_number"))
                .when(null_dev, F.lit("null_device")))

    return bind_once(split_payload(value, sep, normalize), reason)
