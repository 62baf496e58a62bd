"""Keys of the keyed device store and of the search index."""
from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def utc_ntz(ts) -> Column:
    """The instant as a UTC timestamp without zone: no session setting enters."""
    seconds = (F.unix_micros(_c(ts).cast("timestamp")).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def event_time_text(ts, legacy: bool = False) -> Column:
    """Timestamp as text the way Python renders a datetime: seconds, plus
    ``.ffffff`` only when the sub-second part is non-zero.  ISO ``T`` form by
    default; ``legacy=True`` gives the space-separated form."""
    t = _c(ts)
    text = utc_ntz(t).cast("string")  # UTC whatever the session's zone
    base = F.substring(text, 1, 19)
    if not legacy:
        base = F.translate(base, " ", "T")
    micros = F.pmod(F.unix_micros(t.cast("timestamp")), F.lit(1_000_000))
    frac = F.when(micros != 0, F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))).otherwise(F.lit(""))
    return F.concat(base, frac)


def row_key(device, ts, row_hash, hash_len: int | None = None, legacy: bool = False) -> Column:
    """``device#time#hash``: the whole fingerprint, so that no two flows share a
    key; ``legacy=True`` keeps the 8-digit prefix of older stores.  ``concat``
    (not ``concat_ws``) so that a NULL part makes the key NULL instead of
    silently shortening it."""
    if hash_len is None:
        hash_len = 8 if legacy else 64
    return F.concat(_c(device), F.lit("#"), event_time_text(ts, legacy), F.lit("#"),
                    F.substring(_c(row_hash), 1, hash_len))


def index_doc_id(device, row_hash) -> Column:
    return F.concat(_c(device), F.lit("_"), _c(row_hash))
