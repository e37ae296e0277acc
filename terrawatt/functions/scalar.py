"""Small scalar expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tri_state_bool(value: Column) -> Column:
    """`yes` -> true, `no` -> false (any case), anything else -> NULL."""
    folded = F.lower(value)
    return F.when(folded == "yes", True).when(folded == "no", False)


def decimal_cast(value: Column, scale: int) -> Column:
    """Decimal with 18 digits; unparsable text becomes NULL."""
    return value.try_cast(f"decimal(18,{scale})")


def clamp01(value: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), value))


def percent(part: Column, whole: Column) -> Column:
    """`part` in percent of `whole`; NULL when `whole` is zero."""
    return F.try_divide(part * F.lit(100.0), whole)


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def nanos_to_timestamp(nanos: Column) -> Column:
    """Epoch nanoseconds (UTC) to a zone-less timestamp; digits below a microsecond are cut off.

    Counted from a zone-less epoch, so the session time zone plays no part.
    """
    seconds = F.floor(nanos / F.lit(1000).cast("decimal(20,0)")).cast("decimal(18,0)") / F.lit(1_000_000)
    return _epoch() + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def epoch_millis(ts: Column, zoned: bool) -> Column:
    """Milliseconds since the epoch; a zone-less timestamp counts as UTC."""
    if zoned:
        return F.unix_millis(ts)
    return F.floor(F.timestamp_diff("MICROSECOND", _epoch(), ts) / 1000)


def boundary_minutes(start: Column, end: Column) -> Column:
    """Number of minute boundaries between two instants (00:59 to 01:00 is 1)."""
    return F.timestamp_diff(
        "MINUTE", F.date_trunc("minute", start), F.date_trunc("minute", end)
    )


def sha256_of(payload: Column, wkb: Column | None = None) -> Column:
    """SHA-256 over the UTF-8 payload followed by the geometry bytes, if any."""
    body = F.encode(payload, "UTF-8")
    if wkb is not None:
        body = F.concat(body, F.coalesce(wkb, F.lit(b"")))
    return F.sha2(body, 256)


def natural_id(*parts: Column) -> Column:
    """A deterministic id in place of a random UUID: the hash of the natural key."""
    return F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
