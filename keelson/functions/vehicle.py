"""Vehicle telemetry column functions (trim, gear codes, event date/hour)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Gear letters and the numeric code each one becomes.
# D -> "4", R -> "-1", N -> "0", P -> "0"; anything else (and null) is kept.
GEAR_CODES: dict[str, str] = {"D": "4", "R": "-1", "N": "0", "P": "0"}

_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_spaces(c: str | Column) -> Column:
    """Strip leading/trailing spaces (not tabs); null stays null."""
    return F.trim(_col(c))


def normalize_gear(c: str | Column, codes: dict[str, str] | None = None) -> Column:
    """Case-sensitive gear letter -> numeric string; other values unchanged."""
    codes = GEAR_CODES if codes is None else codes
    col = _col(c)
    if not codes:
        return col.cast("string")
    items = list(codes.items())
    first = F.when(col == F.lit(items[0][0]), F.lit(items[0][1]))
    chain = reduce(lambda acc, kv: acc.when(col == F.lit(kv[0]), F.lit(kv[1])), items[1:], first)
    return chain.otherwise(col.cast("string"))


def epoch_seconds(ms: str | Column) -> Column:
    """Whole seconds of an epoch-millisecond value, truncated toward zero."""
    c = _col(ms).cast("long")
    return F.call_function("div", c, F.lit(1000).cast("long"))


def epoch_ms_wall_clock(ms: str | Column, time_zone: str | None = None) -> Column:
    """Wall-clock TIMESTAMP_NTZ of an epoch-millisecond value in ``time_zone``.

    ``time_zone=None`` means the session time zone, as in the reference. The
    result is zone-free, so ``date_format``/``hour`` on it do not consult the
    session zone a second time.
    """
    utc_wall = F.timestamp_add("SECOND", epoch_seconds(ms), F.expr(_EPOCH))
    target = F.current_timezone() if time_zone is None else F.lit(time_zone)
    return F.convert_timezone(F.lit("UTC"), target, utc_wall)


def ntz_epoch_ms(ts: str | Column) -> Column:
    """Epoch milliseconds (floored) of a TIMESTAMP_NTZ wall clock read as UTC.

    Built from date and time parts, which are zone-free for NTZ values;
    ``timestamp_diff``/``unix_micros`` would go through the session zone.
    """
    t = _col(ts).cast("timestamp_ntz")
    days = F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("long")
    whole = (days * 86400 + F.hour(t) * 3600 + F.minute(t) * 60) * 1000
    return (whole + F.floor(F.extract(F.lit("SECOND"), t) * 1000)).cast("long")


def epoch_ms_date(ms: str | Column, time_zone: str | None = None) -> Column:
    """``yyyy-MM-dd`` STRING of the event in ``time_zone`` (default: session)."""
    return F.to_date(epoch_ms_wall_clock(ms, time_zone)).cast("string")


def epoch_ms_hour(ms: str | Column, time_zone: str | None = None) -> Column:
    """Hour 0-23 (INT) of the event in ``time_zone`` (default: session)."""
    return F.hour(epoch_ms_wall_clock(ms, time_zone))
