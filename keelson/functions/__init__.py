"""Column expressions. Every function returns a ``Column`` built from
``pyspark.sql.functions`` so it stays inside whole-stage codegen."""

from keelson.functions.vehicle import (
    GEAR_CODES,
    epoch_ms_date,
    epoch_ms_hour,
    epoch_ms_wall_clock,
    epoch_seconds,
    normalize_gear,
    ntz_epoch_ms,
    trim_spaces,
)
from keelson.functions.pricing import discount, final_price, price_band
from keelson.functions.checks import is_not_numeric, is_untrimmed

__all__ = [
    "GEAR_CODES",
    "discount",
    "epoch_ms_date",
    "epoch_ms_hour",
    "epoch_ms_wall_clock",
    "epoch_seconds",
    "ntz_epoch_ms",
    "final_price",
    "is_not_numeric",
    "is_untrimmed",
    "normalize_gear",
    "price_band",
    "trim_spaces",
]
