"""Price banding and discount arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Band labels and default thresholds (price < 15 -> Low,
# price < 20 -> Medium, otherwise High; a null price matches no branch -> High).
BAND_LOW, BAND_MEDIUM, BAND_HIGH = "Low", "Medium", "High"
DEFAULT_LOW_BELOW, DEFAULT_MEDIUM_BELOW = 15.0, 20.0
DEFAULT_DISCOUNT_RATE = 0.1


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def price_band(price: str | Column, low_below: float = DEFAULT_LOW_BELOW,
               medium_below: float = DEFAULT_MEDIUM_BELOW) -> Column:
    p = _col(price)
    return (F.when(p < F.lit(low_below), F.lit(BAND_LOW))
            .when(p < F.lit(medium_below), F.lit(BAND_MEDIUM))
            .otherwise(F.lit(BAND_HIGH)))


def discount(price: str | Column, rate: float = DEFAULT_DISCOUNT_RATE) -> Column:
    return _col(price) * F.lit(rate)


def final_price(price: str | Column, rate: float = DEFAULT_DISCOUNT_RATE) -> Column:
    p = _col(price)
    return p - discount(p, rate)
