"""Vehicle telemetry cleaning: the whole transform as one projection + filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.functions.vehicle import epoch_ms_date, epoch_ms_hour, normalize_gear, trim_spaces


def clean_vehicle_events(df: DataFrame, time_zone: str | None = None) -> DataFrame:
    """Trim ``manufacturer``, keep rows with a non-null ``vin`` (empty string
    kept), map gear letters to numeric codes, and add the event ``date``
    (yyyy-MM-dd STRING) and ``hour`` (INT) from the epoch-ms ``timestamp``.

    All other columns pass through. ``time_zone=None`` uses the session zone.
    The filter sits on an untouched input column, so Catalyst pushes it into
    the scan; everything else is one codegen'd projection.
    """
    return (
        df.filter(F.col("vin").isNotNull())
        .withColumns({
            "manufacturer": trim_spaces("manufacturer"),
            "gearPosition": normalize_gear("gearPosition"),
            "date": epoch_ms_date("timestamp", time_zone),
            "hour": epoch_ms_hour("timestamp", time_zone),
        })
    )
