"""Calendar columns."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_ts(c: str | Column) -> Column:
    """ISO text to a timestamp; malformed text gives NULL."""
    return F.try_to_timestamp(_col(c).cast("string"))


def is_off_hours(ts: str | Column) -> Column:
    """Before 7:00 or from 20:00 on; 19:xx still counts as working time."""
    h = F.hour(_col(ts))
    return (h < 7) | (h > 19)


def is_weekend(ts: str | Column) -> Column:
    return F.dayofweek(_col(ts)).isin(1, 7)


def cyclic(c: str | Column, period: float) -> tuple[Column, Column]:
    """Sine and cosine of a value on a circle, so that the last hour is next to the first."""
    angle = F.lit(2 * math.pi) * _col(c) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def time_parts(df: DataFrame, ts: str = "ts") -> DataFrame:
    hour_sin, hour_cos = cyclic(F.hour(ts), 24)
    return df.withColumns({
        "hour": F.hour(ts), "day_of_week": F.dayofweek(ts), "event_date": F.to_date(ts),
        "is_weekend": is_weekend(ts), "is_off_hours": is_off_hours(ts), "epoch": F.unix_timestamp(ts),
        "hour_sin": hour_sin, "hour_cos": hour_cos})


def bucket_start(ts: str | Column, seconds: int = 300) -> Column:
    """Start of the fixed-width time bucket an event falls into."""
    return F.timestamp_seconds(F.floor(F.unix_timestamp(_col(ts)) / seconds) * seconds)
