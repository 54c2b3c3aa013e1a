"""Clock and calendar arithmetic on local, naive times."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def is_clock_time(hhmm: Column) -> Column:
    """Whether an integer reads as HHMM from 0 to 2359, or as 2400."""
    return (hhmm.between(0, 2359) & (hhmm % 100 < 60)) | (hhmm == 2400)


def minute_of_day(hhmm: Column) -> Column:
    """Minutes since midnight; 2400 wraps to 0."""
    minutes = F.call_function("div", hhmm, F.lit(100)) * 60 + hhmm % 100
    return (minutes % 1440).cast("int")


def hour_of_day(minutes: Column) -> Column:
    return F.call_function("div", minutes, F.lit(60)).cast("int")


def clock_time(hour: Column, minute: Column) -> Column:
    """HHMM integer of an hour and a minute."""
    return (hour * 100 + minute).cast("int")


def arrival_day_offset(departure: Column, arrival: Column, elapsed: Column) -> Column:
    """Day shift of the local arrival relative to the local departure date.

    The planned duration says how far arrival should be from departure; what is left is a time
    zone difference. Beyond half a day either way it can only be a change of date.
    """
    zone_shift = arrival.cast("double") - departure.cast("double") - elapsed
    return (
        F.when(zone_shift < -720, F.lit(1)).when(zone_shift > 720, F.lit(-1)).otherwise(F.lit(0))
    )


def hour_index(day: Column, minutes: Column, day_offset: Column | None = None) -> Column:
    """Hours since the epoch: an integer axis on which hour windows are plain ranges."""
    days = F.unix_date(day)
    if day_offset is not None:
        days = days + day_offset
    return (days * 24 + hour_of_day(minutes)).cast("bigint")


def cyclic(position: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a position on a cycle."""
    angle = position * F.lit(2.0 * math.pi) / F.lit(period)
    return F.sin(angle), F.cos(angle)
