"""Guarded ratios and confidence bounds."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ontime.schema import WILSON_Z


def ratio(part: Column, whole: Column) -> Column:
    """Null rather than an error or NaN when the denominator is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def ratio_or_zero(part: Column, whole: Column) -> Column:
    return F.coalesce(ratio(part, whole), F.lit(0.0))


def percentage(part: Column, whole: Column) -> Column:
    return ratio(part, whole) * 100.0


def wilson_interval(successes: Column, total: Column) -> tuple[Column, Column]:
    """95 % Wilson score interval of a proportion; ``(0, 1)`` without observations."""
    z, n = F.lit(WILSON_Z), total.cast("double")
    share = ratio(successes, total)
    spread = z * F.sqrt(F.try_divide(share * (1 - share), n) + F.try_divide(z * z, 4 * n * n))
    middle = share + F.try_divide(z * z, 2 * n)
    scale = 1 + F.try_divide(z * z, n)
    lower = F.greatest((middle - spread) / scale, F.lit(0.0))
    upper = F.least((middle + spread) / scale, F.lit(1.0))
    return F.coalesce(lower, F.lit(0.0)), F.coalesce(upper, F.lit(1.0))


def wilson_lower(successes: Column, total: Column) -> Column:
    """Lower end of the same interval, kept inside [0, 1]."""
    return F.least(wilson_interval(successes, total)[0], F.lit(1.0))
