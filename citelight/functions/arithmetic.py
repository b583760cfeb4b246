"""Division, rounding and exact sums.

Sums of DOUBLE values run over decimals of 38 digits: no value is rounded before it is added, and the
result does not depend on the order in which the partial sums of the cluster arrive. What does not fit (NaN, infinity, a value
or a sum too large, a value with more decimals than the sum carries) ends the job with an error instead of
giving a wrong number.
"""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec, functions as F

#: Decimals of a sum; 14 digits are left before the point.
SCALE = 24


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Quotient, NULL where the denominator is zero or NULL."""
    return F.try_divide(numerator, denominator)


def exact(value: Column, scale: int = SCALE) -> Column:
    """A DOUBLE as the decimal that its shortest spelling names; NULL stays NULL."""
    kind = f"decimal(38,{scale})"
    size = F.abs(value)
    # A DOUBLE has 17 digits at most, so only small ones can have more decimals than there are.
    small = F.when((size == 0) | (size >= 10.0 ** (17 - scale)), True).otherwise(value.cast(kind).cast("double") == value)
    fits = F.when(size < 10.0 ** (38 - scale), small).otherwise(False)
    wrong = F.raise_error(F.concat(F.lit("not exact in a sum: "), value.cast("string"))).cast(kind)
    return F.when(value.isNull(), F.lit(None).cast(kind)).when(fits, value.cast(kind)).otherwise(wrong)


def total(value: Column, scale: int = SCALE, over: WindowSpec | None = None) -> Column:
    """SUM as DOUBLE, in a group or ``over`` a window; NULL without values."""
    value = value.cast("double")
    summed, values = F.sum(exact(value, scale)), F.count(value)
    if over is not None:
        summed, values = summed.over(over), values.over(over)
    # Where ANSI mode is off a sum that is too large is NULL.
    lost = summed.isNull() & (values > 0)
    return F.when(lost, F.raise_error(F.lit("a sum exceeds 38 digits")).cast("double")).otherwise(summed.cast("double"))


def mean(value: Column, scale: int = SCALE, over: WindowSpec | None = None) -> Column:
    """AVG as DOUBLE; NULL without values."""
    values = F.count(value) if over is None else F.count(value).over(over)
    return safe_divide(total(value, scale, over), values)


def round_to(value: Column, places: int) -> Column:
    """Round half away from zero, staying in DOUBLE arithmetic."""
    scale = float(10**places)
    return F.signum(value) * (F.floor(F.abs(value) * scale + 0.5) / scale)


def rescale_percent(value: Column) -> Column:
    """0..100 to 0..1."""
    return value / F.lit(100.0)


def rescale_sentiment(value: Column) -> Column:
    """0..100 with 50 neutral, to -1..1."""
    return (value - F.lit(50.0)) / F.lit(50.0)
