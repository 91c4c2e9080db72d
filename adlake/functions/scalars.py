"""Scalar building blocks: Column in, Column out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Money keeps six decimals; sums of it stay exact.
MONEY = T.DecimalType(20, 6)
_ROUNDING = T.DecimalType(38, 9)


def as_column(value: Column | str | int | float) -> Column:
    if isinstance(value, Column):
        return value
    return F.col(value) if isinstance(value, str) else F.lit(value)


def text(col: Column | str) -> Column:
    return F.trim(as_column(col))


def lower_text(col: Column | str) -> Column:
    return F.lower(text(col))


def tolerant_int(col: Column | str, kind: str = "int") -> Column:
    """Whole part of a number written as text; null if it is no number of that type.

    Exports of optional integer columns often read ``17.0``, which a strict cast
    rejects.
    """
    whole = F.regexp_extract(text(col), r"^([+-]?\d+)(?:\.\d*)?$", 1)
    return whole.try_cast(kind)


def capitalize_words(column: str) -> Column:
    """Upper-case each letter that starts a word, lower-case the rest.

    A word starts after any character that is neither letter nor digit, so
    ``new-york us_east`` becomes ``New-York Us_East`` (Spark's own ``initcap``
    only splits at spaces).
    """
    words = rf"split(lower(`{column}`), r'(?<=[^\p{{L}}\p{{N}}])(?=[\p{{L}}\p{{N}}])')"
    capital = "w -> concat(upper(left(w, 1)), substr(w, 2))"
    return F.expr(f"array_join(transform({words}, {capital}), '')")


def non_zero(col: Column | str) -> Column:
    """The value, or null where it is zero."""
    return F.nullif(as_column(col), F.lit(0))


def ratio(num: Column | str, den: Column | str) -> Column:
    """num / den as double; null where den is zero or either side is null."""
    return as_column(num).cast("double") / non_zero(as_column(den).cast("double"))


def safe_divide(num: Column | str, den: Column | str, null_result: float | None = 0) -> Column:
    """num / den, with ``null_result`` where den is null or zero.

    A null numerator over a good denominator stays null.
    """
    den = as_column(den).cast("double")
    return F.when(den.isNull() | (den == 0), F.lit(null_result).cast("double")).otherwise(
        as_column(num).cast("double") / non_zero(den)
    )


def exact_ratio(num: Column | str, den: Column | str, digits: int, times: int = 1) -> Column:
    """num / den * times on decimals, rounded once (half away from zero), as double.

    Null where den is zero or a side is null. Counts and money are exact as decimals, and
    the quotient keeps at least eleven digits behind the point.
    """
    n, d = as_column(num).cast(MONEY) * times, as_column(den).cast(MONEY)
    return F.round(n / non_zero(d), digits).cast("double")


def money(col: Column | str) -> Column:
    """As an exact amount; a value outside its range is an error, not a null."""
    value = as_column(col)
    exact = value.try_cast(MONEY)
    fault = F.raise_error(F.concat(F.lit("amount out of range: "), value.cast("string")))
    return F.when(value.isNotNull() & exact.isNull(), fault.cast(MONEY)).otherwise(exact)


def rounded(col: Column | str, digits: int) -> Column:
    """Round half away from zero on the decimal value, returned as double.

    Rounding the binary double directly would turn 1.005 into 1.00 or 1.01
    depending on the engine. Values too large for the decimal have no such digits and
    stay as they are.
    """
    value = as_column(col)
    exact = F.round(value.try_cast(_ROUNDING), digits).cast("double")
    return F.coalesce(exact, value.cast("double"))


def finite_number(col: Column | str) -> Column:
    """As double; null if not numeric, infinite or NaN."""
    number = as_column(col).try_cast("double")
    return F.when(F.isnan(number) | (F.abs(number) == float("inf")), None).otherwise(number)


def day_of_week(ts: Column | str) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(as_column(ts)) - 1


def peak_hour_flag(ts: Column | str) -> Column:
    """1 from 18:00 up to 22:59, else 0."""
    return F.when(F.hour(as_column(ts)).between(18, 22), 1).otherwise(0)


def day(ts: Column | str) -> Column:
    return F.to_date(as_column(ts))


def days_between(end: Column | str, start: Column | str) -> Column:
    return F.datediff(as_column(end), as_column(start))


def date_range(start: Column | str, end: Column | str) -> Column:
    """Array of the days from start to end inclusive; null if end lies before start."""
    start, end = as_column(start), as_column(end)
    return F.when(end >= start, F.sequence(start, end, F.expr("interval 1 day")))
