"""Column expressions. All of them are built-in Spark expressions, so they stay
inside whole-stage code generation; none is a UDF."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def round_half_up(value: Column | str, digits: int = 0) -> Column:
    """Round a number half away from zero, computed on doubles.

    Written with ``floor`` so that every engine that follows IEEE arithmetic
    gives the same double.
    """
    scale = float(10**digits)
    scaled = _column(value).cast("double") * F.lit(scale)
    magnitude = F.floor(F.abs(scaled) + F.lit(0.5))
    return F.when(scaled < 0, -magnitude).otherwise(magnitude) / F.lit(scale)


def percent(part: Column | str, whole: Column | str, digits: int = 1) -> Column:
    """``part`` as a rounded percentage of ``whole``; NULL if ``whole`` is zero."""
    ratio = F.try_divide(F.lit(100.0) * _column(part).cast("double"), _column(whole).cast("double"))
    return round_half_up(ratio, digits)


def minor_units(value: Column | str, minor: int = 100) -> Column:
    """A DOUBLE amount as a whole number of minor units (cents).

    Integers are summed exactly and much faster than decimals; a sum beyond
    BIGINT raises an error. For amounts with no more digits than ``minor`` has.
    """
    return F.rint(_column(value) * F.lit(float(minor))).cast("bigint")


def wide(df: DataFrame, name: str) -> Column:
    """An integer column as DECIMAL(38,0), for sums of sums that go beyond BIGINT; others as they are."""
    value = F.col(name)
    return value.cast("decimal(38,0)") if dict(df.dtypes)[name] in ("int", "bigint") else value


def major_units(value: Column | str, minor: int = 1) -> Column:
    """Minor units back to the amount; ``minor=1`` leaves the value and its type."""
    value = _column(value)
    return value if minor == 1 else value.cast("double") / F.lit(float(minor))


def mean(value: Column | str, minor: int = 1) -> Column:
    """Average as exact sum over count.

    For decimal and integer input the sum is exact, so the result does not
    depend on the order in which partitions are merged.
    """
    value = _column(value)
    total = major_units(F.sum(value), minor).cast("double")
    return F.try_divide(total, F.count(value).cast("double"))


def total_or_zero(value: Column | str) -> Column:
    return F.coalesce(F.sum(_column(value)), F.lit(0))


def quarter_number(date: Column | str) -> Column:
    """Quarters counted from year 0: a cheap grouping key."""
    date = _column(date)
    return F.year(date) * 4 + F.quarter(date) - 1


def quarter_text(number: Column | str) -> Column:
    """``YYYY-Qn`` of a quarter number."""
    number = _column(number)
    year = F.floor(number / 4).cast("string")
    return F.concat(year, F.lit("-Q"), (F.pmod(number, F.lit(4)) + 1).cast("string"))


def quarter_label(date: Column | str) -> Column:
    """``YYYY-Qn`` of a date."""
    return quarter_text(quarter_number(date))


def days_between(later: Column | str, earlier: Column | str) -> Column:
    """Whole days from ``earlier`` to ``later`` as BIGINT."""
    return F.datediff(_column(later), _column(earlier)).cast("bigint")


def is_blank(df: DataFrame, name: str) -> Column:
    """NULL and, for texts, the empty string: no value."""
    value = F.col(name)
    return value.isNull() | (value == F.lit("")) if dict(df.dtypes)[name] == "string" else value.isNull()


def blank_to_null(value: Column | str) -> Column:
    return F.nullif(_column(value), F.lit(""))


def null_if_sentinel(value: Column | str, sentinels: Iterable[str]) -> Column:
    """NULL for the listed texts (compared case-sensitively)."""
    value = _column(value)
    return F.when(value.isin(*sentinels), F.lit(None)).otherwise(value)


def repair_prefix(value: Column | str, wrong: str, right: str) -> Column:
    """Replace a wrong key prefix; the text further inside the key is kept."""
    return F.regexp_replace(_column(value), f"^{wrong}", right)


def format_key(prefix: str | Column, number: Column | str) -> Column:
    """Prefix plus a zero-padded number; wider than five digits if needed."""
    prefix = F.lit(prefix) if isinstance(prefix, str) else prefix
    return F.concat(prefix, F.format_string("%05d", _column(number)))


def md5_modulo(value: Column | str, modulus: Column | int) -> Column:
    """The 128-bit MD5 digest of a text, read as one integer, modulo ``modulus``.

    Horner's scheme over the four 32-bit words keeps every step within BIGINT
    as long as the modulus stays below 2**31.
    """
    digest = F.md5(F.coalesce(_column(value), F.lit("")))
    modulus = F.lit(modulus) if isinstance(modulus, int) else modulus
    modulus = modulus.cast("bigint")
    base = F.lit(2**32).cast("bigint") % modulus
    remainder = F.lit(0).cast("bigint")
    for start in (1, 9, 17, 25):
        word = F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint")
        remainder = (remainder * base + word) % modulus
    return remainder


def thousands(value: Column | str, digits: int = 0) -> Column:
    """Text with thousands separators, for display."""
    return F.format_number(_column(value), digits)
