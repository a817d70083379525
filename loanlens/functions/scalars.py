"""Null-safe column expressions for raw text fields."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING_CLASS = "<NA>"


NUMBER = r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)\s*$"
WHOLE = r"^\s*([+-]?\d+)(?:\.0*)?\s*$"


def to_number(c: Column) -> Column:
    """Text to double; anything that is not a finite number becomes null.

    The pattern keeps out what Java's parser takes but a data file never means as a number
    (``1d``, ``NaN``, ``Infinity``), and names the input once, so the plan stays small.
    """
    return F.regexp_extract(c.cast("string"), NUMBER, 1).try_cast("double")


def to_integer(c: Column) -> Column:
    """Text or number to a nullable bigint, ``200503.0`` and ``1e2`` included; fractions become null.

    Whole digits are read as they stand, so that large ids keep all of them; other forms, such as
    the one in which a large double is printed, go through a double.
    """
    number = to_number(c)
    exact = (number == F.floor(number)) & (F.abs(number) < 2.0**63)
    plain = F.regexp_extract(c.cast("string"), WHOLE, 1).try_cast("bigint")
    return F.coalesce(plain, F.when(exact, number.try_cast("bigint")))


def to_month(c: Column) -> Column:
    """``yyyyMM`` as text, integer or float text to the first day of that month."""
    return F.try_to_date(to_integer(c).cast("string"), "yyyyMM")


def month_start(whole: Column) -> Column:
    """First day of a ``yyyyMM`` integer; anything that is not a month becomes null."""
    month = whole % 100
    valid = whole.between(100_001, 999_912) & month.between(1, 12)
    year = F.floor(whole / 100).cast("int")
    return F.when(valid, F.make_date(year, month.cast("int"), F.lit(1)))


def null_if_in(c: Column, values: Iterable) -> Column:
    values = list(values)
    return F.when(~c.isin(values), c) if values else c


def category(c: Column, sentinels: Iterable[str] = (), unknown: str = "UNKNOWN") -> Column:
    """Trimmed upper-case text, with sentinel codes turned into one class."""
    text = F.upper(F.trim(c.cast("string")))
    sentinels = list(sentinels)
    return F.when(text.isin(sentinels), F.lit(unknown)).otherwise(text) if sentinels else text


def month_index(c: Column) -> Column:
    return F.year(c) * 12 + F.month(c)


def month_difference(later: Column, earlier: Column) -> Column:
    return month_index(later) - month_index(earlier)


def finite_or_zero(c: Column) -> Column:
    """Infinite, NaN, unparseable and null values become 0.0; booleans become 0/1."""
    value = c.try_cast("double")
    usable = value.isNotNull() & ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))
    return F.when(usable, value).otherwise(F.lit(0.0))


def ratio(numerator: Column, denominator: Column, default: float | None = 0.0) -> Column:
    """Division where an empty denominator gives ``default`` instead of an error."""
    value = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return F.coalesce(value, F.lit(default).cast("double")) if default is not None else value


def seeded_key(c: Column, seed: int) -> Column:
    """Stable pseudo-random sort key of an id: the same on every run and partitioning."""
    return F.md5(F.concat(F.coalesce(c.cast("string"), F.lit("")), F.lit(f":{seed}")))


def or_missing_class(c: Column) -> Column:
    """Null categories form a class of their own instead of the unseen-value class."""
    return F.coalesce(c.cast("string"), F.lit(MISSING_CLASS))
