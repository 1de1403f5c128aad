"""Numeric and date column helpers. All of them map NaN to NULL and never raise under ANSI."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from rivulet.functions.text import strip

# A plain decimal number of 1e-308 or more in scale; other spellings a JVM would read (1d, 0x1p3)
# are no numbers.
PLAIN_NUMBER = r"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE](?:\+?[0-9]+|-0*(?:[0-2]?[0-9]{1,2}|30[0-7])))?"


def any_of(conditions: Sequence[Column]) -> Column:
    """True when one condition holds; a NULL condition counts as false."""
    result = F.lit(False)
    for condition in conditions:
        result = result | F.coalesce(condition, F.lit(False))
    return result


def known(value: Column) -> Column:
    """Number with NaN read as missing."""
    return F.nanvl(value, F.lit(None).cast("double"))


def finite(value: Column) -> Column:
    """Double value, NULL for NaN and infinities."""
    number = value.try_cast("double")
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def to_double(value: Column) -> Column:
    """Text or number to double, NULL for blank, malformed, NaN and infinite values."""
    text = strip(value.cast("string"))
    return finite(F.when(text.rlike(rf"\A{PLAIN_NUMBER}\z"), text))


def to_doubles(texts: Column) -> Column:
    """``to_double`` for every text of an array, each step done once per text; only what is no number as it is gets stripped."""
    def plain(text: Column) -> Column:
        return text.rlike(rf"\A{PLAIN_NUMBER}\z")

    found = F.transform(texts, lambda t: F.when(plain(t), t).otherwise(F.when(plain(strip(t)), strip(t))).try_cast("double"))
    return F.transform(found, finite)


def to_int(value: Column) -> Column:
    """Whole part of a number or of a number's text."""
    return to_double(value).try_cast("int")


def to_text(value: Column) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(strip(value.cast("string")), F.lit(""))


def safe_float(value: Column) -> Column:
    """Number of a table cell; '', '-', 'N/A' and other text are missing."""
    return to_double(value)


def mean_of_pair(low: Column, high: Column) -> Column:
    """Mean of two numbers at 4 decimals; a lone value is kept as it is."""
    return F.coalesce(F.round((low + high) / 2, 4), low, high)


def minmax_avg(low: Column, high: Column) -> Column:
    """Mean of a min/max pair of cells."""
    return mean_of_pair(safe_float(low), safe_float(high))


def year_to_date(year: Column) -> Column:
    return F.make_date(year, F.lit(1), F.lit(1))


def date_to_text(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM-dd")


def text_to_year(text: Column) -> Column:
    return F.substring(text, 1, 4).try_cast("int")


def round_mean(mean: Column, digits: int) -> Column:
    """Rounded mean.

    The first step removes the noise left by the order in which partial sums were added, so that
    a mean on a rounding tie gives the same digits on every run.
    """
    return F.round(F.round(mean, digits + 4), digits)


def fixed_point(value: Column) -> Column:
    """Value in millionths as a whole number.

    Sums of whole numbers do not depend on the order in which partitions arrive, so a rerun
    after a lost executor gives the same digits.
    """
    return F.round(value * 1_000_000).cast("bigint")
