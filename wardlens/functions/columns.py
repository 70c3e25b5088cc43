"""Column expressions shared by the operators; all stay inside code generation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_int(column: Column | str, modulo: int) -> Column:
    """First 32 bits of the MD5 of the text, reduced by ``modulo``."""
    text = F.col(column) if isinstance(column, str) else column
    prefix = F.substring(F.md5(text.cast("string")), 1, 8)
    return (F.conv(prefix, 16, 10).cast("bigint") % modulo).cast("int")


def pick(values: Sequence[str], index: Column) -> Column:
    """Value of a fixed list at a 0-based position."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), index + 1)


def position_in(values: Sequence[str], column: Column) -> Column:
    """1-based position in a fixed list, null for other values."""
    return F.nullif(F.array_position(F.array(*[F.lit(v) for v in values]), column), F.lit(0)).cast("int")


def flag(condition: Column) -> Column:
    """0/1 with a null comparison counted as false."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def half_even(column: Column, digits: int = 0) -> Column:
    """Round half to even on doubles: scale, ``rint``, scale back."""
    if digits == 0:
        return F.rint(column)
    scale = float(10**digits)
    return F.rint(column * scale) / scale


def clip(column: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), column))


def money(column: Column) -> Column:
    return column.cast("decimal(14,2)")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division, null when the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def mean(column: Column | str) -> Column:
    """Average from an exact sum and a count, so the result does not depend on row order."""
    value = F.col(column) if isinstance(column, str) else column
    return ratio(F.sum(value), F.count(value))


def age_band(age: Column) -> Column:
    """Right-closed bands with the lowest edge included."""
    from wardlens.config import AGE_BANDS

    inside = (age >= 0) & (age <= AGE_BANDS[-1][0])
    label = F.lit(AGE_BANDS[-1][1])
    for upper, name in reversed(AGE_BANDS[:-1]):
        label = F.when(age <= upper, F.lit(name)).otherwise(label)
    return F.when(F.coalesce(inside, F.lit(False)), label).otherwise(F.lit("nan"))


def season(month: Column) -> Column:
    quarter = F.floor((month % 12) / 3)
    return (
        F.when(quarter == 0, "Winter").when(quarter == 1, "Spring").when(quarter == 2, "Summer").when(quarter == 3, "Autumn")
    )


def month_start(day: Column) -> Column:
    """First day of the month as ``yyyy-MM-01`` text."""
    return F.date_format(day, "yyyy-MM-01")


def percent_text(column: Column) -> Column:
    """Share as text with one decimal, ties to even, e.g. ``11.8%``."""
    return F.format_string("%.1f%%", half_even(column * 100, 1))
