"""Money, rounding and guarded division."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pence(amount: Column) -> Column:
    """DECIMAL pounds as whole pence.

    Money is summed as BIGINT pence: exact, independent of the order in which
    partitions merge, and kept in primitive registers instead of BigDecimal.
    """
    return (amount * 100).cast("long")


def pounds(whole_pence: Column) -> Column:
    return (whole_pence.cast("decimal(20,0)") / F.lit(100)).cast("decimal(20,2)")


def money_sum(amount: Column) -> Column:
    return pounds(F.sum(pence(amount)))


def money_avg(amount: Column) -> Column:
    """Mean of a DECIMAL amount in pounds, from exact sums."""
    return F.try_divide(F.sum(pence(amount)).cast("double"), F.count(amount).cast("double")) / 100


def line_pence(quantity: Column, unit_price: Column) -> Column:
    return pence(unit_price) * quantity


def revenue(quantity: Column, unit_price: Column) -> Column:
    return pounds(F.sum(line_pence(quantity, unit_price)))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division that gives null, not an error, for a zero divisor."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double") * 100, whole.cast("double"))


def half_up(value: Column, places: int) -> Column:
    """Round half up on the decimal value, as SQL ROUND does; result is a double."""
    return F.round(value.cast("decimal(28,8)"), places).cast("double")


def mean_int(value: Column) -> Column:
    """Mean of an integer column from an exact sum."""
    return F.try_divide(F.sum(value).cast("double"), F.count(value).cast("double"))


def ceil_to_multiple(value: Column, multiple: Column) -> Column:
    return F.ceil(value.cast("double") / multiple.cast("double")) * multiple


def stable_hash(*columns: str | Column, salt: int = 0) -> Column:
    """A whole number in [0, 2^48) from the md5 of salt and values, joined by "|": the same in every engine. Nulls are skipped."""
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    text = F.concat_ws("|", F.lit(str(salt)), *[c.cast("string") for c in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("long")
