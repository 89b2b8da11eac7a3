"""Column expressions shared by the pipelines. All of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_label(name: str) -> Column:
    return F.upper(F.trim(F.col(name))).alias(name)


def month_start(ts: Column) -> Column:
    # trunc works on dates, so the result does not depend on the session zone
    # (date_trunc on timestamp_ntz goes through a zoned timestamp).
    return F.trunc(ts.cast("date"), "month").cast("timestamp_ntz")


def quarter_start(ts: Column) -> Column:
    return F.trunc(ts.cast("date"), "quarter").cast("timestamp_ntz")


def days_between(start: Column, end: Column) -> Column:
    """Midnights crossed going from ``start`` to ``end``."""
    return F.datediff(end.cast("date"), start.cast("date"))


def flag(condition: Column) -> Column:
    """TRUE when the condition holds, FALSE when it does not or is unknown."""
    return F.coalesce(condition, F.lit(False))


def banded(value: Column, bands: Sequence[tuple[float, str]], rest: str) -> Column:
    """Label of the first band whose lower bound ``value`` reaches."""
    return F.coalesce(*[F.when(value >= low, F.lit(name)) for low, name in bands], F.lit(rest))


def within(value: Column, limits: Sequence[tuple[float, str]], rest: str) -> Column:
    """Label of the first limit that ``value`` does not exceed."""
    return F.coalesce(*[F.when(value <= top, F.lit(name)) for top, name in limits], F.lit(rest))


def mean(value: Column, digits: int) -> Column:
    """Aggregate: average of a decimal column, rounded half up once.

    ``avg`` on decimals already rounds to four extra digits; dividing sum by
    count keeps the full quotient so that the final rounding is the only one.
    """
    return F.round(F.sum(value) / F.nullif(F.count(value), F.lit(0)), digits)


def percent(part: Column, whole: Column, digits: int) -> Column:
    """100 * part / whole, NULL when the whole is zero."""
    # Operands narrow enough for the quotient to keep many more digits than the
    # result, so that it is rounded only once.
    part, whole = part.cast("decimal(22,2)"), whole.cast("decimal(22,2)")
    return F.round(part * 100 / F.nullif(whole, F.lit(0)), digits)


def growth_pct(current: Column, previous: Column, positive_only: bool = False) -> Column:
    """Period-over-period change in percent; NULL without a usable previous value."""
    current, previous = current.cast("decimal(20,2)"), previous.cast("decimal(20,2)")
    usable = previous > 0 if positive_only else previous != 0
    return F.when(usable, F.round((current - previous) / previous * 100, 2))


def padded(number: Column, digits: int = 5) -> Column:
    """A number as text of at least ``digits`` digits; longer ones keep all of theirs."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(digits)), F.lit("0"))
