"""Checked broadcasts: a side is hinted only after counting it, up to a bound."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 1_000_000

Hint = Callable[[DataFrame], DataFrame]


def fits(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows; tasks count, only counts travel."""
    return df.count() <= max_rows


def broadcast_hint(bound: DataFrame, max_rows: int = BROADCAST_ROWS) -> Hint:
    """The broadcast hint for frames no larger than ``bound`` if that is small
    enough, otherwise no hint, which leaves a shuffle join."""
    return F.broadcast if fits(bound, max_rows) else lambda df: df
