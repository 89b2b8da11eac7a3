"""Reproducible random values as pure functions of a row id.

``rand`` depends on how rows fall into partitions; a hash of (seed, purpose, id)
does not, so a regenerated partition, or a run on another cluster, gives the
same rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

_GRAIN = 1 << 52


@dataclass(frozen=True)
class Draw:
    seed: int
    key: tuple[str, ...] = ("id",)

    def uniform(self, purpose: str) -> Column:
        """Uniform double in [0, 1)."""
        h = F.xxhash64(F.lit(self.seed), F.lit(purpose), *[F.col(k) for k in self.key])
        return F.pmod(h, F.lit(_GRAIN)) / F.lit(float(_GRAIN))

    def integer(self, purpose: str, low: int, high: int) -> Column:
        """Whole number from low to high, both included."""
        return F.floor(self.uniform(purpose) * (high - low + 1)) + low

    def amount(self, purpose: str, low: float, high: float, to: str = "decimal(12,2)") -> Column:
        return (self.uniform(purpose) * (high - low) + low).cast(to)

    def choice(self, purpose: str, values: Sequence[str]) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), self.integer(purpose, 0, len(values) - 1))

    def percent(self, purpose: str) -> Column:
        return self.uniform(purpose) * 100

    def mix(self, purpose: str, cumulative: Sequence[tuple[float, str]]) -> Column:
        """First value whose cumulative percentage exceeds the draw."""
        p = self.percent(purpose)
        return F.coalesce(*[F.when(p < top, F.lit(v)) for top, v in cumulative])

    def sometimes(self, purpose: str, pct: float, value: Column) -> Column:
        """``value`` in pct percent of the rows, NULL in the others."""
        return F.when(self.percent(purpose) < pct, value)

    def before(self, purpose: str, end: str, seconds: int) -> Column:
        """Timestamp up to ``seconds`` before ``end``."""
        back = F.make_dt_interval(secs=-self.integer(purpose, 0, seconds))
        return F.lit(end).cast("timestamp_ntz") + back

    def uuid(self, purpose: str) -> Column:
        h = F.md5(F.concat_ws("/", F.lit(str(self.seed)), F.lit(purpose), *[F.col(k).cast("string") for k in self.key]))
        cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
        return F.concat_ws("-", *[F.substring(h, at, n) for at, n in cuts])
