"""Metrics by dimensions over related tables.

Every metric is aggregated at the grain of its own entity; only parents reached
along many-to-one relationships are joined, so no row is ever counted twice.
Results of different entities are then lined up on the dimensions.

A metric with parts is a sum, count, mean or distinct count whose parts can be added
up. An entity whose metrics all have them is first reduced to one row per foreign key
(and own dimension) that the dimensions need, and only these rows meet the parents.
The parts by some dimensions may also be stored as a rollup; a query is answered
from the smallest rollup that has its dimensions and metrics.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Entity:
    name: str
    key: str
    synonyms: tuple[str, ...] = ()


@dataclass(frozen=True)
class Relationship:
    """Many rows of ``child`` point at one row of ``parent`` through ``column``."""

    child: str
    column: str
    parent: str


@dataclass(frozen=True)
class Parts:
    """Aggregates of rows that make up a metric: ``partial`` ones over any cut of the rows,
    and the metric as an aggregate over those. Rows of different ``apart`` columns must
    stay apart until then."""

    partial: Mapping[str, Callable[[], Column]]
    merged: Callable[[Mapping[str, Column]], Column]
    apart: tuple[str, ...] = ()

    def addable(self) -> bool:
        return not self.apart


def summed(value: str) -> Parts:
    return Parts({"sum": lambda: F.sum(value)}, lambda p: F.sum(p["sum"]))


def counted(value: str) -> Parts:
    return Parts({"n": lambda: F.count(value)}, lambda p: F.coalesce(F.sum(p["n"]), F.lit(0)))


def counted_if(condition: Callable[[], Column]) -> Parts:
    return Parts({"n": lambda: F.count_if(condition())}, lambda p: F.coalesce(F.sum(p["n"]), F.lit(0)))


def averaged(value: str, digits: int) -> Parts:
    """The mean of a decimal, rounded once: the total keeps room for a long quotient."""
    total = lambda p: F.sum(p["sum"]).cast("decimal(22,4)")
    return Parts(
        {"sum": lambda: F.sum(value), "n": lambda: F.count(value)},
        lambda p: F.round(total(p) / F.nullif(F.sum(p["n"]), F.lit(0)), digits),
    )


def distinct(value: str) -> Parts:
    return Parts({}, lambda p: F.count_distinct(value), (value,))


@dataclass(frozen=True)
class Expression:
    """A named expression of one entity. ``build`` returns a fresh Column; metrics may
    have ``parts``."""

    entity: str
    name: str
    build: Callable[[], Column]
    synonyms: tuple[str, ...] = ()
    parts: Parts | None = None


class SemanticError(ValueError):
    pass


@dataclass(frozen=True)
class SemanticModel:
    entities: Sequence[Entity]
    relationships: Sequence[Relationship]
    facts: Sequence[Expression] = field(default=())
    dimensions: Sequence[Expression] = field(default=())
    metrics: Sequence[Expression] = field(default=())

    def entity(self, name: str) -> Entity:
        return next(e for e in self.entities if e.name == name)

    def resolve(self, name: str) -> str:
        """Metric or dimension meant by ``name``: a name, entity.name or a synonym."""
        wanted = name.strip().lower()
        exact = {x.name for x in (*self.metrics, *self.dimensions) if wanted in (x.name, f"{x.entity}.{x.name}")}
        found = exact or {
            x.name for x in (*self.metrics, *self.dimensions) if wanted in {s.lower() for s in x.synonyms}
        }
        if len(found) != 1:
            raise SemanticError(f"{name!r} is {'ambiguous: ' + ', '.join(sorted(found)) if found else 'unknown'}")
        return found.pop()

    def path(self, start: str, goal: str) -> list[Relationship]:
        """The one chain of many-to-one steps from ``start`` to ``goal``."""
        chains, complete = [[r] for r in self.relationships if r.child == start], []
        while chains:
            chain = chains.pop()
            if chain[-1].parent == goal:
                complete.append(chain)
            else:
                chains += [[*chain, r] for r in self.relationships if r.child == chain[-1].parent]
        if len(complete) != 1:
            raise SemanticError(f"{len(complete)} ways from {start} to {goal}")
        return complete[0]

    def describe(self, spark: SparkSession) -> DataFrame:
        kinds = (("FACT", self.facts), ("DIMENSION", self.dimensions), ("METRIC", self.metrics))
        rows = [(kind, x.entity, x.name, list(x.synonyms)) for kind, xs in kinds for x in xs]
        return spark.createDataFrame(rows, "KIND string, ENTITY string, NAME string, SYNONYMS array<string>")


@dataclass(frozen=True)
class Rollup:
    """The parts of an entity's metrics by some dimensions, stored."""

    entity: str
    dimensions: tuple[str, ...]
    metrics: tuple[str, ...]
    rows: DataFrame
    size: int


def _part(metric: Expression, part: str) -> str:
    return f"{metric.name}__{part}"


def _partials(metrics: Sequence[Expression]) -> list[Column]:
    return [build().alias(_part(m, p)) for m in metrics for p, build in m.parts.partial.items()]


def _merged(metric: Expression) -> Column:
    return metric.parts.merged({p: F.col(_part(metric, p)) for p in metric.parts.partial}).alias(metric.name)


def build_rollup(
    model: SemanticModel, tables: dict[str, DataFrame], entity: str, dimensions: Sequence[str], path: str
) -> Rollup:
    """Store the parts of all metrics of an entity that can be added up, by some dimensions."""
    dims = tuple(model.resolve(d) for d in dimensions)
    metrics = [m for m in model.metrics if m.entity == entity and m.parts is not None and m.parts.addable()]
    rows = _with_dimensions(model, tables, entity, dims, metrics)
    return _stored(entity, dims, metrics, rows, path)


def coarser_rollup(model: SemanticModel, rollup: Rollup, dimensions: Sequence[str], path: str) -> Rollup:
    """A rollup by fewer dimensions, made from a finer one."""
    dims = tuple(model.resolve(d) for d in dimensions)
    if not set(dims) <= set(rollup.dimensions):
        raise SemanticError(f"{dims} are not among {rollup.dimensions}")
    metrics = [m for m in model.metrics if m.name in rollup.metrics and m.entity == rollup.entity]
    return _stored(rollup.entity, dims, metrics, rollup.rows, path)


def _stored(entity: str, dims: tuple[str, ...], metrics: Sequence[Expression], rows: DataFrame, path: str) -> Rollup:
    parts = [_part(m, p) for m in metrics for p in m.parts.partial]
    rows.groupBy(*dims).agg(*[F.sum(p).alias(p) for p in parts]).write.parquet(path)
    kept = rows.sparkSession.read.parquet(path)
    return Rollup(entity, dims, tuple(m.name for m in metrics), kept, kept.count())


def _covering(rollups: Sequence[Rollup], entity: str, dims: Sequence[str], metrics: Sequence[Expression]) -> Rollup | None:
    """The smallest rollup that has all dimensions and metrics."""
    able = [
        r for r in rollups
        if r.entity == entity and set(dims) <= set(r.dimensions) and {m.name for m in metrics} <= set(r.metrics)
    ]
    return min(able, key=lambda r: r.size, default=None)


def semantic_query(
    model: SemanticModel,
    tables: dict[str, DataFrame],
    metrics: Sequence[str],
    dimensions: Sequence[str] = (),
    where: Column | None = None,
    where_dimensions: Sequence[str] = (),
    rollups: Sequence[Rollup] = (),
) -> DataFrame:
    """One row per combination of the dimensions, one column per metric.

    ``where`` is a condition over dimension names; those not among ``dimensions``
    are listed in ``where_dimensions``. Entities for which a rollup has all that is
    asked are answered from it, without their table.
    """
    dims = [model.resolve(d) for d in dimensions]
    needed = list(dict.fromkeys([*dims, *map(model.resolve, where_dimensions)]))
    chosen = [next(m for m in model.metrics if m.name == model.resolve(name)) for name in metrics]

    parts = []
    for entity in dict.fromkeys(m.entity for m in chosen):
        own = [m for m in chosen if m.entity == entity]
        rollup = _covering(rollups, entity, needed, own)
        abroad = any(d.entity != entity for d in model.dimensions if d.name in needed)
        in_parts = rollup is not None or (abroad and all(m.parts is not None for m in own))
        rows = rollup.rows if rollup is not None else _with_dimensions(model, tables, entity, needed, own if in_parts else None)
        if where is not None:
            rows = rows.filter(where)
        results = [_merged(m) if in_parts else m.build().alias(m.name) for m in own]
        parts.append(rows.groupBy(*dims).agg(*results))
    if len(parts) == 1:
        return parts[0].select(*dims, *[m.name for m in chosen])

    # Line the per-entity results up: each contributes one row per combination.
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.groupBy(*dims).agg(*[F.max(m.name).alias(m.name) for m in chosen])


def _with_dimensions(
    model: SemanticModel, tables: dict[str, DataFrame], entity: str, dims: Sequence[str], metrics: Sequence[Expression] | None = None
) -> DataFrame:
    """Rows of the entity with its facts and the requested dimensions; with ``metrics``
    their parts instead of rows, added up by foreign key and own dimension before
    any parent is joined."""
    wanted = [next(d for d in model.dimensions if d.name == name) for name in dims]
    table = tables[entity]
    facts = {f.name: f.build() for f in model.facts if f.entity == entity}
    own = {d.name: d.build() for d in wanted if d.entity == entity}
    goals = list(dict.fromkeys(d.entity for d in wanted if d.entity != entity))
    rows = table.withColumns(facts) if facts else table
    if metrics is not None:
        ways = dict.fromkeys(model.path(entity, goal)[0].column for goal in goals)
        apart = dict.fromkeys(c for m in metrics for c in m.parts.apart)
        keys = [F.col(c) for c in {**ways, **apart}] + [c.alias(n) for n, c in own.items() if n.lower() not in {w.lower() for w in {**ways, **apart}}]
        rows = rows.groupBy(*keys).agg(*_partials(metrics))
    elif own:
        rows = rows.withColumns(own)

    # Foreign keys met on the way carry the entity's prefix to keep names apart.
    joined: dict[str, dict[str, str]] = {entity: {}}
    for goal in goals:
        for step in model.path(entity, goal):
            if step.parent in joined:
                continue
            child_column = joined[step.child].get(step.column, step.column)
            parent = tables[step.parent]
            key = model.entity(step.parent).key
            onward = {r.column: f"_{step.parent}_{r.column}" for r in model.relationships if r.child == step.parent}
            attributes = parent.select(
                F.col(key).alias(f"_{step.parent}_key"),
                *[F.col(c).alias(a) for c, a in onward.items()],
                *[d.build().alias(d.name) for d in wanted if d.entity == step.parent],
            )
            rows = rows.join(attributes, rows[child_column] == attributes[f"_{step.parent}_key"], "left")
            joined[step.parent] = onward
    return rows
