"""Ordered CASE ladders: the first true rung wins, NULL falls to the last label."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Ladder:
    """A classification given as data: (SQL condition, label) rungs and a default label."""

    rungs: tuple[tuple[str, str], ...]
    default: str

    def column(self) -> Column:
        """The ladder as one CASE expression over the columns its conditions name."""
        result: Column | None = None
        for condition, label in self.rungs:
            rung = F.expr(condition)
            result = F.when(rung, label) if result is None else result.when(rung, label)
        return F.lit(self.default) if result is None else result.otherwise(self.default)

    @property
    def labels(self) -> tuple[str, ...]:
        return tuple(label for _, label in self.rungs) + (self.default,)


def ladder(rungs: Iterable[tuple[str, str]], default: str) -> Ladder:
    return Ladder(tuple(rungs), default)


def _bounded(operand: str, operator: str, bounds: Iterable[tuple[object, str]], default: str) -> Ladder:
    return ladder(((f"{operand} {operator} {bound}", label) for bound, label in bounds), default)


def below(operand: str, *bounds: tuple[object, str], default: str) -> Ladder:
    """Rungs ``operand < bound``."""
    return _bounded(operand, "<", bounds, default)


def at_most(operand: str, *bounds: tuple[object, str], default: str) -> Ladder:
    """Rungs ``operand <= bound``."""
    return _bounded(operand, "<=", bounds, default)


def above(operand: str, *bounds: tuple[object, str], default: str) -> Ladder:
    """Rungs ``operand > bound``."""
    return _bounded(operand, ">", bounds, default)


def one_of(operand: str, *groups: tuple[tuple[object, ...], str], default: str) -> Ladder:
    """Rungs ``operand IN (...)``."""
    return ladder(
        ((f"{operand} IN ({', '.join(map(str, values))})", label) for values, label in groups),
        default,
    )


def reaching(first: str, second: str, *tiers: tuple[object, object, str], default: str) -> Ladder:
    """Rungs that ask two measures to reach a floor each: ``first >= a AND second >= b``."""
    return ladder(
        ((f"{first} >= {a} AND {second} >= {b}", label) for a, b, label in tiers), default
    )
