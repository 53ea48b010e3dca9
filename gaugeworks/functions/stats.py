"""Aggregates that can be computed in parts and merged.

Every windowed job needs the same few statistics, first per small time slice and then combined, so
each one is described once: how its parts are computed, how parts merge, how the result is read off.
Nulls are skipped; a group of nulls gives null; a row count counts every row.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Stat:
    """One output column."""

    name: str
    kind: str
    column: str | None = None

    def _value(self, where: Column | None) -> Column:
        value = F.col(self.column) if self.column else F.lit(1)
        return value if where is None else F.when(where, value)

    def parts(self, where: Column | None = None) -> list[tuple[str, str, Column]]:
        """(column, how parts merge, aggregate over raw rows)."""
        value = self._value(where)
        if self.kind == "mean":
            return [
                (f"_{self.name}_sum", "sum", F.sum(value)),
                (f"_{self.name}_n", "sum", F.count(value)),
            ]
        if self.kind == "count":
            return [(f"_{self.name}", "sum", F.count(value))]
        return [(f"_{self.name}", self.kind, getattr(F, self.kind)(value))]

    def result(self, part) -> Column:
        """Reads the result off; ``part`` maps a part's column name to a Column."""
        if self.kind == "mean":
            total, n = part(f"_{self.name}_sum"), part(f"_{self.name}_n")
            return F.when(n > 0, total / n).alias(self.name)
        return part(f"_{self.name}").alias(self.name)

    def aggregate(self, where: Column | None = None) -> Column:
        """The statistic over raw rows in one step."""
        if self.kind == "mean":
            return F.avg(self._value(where)).alias(self.name)
        direct = {name: agg for name, _, agg in self.parts(where)}
        return self.result(direct.__getitem__)


def count(name: str) -> Stat:
    return Stat(name, "count")


def minimum(column: str, name: str) -> Stat:
    return Stat(name, "min", column)


def maximum(column: str, name: str) -> Stat:
    return Stat(name, "max", column)


def mean(column: str, name: str) -> Stat:
    return Stat(name, "mean", column)


def raw_parts(stats: Iterable[Stat]) -> list[Column]:
    """Parts over raw rows, named."""
    return [agg.alias(name) for s in stats for name, _, agg in s.parts()]


def part_columns(stats: Iterable[Stat]) -> list[tuple[str, str]]:
    return [(name, how) for s in stats for name, how, _ in s.parts()]


def merged_parts(stats: Iterable[Stat]) -> list[Column]:
    """Parts merged by a second aggregation, under the same names."""
    return [getattr(F, how)(name).alias(name) for name, how in part_columns(stats)]


def results(stats: Iterable[Stat]) -> list[Column]:
    return [s.result(F.col) for s in stats]


def combine(how: str, columns: list[Column]) -> Column:
    """Merges parts that sit in different columns of one row, ignoring nulls."""
    if len(columns) == 1:
        return columns[0]
    if how == "sum":
        total = F.coalesce(columns[0], F.lit(0))
        for c in columns[1:]:
            total = total + F.coalesce(c, F.lit(0))
        return F.when(F.coalesce(*columns).isNotNull(), total)
    return (F.greatest if how == "max" else F.least)(*columns)
