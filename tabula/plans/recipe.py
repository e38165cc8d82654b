"""Recipes as configuration: row filters, sentinels and ordered mutate chains as data, applied as projections.

A chain has the meaning of one assignment after another: a step sees what the steps before it wrote, and a
step that writes a column again is seen by those after it only.  ``levels`` groups the steps so that every
group can be one projection; a chain of n steps takes as many projections as its longest dependency.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabula.functions.scalars import null_if


@dataclass(frozen=True)
class Step:
    """``name`` becomes ``make`` of the columns ``reads``."""

    name: str
    reads: Sequence[str]
    make: Callable[..., Column]


def sentinel(name: str, test: Callable[..., Column], by: str | None = None) -> Step:
    """``name`` is null where ``test`` of the column ``by`` (itself, if not given) holds."""
    if by is None or by == name:
        return Step(name, [name], lambda c: null_if(c, test(c)))
    return Step(name, [name, by], lambda c, other: null_if(c, test(other)))


@dataclass(frozen=True)
class Recipe:
    """``exclude``: column -> value (or values) of rows to leave out, null rows with them (F1); ``steps``: the chain;
    ``drop``: columns that end with it."""

    exclude: Mapping[str, object] = field(default_factory=dict)
    steps: Sequence[Step] = ()
    drop: Sequence[str] = ()

    def __add__(self, other: Recipe) -> Recipe:
        return Recipe({**self.exclude, **other.exclude}, [*self.steps, *other.steps], [*self.drop, *other.drop])


def levels(steps: Sequence[Step]) -> list[list[Step]]:
    """The steps in groups: expressions of a group only need what earlier groups wrote."""
    written: dict[str, int] = {}                  # column -> level of its last writer
    read: dict[str, int] = {}                     # column -> highest level that reads its present value
    out: list[list[Step]] = []
    for step in steps:
        level = max([written.get(c, -1) + 1 for c in step.reads] + [written.get(step.name, -1) + 1, read.get(step.name, 0)])
        for c in step.reads:
            read[c] = max(read.get(c, 0), level)
        written[step.name], read[step.name] = level, level + 1
        while len(out) <= level:
            out.append([])
        out[level].append(step)
    return out


def keep_rows(df: DataFrame, exclude: Mapping[str, object]) -> DataFrame:
    for name, values in exclude.items():
        values = [values] if isinstance(values, str) or not isinstance(values, Sequence) else list(values)
        df = df.where(~F.col(name).isin(values))
    return df


def apply(df: DataFrame, recipe: Recipe) -> DataFrame:
    """Filters, then one projection a level, then the dropped columns."""
    df = keep_rows(df, recipe.exclude)
    for group in levels(recipe.steps):
        df = df.withColumns({s.name: s.make(*(F.col(c) for c in s.reads)) for s in group})
    return df.drop(*recipe.drop)
