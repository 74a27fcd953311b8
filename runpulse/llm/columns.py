"""Columns that an operator passes on, kept apart from the names it uses itself."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F


def column(name: str) -> Column:
    """The column of that name, whatever characters it has."""
    return F.col(f"`{name.replace('`', '``')}`")


def passing_on(docs: DataFrame, used: list[str], made: list[str], run: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`run` on `docs` whose columns other than `used` have names that nothing inside can clash with; they get theirs back.

    Columns named like those that are `made` are left out. Names are compared without case, as Spark does.
    """
    low = lambda names: {n.lower() for n in names}
    kept = [c for c in docs.columns if c.lower() in low(used) or c.lower() not in low(made)]
    hidden = [c if c.lower() in low(used) else f"other column {i}" for i, c in enumerate(kept)]
    out = run(docs.select(*[column(c) for c in kept]).toDF(*hidden))
    own = {h: c for h, c in zip(hidden, kept)}
    return out.toDF(*[own.get(c, c) for c in out.columns])


def unused(docs: DataFrame, name: str) -> str:
    """`name`, with as many underscores behind as it takes to be none of the columns'."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name
