"""Evaluate an expression once.

Catalyst puts a column's definition wherever the column is used: into the body
of a lambda, where it runs once per element, or into a filter that is pushed
below the projection.  These two helpers keep costly text expressions from
being repeated that way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` worked out once."""
    return F.transform(F.array(value), body)[0]


def add_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns through a generator, which filters are not pushed through."""
    made = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*df.columns, F.inline(F.array(made)))
