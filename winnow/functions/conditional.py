"""Conditional columns: bins, bounds, thresholds, tiers and constant lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from winnow.functions.nulls import flag
from winnow.functions.rounding import rounded_long


def at_most(value: Column, bound: float) -> Column:
    """Threshold flag; a missing value does not pass."""
    return flag(value <= bound)


def right_closed_bins(
    value: Column,
    edges: Sequence[float],
    labels: Sequence[str],
    outside: str | None = None,
) -> Column:
    """Label of the interval ``(edges[i], edges[i+1]]`` that holds the value.

    The last edge may be infinite. A value in no interval, or a missing one, gets
    ``outside`` (NULL by default; pass ``'nan'`` for text output compatible with
    tools that print a missing category that way).
    """
    if len(labels) != len(edges) - 1:
        raise ValueError("one label per interval is needed")
    column = F.when(value <= edges[0], F.lit(outside))
    for upper, label in zip(edges[1:], labels):
        column = column.when(value <= upper, F.lit(label))
    return column.otherwise(F.lit(outside))


def clip(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """Limit to closed bounds; a missing value stays missing."""
    bounded = value
    if high is not None:
        bounded = F.least(bounded, F.lit(high))
    if low is not None:
        bounded = F.greatest(bounded, F.lit(low))
    return F.when(value.isNotNull(), bounded)


def first_match(branches: Sequence[tuple[Column, object]], default: object) -> Column:
    """Value of the first true condition, else ``default``."""
    column = None
    for condition, value in branches:
        column = F.when(condition, value) if column is None else column.when(condition, value)
    return F.lit(default) if column is None else column.otherwise(default)


def scaled_price(base: Column, *factors: Column) -> Column:
    """Base price times every factor, rounded to a whole amount."""
    price = base
    for factor in factors:
        price = price * factor
    return rounded_long(price)


def constant_lookup(key: Column, table: Mapping[object, object]) -> Column:
    """Value for ``key`` in a short constant table; NULL when the key is absent."""
    pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])
    return F.try_element_at(pairs, key)
