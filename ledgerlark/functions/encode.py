"""Bands, ordinal codes and fixed orders."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F


def encode(col: Column, mapping: dict, default) -> Column:
    """Look a value up in a small fixed mapping; null and unknown values get the default."""
    pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.coalesce(F.try_element_at(pairs, F.coalesce(col, F.lit(""))), F.lit(default))


def band(col: Column, edges: list, labels: list[str], right: bool = True) -> Column:
    """Name the interval a value falls in; null outside the edges and for null.

    `right=True` gives (low, high] intervals, otherwise [low, high). An edge of None is open.
    """
    result = F
    for low, high, label in zip(edges[:-1], edges[1:], labels, strict=True):
        inside = col.isNotNull()
        if low is not None:
            inside = inside & ((col > low) if right else (col >= low))
        if high is not None:
            inside = inside & ((col <= high) if right else (col < high))
        result = result.when(inside, F.lit(label))
    return result


def member(col: Column, values: list) -> Column:
    """Membership in a fixed set where null counts as no member."""
    return F.coalesce(col.isin(*values), F.lit(False))


def place(col: Column, order: list[str]) -> Column:
    """Position of a value in a fixed order, 0 where it is missing."""
    return F.array_position(F.array(*[F.lit(v) for v in order]), col)
