"""Evaluate an expression once and use it several times inside a lambda."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed a single time per row.

    A column used inside a higher-order function is otherwise inlined into the
    lambda and computed again for every array element.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))
