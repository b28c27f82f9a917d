"""Naming an intermediate value inside one column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row.

    A rule that uses a derived value several times would otherwise repeat the
    whole derivation in the expression tree at each use.
    """
    return F.get(F.transform(F.array(value), body), 0)
