"""Naming a value inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once, however often it is used.

    A value held in a column of its own may be copied into every place that
    uses it when the optimizer merges projections; a lambda argument is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
