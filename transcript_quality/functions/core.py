"""Small helpers shared by the expression modules."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body`` as a lambda variable.

    Column expressions referenced inside a higher-order lambda are evaluated again for every
    element; binding them first keeps per-row work linear.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def sum_of(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0).cast("double"), lambda a, v: a + v)


def sum_sq_of(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0).cast("double"), lambda a, v: a + v * v)
