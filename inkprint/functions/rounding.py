"""Rounding of the exact binary value, as Python's round() and JavaScript's toFixed() do it.

Spark's round/bround work on the shortest decimal text of a double, so 2.675 becomes 2.68
although the stored value is below 2.675. Here the exact product ``x * 10^digits`` is
formed as a pair (product, error) and the error decides the apparent ties.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = float(2 ** 27 + 1)


def _product_error(x: Column, factor: float, product: Column) -> Column:
    """Exact ``x * factor - product``; ``factor`` is small enough to need no splitting."""
    high = x * _SPLIT - (x * _SPLIT - x)
    low = x - high
    return (high * factor - product) + low * factor


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` mentions it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def round_binary(x: Column, digits: int = 2, ties: str = "even") -> Column:
    """Nearest multiple of 10^-digits; exact ties go to the even one, or ``up``."""
    factor = float(10 ** digits)

    def nearest(v: Column) -> Column:
        product = v * factor
        floor = F.floor(product).cast("double")
        error = _product_error(v, factor, product)
        tie = F.rint(product) if ties == "even" else floor + 1
        return (
            F.when(product - floor != 0.5, F.rint(product))
            .when(error > 0, floor + 1)
            .when(error < 0, floor)
            .otherwise(tie)
        ) / factor

    return let(x.cast("double"), nearest)
