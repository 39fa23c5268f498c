"""Numeric conventions: guarded ratios, missing values, exact variance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def share(part: Column, whole: Column, scale: int = 100) -> Column:
    """``scale * part / whole`` as a double, 0 where the whole is 0 or missing."""
    part, whole = part.cast("double"), whole.cast("double")
    return F.coalesce(F.try_divide(F.lit(float(scale)) * part, whole), F.lit(0.0))


def missing_as(value: Column, missing: str) -> Column:
    """How a missing metric enters a mean: ``zero`` counts it, ``skip`` drops it."""
    if missing == "zero":
        return F.coalesce(value, F.lit(0).cast("double"))
    if missing == "skip":
        return value
    raise ValueError(f"missing must be 'zero' or 'skip', not {missing!r}")


def population_variance(n: Column, total: Column, squares: Column) -> Column:
    """Population variance from integer sums, so it does not depend on row order.

    ``total`` and ``squares`` are exact decimals; the only rounding is in the
    last division. Fewer than two values give 0.
    """
    top = n.cast("decimal(12,0)") * squares - total * total
    size = n.cast("double")
    return F.when(n < 2, F.lit(0.0)).otherwise(top.cast("double") / (size * size))
