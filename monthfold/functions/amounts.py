"""Numeric parsing that never raises, and averages that agree across engines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT_TYPE = "decimal(18,2)"


def to_amount(value: Column) -> Column:
    """Amount as decimal(18,2); text that is not a number, NaN and overflow give NULL."""
    return value.try_cast(AMOUNT_TYPE)


def exact_average(amount: Column) -> Column:
    """Mean from the exact decimal sum, so that it does not depend on summation order."""
    return F.sum(amount).cast("double") / F.count(amount)
