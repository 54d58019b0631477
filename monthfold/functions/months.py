"""Month labels, numbers and quarters as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The month labels of the input format, in calendar order.
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def month_label(measure: str, pattern: str) -> str:
    """The month a measure column stands for: what the pattern captures, else the name sans suffix."""
    found = re.match(pattern, measure)
    if found and found.groups():
        return found.group(1)
    return measure.removesuffix("_sales")


def month_number(month: Column, unknown: str = "zero") -> Column:
    """Calendar number of a month label; other labels give 0 (``zero``) or NULL (``null``)."""
    if unknown not in ("zero", "null"):
        raise ValueError("unknown is 'zero' or 'null'")
    position = F.array_position(F.lit(list(MONTHS)), month).cast("int")
    return F.coalesce(position, F.lit(0)) if unknown == "zero" else F.nullif(position, F.lit(0))


def quarter_of(number: Column) -> Column:
    """Quarter of a month number; 0 stays 0 and NULL stays NULL."""
    return F.ceil(number / F.lit(3)).cast("int")
