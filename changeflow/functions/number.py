"""Whole-number arithmetic that never goes through a double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_quotient(value: Column, divisor: int | Column) -> Column:
    """The integer quotient, cut towards zero."""
    divisor = divisor if isinstance(divisor, Column) else F.lit(divisor)
    return F.call_function("div", value, divisor)
