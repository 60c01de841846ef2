"""Decimal and integer text, and the money types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(15, 2)  # at rest
TOTAL = T.DecimalType(18, 2)  # in reports
WIDE_TOTAL = T.DecimalType(38, 2)  # while it is not known whether a total fits its report
RATE = T.DecimalType(6, 4)
# In flight: every amount that fits MONEY, with 18 decimals; times a RATE the product is
# decimal(38,22), which is exact.
WIDE = T.DecimalType(31, 18)

# Fixed value: decimal text grammar (sign, digits with an optional point, exponent).
DECIMAL_TEXT = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\z"
INTEGER_TEXT = r"^[+-]?[0-9]+\z"
NONZERO_MANTISSA = r"^[^eE]*[1-9]"


def wide_decimal(text: Column) -> Column:
    """The amount as WIDE; null when it is no number or too large to store."""
    return text.try_cast(WIDE)


def is_decimal(text: Column, wide: Column) -> Column:
    """True when the text is a number. The regex only runs where the cast gave up."""
    return F.when(wide.isNotNull(), F.lit(True)).otherwise(text.rlike(DECIMAL_TEXT))


def sign_of(text: Column, wide: Column) -> Column:
    """-1, 0 or 1 of the unrounded number, also where it is too large or too small for WIDE."""
    by_text = F.when(~text.rlike(NONZERO_MANTISSA), 0).when(text.startswith("-"), -1).otherwise(1)
    return F.when(wide > 0, 1).when(wide < 0, -1).otherwise(by_text)


def money(text: Column) -> Column:
    """The stored amount: one HALF_UP rounding straight from the text; null on overflow."""
    return text.try_cast(MONEY)


def strict_int(text: Column) -> Column:
    """A 32-bit integer with an optional sign and nothing else, else null."""
    return F.when(text.rlike(INTEGER_TEXT), text.try_cast("int"))


def money_round(value: Column) -> Column:
    """HALF_UP to two decimals, as MONEY; null on overflow."""
    return F.round(value, 2).try_cast(MONEY)
