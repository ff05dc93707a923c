from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import strip_spaces

# Python's float grammar. Plain numbers with ASCII spaces around them go straight to the cast (which
# alone would also read "5d"); underscores, other white space, infinity and NaN take the second way.
PLAIN_NUMBER = r"^[ \t\n\x0B\f\r]*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?[ \t\n\x0B\f\r]*$"
_DIGITS = r"[0-9]+(?:_[0-9]+)*"
OTHER_NUMBER = (
    rf"^(?i)[+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?(?:e[+-]?{_DIGITS})?|\.{_DIGITS}(?:e[+-]?{_DIGITS})?"
    r"|inf(?:inity)?|nan)$"
)


def coerce_number(value: Column) -> Column:
    """Text to double; null for null, empty, "N/A" and anything that is not a number."""
    text = strip_spaces(value)
    other = F.when(F.lower(text).endswith("nan"), F.lit(float("nan"))).otherwise(
        F.replace(text, F.lit("_"), F.lit("")).try_cast("double")
    )
    return F.when(value.rlike(PLAIN_NUMBER), value.try_cast("double")).when(text.rlike(OTHER_NUMBER), other)


def to_decimal(number: Column, kind: T.DecimalType) -> Column:
    """Double to decimal, rounded half up; null where the value does not fit."""
    return number.try_cast(kind)


def fits_decimal(number: Column, kind: T.DecimalType) -> Column:
    """True for null, NaN-free numbers within the decimal's range."""
    return number.isNull() | to_decimal(number, kind).isNotNull()
