from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import MAX_ERROR_LENGTH

# The characters Unicode counts as white space.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip_spaces(value: Column) -> Column:
    """Remove all white space at both ends; SQL ``trim`` removes the space character only."""
    return F.btrim(value, F.lit(SPACES))


def clean_symbol(value: Column) -> Column:
    return F.upper(strip_spaces(value))


def first_filled(*values: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(value, F.lit("")) for value in values])


def coin_slug(symbol: Column, name: Column) -> Column:
    """Lower-cased symbol, followed by up to 20 letters, digits or dashes of a differing name."""
    base = F.lower(strip_spaces(symbol))
    letters = F.regexp_replace(F.lower(name), r"[^\p{L}\p{N}-]", "")
    differs = (F.coalesce(name, F.lit("")) != "") & (F.upper(name) != symbol)
    return F.when(differs, F.concat(base, F.lit("-"), F.substring(letters, 1, 20))).otherwise(base)


def truncate_error(message: Column, limit: int = MAX_ERROR_LENGTH) -> Column:
    cut = F.concat(F.substring(message, 1, limit), F.lit("..."))
    return F.when(F.length(message) > limit, cut).otherwise(message)
