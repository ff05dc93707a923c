"""Name similarity by matching blocks (``difflib``), for column names and alias tokens.

Its functions travel to the executors by value: their Python need not have the package.
"""

from __future__ import annotations

import difflib
import sys
from collections.abc import Iterable, Mapping

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def best_match(name: str, candidates: Iterable[str], cutoff: float = 0.8) -> tuple[float, str, float] | None:
    """Rank, candidate and ratio of the closest one. Of several sets, the match of highest rank, then of the
    largest name, is the closest of all."""
    found = difflib.get_close_matches(name, sorted(candidates), n=1, cutoff=cutoff)
    if not found:
        return None
    # The ratio depends on the order of the two; matches are ranked by the other one.
    rank = difflib.SequenceMatcher(None, found[0], name).ratio()
    return rank, found[0], difflib.SequenceMatcher(None, name, found[0]).ratio()


def closest_name(name: str, candidates: Iterable[str], cutoff: float = 0.8) -> tuple[str, float] | None:
    """Closest candidate and its ratio, for schema metadata on the driver."""
    found = best_match(name, candidates, cutoff)
    return found[1:] if found else None


def feasible_lengths(names: Iterable[str], cutoff: float) -> list[int]:
    """Token lengths that can reach the cutoff: the ratio is at most 2*min(a, b)/(a + b)."""
    lengths = {len(name) for name in names}
    longest = int(max(lengths) * 2 / cutoff) + 1
    return [n for n in range(1, longest) if any(2 * min(n, m) >= cutoff * (n + m) for m in lengths)]


def fuzzy_alias_udf(aliases: Mapping[str, str], cutoff: float):
    """Arrow UDF from a token to the symbol of its closest alias, else null.

    Marked nondeterministic so that a filter on its result is not pushed below the ``distinct`` that
    keeps it off the fact rows.
    """
    names = list(aliases)
    symbols = dict(aliases)

    @F.pandas_udf("string")
    def closest(tokens: pd.Series) -> pd.Series:
        def lookup(token):
            found = difflib.get_close_matches(token, names, n=1, cutoff=cutoff)
            return symbols[found[0]] if found else None

        return tokens.map(lookup)

    return closest.asNondeterministic()
