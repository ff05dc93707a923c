"""Source registry: the plug-in surface for new feeds."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators import incremental, normalize
from .csv_feed import read_csv_feed
from .json_feeds import read_markets_json, read_tickers_json


@dataclass(frozen=True)
class FeedSpec:
    """How one source is read, filtered, normalized and checked.

    ``read(spark, path)`` returns raw rows with an orderable ``arrival`` column. With ``reads_files`` it
    takes a list of files as well, and the job hands it those it has not loaded yet. ``newer(raw,
    checkpoint)`` drops rows already seen; ``normalize(raw, source, run_ts)`` returns the columns of
    ``operators.normalize.NORMALIZED``. ``expected_columns`` feeds the drift check; ``columnar`` says
    whether it looks at the columns of the raw rows or at the keys of their JSON ``payload``.
    """

    read: Callable[[SparkSession, str], DataFrame]
    normalize: Callable[..., DataFrame]
    newer: Callable[..., DataFrame]
    expected_columns: tuple[str, ...]
    columnar: bool
    reads_files: bool = False


_REGISTRY: dict[str, FeedSpec] = {}


def register_source(name: str, spec: FeedSpec) -> None:
    """The name labels the rows and, in the run tables, their folders."""
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", name):
        raise ValueError(f"source name must be letters, digits, '_', '.' or '-': {name!r}")
    _REGISTRY[name] = spec


def remove_source(name: str) -> None:
    """Forget a registered source."""
    _REGISTRY.pop(name, None)


def get_source(name: str) -> FeedSpec:
    try:
        return _REGISTRY[name]
    except KeyError:
        raise ValueError(f"No extractor registered for source: {name}") from None


def registered_names() -> list[str]:
    return list(_REGISTRY)


def list_sources(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(name,) for name in _REGISTRY], "source string")


# Expected feed columns per source.
register_source(
    "coinpaprika",
    FeedSpec(
        read_tickers_json,
        normalize.normalize_tickers,
        incremental.newer_json,
        ("id", "symbol", "name", "quotes"),
        columnar=False,
        reads_files=True,
    ),
)
register_source(
    "coingecko",
    FeedSpec(
        read_markets_json,
        normalize.normalize_markets,
        incremental.newer_json,
        ("id", "symbol", "name", "current_price"),
        columnar=False,
        reads_files=True,
    ),
)
register_source(
    "csv",
    FeedSpec(
        read_csv_feed,
        normalize.normalize_csv,
        incremental.newer_csv,
        ("ticker", "price", "vol", "date"),
        columnar=True,
        reads_files=True,
    ),
)
