"""Feed readers, the source registry and the table store."""

from .csv_feed import FeedError, read_csv_feed
from .json_feeds import read_markets_json, read_tickers_json
from .registry import FeedSpec, get_source, list_sources, register_source, registered_names, remove_source
from .store import Store

__all__ = [
    "FeedError",
    "FeedSpec",
    "Store",
    "get_source",
    "list_sources",
    "read_csv_feed",
    "read_markets_json",
    "read_tickers_json",
    "register_source",
    "registered_names",
    "remove_source",
]
