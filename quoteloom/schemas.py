"""Table schemas. Money columns are decimals, times are UTC instants."""

from pyspark.sql import types as T

PRICE = T.DecimalType(20, 8)
AMOUNT = T.DecimalType(30, 2)

# The source labels and run states stored in the tables.
SOURCES = ("coinpaprika", "coingecko", "csv")
SUCCESS, FAILURE, RUNNING = "success", "failure", "running"

# Column of CSV rows: the text of a row that has more filled cells than its header has names, else null.
OVERFLOW = "_overflow"

# Reject reason of a stream's row that is older than its newest by more than the stream allows.
LATE = "late"

MAX_SYMBOL_LENGTH = 20
MAX_ERROR_LENGTH = 990


def _struct(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


COINS = _struct(
    ("coin_id", T.LongType()),
    ("symbol", T.StringType()),
    ("name", T.StringType()),
    ("slug", T.StringType()),
    ("created_at", T.TimestampType()),
    ("updated_at", T.TimestampType()),
)

MAPPINGS = _struct(
    ("coin_id", T.LongType()),
    ("source", T.StringType()),
    ("source_id", T.StringType()),
    ("source_symbol", T.StringType()),
    ("source_name", T.StringType()),
    ("created_at", T.TimestampType()),
)

QUOTES = _struct(
    ("coin_id", T.LongType()),
    ("symbol", T.StringType()),
    ("price_usd", PRICE),
    ("market_cap", AMOUNT),
    ("volume_24h", AMOUNT),
    ("source", T.StringType()),
    ("ingested_at", T.TimestampType()),
    ("timestamp", T.TimestampType()),
    ("event_date", T.DateType()),
)
QUOTE_KEY = ["coin_id", "source", "timestamp"]
QUOTE_UPDATES = ["price_usd", "market_cap", "volume_24h", "ingested_at"]

LEDGER = _struct(
    ("id", T.LongType()),
    ("source", T.StringType()),
    ("status", T.StringType()),
    ("last_processed_timestamp", T.TimestampType()),
    ("records_processed", T.LongType()),
    ("started_at", T.TimestampType()),
    ("completed_at", T.TimestampType()),
    ("error_message", T.StringType()),
    ("stream_id", T.StringType()),
    ("batch_id", T.LongType()),
    ("revision", T.IntegerType()),
)

# Landing files that successful runs have read; a file that changes has another time or length.
LOADED_FILES = _struct(
    ("source", T.StringType()),
    ("path", T.StringType()),
    ("modified", T.TimestampType()),
    ("length", T.LongType()),
)

RAW = _struct(
    ("payload", T.StringType()),
    ("reject_reason", T.StringType()),
    ("created_at", T.TimestampType()),
    ("source", T.StringType()),
    ("job_id", T.LongType()),
)

DRIFT = _struct(
    ("drift_type", T.StringType()),
    ("severity", T.StringType()),
    ("confidence", T.DoubleType()),
    ("message", T.StringType()),
    ("details", T.StringType()),
    ("timestamp", T.TimestampType()),
)

DRIFT_LOG = T.StructType(DRIFT.fields + _struct(("source", T.StringType()), ("job_id", T.LongType())).fields)
