"""JSON feed readers: arrays of objects, one array (API page) per file or per line.

Every row keeps its element in ``payload``, as the JSON parser writes it again: keys and values are the
feed's, white space and the spelling of numbers (``1e5``, ``1.50``) need not be. Fields are looked up
later in ``item``, the parsed VARIANT, so unknown and nested extra keys survive and the JSON type of each
field can be checked. Files with one page per line are split between tasks; in the layout ``files`` a file
is read whole, and may hold one array, or one on each line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workspace import list_files
from .csv_feed import FeedError, arrival_column


LAYOUTS = ("files", "lines")


def page_options(pages: str) -> dict[str, str]:
    if pages not in LAYOUTS:
        raise ValueError(f"pages must be one of {LAYOUTS}")
    return {"wholetext": str(pages == "files").lower(), "recursiveFileLookup": "true"}


def _read_pages(spark: SparkSession, path: str | list[str], pages: str) -> DataFrame:
    if isinstance(path, str) and not list_files(spark, path):
        raise FeedError(f"JSON feed not found: {path}")
    return json_items(spark.read.options(**page_options(pages)).format("text").load(path))


def _array(text: Column) -> Column:
    """The elements of a text that is one JSON array and nothing else, else null.

    The parser stops after the first value, so the text is put into an array with a mark behind it:
    whatever follows the text's own array spoils the pair.
    """
    pair = F.from_json(F.concat(F.lit("["), text, F.lit(",null]")), "array<array<string>>")
    whole = F.transform(F.array(pair), lambda p: F.when((F.size(p) == 2) & F.get(p, 1).isNull(), F.get(p, 0)))
    return F.element_at(whole, 1)


def json_items(pages: DataFrame) -> DataFrame:
    """One row per array element of page rows; blank lines are skipped. Also used by the streams.

    A value is one array, or several with one on each line; anything else is an error that names the file.
    """
    lines = F.filter(F.split("value", r"\r\n|\r|\n"), lambda x: F.trim(x) != "")
    by_line = F.element_at(
        F.transform(F.array(F.transform(lines, _array)), lambda x: F.when(~F.exists(x, F.isnull), F.flatten(x))), 1
    )
    wrong_shape = F.raise_error(
        F.concat(F.lit("Unexpected response format, not a JSON array: "), F.col("_metadata.file_path"))
    )
    line = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    # A condition, not a filter: filters may be evaluated after the error.
    blank = F.trim("value") == ""
    checked = F.when(~blank, F.coalesce(_array(F.col("value")), by_line, wrong_shape.cast("array<string>")))
    items = pages.select(
        arrival_column(line, F.col("_metadata.file_block_start")).alias("page"), checked.alias("elements")
    ).select("page", F.posexplode("elements").alias("position", "payload"))
    return items.select(
        "payload",
        F.try_parse_json("payload").alias("item"),
        F.struct("page.*", F.col("position").cast("long").alias("element")).alias("arrival"),
    )


def read_markets_json(spark: SparkSession, path: str | list[str], pages: str = "files") -> DataFrame:
    """Markets feed: flat objects (id, symbol, name, current_price, ...)."""
    return _read_pages(spark, path, pages)


def read_tickers_json(spark: SparkSession, path: str | list[str], pages: str = "files") -> DataFrame:
    """Tickers feed: objects with a nested ``quotes`` map keyed by currency."""
    return _read_pages(spark, path, pages)
