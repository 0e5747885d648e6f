"""Text expressions and the symbol list."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

PREVIEW_CHARS = 200


def trade_key() -> Column:
    return F.concat_ws(":", F.col("symbol"), F.col("trade_id").cast("string"))


def preview(column: str) -> Column:
    return F.substring(column, 1, PREVIEW_CHARS)


def symbol_list(symbols: str | Iterable[str]) -> list[str]:
    """Upper-cased, trimmed symbols without blanks; an empty list is an error."""
    parts = symbols.split(",") if isinstance(symbols, str) else symbols
    cleaned = [part.strip().upper() for part in parts if part.strip()]
    if not cleaned:
        raise ValueError("at least one symbol is needed")
    return cleaned


def wanted_symbols(
    symbols: str | Iterable[str], column: str = "symbol", stored: Callable[[str], str] = str.upper
) -> Column:
    """Membership in the normalised list. The list is brought to the case the column is ``stored`` in, and
    the bare column compared, so the filter reaches the partition folders or the Parquet statistics."""
    return F.col(column).isin([stored(symbol) for symbol in symbol_list(symbols)])
