"""Derived metrics of events."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marlstone.functions.cast import epoch_seconds

#: Fixed value: trades above this are large.
LARGE_TRADE = 10_000.0
#: Fixed value: seconds within which a story's repeats are suppressed.
NEWS_HORIZON_SECONDS = 43_200


def trade_value(price: Column, size: Column) -> Column:
    return F.round(price * size, 8)


def is_large_trade(value: Column) -> Column:
    return (value > LARGE_TRADE) & ~F.isnan(value)


def latency_ms(ingest: Column, ts: Column, optional: bool = True) -> Column:
    """Milliseconds from the exchange to ingestion; 0 where an optional ingest time is missing or 0."""
    lag = F.round((ingest - epoch_seconds(ts)) * 1000, 3)
    return F.when(ingest.isNull() | (ingest == 0), 0.0).otherwise(lag) if optional else lag


def spread(ask: Column, bid: Column) -> Column:
    """Ask less bid; none for one-sided quotes, negative for crossed ones."""
    return F.when((ask > 0) & (bid > 0), F.round(ask - bid, 6))


def freshness_seconds(ingest: Column, ts: Column) -> Column:
    return F.coalesce(ingest - epoch_seconds(ts), F.lit(0.0))


def now_seconds() -> Column:
    return F.unix_micros(F.current_timestamp()) / 1e6


def dedup_key(url: Column, title: Column) -> Column:
    return F.sha2(F.concat(F.coalesce(url, F.lit("")), F.lit("|"), F.coalesce(title, F.lit(""))), 256)
