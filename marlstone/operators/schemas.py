"""Schemas of the output tables; a field that is not nullable is required at the sink."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _D, _B, _TS = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.TimestampType()
_TAGS = T.ArrayType(T.StringType())


def _table(required: str, fields: list[tuple[str, T.DataType]]) -> T.StructType:
    must = set(required.split())
    return T.StructType([T.StructField(n, t, n not in must) for n, t in fields])


TRADES = _table(
    "msg_type symbol exchange trade_id size price exchange_ts trade_value is_large_trade latency_ms pipeline_ingest_time",
    [("msg_type", _S), ("symbol", _S), ("trade_id", _L), ("exchange", _S), ("price", _D), ("size", _L), ("conditions", _TAGS), ("tape", _S), ("exchange_ts", _TS), ("ingest_timestamp", _D), ("freshness_seconds", _D), ("trade_value", _D), ("is_large_trade", _B), ("latency_ms", _D), ("pipeline_ingest_time", _TS)],
)
QUOTES = _table(
    "msg_type symbol bid_exchange ask_exchange bid_price ask_price bid_size ask_size exchange_ts pipeline_ingest_time",
    [("msg_type", _S), ("symbol", _S), ("bid_exchange", _S), ("bid_price", _D), ("bid_size", _L), ("ask_exchange", _S), ("ask_price", _D), ("ask_size", _L), ("conditions", _TAGS), ("tape", _S), ("exchange_ts", _TS), ("ingest_timestamp", _D), ("freshness_seconds", _D), ("spread", _D), ("pipeline_ingest_time", _TS)],
)
CRYPTO = _table(
    "type trade_id sequence product_id price size side ingest_timestamp trade_value is_large_trade latency_ms pipeline_ingest_time",
    [("type", _S), ("trade_id", _L), ("sequence", _L), ("product_id", _S), ("price", _D), ("size", _D), ("side", _S), ("time", _TS), ("maker_order_id", _S), ("taker_order_id", _S), ("ingest_timestamp", _D), ("freshness_seconds", _D), ("trade_value", _D), ("is_large_trade", _B), ("latency_ms", _D), ("pipeline_ingest_time", _TS)],
)
TOPICS = T.ArrayType(T.StructType([T.StructField("topic", _S), T.StructField("relevance_score", _D)]))
NEWS = _table(
    "",
    [("title", _S), ("url", _S), ("time_published", _TS), ("summary", _S), ("source", _S), ("category_within_source", _S), ("topics", TOPICS), ("overall_sentiment_score", _D), ("overall_sentiment_label", _S)],
)
DLQ = T.StructType([T.StructField("stage", _S), T.StructField("error", _S), T.StructField("codes", _TAGS), T.StructField("raw", _S)])
#: One row for each message received.
STATUS = T.StructType([T.StructField("stream", _S), T.StructField("arrival_seq", _L), T.StructField("arrival_ts", _TS), T.StructField("status", _S), T.StructField("freshness_seconds", _D), T.StructField("spread", _D), T.StructField("detection_ms", _D)])

TABLES = {"trades": TRADES, "quotes": QUOTES, "crypto": CRYPTO, "news": NEWS}

#: The feed's own names of the equity columns, for sinks that want them (with spark.sql.caseSensitive).
FEED_NAMES = {
    "trades": {"msg_type": "T", "symbol": "S", "trade_id": "i", "exchange": "x", "price": "p", "size": "s", "conditions": "c", "tape": "z", "exchange_ts": "t"},
    "quotes": {"msg_type": "T", "symbol": "S", "bid_exchange": "bx", "bid_price": "bp", "bid_size": "bs", "ask_exchange": "ax", "ask_price": "ap", "ask_size": "as", "conditions": "c", "tape": "z", "exchange_ts": "t"},
    "crypto": {},
    "news": {},
}
