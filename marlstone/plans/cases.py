"""Messages with one fault or oddity each, and what must become of them: (changes to a sound message, status, codes).

A change is the JSON text of a field's value; None leaves the field out. Codes are sorted, by bytes, and joined by ";".
"""

from __future__ import annotations

SOUND = {
    "trades": {"T": '"t"', "S": '"AAPL"', "i": "1", "x": '"V"', "p": "10.5", "s": "3", "t": '"2025-09-19T19:41:06.268341055Z"', "c": '["@"]', "z": '"C"'},
    "quotes": {"T": '"q"', "S": '"AAPL"', "bx": '"V"', "bp": "10.5", "bs": "3", "ax": '"W"', "ap": "10.75", "as": "4", "t": '"2025-09-19T19:41:06Z"', "c": '["R"]', "z": '"C"'},
    "crypto": {
        "type": '"match"', "trade_id": "7", "sequence": "0", "product_id": '"BTC-USD"', "price": '"1.5"', "size": '"0.5"', "side": '"buy"', "time": '"2025-09-19T19:41:06.268341Z"',
        "maker_order_id": '"m"', "taker_order_id": '"t"', "ingest_timestamp": "5.5",
    },
    "news": {
        "title": '"A"', "url": '"https://x.example/a"', "time_published": '"20260315T184157"', "summary": '"B"', "source": '"C"', "category_within_source": '"n/a"',
        "overall_sentiment_score": "0.25", "overall_sentiment_label": '"Bullish"', "topics": '[{"topic":"Earnings","relevance_score":"0.75"}]',
    },
}

_OPTIONAL_NUMBERS = [({"ingest_timestamp": '"x"'}, "ingest_timestamp"), ({"ingest_timestamp": "5"}, ""), ({"ingest_timestamp": '"5.5"'}, ""), ({"ingest_timestamp": "null"}, ""), ({"freshness_seconds": "[]"}, "freshness_seconds"), ({"freshness_seconds": "true"}, "")]
_EQUITY = [
    ({}, ""), ({"T": '"x"'}, "T"), ({"T": None}, "T"), ({"T": "null"}, "T"), ({"S": '""'}, "S"), ({"S": '".."'}, "S"), ({"S": '"brk.b"'}, ""), ({"S": "5"}, "S"), ({"S": '"É"'}, ""), ({"S": '"A1"'}, "S"),
    ({"t": '"soon"'}, "t"), ({"t": "5"}, "t"), ({"t": None}, "t"), ({"t": '"2025-09-19T19:41:06+02:00"'}, ""), ({"t": '"2025-09-19T19:41:06.123456789Z"'}, ""), ({"t": '"2025-13-19T19:41:06Z"'}, "t"),
    ({"c": "null"}, ""), ({"c": None}, ""), ({"c": '"x"'}, "c"), ({"c": '["a",1]'}, "c"), ({"c": "[]"}, ""), ({"c": "[null]"}, "c"), ({"z": "5"}, "z"), ({"z": "null"}, ""), ({"z": None}, ""), ({"more": "[1]"}, ""),
    *_OPTIONAL_NUMBERS,
]
_FAULTS = {
    "trades": [
        *_EQUITY, ({"i": "-1"}, "i"), ({"i": "0"}, ""), ({"i": '"12"'}, ""), ({"i": "12.0"}, ""), ({"i": "12.5"}, "i"), ({"i": "true"}, ""), ({"i": "null"}, "i"), ({"i": None}, "i"), ({"i": '"1_000"'}, ""), ({"i": '"a"'}, "i"),
        ({"x": "5"}, "x"), ({"x": None}, "x"), ({"x": '""'}, ""), ({"p": "0"}, "p"), ({"p": '"1.5"'}, ""), ({"p": "-1"}, "p"), ({"p": '"nan"'}, "p"), ({"p": "null"}, "p"), ({"p": "true"}, ""), ({"p": '"inf"'}, ""),
        ({"s": "0"}, "s"), ({"s": '"7"'}, ""), ({"s": "7.5"}, "s"), ({"p": "0", "s": "0", "S": '""'}, "S p s"),
    ],
    "quotes": [
        *_EQUITY, ({"bx": "5"}, "bx"), ({"bx": None}, "bx"), ({"ax": "null"}, "ax"), ({"ax": '""'}, ""), ({"bp": "0"}, ""), ({"bp": "-0.5"}, "bp"), ({"ap": '"x"'}, "ap"), ({"ap": "0"}, ""), ({"bs": "-1"}, "bs"), ({"bs": "0"}, ""),
        ({"as": None}, "as"), ({"as": None, "as_": "5"}, ""), ({"as": "1.5"}, "as"), ({"spread": '"x"'}, "spread"), ({"spread": "-1"}, ""), ({"bp": '"nan"', "as": "-2"}, "as bp"),
    ],
    "crypto": [
        ({}, ""), ({"type": '"last_match"'}, ""), ({"trade_id": "0"}, "trade_id"), ({"trade_id": '"9"'}, ""), ({"trade_id": None}, "trade_id"), ({"sequence": "-1"}, "sequence"), ({"sequence": "1.5"}, "sequence"), ({"sequence": "null"}, "sequence"),
        ({"product_id": '"1INCH-USD"'}, "product_id"), ({"product_id": '"btc-usd"'}, "product_id"), ({"price": "1.5"}, "price"), ({"price": '"0"'}, "price"), ({"price": '"nan"'}, ""), ({"size": '"x"'}, "size"), ({"size": '"1e-8"'}, ""), ({"size": '"-1"'}, "size"),
        ({"side": '"hold"'}, "side"), ({"side": None}, "side"), ({"time": '"T19:41"'}, "time"), ({"time": '"2025-09-19"'}, ""), ({"maker_order_id": "5"}, "maker_order_id"), ({"maker_order_id": "null"}, ""), ({"taker_order_id": "[]"}, "taker_order_id"), ({"taker_order_id": None}, ""),
        *_OPTIONAL_NUMBERS, ({"price": "1", "side": '"x"'}, "price side"),
    ],
    "news": [
        ({}, ""), ({"title": '""'}, "title"), ({"title": "5"}, "title"), ({"url": '"ftp://x"'}, "url"), ({"url": None}, "url"), ({"time_published": '"2026-03-15"'}, "time_published"), ({"time_published": '"20261315T184157"'}, "time_published"), ({"summary": '""'}, "summary"),
        ({"summary": None}, "summary"), ({"source": "null"}, "source"), ({"category_within_source": "5"}, "category_within_source"), ({"category_within_source": None}, ""), ({"overall_sentiment_score": '"x"'}, "overall_sentiment_score"),
        ({"overall_sentiment_score": '"0.5"'}, ""), ({"overall_sentiment_score": "null"}, ""), ({"overall_sentiment_label": '"Somewhat-Bullish"'}, "overall_sentiment_label"), ({"overall_sentiment_label": '"Somewhat_Bullish"'}, ""), ({"overall_sentiment_label": None}, ""),
        ({"topics": "5"}, ""), ({"title": '""', "summary": '""'}, "summary title"),
    ],
}
#: By stream: (message, status, codes) as the contracts see it.
CONTRACTS: dict[str, list[tuple[str, str, str]]] = {}
#: By stream: (message, codes, values) as the pipelines see it; the values are those of shown() in plans/queries.py.
NORMALISED: dict[str, list[tuple[str, str, str]]] = {}


def message(stream: str, changes: dict[str, str | None]) -> str:
    return "{" + ",".join(f'"{k}":{v}' for k, v in (SOUND[stream] | changes).items() if v is not None) + "}"


for _s, _cases in _FAULTS.items():
    CONTRACTS[_s] = [(message(_s, c), "invalid" if f else "valid", ";".join(f"contract:{x}" for x in f.split())) for c, f in _cases]
    CONTRACTS[_s] += [("5", "invalid", "contract:object"), ("[1,2", "invalid", "parse:json")]
CONTRACTS["crypto"].append((message("crypto", {"type": '"heartbeat"', "price": "0"}), "ignored", ""))

_EQUITY_VALUES = [
    ({"ingest_timestamp": "0"}, "", "-|1"), ({"ingest_timestamp": '""'}, "", "-|1"), ({"ingest_timestamp": "null"}, "", "-|1"), ({"ingest_timestamp": "false"}, "", "-|1"), ({"ingest_timestamp": '"5.5"'}, "", "5.5|1"), ({"ingest_timestamp": '"0"'}, "", "0.0|1"),
    ({"ingest_timestamp": '"x"'}, "cast:ingest_timestamp:double", ""), ({"c": None}, "", "-|0"), ({"c": "null"}, "", "-|0"), ({"c": "[]"}, "", "-|0"), ({"c": '["a","b"]'}, "", "-|2"), ({"t": None}, "missing:t", ""), ({"t": "null"}, "cast:t:timestamp", ""),
]
_VALUES = {
    "trades": [*_EQUITY_VALUES, ({"x": None}, "missing:x", ""), ({"x": "null"}, "null:exchange", ""), ({"p": None, "s": '"1.5"'}, "cast:s:long;missing:p", ""), ({"s": "10.7"}, "", "-|1"), ({"i": '"x"'}, "cast:i:long", ""), ({"z": "null"}, "", "-|1")],
    "quotes": [*_EQUITY_VALUES, ({"ax": "null"}, "null:ask_exchange", ""), ({"bx": None}, "missing:bx", ""), ({"bp": '"x"'}, "cast:bp:double", ""), ({"as": None}, "missing:as", ""), ({"bs": "null"}, "cast:bs:long", "")],
    "crypto": [({}, "", "5.5|buy"), ({"ingest_timestamp": None}, "missing:ingest_timestamp", ""), ({"ingest_timestamp": "null"}, "cast:ingest_timestamp:double", ""), ({"side": "null"}, "null:side", ""), ({"time": '"x"'}, "cast:time:timestamp", ""), ({"maker_order_id": None}, "", "5.5|buy"), ({"price": '"x"'}, "cast:price:double", "")],
    "news": [
        ({}, "", "Earnings=0.75|0.25"), ({"topics": None}, "", "|0.25"), ({"topics": "null"}, "", "|0.25"), ({"topics": "[]"}, "", "|0.25"), ({"topics": "[{}]"}, "", "=0.0|0.25"), ({"topics": '[{"topic":"a"},{"relevance_score":1}]'}, "", "a=0.0,=1.0|0.25"),
        ({"topics": '[{"topic":"a","relevance_score":null}]'}, "cast:topics:double", ""), ({"topics": '[{"relevance_score":"x"}]'}, "cast:topics:double", ""), ({"topics": '["a"]'}, "cast:topics:object", ""), ({"overall_sentiment_score": "null"}, "", "Earnings=0.75|-"),
        ({"overall_sentiment_score": '"x"'}, "cast:overall_sentiment_score:double", ""), ({"overall_sentiment_score": None, "title": None}, "", "Earnings=0.75|-"), ({"time_published": None}, "missing:time_published", ""), ({"time_published": '"x"'}, "cast:time_published:timestamp", ""),
    ],
}
for _s, _given in _VALUES.items():
    NORMALISED[_s] = [(message(_s, c), codes, shown) for c, codes, shown in _given] + [("5", "type:object", ""), ("[1,2", "parse:json", "")]
