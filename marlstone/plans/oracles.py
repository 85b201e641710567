"""The queries' results as SQL over the plain tables."""

from __future__ import annotations

from marlstone.plans import cases
from marlstone.sources.adapters import MIXED

_EPOCH = "(epoch_us(ts) / 1000000.0)"
_SYMBOL = "regexp_replace(event_type, '[^A-Za-z]', '', 'g')"
_STATUS = """
  SELECT CASE user_id % 3 WHEN 0 THEN 'trades' WHEN 1 THEN 'quotes' ELSE 'crypto' END AS stream, event_id AS arrival_seq, ts AS arrival_ts,
         CASE WHEN event_id % 20 = 0 THEN 'invalid' WHEN event_id % 20 IN (1, 2) THEN 'duplicate' WHEN event_id % 20 = 3 THEN 'ignored' ELSE 'valid' END AS status,
         (event_id % 512) / 256.0 AS freshness_seconds, (event_id % 64) / 128.0 AS spread, (event_id % 50) / 16.0 AS detection_ms, user_id, event_id
  FROM events"""
_RECEIVED = f"received AS (SELECT * FROM ({_STATUS}) WHERE stream = 'crypto' OR status <> 'ignored')"
_HOUR = "epoch_us(date_trunc('hour', arrival_ts))"
_COUNTS = """count(*) AS {p}_received, count(*) FILTER (status = 'valid') AS {p}_valid, count(*) FILTER (status = 'invalid') AS {p}_invalid,
       count(*) FILTER (status = 'duplicate') AS {p}_duplicates, count(*) FILTER (status = 'invalid') AS {p}_dlq"""
_RATES = """round(count(*) FILTER (status = 'valid') / count(*), 6) AS schema_compliance_rate, round(count(*) FILTER (status = 'duplicate') / count(*), 6) AS duplicate_rate,
       round(count(*) FILTER (status = 'invalid') / count(*), 6) AS dlq_rate"""


def _last(value: str, which: str, digits: int, out: str) -> str:
    extra = " AND stream = 'quotes' AND event_id % 4 <> 0" if value == "spread" else ""
    return f"""
WITH s AS ({_STATUS}),
r AS (SELECT *, {_HOUR} AS window_start, row_number() OVER (PARTITION BY stream, date_trunc('hour', arrival_ts) ORDER BY arrival_seq DESC) AS k FROM s WHERE status = '{which}'{extra})
SELECT stream, window_start, round(avg({value}), {digits}) AS {out}, count(*) AS samples FROM r WHERE k <= 1000 GROUP BY ALL"""


_CODES = {
    "trades": ("events", "event_id", """CASE event_id % 11 WHEN 1 THEN 'contract:p' WHEN 2 THEN 'contract:p' WHEN 3 THEN 'contract:p' WHEN 5 THEN 'contract:s' WHEN 6 THEN 'contract:S'
                 WHEN 7 THEN 'contract:t' WHEN 8 THEN 'parse:json' ELSE '' END""", ""),
    "quotes": ("events", "event_id", """concat_ws(';', CASE WHEN round(value, 2) + (event_id % 7 - 3) / 4.0 < 0 THEN 'contract:ap' END, CASE WHEN event_id % 13 = 0 THEN 'contract:as' END)""", ""),
    "crypto": ("events", "event_id", """CASE WHEN event_id % 14 = 0 THEN '' ELSE CASE event_id % 9 WHEN 1 THEN 'contract:price' WHEN 2 THEN 'contract:price' WHEN 3 THEN 'contract:product_id'
                 WHEN 4 THEN 'contract:side' WHEN 5 THEN 'contract:time' ELSE '' END END""", "CASE WHEN event_id % 14 = 0 THEN 'ignored' ELSE NULL END"),
    "news": ("documents", "doc_id", """concat_ws(';', CASE WHEN doc_id % 8 = 5 THEN 'contract:overall_sentiment_label' END, CASE WHEN doc_id % 8 = 4 OR source IS NULL THEN 'contract:source' END,
                 CASE WHEN coalesce(length(text), 0) = 0 THEN 'contract:summary' END, CASE WHEN doc_id % 8 = 3 THEN 'contract:time_published' END,
                 CASE WHEN doc_id % 8 = 1 THEN 'contract:title' END, CASE WHEN doc_id % 8 = 2 OR source IS NULL THEN 'contract:url' END)""", ""),
}


def _checked(stream: str) -> str:
    table, key, codes, other = _CODES[stream]
    status = "CASE WHEN codes <> '' THEN 'invalid' ELSE 'valid' END"
    status = f"coalesce({other}, {status})" if other else status
    return f"SELECT *, {status} AS status FROM (SELECT *, {codes} AS codes FROM {table})"


def _contract(stream: str) -> str:
    return f"SELECT {_CODES[stream][1]}, status, codes FROM ({_checked(stream)})"


_TRADE_CODES = "CASE event_id % 11 WHEN 1 THEN 'missing:p' WHEN 2 THEN 'cast:p:double' WHEN 4 THEN 'cast:s:long' WHEN 7 THEN 'cast:t:timestamp' WHEN 8 THEN 'parse:json' END"
_CRYPTO_CODES = "CASE event_id % 9 WHEN 5 THEN 'cast:time:timestamp' WHEN 6 THEN 'missing:ingest_timestamp' END"
_NEWS_LABEL = "CASE WHEN doc_id % 6 = 5 THEN NULL ELSE (['Bearish', 'Somewhat-Bearish', 'Neutral', 'Somewhat_Bullish', 'Bullish'])[doc_id % 6 + 1] END"
_TRADES_QUOTES = f"""t AS (SELECT event_id, CASE WHEN event_id % 11 = 6 THEN 'A1' ELSE {_SYMBOL} END AS symbol, ts, CASE WHEN event_id % 11 = 3 THEN -1.0 ELSE value END AS price FROM events WHERE event_id % 11 NOT IN (1, 2, 4, 7, 8)),
q AS (SELECT event_id AS quote_id, {_SYMBOL} AS symbol, ts AS quoted, CASE WHEN event_id % 5 = 0 THEN 0.0::DOUBLE ELSE round(value, 2) END AS bid_price, round(value, 2) + (event_id % 7 - 3) / 4.0 AS ask_price FROM events)"""
_SESSIONS = """m AS (SELECT *, CASE WHEN ts - lag(ts) OVER w >= INTERVAL 12 HOUR OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS opens FROM events WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id)),
g AS (SELECT *, sum(opens) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS k FROM m),
sessions AS (SELECT user_id, event_type, epoch_us(min(ts)) AS a, epoch_us(max(ts) + INTERVAL 12 HOUR) AS b, count(*) AS n FROM g GROUP BY user_id, event_type, k)"""
# Messages whose fields are sound or odd by their rows' numbers: m is a field's mode, n the number that odd values are made of.
_N, _HALF = "(user_id % 5 - 2)", "CAST(user_id % 5 - 2 || '.5' AS DOUBLE)"
_BREAKS = {
    "letter": "{m} < 6", "symbol": "{m} < 6", "text": "{m} IN (0, 1, 2, 4)", "maybe text": "{m} IN (2, 4)", "time": "{m} < 4", "tags": "{m} IN (2, 3, 4)", "maybe number": "{m} IN (2, 4)", "topics": "false",
    "count": "{m} IN (0, 1, 4, 5) OR {m} IN (2, 3) AND {n} < 0", "size": "{m} IN (0, 1, 4, 5) OR {m} IN (2, 3) AND {n} <= 0", "amount": "{m} IN (0, 1, 4) OR {m} IN (2, 3) AND {n} < 0 OR {m} > 5 AND value < 0",
    "price": "{m} IN (0, 1, 4, 5) OR {m} IN (2, 3) AND {n} < 0 OR {m} > 5 AND value <= 0",
}
_REQUIRED = {"T": "msg_type", "S": "symbol", "x": "exchange", "bx": "bid_exchange", "ax": "ask_exchange"}


def _mode(stream: str, name: str) -> str:
    place = [x for x, _ in MIXED[stream]].index(name)
    return f"((event_id * {2 * place + 1} + user_id + {3 * place}) % 16)"


def _list(cases: list[tuple[str, str]]) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN {when} THEN '{code}' END" for code, when in cases) + "], lambda x: x IS NOT NULL)"


def _mixed_contract(stream: str) -> str:
    codes = _list([(f"contract:{name}", _BREAKS[kind].format(m=_mode(stream, name), n=_N)) for name, kind in MIXED[stream]])
    return f"SELECT '{stream}' AS stream, event_id, CASE WHEN len({codes}) > 0 THEN 'invalid' ELSE 'valid' END AS status, array_to_string(list_sort({codes}), ';') AS codes FROM events"


def _mixed_codes(stream: str) -> tuple[str, str]:
    """What a pipeline finds wrong in a row, and, if that is nothing, which required columns are null."""
    wrong, empty = [], []
    for name, kind in MIXED[stream]:
        m = _mode(stream, name)
        if name in _REQUIRED:
            wrong.append((f"missing:{name}", f"{m} = 0"))
            empty.append((f"null:{_REQUIRED[name]}", f"{m} = 1"))
        elif kind in ("count", "size", "amount", "price", "time") or name == "ingest_timestamp" and stream == "crypto":
            to, odd = {"count": ("long", "1, 5"), "size": ("long", "1, 5"), "time": ("timestamp", "1, 2, 3"), "maybe number": ("double", "1, 2, 4")}.get(kind, ("double", "1, 4"))
            wrong += [(f"missing:{name}", f"{m} = 0"), (f"cast:{name}:{to}", f"{m} IN ({odd})")]
        elif name in ("ingest_timestamp", "overall_sentiment_score"):
            wrong.append((f"cast:{name}:double", f"{m} IN (2, 4)"))
        elif kind == "topics":
            wrong += [("cast:topics:double", f"{m} = 4"), ("cast:topics:object", f"{m} = 5")]
    return _list(wrong), _list(empty) if empty else "[]::VARCHAR[]"


def _mixed_rows(stream: str) -> str:
    wrong, empty = _mixed_codes(stream)
    number = lambda m, zero: f"CASE {m} WHEN 0 THEN '-' WHEN 1 THEN '-' WHEN 3 THEN {_HALF}::VARCHAR WHEN 5 THEN {zero} ELSE (event_id % 100 + 0.25)::DOUBLE::VARCHAR END"
    if stream == "news":
        t = _mode(stream, "topics")
        topics = f"CASE {t} WHEN 0 THEN '' WHEN 1 THEN '' WHEN 2 THEN '=0.0' WHEN 3 THEN event_type || '=0.0,=' || {_HALF}::VARCHAR ELSE 'b=0.75' END"
        shown = f"{topics} || '|' || {number(_mode(stream, 'overall_sentiment_score'), f'{_N}::DOUBLE::VARCHAR')}"
    else:
        ingest = number(_mode(stream, "ingest_timestamp"), f"{_N}::DOUBLE::VARCHAR" if stream == "crypto" else f"CASE WHEN {_N} = 0 THEN '-' ELSE {_N}::DOUBLE::VARCHAR END")
        last = "'buy'" if stream == "crypto" else f"CASE WHEN {_mode(stream, 'c')} IN (0, 1, 2, 5) THEN 0 WHEN {_mode(stream, 'c')} = 3 THEN 2 ELSE 1 END"
        shown = f"{ingest} || '|' || {last}"
    ingested = "NULL::BIGINT" if stream == "news" else "1700000000000000::BIGINT"
    return f"""SELECT '{stream}' AS stream, event_id, array_to_string(list_sort(codes), ';') AS codes, CASE WHEN len(codes) = 0 THEN {shown} ELSE '' END AS shown, CASE WHEN len(codes) = 0 THEN {ingested} END AS ingested
FROM (SELECT *, CASE WHEN len({wrong}) > 0 THEN {wrong} ELSE {empty} END AS codes FROM events)"""


_FIRST = "row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn"

# What the collectors receive, in frames, and what becomes of it.
_FRAMED = "event_id // 3, CASE WHEN event_id % 15 >= 12 OR {alone} THEN event_id END"
_PLACED = """min(event_id) OVER w AS frame, epoch_us(max(ts) OVER w) / 1000000.0 AS at0, row_number() OVER (PARTITION BY {f} ORDER BY event_id)::INTEGER - 1
         + CASE WHEN event_id // 3 % 10 = 0 AND NOT (event_id % 15 >= 12 OR {alone}) THEN 1 ELSE 0 END AS item"""


def _in_frames(stream: str, more: str, key: str, alone: str) -> str:
    f = _FRAMED.format(alone=alone)
    return f"""c AS (SELECT *, {more}, {_PLACED.format(f=f, alone=alone)} FROM ({_checked(stream)}) WINDOW w AS (PARTITION BY {f})),
ok AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY event_id) AS nth FROM c WHERE status = 'valid'),
said AS (SELECT * REPLACE (CASE WHEN nth > 1 THEN 'duplicate' ELSE status END AS status) FROM ok
         UNION ALL SELECT *, 0 FROM c WHERE status = 'invalid' AND codes <> 'parse:json')"""


_TRADES_IN = _in_frames("trades", "CASE WHEN event_id % 7 = 3 THEN event_id - 3 ELSE event_id END AS id", "id", "event_id % 11 = 8")
_QUOTES_IN = _in_frames(
    "quotes",
    """CASE WHEN event_id % 5 <> 0 AND round(value, 2) > 0 AND round(value, 2) + (event_id % 7 - 3) / 4.0 > 0 THEN round((round(value, 2) + (event_id % 7 - 3) / 4.0) - round(value, 2), 6) END AS spread,
         strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%S') || CASE WHEN event_id % 2 = 0 THEN 'Z' ELSE '+00:00' END AS t""",
    f"upper({_SYMBOL}), t", "false",
)
_CRYPTO_IN = f"""c AS (SELECT * FROM ({_checked("crypto")})),
p AS (SELECT c.*, coalesce((SELECT a.status = 'valid' FROM c a WHERE a.event_id = c.event_id - 1 AND c.event_id % 4 > 0), false) AS ok1,
             coalesce((SELECT b.status = 'valid' FROM c b WHERE b.event_id = c.event_id - 2 AND c.event_id % 4 > 1), false) AS ok2 FROM c),
said AS (SELECT * REPLACE (CASE WHEN status = 'valid' AND (event_id % 4 = 1 AND ok1 OR event_id % 4 = 2 AND ok1 AND NOT ok2) THEN 'duplicate' ELSE status END AS status) FROM p)"""
_NEWS_IN = f"""said AS (SELECT *, min(doc_id) OVER (PARTITION BY doc_id // 8, source) AS frame, row_number() OVER (PARTITION BY doc_id // 8, source ORDER BY doc_id)::INTEGER - 1 AS item FROM ({_checked("news")}))"""


def _listed(values: list[str]) -> str:
    return "([" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + f"])[event_id % {len(values)} + 1]"


_SNAPSHOT_METRICS = {
    "throughput_msgs_per_sec": "throughput_msgs_per_sec", "schema_compliance_rate": "schema_compliance_rate", "duplicate_rate": "duplicate_rate", "dlq_rate": "dlq_rate", "freshness_seconds_mean": "freshness_at_ingestion_seconds_mean",
    "violation_detection_time_ms": "contract_violation_detection_time_ms", "mean_bid_ask_spread": "mean_bid_ask_spread",
}
_RUN_METRICS = ("articles_fetched", "articles_valid", "articles_invalid", "articles_published", "articles_dlq", "schema_compliance_rate", "dlq_rate", "freshness_seconds_mean", "violation_detection_ms_mean")

ORACLES: dict[str, str] = {
    "contract_faults": "\nUNION ALL ".join(
        f"SELECT '{s}' AS stream, event_id, {_listed([x for _, x, _ in c])} AS status, {_listed([x for *_, x in c])} AS codes FROM events" for s, c in cases.CONTRACTS.items()
    ),
    "normalise_edges": "\nUNION ALL ".join(
        f"SELECT '{s}' AS stream, event_id, codes, {_listed([x for *_, x in c])} AS shown, CASE WHEN codes = '' AND '{s}' <> 'news' THEN 1700000000000000 END::BIGINT AS ingested FROM (SELECT event_id, {_listed([x for _, x, _ in c])} AS codes FROM events)"
        for s, c in cases.NORMALISED.items()
    ),
    "reconcile_trades": f"""
WITH m AS (SELECT *, {_TRADE_CODES} IS NULL AS good, CASE WHEN event_id % 7 = 3 THEN event_id - 3 ELSE event_id END AS id FROM events),
w AS (SELECT event_id, CASE WHEN NOT good THEN 'dead' WHEN row_number() OVER (PARTITION BY good, id ORDER BY event_id) = 1 THEN 'table_' ELSE 'duplicate' END AS lane FROM m),
n AS (SELECT count(*) AS came, count(*) FILTER (lane = 'table_') AS t, count(*) FILTER (lane = 'duplicate') AS dup, count(*) FILTER (lane = 'dead') AS dead, count(*) FILTER (lane = 'table_' AND event_id % 97 = 0) AS gone FROM w)
SELECT unnest(['whole', 'whole', 'whole', 'whole', 'whole', 'whole', 'short', 'short', 'short', 'short', 'short', 'short']) AS books, unnest(['came', 'table_', 'duplicate', 'dead', 'lost', 'surplus', 'came', 'table_', 'duplicate', 'dead', 'lost', 'surplus']) AS lane,
       unnest([came, t, dup, dead, 0, 0, came, t - gone, dup, dead, gone, 0])::BIGINT AS n FROM n""",
    "sketched_days": """
SELECT event_type, epoch_us(date_trunc('day', ts)) AS day, count(*) AS n, count(DISTINCT user_id) AS exact_users, true AS users_near, true AS median_near FROM events GROUP BY 1, 2""",
    "stream_sessions": f"""
WITH {_SESSIONS}
SELECT user_id || '|' || event_type AS key, count(*) AS n_accepted, count(*) AS n_sessions, sum(n)::BIGINT AS n_rows, min(a) AS first_start, max(b) AS last_end FROM sessions GROUP BY 1""",
    "contract_mixed": "\nUNION ALL ".join(map(_mixed_contract, MIXED)),
    "normalise_mixed": "\nUNION ALL ".join(map(_mixed_rows, MIXED)),
    "source_messages": """
SELECT 'events' AS source, 0 AS n_codes, count(*) AS n, sum((props->>'$.k')::BIGINT)::BIGINT AS total FROM events
UNION ALL SELECT 'customer', 0, count(*), sum(c_custkey)::BIGINT FROM customer""",
    "only_symbols": f"SELECT {_SYMBOL} AS symbol, count(*) AS n FROM events WHERE {_SYMBOL} IN ('view', 'click') GROUP BY 1",
    "metric_names": "SELECT p_partkey, lower(regexp_replace(p_name || '-Somewhat Bullish', '[- ]', '_', 'g')) AS name FROM part",
    "published_datetime": "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS published FROM events",
    "recent_dead_letters": f"SELECT event_id, {_TRADE_CODES} AS codes FROM events WHERE {_TRADE_CODES} IS NOT NULL ORDER BY event_id DESC LIMIT 500",
    "throughput_sliding": f"""
WITH v AS (SELECT stream, epoch_us(arrival_ts) AS us FROM ({_STATUS}) WHERE status = 'valid'),
w AS (SELECT stream, us // 600000000 * 600000000 - k * 600000000 AS window_start FROM v, range(0, 6) AS r(k))
SELECT stream, window_start, round(count(*) / 3600, 4) AS throughput_msgs_per_sec FROM w GROUP BY ALL""",
    "collector_memory": f"WITH {_TRADES_IN} SELECT frame, item, status FROM said",
    "collector_short_memory": f"""
WITH {_TRADES_IN}, o AS (SELECT *, row_number() OVER (ORDER BY frame, item) AS place FROM c WHERE status = 'valid')
SELECT frame, item, CASE WHEN place - lag(place) OVER (PARTITION BY id ORDER BY place) <= 2 THEN 'duplicate' ELSE status END AS status FROM o
UNION ALL SELECT frame, item, status FROM c WHERE status = 'invalid' AND codes <> 'parse:json'""",
    "stream_trade_quotes": f"""
WITH {_TRADES_QUOTES}
SELECT event_id, quote_id, t.symbol, price, bid_price FROM t JOIN q ON t.symbol = q.symbol AND quoted BETWEEN ts - INTERVAL 60 SECOND AND ts""",
    "stream_quality": f"WITH {_RECEIVED} SELECT stream, {_HOUR} AS window_start, {_COUNTS.format(p='window')}, {_RATES} FROM received GROUP BY ALL",
    "stream_two_queries": f"""
SELECT CASE WHEN {_TRADE_CODES} IS NULL THEN 'main' ELSE 'dead' END AS lane, count(*) AS n, 2::BIGINT AS batches FROM events GROUP BY event_id % 2, 1""",
    "stream_trades": f"""
SELECT 'main' AS lane, event_id::VARCHAR AS what, round(value * CASE WHEN event_id % 11 = 4 THEN 10 WHEN event_id % 11 = 5 THEN 10 ELSE user_id % 100 + 1 END, 8) AS trade_value
FROM (SELECT event_id, user_id, CASE WHEN event_id % 11 = 3 THEN -1.0 ELSE value END AS value FROM events WHERE {_TRADE_CODES} IS NULL)
UNION ALL SELECT 'dead', {_TRADE_CODES}, count(*)::DOUBLE FROM events WHERE {_TRADE_CODES} IS NOT NULL GROUP BY 2""",
    "stream_news": """
SELECT event_type AS what, count(DISTINCT user_id) AS n, count(DISTINCT user_id) AS n_stories FROM events WHERE event_id % 13 <> 0 GROUP BY 1
UNION ALL SELECT 'cast:time_published:timestamp', count(*), 0 FROM events WHERE event_id % 13 = 0""",
    "stream_collector": f"WITH {_QUOTES_IN}, n AS (SELECT status, count(*) AS n FROM said GROUP BY 1) SELECT * FROM n UNION ALL SELECT 'published', n FROM n WHERE status = 'valid'",
    "asof_trades_quotes": f"""
WITH {_TRADES_QUOTES}, z AS (SELECT * FROM q WHERE quote_id % 3 = 0)
SELECT event_id, t.symbol, price, quote_id, bid_price, ask_price, epoch_us(ts) - epoch_us(quoted) AS age_micros FROM t ASOF LEFT JOIN z ON t.symbol = z.symbol AND t.ts > z.quoted""",
    "asof_next_quote": f"""
WITH {_TRADES_QUOTES}, z AS (SELECT * FROM q WHERE quote_id % 3 = 1),
j AS (SELECT event_id, t.symbol, quote_id, epoch_us(quoted) - epoch_us(ts) AS wait FROM t ASOF LEFT JOIN z ON t.symbol = z.symbol AND t.ts <= z.quoted)
SELECT event_id, symbol, CASE WHEN wait <= 600000000 THEN quote_id END AS quote_id, CASE WHEN wait <= 600000000 THEN wait END AS wait_micros FROM j""",
    "quotes_around_trades": f"""
WITH {_TRADES_QUOTES}
SELECT event_id, count(*) AS n_quotes, max(bid_price) AS best_bid, min(ask_price) AS best_ask
FROM t JOIN q ON t.symbol = q.symbol AND quoted >= ts - INTERVAL 5 MINUTE AND quoted < ts GROUP BY event_id""",
    "sessions_overlap": f"""
WITH {_SESSIONS}
SELECT v.user_id, v.a AS session_start, e.a AS error_start, v.n, e.n AS error_n, least(v.b, e.b) - greatest(v.a, e.a) AS shared_micros
FROM sessions v JOIN sessions e ON v.user_id = e.user_id AND v.event_type = 'view' AND e.event_type = 'error' AND v.a < e.b AND e.a < v.b""",
    "trade_value": """
SELECT (l_orderkey * 8 + l_linenumber)::BIGINT AS trade_id, 'SYM' || l_returnflag || l_linestatus AS symbol, l_extendedprice AS price, l_quantity::BIGINT AS size,
       round(l_extendedprice * l_quantity::BIGINT, 8) AS trade_value, l_extendedprice * l_quantity::BIGINT > 10000 AS is_large_trade, CASE WHEN l_returnflag = 'R' THEN 2 ELSE 0 END AS n_conditions
FROM lineitem WHERE l_linenumber <> 7""",
    "trade_summary": """
SELECT 'SYM' || l_returnflag || l_linestatus AS symbol, count(*) AS n, count(*) FILTER (l_extendedprice * l_quantity::BIGINT > 10000) AS n_large,
       max(round(l_extendedprice * l_quantity::BIGINT, 8)) AS max_value, sum(l_quantity::BIGINT)::BIGINT AS volume
FROM lineitem WHERE l_linenumber <> 7 GROUP BY 1""",
    "trade_latency": f"""
WITH e AS (SELECT event_id, ts, {_EPOCH} AS at0, CASE WHEN event_id % 10 <> 0 THEN {_EPOCH} + (event_id % 1000) / 1000.0 END AS ingest FROM events WHERE event_id % 11 NOT IN (1, 2, 4, 7, 8))
SELECT event_id, CASE WHEN ingest IS NULL OR ingest = 0 THEN 0.0 ELSE round((ingest - at0) * 1000, 3) END AS latency_ms, round(coalesce(ingest - at0, 0.0), 6) AS freshness_seconds, epoch_us(ts) AS exchange_ts FROM e""",
    "trade_dead_letters": f"SELECT event_id, {_TRADE_CODES} AS codes FROM events WHERE {_TRADE_CODES} IS NOT NULL",
    "quote_spread": f"""
WITH q AS (SELECT event_id, {_SYMBOL} AS symbol, CASE WHEN event_id % 5 = 0 THEN 0.0::DOUBLE ELSE round(value, 2) END AS bid_price, round(value, 2) + (event_id % 7 - 3) / 4.0 AS ask_price,
                  CASE WHEN event_id % 13 = 0 THEN -1 ELSE 3 END::BIGINT AS ask_size FROM events)
SELECT *, CASE WHEN ask_price > 0 AND bid_price > 0 THEN round(ask_price - bid_price, 6) END AS spread FROM q""",
    "crypto_normalise": f"""
WITH c AS (SELECT event_id, CASE WHEN event_id % 9 = 3 THEN '1INCH-USD' ELSE upper({_SYMBOL}) || '-USD' END AS product_id, CASE event_id % 9 WHEN 2 THEN 0.0::DOUBLE ELSE value END AS price,
                  (user_id % 8 + 1) / 8.0 AS size, {_EPOCH} AS at0, epoch_us(ts) AS time FROM events WHERE event_id % 9 NOT IN (5, 6))
SELECT event_id, product_id, price, size, round(price * size, 8) AS trade_value, price * size > 10000 AS is_large_trade, round((at0 + 0.25 - at0) * 1000, 3) AS latency_ms, time FROM c""",
    "news_explode": """
SELECT 'https://c.example/' || conv_id || '/' || turn AS url, role AS title, length(text) AS n_chars, 0 AS n_topics, epoch_us(TIMESTAMP '2026-03-15 18:41:57') AS time_published FROM conversations""",
    "news_topics": """
SELECT CASE WHEN doc_id % 8 = 1 THEN '' ELSE 'doc ' || lang || ' ' || sha256(text) END AS title, CASE WHEN doc_id % 8 = 2 THEN 'ftp://x' ELSE 'https://x.example/' || source END AS url,
       'Earnings' AS topic, 0.75::DOUBLE AS relevance_score, (doc_id % 21 - 10) / 20.0 AS overall_sentiment_score FROM documents WHERE doc_id % 8 <> 3""",
    "news_dedup_key": "SELECT doc_id, sha256(coalesce(source, '') || '|' || coalesce(text, '')) AS dedup_key FROM documents",
    "news_first_seen": """
SELECT doc_id, source, sha256('|' || coalesce(text, '')) AS dedup_key FROM documents QUALIFY row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id) = 1""",
    "dedup_12h": f"""
WITH RECURSIVE o AS (SELECT event_id, user_id, event_type, ts, {_FIRST} FROM events),
r AS (SELECT *, ts AS seen, true AS accepted FROM o WHERE rn = 1
      UNION ALL
      SELECT o.*, CASE WHEN o.ts >= r.seen + INTERVAL 12 HOUR THEN o.ts ELSE r.seen END, o.ts >= r.seen + INTERVAL 12 HOUR
      FROM r JOIN o ON o.user_id = r.user_id AND o.event_type = r.event_type AND o.rn = r.rn + 1)
SELECT event_id, user_id, event_type FROM r WHERE accepted""",
    "dedup_session": """
SELECT event_id, user_id, event_type FROM events
QUALIFY coalesce(ts - lag(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) >= INTERVAL 12 HOUR, true)""",
    "session_12h": """
WITH m AS (SELECT *, CASE WHEN ts - lag(ts) OVER w >= INTERVAL 12 HOUR OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS opens FROM events WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id)),
g AS (SELECT *, sum(opens) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS k FROM m)
SELECT user_id, event_type, epoch_us(min(ts)) AS session_start, epoch_us(max(ts) + INTERVAL 12 HOUR) AS session_end, count(*) AS n FROM g GROUP BY user_id, event_type, k""",
    "throughput_rolling": """
SELECT event_id, round(count(*) OVER (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 3600 SECOND PRECEDING AND CURRENT ROW) / 3600, 4) AS throughput_msgs_per_sec FROM events""",
    "throughput_now": f"""
WITH {_RECEIVED}
SELECT stream, round(count(*) FILTER (status = 'valid' AND arrival_ts >= (SELECT max(ts) FROM events) - INTERVAL 86400 SECOND) / 86400, 4) AS throughput_msgs_per_sec FROM received GROUP BY stream""",
    "hourly_quality": f"WITH {_RECEIVED} SELECT stream, {_HOUR} AS window_start, {_COUNTS.format(p='window')}, {_RATES} FROM received GROUP BY ALL",
    "lifetime_totals": f"""
WITH {_RECEIVED}, h AS (SELECT stream, {_HOUR} AS window_start, {_COUNTS.format(p='n')} FROM received GROUP BY ALL)
SELECT stream, window_start, {', '.join(f"(sum(n_{n}) OVER (PARTITION BY stream ORDER BY window_start))::BIGINT AS total_{n}" for n in ('received', 'valid', 'invalid', 'duplicates', 'dlq'))} FROM h""",
    "freshness_last": _last("freshness_seconds", "valid", 4, "freshness_at_ingestion_seconds_mean"),
    "detection_last": _last("detection_ms", "invalid", 4, "contract_violation_detection_time_ms"),
    "spread_last": _last("spread", "valid", 6, "mean_bid_ask_spread"),
    "stream_snapshot": f"""
WITH {_RECEIVED}, t AS (SELECT stream, {_COUNTS.format(p='total')} FROM received GROUP BY stream),
n AS (SELECT stream, round(count(*) FILTER (status = 'valid' AND arrival_ts >= (SELECT max(ts) FROM events) - INTERVAL 60 SECOND) / 60, 4) AS throughput_msgs_per_sec FROM received GROUP BY stream),
w AS (SELECT *, row_number() OVER (PARTITION BY stream, status ORDER BY arrival_seq DESC) AS k FROM received WHERE date_trunc('hour', arrival_ts) = (SELECT date_trunc('hour', max(ts)) FROM events)),
c AS (SELECT stream, {_COUNTS.format(p='window')}, {_RATES} FROM w GROUP BY stream),
m AS (SELECT stream, round(avg(freshness_seconds) FILTER (status = 'valid' AND k <= 1000), 4) AS f, round(avg(detection_ms) FILTER (status = 'invalid' AND k <= 1000), 4) AS d,
             round(avg(spread) FILTER (status = 'valid' AND stream = 'quotes' AND event_id % 4 <> 0), 6) AS p FROM w GROUP BY stream)
SELECT t.*, throughput_msgs_per_sec, {', '.join(f"coalesce(window_{n}, 0) AS window_{n}" for n in ('received', 'valid', 'invalid', 'duplicates', 'dlq'))},
       coalesce(schema_compliance_rate, 1.0) AS schema_compliance_rate, coalesce(duplicate_rate, 0.0) AS duplicate_rate, coalesce(dlq_rate, 0.0) AS dlq_rate,
       coalesce(f, 0.0) AS freshness_at_ingestion_seconds_mean, coalesce(d, 0.0) AS contract_violation_detection_time_ms, coalesce(p, 0.0) AS mean_bid_ask_spread
FROM t JOIN n USING (stream) LEFT JOIN c USING (stream) LEFT JOIN m USING (stream)""",
    "metrics_union_streams": """
SELECT 'trades' AS stream, (SELECT count(*) FROM lineitem WHERE l_linenumber <> 7) AS n_main
UNION ALL SELECT 'quotes', (SELECT count(*) FROM events) UNION ALL SELECT 'crypto', (SELECT count(*) FROM events WHERE event_id % 9 NOT IN (5, 6))""",
    "contract_violation_counts": "SELECT stream, code, count(*) AS n FROM ("
    + " UNION ALL ".join(f"SELECT '{s}' AS stream, unnest(string_split(codes, ';')) AS code FROM ({_checked(s)}) WHERE codes <> ''" for s in _CODES)
    + ") GROUP BY ALL",
    "dlq_union": f"""
SELECT error, count(*) AS n FROM (SELECT {_TRADE_CODES} AS error FROM events UNION ALL SELECT {_CRYPTO_CODES} FROM events) WHERE error IS NOT NULL GROUP BY 1""",
    "collector_trades": f"""
WITH {_TRADES_IN}
SELECT frame, item, status, codes, CASE WHEN status = 'valid' THEN round(at0 - epoch_us(ts) / 1000000.0, 6) END AS freshness_seconds, CASE WHEN status = 'valid' THEN upper({_SYMBOL}) END AS symbol,
       CASE WHEN status = 'valid' THEN id END AS trade_id, CASE WHEN status = 'valid' THEN value END AS price, CASE WHEN status = 'valid' THEN CASE WHEN event_id % 11 = 4 THEN 10 ELSE user_id % 100 + 1 END END AS size,
       CASE WHEN status = 'valid' THEN round(at0, 6) END AS ingest_timestamp FROM said""",
    "collector_quotes": f"""
WITH {_QUOTES_IN}
SELECT frame, item, status, codes, CASE WHEN status = 'valid' THEN round(at0 - epoch_us(date_trunc('hour', ts)) / 1000000.0, 6) END AS freshness_seconds, CASE WHEN status = 'valid' THEN upper({_SYMBOL}) END AS symbol,
       CASE WHEN status = 'valid' THEN spread END AS spread, CASE WHEN status = 'valid' THEN spread END AS event_spread, CASE WHEN status = 'valid' THEN 3 END::BIGINT AS ask_size, CASE WHEN status = 'valid' THEN t END AS t FROM said""",
    "collector_crypto": f"""
WITH {_CRYPTO_IN}
SELECT event_id AS frame, status, codes, CASE WHEN status = 'valid' THEN event_id % 8 / 4.0 END AS freshness_seconds, CASE WHEN status = 'valid' THEN ['A', 'B', 'C'][event_id // 4 % 3 + 1] || '-USD' END AS product_id,
       CASE WHEN status = 'valid' THEN CASE WHEN event_id % 4 = 1 THEN event_id ELSE event_id + 1 END END AS trade_id, CASE WHEN status = 'valid' THEN round(value, 2)::VARCHAR END AS price,
       CASE WHEN status = 'valid' THEN CASE WHEN event_id % 3 = 0 THEN 'buy' ELSE 'sell' END END AS side FROM said""",
    "collector_news": f"""
WITH {_NEWS_IN}
SELECT frame, item, status, codes, CASE WHEN status = 'valid' THEN round((frame % 256) / 64.0, 6) END AS freshness_seconds, CASE WHEN status = 'valid' THEN 'https://x.example/' || source END AS url,
       CASE WHEN status = 'valid' THEN (doc_id % 21 - 10) / 20.0 END AS score, CASE WHEN status = 'valid' THEN {_NEWS_LABEL} END AS label FROM said""",
    "collector_status": f"""
WITH {_TRADES_IN} SELECT 'trades' AS stream, status, count(*) AS n, count(*) FILTER (status = 'valid') AS n_fresh, 0::BIGINT AS n_spreads FROM said GROUP BY status
UNION ALL SELECT * FROM (WITH {_QUOTES_IN} SELECT 'quotes', status, count(*), count(*) FILTER (status = 'valid'), count(*) FILTER (status = 'valid' AND spread IS NOT NULL) FROM said GROUP BY status)
UNION ALL SELECT * FROM (WITH {_CRYPTO_IN} SELECT 'crypto', status, count(*), count(*) FILTER (status = 'valid'), 0::BIGINT FROM said GROUP BY status)
UNION ALL SELECT * FROM (WITH {_NEWS_IN} SELECT 'news', status, count(*), count(*) FILTER (status = 'valid'), 0::BIGINT FROM said GROUP BY status)""",
    "collector_log": f"""
WITH {_QUOTES_IN}
SELECT frame, item, concat_ws(' ', 'QUOTES', upper(status), CASE WHEN status <> 'invalid' THEN 'symbol=' || upper({_SYMBOL}) || ' id=' || upper({_SYMBOL}) || '|' || t END,
       CASE WHEN status = 'valid' AND spread IS NOT NULL THEN 'spread=' || printf('%.4f', spread) END, CASE WHEN status = 'valid' THEN 'freshness=' || format('{{:,.3f}}', at0 - epoch_us(date_trunc('hour', ts)) / 1000000.0) END,
       CASE WHEN codes <> '' THEN 'errors=' || replace(codes, ';', ',') END) AS line FROM said""",
    "trade_frames": f"""
WITH {_TRADES_IN}
SELECT id AS trade_id, upper({_SYMBOL}) AS symbol, round(value * CASE WHEN event_id % 11 = 4 THEN 10 ELSE user_id % 100 + 1 END, 8) AS trade_value, round((at0 - epoch_us(ts) / 1000000.0) * 1000, 3) AS latency_ms,
       round(at0 - epoch_us(ts) / 1000000.0, 6) AS freshness_seconds FROM said WHERE status = 'valid'""",
    "news_pipeline": """
WITH RECURSIVE o AS (SELECT event_id, user_id, event_type, date_trunc('second', ts) AS told, row_number() OVER (PARTITION BY user_id, event_type ORDER BY date_trunc('second', ts), event_id) AS rn FROM events WHERE event_id % 13 <> 0),
r AS (SELECT *, told AS seen, true AS accepted FROM o WHERE rn = 1
      UNION ALL
      SELECT o.*, CASE WHEN o.told >= r.seen + INTERVAL 12 HOUR THEN o.told ELSE r.seen END, o.told >= r.seen + INTERVAL 12 HOUR
      FROM r JOIN o ON o.user_id = r.user_id AND o.event_type = r.event_type AND o.rn = r.rn + 1)
SELECT event_id, event_type AS title, 'https://e.example/' || user_id AS url, epoch_us(told) AS time_published FROM r WHERE accepted""",
    "dedup_trade_id": """
WITH r AS (SELECT (l_orderkey * 8 + l_linenumber)::BIGINT AS trade_id, l_extendedprice AS price,
                  row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_extendedprice, l_quantity::BIGINT) AS k FROM lineitem WHERE l_linenumber <> 7)
SELECT trade_id, count(*) AS n_first, min(price) AS price FROM r WHERE k = 1 GROUP BY 1""",
    "dedup_quote_key": f"""
SELECT event_id, row_number() OVER (PARTITION BY {_SYMBOL}, date_trunc('hour', ts) ORDER BY event_id) > 1 AS is_duplicate FROM events""",
    "dedup_either": """
WITH RECURSIVE e AS MATERIALIZED (SELECT event_id, event_id * event_id % 701 AS id1, (event_id * 31 + event_id // 5) % 997 AS id2, row_number() OVER (ORDER BY event_id) AS n FROM events),
r AS (SELECT n, event_id, id1, id2, true AS accepted, [id1] AS seen1, [id2] AS seen2 FROM e WHERE n = 1
      UNION ALL
      SELECT n, event_id, id1, id2, fresh, CASE WHEN fresh THEN list_append(seen1, id1)[-300:] ELSE seen1 END, CASE WHEN fresh THEN list_append(seen2, id2)[-300:] ELSE seen2 END
      FROM (SELECT e.*, r.seen1, r.seen2, NOT (list_contains(r.seen1, e.id1) OR list_contains(r.seen2, e.id2)) AS fresh FROM r JOIN e ON e.n = r.n + 1))
SELECT event_id, id1, id2, accepted FROM r""",
    "sentiment_distribution": f"SELECT {_NEWS_LABEL} AS label, count(*) AS n FROM ({_checked('news')}) WHERE status = 'valid' AND doc_id % 6 <> 5 GROUP BY 1",
    "sentiment_scale": """
WITH s AS (SELECT doc_id, (doc_id % 21 - 10) / 20.0 AS x FROM documents)
SELECT doc_id, CASE WHEN x <= -0.35 THEN 'Bearish' WHEN x <= -0.15 THEN 'Somewhat-Bearish' WHEN x < 0.15 THEN 'Neutral' WHEN x < 0.35 THEN 'Somewhat_Bullish' ELSE 'Bullish' END AS label FROM s""",
    "news_run_metrics": f"""
SELECT source AS run_id, count(*) AS articles_fetched, count(*) FILTER (status = 'valid') AS articles_valid, count(*) FILTER (status = 'invalid') AS articles_invalid,
       (CASE WHEN count(*) FILTER (status = 'valid') > 0 THEN 1 ELSE 0 END)::BIGINT AS articles_published, count(*) FILTER (status = 'invalid') AS articles_dlq,
       round(count(*) FILTER (status = 'valid') / count(*), 6) AS schema_compliance_rate, round(count(*) FILTER (status = 'invalid') / count(*), 6) AS dlq_rate,
       coalesce(round(avg((doc_id % 256) / 64.0) FILTER (status = 'valid'), 4), 0.0) AS freshness_seconds_mean,
       coalesce(round(avg((doc_id % 32) / 8.0) FILTER (status = 'invalid'), 4), 0.0) AS violation_detection_ms_mean
FROM ({_checked('news')}) GROUP BY 1""",
    "news_publish": f"""
WITH {_NEWS_IN}
SELECT source AS run_id, count(*)::INTEGER AS n_articles, arg_min('doc ' || lang || ' ' || sha256(text), doc_id) AS first_title FROM said WHERE status = 'valid' GROUP BY 1""",
    "symbol_upper_valid": r"""
SELECT name, regexp_full_match(name, '[.-]*\p{L}[\p{L}.-]*') AS valid, upper(name) AS symbol FROM (SELECT n_name AS name FROM nation UNION ALL SELECT p_name FROM part)""",
    "iso_truncate": """
SELECT o_orderkey, epoch_us(date_trunc('second', o_orderdate)) + 123456 AS micros, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '.123456 UTC' AS text FROM orders""",
    "compact_ts": """
SELECT event_id, epoch_us(date_trunc('second', ts)) AS micros, strftime(ts, '%Y-%m-%dT%H:%M:%S UTC') AS text, strftime(date_trunc('second', ts) - INTERVAL 15 MINUTE, '%Y%m%dT%H%M') AS cutoff FROM events""",
} | {f"contract_{s}": _contract(s) for s in _CODES}
_PREFIX = "CASE stream WHEN 'trades' THEN 'alpaca_collector_trades' WHEN 'quotes' THEN 'alpaca_collector_quotes' ELSE 'coinbase_collector' END"
ORACLES["exposition_text"] = f"WITH s AS ({ORACLES['stream_snapshot']})" + " UNION ALL ".join(
    [f"\nSELECT {_PREFIX} || '_{n}' AS metric, 'gauge' AS kind, {c}::DOUBLE AS value FROM s" + (" WHERE stream <> 'crypto'" if n == "mean_bid_ask_spread" else "") for n, c in _SNAPSHOT_METRICS.items()]
    + [f"\nSELECT {_PREFIX} || '_total_{n}_total', 'counter', total_{n}::DOUBLE FROM s" for n in ("received", "valid", "invalid", "duplicates", "dlq")]
)
ORACLES["run_text"] = f"WITH s AS (SELECT * FROM ({ORACLES['news_run_metrics']}) WHERE run_id IS NOT NULL ORDER BY run_id LIMIT 1)" + " UNION ALL ".join(
    [f"\nSELECT 'news_collector_{n}' AS metric, {n}::DOUBLE AS value FROM s" for n in _RUN_METRICS] + ["\nSELECT 'news_collector_api_latency_seconds', 0.5", "\nSELECT 'news_collector_run_duration_seconds', 2.5", "\nSELECT 'news_collector_sentiment_somewhat_bearish_count', 3.0"]
)
